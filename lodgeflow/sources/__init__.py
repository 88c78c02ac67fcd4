"""Sources: positional CSV files of the raw layer and the parquet tables."""
