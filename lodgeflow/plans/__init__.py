"""Plans: staging, warehouse, marts and analysis built from DataFrames."""
