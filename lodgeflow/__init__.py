"""lodgeflow: a Spark-native ELT pipeline and analysis layer for monthly
short-term-rental listing snapshots (staging -> star schema -> marts ->
business questions), expressed with the DataFrame API so Catalyst and AQE
plan the physical work."""

__version__ = "0.1.0"
