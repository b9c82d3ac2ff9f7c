"""fiscalflow: open-data ingest and series analysis on Spark."""
