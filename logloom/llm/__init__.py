"""Training-data operators: deduplication, scans, packing and extraction on Spark."""
