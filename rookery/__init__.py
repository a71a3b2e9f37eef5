"""rookery: Spark jobs that turn fetched pages and listings into a clean, merged, published entity dataset."""
