"""Matrix sources and sinks: generators, Parquet scan/write, matrices from tables."""
