"""Sources (CSV discovery and loading, Parquet tables) and sinks."""
