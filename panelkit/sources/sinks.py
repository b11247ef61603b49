"""Result sink: every result / chart-data table as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_results(dfs: dict, directory: str, mode: str = "overwrite") -> list:
    """Write each DataFrame to ``directory/<name>`` (Parquet); returns paths.
    Tables keep their partitioning: a coalesce to one file would pull the last
    stage into one task."""
    paths = []
    for name, df in dfs.items():
        if not isinstance(df, DataFrame):
            continue
        path = f"{directory.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(path)
        paths.append(path)
    return paths

