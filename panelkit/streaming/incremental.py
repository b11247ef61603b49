"""Structured Streaming wrappers around the row-wise cleaning operators and
the grouped yearly rate.

Only stateless operators (text cleaning, target encoding, code
standardisation, invalid-row, year and topic filters) are applied per
micro-batch; operators that need whole-table statistics (outliers, constant
columns, medians) stay batch-only. The rate is kept as running sums per key
in the state store (update mode), so state grows with the number of keys,
not with the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import clean as CL


def clean_stream(df: DataFrame, target: str | None = None, topic_patterns=None) -> DataFrame:
    """Text clean -> invalid rows -> codes -> (topic filter) -> target encode."""
    out = CL.clean_text_columns(df)
    out = CL.drop_invalid(out)
    out = CL.standardize_codes(out)
    if topic_patterns:
        out = CL.where_topic(out, topic_patterns)
    if target and target in out.columns:
        out = out.withColumn("vote", S.encode_target(F.col(target)))
    return out


def rate_by_stream(df: DataFrame, key: str, target: str) -> DataFrame:
    """Running mean and count of the target per key (update output mode)."""
    return (df.where(F.col(key).isNotNull() & F.col(target).isNotNull())
              .groupBy(key)
              .agg(F.avg(F.col(target).cast("double")).alias("mean"), F.count("*").alias("count")))


def run_available(df: DataFrame, name: str, checkpoint: str, mode: str = "update"):
    """Run a streaming frame over everything available into a memory table
    ``name`` (checkpointed for restarts) and return that table."""
    q = (df.writeStream.outputMode(mode).format("memory").queryName(name)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)
