"""Streaming forms agree with the batch operators on the same files."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelkit.operators import stats as ST
from panelkit.streaming import clean_stream, rate_by_stream, run_available

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_stream_rate_equals_batch(spark):
    batch = spark.read.parquet(f"{SF}/orders.parquet")
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "orders.parquet").parquet(SF)

    def prep(df):
        v = df.select(F.year("o_orderdate").alias("year"),
                      F.when(F.col("o_orderstatus") == "F", " y").otherwise("no").alias("ms_vote"))
        return clean_stream(v, target="ms_vote")

    ck = tempfile.mkdtemp(prefix="pk-stream-")
    got = run_available(rate_by_stream(prep(stream), "year", "vote"), "rate_stream", ck, "complete")
    want = ST.rate_by(prep(batch), "year", "vote")
    norm = lambda d: sorted((r.year, round(r.mean, 9), r["count"]) for r in d.collect())
    assert norm(got) == norm(want)
