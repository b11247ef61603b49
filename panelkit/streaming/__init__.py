"""Incremental forms of existing operators (the batch job has no streams of
its own). Row-wise operators are plain projections / filters and run
unchanged on a streaming DataFrame; the yearly rate (A1) runs as a stateful
streaming aggregate."""

from panelkit.streaming.incremental import clean_stream, rate_by_stream, run_available  # noqa: F401
