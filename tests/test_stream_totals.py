"""Totals of streams over batches and restarts."""

from types import SimpleNamespace

from pyspark.sql import Row

from editengine.plans import catalog
from editengine.streaming.sinks import StreamTotals


def report(batch, published, rows=10, query="q"):
    return SimpleNamespace(progress=SimpleNamespace(
        id=query, batchId=batch, numInputRows=rows, durationMs={"triggerExecution": 500},
        observedMetrics={"feed": Row(published=published, blank=1)},
    ))


def test_figures_add_up_and_survive(spark, tmp_path):
    first = StreamTotals(spark, f"{tmp_path}/totals")
    assert first.totals("q") == {"rows": 0, "busy_ms": 0, "missing": 0, "rows_per_second": 0.0}
    first.onQueryProgress(report(0, 5))
    first.onQueryProgress(report(1, 7))
    first.onQueryProgress(report(0, 1, query="other"))
    again = StreamTotals(spark, f"{tmp_path}/totals")
    again.onQueryProgress(report(1, 7))  # delivered again
    again.onQueryProgress(report(0, 5))  # a late report
    assert again.totals("q") == {"rows": 20, "busy_ms": 1000, "feed.published": 12, "feed.blank": 2, "missing": 0, "rows_per_second": 20.0}
    again.onQueryProgress(report(3, 2))  # nobody saw batch 2
    assert again.totals("q")["missing"] == 1 and again.totals("q")["feed.published"] == 14
    assert again.totals("other")["feed.published"] == 1
    assert len(list((tmp_path / "totals").glob("*.json"))) == 1


def test_two_runs_count_like_one_batch(spark, small):
    assert catalog.QUERIES["stream_counters"](spark, small).collect() == catalog.QUERIES["ingest_counters"](spark, small).collect()
