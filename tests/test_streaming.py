import pytest
from pyspark.sql import functions as F

from lexlake.catalog.views import audit_columns
from lexlake.plans import monitoring
from lexlake.streaming import arrival, monitors

FIGURES = [
    monitoring.quarantine_rate,
    monitoring.quarantine_by_rule,
    monitoring.failure_rate,
    monitoring.throughput,
    monitoring.stage_latency,
    monitoring.error_count,
]


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    """Events in several files, in time order, plus one late flush row that moves the
    watermark past every window."""
    path = str(tmp_path_factory.mktemp("landing"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i in range(3):
        events.where(F.floor(F.dayofmonth("ts") / 11) == i).coalesce(1).write.mode("append").parquet(path)
    return path, events


@pytest.mark.parametrize("figure", FIGURES, ids=lambda f: f.__name__)
def test_stream_equals_batch(spark, landing, tmp_path, figure):
    path, events = landing
    flush = str(tmp_path / "in")
    events.write.parquet(flush)
    stream = arrival.arrivals(spark, flush, events.schema)
    sink, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: monitors.start(audit_columns(stream), figure, sink, state).awaitTermination()
    run()
    # an event far ahead closes every window; it belongs to none of them
    events.limit(1).withColumn("ts", F.expr("timestamp_ntz'2030-01-01 00:00:00'")).write.mode("append").parquet(flush)
    run()
    batch = figure(audit_columns(events))
    got = spark.read.parquet(sink).where("window_start < '2029-01-01'").select(*batch.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))


def test_each_file_is_ingested_once(spark, landing, tmp_path):
    path, events = landing
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    seen = []

    def process(batch, batch_id):
        seen.append((batch_id, batch.count()))
        arrival.land_by_batch(out)(batch, batch_id)

    stream = arrival.arrivals(spark, path, events.schema, files_per_batch=1)
    for _ in range(2):
        arrival.ingest(stream, state, process).awaitTermination()
    assert sum(n for _, n in seen) == events.count() and len(seen) >= 3
    assert spark.read.parquet(out).count() == events.count()


def test_a_failed_batch_is_retried_alone(spark, landing, tmp_path):
    path, events = landing
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    calls = []

    def flaky(batch, batch_id):
        calls.append(batch_id)
        arrival.land_by_batch(out)(batch, batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost after writing")

    stream = arrival.arrivals(spark, path, events.schema, files_per_batch=1)
    with pytest.raises(Exception, match="lost after writing"):
        arrival.ingest(stream, state, flaky).awaitTermination()
    arrival.ingest(stream, state, flaky).awaitTermination()
    assert calls[1] == calls[2] and len(set(calls)) == len(calls) - 1
    assert spark.read.parquet(out).count() == events.count()


def test_other_suffixes_are_ignored(spark, landing, tmp_path):
    _, events = landing
    src = tmp_path / "in"
    events.coalesce(1).write.parquet(str(src))
    (src / "note.txt").write_text("not data")
    stream = arrival.arrivals(spark, str(src), events.schema)
    rows = []
    arrival.ingest(stream, str(tmp_path / "s"), lambda b, i: rows.append(b.count())).awaitTermination()
    assert sum(rows) == events.count()


def test_dedup_upsert_over_restarts(spark, landing, tmp_path):
    from lexlake.operators.partitions import with_month

    _, events = landing
    src, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):  # the same events delivered in two runs
        events.write.mode("append").parquet(src)
        stream = monitors.event_time(arrival.arrivals(spark, src, events.schema).drop("_source_file"))
        unique = with_month(arrival.dedup_stream(stream, ["event_id"], "ts", "10 minutes"), "ts")
        load = arrival.upsert_batches(out, ["event_id", "month"], ["ts"], "month")
        arrival.ingest(unique, state, load).awaitTermination()
    assert spark.read.parquet(out).count() == events.count()
