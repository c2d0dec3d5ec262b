"""The live feed as streams: state that expires, a bounded log, health from metrics, a list that changes."""

import json
import time

from pyspark.sql import functions as F

from barwright.streaming import feed

EVENTS = "contract_key string, t long, ev string, event_id long"


def add(folder, name, rows):
    """A file of events, which appears at once."""
    text = "".join(json.dumps(dict(zip(("contract_key", "t", "ev", "event_id"), r, strict=True))) + "\n" for r in rows)
    (folder.parent / name).write_text(text)
    (folder.parent / name).rename(folder / name)


def source(spark, folder):
    folder.mkdir(exist_ok=True)
    return spark.readStream.schema(EVENTS).json(str(folder))


def until(spark, run, table, condition, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if run.exception():
            raise run.exception()
        rows = [tuple(r) for r in spark.table(table).collect()]
        if condition(rows):
            return rows
        time.sleep(0.3)
    raise AssertionError(rows)


def quotes(tmp_path, events, name, ttl):
    q = feed.latest_quotes_with_ttl(events, ttl_seconds=ttl)
    return q.writeStream.format("memory").queryName(name).outputMode("update").option("checkpointLocation", str(tmp_path / "checkpoint")).start()


def test_quotes_go_by_arrival(spark, tmp_path):
    """Within a micro-batch the last to arrive counts, whatever its time and place; what arrives late changes nothing."""
    events = source(spark, tmp_path / "in")
    add(tmp_path / "in", "a.json", [("A", 9, "Q", 12), ("A", 50, "T", 11), ("B", None, "Q", 3), ("A", 70, "Q", 10), ("C", 1, "Q", 7)])
    run = quotes(tmp_path, events, "arrivals", 600)
    try:
        until(spark, run, "arrivals", lambda rows: len(rows) == 2)
        add(tmp_path / "in", "b.json", [("A", 99, "Q", 5), ("C", 2, "Q", 8)])
        rows = until(spark, run, "arrivals", lambda rows: ("C", 8, 2, "Q", False) in rows)
        assert sorted(rows) == [("A", 12, 9, "Q", False), ("C", 7, 1, "Q", False), ("C", 8, 2, "Q", False)]
    finally:
        run.stop()


def test_quotes_expire_and_come_back(spark, tmp_path):
    """A quote is forgotten, told of once, and comes back."""
    events = source(spark, tmp_path / "in")
    add(tmp_path / "in", "a.json", [("A", 9, "Q", 12)])
    run = quotes(tmp_path, events, "expiries", 2)
    try:
        rows = until(spark, run, "expiries", lambda rows: len(rows) == 2)
        assert sorted(rows) == [("A", 12, 9, "Q", False), ("A", 12, 9, "Q", True)]
        add(tmp_path / "in", "b.json", [("A", 3, "Q", 4)])  # forgotten, so even a lower number is news
        rows = until(spark, run, "expiries", lambda rows: len(rows) == 4)
        assert sorted(rows)[:2] == [("A", 4, 3, "Q", False), ("A", 4, 3, "Q", True)]
    finally:
        run.stop()


def test_log_is_bounded_on_disk(spark, tmp_path):
    """After several runs over more events than are kept, the stored files hold the newest ones and at most a bucket more."""
    feed_in = tmp_path / "in"
    for part in range(5):
        events = source(spark, feed_in)
        add(feed_in, f"{part}.json", [("A", part * 1000 + i, "Q", part * 1000 + i) for i in range(400)] + [("A", None, "Q", -part)])
        log = feed.run_to_bounded_log(events, str(tmp_path / "run"), keep=500, bucket_ms=100)
        kept = [r["t"] for r in log.collect()]
        everything = sorted((p * 1000 + i for p in range(part + 1) for i in range(400)), reverse=True)
        assert sorted((t for t in kept if t is not None), reverse=True) == everything[: 500 if part else 400]
        assert None not in kept if part > 1 else True
    buckets = {p.name for p in (tmp_path / "run" / "log").iterdir() if p.name.startswith("bucket=")}
    assert buckets == {f"bucket={b}" for b in (40, 41, 42, 43, 33)}


def test_health_comes_from_the_stream(spark, tmp_path):
    events = source(spark, tmp_path / "in")
    for n in range(3):
        add(tmp_path / "in", f"{n}.json", [("A", n * 10 + i, "Q", i) for i in range(4)])
    watch = feed.StreamHealth()
    spark.streams.addListener(watch)
    try:
        assert watch.row(spark, 10).collect() == [(0, None, True)]
        feed.run_to_files(feed.observed(events), "health", "append")
        assert watch.ended.wait(60)
    finally:
        spark.streams.removeListener(watch)
    assert watch.batches >= 1 and watch.row(spark, 100_000).first() == (12, 23, False) and watch.row(spark, 200_000).first()["stale"]


def test_list_changes_between_micro_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    lists = [["A"], ["A", "B"], ["B"]]
    for n in range(3):
        add(tmp_path / "in", f"{n}.json", [(f"{s}|OPT", n, "Q", n) for s in "ABC"])
        time.sleep(1.1)  # files are taken by their time
    asked = iter(lists)
    feed.run_watched(events, lambda: spark.createDataFrame([(s,) for s in next(asked)], "symbol string"), str(tmp_path / "run"))
    rows = spark.read.parquet(str(tmp_path / "run" / "rows")).select("contract_key", "t").collect()
    assert sorted((r["contract_key"][0], r["t"]) for r in rows) == [("A", 0), ("A", 1), ("B", 1), ("B", 2)]
    changes = spark.read.parquet(str(tmp_path / "run" / "changes")).orderBy("batch", "symbol").collect()
    assert [(r["batch"], r["symbol"], r["action"]) for r in changes] == [(0, "A", "add"), (1, "B", "add"), (2, "A", "remove")]


def test_written_rows_are_counted_by_the_write(spark, tmp_path):
    from barwright.sources import sinks

    df, now = spark.range(7).withColumn("x", F.lit(1)), F.lit("2024-01-02").cast("timestamp")
    row = sinks.write_observed(df, str(tmp_path / "out"), "d", now).first()
    assert (row["rows_written"], row["status"]) == (7, "ok")
    assert sinks.write_observed(df, str(tmp_path / "out"), "d", now, mode="error").first()["status"] == "failed" and spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_trimmed_log_keeps_its_whole_length(spark, sf, tmp_path):
    """Of a feed longer than the log, as many events stay as the log keeps, the newest."""
    import duckdb

    from barwright import plans
    from tests.oracle import compare

    duckdb.sql(f"copy (select event_id + 1000000 * k as event_id, ts + to_minutes(k) as ts, * exclude (event_id, ts) from '{sf}/events.parquet', range(16000 // (select count(*) from '{sf}/events.parquet')) r(k)) to '{tmp_path}/events.parquet'")
    assert plans.QUERIES["k4_event_log_trimmed"](spark, str(tmp_path)).count() == feed.LOG_LENGTH == 10_000
    compare(spark, str(tmp_path), plans.QUERIES["k4_event_log_trimmed"], plans.ORACLE_SQL["k4_event_log_trimmed"])
