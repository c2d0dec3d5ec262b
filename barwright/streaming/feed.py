"""Live option feed: decoding, latest state, log and health. The transformations work on streams and on batches alike."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from ..functions.columns import stream_contract_key
from ..sources.landing import with_document
from ..sources.scratch import new_folder

MESSAGE = "ev string, sym string, t bigint, s bigint, bp double, ap double, bs bigint, `as` bigint, o double, h double, l double, c double, v double, p double"
#: Fixed value: events that the log keeps. Milliseconds of event time in a bucket of it.
LOG_LENGTH, BUCKET_MS = 10_000, 6 * 3600 * 1000
#: Seconds after which a quote that was not renewed expires; seconds after which the feed is stale.
TTL, STALE = 300, 120


def decoded(raw: DataFrame, value: str = "value") -> DataFrame:
    """Events of messages that are a JSON object or an array of them; elements that are no objects or have no `ev`, and broken JSON, are left out, and only they.

    Other columns stay.
    """
    keep = [F.col(c) for c in raw.columns if c != value]
    text = F.trim(F.col(value))
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    messages = raw.withColumn(value, F.concat(F.lit('{"m":'), listed, F.lit("}")))
    rows = with_document(messages, f"m array<struct<{', '.join(x.replace(' ', ': ', 1) for x in MESSAGE.split(', '))}>>", "j", value)
    return rows.select(*keep, F.explode("j.m").alias("m")).where("m.ev <> ''").select(*keep, "m.*")


def normalized(events: DataFrame) -> DataFrame:
    """Rows (contract_key, ev, t, bid, ask, last, size, open, high, low, close, volume): quotes, aggregates and trades carry their own fields, other kinds pass with key and time; unreadable symbols go."""
    ev = F.col("ev")
    quote, bar, trade = ev == "Q", ev.isin("A", "AM"), ev == "T"
    only = lambda test, c, name: F.when(test, F.col(c)).alias(name)
    keep = [c for c in events.columns if c not in {x.split()[0].strip("`") for x in MESSAGE.split(", ")}]
    return events.select(
        *keep, stream_contract_key(F.col("sym")).alias("contract_key"), "ev", F.when(bar, F.coalesce("s", "t")).otherwise(F.col("t")).alias("t"), only(quote, "bp", "bid"), only(quote, "ap", "ask"), only(trade, "p", "last"), only(trade, "s", "size"),
        only(bar, "o", "open"), only(bar, "h", "high"), only(bar, "l", "low"), only(bar, "c", "close"), only(bar, "v", "volume"),
    ).where("contract_key is not null")


def latest_quotes(events: DataFrame, order: list[str]) -> DataFrame:
    """The last event of each contract by event time; on a stream, run it in update or complete mode."""
    rest = [c for c in events.columns if c not in ("contract_key", *order)]
    return events.groupBy("contract_key").agg(F.max(F.struct(*order, *rest)).alias("m")).select("contract_key", "m.*")


class _QuoteState(StatefulProcessor):
    """The last event of a contract by its number of arrival, which the state store forgets after a time; the notice of that is sent by a timer."""

    FIELDS = "seq long, t long, ev string"

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getValueState("live", self.FIELDS, ttlDurationMs=self.ttl_ms)
        self.last = handle.getValueState("last", self.FIELDS)  # what the notice tells; cleared with it

    def _row(self, key: tuple, held: tuple, expired: bool) -> pd.DataFrame:
        return pd.DataFrame({"contract_key": [key[0]], "seq": [held[0]], "t": [held[1]], "ev": [held[2]], "expired": [expired]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.live.get() if self.live.exists() else None
        new = None
        for batch in rows:
            if len(batch):
                r = batch.loc[batch["seq"].idxmax()]
                if (new or held) is None or r["seq"] > (new or held)[0]:
                    new = (int(r["seq"]), int(r["t"]), str(r["ev"]))
        if new:
            self.live.update(new)
            self.last.update(new)
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
            yield self._row(key, new, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.last.exists():
            held = self.last.get()
            self.last.clear()
            self.live.clear()
            yield self._row(key, held, True)


def latest_quotes_with_ttl(events: DataFrame, ttl_seconds: float = TTL, arrival: str = "event_id") -> DataFrame:
    """The last event of each contract by arrival, forgotten after ttl_seconds without a new one: columns contract_key, seq, t, ev, expired.

    arrival is a column that grows as events arrive, such as an offset; within a micro-batch the greatest counts whatever the order of rows after the shuffle, and an
    event that is older than the one held changes nothing. Needs a streaming input; the state is kept by RocksDB (set on the session), two rows
    for each live contract. A change is emitted in update mode; an expiry once, with expired true.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = events.where(F.col("t").isNotNull() & F.col(arrival).isNotNull()).select("contract_key", F.col(arrival).cast("long").alias("seq"), "t", "ev")
    schema = f"contract_key string, {_QuoteState.FIELDS}, expired boolean"
    return rows.groupBy("contract_key").transformWithStateInPandas(_QuoteState(int(ttl_seconds * 1000)), schema, "Update", "ProcessingTime")


def health(events: DataFrame, now_ms: Column, stale_seconds: int = STALE) -> DataFrame:
    """Messages, time of the last one, and whether the feed is stale."""
    age = (now_ms - F.max("t")) / 1000
    return events.agg(F.count("*").alias("messages"), F.max("t").alias("last_t"), (age > stale_seconds).alias("stale"))


def observed(events: DataFrame, name: str = "health") -> DataFrame:
    """events with their number and last time measured on the way, for `StreamHealth` or an `Observation`."""
    return events.observe(name, F.count("*").alias("messages"), F.max("t").alias("last_t"))


class StreamHealth(StreamingQueryListener):
    """Health of streams from their own metrics: what `observed` measured in each micro-batch, added up as progress is reported. Nothing is read twice.

    Register it with `spark.streams.addListener`.
    """

    def __init__(self, name: str = "health"):
        self.name, self.messages, self.last_t, self.batches, self.ended = name, 0, None, 0, threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.ended.clear()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress.observedMetrics.get(self.name)
        if found:
            self.batches += 1
            self.messages += found["messages"]
            self.last_t = max((t for t in (self.last_t, found["last_t"]) if t is not None), default=None)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.set()

    def row(self, spark: SparkSession, now_ms: int, stale_seconds: int = STALE) -> DataFrame:
        """One row (messages, last_t, stale); a feed without a message is stale."""
        stale = self.last_t is None or (now_ms - self.last_t) / 1000 > stale_seconds
        return spark.createDataFrame([(self.messages, self.last_t, stale)], "messages long, last_t long, stale boolean")


def watched(events: DataFrame, symbols: DataFrame) -> DataFrame:
    """Events of contracts whose underlying is on the list."""
    root = F.substring_index("contract_key", "|", 1)
    return events.withColumn("symbol", root).join(symbols.select("symbol").distinct(), "symbol", "left_semi")


def run_watched(stream: DataFrame, symbols: Callable[[], DataFrame], path: str) -> None:
    """Runs a stream over what is there now and adds its events of watched underlyings under path/rows.

    The list is asked for anew in every micro-batch, so a change holds from the next one on, and its difference from the list before is kept under path/changes.
    A run goes on where the last one ended. A micro-batch that is run again overwrites what it wrote before.
    """

    def step(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        now = symbols().select("symbol").distinct()
        now.write.mode("overwrite").parquet(f"{path}/lists/{batch}")
        now = spark.read.schema("symbol string").parquet(f"{path}/lists/{batch}")
        before = spark.read.schema("symbol string").parquet(f"{path}/lists/{batch - 1}") if batch else now.where("false")
        subscription_diff(before, now).write.mode("overwrite").parquet(f"{path}/changes/batch={batch}")
        watched(rows, now).write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")

    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{path}/checkpoint").foreachBatch(step).start().awaitTermination()


def subscription_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Symbols to add and to remove when a list changes."""
    add = after.select("symbol").distinct().join(before.select("symbol"), "symbol", "left_anti").withColumn("action", F.lit("add"))
    return add.union(before.select("symbol").distinct().join(after.select("symbol"), "symbol", "left_anti").withColumn("action", F.lit("remove")))


def newest_kept(rows: DataFrame, n: int, order: tuple[str, ...] = ("t", "event_id")) -> DataFrame:
    """The newest n rows."""
    return rows.orderBy(*(F.col(c).desc_nulls_last() for c in order)).limit(n)


def run_to_bounded_log(stream: DataFrame, path: str, keep: int = LOG_LENGTH, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Runs a stream over what is there now and adds its events to a log under path, laid out by buckets of event time; returns the log.

    After each micro-batch whole buckets are dropped once newer ones hold `keep` events, so the log holds the newest `keep`, and at most a
    bucket more. What is dropped is known from the files' row counts alone. Events without a time are in a bucket of their own, the oldest.
    """
    spark = stream.sparkSession
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in stream.schema)}, bucket long, batch long"
    log = f"{path}/log"
    folder = spark._jvm.org.apache.hadoop.fs.Path(log)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)

    def step(rows: DataFrame, batch: int) -> None:
        out = rows.withColumns({"bucket": F.coalesce(F.floor(F.col("t") / bucket_ms), F.lit(-1)), "batch": F.lit(batch)})
        # only this micro-batch's folders are overwritten, so it may run again
        out.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(log)
        held = rows.sparkSession.read.schema(schema).parquet(log).groupBy("bucket").count().orderBy(F.desc("bucket")).toLocalIterator()
        newer = 0
        for r in held:
            if newer >= keep:
                files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{log}/bucket={r['bucket']}"), True)
            newer += r["count"]

    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{path}/checkpoint").foreachBatch(step).start().awaitTermination()
    return spark.read.schema(schema).parquet(log).select(*stream.columns)


def ticks(log: DataFrame, ev: str, start_ms: int, end_ms: int) -> DataFrame:
    """Logged events of a kind in a time range."""
    return log.where((F.col("ev") == ev) & F.col("t").between(start_ms, end_ms))


def run_to_files(stream: DataFrame, name: str, mode: str) -> DataFrame:
    """Runs a stream over what is there now and reads the Parquet files it wrote under spark.checkpoint.dir, where its checkpoint lies too.

    In append mode the stream writes every row; in complete mode each micro-batch replaces the state that the one before wrote; in update
    mode each micro-batch adds the rows that changed.
    """
    spark: SparkSession = stream.sparkSession
    path = new_folder(spark, f"stream-{name}")
    now = {"once": True} if mode == "update" else {"availableNow": True}  # state with timers never runs out of micro-batches
    writer = stream.writeStream.outputMode(mode).trigger(**now).option("checkpointLocation", f"{path}/checkpoint")
    if mode == "complete":
        spark.createDataFrame([], stream.schema).write.parquet(f"{path}/rows")  # the state before the first micro-batch
        writer = writer.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{path}/rows"))
    elif mode == "update":
        spark.createDataFrame([], stream.schema).write.parquet(f"{path}/rows")
        # A batch that is run again after a failure overwrites what it wrote before.
        writer = writer.foreachBatch(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}"))
    else:
        writer = writer.format("parquet").option("path", f"{path}/rows")
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(f"{path}/rows")
