"""Queries over the live feed: the events table read as a stream of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import new_folder
from ..streaming import feed
from .registry import query

#: Files that a micro-batch takes at most.
FILES = 64
EV = {"click": "Q", "view": "AM", "purchase": "T", "error": "status"}


def messages(events: DataFrame) -> DataFrame:
    """Raw messages of events: JSON objects, every second one in an array, some broken; some arrays hold elements that are no objects, some numbers are text.

    Signups have no kind.
    """
    ev = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in EV.items() for x in kv]), F.col("event_type")), F.lit(None).cast("string"))
    sym = F.concat(F.lit("O:U"), F.translate((F.col("user_id") % 20).cast("string"), "0123456789", "ABCDEFGHIJ"), F.lit("040116"), F.when(F.col("user_id") % 2 == 0, "C").otherwise("P"), F.lpad((F.col("user_id") % 7 * 2500 + 100000).cast("string"), 8, "0"))
    t = (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    v = F.col("value")
    body = F.to_json(F.struct(ev.alias("ev"), sym.alias("sym"), t.alias("t"), v.alias("bp"), (v + 0.25).alias("ap"), v.alias("p"), F.when(ev == "T", F.col("event_id") % 9).alias("s"), v.alias("o"), v.alias("h"), v.alias("l"), v.alias("c"), F.lit(10.0).alias("v")))
    odd = F.regexp_replace(F.regexp_replace(body, r'"(bp|p|c)":([0-9.E-]+)', '"$1":"$2"'), r'"t":([0-9]+)', '"t":$1.0')
    text = F.when(F.col("event_id") % 50 == 7, F.substring(body, 1, 20)).when(F.col("event_id") % 6 == 0, F.concat(F.lit('[7,"x",null,'), odd, F.lit(',{"ev":""},[1]]')))
    text = text.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    return events.select("event_id", text.alias("value"))


SQL = """e as (
    select event_id, case event_type when 'click' then 'Q' when 'view' then 'AM' when 'purchase' then 'T' when 'error' then 'status' end as ev,
        epoch_us(ts) // 1000 as t, value, user_id,
        'U' || translate(cast(user_id % 20 as varchar), '0123456789', 'ABCDEFGHIJ') as symbol, 100 + (user_id % 7) * 2.5 as strike from events
), f as (
    select event_id, symbol || '|OPT|20040116|' || case when strike = floor(strike) then cast(cast(strike as int) as varchar)
        else cast(cast(strike as decimal(8, 1)) as varchar) end || '|' || case when user_id % 2 = 0 then 'C' else 'P' end as contract_key, symbol, ev, t,
        value
    from e where ev is not null and event_id % 50 <> 7
)"""


def _feed(m) -> DataFrame:
    return feed.normalized(feed.decoded(messages(m.events)))


def _stream(m) -> DataFrame:
    """The same feed as a stream over the table's files."""
    source = m.spark.readStream.schema(m.events.schema).option("maxFilesPerTrigger", FILES).parquet(f"{m.dir}/events.parque[t]")
    return feed.normalized(feed.decoded(messages(source)))


@query("k1_decode_stream", f"with {SQL} select event_id, ev, t from f")
def _(m):
    return feed.decoded(messages(m.events)).select("event_id", "ev", "t")


@query(
    "k2_normalize_event",
    f"""with {SQL} select event_id, contract_key, ev, t, case when ev = 'Q' then value end as bid, case when ev = 'T' then value end as last,
    case when ev = 'T' then event_id % 9 end as size, case when ev = 'AM' then value end as close from f""",
)
def _(m):
    return _feed(m).select("event_id", "contract_key", "ev", "t", "bid", "last", "size", "close")


@query(
    "k3_latest_quote_state",
    f"""with {SQL} select contract_key, max(t) as t, arg_max(event_id, (t, event_id)) as event_id, arg_max(ev, (t, event_id)) as ev from f
    group by contract_key""",
)
def _(m):
    latest = feed.latest_quotes(_stream(m).select("contract_key", "t", "event_id", "ev"), ["t", "event_id"])
    return feed.run_to_files(latest, "quotes", "complete")


@query("k4_event_log_sink", f"with {SQL} select contract_key, ev, t, event_id from f")
def _(m):
    return feed.run_to_files(_stream(m).select("contract_key", "ev", "t", "event_id"), "log", "append")


@query(
    "k3_latest_quote_ttl",
    f"with {SQL} select contract_key, max(event_id) as seq, arg_max(t, event_id) as t, arg_max(ev, event_id) as ev, false as expired from f where t is not null group by contract_key",
)
def _(m):
    """The state that forgets by arrival; nothing expires while the stream only catches up."""
    held = feed.run_to_files(feed.latest_quotes_with_ttl(_stream(m)), "ttl", "update")
    return held.groupBy("contract_key").agg(F.max("seq").alias("seq"), *(F.max_by(c, "seq").alias(c) for c in ("t", "ev", "expired")))


@query("k4_event_log_trimmed", f"with {SQL} select contract_key, ev, t, event_id from f order by t desc nulls last, event_id desc limit 10000")
def _(m):
    log = feed.run_to_files(_stream(m).select("contract_key", "ev", "t", "event_id"), "log", "append")
    return feed.newest_kept(log, feed.LOG_LENGTH)


@query(
    "k4_event_log_retained",
    f"""with {SQL}, b as (select *, coalesce(t // {feed.BUCKET_MS}, -1) as bucket from f), n as (select bucket, count(*) as n from b group by bucket),
    kept as (select bucket from (select bucket, coalesce(sum(n) over (order by bucket desc rows between unbounded preceding and 1 preceding), 0) as newer from n) x where newer < 1000)
    select contract_key, ev, t, event_id from b where bucket in (select bucket from kept)""",
)
def _(m):
    """Old buckets of the log are gone from the disk, not only from what is read."""
    return feed.run_to_bounded_log(_stream(m).select("contract_key", "ev", "t", "event_id"), new_folder(m.spark, "log"), keep=1000)


@query("k5_stream_health", f"with {SQL} select count(*) as messages, max(t) as last_t, (1706659200000 - max(t)) / 1000 > 120 as stale from f")
def _(m):
    return feed.run_to_files(feed.health(_stream(m), F.lit(1706659200000)), "health", "complete")


@query("k5_stream_health_observed", f"with {SQL} select count(*) as messages, max(t) as last_t, (1706659200000 - max(t)) / 1000 > 120 as stale from f")
def _(m):
    """From the metrics of the stream that writes the log."""
    watch = feed.StreamHealth()
    m.spark.streams.addListener(watch)
    try:
        feed.run_to_files(feed.observed(_stream(m).select("contract_key", "ev", "t")), "log", "append")
        watch.ended.wait(60)  # progress is reported a moment later
    finally:
        m.spark.streams.removeListener(watch)
    return watch.row(m.spark, 1706659200000)


@query(
    "k5_stream_health_metrics",
    f"""with {SQL} select count(*) as messages, max(t) as last_t, (epoch_ms(timestamp '2024-01-31 00:00:00') - max(t)) / 1000 > 120 as stale from f""",
)
def _(m):
    return feed.health(_feed(m), F.lit(1706659200000))


@query(
    "k6_watchlist_stream_filter",
    f"""with {SQL} select event_id, contract_key from f where symbol in (select symbol from ticker where instrument_type = 'cs')""",
)
def _(m):
    return feed.watched(_feed(m), m.ticker.where("instrument_type = 'cs'")).select("event_id", "contract_key")


@query(
    "k6_watchlist_on_stream",
    f"""with {SQL} select event_id, contract_key from f where event_id % 2 = 0 and symbol in (select symbol from ticker where instrument_type = 'cs')
    union all select event_id, contract_key from f where event_id % 2 = 1 and symbol in (select symbol from ticker where market = 'stocks')""",
)
def _(m):
    """The feed arrives in two parts, and the list changes in between."""
    path, arrived = new_folder(m.spark, "watched"), new_folder(m.spark, "arrived")
    listed = [m.ticker.where("instrument_type = 'cs'"), m.ticker.where("market = 'stocks'")]
    for part, symbols in enumerate(listed):
        messages(m.events.where(F.col("event_id") % 2 == part)).write.mode("append").parquet(arrived)
        source = m.spark.readStream.schema("event_id long, value string").option("maxFilesPerTrigger", FILES).parquet(arrived)
        feed.run_watched(feed.normalized(feed.decoded(source)), lambda symbols=symbols: symbols, path)
    return m.spark.read.parquet(f"{path}/rows").select("event_id", "contract_key")


@query(
    "k6_subscription_diff",
    """select symbol, 'add' as action from ticker where instrument_type = 'cs' and market <> 'stocks' union all select symbol, 'remove' from ticker
    where market = 'stocks' and instrument_type is distinct from 'cs'""",
)
def _(m):
    return feed.subscription_diff(m.ticker.where("market = 'stocks'"), m.ticker.where("instrument_type = 'cs'"))


@query("l9_last_trade", f"with {SQL} select contract_key, max(t) as t, arg_max(value, (t, event_id)) as last from f where ev = 'T' group by contract_key")
def _(m):
    return feed.latest_quotes(_feed(m).where("ev = 'T'").select("contract_key", "t", "event_id", "last"), ["t", "event_id"]).select("contract_key", "t", "last")


@query("l9_quotes", f"with {SQL} select contract_key, t, value as bid, value + 0.25 as ask from f where ev = 'Q' and t between 1704500000000 and 1705500000000")
def _(m):
    return feed.ticks(_feed(m), "Q", 1704500000000, 1705500000000).select("contract_key", "t", "bid", "ask")


@query("l9_trades", f"with {SQL} select contract_key, t, value as last from f where ev = 'T' and t between 1704500000000 and 1705500000000")
def _(m):
    return feed.ticks(_feed(m), "T", 1704500000000, 1705500000000).select("contract_key", "t", "last")
