"""Queries of the scalar functions over the market views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as col
from .registry import query


@query(
    "c1_parse_option_ticker",
    """select option_ticker, case when pk % 10 <> 3 then underlying end as underlying, case when pk % 10 <> 3 then expiry end as expiry, case
    when pk % 10 <> 3 then strike end as strike, case when pk % 10 <> 3 then option_right end as option_right from option_contract""",
)
def _(m):
    # Lower case with blanks must still parse; a cut ticker must not.
    raw = F.when(F.col("pk") % 10 == 3, F.substring("option_ticker", 1, 12)).when(F.col("pk") % 2 == 0, F.concat(F.lit(" "), F.lower("option_ticker"))).otherwise(F.col("option_ticker"))
    return m.option_contract.select("option_ticker", col.parse_option_ticker(raw).alias("p")).select("option_ticker", "p.underlying", "p.expiry", "p.strike", "p.option_right")


@query(
    "c2_parse_option_right",
    """select option_ticker, case pk % 3 when 0 then option_right when 1 then option_right end as r, pk % 3 < 2 and option_right = 'P' as put,
    pk % 3 < 2 and option_right = 'C' as call from option_contract""",
)
def _(m):
    long = F.when(F.col("option_right") == "C", " call").otherwise("Put ")
    raw = F.when(F.col("pk") % 3 == 0, F.lower("option_right")).when(F.col("pk") % 3 == 1, long).otherwise("x")
    return m.option_contract.select("option_ticker", col.parse_option_right(raw).alias("r"), col.is_put(raw).alias("put"), col.is_call(raw).alias("call"))


@query("c3_epoch_to_date", "select event_id, cast(ts as date) as day, epoch_us(ts) // 1000 as ms, epoch_us(ts) as us from events")
def _(m):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ms, ns = F.floor(us / 1000), us * 1000
    return m.events.select("event_id", col.epoch_ms_to_date(ms).alias("day"), F.unix_millis(col.epoch_ms_to_ts(ms)).alias("ms"), F.unix_micros(col.epoch_ns_to_ts(ns)).alias("us"))


@query(
    "c5_snapshot_ts_auto",
    """select event_id, case when event_id % 3 < 2 then epoch_us(ts) // 1000 * 1000 else epoch_us(timezone('America/New_York', date_trunc('day',
    timezone('America/New_York', timezone('UTC', ts))) + interval 16 hour)) end as us from events""",
)
def _(m):
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    trade, day = F.when(F.col("event_id") % 3 == 0, ms * 1000000), F.when(F.col("event_id") % 3 == 1, ms)
    return m.events.select("event_id", F.unix_micros(col.snapshot_ts_auto(trade, day, F.col("ts").cast("timestamp"))).alias("us"))


@query(
    "c6_daily_anchor",
    """select distinct epoch_us(snapshot_ts) as t, epoch_us(timezone('America/New_York', cast(ny_date as timestamp) + interval 16 hour)) as anchor
    from option_snapshot""",
)
def _(m):
    return m.option_snapshot.select(F.unix_micros("snapshot_ts").alias("t"), F.unix_micros(col.daily_anchor(F.col("snapshot_ts"))).alias("anchor")).distinct()


@query("c7_ny_date", "select distinct epoch_us(snapshot_ts) as t, ny_date from option_snapshot")
def _(m):
    return m.option_snapshot.select(F.unix_micros("snapshot_ts").alias("t"), col.ny_date(F.col("snapshot_ts")).alias("ny_date")).distinct()


@query(
    "c8_periods",
    """select event_id, case event_id % 4 when 0 then '1 minute' when 1 then '5 minute' when 2 then '1 hour' else '7 weeks' end as period,
    cast(event_id % 5 + 1 as varchar) || ' minute' as label from events""",
)
def _(m):
    raw = F.element_at(F.array(*map(F.lit, ("1 min", " 5 mins", "1 Hours", "7 weeks"))), (F.col("event_id") % 4 + 1).cast("int"))
    return m.events.select("event_id", col.normalize_period(raw).alias("period"), col.period_label(F.col("event_id") % 5 + 1, F.lit("Minute")).alias("label"))


@query(
    "c9_parse_date",
    """select o_orderkey, case when o_orderkey % 9 = 4 then null else cast(o_orderdate as date) end as d, cast(o_orderdate as date) as e from orders""",
)
def _(m):
    iso = F.when(F.col("o_orderkey") % 9 == 4, "2001-02-30").otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:00:00Z")))
    short = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return m.orders.select("o_orderkey", col.parse_date(iso).alias("d"), col.normalize_expiry(short).alias("e"))


@query(
    "c10_numbers",
    """select o_orderkey, case when o_orderkey % 8 = 1 then null else o_totalprice end as f, case
    when o_orderkey % 2 = 0 then cast(trunc(o_totalprice) as bigint) end as i from orders""",
)
def _(m):
    text = F.when(F.col("o_orderkey") % 8 == 1, "").otherwise(F.col("o_totalprice").cast("string"))
    return m.orders.select("o_orderkey", col.as_float(text).alias("f"), F.when(F.col("o_orderkey") % 2 == 0, col.as_int(F.col("o_totalprice"))).alias("i"))


@query("c11_parse_timestamptz", "select event_id, case when event_id % 6 = 5 then null else epoch_us(date_trunc('second', ts)) end as us from events")
def _(m):
    ts = F.col("ts").cast("timestamp")
    text = F.when(F.col("event_id") % 6 == 5, "soon").when(F.col("event_id") % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 3 == 1, F.concat(F.date_format(ts + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    return m.events.select("event_id", F.unix_micros(col.parse_timestamptz(text)).alias("us"))


@query("c12_symbols", "select symbol, symbol || ',' || 'SPY' as listed from ticker")
def _(m):
    raw = F.concat(F.lit(" "), F.lower("symbol"), F.lit(" ,spy,, SPY,"), F.col("symbol"))
    return m.ticker.select(col.normalize_symbol(F.concat(F.lit("  "), F.lower("symbol"))).alias("symbol"), F.concat_ws(",", col.parse_symbol_list(raw)).alias("listed"))


@query(
    "c14_contract_keys",
    """select option_ticker, underlying || '|OPT|' || strftime(expiry, '%Y%m%d') || '|' || cast(strike as varchar) || '|' || option_right as key,
    pk % 5 <> 2 as parsed from option_contract""",
)
def _(m):
    c = m.option_contract
    key = col.build_contract_key(F.lower("underlying"), F.col("expiry"), F.col("strike"), F.col("option_right"))
    p = col.parse_contract_key(F.when(F.col("pk") % 5 == 2, F.replace(key, F.lit("OPT"), F.lit("STK"))).otherwise(key))
    same = (p["underlying"] == F.col("underlying")) & (p["expiry"] == F.col("expiry")) & (p["strike"] == F.col("strike")) & (p["option_right"] == F.col("option_right"))
    return c.select("option_ticker", key.alias("key"), F.coalesce(same, F.lit(False)).alias("parsed"))


@query("c16_contract_identity", "select underlying, expiry, strike, option_right, true as vendor, count(*) as n from option_contract group by all")
def _(m):
    a = col.parse_option_ticker(F.col("option_ticker"))
    rows = m.option_contract.select(col.contract_identity(a["underlying"], a["expiry"], a["strike"], a["option_right"]).alias("i"), col.is_vendor_ticker(F.col("option_ticker")).alias("vendor"))
    return rows.groupBy("i", "vendor").agg(F.count("*").alias("n")).select("i.*", "vendor", "n")


@query(
    "c17_stream_contract_key",
    """select option_ticker, underlying || '|OPT|' || strftime(expiry,
    '%Y%m%d') || '|' || cast(cast(strike as int) as varchar) || '|' || option_right as key from option_contract""",
)
def _(m):
    return m.option_contract.select("option_ticker", col.stream_contract_key(F.col("option_ticker")).alias("key"))


@query(
    "c18_safe_ratio",
    """select o_orderkey, case when o_orderkey % 5 > 0 then round(cast(o_custkey as double) / (o_orderkey % 5), 6) end as r6, case
    when o_orderkey % 5 > 0 then round(cast(o_custkey as double) / (o_orderkey % 5), 3) end as r3 from orders""",
)
def _(m):
    d = F.col("o_orderkey") % 5
    return m.orders.select("o_orderkey", col.safe_ratio(F.col("o_custkey"), d).alias("r6"), col.safe_ratio(F.col("o_custkey"), d, 3).alias("r3"))


@query("c19_valid_iv", "select option_ticker, epoch_us(snapshot_ts) as t, case when iv * 50 > 0 and iv * 50 < 10 then iv * 50 end as iv from option_snapshot")
def _(m):
    return m.option_snapshot.select("option_ticker", F.unix_micros("snapshot_ts").alias("t"), col.valid_iv(F.col("iv") * 50).alias("iv"))


@query("c21_payload_hash", """select option_ticker, left(sha256('{"right":"' || option_right || '","underlying":"' || underlying || '"}'), 16) as h from option_contract""")
def _(m):
    return m.option_contract.select("option_ticker", col.payload_hash(F.col("option_right").alias("right"), F.col("underlying")).alias("h"))


@query(
    "c22_json_fields",
    """select symbol, report_type, period_date, period_type, cast(json_extract_string(data, '$.avg_daily_volume') as bigint) as v,
    cast(json_extract_string(data, '$.short_interest') as double) as d, coalesce(json_extract_string(data, '$.revenue'), '') <> '' as has
    from stock_financials""",
)
def _(m):
    d = F.col("data")
    return m.stock_financials.select("symbol", "report_type", "period_date", "period_type", col.json_bigint(d, "none", "avg_daily_volume").alias("v"), col.json_double(d, "short_interest").alias("d"), col.json_has_value(d, "revenue").alias("has"))


@query("c24_stable_symbol_id", "select count(distinct symbol) as symbols, count(distinct symbol) as ids, true as same from ticker")
def _(m):
    ids = m.ticker.select("symbol", col.stable_symbol_id(F.col("symbol")).alias("a"), col.stable_symbol_id(F.concat(F.lower("symbol"), F.lit(" "))).alias("b"))
    return ids.agg(F.count_distinct("symbol").alias("symbols"), F.count_distinct("a").alias("ids"), F.bool_and(F.col("a") == F.col("b")).alias("same"))


@query("c25_epoch_iso", "select event_id, epoch_us(ts) / 1e6 as t, strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso, strftime(ts, '%Y-%m-%d') as day from events")
def _(m):
    return m.events.select("event_id", col.epoch_seconds(F.col("ts")).alias("t"), col.iso_format(F.col("ts"), "timestamp").alias("iso"), col.iso_format(F.col("ts"), "date").alias("day"))
