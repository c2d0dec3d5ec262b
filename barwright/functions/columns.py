"""Scalar functions on columns: tickers, times, numbers, keys. Unparsable input gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"
_TICKER = r"^O:([A-Z.\-]+)(\d{2})(\d{2})(\d{2})([CP])(\d{8})$"
#: Bar periods as callers write them, and as they are stored.
PERIODS = {
    "1 min": "1 minute", "1 mins": "1 minute", "2 mins": "2 minute", "3 mins": "3 minute", "5 min": "5 minute", "5 mins": "5 minute", "10 mins": "10 minute", "15 min": "15 minute",
    "15 mins": "15 minute", "30 min": "30 minute", "30 mins": "30 minute", "1 hour": "1 hour", "1 hours": "1 hour", "2 hours": "2 hour", "4 hours": "4 hour", "1 d": "1 day", "1 day": "1 day",
}


def normalize_symbol(c: Column) -> Column:
    return F.upper(F.trim(c))


def parse_symbol_list(c: Column) -> Column:
    """Ordered distinct symbols of a comma list."""
    return F.array_distinct(F.filter(F.transform(F.split(c, ","), normalize_symbol), lambda x: x != ""))


def parse_option_ticker(c: Column) -> Column:
    """Struct (underlying, expiry, strike, option_right) of an OCC ticker; null if it is malformed or its date does not exist."""
    t = normalize_symbol(c)
    part = lambda i: F.regexp_extract(t, _TICKER, i)
    year = F.try_to_number(part(2), F.lit("99")).cast("int")
    expiry = F.to_date(F.try_to_timestamp(F.concat(F.when(year < 70, "20").otherwise("19"), part(2), part(3), part(4)), F.lit("yyyyMMdd")))
    parsed = F.struct(part(1).alias("underlying"), expiry.alias("expiry"), (part(6).try_cast("double") / 1000).alias("strike"), part(5).alias("option_right"))
    return F.when(t.rlike(_TICKER) & expiry.isNotNull(), parsed)


def parse_option_right(c: Column) -> Column:
    t = normalize_symbol(c)
    return F.when(t.isin("C", "CALL"), "C").when(t.isin("P", "PUT"), "P")


def is_put(c: Column) -> Column:
    return F.coalesce(parse_option_right(c) == "P", F.lit(False))


def is_call(c: Column) -> Column:
    return F.coalesce(parse_option_right(c) == "C", F.lit(False))


def epoch_ms_to_ts(c: Column) -> Column:
    return F.timestamp_millis(c.try_cast("bigint"))


def epoch_ms_to_date(c: Column) -> Column:
    """UTC date of epoch milliseconds (session time zone UTC)."""
    return F.to_date(epoch_ms_to_ts(c))


def epoch_ns_to_ts(c: Column) -> Column:
    return F.timestamp_micros(F.floor(c.try_cast("decimal(20,0)") / 1000).cast("bigint"))


def snapshot_ts_auto(trade: Column, day: Column, otherwise: Column) -> Column:
    """First given epoch number, in nanoseconds if over 1e13 and else in milliseconds; otherwise the day's anchor."""
    v = F.coalesce(trade, day)
    return F.coalesce(F.when(v > 1e13, epoch_ns_to_ts(v)).otherwise(epoch_ms_to_ts(v)), daily_anchor(otherwise))


def ny_date(ts: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, NEW_YORK))


def daily_anchor(ts: Column) -> Column:
    """16:00 in New York on the New York date of an instant."""
    return F.to_utc_timestamp(F.date_trunc("day", F.from_utc_timestamp(ts, NEW_YORK)) + F.expr("interval 16 hours"), NEW_YORK)


def period_label(multiplier: Column, timespan: Column) -> Column:
    return F.concat_ws(" ", multiplier.cast("string"), F.lower(timespan))


def normalize_period(c: Column) -> Column:
    """Stored label of a period; an unknown one passes through."""
    label = F.create_map(*[F.lit(x) for kv in PERIODS.items() for x in kv])
    return F.coalesce(F.element_at(label, F.lower(F.trim(c))), c)


def parse_date(c: Column) -> Column:
    """Date of the first ten characters, null if they are none."""
    return F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")))


def normalize_expiry(c: Column) -> Column:
    t = F.trim(c)
    return F.coalesce(F.to_date(F.try_to_timestamp(t, F.lit("yyyyMMdd"))), parse_date(t))


def as_float(c: Column) -> Column:
    return c.try_cast("double")


def as_int(c: Column) -> Column:
    """Integer of a number (truncated) or of text that is one."""
    return c.try_cast("bigint")


def parse_timestamptz(c: Column) -> Column:
    """Instant of ISO text; without an offset it is UTC (session time zone UTC)."""
    return F.try_to_timestamp(c)


def _strike_text(strike: Column) -> Column:
    """Shortest decimal with at least one place, never in exponent form."""
    fixed = F.regexp_replace(F.format_string("%.8f", strike), r"0+$", "")
    return F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)


def build_contract_key(symbol: Column, expiry: Column, strike: Column, right: Column) -> Column:
    return F.concat_ws("|", normalize_symbol(symbol), F.lit("OPT"), F.date_format(expiry, "yyyyMMdd"), _strike_text(strike), parse_option_right(right))


def parse_contract_key(c: Column) -> Column:
    """Struct (underlying, expiry, strike, option_right) of a contract key; null if it is malformed."""
    p = F.split(F.trim(c), r"\|")
    at = lambda i: F.get(p, F.lit(i))
    expiry, strike, right = normalize_expiry(at(2)), F.round(at(3).try_cast("double"), 8), parse_option_right(at(4))
    good = (F.size(p) == 5) & (F.upper(at(1)) == "OPT") & (F.trim(at(0)) != "") & expiry.isNotNull() & strike.isNotNull() & right.isNotNull()
    return F.when(good, F.struct(normalize_symbol(at(0)).alias("underlying"), expiry.alias("expiry"), strike.alias("strike"), right.alias("option_right")))


def is_vendor_ticker(c: Column) -> Column:
    return normalize_symbol(c).startswith("O:")


def contract_identity(underlying: Column, expiry: Column, strike: Column, right: Column) -> Column:
    """Canonical identity on which contracts from any source are joined."""
    return F.struct(normalize_symbol(underlying).alias("underlying"), expiry.alias("expiry"), F.round(strike, 8).alias("strike"), parse_option_right(right).alias("option_right"))


def stream_contract_key(ticker: Column) -> Column:
    """Key of a live ticker, read from its end; any right but C is P; the strike without needless places."""
    t = F.regexp_replace(ticker, "^O:", "")
    n = F.length(t)
    root, day = F.substr(t, F.lit(1), n - 15), F.concat(F.lit("20"), F.substr(t, n - 14, F.lit(6)))
    right, strike = F.substr(t, n - 8, F.lit(1)), F.substr(t, n - 7, F.lit(8)).try_cast("bigint")
    shown = F.regexp_replace(F.format_string("%.3f", strike / 1000.0), r"\.?0+$", "")
    return F.when((n > 15) & strike.isNotNull(), F.concat_ws("|", root, F.lit("OPT"), day, shown, F.when(right == "C", "C").otherwise("P")))


def safe_ratio(top: Column, bottom: Column, places: int = 6) -> Column:
    return F.when((bottom > 0) & (top >= 0), F.round(F.try_divide(top.cast("double"), bottom.cast("double")), places))


def valid_iv(iv: Column) -> Column:
    return F.when((iv > 0) & (iv < 10), iv)


def payload_hash(*fields: Column) -> Column:
    """16 hexadecimal digits of the SHA-256 of the fields as JSON; pass them sorted by name."""
    return F.substring(F.sha2(F.to_json(F.struct(*fields)), 256), 1, 16)


def json_bigint(data: Column, *keys: str) -> Column:
    return F.coalesce(*(F.get_json_object(data, f"$.{k}").try_cast("bigint") for k in keys))


def json_double(data: Column, *keys: str) -> Column:
    return F.coalesce(*(F.get_json_object(data, f"$.{k}").try_cast("double") for k in keys))


def json_has_value(data: Column, key: str) -> Column:
    return F.nullif(F.get_json_object(data, f"$.{key}"), F.lit("")).isNotNull()


def stable_symbol_id(c: Column) -> Column:
    return F.xxhash64(normalize_symbol(c))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def iso_format(c: Column, kind: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd" if kind == "date" else "yyyy-MM-dd'T'HH:mm:ss")
