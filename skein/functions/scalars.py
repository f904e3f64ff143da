"""Scalar column functions (JVM-side built-ins only, so they stay in codegen).

Each function returns a `Column`; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColOrName = Column | str

# Fixed values (must equal the reference's):
# script letter ranges used by the language tests
SCRIPT_RANGES = {
    "arabic": "\u0600-\u06FF",
    "hebrew": "\u0590-\u05FF",
    "english": "a-zA-Z",
}
# hour offset of the activity statistics (fixed UTC+3)
HOUR_SHIFT = 3
# vendor symbol map of the CSV bar import
VENDOR_SYMBOLS = {
    "CURRENCY:BTCUSD": "BTC-USD",
    "CURRENCY:ETHUSD": "ETH-USD",
    "CURRENCY:USDARS": "ARS=X",
    "CURRENCY:USDCNY": "CNY=X",
    "CURRENCY:USDEUR": "EUR=X",
    "CURRENCY:USDILS": "ILS=X",
    "CURRENCY:USDJPY": "JPY=X",
    "CURRENCY:USDVES": "VES=X",
    "GCW00": "GC=F",
    "TLV:137": "^TA125.TA",
}
# interval names of the CSV import and the download lookback per interval (days)
INTERVAL_CODES = {"DAILY": "1d"}
INTERVAL_LOOKBACK_DAYS = {"1m": 7, "2m": 60, "5m": 60, "15m": 60, "30m": 60, "90m": 60, "1h": 730, "1d": 365 * 98}
# symbol suffixes that shift the polling lookback by three hours each
LOOKBACK_SUFFIXES = (".TA", "=X", "-USD")
# message prompt line and its fallbacks
MESSAGE_TEMPLATE = ('<message id="%s" sender="%s" responds_to_sender="%s" '
                    'responds_to_message_id="%s">%s</msg>')
NO_CONTENT = "Message has no content (possibly media?)"
UNKNOWN_SENDER = "UNKNOWN"
NONE_TEXT = "None"
# typographic quotes replaced by straight ones
QUOTE_MAP = {"“": '"', "”": '"', "‘": "'"}
# chat / media type codes
CHAT_TYPE_CODES = {"channel": 1, "group": 2, "supergroup": 3, "private": 4, "bot": 5}
MEDIA_TYPE_CODES = {"audio": 1, "document": 2, "photo": 3, "sticker": 4, "video": 5, "animation": 6,
                    "voice": 7, "video_note": 8, "contact": 9, "location": 10, "venue": 11, "poll": 12,
                    "web_page": 13, "dice": 14, "game": 15}


def _c(c: ColOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F01 / F02 ---------------------------------------------------------------

def has_script(c: ColOrName, script: str) -> Column:
    """Regex test for any letter of the script; null in, null out."""
    return _c(c).rlike(f"[{SCRIPT_RANGES[script]}]")


def script_pct(c: ColOrName, script: str) -> Column:
    """Share of the script's letters in the text; null or empty text -> 0."""
    x = _c(c)
    kept = F.length(F.regexp_replace(x, f"[^{SCRIPT_RANGES[script]}]", ""))
    return F.coalesce(F.try_divide(kept.cast("double"), F.length(x).cast("double")), F.lit(0.0))


# F03 / F04 / F05 -----------------------------------------------------------

def hour_shift(ts: ColOrName) -> Column:
    return (F.hour(_c(ts)) + HOUR_SHIFT) % 24


def mid_price(open_: ColOrName, close: ColOrName) -> Column:
    o, c = _c(open_), _c(close)
    return (F.coalesce(o, c) + F.coalesce(c, o)) / 2


def full_name(first: ColOrName, last: ColOrName) -> Column:
    """first || coalesce(' ' || last, ''): null first gives null."""
    return F.concat(_c(first), F.coalesce(F.concat(F.lit(" "), _c(last)), F.lit("")))


def prompt_name(first: ColOrName, last: ColOrName, fallback: str = UNKNOWN_SENDER) -> Column:
    """Prompt variant: empty last name omitted, no sender -> fallback."""
    f, l_ = _c(first), _c(last)
    name = F.when(F.coalesce(l_, F.lit("")) != "", F.concat(f, F.lit(" "), l_)).otherwise(f)
    return F.when(f.isNull(), F.lit(fallback)).otherwise(name)


# F06 / F07 -----------------------------------------------------------------

def yyyymm(ts: ColOrName) -> Column:
    return F.year(_c(ts)) * 100 + F.month(_c(ts))


def date_parts(ts: ColOrName) -> list[Column]:
    t = _c(ts)
    return [yyyymm(t).alias("yyyymm"), F.dayofmonth(t).alias("day"), F.hour(t).alias("hour"),
            F.minute(t).alias("minute"), F.second(t).alias("second")]


def from_date_parts(yyyymm_: ColOrName, day: ColOrName, hour: ColOrName, minute: ColOrName,
                    second: ColOrName) -> Column:
    ym = _c(yyyymm_)
    return F.make_timestamp_ntz(F.floor(ym / 100).cast("int"), (ym % 100).cast("int"), _c(day),
                                _c(hour), _c(minute), _c(second).cast("decimal(16,6)"))


# F09 / F10 / F11 -----------------------------------------------------------

def canonical_symbol(c: ColOrName) -> Column:
    """Vendor map, then `TLV:n` -> `n.TA`; other symbols unchanged."""
    x = _c(c)
    mapped = F.coalesce(F.create_map(*[F.lit(v) for kv in VENDOR_SYMBOLS.items() for v in kv])[x], x)
    return F.when(mapped.startswith("TLV:"), F.concat(F.split(mapped, ":").getItem(1), F.lit(".TA"))
                  ).otherwise(mapped)


def symbol_is_valid(c: ColOrName) -> Column:
    return ~_c(c).contains(":")


def interval_code(c: ColOrName) -> Column:
    """`DAILY` -> `1d`; unknown names give null (the reference raises)."""
    return F.create_map(*[F.lit(v) for kv in INTERVAL_CODES.items() for v in kv])[_c(c)]


def interval_lookback_days(c: ColOrName) -> Column:
    return F.create_map(*[F.lit(v) for kv in INTERVAL_LOOKBACK_DAYS.items() for v in kv])[_c(c)]


def symbol_lookback(symbol: ColOrName, now: ColOrName) -> Column:
    """now - 60 days + 1 minute, plus 3 hours for each listed suffix contained."""
    s = _c(symbol)
    hours = sum((F.when(s.contains(x), 3).otherwise(0) for x in LOOKBACK_SUFFIXES), F.lit(0))
    return (_c(now) - F.make_dt_interval(F.lit(60)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
            + F.make_dt_interval(F.lit(0), hours))


# F12 -----------------------------------------------------------------------

def pretty_duration(seconds: ColOrName) -> Column:
    """Seconds as "1w, 2d, 3h, 4m, 5.00s"; leading zero units are left out."""
    s = _c(seconds).cast("double")
    w = F.floor(s / 604800)
    r1 = s - w * 604800
    d = F.floor(r1 / 86400)
    r2 = r1 - d * 86400
    h = F.floor(r2 / 3600)
    r3 = r2 - h * 3600
    m = F.floor(r3 / 60)
    r4 = r3 - m * 60
    show_w = w > 0
    show_d = show_w | (d > 0)
    show_h = show_d | (h > 0)
    show_m = show_h | (m > 0)
    part = lambda cond, v, unit: F.when(cond, F.concat(v.cast("string"), F.lit(unit + ", "))).otherwise(F.lit(""))
    return F.concat(part(show_w, w, "w"), part(show_d, d, "d"), part(show_h, h, "h"), part(show_m, m, "m"),
                    F.format_string("%.2fs", r4))


# F13 / F14 / F15 / F16 / F17 ------------------------------------------------

def message_template(message_id: ColOrName, sender_name: ColOrName, reply_sender: ColOrName,
                     reply_id: ColOrName, text: ColOrName) -> Column:
    t = _c(text)
    return F.format_string(
        MESSAGE_TEMPLATE, _c(message_id).cast("string"), _c(sender_name),
        F.coalesce(_c(reply_sender), F.lit(NONE_TEXT)),
        F.coalesce(_c(reply_id).cast("string"), F.lit(NONE_TEXT)),
        F.when(F.coalesce(t, F.lit("")) == "", F.lit(NO_CONTENT)).otherwise(t))


def _stripped(resp: ColOrName) -> Column:
    return F.btrim(_c(resp), F.lit(" \t\n\r\x0b\x0c"))


def _find(s: Column, what: str, start: Column | None = None) -> Column:
    """0-based place of the first `what` from `start` on, -1 if there is none."""
    return F.call_function("locate", F.lit(what), s, F.lit(1) if start is None else start + 1) - 1


def _cut(s: Column, start: Column, end: Column) -> Column:
    """Characters `start .. end`; a negative end counts from the back."""
    end = F.when(end < 0, F.length(s) + end).otherwise(end)
    return F.substring(s, start + 1, F.greatest(end - start, F.lit(0)))


def tagged_summary(resp: ColOrName) -> Column:
    """What stands between the first `<SUMMARY>` and the first `</SUMMARY>`; null if either is missing."""
    r = _stripped(resp)
    start, end = _find(r, "<SUMMARY>"), _find(r, "</SUMMARY>")
    return F.when((start >= 0) & (end >= 0), _cut(r, start + len("<SUMMARY>"), end))


def _tag(r: Column) -> tuple[Column, Column, Column]:
    """Place of `<MSG`, of the attributes behind it, and of the `>` that ends them."""
    start = _find(r, "<MSG")
    return start, start + len("<MSG"), _find(r, ">", start + len("<MSG"))


def tagged_message(resp: ColOrName) -> Column:
    """What follows the first `<MSG ..>` up to the first `</MSG>`; without the closing tag, up to the
    last character (which is left out, as in the reference)."""
    r = _stripped(resp)
    start, _, end = _tag(r)
    return F.when(start >= 0, _cut(r, end + 1, _find(r, "</MSG>")))


def tagged_reply_to(resp: ColOrName) -> Column:
    """The quoted ID of the first `<MSG ..>`; null if it is none or no number."""
    r = _stripped(resp)
    start, attributes, end = _tag(r)
    tags = F.when(start >= 0, _cut(r, attributes, end))
    return F.nullif(F.regexp_extract(tags, "ID='([^']*)", 1), F.lit("")).try_cast("bigint")


RESPONSE_SCHEMA = "should_participate boolean, response_text string, reply_to_message_id bigint"


def json_response(resp: ColOrName) -> Column:
    """Struct (text, reply_to) of a JSON answer; malformed or not participating -> nulls."""
    p = F.from_json(_c(resp), RESPONSE_SCHEMA, {"mode": "PERMISSIVE"})
    ok = F.coalesce(p.getField("should_participate"), F.lit(False))
    return F.struct(F.when(ok, p.getField("response_text")).alias("response_text"),
                    F.when(ok, p.getField("reply_to_message_id")).alias("reply_to_message_id"))


def search_params(text: ColOrName) -> Column:
    """`key value;;;key value` -> map; blank entries dropped, of a repeated key the last value counts."""
    parts = F.filter(F.transform(F.split(_c(text), ";;;"), lambda x: F.trim(x)), lambda x: x != "")
    # a part without a space has no value: the reference fails on it; we keep key -> null
    pairs = F.transform(parts, lambda x: F.struct(
        F.split(x, " ", 2).getItem(0).alias("key"), F.try_element_at(F.split(x, " ", 2), F.lit(2)).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def clean_quotes(c: ColOrName) -> Column:
    return F.translate(_c(c), "".join(QUOTE_MAP), "".join(QUOTE_MAP.values()))


# F18 / F19 -----------------------------------------------------------------

REACTION_LIST_SCHEMA = "array<struct<emoji:string,custom_emoji_id:bigint,count:int>>"


def json_reaction_list(c: ColOrName) -> Column:
    return F.from_json(_c(c), REACTION_LIST_SCHEMA)


def na_to_null(c: ColOrName, token: str = "#N/A") -> Column:
    return F.nullif(_c(c), F.lit(token))


def nan_to_null(c: ColOrName) -> Column:
    x = _c(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


# P08 / P09 / P12 ------------------------------------------------------------

def presence_flags(cols: dict[str, ColOrName]) -> list[Column]:
    return [_c(v).isNotNull().alias(k) for k, v in cols.items()]


def language_pct(count: ColOrName, sample: ColOrName) -> Column:
    s = _c(sample)
    return F.when(s > 0, _c(count).cast("double") / s.cast("double")).otherwise(F.lit(0.0))


def type_code(c: ColOrName, codes: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(v) for kv in codes.items() for v in kv])[_c(c)]


def round4(c: ColOrName) -> Column:
    """Comparison rounding shared with the oracle: round(x + 1e-9, 4)."""
    return F.round(_c(c).cast("double") + F.lit(1e-9), 4)
