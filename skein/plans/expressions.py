"""Registered scalar-function queries (F03-F19) over columns derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from .fixtures import fixture, sql_with
from .registry import register


@register("hour_shift", sql_with(["messages"], "select chat_id, message_id, cast((hour(date) + 3) % 24 as int) as hour "
                                  "from messages"))
def q_hour_shift(spark, sf_dir):
    m = fixture(spark, sf_dir).messages
    return m.select("chat_id", "message_id", S.hour_shift("date").alias("hour"))


@register("mid_price", sql_with(["stocks"], """
select symbol, date, round((coalesce(open, close) + coalesce(close, open)) / 2 + 1e-9, 4) as price from stocks"""))
def q_mid_price(spark, sf_dir):
    s = fixture(spark, sf_dir).stocks
    return s.select("symbol", "date", S.round4(S.mid_price("open", "close")).alias("price"))


@register("full_name", sql_with(["users"], """
select sender_id, first_name || coalesce(' ' || last_name, '') as name,
  case when first_name is null then 'UNKNOWN' when coalesce(last_name, '') <> '' then first_name || ' ' || last_name
    else first_name end as prompt_name from users"""))
def q_full_name(spark, sf_dir):
    u = fixture(spark, sf_dir).users
    return u.select("sender_id", S.full_name("first_name", "last_name").alias("name"),
                    S.prompt_name("first_name", "last_name").alias("prompt_name"))


@register("date_parts", sql_with(["stocks"], """
select symbol, date, cast(year(date) * 100 + month(date) as int) as yyyymm, cast(day(date) as int) as day,
  cast(hour(date) as int) as hour, cast(minute(date) as int) as minute, cast(second(date) as int) as second,
  make_timestamp(cast(year(date) as bigint), cast(month(date) as bigint), cast(day(date) as bigint),
    cast(hour(date) as bigint), cast(minute(date) as bigint), cast(second(date) as double)) = date as roundtrip
from stocks"""))
def q_date_parts(spark, sf_dir):
    s = fixture(spark, sf_dir).stocks.select("symbol", "date", *S.date_parts("date"))
    return s.select("*", (S.from_date_parts("yyyymm", "day", "hour", "minute", "second") == F.col("date"))
                    .alias("roundtrip"))


@register("from_date_parts", sql_with(["stocks"], """
select symbol, make_timestamp(cast(year(date) as bigint), cast(month(date) as bigint), 1, 0, 0, 0.0) as month_start
from stocks"""))
def q_from_date_parts(spark, sf_dir):
    s = fixture(spark, sf_dir).stocks
    return s.select("symbol", S.from_date_parts(S.yyyymm("date"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
                    .alias("month_start"))


@register("array_build", sql_with(["messages"], """
select chat_id, message_id, [message_id] as single, list_append([message_id], reply_to_message_id) as appended,
  list_prepend(chat_id, [message_id]) as prepended, [message_id, reply_to_message_id][1] as first,
  list_contains([message_id - 1, message_id - 2], reply_to_message_id) as near_parent,
  list_position([message_id - 1, message_id - 2, message_id - 3], reply_to_message_id) as parent_pos
from messages"""))
def q_array_build(spark, sf_dir):
    m = fixture(spark, sf_dir).messages
    mid, rep = F.col("message_id"), F.col("reply_to_message_id")
    pos = F.array_position(F.array(mid - 1, mid - 2, mid - 3), rep)
    return m.select("chat_id", "message_id", F.array(mid).alias("single"),
                    F.concat(F.array(mid), F.array(rep)).alias("appended"),
                    F.concat(F.array(F.col("chat_id")), F.array(mid)).alias("prepended"),
                    F.element_at(F.array(mid, rep), 1).alias("first"),
                    F.array_contains(F.array(mid - 1, mid - 2), rep).alias("near_parent"),
                    F.when(pos > 0, pos.cast("int")).alias("parent_pos"))


VENDOR = """vendor as (select p_partkey, case when p_size % 5 = 0 then concat('TLV:', cast(p_size as varchar))
  when p_size % 5 = 1 then 'CURRENCY:USDILS' when p_size % 5 = 2 then 'GCW00' else p_brand end as raw_symbol
  from part)"""


def _vendor(f):
    p = f.table("part")
    z = F.col("p_size") % 5
    return p.select("p_partkey", F.when(z == 0, F.concat(F.lit("TLV:"), F.col("p_size").cast("string")))
                    .when(z == 1, F.lit("CURRENCY:USDILS")).when(z == 2, F.lit("GCW00"))
                    .otherwise(F.col("p_brand")).alias("raw_symbol"))


def _vendor_map_sql() -> str:
    return "case raw_symbol " + " ".join(f"when '{k}' then '{v}'" for k, v in S.VENDOR_SYMBOLS.items()) + \
        " else raw_symbol end"


@register("canonical_symbol", sql_with([], f"""
select p_partkey, case when m like 'TLV:%' then split_part(m, ':', 2) || '.TA' else m end as symbol,
  position(':' in case when m like 'TLV:%' then split_part(m, ':', 2) || '.TA' else m end) = 0 as valid
from (select p_partkey, {_vendor_map_sql()} as m from vendor)""", extra=VENDOR))
def q_canonical_symbol(spark, sf_dir):
    v = _vendor(fixture(spark, sf_dir))
    c = v.select("p_partkey", S.canonical_symbol("raw_symbol").alias("symbol"))
    return c.select("*", S.symbol_is_valid("symbol").alias("valid"))


@register("interval_code", sql_with(["stocks"], """
select distinct granularity, case granularity when '1m' then 7 when '2m' then 60 when '5m' then 60 when '15m' then 60
  when '30m' then 60 when '90m' then 60 when '1h' then 730 when '1d' then 35770 end as lookback_days,
  case when granularity = '1m' then '1d' end as daily_code from stocks"""))
def q_interval_code(spark, sf_dir):
    s = fixture(spark, sf_dir).stocks.select("granularity").distinct()
    daily = F.when(F.col("granularity") == "1m", F.lit("DAILY"))
    return s.select("granularity", S.interval_lookback_days("granularity").alias("lookback_days"),
                    S.interval_code(daily).alias("daily_code"))


@register("symbol_lookback", sql_with([], f"""
select p_partkey, symbol, timestamp '2024-03-01 12:00:00' - interval 60 day + interval 1 minute
  + to_hours((case when symbol like '%.TA%' then 3 else 0 end) + (case when symbol like '%=X%' then 3 else 0 end)
             + (case when symbol like '%-USD%' then 3 else 0 end)) as since
from (select p_partkey, case when m like 'TLV:%' then split_part(m, ':', 2) || '.TA' else m end as symbol
      from (select p_partkey, {_vendor_map_sql()} as m from vendor))""", extra=VENDOR))
def q_symbol_lookback(spark, sf_dir):
    v = _vendor(fixture(spark, sf_dir)).select("p_partkey", S.canonical_symbol("raw_symbol").alias("symbol"))
    return v.select("p_partkey", "symbol",
                    S.symbol_lookback("symbol", F.lit("2024-03-01 12:00:00").cast("timestamp_ntz")).alias("since"))


PRETTY_SQL = """with s as (select event_id, value * 997.0 as secs from events),
p as (select event_id, secs, floor(secs / 604800) as w, secs - floor(secs / 604800) * 604800 as r1 from s),
p2 as (select *, floor(r1 / 86400) as d, r1 - floor(r1 / 86400) * 86400 as r2 from p),
p3 as (select *, floor(r2 / 3600) as h, r2 - floor(r2 / 3600) * 3600 as r3 from p2),
p4 as (select *, floor(r3 / 60) as m, r3 - floor(r3 / 60) * 60 as r4 from p3)
select event_id, concat(case when w > 0 then cast(cast(w as bigint) as varchar) || 'w, ' else '' end,
  case when w > 0 or d > 0 then cast(cast(d as bigint) as varchar) || 'd, ' else '' end,
  case when w > 0 or d > 0 or h > 0 then cast(cast(h as bigint) as varchar) || 'h, ' else '' end,
  case when w > 0 or d > 0 or h > 0 or m > 0 then cast(cast(m as bigint) as varchar) || 'm, ' else '' end,
  printf('%.2fs', r4)) as pretty from p4"""


@register("pretty_duration", PRETTY_SQL)
def q_pretty_duration(spark, sf_dir):
    e = fixture(spark, sf_dir).table("events")
    return e.select("event_id", S.pretty_duration(F.col("value") * 997.0).alias("pretty"))


@register("message_template", sql_with(["messages", "users"], """
select m.chat_id, m.message_id, printf('<message id="%s" sender="%s" responds_to_sender="%s" responds_to_message_id="%s">%s</msg>',
  cast(m.message_id as varchar),
  case when u.first_name is null then 'UNKNOWN' when coalesce(u.last_name, '') <> ''
       then u.first_name || ' ' || u.last_name else u.first_name end,
  coalesce(case when pu.first_name is null then null when coalesce(pu.last_name, '') <> ''
       then pu.first_name || ' ' || pu.last_name else pu.first_name end, 'None'),
  coalesce(cast(p.message_id as varchar), 'None'),
  case when coalesce(m.text, '') = '' then 'Message has no content (possibly media?)' else m.text end) as line
from messages m left join users u on u.sender_id = m.sender_id
left join messages p on p.chat_id = m.chat_id and p.message_id = m.reply_to_message_id
left join users pu on pu.sender_id = p.sender_id"""))
def q_message_template(spark, sf_dir):
    f = fixture(spark, sf_dir)
    u = f.users.select("sender_id", S.prompt_name("first_name", "last_name").alias("sender_name"))
    parent = (f.messages.select("chat_id", F.col("message_id").alias("reply_to_message_id"),
                                F.col("sender_id").alias("_ps"), F.lit(True).alias("_hit"))
              .join(f.users.select(F.col("sender_id").alias("_ps"),
                                   S.prompt_name("first_name", "last_name", fallback=None).alias("reply_sender")),
                    "_ps", "left"))
    # the names are looked up without the texts, which are read where they are used
    who = ["chat_id", "sender_id", "reply_to_message_id"]
    named = (f.messages.select(*who).distinct().join(u, "sender_id", "left").join(parent, ["chat_id", "reply_to_message_id"], "left")
             .select(*[F.col(c).alias(f"_of_{c}") for c in who], "sender_name", "reply_sender", "_hit"))
    m = (f.placed.join(named, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in who], "left")
         .fillna({"sender_name": S.UNKNOWN_SENDER}).select("chat_id", "message_id", "reply_to_message_id", "sender_name", "reply_sender", "_hit", "place"))
    m = f.read(m, "place", "text")
    reply_id = F.when(F.col("_hit"), F.col("reply_to_message_id"))
    return m.select("chat_id", "message_id",
                    S.message_template("message_id", "sender_name", "reply_sender", reply_id, "text").alias("line"))


RESP_SQL = """resp as (select doc_id, case doc_id % 6 when 0 then '  <SUMMARY>' || text || '</SUMMARY> <MSG ID=''' ||
  cast(doc_id * 7 as varchar) || '''>' || lang || '</MSG> ' when 1 then '<MSG>' || lang || '</MSG>'
  when 2 then 'x <MSG ID=''n''>' || lang || ' and <B ID=''9''>' when 3 then '<SUMMARY>' || text
  when 4 then '</SUMMARY><SUMMARY>late</SUMMARY><MSG X=1>a</MSG><MSG ID=''5''>b</MSG>' else text end as response from documents)"""


def _responses(f):
    d = f.table("documents")
    z, text, lang = F.col("doc_id") % 6, F.col("text"), F.col("lang")
    return d.select("doc_id", F.when(z == 0, F.concat(F.lit("  <SUMMARY>"), text, F.lit("</SUMMARY> <MSG ID='"),
                                                      (F.col("doc_id") * 7).cast("string"), F.lit("'>"), lang, F.lit("</MSG> ")))
                    .when(z == 1, F.concat(F.lit("<MSG>"), lang, F.lit("</MSG>")))
                    .when(z == 2, F.concat(F.lit("x <MSG ID='n'>"), lang, F.lit(" and <B ID='9'>")))
                    .when(z == 3, F.concat(F.lit("<SUMMARY>"), text))
                    .when(z == 4, F.lit("</SUMMARY><SUMMARY>late</SUMMARY><MSG X=1>a</MSG><MSG ID='5'>b</MSG>"))
                    .otherwise(text).alias("response"))


@register("parse_tagged_response", sql_with([], """
select doc_id, case when s > 0 and e > 0 then case when e > s + 8 then substr(r, s + 9, e - s - 9) else '' end end as summary,
  case when m > 0 then case when c > 0 then case when c > g then substr(r, g + 1, c - g - 1) else '' end
    else substr(r, g + 1, greatest(length(r) - g - 1, 0)) end end as msg,
  case when m > 0 and instr(t, 'ID=''') > 0 then try_cast(split_part(split_part(t, 'ID=''', 2), '''', 1) as bigint) end as reply_to
from (select *, substr(r, m + 4, g - m - 4) as t from (
  select doc_id, r, instr(r, '<SUMMARY>') as s, instr(r, '</SUMMARY>') as e, instr(r, '<MSG') as m, instr(r, '</MSG>') as c,
    case when instr(r, '<MSG') > 0 then instr(r, '<MSG') + 3 + instr(substr(r, instr(r, '<MSG') + 4), '>') end as g
  from (select doc_id, trim(response, ' ' || chr(9) || chr(10) || chr(13)) as r from resp)))""", extra=RESP_SQL))
def q_parse_tagged_response(spark, sf_dir):
    r = _responses(fixture(spark, sf_dir))
    return r.select("doc_id", S.tagged_summary("response").alias("summary"), S.tagged_message("response").alias("msg"),
                    S.tagged_reply_to("response").alias("reply_to"))


JSON_SQL = """js as (select doc_id, case when doc_id % 7 = 0 then 'not json: ' || lang
  else '{"should_participate": ' || case when doc_id % 2 = 0 then 'true' else 'false' end ||
  ', "response_text": "' || lang || '", "reply_to_message_id": ' || cast(doc_id as varchar) || '}' end as response
  from documents)"""


def _json_responses(f):
    d = f.table("documents")
    body = F.concat(F.lit('{"should_participate": '),
                    F.when(F.col("doc_id") % 2 == 0, F.lit("true")).otherwise(F.lit("false")),
                    F.lit(', "response_text": "'), "lang", F.lit('", "reply_to_message_id": '),
                    F.col("doc_id").cast("string"), F.lit("}"))
    return d.select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("not json: "), "lang"))
                    .otherwise(body).alias("response"))


@register("parse_json_response", sql_with([], """
select doc_id,
  case when json_valid(response) and coalesce(try_cast(json_extract_string(response, '$.should_participate') as boolean), false)
    then json_extract_string(response, '$.response_text') end as response_text,
  case when json_valid(response) and coalesce(try_cast(json_extract_string(response, '$.should_participate') as boolean), false)
    then try_cast(json_extract_string(response, '$.reply_to_message_id') as bigint) end as reply_to_message_id
from (select doc_id, case when json_valid(response) then response end as response from js)""", extra=JSON_SQL))
def q_parse_json_response(spark, sf_dir):
    r = _json_responses(fixture(spark, sf_dir)).select("doc_id", S.json_response("response").alias("p"))
    return r.select("doc_id", "p.response_text", "p.reply_to_message_id")


PARAMS_SQL = """ps as (select event_id, case when event_id % 5 = 0 then 'chat_id ' || cast(user_id % 40 as varchar)
  else 'textlike ' || event_type || ';;;chat_id ' || cast(user_id % 40 as varchar) || ';;;   ;;;limit ' ||
  cast(cast(floor(value) as bigint) as varchar) end as params from events)"""


def _params(f):
    e = f.table("events")
    return e.select("event_id", F.when(F.col("event_id") % 5 == 0,
                                       F.concat(F.lit("chat_id "), (F.col("user_id") % 40).cast("string")))
                    .otherwise(F.concat(F.lit("textlike "), "event_type", F.lit(";;;chat_id "),
                                        (F.col("user_id") % 40).cast("string"), F.lit(";;;   ;;;limit "),
                                        F.floor("value").cast("bigint").cast("string"))).alias("params"))


@register("parse_search_params", sql_with([], """
select event_id, m['textlike'] as textlike, m['chat_id'] as chat_id, m['limit'] as "limit",
  m['textlike'] is null and m['textcos'] is null as missing_text, cast(cardinality(m) as int) as n_params
from (select event_id, map_from_entries(list_transform(list_filter(list_transform(string_split(params, ';;;'),
  lambda x: trim(x)), lambda x: x <> ''), lambda x: {'key': split_part(x, ' ', 1),
  'value': case when position(' ' in x) > 0 then substr(x, position(' ' in x) + 1) end})) as m from ps)""",
    extra=PARAMS_SQL))
def q_parse_search_params(spark, sf_dir):
    p = _params(fixture(spark, sf_dir)).select("event_id", S.search_params("params").alias("m"))
    m = F.col("m")
    return p.select("event_id", m["textlike"].alias("textlike"), m["chat_id"].alias("chat_id"),
                    m["limit"].alias("limit"), (m["textlike"].isNull() & m["textcos"].isNull()).alias("missing_text"),
                    F.size(m).alias("n_params"))


@register("clean_quotes", sql_with([], """
select event_id, replace(replace(replace('“' || event_type || '” ‘' || cast(user_id as varchar) || '’', '“', '"'),
  '”', '"'), '‘', '''') as cleaned from events"""))
def q_clean_quotes(spark, sf_dir):
    e = fixture(spark, sf_dir).table("events")
    s = F.concat(F.lit("“"), "event_type", F.lit("” ‘"), F.col("user_id").cast("string"), F.lit("’"))
    return e.select("event_id", S.clean_quotes(s).alias("cleaned"))


@register("null_to_default", sql_with(["messages", "stocks"], """
select chat_id, message_id, coalesce(text, '') = '' as empty_text, coalesce(reply_to_message_id, -1) as parent,
  case when views % 11 = 0 then null else cast(views as varchar) end as views_text from messages"""))
def q_null_to_default(spark, sf_dir):
    m = fixture(spark, sf_dir).messages
    raw_views = F.when(F.col("views") % 11 == 0, F.lit("#N/A")).otherwise(F.col("views").cast("string"))
    nan = F.when(F.col("views") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("views").cast("double"))
    return m.select("chat_id", "message_id", (F.coalesce("text", F.lit("")) == "").alias("empty_text"),
                    F.coalesce("reply_to_message_id", F.lit(-1)).alias("parent"),
                    F.when(S.nan_to_null(nan).isNull(), F.lit(None)).otherwise(S.na_to_null(raw_views))
                    .alias("views_text"))


@register("sql_functions", sql_with(["messages"], r"""
select chat_id, message_id, regexp_matches(text, '[\x{0590}-\x{05FF}]') as hebrew, regexp_matches(text, '[\x{0600}-\x{06FF}]') as arabic,
  round(case when coalesce(text, '') = '' then 0 else length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / cast(length(text) as double) end
    + 1e-9, 4) as english from messages"""))
def q_sql_functions(spark, sf_dir):
    """The SQL form of the script functions, called from SQL text."""
    from ..functions import sql
    sql.register(spark)
    fixture(spark, sf_dir).messages.createOrReplaceTempView("sql_function_messages")
    return spark.sql("""select chat_id, message_id, has_hebrew_text(text) as hebrew, has_arabic_text(text) as arabic,
        round(english_pct(text) + 1e-9, 4) as english from sql_function_messages""")
