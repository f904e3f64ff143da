"""Sources: raw message documents, bar CSVs, candle partitions, chain files, exports.

Every reader passes an explicit schema; partitioned layouts are read with a
partition filter so that only the requested directories are listed.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalars import canonical_symbol, from_date_parts, interval_code, na_to_null, symbol_is_valid

MALFORMED = "_malformed"
REACTION_LEVELS = 5   # fixed value: levels of nested reaction objects that are unwrapped
CANDLE_FILE = ("day int, hour int, minute int, second int, open double, high double, low double, close double, "
               "volume double, adj_close double, symbol string, yyyymm int")
CHAIN_CONTRACT = ("chat_id", "sent_by_linked_chat", "first_message_id", "last_message_id", "chain", "chain_len")


def raw_schema(malformed: bool = True):
    """The declared document schema as it is read: `reactions` as its JSON text, because it comes as a
    list or as objects nested up to five deep, and a column for lines that do not parse."""
    from pyspark.sql import types as T
    fields = [T.StructField("reactions", T.StringType()) if f.name == "reactions" else f for f in schemas.RAW_MESSAGE.fields]
    return T.StructType([*fields, *([T.StructField(MALFORMED, T.StringType())] if malformed else [])])


def declared_shape(raw: DataFrame) -> DataFrame:
    """Documents read by `raw_schema` in the declared schema: text and caption objects become their
    `markdown`, reactions the innermost list (none: null)."""
    inner = F.col("reactions")
    for _ in range(REACTION_LEVELS):
        inner = F.when(inner.startswith("{"), F.get_json_object(inner, "$.reactions")).otherwise(inner)
    items = F.when(inner.startswith("["), F.from_json(inner, schemas.RAW_MESSAGE["reactions"].dataType["reactions"].dataType))

    def markdown(c: str):
        # an object read into a string column is its JSON text
        return F.when(F.col(c).rlike(r'(?s)^\{\s*"'), F.get_json_object(c, "$.markdown")).otherwise(F.col(c)).alias(c)

    shaped = {"reactions": F.when(items.isNotNull(), F.struct(items.alias("reactions"))).alias("reactions"),
              "text": markdown("text"), "caption": markdown("caption")}
    return raw.select(*[shaped.get(c, F.col(c)) for c in raw.columns])


def read_raw_messages(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines message documents with the declared nested schema.

    Unknown fields are ignored, missing ones are null (the struct schema is the null-pruning of
    the reference).  A line that is no such document comes as a row of nulls with the line in
    `_malformed`: `split_malformed` parts the two, so nothing is lost unseen.
    """
    return declared_shape(spark.read.schema(raw_schema()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
                          .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").json(path))


def split_malformed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents, and the rejected lines `(line)` to be kept in quarantine.  A line is rejected if it
    does not parse, or if its chat or message id is missing."""
    bad = F.col(MALFORMED).isNotNull() | F.col("id").isNull() | F.col("chat.id").isNull()
    line = F.coalesce(F.col(MALFORMED), F.to_json(F.struct(*[c for c in raw.columns if c != MALFORMED])))
    return raw.filter(~bad).drop(MALFORMED), raw.filter(bad).select(line.alias("line"))


#: Deepest level of a value in a document; the document itself is at level 1 (fixed value).
MAX_LEVEL = 25
# a JSON string; an object's field whose value is null, with the comma behind it, and as the last one
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_NULL_FIELD, _LAST_NULL_FIELD = _STRING + ":null,", ",?" + _STRING + r":null(?=\})"


def level_at_most(json: Column, levels: int = MAX_LEVEL) -> Column:
    """Whether the JSON text is one value and holds none deeper than `levels`.  Strings and empty containers count as
    plain values; taking the innermost containers for plain values (a control character) brings a document one level up."""
    plain = F.regexp_replace(F.regexp_replace(json, _STRING, "x"), r"\[\s*\]|\{\s*\}", "\x01")
    flat = F.aggregate(F.sequence(F.lit(2), F.lit(levels)), plain, lambda t, _: F.regexp_replace(t, r"\[[^\[\]{}]*+\]|\{[^\[\]{}]*+\}", "\x01"))
    return flat.rlike("^\\s*(\\x01|[^\\s\\[\\]{}\\x01]+)\\s*$")


def without_null_fields(json: Column) -> Column:
    """The compact JSON text without the null fields of its objects, at every level; nulls in lists stay."""
    return F.regexp_replace(F.regexp_replace(json, _NULL_FIELD, ""), _LAST_NULL_FIELD, "")


def read_free_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S01 for documents of any shape: `(doc)` as VARIANT, fields that no schema declares included, and the rejected
    lines `(line)`: those that are no JSON object or hold a value deeper than `MAX_LEVEL`.

    Null fields are pruned at every level.  All of it is per-line SQL expressions; `F.variant_get` reads fields, and
    the column can be stored in Parquet as it is."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.to_json(F.try_parse_json("value")).alias("_json"))
    ok = F.coalesce(F.col("_json").startswith("{") & level_at_most(F.col("line")), F.lit(False))
    docs = lines.filter(ok).select(F.parse_json(without_null_fields(F.col("_json"))).alias("doc"))
    return docs, lines.filter(~ok).select("line")


def write_raw_messages(docs: DataFrame, path: str) -> None:
    """JSON-lines documents with microsecond timestamps; refuses an existing path."""
    (docs.write.mode("errorifexists").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .option("compression", "gzip").json(path))


def read_bars_csv(spark: SparkSession, path: str) -> DataFrame:
    """Sheet-exported bar CSVs (Name, Interval, Date, OHLCV; `#N/A` = null).

    Symbol and interval come from each file's first row in the reference; here
    they are read per row (every row of a file carries the same values), the
    vendor symbol is canonicalised (F09) and the interval coded (F10).
    """
    raw = (spark.read.schema(schemas.BARS_CSV).option("header", True).option("nullValue", "#N/A")
           .option("mode", "PERMISSIVE").csv(path))
    return parse_bar_rows(raw)


def parse_bar_rows(raw: DataFrame, codes: bool = False) -> DataFrame:
    """Typed bars from sheet-export rows (shared by the batch and the streaming reader).

    A symbol that still holds `:` (F09) or an unknown interval fails the job, as in the
    reference.  With `codes` the interval may also be one of the stored granularities.
    """
    code = interval_code("Interval")
    if codes:
        code = F.coalesce(code, F.when(F.col("Interval").isin(*schemas.GRANULARITIES), F.col("Interval")))
    symbol = canonical_symbol("Name")
    raw = raw.filter(F.col("Name").isNotNull())
    code = F.when(code.isNull(), F.raise_error(F.concat(F.lit("unknown interval: "), F.coalesce("Interval", F.lit("null"))))).otherwise(code)
    symbol = F.when(symbol_is_valid(symbol), symbol).otherwise(F.raise_error(F.concat(F.lit("unknown vendor symbol: "), symbol)))
    num = lambda c: na_to_null(c).try_cast("double")
    return raw.select(
        symbol.alias("symbol"), code.alias("granularity"),
        F.coalesce(F.try_to_timestamp("Date", F.lit("yyyy-MM-dd HH:mm:ss")),
                   F.try_to_timestamp("Date", F.lit("yyyy-MM-dd"))).cast("timestamp_ntz").alias("date"),
        num("Open").alias("open"), num("High").alias("high"), num("Low").alias("low"),
        num("Close").alias("close"), num("Volume").alias("volume"))


def read_candles(spark: SparkSession, root: str, symbol: str | None = None, lo_yyyymm: int | None = None,
                 hi_yyyymm: int | None = None) -> DataFrame:
    """Hive-partitioned candles `symbol=/yyyymm=`; only partitions in range are read.

    The timestamp is rebuilt from yyyymm and the stored day/hour/minute/second
    parts (F07).  A missing root or no matching partition gives an empty frame.
    """
    df = _candle_files(spark, root, _candle_path(root, symbol, lo_yyyymm, hi_yyyymm))
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    if lo_yyyymm is not None:
        df = df.filter(F.col("yyyymm") >= lo_yyyymm)
    if hi_yyyymm is not None:
        df = df.filter(F.col("yyyymm") <= hi_yyyymm)
    return df.select("symbol", from_date_parts("yyyymm", "day", "hour", "minute", "second").alias("date"),
                     "open", "high", "low", "close", "volume", "adj_close")


def _months(lo: int, hi: int) -> list[int]:
    out, y, m = [], lo // 100, lo % 100
    while y * 100 + m <= hi:
        out.append(y * 100 + m)
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


# characters Spark escapes in partition directory names (as %XX)
_PATH_ESCAPES = set('"#%\'*/:=?\\\x7f{[]^')


def partition_dir_value(v: str) -> str:
    """A partition value as Spark writes it into a directory name."""
    return "".join(f"%{ord(c):02X}" if (c in _PATH_ESCAPES or ord(c) < 0x20) else c for c in str(v))


def _candle_path(root: str, symbol: str | None, lo: int | None, hi: int | None) -> str:
    """The store, or a pattern of the directories of one symbol and a month range, so that only
    those are listed."""
    if symbol is None or lo is None or hi is None or hi < lo:
        return root
    return f"{root}/symbol={partition_dir_value(symbol)}/yyyymm={{{','.join(map(str, _months(lo, hi)))}}}"


def _candle_files(spark: SparkSession, root: str, path: str) -> DataFrame:
    """Stored candle rows with their partition columns; a missing store or no matching directory is empty."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(CANDLE_FILE).option("basePath", root).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CANDLE_FILE)


def stored_candles(spark: SparkSession, root: str) -> DataFrame:
    """The rows of a candle store as they are kept: partition columns `symbol, yyyymm` and time parts."""
    return _candle_files(spark, root, root)


def read_chain_file(spark: SparkSession, path: str) -> DataFrame:
    """A chain file must have exactly the contract columns; null chains are dropped."""
    df = spark.read.parquet(path)
    if set(df.columns) != set(CHAIN_CONTRACT):
        raise ValueError(f"chain file columns {sorted(df.columns)} != {sorted(CHAIN_CONTRACT)}")
    return df.filter(F.col("chain").isNotNull()).select(*CHAIN_CONTRACT)


def messages_with_title(messages: DataFrame, chats: DataFrame | None = None) -> DataFrame:
    """Messages, optionally with the chat title (left join: messages are kept)."""
    if chats is None:
        return messages
    return messages.join(chats.select("chat_id", "title"), "chat_id", "left")


def normalize_bars(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """S09 `repair_yf`: vendor columns to lower snake case, missing OHLCV /
    splits / dividends added as null, symbol set, zoned time converted to UTC
    and the zone dropped (`date` becomes timestamp_ntz)."""
    renamed = df.withColumnsRenamed({c: c.strip().lower().replace(" ", "_") for c in df.columns})
    if "datetime" in renamed.columns and "date" not in renamed.columns:
        renamed = renamed.withColumnRenamed("datetime", "date")
    for c in ("open", "high", "low", "close", "volume", "adj_close", "stock_splits", "dividends"):
        if c not in renamed.columns:
            renamed = renamed.withColumn(c, F.lit(None).cast("double"))
    if symbol is not None:
        renamed = renamed.withColumn("symbol", F.lit(symbol))
    dtype = dict(renamed.dtypes).get("date")
    if dtype in ("timestamp", "string"):
        instant = F.col("date") if dtype == "timestamp" else F.to_timestamp("date")
        renamed = renamed.withColumn("date", utc_wall_time(instant))
    return renamed


def utc_wall_time(instant) -> "F.Column":
    """A zoned instant as the UTC wall-clock time without zone (independent of the session zone)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
