"""Stand-in domain tables derived from the generated test tables.

The domain model (messages, users, chats, bars, reactions, threads, vectors)
does not exist in `/root/testdata`; these views derive it from the given
tables so that every registered query reads them and grows with them.
The Spark side is DataFrame code; `SQL_VIEWS` holds the same derivation as
DuckDB SQL for the oracle.  Message text is the whole document text.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.threads import Late
from ..session import scratch_path, stored
from ..sources import texts

# Fixed values of the stand-in derivation (they must be equal on both sides).
N_CHATS = 40
FORWARD_EVERY = 11
FORWARD_CHAT_STEP = 7
FORWARD_MSG_STEP = 3
NULL_TEXT_EVERY = 17
HEBREW_GREETING = "שלום"
ARABIC_GREETING = "سلام"
GRANULARITY_BY_LINE = {1: "1m", 2: "2m", 3: "5m", 4: "15m", 5: "30m", 6: "60m"}
GRANULARITY_OTHER = "90m"


def _chat_prefix(chat_id: Column, sep: str) -> Column:
    m = chat_id % 4
    return (F.when(m == 1, F.lit(HEBREW_GREETING + sep))
            .when(m == 2, F.lit(ARABIC_GREETING + sep)))


class Fixture:
    """Lazily built stand-in tables for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def raw(self) -> DataFrame:
        ev = self.table("events")
        return ev.select(
            "event_id", "user_id", "ts", "value", "event_type",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            (F.col("event_id") % N_CHATS).alias("chat_id"),
            F.floor(F.col("event_id") / N_CHATS).cast("bigint").alias("message_id"),
        )

    @cached_property
    def headers(self) -> DataFrame:
        """Messages without their texts, with the key of the text; `with_text` makes `messages` of them."""
        n_docs = self.table("documents").select(F.count(F.lit(1))).scalar()
        return self.raw.select(
            "chat_id", "message_id",
            F.col("user_id").alias("sender_id"),
            F.col("ts").alias("date"),
            F.when(F.col("k") % 3 == 0, F.lit(None).cast("bigint"))
             .otherwise(F.col("message_id") - 1 - (F.col("k") % 5)).alias("reply_to_message_id"),
            F.floor("value").cast("int").alias("views"),
            (F.col("k") % 7).alias("forwards"),
            F.when(F.col("k") % FORWARD_EVERY == 0, (F.col("chat_id") + FORWARD_CHAT_STEP) % N_CHATS
                   ).alias("forward_from_chat_id"),
            F.when(F.col("k") % FORWARD_EVERY == 0, F.col("message_id") - FORWARD_MSG_STEP
                   ).alias("forward_from_message_id"),
            (F.col("event_id") % n_docs).alias("doc_key"),
            (F.col("event_id") % NULL_TEXT_EVERY == 0).alias("no_text"),
        )

    def with_text(self, headers: DataFrame) -> DataFrame:
        """`headers` (any of their columns, but `chat_id` and the keys of the text) with the column `text`."""
        d = self.table("documents").select(F.col("doc_id").alias("doc_key"), F.col("text").alias("doc_text"))
        prefix = F.coalesce(_chat_prefix(F.col("chat_id"), " "), F.lit(""))
        text = F.when(F.col("no_text"), F.lit(None).cast("string")).otherwise(F.concat(prefix, F.col("doc_text")))
        return headers.join(d, "doc_key", "left").withColumn("text", text).drop("doc_key", "no_text", "doc_text")

    @property
    def late(self) -> Late:
        return Late(self.headers, ["doc_key", "no_text"], self.with_text)

    @cached_property
    def _kept(self) -> tuple[DataFrame, str]:
        """`(doc_key, place)` of the documents' texts, and the folder that has them."""
        path = scratch_path(self.spark, "texts")
        d = self.table("documents").select(F.col("doc_id").alias("doc_key"), "text")
        return stored(texts.put_texts(d, "text", path)), path

    @cached_property
    def placed(self) -> DataFrame:
        """`messages` with the place of each text (null: no text) in place of it; `read` gives the texts."""
        place = F.when(~F.col("no_text"), F.col("place"))
        return self.headers.join(self._kept[0], "doc_key", "left").withColumn("place", place).drop("doc_key", "no_text")

    def read(self, rows: DataFrame, places: str, out: str) -> DataFrame:
        """`rows` (with `chat_id`) with the message texts at `places` (a place or an array) as `out` in their stead."""
        prefix = F.coalesce(_chat_prefix(F.col("chat_id"), " "), F.lit(""))
        many = rows.schema[places].dataType.typeName() == "array"
        text = F.transform(out, lambda t: F.concat(prefix, t)) if many else F.concat(prefix, F.col(out))
        return texts.with_texts(rows, places, out, self._kept[1]).withColumn(out, text)

    @cached_property
    def messages(self) -> DataFrame:
        return self.with_text(self.headers).select(
            "chat_id", "message_id", "sender_id", "date", "text", "reply_to_message_id", "views", "forwards",
            "forward_from_chat_id", "forward_from_message_id")

    @cached_property
    def users(self) -> DataFrame:
        c = self.table("customer")
        return c.select(
            F.col("c_custkey").alias("sender_id"),
            F.col("c_name").alias("first_name"),
            F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("last_name"),
            F.when(F.col("c_custkey") % 3 == 0,
                   F.concat(F.lit("+"), F.col("c_custkey").cast("string"))).alias("phone_number"),
        )

    @cached_property
    def chats(self) -> DataFrame:
        ids = self.messages.select("chat_id").distinct()
        cid = F.col("chat_id")
        title_prefix = F.coalesce(
            _chat_prefix(cid, "").when(cid % 4 == 3, F.lit("news")), F.lit(""))
        return ids.select(
            "chat_id",
            F.concat(title_prefix, F.lit(" "), cid.cast("string")).alias("title"),
            F.when((cid % 2 == 0) | (cid % 4 == 1), cid + 100).alias("linked_chat_id"),
            F.when(cid % 5 > 0, cid + 50).alias("top_message_id"),
        )

    @cached_property
    def stocks(self) -> DataFrame:
        li = self.table("lineitem")
        p = self.table("part").select("p_partkey", "p_brand")
        j = li.join(p, li.l_partkey == p.p_partkey)
        gran = None
        for line, g in GRANULARITY_BY_LINE.items():
            gran = (F.when(F.col("l_linenumber") == line, g) if gran is None
                    else gran.when(F.col("l_linenumber") == line, g))
        gran = gran.otherwise(GRANULARITY_OTHER)
        return j.select(
            F.col("p_brand").alias("symbol"),
            gran.alias("granularity"),
            (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias("date"),
            F.when(F.col("l_discount") > 0.05, F.lit(None).cast("double"))
             .otherwise(F.col("l_extendedprice") / F.col("l_quantity")).alias("open"),
            F.when(F.col("l_tax") == 0, F.lit(None).cast("double"))
             .otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")).alias("close"),
            F.col("l_quantity").alias("volume"),
        )

    @cached_property
    def reactions(self) -> DataFrame:
        """Reactions stand-in: event_type as the reaction, `k` votes, per message."""
        r = self.raw
        return r.groupBy("chat_id", "message_id", F.col("event_type").alias("reaction")).agg(
            F.sum("k").cast("int").alias("votes_abs"))

    @cached_property
    def raw_docs(self) -> DataFrame:
        """Raw message documents (schema `RAW_MESSAGE`) derived from events and documents."""
        docs = self.table("documents").select(F.col("doc_id").alias("doc_key"), F.col("text").alias("doc_text"))
        return self._raw_docs(docs, "doc_text")

    @cached_property
    def placed_docs(self) -> DataFrame:
        """`raw_docs` whose `text` is empty or null where a document's text stands, with the place of it in `_place`;
        `with_document_text` gives the texts."""
        return self._raw_docs(self._kept[0], "place")

    def with_document_text(self, docs: DataFrame) -> DataFrame:
        text = F.coalesce("_document_text", "text")
        return texts.with_texts(docs, "_place", "_document_text", self._kept[1]).withColumn("text", text).drop("_document_text")

    def _raw_docs(self, docs: DataFrame, text: str) -> DataFrame:
        """`docs`: the column `text`, or the place of it, by `doc_key`."""
        from .. import schemas
        n_docs = self.table("documents").select(F.count(F.lit(1))).scalar()
        r = self.raw.withColumn("doc_key", F.col("event_id") % n_docs).join(docs, "doc_key", "left")
        k, uid, cid, mid, et = F.col("k"), F.col("user_id"), F.col("chat_id"), F.col("message_id"), F.col("event_type")
        title_prefix = F.coalesce(_chat_prefix(cid, "").when(cid % 4 == 3, F.lit("news")), F.lit(""))
        s = lambda: F.lit(None).cast("string")
        b = lambda: F.lit(None).cast("boolean")
        chat = F.when(F.col("event_id") % 97 != 0, F.struct(
            cid.alias("id"),
            F.when(cid % 3 == 0, "CHANNEL").when(cid % 3 == 1, "SUPERGROUP").otherwise("GROUP").alias("type"),
            F.concat(title_prefix, F.lit(" "), cid.cast("string")).alias("title"),
            s().alias("first_name"), s().alias("last_name"),
            F.when(cid % 2 == 0, F.concat(F.lit("chat"), cid.cast("string"))).alias("username"),
            s().alias("invite_link"),
            F.when(k % 6 != 0, (cid * 10 + k % 3).cast("int")).alias("members_count"),
            b().alias("is_verified"), b().alias("is_restricted"),
            (cid % 7 == 0).alias("is_scam"),
            F.when(cid % 5 == 0, F.lit(True)).alias("is_fake"),
            b().alias("is_support"), s().alias("phone_number"),
            F.when(cid % 2 == 0, F.struct((cid + 100).alias("id"))).alias("linked_chat")))
        user = F.when(uid % 5 != 0, F.struct(
            uid.alias("id"), F.concat(F.lit("U"), uid.cast("string")).alias("first_name"),
            F.when(uid % 2 == 0, F.concat(F.lit("L"), uid.cast("string"))).alias("last_name"),
            F.when(k % 2 == 0, F.concat(F.lit("user"), uid.cast("string"))).alias("username"),
            s().alias("phone_number"), b().alias("is_verified"), b().alias("is_restricted"), b().alias("is_scam"),
            b().alias("is_fake"), b().alias("is_support"), (uid % 11 == 0).alias("is_bot")))
        rx = lambda e, c, n: F.struct(F.lit(e).cast("string").alias("emoji"), c.cast("bigint").alias("custom_emoji_id"),
                                      n.cast("int").alias("count"))
        reactions = (F.when(et == "click", F.struct(F.array(
            rx("👍", F.lit(None), k), rx(None, F.lit(5000000000) + k % 3, F.lit(2)), rx("👍", F.lit(None), F.lit(1))
        ).alias("reactions")))
            .when(et == "view", F.struct(F.array().cast(T.ArrayType(schemas.REACTION_ITEM)).alias("reactions")))
            .when(et == "purchase", F.struct(F.array(rx("🔥", F.lit(None), k % 4)).alias("reactions"))))
        opt = lambda t, n: F.struct(F.lit(t).alias("text"), n.cast("int").alias("voter_count"))
        poll = F.when(et == "signup", F.struct(
            F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("poll "), mid.cast("string"))).alias("question"),
            F.when(k % 2 == 0, F.array(opt("yes", k), opt("no", k % 3), opt("yes", F.lit(1))))
             .otherwise(F.array().cast(T.ArrayType(schemas.POLL_OPTION))).alias("options")))
        f = lambda p_: F.struct(F.concat(F.lit(p_ + "f"), mid.cast("string")).alias("file_id"),
                                F.concat(F.lit(p_ + "u"), mid.cast("string")).alias("file_unique_id"))
        media = {"photo": (k % 9 == 0) | (k % 9 == 1), "document": k % 9 == 1, "video": k % 9 == 2,
                 "voice": k % 9 == 3}
        cols = {
            "id": F.when(F.col("event_id") % 89 != 0, mid),
            "outgoing": k % 13 == 0,
            "date": F.col("ts"),
            "text": F.when(k % 4 == 0, s()).when(k % 4 == 1, F.lit("")).otherwise(s() if text == "place" else F.col(text)),
            "caption": F.when((k % 4 < 2) & (uid % 2 == 0), F.concat(F.lit("cap "), mid.cast("string"))),
            "views": F.floor("value").cast("int"),
            "forwards": F.when(k % 13 == 5, F.lit(None).cast("int")).otherwise(k % 7),
            "chat": chat, "from_user": user,
            "sender_chat": F.when(uid % 5 == 0, F.struct((-1000 - cid).alias("id"))),
            "forward_from": F.when(k % 11 == 1, F.struct(uid.alias("id"))),
            "forward_from_chat": F.when(k % 11 == 0, F.struct(((cid + 7) % N_CHATS).alias("id"))),
            "forward_from_message_id": F.when(k % 11 <= 1, mid - 3),
            "reply_to_message_id": F.when(k % 3 == 0, F.lit(None).cast("bigint")).otherwise(mid - 1 - (k % 5)),
            "reactions": reactions, "poll": poll,
        }
        for m in schemas.MEDIA_KINDS:
            cols[m] = F.when(media[m], f(m[:2])) if m in media else F.lit(None).cast(schemas.FILE)
        out = r.select(*[cols[fl.name].cast(fl.dataType).alias(fl.name) for fl in schemas.RAW_MESSAGE.fields],
                       F.col("event_id").alias("_arrival"), *([F.when(F.coalesce(k % 4 > 1, F.lit(True)), F.col("place")).alias("_place")] if text == "place" else []))
        return out

    @cached_property
    def polls(self) -> DataFrame:
        """Poll stand-in: one option per event, event_type as its text, floor(value) votes."""
        return self.raw.select("chat_id", "message_id", F.col("event_type").alias("poll_option_text"),
                               F.floor("value").cast("int").alias("votes_abs"))

    @cached_property
    def message_vectors(self) -> DataFrame:
        """Messages with an embedding: vector `(message_id * 40 + chat_id) % n` of `embeddings`."""
        emb = self.table("embeddings")
        n = emb.select(F.count(F.lit(1))).scalar()
        m = self.messages.withColumn("_vk", (F.col("message_id") * N_CHATS + F.col("chat_id")) % n)
        return m.join(emb.select(F.col("vec_id").alias("_vk"), "embedding"), "_vk", "left").drop("_vk")

    def query_vector(self, vec_id: int = 0) -> list[float]:
        """The query vector: one row looked up by key, passed on as a query parameter
        (as the reference passes the encoded query text)."""
        row = self.table("embeddings").filter(F.col("vec_id") == vec_id).select("embedding").first()
        return list(row[0])

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.table("embeddings")

    @cached_property
    def conversations(self) -> DataFrame:
        return self.table("conversations")


def fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    return Fixture(spark, sf_dir)


# --------------------------------------------------------------------------
# DuckDB side: the same derivation as SQL views (only the oracle uses these).

SQL_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": ((), """select event_id, user_id, ts, value, event_type,
  cast(json_extract_string(props,'$.k') as int) k, event_id % 40 chat_id,
  cast(floor(event_id/40) as bigint) message_id,
  event_id % (select count(*) from documents) doc_key from events"""),
    "messages": (("raw",), """select r.chat_id, r.message_id, r.user_id sender_id, r.ts as date,
  case when r.event_id % 17 = 0 then null else (case r.chat_id % 4 when 1 then 'שלום '
    when 2 then 'سلام ' else '' end) || d.text end as text,
  case when k % 3 = 0 then null else message_id-1-(k % 5) end reply_to_message_id,
  cast(floor(value) as int) views, k % 7 as forwards,
  case when k % 11 = 0 then (chat_id + 7) % 40 end forward_from_chat_id,
  case when k % 11 = 0 then message_id - 3 end forward_from_message_id
  from raw r left join documents d on d.doc_id = r.doc_key"""),
    "raw_docs": (("raw",), """select
  case when r.event_id % 89 <> 0 then r.message_id end as id,
  k % 13 = 0 as outgoing, ts as date,
  case when k % 4 = 0 then null when k % 4 = 1 then '' else d.text end as text,
  case when k % 4 < 2 and user_id % 2 = 0 then concat('cap ', cast(message_id as varchar)) end as caption,
  cast(floor(value) as int) as views,
  case when k % 13 = 5 then null else k % 7 end as forwards,
  case when event_id % 97 <> 0 then {'id': chat_id,
    'type': case chat_id % 3 when 0 then 'CHANNEL' when 1 then 'SUPERGROUP' else 'GROUP' end,
    'title': concat(case chat_id % 4 when 1 then 'שלום' when 2 then 'سلام' when 3 then 'news' else '' end, ' ',
      cast(chat_id as varchar)),
    'username': case when chat_id % 2 = 0 then concat('chat', cast(chat_id as varchar)) end,
    'members_count': case when k % 6 <> 0 then cast(chat_id * 10 + k % 3 as int) end,
    'is_scam': chat_id % 7 = 0, 'is_fake': case when chat_id % 5 = 0 then true end,
    'linked_chat': case when chat_id % 2 = 0 then {'id': chat_id + 100} end} end as chat,
  case when user_id % 5 <> 0 then {'id': user_id, 'first_name': concat('U', cast(user_id as varchar)),
    'last_name': case when user_id % 2 = 0 then concat('L', cast(user_id as varchar)) end,
    'username': case when k % 2 = 0 then concat('user', cast(user_id as varchar)) end,
    'is_bot': user_id % 11 = 0} end as from_user,
  case when user_id % 5 = 0 then {'id': -1000 - chat_id} end as sender_chat,
  case when k % 11 = 1 then {'id': user_id} end as forward_from,
  case when k % 11 = 0 then {'id': (chat_id + 7) % 40} end as forward_from_chat,
  case when k % 11 <= 1 then message_id - 3 end as forward_from_message_id,
  case when k % 3 = 0 then null else message_id - 1 - (k % 5) end as reply_to_message_id,
  case event_type
    when 'click' then {'reactions': [{'emoji': '👍', 'custom_emoji_id': null::bigint, 'count': k},
      {'emoji': null::varchar, 'custom_emoji_id': 5000000000 + k % 3, 'count': 2},
      {'emoji': '👍', 'custom_emoji_id': null::bigint, 'count': 1}]}
    when 'view' then {'reactions': []::struct(emoji varchar, custom_emoji_id bigint, count int)[]}
    when 'purchase' then {'reactions': [{'emoji': '🔥', 'custom_emoji_id': null::bigint, 'count': k % 4}]}
  end as reactions,
  case when event_type = 'signup' then {
    'question': case when k % 5 = 0 then '' else concat('poll ', cast(message_id as varchar)) end,
    'options': case when k % 2 = 0 then [{'text': 'yes', 'voter_count': k}, {'text': 'no', 'voter_count': k % 3},
      {'text': 'yes', 'voter_count': 1}] else []::struct(text varchar, voter_count int)[] end} end as poll,
  case when k % 9 in (0, 1) then {'file_id': concat('phf', cast(message_id as varchar)),
    'file_unique_id': concat('phu', cast(message_id as varchar))} end as photo,
  case when k % 9 = 1 then {'file_id': concat('dof', cast(message_id as varchar)),
    'file_unique_id': concat('dou', cast(message_id as varchar))} end as document,
  case when k % 9 = 2 then {'file_id': concat('vif', cast(message_id as varchar)),
    'file_unique_id': concat('viu', cast(message_id as varchar))} end as video,
  case when k % 9 = 3 then {'file_id': concat('vof', cast(message_id as varchar)),
    'file_unique_id': concat('vou', cast(message_id as varchar))} end as voice,
  cast(null as struct(file_id varchar, file_unique_id varchar)) as audio,
  cast(null as struct(file_id varchar, file_unique_id varchar)) as sticker,
  cast(null as struct(file_id varchar, file_unique_id varchar)) as animation,
  cast(null as struct(file_id varchar, file_unique_id varchar)) as video_note,
  cast(null as struct(file_id varchar, file_unique_id varchar)) as new_chat_photo,
  event_id as _arrival
  from raw r left join documents d on d.doc_id = r.doc_key"""),
    "message_vectors": (("messages",), """select m.*, e.embedding from messages m left join embeddings e
  on e.vec_id = (m.message_id * 40 + m.chat_id) % (select count(*) from embeddings)"""),
    "users": ((), """select c_custkey sender_id, c_name first_name,
  case when c_custkey % 2 = 0 then c_mktsegment end last_name,
  case when c_custkey % 3 = 0 then concat('+', cast(c_custkey as varchar)) end phone_number from customer"""),
    "chats": (("messages",), """select distinct chat_id, concat(case chat_id % 4 when 1 then 'שלום' when 2 then 'سلام'
    when 3 then 'news' else '' end, ' ', cast(chat_id as varchar)) title,
  case when chat_id % 2 = 0 or chat_id % 4 = 1 then chat_id + 100 end linked_chat_id,
  case when chat_id % 5 > 0 then 50 + chat_id end top_message_id from messages"""),
    "stocks": ((), """select p_brand symbol, case l_linenumber when 1 then '1m' when 2 then '2m' when 3 then '5m'
    when 4 then '15m' when 5 then '30m' when 6 then '60m' else '90m' end granularity,
  l_shipdate + to_hours(l_linenumber) as date,
  case when l_discount > 0.05 then null else l_extendedprice/l_quantity end as open,
  case when l_tax = 0 then null else l_extendedprice*(1-l_discount)/l_quantity end as close,
  l_quantity volume from lineitem join part on p_partkey = l_partkey"""),
    "reactions": (("raw",), """select chat_id, message_id, event_type reaction, cast(sum(k) as int) votes_abs
  from raw group by chat_id, message_id, event_type"""),
}


def sql_with(views: list[str] | tuple[str, ...], body: str, extra: str = "", recursive: bool = False) -> str:
    """`with <views and deps>[, extra ctes] <body>` in DuckDB dialect."""
    order: list[str] = []

    def add(v: str) -> None:
        for dep in SQL_VIEWS[v][0]:
            add(dep)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    ctes = [f"{v} as ({SQL_VIEWS[v][1]})" for v in order]
    if extra:
        ctes.append(extra)
    if not ctes:
        return body
    return ("with recursive " if recursive else "with ") + ",\n".join(ctes) + "\n" + body
