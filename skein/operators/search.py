"""Filtered text / nearest-vector search and incremental embedding jobs.

Search is a filter + distance projection + `orderBy(...).limit(k)`, which
Spark plans as `TakeOrderedAndProject`: every task keeps its own top k and
only k rows per task reach the final merge, so the whole table is scanned
once and nothing else is shuffled.  Filters are added only for the given
arguments (P14) so they are pushed into the scan.

Embedding uses a pluggable encoder `DataFrame -> DataFrame`.  The default
is JVM-side feature hashing (tokenise with built-ins, `HashingTF`, L2
normalise): deterministic, no model files, whole texts, no Python in the
hot path.  A model encoder can be plugged in through `pandas_encoder`, which
runs it with `mapInPandas` in Arrow batches (model loaded once per worker).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[DataFrame, str, str], DataFrame]

DEFAULT_K = 10
BATCH = 128            # fixed value: texts per model call
TOKEN_RE = r"[^\p{L}\p{N}]+"


def as_vector(query) -> Column:
    """A query vector parameter (sequence of floats) as an array literal."""
    if isinstance(query, Column):
        return query
    return F.array(*[F.lit(float(x)) for x in query])


def l2_distance(vec: Column | str, query) -> Column:
    """Euclidean distance between two float arrays, computed in double."""
    query = as_vector(query)
    v = F.col(vec) if isinstance(vec, str) else vec
    sq = F.zip_with(v, query, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))


def cosine_distance(vec: Column | str, query) -> Column:
    query = as_vector(query)
    v = F.col(vec) if isinstance(vec, str) else vec
    dot = F.aggregate(F.zip_with(v, query, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0),
                      lambda acc, x: acc + x)
    nv = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    nq = F.sqrt(F.aggregate(query, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.lit(1.0) - F.try_divide(dot, nv * nq)


def optional_filters(messages: DataFrame, chats: DataFrame | None = None, chat_id: int | None = None,
                     chatname: str | None = None, after: str | None = None, before: str | None = None) -> DataFrame:
    """P14 + P16 + J12: only the given filters; dates are strict bounds; the chat
    name filter is `chat_id IN (chats whose title contains name)` (a semi join)."""
    m = messages
    if chat_id is not None:
        m = m.filter(F.col("chat_id") == chat_id)
    if after is not None:
        m = m.filter(F.col("date") > F.lit(after).cast("timestamp_ntz"))
    if before is not None:
        m = m.filter(F.col("date") < F.lit(before).cast("timestamp_ntz"))
    if chatname is not None:
        if chats is None:
            raise ValueError("chatname needs the chats table")
        m = m.join(chats.filter(F.col("title").contains(chatname)).select("chat_id"), "chat_id", "left_semi")
    return m


def _known_chats(messages: DataFrame, chats: DataFrame) -> DataFrame:
    """Messages whose chat is in `chats` (the search's inner join, as a semi join before the limit)."""
    return messages.join(chats.select("chat_id"), "chat_id", "left_semi")


def _with_title(top: DataFrame, chats: DataFrame, columns: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Add the chat title to the k found rows and put them back in order (the join loses it)."""
    titles = chats.select("chat_id", "title").dropDuplicates(["chat_id"])
    return top.join(titles, "chat_id", "left").select(*columns).orderBy(*order)


def vector_search(messages: DataFrame, chats: DataFrame, query, k: int = DEFAULT_K,
                  metric: str = "l2", keys: Sequence[str] = ("chat_id", "message_id"), **filters) -> DataFrame:
    """Messages of known chats, filters, embedding not null, nearest k by distance
    -> (title, date, text, distance), nearest first.

    Ties are broken by the message key so the result is deterministic.
    """
    m = _known_chats(optional_filters(messages, chats, **filters), chats).filter(F.col("embedding").isNotNull())
    dist = l2_distance("embedding", query) if metric == "l2" else cosine_distance("embedding", query)
    order = [F.col("distance").asc_nulls_last(), *[F.col(c) for c in keys]]
    top = m.select(*keys, "date", "text", dist.alias("distance")).orderBy(*order).limit(k)
    return _with_title(top, chats, [*keys, "title", "date", "text", "distance"], order)


def like_search(messages: DataFrame, chats: DataFrame, text: str, k: int | None = DEFAULT_K, **filters) -> DataFrame:
    """Same filters, `text LIKE %text%`; newest first (the reference leaves the order open)."""
    m = _known_chats(optional_filters(messages, chats, **filters), chats).filter(F.col("embedding").isNotNull())
    order = [F.col("date").desc(), "chat_id", "message_id"]
    m = m.filter(F.col("text").contains(text)).select("chat_id", "message_id", "date", "text")
    if k is not None:
        m = m.orderBy(*order).limit(k)
    return _with_title(m, chats, ["chat_id", "message_id", "title", "date", "text"], order)


def find_chats(chats: DataFrame, search: str, case_insensitive: bool = False) -> DataFrame:
    """Chats whose title contains the string (document-store variant: case-insensitive)."""
    cond = F.col("title").ilike(f"%{search}%") if case_insensitive else F.col("title").contains(search)
    return chats.filter(cond)


def limit_rows(df: DataFrame, n: int | None = 10, order: Sequence[str | Column] = ()) -> DataFrame:
    """At most n rows (None = all), in a given order for determinism."""
    if order:
        df = df.orderBy(*order)
    return df if n is None else df.limit(n)


# embedding -----------------------------------------------------------------------

def hashing_encoder(dim: int = 64) -> Encoder:
    """Deterministic feature-hashing encoder: lower-cased word tokens of the whole
    text -> term counts hashed into `dim` buckets -> L2-normalised float array."""
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    def encode(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        tok = df.withColumn("_tok", F.array_remove(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), TOKEN_RE), ""))
        tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim)
        arr = vector_to_array(F.col("_tf"), "float64")
        v = tf.transform(tok).withColumn("_arr", arr)
        norm = F.sqrt(F.aggregate("_arr", F.lit(0.0), lambda a, x: a + x * x))
        # the norm stands in an argument: inside the lambda it would be summed anew for every value
        return v.withColumn(out_col, F.zip_with("_arr", F.array_repeat(norm, dim), lambda x, n: F.coalesce(F.try_divide(x, n), F.lit(0.0))
                                                .cast("float"))).drop("_tok", "_tf", "_arr")
    return encode


def pandas_encoder(load_model: Callable[[], Callable[[list[str]], list[list[float]]]], dim: int,
                   batch: int = BATCH) -> Encoder:
    """Wrap a Python model (`load_model()` -> `encode(list_of_texts)`) as an encoder.

    Runs in `mapInPandas` with Arrow batches of `batch` rows; the model is
    loaded once per Python worker and reused across batches.
    """
    def encode(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        from pyspark.sql import types as T
        schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(T.FloatType()))])

        def run(it):
            model = load_model()
            for pdf in it:
                texts = pdf[text_col].fillna("").astype(str).tolist()
                vecs = []
                for i in range(0, len(texts), batch):
                    vecs.extend(model(texts[i:i + batch]))
                if any(len(v) != dim for v in vecs):
                    raise ValueError(f"the model returned a vector that does not have {dim} values")
                pdf[out_col] = [list(map(float, v)) for v in vecs]
                yield pdf
        return df.mapInPandas(run, schema)
    return encode


def placed_encoder(with_texts: Callable[[DataFrame], DataFrame], encoder: Encoder) -> Encoder:
    """An encoder of rows whose texts are kept elsewhere: `with_texts` adds them to the rows that are encoded."""
    return lambda df, text_col, out_col: encoder(with_texts(df), text_col, out_col)


def embed(df: DataFrame, text_col: str = "text", out_col: str = "embedding", encoder: Encoder | None = None) -> DataFrame:
    """Add a vector column computed from the whole text."""
    enc = encoder or hashing_encoder()
    return enc(df, text_col, out_col)


def pending_chains(chains: DataFrame, embeddings: DataFrame, keys: Sequence[str] = ("chat_id", "last_message_id")) -> DataFrame:
    """Chains without an embedding (no row, or a null vector)."""
    have = embeddings.filter(F.col("embedding").isNotNull()).select(*keys)
    return chains.join(have, list(keys), "left_anti")


def channel_responses(chains: DataFrame, chat_ids: DataFrame, min_len: int = 5) -> DataFrame:
    """Chains of the given chats, sent by the linked chat and longer than `min_len`."""
    return (chains.join(chat_ids.select("chat_id"), "chat_id", "left_semi")
            .filter(F.col("sent_by_linked_chat") & (F.col("chain_len") > min_len)))


def append_embeddings(store: DataFrame, new: DataFrame, dim: int,
                      keys: Sequence[str] = ("chat_id", "last_message_id")) -> DataFrame:
    """Append vectors of the right dimension whose key is not stored with a vector yet.
    Of repeated keys the smallest vector (by values) is taken, so that a retry appends the same row."""
    rest = [c for c in new.columns if c not in keys]
    row = F.struct("embedding", *[c for c in rest if c != "embedding"])
    ok = (new.filter(F.size("embedding") == dim).groupBy(*keys).agg(F.min(row).alias("_row"))
          .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*new.columns))
    fresh = pending_chains(ok, store, keys)
    kept = store.join(fresh.select(*keys), list(keys), "left_anti")  # a null-vector row is replaced
    return kept.unionByName(fresh.select(*store.columns))


def embed_pending(chains: DataFrame, store: DataFrame, dim: int, encoder: Encoder | None = None,
                  text_col: str = "chain", keys: Sequence[str] = ("chat_id", "last_message_id")) -> DataFrame:
    """One idempotent incremental step: pending (J05) -> encode (V03) -> append.

    Running it again on its own output finds nothing pending and returns the
    same table.
    """
    from ..session import cut_lineage
    todo = pending_chains(chains, store, keys).filter(F.col(text_col).isNotNull())
    vec = embed(todo.select(*keys, text_col), text_col, "embedding", encoder or hashing_encoder(dim))
    # the encoded batch is read twice by the append: materialise it once
    vec = cut_lineage(vec.select(*keys, "embedding"))
    return append_embeddings(store, vec, dim, keys)
