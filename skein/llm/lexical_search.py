"""Ranked lexical search: the best documents of every item by the Best Position Algorithm.

Method.  The documents' texts become index blocks: the postings (document, occurrences) of the
terms that the items ask for, per term, with every document's number of terms.  From the blocks
come the number of documents and terms and each term's number of documents.  In a block, the impact
list of a term holds its documents by falling impact.  An item reads its lists side by side from
the top; each document met is looked up in all other lists by direct access, which gives its whole
score and its position there.  A list's best position ends the run of positions from the top that
have been met in either way.  What has not been met stands behind it in every list, so it cannot
score more than the sum of the impacts behind the best positions, which is below the sum at the
positions read last.  An item stops when that sum is strictly below its tenth best score; equal
sums go on, since the smaller id wins a tie.

Scale.  Documents are never shuffled: a block is made and searched where its texts are read, and
only the ten best of an item and task meet.  The best scores go on from block to block of a task,
so later blocks stop at once.  A frequent term's list is cut by blocks, never gathered.  Blocks
are written to the shared folder once and read twice (counts, search).  Items are taken in groups
of at most about `GROUP_TERMS` (item, term) pairs; the terms of a group and their weights go to
every task, and the documents are read once for each group.

Defined cases.  Null and empty texts have no terms and are no documents of the counts; an item
without terms, or whose documents all score 0, has no rows; rows of one item id (null is one) form
one item with the terms of all; rows of one document id are documents of their own; among equal
scores a null id comes last.  Empty tables give no rows.  Extra columns are not read."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, staged, text_chunks

#: Results an item gets.
TOP = 10
#: (item, term) pairs of one group of items, all of which a task holds.
GROUP_TERMS = 500_000
#: Postings or documents after which an index block is closed.
BLOCK_POSTINGS = 2_000_000
BLOCK_DOCS = 100_000
#: Positions read from each list in the first round; every round reads twice as many, up to the last.
FIRST_STEP, LAST_STEP = 16, 1024

#: Everything but letters, digits and bytes of other scripts parts terms; A-Z are lower-cased.
_TERM_BYTES = bytearray(b" " * 128 + bytes(range(128, 256)))
for _b in b"0123456789" + ASCII_LOWER:
    _TERM_BYTES[_b] = _b
for _u, _l in zip(ASCII_UPPER, ASCII_LOWER):
    _TERM_BYTES[_u] = _l
TERM_TABLE = bytes(_TERM_BYTES)

INDEX = ("n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, terms array<int>, sizes array<int>, "
         "post_docs array<int>, post_tfs array<int>")


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order: maximal runs of digits, letters and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(TERM_TABLE).split() if text else []


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct `item_id, term` (UTF-8 bytes)."""
    rows = items.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in text_chunks(batch.column(1)):
                found = [list(dict.fromkeys(terms_of(t))) for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(texts)), pa.array(found, pa.list_(pa.binary()))],
                                                 names=["item_id", "terms"])

    found = rows.mapInArrow(run, f"item_id {kind}, terms array<binary>")
    return found.select("item_id", F.explode("terms").alias("term")).distinct()


class BlockWriter:
    """Collects documents' term counts and gives them out as index blocks."""

    def __init__(self, terms: dict[bytes, int]):
        self.ids_of = terms
        self.clear()

    def clear(self) -> None:
        self.n_docs = self.n_terms = self.postings = 0
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.keys: list[np.ndarray] = []
        self.tfs: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: str | None) -> None:
        words = terms_of(text)
        if not words:
            return
        self.n_docs += 1
        self.n_terms += len(words)
        get = self.ids_of.get
        known = [i for i in map(get, words) if i is not None]
        if known:
            found, tf = np.unique(np.array(known, np.int64), return_counts=True)
            self.keys.append((found << 32) + len(self.doc_ids))
            self.tfs.append(tf)
            self.doc_ids.append(doc_id)
            self.lengths.append(len(words))
            self.postings += len(found)

    def full(self) -> bool:
        return self.postings >= BLOCK_POSTINGS or len(self.doc_ids) >= BLOCK_DOCS

    def close(self) -> pa.RecordBatch:
        keys = np.concatenate([np.empty(0, np.int64), *self.keys])
        tfs = np.concatenate([np.empty(0, np.int64), *self.tfs])
        order = np.argsort(keys, kind="stable")
        keys, tfs = keys[order], tfs[order]
        terms, sizes = np.unique(keys >> 32, return_counts=True)
        lists = [(self.doc_ids, pa.int64()), (self.lengths, pa.int64()), (terms, pa.int32()), (sizes, pa.int32()),
                 (keys & 0xFFFFFFFF, pa.int32()), (tfs, pa.int32())]
        arrays = [pa.array([self.n_docs], pa.int64()), pa.array([self.n_terms], pa.int64())]
        for values, kind in lists:
            flat = pa.array(values, kind)
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        self.clear()
        return pa.RecordBatch.from_arrays(arrays, names=[f.split(" ")[0] for f in INDEX.split(", ")])


def index_blocks(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """One row per index block of `docs` (`doc_id, text`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = BlockWriter(terms)
        for batch in batches:
            for a, texts in text_chunks(batch.column(1)):
                for doc_id, text in zip(batch.column(0).slice(a, len(texts)).to_pylist(), texts.to_pylist()):
                    block.add(doc_id, text)
                    if block.full():
                        yield block.close()
        if block.n_docs:
            yield block.close()

    return docs.mapInArrow(run, INDEX)


@dataclass
class Best:
    """The best results of an item so far, best first."""
    scores: np.ndarray
    doc_ids: np.ndarray
    no_id: np.ndarray

    @classmethod
    def none(cls) -> Best:
        return cls(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))

    def with_new(self, scores: np.ndarray, doc_ids: np.ndarray, no_id: np.ndarray, top: int) -> Best:
        s, d, n = (np.concatenate(x) for x in ((self.scores, scores), (self.doc_ids, doc_ids), (self.no_id, no_id)))
        order = np.lexsort((d, n, -s))[:top]
        return Best(s[order], d[order], n[order])


class Block:
    """A block's impact lists: postings by (term, document) for direct access and by falling impact."""

    def __init__(self, row: dict[str, pa.Array], n_all: int, l_all: int):
        ids = row["doc_ids"]
        self.no_id = np.asarray(ids.is_null())
        self.doc_ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        # Python integers: 90 * n * N may exceed 64 bits
        m = np.array([10 + 90 * n * n_all // l_all for n in row["lengths"].to_pylist()], np.int64)
        self.terms, sizes, docs, tf = (row[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "sizes", "post_docs", "post_tfs"))
        self.size = len(m)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        lists = np.repeat(np.arange(len(sizes)), sizes)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[docs])
        order = np.lexsort((docs, -impact, lists))
        self.keys, self.impact = lists * self.size + docs, impact
        self.falling, self.falling_docs = impact[order], docs[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))

    def best(self, terms: np.ndarray, weights: np.ndarray, so_far: Best, top: int) -> Best:
        """`so_far` with the block's documents of an item with `terms` (ascending) and their `weights`."""
        at = np.searchsorted(self.terms, terms)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == terms[here]
        here &= weights > 0
        lists, weights = at[here], weights[here]
        if not len(lists):
            return so_far
        starts, ends = self.starts[lists], self.ends[lists]
        met = [np.zeros(e - s, bool) for s, e in zip(starts.tolist(), ends.tolist())]
        known = np.zeros(self.size, bool)
        best_at = starts.copy()  # behind the best position: the first not yet met
        step = FIRST_STEP
        while True:
            open_ = best_at < ends
            bound = int((weights[open_] * self.falling[best_at[open_]]).sum())
            if bound <= 0 or (len(so_far.scores) >= top and bound < so_far.scores[top - 1]):
                return so_far
            # sorted access: the next positions of every list
            read = np.concatenate([self.falling_docs[a:min(a + step, e)] for a, e in zip(best_at[open_].tolist(), ends[open_].tolist())])
            docs = np.unique(read[~known[read]])
            known[docs] = True
            # direct access: their places and impacts in all lists
            want = lists[None, :] * self.size + docs[:, None]
            found = np.searchsorted(self.keys, want)
            hit = found < len(self.keys)
            hit[hit] = self.keys[found[hit]] == want[hit]
            impacts = np.where(hit, self.impact[np.where(hit, found, 0)], 0)
            scores = impacts @ weights
            for j, flags in enumerate(met):
                flags[self.place[found[hit[:, j], j]] - starts[j]] = True
                seen = flags[best_at[j] - starts[j]:]
                gap = int(seen.argmin()) if len(seen) else 0
                best_at[j] += len(seen) if len(seen) and seen[gap] else gap
            good = scores > 0
            if len(so_far.scores) >= top:
                good &= scores >= so_far.scores[top - 1]
            if good.any():
                so_far = so_far.with_new(scores[good], self.doc_ids[docs[good]], self.no_id[docs[good]], top)
            step = min(2 * step, LAST_STEP)


def search_blocks(index: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], n_all: int, l_all: int, top: int) -> DataFrame:
    """`query, doc_id, score`: the best of every task for each query (terms ascending, weights)."""
    names = index.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best.none() for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({c: batch.column(names.index(c))[i].values for c in names[2:]}, n_all, l_all)
                if block.size:
                    best = [block.best(terms, weights, b, top) for (terms, weights), b in zip(queries, best)]
        for q, b in enumerate(best):
            if len(b.scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.scores), q), pa.int32()), pa.array(b.doc_ids, pa.int64(), mask=b.no_id),
                                                  pa.array(b.scores, pa.int64())], names=["query", "doc_id", "score"])

    return index.mapInArrow(run, "query int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = TOP, group_terms: int = GROUP_TERMS) -> DataFrame:
    """`item_id, rank, doc_id, score`: the `top` best documents of every item with a score above 0."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pairs = staged(item_terms(items, item_col, item_text_col), "search-terms")
    groups = -(-pairs.count() // group_terms)
    found = [_search_group(texts, pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g), top) for g in range(groups)]
    if not found:
        kind = pairs.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _search_group(texts: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    """The items of one group, whose (item, term) pairs are of a checked number."""
    rows = pairs.collect()
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    index = staged(index_blocks(texts, vocabulary), "search-index")
    totals = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    held = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy("x.terms").agg(F.sum("x.sizes").alias("df")).collect()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in held:
        weight[r["terms"]] = math.floor(1000 * math.log((2 * totals["n"] + 2) / (2 * r["df"] + 1)))
    items: dict = {}
    for r in rows:
        items.setdefault(r["item_id"], []).append(vocabulary[bytes(r["term"])])
    queries = [(t, weight[t]) for t in (np.array(sorted(ids), np.int64) for ids in items.values())]
    best = search_blocks(index, queries, totals["n"], totals["l"], top)
    by_item = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= top)
    kind = pairs.schema["item_id"].dataType.simpleString()
    names = texts.sparkSession.createDataFrame(list(enumerate(items)), f"query int, item_id {kind}")
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
