"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of `window` consecutive words of every benchmark item
(an item with fewer words, but not none, is one window).  Per pattern length a
shift table over two-word blocks tells how far the search position may jump; a
block with shift 0 leads to the bucket of patterns that end in it, the bucket
is narrowed by the patterns' first block, and the remaining patterns are
compared with the text word by word.

Scale: the patterns are a stated query set.  They are cut by hash into blocks of
a checked size, and each block is one narrow pass over the documents (no
shuffle), written to the shared folder before the next; one block is enough for ordinary benchmarks.

Defined cases: a null or empty text has no words, no hits and is not
contaminated; items without words give no window; repeated items and windows
count once per item id; words in a window of an item without an id are hit, but the item is in no
list; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, staged

WINDOW = 10
#: Bytes of patterns sent to the tasks at once; more patterns take more passes.
BLOCK_BYTES = 32_000_000

#: ASCII letters (folded) and digits stay, every other ASCII byte separates words.
_SEPARATE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def benchmark_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").translate(_SEPARATE).split() if text else []


class WuManber:
    """Search for word sequences of one length in a word list."""

    def __init__(self, patterns: Sequence[tuple[bytes, ...]]):
        self.length = m = len(patterns[0])
        self.block = b = min(2, m)
        self.far = m - b + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for i, p in enumerate(patterns):
            for end in range(b, m + 1):
                key = p[end - b:end]
                jump = m - end
                if jump < self.shift.get(key, self.far):
                    self.shift[key] = jump
            self.buckets.setdefault(p[m - b:], {}).setdefault(p[:b], []).append((p, i))

    def search(self, words: list[bytes]) -> list[tuple[int, int]]:
        """All occurrences as (start, pattern index)."""
        found = []
        m, b, far, shift = self.length, self.block, self.far, self.shift.get
        end, n = m, len(words)
        while end <= n:
            key = (words[end - 2], words[end - 1]) if b == 2 else (words[end - 1],)
            jump = shift(key, far)
            if jump:
                end += jump
                continue
            start = end - m
            for p, i in self.buckets[key].get(tuple(words[start:start + b]), ()):
                if tuple(words[start:end]) == p:
                    found.append((start, i))
            end += 1
        return found


class PatternSet:
    """Searchers by pattern length, with the items that hold each pattern."""

    def __init__(self, pairs: Sequence[tuple[str, str]]):
        items: dict[tuple[bytes, ...], list[str]] = {}
        for window, item in pairs:
            items.setdefault(tuple(window.encode("utf-8", "surrogatepass").split(b" ")), []).append(item)
        by_length: dict[int, list] = {}
        for p in sorted(items):
            by_length.setdefault(len(p), []).append(p)
        self.groups = [(WuManber(ps), [items[p] for p in ps]) for _, ps in sorted(by_length.items())]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        spans, items = [], set()
        for searcher, owners in self.groups:
            for start, i in searcher.search(words):
                spans.append((start, start + searcher.length))
                items.update(owners[i])
        return spans, items


def union_spans(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint spans covering the same positions."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (window, item_id): space-joined words of every window of every item."""
    def cut(texts):
        rows = []
        for t in texts:
            w = benchmark_words(t)
            rows.append([b" ".join(w[i:i + window]).decode("utf-8", "surrogatepass")
                         for i in range(max(1, len(w) - window + 1))] if w else [])
        return {"_windows": rows}

    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("_text"))
    return (map_texts(items, "_text", cut, "_windows array<string>", drop_text=True)
            .select(F.explode("_windows").alias("window"), "item_id").distinct())


def pattern_blocks(windows: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str | None]]]:
    """The windows in blocks of about `block_bytes`, dealt by hash (each block is
    collected alone, so what the driver holds has a checked size)."""
    size = windows.agg(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 64)).first()[0] or 0
    n = max(1, -(-int(size) // block_bytes))
    for k in range(n):
        part = windows if n == 1 else windows.filter(F.pmod(F.xxhash64("window", "item_id"), F.lit(n)) == k)
        yield [(r["window"], r["item_id"]) for r in part.collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` with `n_words`, `hit_spans` (disjoint word ranges, end exclusive) and
    `hit_items` (ids of the items with occurring windows, sorted as strings)."""
    windows = benchmark_windows(benchmark, window=window)
    out = None
    for pairs in pattern_blocks(windows, block_bytes):
        patterns = PatternSet(pairs)

        def scan(texts, patterns=patterns):
            n, spans, items = [], [], []
            for t in texts:
                w = benchmark_words(t)
                s, i = patterns.hits(w)
                n.append(len(w))
                spans.append([{"start": a, "end": b} for a, b in union_spans(s)])
                items.append(sorted(x for x in i if x is not None))
            return {"n_words": n, "_spans": spans, "_items": items}

        # further blocks add their spans and items to those found so far, row by row
        # (written in between: no task and no plan holds the patterns of two blocks)
        src = docs if out is None else staged(out, "decontamination").withColumnsRenamed({"_spans": "_spans0", "_items": "_items0"})
        got = map_texts(src, text_col, scan, "n_words long, _spans array<struct<start:int,end:int>>, _items array<string>")
        if out is not None:
            got = (got.withColumn("_spans", F.concat("_spans0", "_spans")).withColumn("_items", F.array_union("_items0", "_items"))
                   .drop("_spans0", "_items0"))
        out = got
    merged = F.aggregate(
        F.array_sort("_spans"), F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
                              F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                                       F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                                                        F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))))
    return (out.withColumn("hit_spans", F.when(F.size("_spans") < 2, F.col("_spans")).otherwise(merged))
            .withColumn("hit_items", F.array_sort("_items")).drop("_spans", "_items"))


def digest(found: DataFrame) -> DataFrame:
    """Query columns from `find_contamination`."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]).cast("long"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
                        (F.size("hit_spans") > 0).alias("contaminated"))
