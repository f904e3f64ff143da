"""SimHash near-duplicates with bit-sliced comparison.

A document's fingerprint has a bit set where more than half of the XXH64 values of
its word shingles have it.  Two fingerprints within `radius` bits are linked, and
the components of the links are the near-duplicate groups.

Candidates (exact): the 64 bits are cut into `radius + 2` pieces; fingerprints within
the radius agree on at least two whole pieces, so each distinct fingerprint goes
to one bucket per pair of pieces.  Only buckets with two or more fingerprints go on,
and a large bucket is dealt into chunks whose pairs are separate units of work, so
no task ever holds an unbounded group.

Comparison: the fingerprints of a unit are stored vertically, one bit plane per
fingerprint bit.  Distances of all pairs grow together in carry-save counters
(ones, twos, over), plane by plane; a block of rows is abandoned once all its
distances exceed the radius.  A unit reports its links as stars around local minima,
at most one row per fingerprint, never all pairs; the distributed components are
those of the full link graph.

Defined cases: a null, empty or blank text has fingerprint zero and is linked like
any other; a text with fewer words than a shingle is one shingle; equal texts share
a fingerprint; rows with a null id are left out; repeated ids with different texts
keep one row each with their own fingerprint, and the id joins their components.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import map_texts, staged, text_table, words_of

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Largest number of fingerprints of one bucket in a chunk.
CHUNK = 2048
#: Small buckets are compared together up to about this many rows.
BLOCK_ROWS = 1024
#: Planes between two checks whether rows can be abandoned.
STRIDE = 8

#: 256 x 8 table: the bits of each byte value.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles, repeats included."""
    from xxhash import xxh64_intdigest
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        starts = [0]
        at = 0
        for w in words:
            at += len(w) + 1
            starts.append(at)
        hashes = [xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[shingle:])]
    by_byte = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    if n < 4096:
        counts = np.unpackbits(by_byte, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(by_byte[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, drop_text: bool = True) -> DataFrame:
    """`docs` with `fp`, the fingerprint as a signed long."""
    def run(texts):
        return {"fp": np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)}

    return map_texts(docs, text_col, run, "fp long", drop_text=drop_text)


def close_pairs(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Bit matrix (rows x packed columns, little bit order) of the pairs within the radius.

    Carry-save counting up to `radius` (at most 3) with saturation in `over`."""
    if not 0 <= radius <= 3:
        raise ValueError("the two-bit carry-save counter holds distances up to 3")
    n = len(fps)
    lanes = -(-n // 64)
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = np.zeros((64, lanes * 64), np.uint8)
    planes[:, :n] = bits.T
    packed = np.packbits(planes, axis=1, bitorder="little").view("<u8")  # one row of lanes per fingerprint bit
    flip = np.where(bits.T == 1, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))  # a query's own bit, spread over a lane
    result = np.zeros((n, lanes), "<u8")
    real = np.packbits((np.arange(lanes * 64) < n), bitorder="little").view("<u8")
    rows = np.arange(n)
    ones = np.zeros((n, lanes), "<u8")
    twos, over = ones.copy(), np.broadcast_to(~real, (n, lanes)).copy()
    for p in range(64):
        d = packed[p][None, :] ^ flip[p][rows][:, None]
        carry = ones & d
        ones ^= d
        over |= twos & carry
        twos ^= carry
        if p % STRIDE == STRIDE - 1:
            live = ~(over == np.uint64(0xFFFFFFFFFFFFFFFF)).all(axis=1)
            if not live.all():  # abandon the rows that have no distance within the radius left
                rows, ones, twos, over = rows[live], ones[live], twos[live], over[live]
                if not len(rows):
                    return result
    if radius == 2:
        over |= ones & twos
    elif radius == 1:
        over |= twos
    elif radius == 0:
        over |= ones | twos
    result[rows] = ~over
    return result


def local_stars(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links of a block of distinct fingerprints as (fingerprint, local minimum)."""
    close = close_pairs(fps, radius)
    n = len(fps)
    signed = fps.view(np.int64)
    waiting = np.unpackbits(close.view(np.uint8), axis=1, bitorder="little", count=n).sum(axis=1, dtype=np.int64) > 1
    stars = []
    for first in np.flatnonzero(waiting):
        if not waiting[first]:
            continue
        member = np.zeros(n, bool)
        member[first] = True
        fresh = np.array([first])
        while len(fresh):
            reach = np.unpackbits(np.bitwise_or.reduce(close[fresh], axis=0).view(np.uint8), bitorder="little", count=n).astype(bool)
            fresh = np.flatnonzero(reach & ~member)
            member |= reach
        waiting[member] = False
        group = signed[member]
        least = int(group.min())
        stars.extend((int(x), least) for x in group if x != least)
    return stars


def pieces(radius: int) -> list[tuple[int, int]]:
    """Bit ranges (start, length) of the `radius + 2` pieces."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def buckets(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`(bucket, fp)`: one row per fingerprint and pair of pieces."""
    def part(start, length):
        return F.shiftrightunsigned("fp", start).bitwiseAND((1 << length) - 1)

    keys = []
    for t, ((s1, l1), (s2, l2)) in enumerate(combinations(pieces(radius), 2)):
        keys.append(F.lit(t << 56).cast("long") + F.shiftleft(part(s1, l1), 28) + part(s2, l2))
    return fps.select(F.explode(F.array(*keys)).alias("bucket"), "fp")


def links(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """`(src, dst)`: stars that connect exactly the fingerprints linked within the radius.
    `fps` holds distinct `fp`."""
    rows = buckets(fps, radius)
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    rows = rows.join(sizes, "bucket")
    # a bucket of c chunks becomes the units (i, j), i <= j: chunk k goes to all units that name it
    count = F.ceil(F.col("size") / chunk).cast("int")
    mine = F.pmod(F.xxhash64("fp"), count).cast("int")
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    units = rows.withColumn("chunks", count).withColumn("mine", mine).select(
        "bucket", "fp", F.explode(F.transform(others, lambda o: F.struct(
            F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j")))).alias("unit"))
    units = (units.select("bucket", F.col("unit.i").alias("i"), F.col("unit.j").alias("j"), "fp")
             .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 4), np.int64)

        def report(block: np.ndarray) -> Iterator[pa.RecordBatch]:
            stars = local_stars(np.unique(block[:, 3]).view(np.uint64), radius)
            if stars:
                src, dst = zip(*stars)
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

        for batch in batches:
            held = np.concatenate([held, np.column_stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])])
            # cut only where the unit changes; the last unit may go on in the next batch
            ends = np.flatnonzero((held[1:, :3] != held[:-1, :3]).any(axis=1)) + 1
            start = 0
            for k, end in enumerate(ends):
                following = ends[k + 1] if k + 1 < len(ends) else None
                if end - start >= BLOCK_ROWS or following is None or following - start > 2 * BLOCK_ROWS:
                    yield from report(held[start:end])
                    start = end
            held = held[start:]
        if len(held):
            yield from report(held)

    return units.mapInArrow(compare, "src long, dst long")


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """`(doc_id, fp)` of every row with an id, and `(fp, least_id, root)`: the smallest id and the component of each fingerprint."""
    prints = staged(fingerprints(text_table(docs, id_col, text_col).filter("doc_id is not null"), shingle=shingle), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    parts = connected_components(links(distinct.select("fp"), radius))
    root = F.coalesce("component", "fp")
    return prints, distinct.join(parts, distinct["fp"] == parts["node"], "left").select("fp", "least_id", root.alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """`(doc_id, fp, component_id)`, one row per row of `docs` with an id."""
    prints, named = _classes(docs, id_col, text_col, shingle, radius)
    # class representatives: the smallest id of each fingerprint, then of its component
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = named.join(ids, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs` that represent their group: the row with the smallest id, then fingerprint.
    Rows without an id stay; rows with one id stay one each if they are of different groups."""
    _, named = _classes(docs, id_col, text_col, shingle, radius)
    stay = named.groupBy("root").agg(F.min(F.struct("least_id", "fp")).alias("r")).select(
        F.col("r.least_id").alias("_kept_id"), F.col("r.fp").alias("_kept_fp"))

    def own(texts):
        return {"_own_fp": np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)}

    rows = map_texts(docs.filter(F.col(id_col).isNotNull()), text_col, own, "_own_fp long")
    kept = rows.join(stay, (rows[id_col] == F.col("_kept_id")) & (rows["_own_fp"] == F.col("_kept_fp")), "left_semi")
    # the join has dealt the rows by both, so repeated rows need no further shuffle
    kept = kept.dropDuplicates([id_col, "_own_fp"]).select(*docs.columns)
    return kept.unionByName(docs.filter(F.col(id_col).isNull()))


def hex_print(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))
