"""Language-model scoring with a probabilistic suffix tree over words.

Model.  Symbols are the words seen at least `min_symbol` times in training and the
end of a text; all rarer and unknown words share one symbol and split its mass by
their base probabilities.  A context (the last 1 .. `depth` words) is a candidate if
it was followed at least `min_context` times, whatever the size of the corpus (a
caller may set shares of the training tokens besides).  It is retained if its next-symbol
distribution diverges from its suffix's: the log-likelihood that its leave-one-out
counts gain over the suffix's smoothed distribution must reach `min_gain` nats, and
its suffix must be retained, so the states form a tree.  Next-symbol distributions
are smoothed towards the suffix (Witten-Bell: N followers of T kinds give
`(c + T * p_suffix) / (N + T)`), down to the base distribution
`(c + 0.1) / (N + 0.1 * (V + 1))`.  A token is scored by the longest suffix of the
words before it that is a state.

Jobs.  The model grows with the corpus and is never broadcast.  Texts are cut into
blocks (whole documents, about `BLOCK_CHARS`), each written once as a small file in
the session's shared folder.  A level counts like this: every block sends each of
its distinct keys once, with its training count, packed by range of keys; a task
sums one range over all blocks and answers each block's packet in order.  A key
occurs at most once per block, so no key is hot however frequent the word.  The
answers come back grouped by block and are written beside its file; with them the
block goes on to the next level, and at last scores its documents.  Every level is
in the shared folder before it is used, so lost executors repeat only their own tasks.

Keys.  Words are identified by their 64-bit hash, ranges of words by its upper bits.
The answers number the symbols and the frequent pairs: range * width + rank in the
range, where the width is the largest range's.  A pair's key is context number *
symbols + symbol number (exact, `check_width`), and its range is its context's, so
that near keys lie together and take two to three bytes each; the pairs of a context
with more followers than a range has on average are dealt by symbol over as many
ranges as it fills.

Defined cases: a null or empty text has
the end token only; documents without an id train and are not held out; repeated
rows count each time; with no training rows every token has probability 1 under
the base distribution (its one class holds all mass).
"""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type, in_training, scratch, text_chunks, words_of
from .token_files import _file_system, _make_folder

MODULUS = 10
DEPTH = 2
MIN_SYMBOL = 8
MIN_CONTEXT = 16
#: No shares: the model grows with the corpus, only the divergence test ends it.
SYMBOL_SHARE = 0.0
CONTEXT_SHARE = 0.0
MIN_GAIN = 5.0
#: Characters of text per block, and bytes of text per range of keys.
BLOCK_CHARS = 12_000_000
RANGE_BYTES = 24_000_000

#: Symbol numbers of all rarer words together and of the end of a text; others follow.
_RARE, _END, _SYMBOLS = 0, 1, 2
#: Words of a block found so often take the lowest codes.
_OFTEN = 4
_END_WORD = b""
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PACKET = "level int, part int, file string, keys binary, stats binary, n long"
ANSWER = ("level int, part int, file string, totals binary, extra binary, ranks binary, "
          "n_keys long, n_sum long, n_rare_keys long, n_rare_sum long, width long")
TAKEN = "file string, n_keys long, n_sum long, n_rare_keys long, n_rare_sum long, width long"


@dataclass(frozen=True)
class Settings:
    depth: int = DEPTH
    min_symbol: int = MIN_SYMBOL
    min_context: int = MIN_CONTEXT
    min_gain: float = MIN_GAIN
    symbol_share: float = SYMBOL_SHARE
    context_share: float = CONTEXT_SHARE

    def at(self, tokens: int) -> Settings:
        """The counts that the shares mean for a corpus of `tokens`."""
        return replace(self, min_symbol=max(self.min_symbol, math.ceil(self.symbol_share * tokens)),
                       min_context=max(self.min_context, math.ceil(self.context_share * tokens)))


# -- packing ------------------------------------------------------------------
def planes(a: np.ndarray) -> bytes:
    """Bytes of an array by significance, so that small values compress well."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def unplanes(b: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


def squeeze(b: bytes) -> bytes:
    """Bytes with their length, compressed: most counts are small and most kinds few."""
    return len(b).to_bytes(8, "little") + pa.compress(b, codec="zstd", asbytes=True)


def unsqueeze(b: bytes) -> bytes:
    return pa.decompress(b[8:], decompressed_size=int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True)


def pack_keys(keys: np.ndarray) -> bytes:
    return squeeze(planes(np.diff(keys, prepend=np.uint64(0))))


def unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unplanes(unsqueeze(b), "<u8"), dtype=np.uint64)


def distinct_places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct values and the place of each value among them, as `np.unique` gives, in less memory."""
    order = np.argsort(values).astype(np.int32)
    ranked = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    place = np.empty(len(values), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return ranked[new], place


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Range of each key; ascending with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def packet_rows(level: int, file: str, keys: np.ndarray, stats: list[np.ndarray], part: np.ndarray) -> list[tuple]:
    """Packets of distinct keys, ascending by range and in it; `stats` has one array per statistic.  Word
    packets carry the sum of their counts."""
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    return [(level, int(part[a]), file, pack_keys(keys[a:b].astype(np.uint64)),
             squeeze(b"".join(planes(np.ascontiguousarray(s[a:b])) for s in stats)),
             int(stats[0][a:b].sum()) if level == 0 else 0)
            for a, b in zip(cuts[:-1], cuts[1:])]


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, schema.types)], schema=schema)


PACKET_ARROW = pa.schema([("level", pa.int32()), ("part", pa.int32()), ("file", pa.string()), ("keys", pa.binary()), ("stats", pa.binary()),
                          ("n", pa.int64())])
ANSWER_ARROW = pa.schema([("level", pa.int32()), ("part", pa.int32()), ("file", pa.string()), ("totals", pa.binary()), ("extra", pa.binary()),
                          ("ranks", pa.binary()), *((n, pa.int64()) for n in ("n_keys", "n_sum", "n_rare_keys", "n_rare_sum", "width"))])
TAKEN_ARROW = pa.schema([("file", pa.string()), *((n, pa.int64()) for n in ("n_keys", "n_sum", "n_rare_keys", "n_rare_sum", "width"))])


# -- blocks -------------------------------------------------------------------
def write_fields(folder: str, name: str, fields: dict[str, bytes]) -> None:
    """A file of the shared folder; it appears whole, and a task that runs twice writes the same."""
    row = pa.RecordBatch.from_arrays([pa.array([v], pa.large_binary()) for v in fields.values()], [*fields])
    system, path = _file_system(folder)
    with system.open_output_stream(draft := f"{path}/{name}.{uuid.uuid4().hex}") as out, pa.ipc.new_stream(out, row.schema) as w:
        w.write_batch(row)
    try:
        system.move(draft, f"{path}/{name}")
    except OSError:  # the other run was first
        system.delete_file(draft)
        if system.get_file_info(f"{path}/{name}").type != pa.fs.FileType.File:
            raise


def read_fields(folder: str, name: str) -> dict[str, bytes]:
    system, path = _file_system(folder)
    with system.open_input_stream(f"{path}/{name}") as f:
        row = pa.ipc.open_stream(f).read_next_batch()
    return {n: row.column(i)[0].as_py() for i, n in enumerate(row.schema.names)}


class Block:
    """Whole documents as word codes.  Frequent words of the block have the lowest codes, the others follow
    by hash; `order` has the codes in order of their words' hashes.  The hashes are sent and not kept."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, train: np.ndarray, order: np.ndarray, ids: pa.Array,
                 hashes: np.ndarray | None = None):
        self.codes, self.lengths, self.train, self.order, self.ids, self.hashes = codes, lengths, train, order, ids, hashes

    @classmethod
    def of(cls, rows: list[tuple[object, str | None, bool]], id_type: pa.DataType) -> Block:
        from xxhash import xxh64_intdigest
        known: dict[bytes, int] = {}
        found, lengths = [], []
        for _, text, _ in rows:
            words = words_of(text)
            words.append(_END_WORD)
            found.append(np.array([known.setdefault(w, len(known)) for w in words], np.int32))
            lengths.append(len(words))
        codes = np.concatenate(found)
        hashes = np.fromiter((xxh64_intdigest(w) for w in known), np.uint64, len(known))
        seen = np.bincount(codes, minlength=len(hashes))
        by_code = np.lexsort((hashes, -np.where(seen >= _OFTEN, seen, 0)))
        code = np.empty(len(hashes), np.int32)
        code[by_code] = np.arange(len(hashes))
        hashes = hashes[by_code]
        return cls(code[codes], np.array(lengths, np.int64), np.array([t for _, _, t in rows], bool), np.argsort(hashes),
                   pa.array([i for i, _, _ in rows], id_type), hashes)

    def write(self, folder: str, name: str) -> None:
        ids = pa.ipc.new_stream(sink := pa.BufferOutputStream(), pa.schema([("id", self.ids.type)]))
        ids.write_batch(pa.RecordBatch.from_arrays([self.ids], ["id"]))
        ids.close()
        often = int((np.bincount(self.codes) >= _OFTEN).sum())
        place = np.empty(len(self.order), np.int32)
        place[self.order] = np.arange(len(self.order))
        write_fields(folder, name, {
            "codes": squeeze(planes(self.codes.astype("<i4"))), "lengths": squeeze(planes(self.lengths.astype("<i8"))),
            "train": squeeze(np.packbits(self.train).tobytes()), "words": len(place).to_bytes(8, "little"),
            "places": squeeze(planes(place[:often].astype("<i4"))), "ids": squeeze(sink.getvalue().to_pybytes())})

    @classmethod
    def read(cls, folder: str, name: str) -> Block:
        get = read_fields(folder, name)
        lengths = unplanes(unsqueeze(get["lengths"]), "<i8")
        places = unplanes(unsqueeze(get["places"]), "<i4")
        order = np.full(int.from_bytes(get["words"], "little"), -1, np.int64)
        order[places] = np.arange(len(places))
        order[order < 0] = np.arange(len(places), len(order))
        train = np.unpackbits(np.frombuffer(unsqueeze(get["train"]), np.uint8), count=len(lengths)).astype(bool)
        return cls(unplanes(unsqueeze(get["codes"]), "<i4"), lengths, train, order,
                   pa.ipc.open_stream(unsqueeze(get["ids"])).read_all().column("id").combine_chunks())


@dataclass
class Totals:
    """Corpus-wide figures of the training tokens."""
    tokens: int
    types: int
    rare_tokens: int
    rare_types: int
    #: Ranges of keys, and the most symbols (level 0) or frequent pairs (odd levels) of a range.
    parts: int = 1
    widths: tuple[tuple[int, int], ...] = ()

    def width(self, level: int) -> int:
        return dict(self.widths).get(level, 0)

    @property
    def symbols(self) -> int:
        return self.parts * self.width(0) + _SYMBOLS

    def check_width(self, level: int) -> None:
        """Keys of the next level's pairs must fit 63 bits (contexts times symbols; tens of billions of tokens do)."""
        if self.parts * self.width(level) * self.symbols >= 2 ** 63:
            raise ValueError(f"{self.width(level)} contexts a range of {self.parts} and {self.symbols} symbols: raise min_context or min_symbol")

    @property
    def norm(self) -> float:
        return self.tokens + 0.1 * (self.types + 1)

    @property
    def rare_mass(self) -> float:
        """Base probability of all rarer and unknown words together."""
        return (self.rare_tokens + 0.1 * (self.rare_types + 1)) / self.norm


class Walk:
    """One block's way through the levels that have been answered so far.

    Levels: 0 words; 2d - 1 pairs (context of depth d, symbol); 2d contexts of depth d."""

    def __init__(self, block: Block, answers: dict[int, tuple[np.ndarray, np.ndarray]], totals: Totals, s: Settings):
        self.block, self.answers, self.totals, self.s = block, answers, totals, s
        codes, n, words = block.codes, len(block.codes), len(block.order)
        self.train = np.repeat(block.train, block.lengths)
        self.first = np.zeros(n, bool)
        self.first[np.concatenate(([0], np.cumsum(block.lengths)[:-1])).astype(np.int64)] = True
        # what depends on the word alone is kept per word, not per token
        self.count, number = np.empty((2, words), np.int64)
        self.count[block.order] = answers[0][0]
        number[block.order] = np.arange(words) if answers[0][1] is None else answers[0][1]
        self.base = (self.count + 0.1) / totals.norm
        end = np.zeros(words, bool)
        end[codes[np.cumsum(block.lengths) - 1]] = True  # every document closes with the end
        self.rare = (self.count < s.min_symbol) & ~end
        # within the shared symbol a word keeps its share of the base mass
        self.share = np.where(self.rare, self.base / totals.rare_mass, 1.0)
        self.symbol = np.where(self.rare, _RARE, np.where(end, _END, number + _SYMBOLS))
        self.p = np.where(self.rare, totals.rare_mass, self.base)[codes]
        # number and training count of the context before each token
        self.context, self.weight = np.zeros((2, n), np.int64)
        self.context[1:], self.weight[1:] = number[codes[:-1]], self.count[codes[:-1]]
        self.candidate = np.zeros(n, bool)
        self.candidate[1:] = ~self.first[1:] & ((self.count >= s.min_context) & ~self.rare)[codes[:-1]]

    def home(self, contexts: np.ndarray, depth: int) -> np.ndarray:
        """Range of contexts by their numbers."""
        return contexts // max(self.totals.width(max(2 * depth - 3, 0)), 1)

    def pairs(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of the current depth, their ranges and their training counts."""
        self.at = np.flatnonzero(self.candidate).astype(np.int32)
        symbols = self.totals.symbols
        keys, self.pair_of = distinct_places(self.context[self.at] * symbols + self.symbol[self.block.codes[self.at]])
        weight = np.empty(len(keys), np.int64)
        weight[self.pair_of] = self.weight[self.at]
        spread = np.maximum(-(-weight * self.totals.parts // max(self.totals.tokens, 1)), 1)
        part = (self.home(keys // symbols, depth) + keys % symbols * spread // symbols) % self.totals.parts
        if (part[1:] < part[:-1]).any():
            order = np.argsort(part, kind="stable")
            keys, part, place = keys[order], part[order], np.empty(len(keys), np.int32)
            place[order] = np.arange(len(keys))
            self.pair_of = place[self.pair_of]
        return keys, part, np.bincount(self.pair_of, weights=self.train[self.at], minlength=len(keys)).astype("<i8")

    def contexts(self, depth: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Distinct contexts of the current depth, their ranges and their additive statistics: followers,
        kinds, kinds seen once, and the sum of the divergence test."""
        total, owned = self.answers[2 * depth - 1][:2]
        self.pair_total = total[self.pair_of] if len(total) else np.empty(0, np.int64)
        keys, context_of = distinct_places(self.context[self.at])
        self.context_of = context_of
        # a pair's figures are sent by one block only: its owner
        place, suffix = np.empty(len(total), np.int32), np.empty(len(total))
        place[self.pair_of], suffix[self.pair_of] = context_of, self.p[self.at]
        own, c, suffix = place[owned], total[owned], np.log(suffix[owned])

        def add(values):
            return np.bincount(own, weights=values, minlength=len(keys))

        stats = [*(add(x).astype("<i8") for x in (c, np.ones(len(c)), c == 1)),
                 add(np.where(c >= 2, c * (np.log(np.maximum(c - 1, 1)) - suffix), 0.0))]
        # a state's suffix must be a state too
        self.open = np.ones(len(keys), bool)
        if depth > 1:
            self.open[context_of] = self.state[self.at]
        keys = keys[self.open]
        return keys, self.home(keys, depth), [x[self.open] for x in stats]

    def descend(self, depth: int) -> None:
        """Apply the retained contexts of `depth` to the probabilities."""
        followers, kinds = np.zeros((2, len(self.open)), np.int64)
        followers[self.open], kinds[self.open] = self.answers[2 * depth][:2]
        followers, kinds = followers[self.context_of], kinds[self.context_of]
        kept = followers > 0
        at, n, t = self.at[kept], followers[kept].astype(float), kinds[kept].astype(float)
        self.p[at] = (self.pair_total[kept] + t * self.p[at]) / (n + t)
        self.state = np.zeros(len(self.p), bool)
        self.state[at] = True

    def deepen(self, depth: int) -> None:
        """Contexts of the next depth: the frequent pairs of `depth` that end one word earlier."""
        frequent = (self.pair_total >= self.s.min_context) & ~self.rare[self.block.codes[self.at]]
        frequent &= self.at < len(self.p) - 1
        after = self.at[frequent] + 1
        # what stands at other tokens is not read again
        self.context[after] = self.answers[2 * depth - 1][2][self.pair_of[frequent]]
        self.weight[after] = self.pair_total[frequent]
        candidate = np.zeros(len(self.p), bool)
        candidate[after] = ~self.first[after] & self.candidate[after]
        self.candidate = candidate

    def run(self, step: int) -> list[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Go as far as `step` and return what the block sends then, as (level, keys, ranges, statistics):
        the contexts of depth `step - 1` and the pairs of depth `step`.  After the last step
        nothing is sent and `p` holds the model's probabilities."""
        depth, sent = self.s.depth, []
        for d in range(1, depth + 1):
            keys, part, counts = self.pairs(d)
            if step == d:
                return [*sent, (2 * d - 1, keys, part, [counts])]
            ctx, home, stats = self.contexts(d)
            if step == d + 1:
                sent.append((2 * d, ctx, home, stats))
            else:
                self.descend(d)
            if d < depth:
                self.deepen(d)
        return sent


# -- tasks ---------------------------------------------------------------------
def _by_key(table: pa.Table) -> tuple[list, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Packets of one range in file order; their keys; distinct keys and each entry's place."""
    rows = sorted(table.to_pylist(), key=lambda r: r["file"])
    keys = [unpack_keys(r["keys"]) for r in rows]
    sizes = np.array([len(k) for k in keys])
    distinct, place = distinct_places(np.concatenate(keys))
    return rows, keys, sizes, distinct, place


def _stats(rows: list, sizes: np.ndarray, columns: int) -> np.ndarray:
    """Statistics of all packets, one row per column."""
    parts = []
    for r, n in zip(rows, sizes):
        packed = unsqueeze(r["stats"])
        parts.append(np.stack([unplanes(packed[i * n * 8:(i + 1) * n * 8], "<i8") for i in range(columns)]))
    return np.concatenate(parts, axis=1)


def numbered(level: int, totals: np.ndarray, s: Settings) -> np.ndarray:
    """The words that are symbols, or the pairs that are candidates of the next depth, by their totals."""
    if level == 2 * s.depth - 1:
        return np.zeros(len(totals), bool)
    return totals >= (s.min_context if level else s.min_symbol)


def answer_counts(table: pa.Table, s: Settings) -> pa.Table:
    """Total training count of every key of a range, and the ranks of those that get numbers; one packet owns each key."""
    rows, _, sizes, distinct, place = _by_key(table)
    level = rows[0]["level"]
    counts = _stats(rows, sizes, 1)[0]
    total = np.bincount(place, weights=counts, minlength=len(distinct)).astype("<i8")
    owner = np.zeros(len(place), bool)
    seen = np.flatnonzero(counts > 0)
    _, first = np.unique(place[seen], return_index=True)
    owner[seen[first]] = True
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    known = total > 0
    rare = known & (total < s.min_symbol)
    counted = numbered(level, total, s)
    rank = np.cumsum(counted) - 1
    out = []
    for i, r in enumerate(rows):
        a, b = cuts[i], cuts[i + 1]
        mine = place[a:b]
        figures = (int(known.sum()), int(total.sum()), int(rare.sum()), int(total[rare].sum()), int(counted.sum())) if i == 0 else (0,) * 5
        out.append((level, r["part"], r["file"], squeeze(planes(np.ascontiguousarray(total[mine]))),
                    squeeze(np.packbits(owner[a:b]).tobytes() if level else b""),
                    squeeze(planes(np.diff(rank[mine[counted[mine]]].astype("<u4"), prepend=np.uint32(0)))), *figures))
    return pa.Table.from_batches([as_batch(out, ANSWER_ARROW)])


def answer_contexts(table: pa.Table, s: Settings) -> pa.Table:
    """Followers and kinds of every retained context of a range, 0 for the others."""
    rows, _, sizes, distinct, place = _by_key(table)
    stats = _stats(rows, sizes, 4)
    n, t, once, loo = (np.bincount(place, weights=x, minlength=len(distinct)) for x in (*stats[:3], stats[3].view("<f8")))
    more = n - once
    gain = loo - more * np.log(np.maximum(n + t, 1)) + once * np.log(np.maximum(t, 1) / np.maximum(n + t, 1))
    keep = (n >= s.min_context) & (gain >= s.min_gain)
    followers = np.where(keep, n, 0).astype("<i8")
    kinds = np.where(keep, t, 0).astype("<i8")
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    out = [(r["level"], r["part"], r["file"], squeeze(planes(np.ascontiguousarray(followers[place[a:b]]))),
            squeeze(planes(np.ascontiguousarray(kinds[place[a:b]]))), squeeze(b""),
            len(distinct) if i == 0 else 0, int(keep.sum()) if i == 0 else 0, 0, 0, 0)
           for i, (r, a, b) in enumerate(zip(rows, cuts[:-1], cuts[1:]))]
    return pa.Table.from_batches([as_batch(out, ANSWER_ARROW)])


def take_answers(table: pa.Table, folder: str) -> pa.Table:
    """Write a block's answers beside it, a file per level, in the order of its keys; return their figures."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["level"], r["part"]))
    name = rows[0]["file"]
    for level in sorted({r["level"] for r in rows}):
        mine = [r for r in rows if r["level"] == level]
        totals = [unplanes(unsqueeze(r["totals"]), "<i8") for r in mine]
        extra = [unsqueeze(r["extra"]) for r in mine]
        if level % 2:
            extra = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(t)) for x, t in zip(extra, totals)]
            second = np.packbits(np.concatenate(extra)).tobytes()
        else:
            second = planes(np.concatenate([unplanes(x, "<i8") for x in extra]))
        ranks = [unplanes(unsqueeze(r["ranks"]), "<u4") for r in mine]
        write_fields(folder, f"{name}.{level}", {
            "totals": squeeze(planes(np.concatenate(totals))), "extra": squeeze(second), "ranks": squeeze(planes(np.concatenate(ranks))),
            "parts": squeeze(planes(np.array([r["part"] for r in mine], "<i4"))), "sizes": squeeze(planes(np.array([len(x) for x in ranks], "<i4")))})
    sums = [sum(r[n] for r in rows) for n in TAKEN_ARROW.names[1:-1]]
    return pa.Table.from_batches([as_batch([(name, *sums, max(r["width"] for r in rows))], TAKEN_ARROW)])


def read_answers(folder: str, name: str, levels: int, totals: Totals, s: Settings) -> dict[int, tuple[np.ndarray, ...]]:
    """A block's answers of the first `levels` levels: totals, owner bits or kinds, and numbers (0 where there is none)."""
    system, path = _file_system(folder)
    got: dict[int, tuple[np.ndarray, ...]] = {}
    for level in range(levels):
        if level and system.get_file_info(f"{path}/{name}.{level}").type == pa.fs.FileType.NotFound:
            got[level] = np.empty(0, np.int64), np.empty(0, bool if level % 2 else np.int64), np.empty(0, np.int64)  # it sent no keys
            continue
        get = {n: unsqueeze(v) for n, v in read_fields(folder, f"{name}.{level}").items()}
        total = unplanes(get["totals"], "<i8")
        if level % 2:
            second = np.unpackbits(np.frombuffer(get["extra"], np.uint8), count=len(total)).astype(bool)
        else:
            second = unplanes(get["extra"], "<i8")
        number = np.zeros(len(total), np.int64)
        if level % 2 or not level:
            part, sizes, steps = unplanes(get["parts"], "<i4").astype(np.int64), unplanes(get["sizes"], "<i4"), unplanes(get["ranks"], "<u4")
            # ranks are kept as steps within each range
            rank = np.cumsum(steps, dtype=np.int64)
            ends = np.cumsum(sizes)
            rank -= np.repeat(np.concatenate(([0], rank))[ends - sizes], sizes)
            number[numbered(level, total, s)] = np.repeat(part, sizes) * totals.width(level) + rank
        got[level] = (total, number) if level == 0 else (total, second, number)
    return got


def give_back() -> None:
    """What the last group has freed goes back to the system: the workers take turns, and one that waits would hold it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not glibc


# -- jobs ----------------------------------------------------------------------
def drop_folder(folder: str) -> None:
    """Words were sent and answered; what they were sent in is of no use any more."""
    system, path = _file_system(folder)
    system.delete_dir(path)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when their job ends, not when the driver next collects its garbage."""
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if was is None else spark.conf.set(_CLEANUP, was)


def write_blocks(docs: DataFrame, folder: str, parts: int) -> DataFrame:
    """Write the blocks of `docs` (`doc_id, text, _train`) and return their word packets."""
    id_type = arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            block = Block.of(held, id_type)
            name = f"block-{uuid.uuid4().hex}.arrow"
            block.write(folder, name)
            give_back()
            train = np.repeat(block.train, block.lengths)
            counts = np.bincount(block.codes, weights=train, minlength=len(block.hashes)).astype("<i8")
            order = block.order
            return as_batch(packet_rows(0, name, block.hashes[order], [counts[order]], part_of(block.hashes[order], parts)), PACKET_ARROW)

        for batch in batches:
            for a, texts in text_chunks(batch.column(1)):
                for row in zip(batch.column(0).slice(a, len(texts)).to_pylist(), texts.to_pylist(),
                               batch.column(2).slice(a, len(texts)).to_pylist()):
                    held.append(row)
                    size += len(row[1] or "")
                    if size >= BLOCK_CHARS:
                        yield close()
                        held, size = [], 0
        if held:
            yield close()

    return docs.select("doc_id", "text", "_train").mapInArrow(run, PACKET)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = MODULUS,
          settings: Settings = Settings()) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(in_training(id_col, modulus), F.lit(True)).alias("_train"))
    folder = scratch(spark, "suffix-tree")
    blocks = f"{folder}/blocks"
    _make_folder(spark, blocks)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(16, -(-int(size) // RANGE_BYTES))

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    packets = stored(write_blocks(rows, blocks, parts), "packets0")
    settings = settings.at(packets.agg(F.sum("n")).first()[0] or 0)

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        level = key[0].as_py()
        return answer_contexts(table, settings) if level and level % 2 == 0 else answer_counts(table, settings)

    def take(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return take_answers(table, blocks)

    def answered(packets: DataFrame, name: str) -> tuple[DataFrame, Row]:
        """Write the answers to `packets` beside the blocks; return the blocks that had some, and the figures of all."""
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_keys", "n_sum", "n_rare_keys", "n_rare_sum")]
        with shuffles_end(spark):
            taken = stored(packets.groupBy("level", "part").applyInArrow(answer, ANSWER).groupBy("file").applyInArrow(take, TAKEN), name)
            return taken, taken.agg(*sums, F.coalesce(F.max("width"), F.lit(0)).alias("width"), F.count("file").alias("files")).first()

    files, f = answered(packets, "answers0")
    drop_folder(f"{folder}/packets0")
    totals = Totals(f["n_sum"], f["n_keys"], f["n_rare_sum"], f["n_rare_keys"], parts, ((0, f["width"]),))
    totals.check_width(0)
    files = files.select("file").repartition(max(f["files"], 1))

    def walked(name: str, step: int, totals: Totals) -> tuple[Walk, list]:
        """The way of a block up to `step`, and what it sends then."""
        give_back()
        levels = 1 if step == 1 else min(2 * step - 2, 2 * settings.depth + 1)
        walk = Walk(Block.read(blocks, name), read_answers(blocks, name, levels, totals, settings), totals, settings)
        return walk, walk.run(step)

    def sender(step: int, totals: Totals):
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for name in (x for batch in batches for x in batch.column(0).to_pylist()):
                sent = walked(name, step, totals)[1]
                yield as_batch([r for level, keys, part, stats in sent for r in packet_rows(level, name, keys, stats, part)], PACKET_ARROW)
        return send

    for step in range(1, settings.depth + 2):
        # every block takes what it was answered so far and sends the keys of the next level
        _, f = answered(files.mapInArrow(sender(step, totals), PACKET), f"answers{step}")
        if step < settings.depth:
            totals = replace(totals, widths=(*totals.widths, (2 * step - 1, f["width"])))
            totals.check_width(2 * step - 1)

    id_type = rows.schema["doc_id"].dataType

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (x for batch in batches for x in batch.column(0).to_pylist()):
            yield from scores(walked(name, settings.depth + 2, totals)[0]).to_batches()

    def scores(walk: Walk) -> pa.Table:
        block = walk.block
        starts = np.concatenate(([0], np.cumsum(block.lengths)[:-1])).astype(np.int64)
        known = np.add.reduceat((walk.count > 0).astype(np.int64)[block.codes], starts)
        return pa.table({
            "doc_id": block.ids, "held_out": pa.array(~block.train), "n_tokens": pa.array(block.lengths),
            "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(starts), totals.tokens, np.int64)),
            "base_score": pa.array(np.add.reduceat(np.log10(walk.base)[block.codes], starts)),
            "score": pa.array(np.add.reduceat(np.log10(walk.p * walk.share[block.codes]), starts))})

    return files.mapInArrow(
        scored, f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
