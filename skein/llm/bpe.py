"""BPE encoding and decoding by speculate and verify.

Speculate: every word is cut by greedy longest match against the vocabulary.
Verify: a sequence of tokens is the exact BPE encoding of a word if and only if
each adjacent pair is the encoding of its own concatenation, so all distinct
adjacent pairs of a batch are tested together with numpy.  A pair is followed
back in time: the token formed last (on either side of the boundary) is split
again, and at every moment the merge across the boundary must not come before
the merge that consumed one of its two sides.  Only words with a failing pair
undergo exact merging (a heap over a linked list, O(n log n)).

Text preparation is that of the given tokenizer file: NFC, white space, lower
case, the word pattern and byte-level symbols.  Texts whose characters all lie
below U+0250 take a pattern with the same meaning; others (where Unicode versions
and context rules matter) are prepared by the tokenizers library's own normaliser
and pre-tokeniser.  The file's special tokens are cut out first, as the library
does.

Words do not depend on each other, so each distinct word is encoded once per task and
kept in a cache of bounded size (freed with the task: Spark may keep several Python
workers waiting, and each would hold its own).

Defined cases: a null or empty text has no tokens and decodes to the empty
string; a word of any length is one unit; other columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import Memo, map_texts

#: Distinct words per cache generation of a task.
CACHE_WORDS = 200_000

_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\t-\r \x85\xa0\p{L}\p{N}]+")
_LATIN = regex.compile(r"[\x00-\x1b -įı-ɏ]*")
#: The same for Arrow (RE2): a character that makes a text not plain, and the words that are no
#: letter runs (set apart by blanks, they leave the letter runs between them).
_NOT_PLAIN = "[^\\x00-\\x1b\\x20-\\x{12f}\\x{131}-\\x{24f}]"
_APART_RE2 = r"'(?:s|t|re|ve|m|ll|d)|\pN|[^\t-\r \x{85}\x{a0}\pL\pN]+"
_NEVER = np.iinfo(np.int64).max
_NO_MERGE = (_NEVER, -1)
#: Longer words are merged with a heap.
SHORT_WORD = 40
#: Marks the last symbol of a word (the file's `</w>` suffix) in the working alphabet.
_END = 0x100


def byte_symbols() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 characters stand for themselves, the
    other bytes, in order, for the characters from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def plain_text(text: str) -> bool:
    """Whether a text can be cut by the word pattern after plain lower-casing: characters below
    U+0250 (NFC changes none of them) without the separators that only splitting knows and the
    one letter whose lower case is two, and no special token."""
    return _LATIN.fullmatch(text) is not None and "<|" not in text


def plain_rows(column: pa.Array) -> np.ndarray:
    """Mask of the plain texts of an Arrow column (null: not plain)."""
    odd = pc.or_(pc.match_substring_regex(column, _NOT_PLAIN), pc.match_substring(column, "<|"))
    return pc.fill_null(pc.invert(odd), False).to_numpy(zero_copy_only=False)


def word_table(column: pa.Array, plain: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words of the plain texts of a column: the distinct words, the code of each word, and the row
    offsets into the codes (other rows have none)."""
    low = pc.utf8_lower(column.filter(pa.array(plain)))
    lists = pc.utf8_split_whitespace(pc.replace_substring_regex(low, pattern=_APART_RE2, replacement=r" \0 "))
    counts = np.zeros(len(column), np.int64)
    counts[plain] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    table = lists.flatten().dictionary_encode()
    words, codes = table.dictionary.to_pylist(), table.indices.to_numpy(zero_copy_only=False)
    if "" in words:  # blanks at the ends of a text
        none = words.index("")
        del words[none]
        keep = codes != none
        offsets = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))[offsets]
        codes = codes[keep]
        codes = codes - (codes > none)
    return words, codes, offsets


class Bpe:
    """Tables of one tokenizer file. Words are strings over a working alphabet of
    one character per byte; the last one is shifted by `_END`."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path = path
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.split_specials = regex.compile("(" + "|".join(regex.escape(s) for s in self.specials) + ")") if self.specials else None
        self._library = None
        symbols = byte_symbols()
        vocab = model["vocab"]
        size = max(max(vocab.values()), *self.specials.values(), 0) + 1
        self.names = [""] * size
        self.strings: dict[str, int] = {}
        for token, i in vocab.items():
            self.names[i] = token
            self.strings[self._working(token, symbols)] = i
        for token, i in self.specials.items():
            self.names[i] = token
        # a merge makes one token out of two: rank, and the two sides, by token
        self.rank = np.full(size, -1, np.int64)
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ia, ib, made = vocab[a], vocab[b], vocab[a + b]
            self.merges[(ia, ib)] = (r, made)
            self.rank[made], self.left[made], self.right[made] = r, ia, ib
        self.size = size
        keys = np.fromiter((a * size + b for a, b in self.merges), np.int64, len(self.merges))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.fromiter((r for r, _ in self.merges.values()), np.int64, len(self.merges))[order]
        # tokens that merging their own string does not give are never proposed
        self.proposals = {s: i for s, i in self.strings.items() if len(s) == 1 or self.merge(s) == [i]}
        # length of the longest proposal by its first two symbols
        self.longest_from: dict[str, int] = {}
        for w in self.proposals:
            self.longest_from[w[:2]] = max(len(w), self.longest_from.get(w[:2], 1))

    def _working(self, token: str, symbols: dict[str, int]) -> str:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[:-len(self.suffix)]
            return "".join(chr(symbols[c]) for c in body[:-1]) + chr(symbols[body[-1]] + _END)
        return "".join(chr(symbols[c]) for c in token)

    def word(self, piece: str) -> str:
        w = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        return w[:-1] + chr(ord(w[-1]) + _END) if self.suffix else w

    # -- text preparation ---------------------------------------------------
    def pieces(self, text: str) -> list[str]:
        if _LATIN.fullmatch(text):
            return _WORD.findall(text.lower())
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_file(self.path)
        lib = self._library
        back = byte_symbols()
        made = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(text))
        return [bytes(back[c] for c in p).decode("utf-8", "surrogatepass") for p, _ in made]

    # -- speculate ----------------------------------------------------------
    def greedy(self, word: str) -> list[int]:
        out, at, n = [], 0, len(word)
        get, longest = self.proposals.get, self.longest_from.get
        while at < n:
            end = min(n, at + longest(word[at:at + 2], 1))
            while (i := get(word[at:end])) is None:
                end -= 1
            out.append(i)
            at = end
        return out

    # -- verify -------------------------------------------------------------
    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens is the encoding of its concatenation."""
        ok = np.ones(len(first), bool)
        at = np.arange(len(first))
        a, b = first.astype(np.int64), second.astype(np.int64)
        until_a = np.full(len(a), _NEVER)  # rank of the merge that consumes the side
        until_b = until_a.copy()
        while len(at):
            key = a * self.size + b
            place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[place] == key, self.pair_ranks[place], _NEVER)
            # of merges of one rank the leftmost comes first: the left side's own merge
            # precedes the one across the boundary, which precedes the right side's own
            clash = (rank < until_a) & (rank <= until_b) & (rank != _NEVER)
            ok[at[clash]] = False
            ra, rb = self.rank[a], self.rank[b]
            back_a, back_b = ra > rb, (rb >= ra) & (rb >= 0)
            until_a = np.where(back_a, ra, until_a)
            until_b = np.where(back_b, rb, until_b)
            a = np.where(back_a, self.right[a], a)
            b = np.where(back_b, self.left[b], b)
            go = ~clash & (back_a | back_b)
            at, a, b, until_a, until_b = at[go], a[go], b[go], until_a[go], until_b[go]
        return ok

    # -- exact --------------------------------------------------------------
    def merge(self, word: str) -> list[int]:
        ids: list[int | None] = [self.strings[c] for c in word]
        n = len(ids)
        if n <= SHORT_WORD:
            return self._merge_short(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, made, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = made, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((made, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1], made, ids[k]))
            h = before[i]
            if h >= 0 and (m := merges.get((ids[h], made))):
                heapq.heappush(heap, (m[0], h, m[1], ids[h], made))
        return [i for i in ids if i is not None]

    def _merge_short(self, ids: list[int]) -> list[int]:
        """Merge the lowest pair, leftmost first, until none is left (quadratic, for short words)."""
        get = self.merges.get
        ranks = [get(p, _NO_MERGE) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best is _NO_MERGE:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [best[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), _NO_MERGE)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), _NO_MERGE)
        return ids

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """Speculate on all words, test all distinct adjacent pairs, merge the failing words."""
        got = [self.greedy(w) for w in words]
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((i for g in got for i in g), np.int64, int(lengths.sum()))
        if len(flat) < 2:
            return got
        owner = np.repeat(np.arange(len(got)), lengths)
        inside = owner[1:] == owner[:-1]
        keys, inverse = np.unique((flat[:-1] * self.size + flat[1:])[inside], return_inverse=True)
        fails = ~self.compatible(keys // self.size, keys % self.size)[inverse]
        for w in np.unique(owner[1:][inside][fails]):
            got[w] = self.merge(words[w])
        return got


_tables: dict[str, Bpe] = {}


def tables(path: str) -> Bpe:
    """The tables of a tokenizer file, read once per Python worker."""
    if path not in _tables:
        _tables.clear()
        _tables[path] = Bpe(path)
    return _tables[path]


class Encoder:
    """Encodes texts word by word; `entry(ids)` is what is kept for a distinct word."""

    def __init__(self, bpe: Bpe, entry: Callable[[list[int]], object]):
        self.bpe, self.entry = bpe, entry
        self.memo = Memo(CACHE_WORDS)

    def _words(self, text: str | None) -> list[str]:
        if not text:
            return []
        if plain_text(text):
            return _WORD.findall(text.lower())
        bpe, words = self.bpe, []
        for k, part in enumerate(bpe.split_specials.split(text) if bpe.split_specials else [text]):
            words.extend([part] if k % 2 else bpe.pieces(part))
        return words

    def _entries(self, words: list[str]) -> list:
        specials = self.bpe.specials  # no word equals one: their signs and letters are different words
        got = self.bpe.encode_words([self.bpe.word(w) for w in words])
        return [self.entry([specials[w]] if w in specials else ids) for w, ids in zip(words, got)]

    def texts(self, texts: Sequence[str | None]) -> list[list]:
        """Entries of the words of each text, in order."""
        rows = [self._words(t) for t in texts]
        known = self.memo.all_of({w for r in rows for w in r}, self._entries)
        return [[known[w] for w in r] for r in rows]

    def column(self, column: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """The distinct entries of an Arrow column of texts, the entry of each word, and row offsets."""
        plain = plain_rows(column)
        words, codes, offsets = word_table(column, plain)
        known = self.memo.all_of(words, self._entries)
        entries = [known[w] for w in words]
        odd = [int(i) for i in np.flatnonzero(~plain) if column[int(i)].is_valid and column[int(i)].as_py()]
        if odd:
            rows = self.texts([column[i].as_py() for i in odd])
            at = np.repeat(offsets[odd], [len(r) for r in rows])
            extra = len(entries) + np.arange(len(at))
            entries += [e for r in rows for e in r]
            codes = np.insert(codes.astype(np.int64), at, extra)
            sizes = np.diff(offsets)
            sizes[odd] = [len(r) for r in rows]
            offsets = np.concatenate(([0], np.cumsum(sizes)))
        return entries, codes, offsets


def _digest_entry(bpe: Bpe) -> Callable[[list[int]], object]:
    # the ids and the decoded text of a whole text are its words' joined by one space
    return lambda ids: (" ".join(map(str, ids)), decode_ids(bpe, ids), len(ids))


def encoder(path: str, kind: str) -> Encoder:
    """An encoder whose entries are the ids of a word, or (`digest`) their strings."""
    bpe = tables(path)
    return Encoder(bpe, _digest_entry(bpe) if kind == "digest" else lambda ids: ids)


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """`docs` with the token ids of each whole text."""
    task: list[Encoder] = []  # filled in the task

    def run(texts):
        if not task:
            task.append(encoder(tokenizer, "ids"))
        return {out_col: [[i for word in row for i in word] for row in task[0].texts(texts)]}

    return map_texts(docs, text_col, run, f"`{out_col}` array<int>")


def decode_ids(bpe: Bpe, ids: Sequence[int]) -> str:
    """Token strings joined by one space: the file names no decoder."""
    names = bpe.names
    return " ".join([names[i] for i in ids])


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """`encoded` with the decoded text of each list of ids (null: empty)."""
    def run(rows):
        bpe = tables(tokenizer)
        return {out_col: [decode_ids(bpe, r or []) for r in rows]}

    return map_texts(encoded, ids_col, run, f"`{out_col}` string")


def _joined(parts: list[str], codes: np.ndarray, offsets: np.ndarray) -> list:
    """For each row its parts joined by one space (as buffers)."""
    if len(offsets) == 2:  # one text, of any length
        return [" ".join([parts[c] for c in codes.tolist()]).encode("utf-8", "surrogatepass")]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(parts, pa.string()).take(pa.array(codes)))
    return [t.as_buffer() for t in pc.binary_join(lists, " ")]


def digest(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """Per document the number of tokens, the digest of its ids and of the text decoded from them."""
    task: list[Encoder] = []  # filled in the task

    def run(column):
        if not task:
            task.append(encoder(tokenizer, "digest"))
        entries, codes, offsets = task[0].column(column)
        sizes = np.concatenate(([0], np.cumsum(np.array([e[2] for e in entries], np.int64)[codes])))
        sha = lambda texts: [hashlib.sha256(t).hexdigest() for t in texts]
        return {"n_tokens": sizes[offsets[1:]] - sizes[offsets[:-1]],
                "ids_sha256": sha(_joined([e[0] for e in entries], codes, offsets)),
                "decoded_sha256": sha(_joined([e[1] for e in entries], codes, offsets))}

    return map_texts(docs, text_col, run, "n_tokens long, ids_sha256 string, decoded_sha256 string", drop_text=True, as_arrow=True)
