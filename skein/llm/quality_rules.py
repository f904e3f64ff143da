"""Quality rules from a suffix array over the words of each document.

The suffix array of all documents of a batch is built at once by prefix doubling
(the document is part of the first key, so a repeat never spans two documents);
only suffixes that still share a prefix are sorted again.  The ranks of the
doubling steps give the longest common prefixes of neighbours.  At each position
the longer of its two neighbours' prefixes is the deepest interval it lies in;
spans that a longer repeat starting one word earlier already contains are not
maximal and are skipped.  The union of the maximal spans gives the covered fraction
and the longest repeat, which the verdict limits.

Narrow: one pass over the documents, no shuffle; whole texts, a long document is
one unit of work.

Defined cases: a null or empty text has no words and fails the base rule (fewer
than `min_words`); repeated rows are judged alike; other columns pass through, a
column with the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts, run_lengths

#: A base rule: fewer words than this fail.
MIN_WORDS = 50
#: A base rule: a larger share of words in repeated 3-word windows fails (percent).
MAX_REPEAT_WORDS_PCT = 50
#: Repeats of at least this many words count for the covered fraction.
MIN_REPEAT = 6
#: Verdict: largest share of words covered by such repeats.
MAX_COVERED = 0.4
#: Verdict: largest length of one repeat, as a share of the words.
MAX_LONGEST = 0.3

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"

FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, "
          "longest_repeat long, base_failed boolean, kept boolean")


def suffix_order(codes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array (by document, then by words) and the ranks of each doubling
    step: equal ranks at step k mean that the next 2**k words are equal."""
    n = len(codes)
    key = docs.astype(np.int64) * (int(codes.max()) + 1 if n else 1) + codes
    order = np.argsort(key, kind="stable")
    starts, lengths = run_lengths(key[order])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, lengths)
    steps = [rank]
    slots = np.flatnonzero(np.repeat(lengths > 1, lengths))
    h = 1
    while len(slots):
        pos = order[slots]
        after = pos + h
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[pos]
        by = np.lexsort((second, first))
        pos = pos[by]
        order[slots] = pos
        starts, lengths = run_lengths(first[by] * (n + 1) + second[by] + 1)
        rank = rank.copy()
        rank[pos] = np.repeat(slots[starts], lengths)
        steps.append(rank)
        slots = slots[np.repeat(lengths > 1, lengths)]
        h *= 2
    return order, steps


def repeat_lengths(codes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """At each position the length of the longest run of words that starts there
    and also starts elsewhere in the same document."""
    n = len(codes)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    order, steps = suffix_order(codes, docs)
    pair = np.flatnonzero(steps[0][order[:-1]] == steps[0][order[1:]])
    a, b = order[pair], order[pair + 1]
    lcp = np.zeros(len(pair), np.int64)
    for k in range(len(steps) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < n) & (y < n)
        same = inside & (steps[k][np.minimum(x, n - 1)] == steps[k][np.minimum(y, n - 1)])
        lcp += same.astype(np.int64) << k
    longest[a] = lcp
    longest[b] = np.maximum(longest[b], lcp)
    return longest


def covered(longest: np.ndarray, first_of_doc: np.ndarray, at_least: int) -> np.ndarray:
    """Mask of the words inside maximal repeats of `at_least` words or more."""
    n = len(longest)
    start = longest >= at_least
    start[1:] &= first_of_doc[1:] | (longest[:-1] != longest[1:] + 1)
    p = np.flatnonzero(start)
    edge = np.bincount(p, minlength=n + 1) - np.bincount(p + longest[p], minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def duplicate_lines(text: str) -> int:
    """Lines (cut at \\n) with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def measure(texts: Sequence[str | None], min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """The rule figures of whole texts."""
    ids: dict[bytes, int] = {}
    rows = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    n_words = np.fromiter(map(len, rows), np.int64, len(rows))
    codes = np.fromiter((ids.setdefault(w, len(ids)) for r in rows for w in r), np.int64, int(n_words.sum()))
    docs = np.repeat(np.arange(len(rows)), n_words)
    longest = repeat_lengths(codes, docs)
    first = np.ones(len(docs), bool)
    first[1:] = docs[1:] != docs[:-1]

    def per_doc(mask):
        return np.bincount(docs[mask], minlength=len(rows)).astype(np.int64)

    top = np.zeros(len(rows), np.int64)
    np.maximum.at(top, docs, longest)
    return {
        "n_words": n_words,
        "word_chars": np.array([len(t) - sum(map(t.count, _SPACE)) if t else 0 for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, _SYMBOLS)) if t else 0 for t in texts], np.int64),
        "n_dup_lines": np.array([duplicate_lines(t) if t else 0 for t in texts], np.int64),
        "n_repeat_words": per_doc(covered(longest, first, 3)),
        "covered_words": per_doc(covered(longest, first, min_repeat)),
        "longest_repeat": top,
    }


def judge(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, max_repeat_words_pct: int = MAX_REPEAT_WORDS_PCT,
          min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: float = MAX_LONGEST,
          only_kept: bool = False, drop_text: bool = False) -> DataFrame:
    """`docs` with the rule figures and verdicts; `only_kept` leaves rejected rows out."""
    def run(texts):
        m = measure(texts, min_repeat)
        n = m["n_words"]
        m["base_failed"] = (n < min_words) | (100 * m["n_repeat_words"] > max_repeat_words_pct * n)
        m["kept"] = ~m["base_failed"] & (m["covered_words"] <= max_covered * n) & (m["longest_repeat"] <= max_longest * n)
        return m

    return map_texts(docs, text_col, run, FIELDS, drop_text=drop_text, keep=(lambda m: m["kept"]) if only_kept else None)
