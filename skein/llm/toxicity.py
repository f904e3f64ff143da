"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

Kernel.  Two words are compared by their common letter subsequences of length 3,
each weighted by `DECAY` to the power of the span it takes, gaps included; so an
insult with inserted characters (`id.i-ot`) stays close to the plain one.  Each word's
vector of subsequences is divided by its length to the power `NORM`: below 1, so that letters a
spelling adds (`idxiot`, `stuupid`), which make its vector longer, take less from its closeness to the plain
word.  The kernel is raised to `POWER` (again a kernel), which parts words that merely
share common letter groups.  Letters are folded (case, accents, digits and signs that stand for
letters); other characters only make gaps.  A run of single letters between blanks
also counts as one word.

Machine.  A sentence is the sum of the Nystroem embeddings of its words over a set of
landmark words: those most associated with toxic training sentences, and ordinary
ones.  A linear support vector machine (squared hinge) on these sums is the kernel
machine on sentences.  Labels belong to documents, so after a first fit each toxic
document is represented by its highest sentence and those on the toxic side
(multiple-instance rounds).  A last fit also has the sentences on the toxic side with their most telling word
misspelt by one inserted or doubled letter (virtual examples).  A document's decision is the highest of its sentences', turned into a probability by
a logistic fit on the training documents.

Fitting uses a bounded sample of the labelled training rows (`TRAIN_DOCS` documents and `TRAIN_BYTES`
of text, in hash order of the id, so it does not depend on how the data are partitioned).  Scoring
needs the landmarks and one weight for each, whatever the corpus: one narrow pass
over all whole texts, in which each distinct word meets the landmarks once per task.  Only text and training labels are inputs.

Defined cases: an empty or null text has the score of a text without words; without
both labels in training every text gets the training share of toxic rows (Laplace
smoothed); repeated label rows of a document count once, toxic if any is; of repeated
rows of a document the smallest text is fitted on; labels that
are null or of unknown documents are left out; documents without an id are not held out.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, in_training, map_texts

MODULUS = 5
#: Largest number of labelled documents the classifier is fitted on.
TRAIN_DOCS = 2000
#: Largest size of their texts; documents beyond it, in hash order, are left out.
TRAIN_BYTES = 100_000_000
LANDMARKS = 32
ORDINARY = 32
DECAY = 0.95
NORM = 0.9
POWER = 4
ROUNDS = 3
#: Misspelt forms of the most telling word of a toxic sentence that are learnt from as well.
MISSPELT = 6
PENALTY = 0.03
#: A sentence without an end mark is cut after this many words.
SENTENCE_WORDS = 24
#: Longer words take the recursive form of the kernel.
SHORT = 24
#: Distinct tokens, and distinct words in them, per cache generation of a task.
CACHE_TOKENS = 250_000
CACHE_WORDS = 150_000

_LETTERS = 27  # a-z, and one code for characters that only make gaps
#: Characters that stand for letters.
_STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "$": "s", "@": "a", "!": "i", "|": "i"}
_SPACED = re.compile(r"(?<!\S)(?:[A-Za-z0-9$@] ){3,}[A-Za-z0-9$@](?!\S)")
_EDGES = re.compile(r"^[^0-9A-Za-zÀ-ɏ$@]+|[^0-9A-Za-zÀ-ɏ$@]+$")
_BREAK = "\x00"


def _letter_table() -> np.ndarray:
    table = np.full(256, _LETTERS - 1, np.uint8)
    for b in range(256):
        c = unicodedata.normalize("NFD", chr(b).lower())[0]
        c = _STANDS_FOR.get(c, c)
        if "a" <= c <= "z":
            table[b] = ord(c) - 97
    return table


_CODES = _letter_table()


def bare(token: str) -> str:
    """A token without the signs around it."""
    return _EDGES.sub("", token)


def letters(words: Sequence[str]) -> np.ndarray:
    """Letter codes of words of one length, one row per word."""
    n = len(words[0])
    raw = np.array([w.encode("latin-1", "replace") for w in words], f"S{n}")
    return _CODES[raw.view(np.uint8).reshape(len(words), n)]


def by_length(words: Sequence[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    return groups


def _smooth(a: np.ndarray, axis: int) -> np.ndarray:
    """Running sums that decay by `DECAY` per place, along one axis."""
    out = np.moveaxis(a.copy(), axis, 0)
    for i in range(1, len(out)):
        out[i] += DECAY * out[i - 1]
    return np.moveaxis(out, 0, axis)


def norms(codes: np.ndarray) -> np.ndarray:
    """What each word's vector is divided by: its length to the power `NORM`."""
    c = codes.T[:, None, :]
    match = ((c == codes.T[None, :, :]) & (c < _LETTERS - 1)).astype(np.float64)
    tail = DECAY * DECAY * match
    for _ in range(2):
        grown = _smooth(_smooth(tail, 0), 1)
        tail = np.zeros_like(match)
        tail[1:, 1:] = DECAY * DECAY * match[1:, 1:] * grown[:-1, :-1]
    return tail.sum(axis=(0, 1)) ** (NORM / 2)


class Landmarks:
    """Letter triples of the landmark words: row `place[triple]` of `rows` holds the triple's value in
    each landmark's scaled feature vector (row 0: triples of none)."""

    def __init__(self, words: Sequence[str]):
        features = np.column_stack([triples(w) for w in words])
        used = np.flatnonzero(features.any(axis=1))
        self.place = np.zeros(_LETTERS ** 3, np.int32)
        self.place[used] = np.arange(1, len(used) + 1)
        self.rows = np.vstack([np.zeros(len(words)), features[used]]).astype(np.float32)

    def products(self, codes: np.ndarray) -> np.ndarray:
        """Kernel (not yet normalised by the words) of words of one length with every landmark."""
        n = codes.shape[1]
        wide = codes.astype(np.int32)
        out = np.zeros((len(codes), self.rows.shape[1]), np.float32)
        for i in range(n - 2):
            for j in range(i + 1, n - 1):
                pair = (wide[:, i] * _LETTERS + wide[:, j]) * _LETTERS
                for k in range(j + 1, n):
                    at = self.place[pair + wide[:, k]]
                    hit = np.flatnonzero(at)
                    if len(hit):
                        out[hit] += np.float32(DECAY ** (k - i + 1)) * self.rows[at[hit]]
        return out

    def against(self, words: Sequence[str]) -> np.ndarray:
        """Kernel of every word with every landmark: scaled by `NORM`, raised to `POWER`."""
        out = np.zeros((len(words), self.rows.shape[1]), np.float32)
        for n, places in by_length(words).items():
            if n < 3:
                continue
            if n > SHORT:
                for p in places:
                    full = triples(words[p])
                    used = np.flatnonzero(full)
                    out[p] = full[used] @ self.rows[self.place[used]]
                continue
            for a in range(0, len(places), 4096):
                some = places[a:a + 4096]
                codes = letters([words[p] for p in some])
                size = norms(codes)
                out[some] = self.products(codes) * np.divide(1.0, size, out=np.zeros_like(size), where=size > 0)[:, None]
        np.maximum(out, 0, out=out)
        return np.power(out, POWER, out=out)


def triples(word: str) -> np.ndarray:
    """The scaled feature vector of one word, in time proportional to its length."""
    one, two = np.zeros(_LETTERS), np.zeros((_LETTERS, _LETTERS))
    three = np.zeros((_LETTERS, _LETTERS, _LETTERS))
    for c in letters([word])[0]:
        three[:, :, c] += DECAY * two
        two *= DECAY
        two[:, c] += DECAY * one
        one *= DECAY
        one[c] += DECAY
    three[-1], three[:, -1], three[:, :, -1] = 0, 0, 0
    size = float((three * three).sum()) ** (NORM / 2)
    return (three / size if size else three).reshape(-1)


# -- sentences ------------------------------------------------------------------
def tokens(text: str | None) -> list[str]:
    """Tokens of a text with a break at line ends; spaced-out words are added at the end."""
    if not text:
        return []
    out = text.lower().replace("\n", f" {_BREAK} ").split()
    for m in _SPACED.finditer(text):
        out += [_BREAK, m.group().lower().replace(" ", "")]
    return out


def sentence_ids(ends: np.ndarray) -> np.ndarray:
    """Sentence number of each token: a sentence goes on until an end mark or its largest length."""
    n = len(ends)
    before = np.concatenate(([0], np.cumsum(ends)[:-1]))
    starts = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
    at = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    new = np.concatenate(([False], (before[1:] != before[:-1]) | (at[1:] % SENTENCE_WORDS == 0)))
    return np.cumsum(new)


def ends_sentence(token: str) -> bool:
    return token == _BREAK or token[-1] in ".!?"


# -- fitting --------------------------------------------------------------------
@dataclass(frozen=True)
class Model:
    """The landmarks, a weight for each, the bias, and the logistic map of a document's decision."""
    landmarks: Landmarks | None
    weights: np.ndarray | None
    bias: float
    slope: float
    offset: float

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * decision + self.offset, -30, 30)))


def fit_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Linear squared-hinge machine by Newton steps on the rows inside the margin (last weight: bias)."""
    n = x.shape[1] + 1
    w = np.zeros(n)
    ridge = penalty * np.eye(n)
    ridge[-1, -1] = 1e-6
    before = None
    for _ in range(50):
        active = y * (x @ w[:-1] + w[-1]) < 1
        if before is not None and (active == before).all():
            break
        before = active
        left, right, inside = ridge.copy(), np.zeros(n), np.flatnonzero(active)
        for a in range(0, len(inside), 8192):
            some = inside[a:a + 8192]
            xa = np.column_stack([x[some], np.ones(len(some))])
            xc = xa * cost[some][:, None]
            left += xc.T @ xa
            right += xc.T @ y[some]
        w = np.linalg.solve(left, right)
    return w


def fit_logistic(decision: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the label's probability, by Newton steps."""
    x = np.column_stack([decision, np.ones(len(decision))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (label - p) - 1e-3 * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def choose_landmarks(docs: list[np.ndarray], words: list[str], label: np.ndarray) -> list[str]:
    """Words most associated with toxic documents, and ordinary words (frequent ones and, in hash
    order, others).  `docs`: the distinct word numbers of each document."""
    toxic, clean = (sum((np.bincount(d, minlength=len(words)) for d, y in zip(docs, label) if (y > 0) == side),
                        np.zeros(len(words), np.int64)) for side in (True, False))
    a, b = int(label.sum()), int((1 - label).sum())
    gain = toxic * np.log((toxic + 0.5) / (a + 1) * (b + 1) / (clean + 0.5))
    long = np.array([len(w) >= 4 for w in words], bool)
    named = sorted(np.flatnonzero(long & (toxic > 1)), key=lambda i: (-gain[i], words[i]))[:LANDMARKS]
    left = sorted(set(np.flatnonzero(long & (clean > 0))) - set(named), key=lambda i: (-clean[i], words[i]))
    rest = sorted(left[ORDINARY // 2:], key=lambda i: hashlib.md5(words[i].encode("utf-8", "surrogatepass")).digest())
    return [words[i] for i in [*named, *left[:ORDINARY // 2], *rest[:ORDINARY - ORDINARY // 2]]]


def misspelt(word: str, n: int) -> list[str]:
    """`n` spellings of a word with one more letter, inserted or doubled, drawn from a digest of the word."""
    out = []
    for k in range(n):
        draw = hashlib.md5(f"{k} {word}".encode("utf-8", "surrogatepass")).digest()
        i = 1 + draw[0] % max(1, len(word) - 1)
        out.append(word[:i] + (word[i - 1] if k % 3 == 0 else chr(97 + draw[1] % 26)) + word[i:])
    return out


def fit(rows: Sequence[tuple[str | None, int]]) -> Model:
    """Fit on (text, label) rows."""
    label = np.array([y for _, y in rows], float)
    share = (label.sum() + 1) / (len(label) + 2)
    flat = Model(None, None, 0.0, 0.0, math.log(share / (1 - share)))
    if not len(label) or label.min() == label.max():
        return flat
    place: dict[str, int] = {}
    distinct: dict[str, int] = {}
    word_of: list[int] = []
    ends: list[bool] = []
    codes = []
    for text, _ in rows:
        row = tokens(text)
        for t in row:
            if t not in place:
                place[t] = len(place)
                word_of.append(distinct.setdefault(bare(t), len(distinct)))
                ends.append(ends_sentence(t))
        codes.append(np.fromiter(map(place.__getitem__, row), np.int32, len(row)))
    word, ends_array, words = np.array(word_of, np.int32), np.array(ends, bool), list(distinct)
    del place, word_of, ends, distinct
    marks = choose_landmarks([np.unique(word[cs]) for cs in codes], words, label) if words else []
    if not marks:
        return flat
    landmarks = Landmarks(marks)
    values, vectors = np.linalg.eigh(landmarks.against(marks).astype(float))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    embedded = landmarks.against(words) @ whiten.astype(np.float32)

    sums, owner, held = [], [], []
    for d, cs in enumerate(codes):
        if len(cs):
            ids = sentence_ids(ends_array[cs])
            starts = np.flatnonzero(np.diff(ids, prepend=-1))
            sums.append(np.add.reduceat(embedded[word[cs]], starts, axis=0))
            owner += [d] * (int(ids[-1]) + 1)
            if label[d] > 0:
                held += np.split(word[cs], starts[1:])
            else:
                held += [None] * len(starts)
    if not sums:
        return flat
    x, owner = np.concatenate(sums), np.array(owner)
    toxic = label[owner] > 0
    pick = np.ones(len(x), bool)
    for _ in range(1 + ROUNDS):
        y = np.where(toxic, 1.0, -1.0)[pick]
        cost = np.where(y > 0, (y < 0).sum() / max(1, (y > 0).sum()), 1.0) ** 0.5
        w = fit_svm(x[pick], y, cost)
        f = x @ w[:-1] + w[-1]
        best = np.full(len(codes), -np.inf)
        np.maximum.at(best, owner, f)
        pick = ~toxic | (f == best[owner]) | (f >= 0)
    # sentences on the toxic side again, with their most telling word misspelt
    worth = embedded @ w[:-1]
    telling: dict[int, list[int]] = {}
    for i in np.flatnonzero(toxic & (f >= 0)).tolist():
        top = int(held[i][worth[held[i]].argmax()])
        if worth[top] > 0 and len(words[top]) >= 4:
            telling.setdefault(top, []).append(i)
    if telling:
        virtual = []
        for top, where in telling.items():
            spelt = landmarks.against(misspelt(words[top], MISSPELT)) @ whiten.astype(np.float32)
            virtual += [x[i] - embedded[top] + e for i in where for e in spelt]
        more = np.concatenate((x[pick], virtual))
        y = np.concatenate((np.where(toxic, 1.0, -1.0)[pick], np.ones(len(virtual))))
        share_of_one = np.concatenate((np.ones(int(pick.sum())), np.full(len(virtual), 1.0 / MISSPELT)))
        positive = float(share_of_one[y > 0].sum())
        w = fit_svm(more, y, np.where(y > 0, share_of_one * ((y < 0).sum() / max(1.0, positive)) ** 0.5, 1.0))
        f = x @ w[:-1] + w[-1]
        best = np.full(len(codes), -np.inf)
        np.maximum.at(best, owner, f)
    decision = np.where(np.isfinite(best), best, w[-1])
    slope, offset = fit_logistic(decision, label)
    return Model(landmarks, whiten @ w[:-1], float(w[-1]), slope, offset)


# -- scoring --------------------------------------------------------------------
class Scorer:
    """Decisions of texts, with bounded caches of token and word weights."""

    def __init__(self, model: Model):
        self.model = model
        self.tokens = Memo(CACHE_TOKENS)
        self.words = Memo(CACHE_WORDS)

    def _words(self, words: list[str]) -> list[float]:
        return (self.model.landmarks.against(words) @ self.model.weights).tolist()

    def _tokens(self, some: list[str]) -> list[complex]:
        """Weight of each token, and 1j if it ends a sentence."""
        plain = [bare(t) for t in some]
        worth = self.words.all_of(set(plain), self._words)
        return [complex(worth[w], ends_sentence(t)) for t, w in zip(some, plain)]

    def texts(self, texts: Sequence[str | None]) -> np.ndarray:
        m = self.model
        decision = np.full(len(texts), m.bias)
        if m.landmarks is not None:
            rows = [tokens(t) for t in texts]
            get = self.tokens.all_of({t for r in rows for t in r}, self._tokens).__getitem__
            for i, r in enumerate(rows):
                if r:
                    got = np.fromiter(map(get, r), np.complex128, len(r))
                    decision[i] += np.bincount(sentence_ids(got.imag > 0), weights=got.real).max()
        return m.probability(decision)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                    modulus: int = MODULUS, bound: int = TRAIN_DOCS, byte_bound: int = TRAIN_BYTES) -> list[tuple[str | None, int]]:
    """At most `bound` labelled training documents of together at most `byte_bound` bytes, in hash order of the id,
    one row per document."""
    order = [F.xxhash64(F.col("_id").cast("string")), F.col("_id")]
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & in_training(id_col, modulus))
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
             .join(docs.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi").orderBy(*order).limit(bound))
    # `bound` rows of two numbers: small by construction
    texts = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(known), "_id")
             .groupBy("_id", "_label").agg(F.min("_text").alias("_text")))
    chosen, total = [], 0
    for r in texts.select("_id", F.coalesce(F.octet_length("_text"), F.lit(0)).alias("n")).orderBy(*order).collect():
        total += r["n"]
        if total <= byte_bound:
            chosen.append(r["_id"])
    rows = texts.filter(F.col("_id").isin(chosen)).collect() if chosen else []
    return [(r["_text"], r["_label"]) for r in sorted(rows, key=lambda r: r["_id"])]


def score(docs: DataFrame, model: Model, text_col: str = "text", drop_text: bool = True) -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted`."""
    task: list[Scorer] = []  # filled in the task

    def run(texts):
        if not task:
            task.append(Scorer(model))
        p = task[0].texts(texts)
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return map_texts(docs, text_col, run, "score double, predicted int", drop_text=drop_text)
