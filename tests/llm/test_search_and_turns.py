"""Lexical search, chat formatting and prefix tries against plain versions, and their defined cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skein.llm import chat_tree, lexical_search, prefix_trie

from .edge import LONG, edge_docs, empty_docs

BYTES = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


# ---------------------------------------------------------------- lexical search

def plain_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs, items, top=10):
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_all, l_all = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for i, terms in asked.items():
        rows = []
        for d, c, n in counts:
            m = 10 + 90 * n * n_all // l_all
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                rows.append((-s, d is None, d or 0, d))
        out += [(i, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(rows, key=lambda r: r[:3])[:top])]
    return sorted(out, key=repr)


def found_by_search(docs, items, **options):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical_search.search(docs, items, **options).collect()), key=repr)


WORDS = ["the", "a", "cat", "Dog", "é", "42", "x1", "ÀB", "zebra", "sun", "moon", "rare", "blue"]


def random_rows(seed, n, longest):
    r = random.Random(seed)
    weights = [1 / (k + 1) for k in range(len(WORDS))]
    return [(i // 2, r.choice([", ", " ", "-"]).join(r.choices(WORDS, weights, k=r.randint(0, longest)))) for i in range(n)]


@pytest.mark.parametrize("postings", [40, 2_000_000])
def test_search_equals_plain_search(spark, monkeypatch, postings):
    docs, items = random_rows(1, 400, 30), random_rows(2, 25, 6) + [(3, None), (None, "cat zebra"), (None, "moon"), (99, "!!")]
    docs += [(None, "cat zebra"), (None, "cat zebra moon"), (7, None), (8, ""), (9, LONG + " cat")]
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", postings)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("score", F.lit("own")).withColumn("rank", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(5))
    want = plain_search(docs, items)
    assert found_by_search(d, i) == want
    assert found_by_search(d, i, group_terms=10) == want


def test_equal_scores_go_on_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(k, "same words here") for k in range(40, 0, -1)] + [(100, "other")] * 60, "doc_id long, text string")
    items = spark.createDataFrame([("i", "same words")], "item_id string, text string")
    got = found_by_search(docs.repartition(4), items)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 11))
    assert len({r[3] for r in got}) == 1


def test_search_stops_before_the_end_of_its_lists():
    """A block of clear winners: far fewer documents are looked at than the lists hold."""
    block = lexical_search.BlockWriter({b"win": 0, b"common": 1})
    for k in range(20_000):
        block.add(k, "win " * 9 if k < 10 else "common " + "filler " * (k % 50))
    row = block.close()
    one = lexical_search.Block({c: row.column(c)[0].values for c in row.schema.names[2:]}, 20_000, 520_000)
    seen = []
    keep = lexical_search.Best.with_new
    best = lexical_search.Best.none()
    real = np.unique

    def counting(a, *x, **y):
        seen.append(len(a))
        return real(a, *x, **y)

    lexical_search.np.unique = counting
    try:
        best = one.best(np.array([0, 1]), np.array([8000, 1]), best, 10)
    finally:
        lexical_search.np.unique = real
    assert sorted(best.doc_ids.tolist()) == list(range(10)) and sum(seen) < 200
    assert keep is lexical_search.Best.with_new


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    none = items.filter("false")
    assert found_by_search(empty_docs(spark), items) == [] and found_by_search(edge_docs(spark), none) == []


# ---------------------------------------------------------------- chat formatting

def plain_chat(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for c, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((c, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss),
                    sum(len(p) for r, t in turns for p in chat_tree.pieces(r, t))))
    return sorted(out, key=repr)


CHATS = ([(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c if t > c % 4 else 'all'} </s>[INST] ok") for c in range(30) for t in range(5)]
         + [(c, 0, "user", "hot start") for c in range(100, 160)] + [(c, 1, "assistant", "same answer") for c in range(100, 160)]
         + [(200, None, "assistant", None), (200, None, None, "x"), (200, 3, "a\nb\\n[INST]", "<\\s>"), (201, 0, "assistant", "<"),
            (201, 1, "assistant", "\\s>"), (201, 1, "assistant", "\\s>"), (202, 0, "user", ""), (None, 0, "user", "no id"),
            (None, 1, "assistant", "🙂 é<|endoftext|>"), (203, 0, "user", LONG), (203, 1, "assistant", LONG)])
CHAT_SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("limits", [{}, {"pack_chars": 60, "pack_convs": 3}])
def test_chats_read_back_equal_the_given_ones(spark, limits):
    chats = spark.createDataFrame(CHATS, CHAT_SCHEMA).repartition(5).withColumns({"tokens": F.lit(1), "path": F.lit("own"), "t": F.lit(2)})
    packs = chat_tree.format_conversations(chats, *BYTES, **limits)
    assert sorted(map(tuple, chat_tree.read_back(packs, *BYTES).collect()), key=repr) == plain_chat(CHATS)


def test_shared_turns_are_written_once_with_ancestor_intervals(spark):
    rows = [(1, 0, "user", "root"), (1, 1, "assistant", "left"), (2, 0, "user", "root"), (2, 1, "assistant", "right"), (2, 2, "user", "more"),
            (3, 0, "user", "root"), (3, 1, "assistant", "right"), (3, 2, "user", "other")]
    pack = chat_tree.format_conversations(spark.createDataFrame(rows, CHAT_SCHEMA).coalesce(1), *BYTES).collect()
    assert len(pack) == 1
    p = pack[0]
    assert len(p.node_start) == 5 and sorted(p.conv_ids) == [1, 2, 3]
    assert p.node_start == [0, *p.node_end[:-1]] and p.node_end[-1] == len(p.tokens) == len(p.positions) == len(p.loss)
    for node, parent in enumerate(p.node_parent):
        flat = p.attends[node]
        at = [i for a, b in zip(flat[::2], flat[1::2]) for i in range(a, b)]
        up = [] if parent < 0 else [i for a, b in zip(p.attends[parent][::2], p.attends[parent][1::2]) for i in range(a, b)]
        assert at == up + list(range(p.node_start[node], p.node_end[node])) and [p.positions[i] for i in at] == list(range(len(at)))
        assert parent < node and all(a[1] < b[0] for a, b in zip(list(zip(flat[::2], flat[1::2])), list(zip(flat[2::2], flat[3::2]))))


def test_chat_escapes_are_undone_exactly():
    r = random.Random(3)
    parts = ["<", "[", "/", "s>", "INST]", "\\", "\n", " ", "a", "é", "</s>", "[INST] ", " [/INST]", "\\n"]
    for _ in range(3000):
        turns = [(r.choice(["user", "assistant", "".join(r.choices(parts, k=3))]), "".join(r.choices(parts, k=r.randint(0, 7)))) for _ in range(3)]
        assert chat_tree.parse("".join("".join(chat_tree.pieces(*t)) for t in turns)) == turns


def test_chats_of_an_empty_table(spark):
    none = spark.createDataFrame([], CHAT_SCHEMA)
    assert chat_tree.read_back(chat_tree.format_conversations(none, *BYTES), *BYTES).collect() == []


# ---------------------------------------------------------------- prefix trie

def plain_trie(rows):
    from base64 import b64encode
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = b64encode(hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()).decode()[:22]
            convs.setdefault(c, []).append((turn is not None, turn or 0, name, (role, text)))
    convs = {c: [t[3] for t in sorted(v)] for c, v in convs.items()}
    nodes = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, d == len(path)))
    out = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[:len(node)] == node]
        kids = lambda n: sum(len(k) == len(n) + 1 and k[:len(n)] == n for k in nodes)
        ends = ",".join(map(str, sorted(c for c, e in members if e)))
        out.append((min(members)[0], len(node), min(nodes[node[:-1]])[0] if node else None, len(members), kids(node),
                    sum(kids(n) == 0 for n in below),
                    sum((len(nodes[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TALKS = ([(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c // 7 if t > 1 else 'all'} b") for c in range(45) for t in range(1 + c % 5)]
         + [(c, t, "user", "hot words here") for c in range(1000, 1060) for t in range(3)]
         + [(500, None, None, None), (500, None, "x", "y z"), (500, 1, "x", "y z"), (500, 1, "x", "y z"), (None, 0, "user", "no id"),
            (621, 0, "user", "own first"), (623, 0, "user", "own first"), (625, 0, "user", "own first"), (627, 0, "u", LONG)])


@pytest.mark.parametrize("shards", [{}, {"shard_convs": 4}, {"shard_convs": 1}, {"shard_turns": 9}])
def test_trie_equals_plain_trie(spark, shards):
    talks = spark.createDataFrame(TALKS, CHAT_SCHEMA).repartition(3).withColumns({"depth": F.lit("own"), "key": F.lit(1), "donor": F.lit(2), "h": F.lit(3)})
    got = prefix_trie.trie_nodes(prefix_trie.rebuilt_paths(talks), **shards)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(TALKS)


def test_trie_of_empty_tables_and_turnless_conversations(spark):
    none = spark.createDataFrame([], CHAT_SCHEMA)
    assert prefix_trie.prefix_trie(none).collect() == []
    # crc32('623') % 4 = 1 and there is no conversation 620: nothing is left of a single turn
    alone = next(c for c in range(621, 640) if zlib.crc32(str(c).encode()) % 4)
    rows = [(alone, 0, "user", "gone")]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, CHAT_SCHEMA)).collect()
    assert list(map(tuple, got)) == plain_trie(rows) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_double_array_holds_exactly_its_paths():
    r = np.random.default_rng(5)
    parents, labels = [], []
    children = [set()]
    for node in range(1, 600):
        up = int(r.integers(0, len(children)) if r.random() < 0.8 else 0)
        label = int(r.integers(0, 700))
        while label in children[up]:
            label = int(r.integers(0, 700))
        children[up].add(label)
        children.append(set())
        parents.append(up)
        labels.append(label)
    trie = prefix_trie.DoubleArray(np.array(parents), np.array(labels))
    state = np.zeros(600, np.int64)
    for node in range(1, 600):
        state[node] = trie.step(state[parents[node - 1]][None], np.array([labels[node - 1]]))[0]
    assert len(set(state.tolist())) == 600 and (state[1:] > 0).all()
    for node in range(600):
        reached = trie.step(np.full(700, state[node]), np.arange(700))
        assert set(np.flatnonzero(reached >= 0).tolist()) == children[node]
