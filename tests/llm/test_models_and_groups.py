"""Suffix tree, toxicity, SimHash and the pipeline against plain versions."""

import contextlib
import glob
import itertools
import math
import os
import random
import tempfile
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skein.llm import simhash, suffix_tree, toxicity
from skein.llm.common import scratch

from .edge import EDGE, edge_docs, empty_docs, words


# -- suffix tree ----------------------------------------------------------------------
class PlainTree:
    """The model of `suffix_tree` by dictionaries."""

    def __init__(self, rows, s):
        self.s = s
        train = [[*words(t), ""] for i, t in rows if zlib.crc32(str(i).encode()) % 10]
        self.c = c = Counter(w for ws in train for w in ws)
        self.n, self.z = sum(c.values()), sum(c.values()) + 0.1 * (len(c) + 1)
        rare = [w for w in c if c[w] < s.min_symbol]
        self.rare_mass = (sum(c[w] for w in rare) + 0.1 * (len(rare) + 1)) / self.z
        self.states, self.pairs = {}, {}
        for d in range(1, s.depth + 1):
            following = {}
            for ws in train:
                for t in range(d, len(ws)):
                    ctx = tuple(ws[t - d:t])
                    if self.open(ctx):
                        following.setdefault(ctx, Counter())[self.sym(ws[t])] += 1
            new = {}
            for ctx, f in following.items():
                if d > 1 and ctx[1:] not in self.states:
                    continue
                n, t = sum(f.values()), len(f)
                once = sum(m == 1 for m in f.values())
                gain = sum(m * math.log(m - 1) - m * math.log(self.p(ctx[1:], y)) for y, m in f.items() if m > 1)
                gain += -(n - once) * math.log(n + t) + once * math.log(t / (n + t))
                if n >= s.min_context and gain >= s.min_gain:
                    new[ctx] = (n, t)
            self.pairs.update(following)
            self.states.update(new)

    def sym(self, w):
        return w if w == "" or self.c[w] >= self.s.min_symbol else None

    def open(self, ctx):
        """A candidate: each word is a symbol, and each shorter context was frequent enough."""
        if any(self.sym(w) is None for w in ctx) or any(self.c[w] < self.s.min_context for w in ctx):
            return False
        return all(self.pairs.get(ctx[i:j], {}).get(ctx[j], 0) >= self.s.min_context
                   for j in range(1, len(ctx)) for i in range(j))

    def base(self, w):
        return (self.c[w] + 0.1) / self.z

    def p(self, ctx, y):
        low = self.p(ctx[1:], y) if ctx else (self.rare_mass if y is None else self.base(y))
        if ctx in self.states:
            n, t = self.states[ctx]
            return (self.pairs[ctx][y] + t * low) / (n + t)
        return low

    def score(self, text):
        ws, total = [*words(text), ""], 0.0
        for t, w in enumerate(ws):
            y = self.sym(w)
            total += math.log10(self.p(tuple(ws[max(0, t - self.s.depth):t]), y) * (self.base(w) / self.rare_mass if y is None else 1))
        return total


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_scores_equal_the_plain_tree(spark, depth):
    r = random.Random(depth)
    vocabulary = [f"v{i}" for i in range(12)] + ["É", "x|y"]

    def text():
        out = [r.choice(vocabulary)]
        for _ in range(r.randint(0, 40)):
            out.append(vocabulary[(vocabulary.index(out[-1]) + 1) % 12] if r.random() < 0.6 else r.choice(vocabulary))
        return r.choice([" ", "\n", "  "]).join(out)

    rows = [(i, text()) for i in range(150)] + [(1000 + i, t) for i, t in EDGE if len(t or "") < 100]
    s = suffix_tree.Settings(depth=depth, min_symbol=3, min_context=4, min_gain={1: 0.5, 2: -5.0, 3: -100.0}[depth], symbol_share=0, context_share=0)
    assert suffix_tree.Settings(symbol_share=0.01, context_share=0.02).at(10_000).min_context == 200
    tree = PlainTree(rows, s)
    got = suffix_tree.score(edge_docs(spark, rows).repartition(3), settings=s).collect()
    assert sorted(g["doc_id"] for g in got) == sorted(i for i, _ in rows)
    text_of = dict(rows)
    assert any(len(c) == depth for c in tree.states)
    for g in got:
        t = text_of[g["doc_id"]]
        ws = [*words(t), ""]
        assert g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 10 == 0)
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(ws), sum(w in tree.c for w in ws), tree.n)
        assert g["base_score"] == pytest.approx(sum(math.log10(tree.base(w)) for w in ws), abs=1e-9)
        assert g["score"] == pytest.approx(tree.score(t), abs=1e-9)
    for ctx in tree.states:
        symbols = [w for w in tree.c if tree.sym(w) is not None] + [None]
        assert sum(tree.p(ctx, y) for y in symbols) == pytest.approx(1)


def test_counts_do_not_rise_with_the_corpus():
    s = suffix_tree.Settings().at(5_000_000_000)
    assert (s.min_symbol, s.min_context) == (suffix_tree.MIN_SYMBOL, suffix_tree.MIN_CONTEXT)


def test_suffix_tree_holds_words_once():
    """What a word alone decides is held per word, and places take 4 bytes (memory of a task)."""
    rows = [(i, "a b c a b a " * 30, True) for i in range(4)]
    block = suffix_tree.Block.of(rows, pa.int64())
    counts = np.bincount(block.codes, minlength=len(block.hashes))[np.argsort(block.hashes)]
    walk = suffix_tree.Walk(block, {0: (counts, None)}, suffix_tree.Totals(int(counts.sum()), 4, 0, 0), suffix_tree.Settings())
    assert len(walk.count) == len(walk.base) == len(walk.share) == len(walk.symbol) == len(walk.rare) == 4
    for values in (np.random.default_rng(1).integers(0, 50, 500).astype(np.uint64), np.empty(0, np.uint64)):
        distinct, place = suffix_tree.distinct_places(values)
        want = np.unique(values, return_inverse=True)
        assert (distinct == want[0]).all() and (place == want[1]).all() and place.dtype == np.int32


def skewed_texts(n, tokens, seed=5):
    """Texts of words as frequent as a language's: few very often, most a few times."""
    rng = np.random.default_rng(seed)
    ranks = np.minimum(rng.zipf(1.3, (n, tokens)), 30_000)
    return [(i, " ".join(f"w{r}" for r in row)) for i, row in enumerate(ranks.tolist())]


def test_suffix_tree_keeps_and_moves_little(spark, monkeypatch):
    """What stays in the shared folder: blocks and answers, no word hashes and no second copy of answers (disk)."""
    folders = []
    monkeypatch.setattr(suffix_tree, "scratch", lambda s, name: folders.append(scratch(s, name)) or folders[-1])
    rows = skewed_texts(400, 1000)
    assert suffix_tree.score(edge_docs(spark, rows)).count() == len(rows)
    at = folders[0].removeprefix("file:")
    kept = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(at) for f in files)
    assert kept < 1.9 * sum(len(t.split()) + 1 for _, t in rows)


def test_suffix_tree_leaves_no_shuffles_and_no_setting(spark):
    """Shuffle files of the levels are gone when the tree is built (those of the few sums may stay), and the
    session's settings are as before (disk)."""
    local = spark.sparkContext.getConf().get("spark.local.dir") or tempfile.gettempdir()

    def files():
        found = {}
        for f in glob.glob(f"{local}/**/shuffle_*.data", recursive=True):
            with contextlib.suppress(OSError):  # it goes meanwhile
                found[f] = os.path.getsize(f)
        return found

    before, was = files(), spark.conf.get(suffix_tree._CLEANUP, None)
    rows = skewed_texts(100, 1000)
    scored = suffix_tree.score(edge_docs(spark, rows))
    until = time.time() + 5
    while (left := sum(n for f, n in files().items() if f not in before)) > 20_000 and time.time() < until:
        time.sleep(0.2)  # they go shortly after their job
    assert left <= 20_000 and spark.conf.get(suffix_tree._CLEANUP, None) == was
    assert scored.count() == len(rows)
    with pytest.raises(ZeroDivisionError), suffix_tree.shuffles_end(spark):
        1 / 0
    assert spark.conf.get(suffix_tree._CLEANUP, None) == was


def test_suffix_tree_pairs_take_few_bytes():
    """Keys of pairs are numbers that lie close together, not hashes, and a frequent context is dealt over ranges (disk)."""
    block = suffix_tree.Block.of([(i, t, True) for i, t in skewed_texts(200, 1000)], pa.int64())
    counts = np.bincount(block.codes, minlength=len(block.hashes))[block.order]
    totals = suffix_tree.Totals(int(counts.sum()), len(counts), 0, 0, 20, ((0, -(-len(counts) // 20)),))
    walk = suffix_tree.Walk(block, {0: (counts, None)}, totals, suffix_tree.Settings())
    (level, keys, part, (found,)), = walk.run(1)
    assert level == 1 and (np.diff(part) >= 0).all() and found.sum() == walk.candidate.sum()
    assert len(np.unique(keys)) == len(keys) and np.bincount(part, minlength=20).max() < 0.2 * len(keys)
    assert (keys[walk.pair_of] % totals.symbols == walk.symbol[block.codes[walk.at]]).all()
    packets = suffix_tree.packet_rows(level, "b", keys, [found], part)
    assert sum(len(r[3]) + len(r[4]) for r in packets) < 3.5 * len(keys)
    assert np.array_equal(np.concatenate([suffix_tree.unpack_keys(r[3]) for r in packets]), keys.astype(np.uint64))


def test_suffix_tree_blocks_come_back_whole(tmp_path):
    rows = [(i, t, i % 3 > 0) for i, t in [*EDGE, *skewed_texts(20, 200)]]
    block = suffix_tree.Block.of(rows, pa.int64())
    for _ in range(2):  # a task that runs again
        block.write(str(tmp_path), "b")
    got = suffix_tree.Block.read(str(tmp_path), "b")
    for name in ("codes", "lengths", "train", "order"):
        assert np.array_equal(getattr(got, name), getattr(block, name)), name
    assert got.ids.equals(block.ids) and [p.name for p in tmp_path.iterdir()] == ["b"]
    assert (np.diff(block.hashes[got.order].astype(object)) > 0).all()


def test_suffix_tree_many_blocks_and_ranges(spark, monkeypatch):
    """Scores do not depend on how texts are cut into blocks and keys into ranges."""
    rows = skewed_texts(150, 120)
    s = suffix_tree.Settings(depth=3, min_symbol=2, min_context=3, min_gain=-20.0)
    tree = PlainTree(rows, s)
    monkeypatch.setattr(suffix_tree, "BLOCK_CHARS", 9_000)
    monkeypatch.setattr(suffix_tree, "RANGE_BYTES", 2_500)
    got = {g["doc_id"]: g["score"] for g in suffix_tree.score(edge_docs(spark, rows), settings=s).collect()}
    assert any(len(c) == 3 for c in tree.states)
    assert got == {i: pytest.approx(tree.score(t), abs=1e-9) for i, t in rows}


def test_suffix_tree_refuses_numbers_that_do_not_fit():
    with pytest.raises(ValueError, match="min_context"):
        suffix_tree.Totals(1, 1, 0, 0, 2 ** 20, ((0, 2 ** 14),)).check_width(0)


def test_suffix_tree_edge_rows(spark):
    got = suffix_tree.score(edge_docs(spark, [*EDGE, (None, "no id here")])).collect()
    assert len(got) == len(EDGE) + 1 and all(math.isfinite(g["score"]) for g in got)
    assert next(g for g in got if g["doc_id"] is None)["held_out"] is False
    assert suffix_tree.score(empty_docs(spark)).count() == 0


def test_model_beats_the_base_on_held_out_text(spark):
    from skein.llm.queries import QUERIES
    got = QUERIES["op1_suffix_tree"](spark, "/root/testdata/sf0.01").filter("held_out").toPandas()
    assert got["score"].sum() > got["base_score"].sum()


# -- toxicity ---------------------------------------------------------------------------
def plain_kernel(u, v):
    def features(s):
        c, out = toxicity.letters([s])[0] if s else np.empty(0, int), {}
        for t in itertools.combinations(range(len(c)), 3):
            key = tuple(c[list(t)])
            if 26 not in key:
                out[key] = out.get(key, 0) + toxicity.DECAY ** (t[2] - t[0] + 1)
        return out
    a, b = features(u), features(v)
    dot = lambda x, y: sum(w * y.get(k, 0) for k, w in x.items())
    size = (dot(a, a) * dot(b, b)) ** (toxicity.NORM / 2)
    return (dot(a, b) / size) ** toxicity.POWER if size else 0.0


def test_kernel_equals_its_definition():
    some = ["idiot", "i.d.i.o.t", "idXiXot", "moron", "abcabcabcabc", "id10t", "entionthe", "pathetic" * 5, "xy", "", "|||", "naïve"]
    marks = [w for w in some if len(w) >= 4]
    got = toxicity.Landmarks(marks).against(some)
    for i, u in enumerate(some):
        for j, v in enumerate(marks):
            assert got[i, j] == pytest.approx(plain_kernel(u, v), rel=1e-4, abs=1e-5), (u, v)


@pytest.fixture(scope="module")
def labelled():
    r = random.Random(9)
    syllables = "en the on an re ti er st ha nd".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    rows = []
    for i in range(500):
        ws = [word() + ("." if r.random() < 0.1 else "") for _ in range(60)]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(4):
                ws[r.randrange(len(ws))] = r.choice(["idiot", "scumbag", "worthless", "moron"])
        rows.append((i, " ".join(ws), toxic))
    return rows


def test_held_out_accuracy_and_gaps(labelled):
    model = toxicity.fit([(t, y) for _, t, y in labelled[:350]])
    scorer = toxicity.Scorer(model)
    p = scorer.texts([t for _, t, _ in labelled[350:]])
    y = np.array([y for *_, y in labelled[350:]])
    assert ((p >= 0.5) == y).mean() > 0.95
    plain = "then the oner. Ther %s on the reti and %s. The and ston."
    clean, gaps = scorer.texts([plain % ("enti", "tier"), plain % ("i.d.i.o.t", "m-o-r-o-n")])
    assert gaps > 0.5 > clean
    long = scorer.texts([" ".join([labelled[1][1]] * 300), " ".join([labelled[1][1]] * 300 + ["you idiot moron scumbag idiot."])])
    assert long[1] > 0.5


def test_toxicity_edge_rows(spark, labelled):
    docs = edge_docs(spark, [(i, t) for i, t, _ in labelled] + [(2000 + i, t) for i, t in EDGE] + [(None, "idiot")])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in labelled] + [(0, 0, 1), (77777, 1, 1), (None, 1, 1), (3, 1, None)],
                                   "doc_id long, quality int, toxic int")
    rows = toxicity.training_sample(docs, labels)
    ids = {i for i, *_ in labelled if zlib.crc32(str(i).encode()) % 5}
    assert len(rows) == len(ids)
    got = toxicity.score(docs, toxicity.fit(rows)).collect()
    assert len(got) == docs.count() and all(0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.5) for g in got)
    assert toxicity.score(empty_docs(spark), toxicity.fit(rows)).count() == 0


def test_training_sample_is_bounded_in_rows_and_bytes(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 7)) for i in range(60)] + [(3, "a")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")  # most have no document
    rows = toxicity.training_sample(docs, labels)
    assert len(rows) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(60))
    assert len(toxicity.training_sample(docs, labels, bound=20)) == 20
    assert 0 < sum(len(t) for t, _ in toxicity.training_sample(docs, labels, byte_bound=200)) <= 200


def test_inserted_and_doubled_letters_are_found_on_given_documents():
    """Fitted on the training rows of sf0.1, one insult planted in each of 150 clean held-out documents."""
    import duckdb
    sf = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"select d.doc_id, d.text, l.toxic from '{sf}/documents.parquet' d join '{sf}/labels.parquet' l using (doc_id) "
                      "where l.toxic is not null and d.text is not null order by doc_id").fetchall()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    scorer = toxicity.Scorer(toxicity.fit([(t, y) for i, t, y in rows if not held(i)][:toxicity.TRAIN_DOCS]))
    test = [(t, y) for i, t, y in rows if held(i)]
    found = scorer.texts([t for t, _ in test]) >= 0.5
    label = np.array([y for _, y in test])
    assert label[found].mean() > 0.85 and found[label == 0].mean() < 0.02
    clean = [t for (t, y), f in zip(test, found) if not y and not f and len(t) < 20_000][:150]
    share = {}
    for kind in ("plain", "gaps", "doubled", "inserted"):
        planted = []
        for k, t in enumerate(clean):
            r, words = random.Random(k), t.split(" ")
            w = ["idiot", "loser", "worthless", "trash", "moron", "pathetic", "scum", "disgusting", "clown", "stupid"][k % 10]
            i = r.randrange(1, len(w) - 1)
            w = {"plain": w, "gaps": ".".join(w), "doubled": w[:i] + w[i] + w[i:],
                 "inserted": w[:i] + r.choice("abcdefghklmnoprstuvwxyz") + w[i:]}[kind]
            words.insert(r.randrange(len(words) + 1), w)
            planted.append(" ".join(words))
        share[kind] = (scorer.texts(planted) >= 0.5).mean()
    assert share["plain"] > 0.9 and share["gaps"] > 0.9 and share["doubled"] > 0.9 and share["inserted"] > 0.35, share


def test_without_both_labels_the_share_is_returned(spark):
    model = toxicity.fit([("a b c", 0), ("idiot", 0)])
    assert toxicity.Scorer(model).texts(["idiot", None]) == pytest.approx([0.25, 0.25])
    assert toxicity.Scorer(toxicity.fit([])).texts(["x"]) == pytest.approx([0.5])


# -- SimHash ------------------------------------------------------------------------------
def plain_print(t):
    import xxhash
    w = words(t)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """Smallest linked value per value, by all pairs."""
    up = {f: f for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {f: root(f) for f in fps}


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = np.unique(np.array([int(b) ^ sum(1 << int(k) for k in set(rng.integers(0, 64, rng.integers(0, 6)).tolist()))
                              for b in base for _ in range(25)] + [0, 2**64 - 1], np.uint64))
    distance = np.bitwise_count(fps[:, None] ^ fps[None, :])
    for radius in range(4):
        close = np.unpackbits(simhash.close_pairs(fps, radius).view(np.uint8), axis=1, bitorder="little", count=len(fps))
        assert (close == (distance <= radius)).all()


@pytest.mark.parametrize("chunk", [4, 2048])
def test_links_lose_nothing(spark, chunk):
    r = random.Random(chunk)
    fps = set()
    for _ in range(25):
        x = r.getrandbits(64)
        for _ in range(r.randint(1, 30)):
            fps.add(x)
            for _ in range(r.randint(0, 4)):
                x ^= 1 << r.randrange(64)
    want = plain_components(sorted(fps))
    from skein.operators.components import connected_components
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {a: b for a, b in connected_components(simhash.links(df, chunk=chunk)).collect()}
    groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
    assert groups({signed(f): got.get(signed(f), signed(f)) for f in fps}) == groups({signed(f): v for f, v in want.items()})


def test_near_duplicates_edge_rows(spark):
    body = " ".join(f"w{i}" for i in range(400))
    rows = [*EDGE, (30, body), (31, body + " extra"), (32, "A B C"), (None, "x"), (29, body.upper())]
    got = simhash.near_duplicates(edge_docs(spark, rows)).collect()
    prints = {(i, plain_print(t)) for i, t in rows if i is not None}
    assert sorted((g["doc_id"], g["fp"] % 2**64) for g in got) == sorted((i, plain_print(t)) for i, t in rows if i is not None)
    part = plain_components(sorted({f for _, f in prints}))
    least = {}
    for i, f in prints:
        least[part[f]] = min(i, least.get(part[f], i))
    assert all(g["component_id"] == least[part[g["fp"] % 2**64]] for g in got)
    kept = simhash.one_per_group(edge_docs(spark, rows))
    assert kept.columns == edge_docs(spark).columns
    assert sorted((r["doc_id"] is not None, r["doc_id"]) for r in kept.collect()) == sorted([(False, None), *((True, i) for i in set(least.values()))])
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def test_rows_of_one_id_in_different_groups_stay(spark):
    texts = [" ".join(f"{c}{i}" for i in range(200)) for c in "uvw"]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[1]), (2, texts[2]), (3, texts[2]), (None, texts[0])]
    kept = simhash.one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in kept) == sorted([(0, texts[0]), (1, texts[0]), (1, texts[1]), (2, texts[2])])


# -- pipeline --------------------------------------------------------------------------------
def test_pipeline_equals_the_plain_stages(spark):
    import duckdb
    from tokenizers import Tokenizer

    import corpus_pipeline
    from skein.llm.queries import word_bpe

    from .test_rules_and_spans import plain_hits, rule_figures

    from skein.llm import pii
    base = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select doc_id, text from '{base}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{base}/benchmark.parquet'").fetchall()
    kept = []
    for i, t in rows:
        n, _, _, _, rep, cov, longest = rule_figures(t)
        if n >= 50 and 100 * rep <= 50 * n and cov <= 0.4 * n and longest <= 0.3 * n:
            kept.append((i, t))
    part = plain_components(sorted({plain_print(t) for _, t in kept}))
    least = {}
    for i, t in kept:
        least[part[plain_print(t)]] = min(i, least.get(part[plain_print(t)], i))
    kept = [(i, t) for i, t in kept if i in set(least.values())]
    kept = [(i, t) for i, t in kept if plain_hits(t, items, 10)[1] == 0]
    finder, library = pii.Finder(), Tokenizer.from_file(word_bpe())
    kept = [(i, pii.masked(t, finder.spans(t))) for i, t in kept]
    want = sorted((i, t, len(t), tuple(library.encode(t, add_special_tokens=False).ids)) for i, t in kept)
    got = corpus_pipeline.run(spark, base)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids"]
    assert sorted((r["doc_id"], r["text"], r["n_chars"], tuple(r["token_ids"])) for r in got.collect()) == want


def test_pipeline_stages_edge_rows(spark):
    import corpus_pipeline
    docs = edge_docs(spark, [*EDGE, (40, " ".join(f"u{i}" for i in range(90)) + " mail x@y.org"), (None, " ".join(f"z{i}" for i in range(90)))])
    for table in (docs, docs.filter("false")):
        now = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, "/root/testdata/sf0.001")
            assert now.columns == docs.columns, name
        out = corpus_pipeline.STAGES[-1][1](spark, now, "/root/testdata/sf0.001").collect()
        if table is docs:
            assert {r["doc_id"] for r in out} == {40, 8, None} and all(r["kept"] == "own kept" for r in out)
            assert next(r for r in out if r["doc_id"] == 40)["text"].endswith("mail [EMAIL]")
        else:
            assert out == []
