"""BPE encoding and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from skein.llm import bpe, token_files
from skein.llm.queries import word_bpe

from .edge import EDGE, edge_docs, empty_docs

PATH = word_bpe()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def samples():
    r = random.Random(7)
    mixed = "abcdeé'sstt  ΣσÀİß\x1c\x85 ́的あ12½²_-<|>\n\t🙂ǅ\xad\x00"
    out = ["".join(r.choice(mixed) for _ in range(r.randint(0, 40))) for _ in range(400)]
    out += ["".join(r.choice("aaabbeinth") for _ in range(r.randint(1, 60))) for _ in range(400)]
    return out + ["<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "don't we'll", "x" * 5000, "ab" * 3000 + " c"]


def test_encoder_equals_the_library(library):
    enc = bpe.encoder(PATH, "ids")
    for text, row in zip(samples(), enc.texts(samples())):
        assert [i for token in row for i in token] == ids(library, text), text


def test_pairs_are_tested_exactly():
    b = bpe.tables(PATH)
    r = random.Random(3)
    some = r.choices(list(b.proposals.items()), k=3000)
    first = [(s, i) for s, i in some if ord(s[-1]) < 256][:900]
    second = r.choices(some, k=len(first))
    got = b.compatible(np.array([i for _, i in first]), np.array([i for _, i in second]))
    for (s, i), (t, j), ok in zip(first, second, got):
        assert (b.merge(s + t) == [i, j]) == bool(ok), (s, t)


def test_heap_and_short_merging_agree(monkeypatch):
    b = bpe.tables(PATH)
    r = random.Random(5)
    some = [b.word("".join(r.choice("theandionrs") for _ in range(r.randint(1, 38)))) for _ in range(300)]
    short = [b.merge(w) for w in some]
    monkeypatch.setattr(bpe, "SHORT_WORD", 0)
    assert [b.merge(w) for w in some] == short


def test_bounded_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    enc = bpe.Encoder(bpe.tables(PATH), lambda x: x)
    for t in samples()[:60]:
        assert [i for token in enc.texts([t])[0] for i in token] == ids(library, t)


def test_encode_decode_edge_rows(spark, library):
    docs = edge_docs(spark)
    got = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted((r["doc_id"], tuple(r["token_ids"])) for r in got) == sorted((i, tuple(ids(library, t))) for i, t in EDGE)
    for r in got:
        assert r["decoded"] == (library.decode(r["token_ids"], skip_special_tokens=False) if r["token_ids"] else "")
        assert r["kept"] == "own kept"
    assert bpe.digest(empty_docs(spark), PATH).count() == 0


def test_token_files_round_trip(spark, library, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    docs = edge_docs(spark).repartition(5)
    index = token_files.write_token_files(docs, PATH, folder, length=16)
    got = sorted(token_files.read_token_files(index, folder).collect(), key=lambda r: (r["start"], r["doc_id"]))
    want, at = [], 0
    for i, t in sorted(EDGE, key=lambda r: (r[0], r[1] or "")):
        e = ids(library, t) + [2]
        want.append((i, at, len(e), zlib.crc32(np.array(e, "<u4").tobytes())))
        at += len(e)
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == want


def test_sequences_and_masks(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BATCH_SEQUENCES", 3)
    packed = [np.arange(i, i + n).astype(np.uint16) for i, n in ((0, 5), (100, 61), (7, 1), (900, 130))]
    writer = token_files.ShardWriter(str(tmp_path), "s.arrow", np.dtype(np.uint16), 8)
    for p in packed:
        writer.add(p)
    writer.close()
    flat = np.concatenate(packed)
    reader = token_files.ShardReader(str(tmp_path), "s.arrow")
    at = 0
    for p in packed:
        assert (reader.ids(at, len(p)) == p).all()
        at += len(p)
    for i in range(-(-len(flat) // 8)):
        tokens, mask = reader.sequence(i)
        part = flat[8 * i:8 * i + 8]
        assert len(tokens) == 8 and (tokens[:len(part)] == part).all() and mask.tolist() == [k < len(part) for k in range(8)]


def test_files_of_other_attempts_are_not_read(spark, library, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    docs = edge_docs(spark)
    first = token_files.read_token_files(token_files.write_token_files(docs, PATH, folder), folder)
    want = sorted(map(tuple, first.select("doc_id", "start", "ids_crc32").collect()))
    again = token_files.read_token_files(token_files.write_token_files(docs, PATH, folder), folder)
    assert sorted(map(tuple, again.select("doc_id", "start", "ids_crc32").collect())) == want


def test_empty_table_has_no_shards(spark, tmp_path):
    assert token_files.round_trip(empty_docs(spark), PATH, f"file://{tmp_path}/t").count() == 0


def test_rows_of_one_id_have_one_order_over_all_shards(spark, tmp_path):
    """By hash of the text, then text: `start` does not depend on where the shards are cut."""
    docs = spark.createDataFrame([(5, f"text {i} " + "word " * (i % 9)) for i in range(400)], "doc_id long, text string")
    starts = []
    for shards in (1, 6):
        spark.conf.set("spark.sql.shuffle.partitions", str(shards))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            rows = token_files.round_trip(docs, PATH, f"file://{tmp_path}/{shards}").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        starts.append(sorted((r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows))
    assert starts[0] == starts[1] and starts[0][0][0] == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_queries_over_whole_tables(spark, library, sf):
    import hashlib

    import duckdb

    from skein.llm.queries import QUERIES
    base = f"/root/testdata/{sf}"
    rows = duckdb.sql(f"select doc_id, text from '{base}/documents.parquet' order by doc_id, text").fetchall()
    enc = [ids(library, t) for _, t in rows]
    files = sorted(map(tuple, QUERIES["op10_token_files"](spark, base).collect()))
    at, want = 0, []
    for (i, _), e in zip(rows, enc):
        want.append((i, at, len(e) + 1, zlib.crc32(np.array([*e, 2], "<u4").tobytes())))
        at += len(e) + 1
    assert files == sorted(want)
    got = sorted(map(tuple, QUERIES["op7_bpe"](spark, base).collect()))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted((i, len(e), sha(" ".join(map(str, e))), sha(library.decode(e, skip_special_tokens=False))) for (i, _), e in zip(rows, enc))
