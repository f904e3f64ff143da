"""Edge-case rows shared by the operator tests."""

from pyspark.sql import functions as F

CLASHING = ("kept", "score", "fp", "n_words", "file", "shard", "start", "n_tokens", "pii_spans", "token_ids", "hit_spans", "_spans",
            "component_id", "text_len", "held_out", "predicted", "_train", "level", "base_score", "host", "verdict", "decoded")

LONG = " ".join(f"w{i % 4999}x{i % 7}" for i in range(20_000))

EDGE = [(1, None), (2, ""), (3, " \n\t \x0b"), (4, "Word"), (5, "a b c"), (5, "a b c"), (6, "A B c"), (7, "x" * 30_000), (8, LONG), (9, LONG),
        (10, "é ñ ü\u00a0ß 12 🙂"), (11, "the same line\nthe same line\nthe same line")]


def edge_docs(spark, rows=EDGE):
    """Documents with extra columns whose names clash with results."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def empty_docs(spark):
    return edge_docs(spark).filter("false")


def words(text):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)
