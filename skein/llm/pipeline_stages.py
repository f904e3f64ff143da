"""Stage functions of the corpus pipeline: `(spark, docs, sf_dir) -> DataFrame`.

Each applies one operator to all of its input and returns the columns it was
given (the last stage adds `token_ids`).  The documents' columns are renamed by
position while an operator works, so extra columns may have any name.

Defined cases: empty tables give empty tables; a null text fails the quality
rules; repeated rows are judged alike and near-dedup keeps one of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, pii, quality_rules as rules, simhash
from .queries import table, word_bpe


def shielded(docs: DataFrame, work: Callable[[DataFrame, dict[str, str]], DataFrame]) -> DataFrame:
    """Run `work` on the documents with neutral column names and give back the
    documents' columns under their own names."""
    safe = [f"_doc{i}" for i in range(len(docs.columns))]
    out = work(docs.toDF(*safe), dict(zip(docs.columns, safe)))
    return out.select(*safe).toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or repeat themselves too much go."""
    return shielded(docs, lambda d, c: rules.judge(d, c["text"], only_kept=True))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (the smallest id) stays."""
    return shielded(docs, lambda d, c: simhash.one_per_group(d, c["doc_id"], c["text"]))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    bench = table(spark, sf_dir, "benchmark")
    return shielded(docs, lambda d, c: decontaminate.find_contamination(d, bench, c["text"]).filter(F.size("hit_spans") == 0))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; `n_chars` follows the text."""
    out = shielded(docs, lambda d, c: pii.mask_pii(d, c["text"]))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(*docs.columns)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the token ids of their texts."""
    return bpe.encode(docs, word_bpe())
