"""Corpus cleaning pipeline: quality rules, SimHash near-dedup, benchmark
decontamination, PII masking, BPE encoding.

Every stage takes the documents that its predecessor kept, as rows of a Parquet
table in the session's shared folder, and its decisions take effect: rejected
documents go, one document of each near-duplicate group stays, contaminated
documents go, personal data is replaced in the text, and the last stage adds the
token ids."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skein.llm import pipeline_stages as stages  # noqa: E402
from skein.llm.common import staged  # noqa: E402

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("benchmark_decontamination", stages.benchmark_decontamination),
    ("pii", stages.mask_pii),
    ("bpe", stages.bpe_encode),
]

#: Suffix arrays, fingerprints and token ids have no SQL form; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
