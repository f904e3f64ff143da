"""Stores dealt by a hash of their keys.

`write_bucketed` makes a catalog table whose files are the engine's own hash partitions of the keys: joins
and aggregations on them read the stored side in place, without a shuffle (K07, J13, G07).

The versioned store keeps one folder per bucket and version.  A merge (D01) reads the buckets that hold a
key of the change, writes those anew under the next version and then one manifest, which names the
version of every bucket.  Files of other buckets are neither read nor written, nothing is staged twice, readers see
the old version until the manifest is there, and a merge that fails leaves nothing that is read.

    <root>/data/version=V/bucket=B/*.parquet      rows
    <root>/manifest/version=V/*.parquet           bucket, at (its version), for all buckets
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables

#: Tasks that write one bucket of the versioned store: neither a bucket nor a hot key is one task's work.
TASKS_PER_BUCKET = 4


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """`df` as the catalog table `table`, hashed into `buckets` by `keys` and sorted by them; one file a
    bucket, since the rows are dealt by the same hash before the write.  Choose keys without hot values
    (the whole primary key) and as many buckets as give files of 128 to 512 MB."""
    w = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (w.option("path", path) if path else w).saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest manifest: `bucket, at`; none if there is no store."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(root, "manifest"))
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(at):
        return None
    # a manifest counts once its write is complete
    done = [int(s.getPath().getName().split("=")[1]) for s in system.listStatus(at)
            if s.getPath().getName().startswith("version=") and system.exists(s.getPath().suffix("/_SUCCESS"))]
    return spark.read.schema("bucket int, at long").parquet(os.path.join(root, "manifest", f"version={max(done)}")) if done else None


def current_version(spark: SparkSession, root: str) -> dict[int, int]:
    """`bucket -> version` of the newest manifest (one entry per bucket that has rows)."""
    manifest = _versions(spark, root)
    return {r["bucket"]: r["at"] for r in manifest.collect()} if manifest is not None else {}


def _write_version(rows: DataFrame, root: str, version: int, keys: Sequence[str], buckets: int, held: dict[int, int]) -> None:
    spark = rows.sparkSession
    data = os.path.join(root, "data", f"version={version}")
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(TASKS_PER_BUCKET))
    (rows.withColumns({"bucket": bucket_of(keys, buckets), "_salt": salt}).repartition("bucket", "_salt").drop("_salt")
     .sortWithinPartitions("bucket", *keys).write.mode("overwrite").partitionBy("bucket").parquet(data))
    new = {r["bucket"] for r in spark.read.schema(f"{_ddl(rows)}, bucket int").parquet(data).select("bucket").distinct().collect()}
    manifest = [(b, version if b in new else v) for b, v in {**{b: version for b in new}, **held}.items()]
    spark.createDataFrame(manifest, "bucket int, at long").coalesce(1).write.mode("overwrite").parquet(
        os.path.join(root, "manifest", f"version={version}"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def create_store(df: DataFrame, root: str, keys: Sequence[str], buckets: int) -> None:
    """A new store of `df`, one row per key."""
    _write_version(df, root, 0, keys, buckets, {})


def read_store(spark: SparkSession, root: str, schema: str, only: Iterable[int] | None = None) -> DataFrame:
    """The rows of the newest version, of all buckets or `only` some: just their folders are read."""
    at = current_version(spark, root)
    chosen = at if only is None else {b: at[b] for b in only if b in at}
    if not chosen:
        return spark.createDataFrame([], schema)
    base = os.path.join(root, "data")
    paths = [os.path.join(base, f"version={v}", f"bucket={b}") for b, v in sorted(chosen.items())]
    return spark.read.schema(schema).parquet(*paths)


def merge_store(changes: DataFrame, root: str, schema: str, keys: Sequence[str], buckets: int,
                merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> list[int]:
    """D01 on a stored table: merge `changes` (one row per key) into the buckets that hold their keys and return
    those buckets.  `merge(stored, changes)` defaults to the null-aware upsert.

    `buckets` and `keys` are those the store was made with.  One merge runs at a time."""
    spark = changes.sparkSession
    merge = merge or (lambda stored, new: tables.upsert_coalesce(stored, new, keys))
    touched = sorted(r["b"] for r in changes.select(bucket_of(keys, buckets).alias("b")).distinct().collect())  # at most `buckets`
    if not touched:
        return touched
    held = current_version(spark, root)
    merged = merge(read_store(spark, root, schema, touched), changes)
    version = max(held.values(), default=-1) + 1
    _write_version(merged, root, version, keys, buckets, held)
    return touched
