"""Session settings and the shared checkpoint folder.

Operators never change session settings behind the caller's back; the only
thing they need from the session is a reliable checkpoint folder for
iterative jobs (thread walks, closures).  That folder is read from the
session (`spark.checkpoint.dir`, as a cluster names it).  A folder is set
here only when none is configured, which happens in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "skein") -> SparkSession:
    """Session for tests and the local bench (local mode, UI off)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", "16g")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.partition("[")[0] != "local":  # local-cluster has executors of its own
            # a machine-local folder is not visible to other executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        # Unset in a local session (tests, ad-hoc runs): a scratch folder of our own.
        configured = tempfile.mkdtemp(prefix="skein-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: written to the shared folder, survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage_counting(df: DataFrame, condition) -> tuple[DataFrame, int]:
    """Checkpoint `df` and count the rows meeting `condition` in the same job
    (an `Observation` on the checkpoint's own pass, no second scan)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    obs = Observation()
    cp = cut_lineage(df.observe(obs, F.count_if(condition).alias("n")))
    return cp, int(obs.get["n"] or 0)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for staged table writes."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Written as a Parquet table in the shared folder and read back.  Cuts lineage like a checkpoint and
    gives the planner the table's own size: the size estimate of a checkpoint is that of its whole plan,
    which grows without end in rounds of joins."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
