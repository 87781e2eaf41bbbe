"""Session defaults and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Shuffle partitions are left to the cluster: adaptive execution merges small ones
# and splits the skewed sides of a join.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Java compiles no method above 8000 bytes. A wide projection or filter fused into
    # one larger method would run interpreted; unfused, Spark splits it into small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session, whose one machine is the whole cluster, may fall back to
    a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="trendlens-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`shared_dir`; nothing is created or deleted."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Lets iterative training cut its lineage; keeps a folder already set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
