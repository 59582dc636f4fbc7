"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app_name: str = "millrace", **conf: str) -> SparkSession:
    """A session with the semantics the library expects.

    Only semantics are set here (UTC, adaptive execution). Sizing such as the
    number of shuffle partitions belongs to the cluster, so pass it as ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    On a local master without that setting a temporary folder is used. On a
    cluster the setting is required: a machine-local folder would be lost with
    its machine.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return sc.getCheckpointDir().rstrip("/")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder; nothing is created yet."""
    return f"{scratch_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage like a checkpoint does, but stays columnar, so later steps
    prune columns. Later steps see one fixed set of rows even when an executor
    is lost.
    """
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
