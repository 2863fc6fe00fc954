"""Session helpers: a local session for tests/bench, and checkpoint plumbing."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "inforce") -> SparkSession:
    """A local session with the settings the library assumes (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CKPT: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is configured by the deployment and is only read here
    (Spark then also uses it for ``DataFrame.checkpoint``). Only when it is
    unset and the master is local (tests) a scratch folder is created for this
    application and registered as the context's checkpoint directory; on a cluster
    a missing setting is an error, because a machine's own folder is not shared.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master}")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_CKPT:
        _LOCAL_CKPT[app] = tempfile.mkdtemp(prefix="inforce-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_CKPT[app])
    return _LOCAL_CKPT[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage ends there,
    a lost executor repeats only a read, and readers take only the columns they use.
    The write runs when this is called. The folder stays until the deployment's
    clean-up of ``spark.checkpoint.dir``, because results read it lazily."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where an intermediate feeds several downstream aggregations and
    recomputation after an executor loss would be expensive.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

