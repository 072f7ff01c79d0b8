"""Session settings shared by the queries, the tests and the benchmark."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "brightloom", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; `conf` overrides any setting.

    On a cluster `master`, memory and shuffle partitions come from spark-submit,
    so nothing here pins them unless the caller asks for it.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    The cluster names it in `spark.checkpoint.dir`. Where that is unset (tests,
    a laptop) it is a folder below the warehouse, which all executors share too.
    """
    context = spark.sparkContext
    folder = (
        context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    )
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and cut its lineage there.

    Used where one frame feeds many model fits: a lost executor re-reads the
    files instead of replaying the whole upstream plan, and non-deterministic
    upstream row placement cannot change between two reads.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared checkpoint folder, read back from there.

    Like `checkpointed`, but in columns: a reader of few columns reads no others.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
