"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are written for. Skew splitting is forced because several
# joins share one key in a row (order_id): without it the optimizer keeps a hot partition whole
# to save the extra exchange.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a task aggregates or sorts is many times larger in memory than stored: parts of this size
    # keep it from spilling at a few hundred MB a core.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}

# AQE merges small shuffle partitions but cannot split a large one under an aggregate, so the
# initial count has to fit the data: one partition per this many bytes of the largest shuffle.
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024


def shuffle_partitions_for(largest_shuffle_bytes: int, cores: int) -> int:
    """Initial shuffle partition count, given the size of the largest shuffle.

    Only the columns in use are shuffled, so that is a fraction of the raw input: order items
    and payments without texts, on the order of a tenth.
    """
    return max(cores, -(-largest_shuffle_bytes // BYTES_PER_SHUFFLE_PARTITION))


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the defaults above; ``master=None`` leaves it to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> None:
    """Set the SQL defaults on a session built elsewhere, keeping what its owner chose."""
    chosen = spark.sparkContext.getConf()
    for key, value in SQL_DEFAULTS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A temporary folder is chosen only in local mode, where one machine holds every task.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def remove_intermediates(spark: SparkSession) -> bool:
    """Delete what this application has stored in the shared folder, on whatever file system it is.

    Frames over such tables can no longer be read. Returns whether there was anything.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/tidemark/{context.applicationId}"
    )
    return path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def use_reliable_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits checkpoint into the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a frame that reads it back.

    Used where several consumers must see the very same rows: floating sums and sampled range
    bounds may differ between two computations, and a lost executor would otherwise mix them.
    Everything of one application lies in one folder, to be removed when it has ended.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/tidemark/{app}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
