"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

# Only settings the operators rely on; cluster sizing stays with spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Presentation codes such as 2014D would otherwise read back as doubles.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def sized_for(input_bytes: float, task_bytes: int = 256 * 2**20, shuffled_share: float = 0.5) -> dict[str, str]:
    """Settings that keep scan and shuffle tasks near ``task_bytes`` for an input of this size.

    ``shuffled_share`` is the part of the input that reaches a shuffle after pruning and map-side
    aggregation. AQE then merges what turns out smaller and splits what turns out skewed.
    """
    partitions = max(200, math.ceil(input_bytes * shuffled_share / task_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(
    app_name: str = "learnlake", master: str | None = None, input_bytes: float | None = None, **conf: str
) -> SparkSession:
    """Session with the library defaults, sized for an input if given; ``conf`` uses ``__`` for dots in names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sizes = sized_for(input_bytes) if input_bytes else {}
    settings = DEFAULTS | sizes | {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves, but only in local mode. On a cluster a folder below the machines' own
    temporary folder is refused: each would have its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if root:
        own = urlsplit(root).path.rstrip("/") + "/"
        local = urlsplit(root).scheme in ("", "file") and own.startswith(f"{tempfile.gettempdir().rstrip('/')}/")
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir = {root} lies in a temporary folder of each machine")
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="learnlake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing path below the shared folder; what is written there goes when the application ends."""
    name = f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` and Spark ML a reliable checkpoint folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
