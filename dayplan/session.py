"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
Result = TypeVar("Result")

# Safe on any cluster: AQE sizes partitions, splits skewed join partitions and
# turns a join into a broadcast only when the measured side is small.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_spark(app_name: str = "dayplan", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the recommended settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED_CONF)
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="dayplan-")
    context.setCheckpointDir(local)
    return context.getCheckpointDir().rstrip("/")


def task_count(spark: SparkSession) -> int:
    """Tasks to spread small rows over before a CPU-heavy or growing step."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, spark.sparkContext.defaultParallelism)


class Scratch:
    """Tables written under the shared folder by one operator run.

    A written table cuts the lineage, survives lost executors, is columnar, and
    gives the optimizer real sizes for its broadcast decisions.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_counting(self, df: DataFrame, name: str, condition: str = "true") -> tuple[DataFrame, int]:
        """Like ``write``, and the number of rows that meet ``condition``, in the same job."""
        seen = Observation()
        counted = df.observe(seen, F.count(F.when(F.expr(condition), 1)).alias("n"))
        stored = self.write(counted, name)
        return stored, int(seen.get["n"])


def side_by_side(*steps: Callable[[], Result]) -> list[Result]:
    """What the steps give, run at the same time: the many short jobs of one leave room for those of another.

    For a few steps that do not need each other. All are waited for; then the first failure is raised.
    """
    session = SparkSession.getActiveSession()
    inherit = inheritable_thread_target(session) if session else inheritable_thread_target
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        running = [pool.submit(inherit(step)) for step in steps]
    return [r.result() for r in running]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it as a stored table."""
    return Scratch(df.sparkSession, tag).write(df, "data")
