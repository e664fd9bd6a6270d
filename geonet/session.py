"""Session settings, and durable intermediate tables for the iterative operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: str = "*", shuffle_partitions: int = 8, memory: str = "12g", scratch: str | None = None) -> SparkSession:
    """Session for tests and benches; a cluster brings its own.  ``scratch`` is where intermediate tables go."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("geonet")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", memory)
    if scratch:
        builder = builder.config("spark.checkpoint.dir", f"file://{scratch}")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session that names none gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="geonet-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/geonet/{uuid.uuid4().hex}-{name}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that no later plan reads."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later steps read, so that none of them computes it again."""
    return Scratch(df.sparkSession, name).cut(df, name)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables; frames built on them can no longer be read."""
    drop_path(spark, f"{scratch_root(spark).rstrip('/')}/geonet")


class Scratch:
    """Written tables of one iterative job.

    ``cut`` writes a frame and reads it back, which ends the lineage, survives the loss of
    executors and gives the next round exact sizes.  A table written under a name replaces the
    one before it: the earlier copy is removed once the new one is complete.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, name)
        self.current: dict[str, str] = {}
        self.serial = 0

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        self.serial += 1
        path = f"{self.base}/{name}-{self.serial}"
        df.write.parquet(path)
        previous = self.current.get(name)
        if previous:
            drop_path(self.spark, previous)
        self.current[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def cut_watched(self, df: DataFrame, name: str, **watch: str) -> tuple[DataFrame, dict]:
        """``cut`` that also returns aggregates (SQL expressions) of the rows as they are written."""
        seen = Observation()
        out = self.cut(df.observe(seen, *[F.expr(e).alias(n) for n, e in watch.items()]), name)
        return out, seen.get
