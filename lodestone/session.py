"""Session helpers: a session with the settings the library is written for, and written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

_local_scratch: list[tempfile.TemporaryDirectory] = []
#: Folders of intermediate tables, in the order in which they were begun.
_staged: list[str] = []


def spark_session(master: str | None = None, app: str = "lodestone", **conf) -> SparkSession:
    """A session with adaptive execution (runtime broadcast by measured size, skew-join splitting, partition
    coalescing) on. On a cluster leave ``master`` out and size ``spark.sql.shuffle.partitions`` there."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a local-mode session without that setting
    gets a temporary folder, removed when Python exits."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_scratch:
        _local_scratch.append(tempfile.TemporaryDirectory(prefix="lodestone-"))
    return _local_scratch[0].name


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it is; nothing happens if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """What the files below a folder take, on whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the intermediate tables that were written within it. Results that read them have to be
    written or collected by then; calls may be nested."""
    first = len(_staged)
    try:
        yield
    finally:
        for path in _staged[first:]:
            remove_folder(spark, path)
        del _staged[first:]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several later steps read, and continue from the written table: the work is done
    once, survives lost executors, and is read back column by column."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _staged.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_bytes(spark: SparkSession) -> int:
    """Up to this size the planner broadcasts a table; less than 0 if it never does."""
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(10 << 20)).strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", size).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def is_small(staged: DataFrame) -> bool:
    """Whether a written table is so small that the planner broadcasts it."""
    spark = staged.sparkSession
    return sum(folder_bytes(spark, unquote(file)) for file in staged.inputFiles()) <= broadcast_bytes(spark)


def stage_bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """Like :func:`stage`, hashed by ``keys`` into as many buckets as the session has shuffle partitions, so that
    joins and aggregations on the keys read it without a shuffle.

    Bucketing needs a table name. It is given up again once the table is resolved; the files stay.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"lodestone_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark)}/{name}"
    _staged.append(path)
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    staged = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return staged
