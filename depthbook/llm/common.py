"""What the text operators share: tables, the shared folder, bindings inside column expressions."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_made: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_path(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless it is installed with them."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which driver and executors share.

    Where the setting is absent (a local session in a test) a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Whether a query's shuffles go when it ends; else they wait for the driver's garbage collector.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, lineage cut, safe against lost executors.

    What was shuffled for it goes with the write.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        frame.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)
    _made.append(path)
    found = spark.read.schema(frame.schema).parquet(path)
    found.stored_path = path
    return found


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def forget(*frames: DataFrame) -> None:
    """Delete tables that `stored` has returned, once all that is made of them is stored or checkpointed itself.

    Shuffles and checkpoints that nothing refers to any more go too: Spark drops them when the driver's garbage is collected,
    which a driver with room to spare may not do for the length of a job.
    """
    for frame in frames:
        _made.remove(frame.stored_path)
        _delete(frame.sparkSession, frame.stored_path)
    let_go(frames[0].sparkSession)


def let_go(spark: SparkSession) -> None:
    """Have Spark drop the shuffles and checkpoints that nothing refers to any more."""
    spark._jvm.System.gc()


def drop_stored(spark: SparkSession) -> None:
    """Remove the tables that `stored` wrote in this process, once no frame built on them is needed."""
    while _made:
        _delete(spark, _made.pop())


def checkpointed(frame: DataFrame) -> DataFrame:
    shared_folder(frame.sparkSession, "")
    return frame.checkpoint()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` computed once however often `body` mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(column: str | Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def text_key(column: str | Column) -> Column:
    """Tells rows with equal ids and different texts apart."""
    return F.xxhash64(text_of(column))
