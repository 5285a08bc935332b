"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest Arrow batch, in bytes, that is handed to Python at once; very long texts make smaller batches.
BATCH_BYTES = 8 << 20
#: States of partitions that one task, and in the end the driver, combines.
FAN_IN = 32


def session_of(df: DataFrame) -> SparkSession:
    """The session of a frame, with Arrow batches bounded in bytes as well as in rows.

    The package's sources are sent to the executors once for each application,
    so that Python workers can import it wherever they run.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not getattr(context, "_wordgrove_sent", False):
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as packed:
            for source in sorted(root.rglob("*.py")):
                packed.write(source, source.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._wordgrove_sent = True
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Only where that setting is absent (a local session, as in tests) a folder of
    this machine is taken.
    """
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_to:
        return set_to
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def new_path(spark: SparkSession) -> str:
    """A name for a table in the shared folder."""
    return f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """The frame as a Parquet table in the shared folder: its lineage is cut there.

    Like checkpoint files, the table lies there until the folder is cleared, or
    until ``remove_table`` is called on its path.
    """
    spark = df.sparkSession
    path = path or new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Deletes a table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame, computed and kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def over_batches(work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of one Arrow batch as a function of an iterator of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield work(batch)

    return run


def partition_states(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], bytes]) -> DataFrame:
    """``slot`` and ``state``: what ``work`` makes of each partition's batches, those without rows left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = work(batch for batch in batches if batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([state], pa.binary())], names=["slot", "state"])

    return rows.mapInArrow(run, "slot long, state binary")


def folded(states: DataFrame, combine: Callable[[list[bytes]], bytes]) -> bytes:
    """The states of all partitions combined, ``FAN_IN`` at a time in a tree; the last ``FAN_IN`` at most by the driver."""
    level = checkpointed(states)
    left = level.count()

    def several(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slot": [int(rows.slot.min()) // FAN_IN], "state": [combine(list(rows.sort_values("slot").state))]})

    while left > FAN_IN:
        # groups of FAN_IN states at most
        level = checkpointed(level.groupBy(F.floor(F.col("slot") / FAN_IN).alias("up")).applyInPandas(several, "slot long, state binary"))
        left = level.count()
    return combine([row.state for row in level.orderBy("slot").collect()])
