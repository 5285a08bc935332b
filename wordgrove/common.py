"""Helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Leaves ``spark.checkpoint.dir`` as the cluster set it; only a local session without one gets a folder of its own."""
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        spark.sparkContext.setCheckpointDir(named)
    elif spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    else:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame, computed and kept in the shared folder, so that loops don't grow their lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()



def scratch_path(spark: SparkSession) -> str:
    """A name for a new table or folder in the shared folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder.

    For loops whose state is computed from itself: a checkpoint still carries what
    the optimiser knows of the columns, which doubles with every round there.
    Ids pack so well in files that millions of rows look small enough to broadcast
    through the driver, so joins with it are merged unless they say otherwise.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).hint("merge")
