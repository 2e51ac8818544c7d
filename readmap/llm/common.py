"""What several operators need: tables, intermediate tables, state that a Python worker keeps."""

import sys
import types

from pyspark.sql import DataFrame, SparkSession

from readmap.scratch import shared_folder

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parked(frame: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: computed once, with a short lineage."""
    path = shared_folder(frame.sparkSession)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def worker_state() -> types.ModuleType:
    """A namespace that lives as long as the Python worker; functions are shipped anew with each task."""
    return sys.modules.setdefault("_readmap_worker", types.ModuleType("_readmap_worker"))


def bounded(frame: DataFrame, rows: int) -> DataFrame:
    """The table marked for broadcast if it has at most so many rows, otherwise as it is; it is counted."""
    from pyspark.sql.functions import broadcast

    return broadcast(frame) if frame.count() <= rows else frame


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_texts(frame: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` for rows that are whole texts.

    Ten thousand of them, Spark's default for a batch, take much memory on both sides: where the session
    has that default, it is lowered.
    """
    settings = frame.sparkSession.conf
    if settings.get(BATCH_SETTING, "10000") == "10000":
        settings.set(BATCH_SETTING, "500")
    return frame.mapInArrow(function, schema)
