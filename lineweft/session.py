"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Whether the files of a statement's shuffles go when it ends.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "lineweft", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Seen links are kept on disk, not in the heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local-mode session without the setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lineweft-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Lost executors then cost no recomputation of the past. Unlike a checkpoint, which
    evaluates its input once to run and once to write, the table is evaluated once, and
    its known size lets the planner choose joins. It is compressed tightly, as it is read
    a few times and then only takes room. Files of the shuffles that led to it go when it is
    written: nothing reads them again, and they would lie on the executors until the driver collects garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lineweft-{uuid.uuid4().hex}"
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that ``cut_lineage`` has written in this process, in order.
_written: list[str] = []


def written_tables() -> int:
    """How many tables ``cut_lineage`` has written; a mark for ``drop_tables``."""
    return len(_written)


def drop_tables(spark: SparkSession, since: int = 0, but_last: int = 0) -> None:
    """Delete the tables that ``cut_lineage`` has written since a mark, except the last ``but_last`` ones.

    For use when nothing lazy is left that reads them, as when a job's results are written.
    """
    end = len(_written) - but_last
    for path in _written[since:end]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    del _written[since:end]
