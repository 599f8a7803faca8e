"""Where a job may put intermediate tables.

Everything written here must be readable by every executor, so that a lost
executor costs a re-read and not the job.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from threading import RLock

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder would
    not be visible to the other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can read")
            named = tempfile.mkdtemp(prefix="mixloom-", dir="/tmp")
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


def scratch_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables, below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/mixloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the scratch folder; never one that exists already."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete all this application has staged; DataFrames that still read it fail then."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Spark's own removal of a query's shuffle files when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_one_at_a_time = RLock()  # the setting is the session's, and models may be scored side by side


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that is run here go as soon as it has ended, and not when the
    driver happens to collect its garbage; nothing may read them again."""
    with _one_at_a_time:
        before = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
        try:
            yield
        finally:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, name: str, drop_shuffles: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder and go on from the files: the lineage ends here,
    later reads take only the columns they need, and the planner knows the size.

    With ``drop_shuffles`` the write is within :func:`shuffles_dropped`. ``compression`` is for
    tables of long texts, which ``zstd`` makes far smaller than Spark's default does.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", compression) if compression else df.write
    with shuffles_dropped(spark) if drop_shuffles else nullcontext():
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the table of :func:`staged` that ``df`` reads; nothing may read it after."""
    spark = df.sparkSession
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if f"/mixloom-{spark.sparkContext.applicationId}/" not in path:
            raise ValueError(f"not a staged table: {path}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
