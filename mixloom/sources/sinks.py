"""Writers: Parquet stages, the submission CSV, the metrics history."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Overwrite ``path`` and go on from the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_submission(submission: DataFrame, path: str, compression: str | None = None) -> None:
    """CSV with a header, optionally compressed (``gzip``), a part file for each
    partition."""
    writer = submission.write.mode("overwrite").option("header", True)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


SUBMISSION_SCHEMA = "playlist_id bigint, recommended_track_uris string"


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`write_submission`; CSV reads an empty list as null, here it is empty."""
    return spark.read.schema(SUBMISSION_SCHEMA).option("header", True).csv(path).fillna("", ["recommended_track_uris"])


def append_run_metrics(metrics: DataFrame, path: str, run_at: str, training_seconds: float) -> None:
    """Add one row to the metrics history.

    ``metrics`` is the one-row frame of :func:`mixloom.operators.ranking.score_summary`.
    """
    row = metrics.select(
        F.lit(run_at).alias("timestamp"),
        F.col("mean_ap").alias("map_score"),
        F.col("num_playlists"),
        F.lit(float(training_seconds)).alias("training_time"),
    )
    row.write.mode("append").option("header", True).csv(path)


METRICS_SCHEMA = "timestamp string, map_score double, num_playlists bigint, training_time double"
