"""The implicit-feedback factor model, on MLlib's ALS."""

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Event, Thread

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixloom.operators.ranking import K, score_summary, scores_of_lists
from mixloom.operators.scoring import best_lists, rows_of
from mixloom.sources.versions import folder_of, new_attempt, publish
from mixloom.storage import drop_staged, shared_dir, staged

# The model's parameters.
PARAMETERS = {
    "rank": 32,
    "maxIter": 10,
    "regParam": 0.08,
    "alpha": 20.0,
    "numUserBlocks": 16,
    "numItemBlocks": 16,
    "seed": 42,
}
ROWS_PER_BLOCK = 1_000_000
FIT_ROWS_PER_BLOCK = 2_000_000  # a task holds the factors of all that the rows of a block name
COLLECT_SECONDS = 10
FACTOR_TABLES = ["model/userFactors", "model/itemFactors"]  # of a saved model


def als_rows(interactions: DataFrame) -> DataFrame:
    """Indices as INT and the count as FLOAT; rows that do not cast are dropped."""
    return interactions.select(
        F.col("playlist_idx").try_cast("int").alias("playlist_idx"),
        F.col("track_idx").try_cast("int").alias("track_idx"),
        F.col("count").try_cast("float").alias("count"),
    ).dropna()


def als_input(interactions: DataFrame, partitions: int | None = None) -> DataFrame:
    """Clean rows, spread evenly and kept in memory or on disk for the
    iterations. Empty input is an error.

    Spread by both keys: the solver groups the rows into its own blocks, and by
    playlist alone a large playlist would fill one partition.
    """
    keys = ["playlist_idx", "track_idx"]
    rows = als_rows(interactions)
    spread = rows.repartition(partitions, *keys) if partitions else rows.repartition(*keys)
    spread = spread.persist(StorageLevel.MEMORY_AND_DISK)
    if spread.isEmpty():
        spread.unpersist()
        raise ValueError("no interactions to train on")
    return spread


def blocks_for(rows: int, per_block: int = ROWS_PER_BLOCK) -> int:
    """Blocks of playlists and of tracks: as many as the parameters say, and more for more
    rows, since they bound the tasks of a half-iteration."""
    return max(PARAMETERS["numUserBlocks"], -(-rows // per_block))


def make_als(**overrides) -> ALS:
    """Non-negative implicit ALS."""
    return ALS(
        userCol="playlist_idx",
        itemCol="track_idx",
        ratingCol="count",
        implicitPrefs=True,
        nonnegative=True,
        coldStartStrategy="drop",
        **{**PARAMETERS, **overrides},
    )


@contextmanager
def _shuffles_dropped(spark: SparkSession, every: float = COLLECT_SECONDS) -> Iterator[None]:
    """Meanwhile the driver collects its garbage now and then: Spark deletes a shuffle's files when
    nothing refers to the shuffle any more, and a driver with memory to spare seldom notices."""
    ended = Event()

    def collect() -> None:
        while not ended.wait(every):
            spark._jvm.System.gc()

    thread = Thread(target=collect, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()


def fit_rows(rows: DataFrame, **overrides) -> ALSModel:
    """Fit on the result of :func:`als_input`, in blocks of ``FIT_ROWS_PER_BLOCK`` rows: a task
    holds a block's rows and the factors of each track or playlist they name, which Spark cannot
    spill, so more rows make more blocks and not larger ones. A factor is sent to each block that
    needs it, so there are no more than memory asks for. The shared checkpoint folder cuts the
    lineage of the factors in every iteration (``checkpointInterval``), so that the shuffles of
    the iterations before can be deleted, instead of being kept to the end of the fit."""
    spark = rows.sparkSession
    shared_dir(spark)
    blocks = blocks_for(rows.count(), FIT_ROWS_PER_BLOCK)
    als = make_als(**{"numUserBlocks": blocks, "numItemBlocks": blocks, "checkpointInterval": 1, **overrides})
    with _shuffles_dropped(spark):
        return als.fit(rows)


def fit(interactions: DataFrame, **overrides) -> ALSModel:
    """Fit on the cleaned interactions."""
    rows = als_input(interactions)
    try:
        return fit_rows(rows, **overrides)
    finally:
        rows.unpersist()


def train_summary(rows: DataFrame, als: ALS, run_at: str) -> DataFrame:
    """What a run is fitted on and its parameters, one row. ``rows`` is the result of
    :func:`als_input`; ``num_blocks`` is the number of its partitions."""
    partitions = rows.rdd.getNumPartitions()
    return rows.agg(F.count(F.lit(1)).alias("num_interactions")).select(
        F.lit(run_at).alias("timestamp"),
        "num_interactions",
        F.lit(als.getMaxIter()).alias("num_iterations"),
        F.lit(als.getRank()).alias("rank"),
        F.lit(als.getRegParam()).alias("reg_param"),
        F.lit(als.getAlpha()).alias("alpha"),
        F.lit(partitions).alias("num_blocks"),
    )


def factors_of(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """(playlist_idx, features) and (track_idx, features)."""
    return model.userFactors.withColumnRenamed("id", "playlist_idx"), model.itemFactors.withColumnRenamed("id", "track_idx")


def lists_for_all(model: ALSModel, k: int = K) -> DataFrame:
    """(playlist_idx, track_idxs[]): the best ``k`` tracks for every playlist, best first."""
    return best_lists(*factors_of(model), k).drop("scores")


def recommend_all(model: ALSModel, k: int = K) -> DataFrame:
    """(playlist_idx, rank, track_idx) of the best ``k`` tracks for every playlist."""
    return rows_of(lists_for_all(model, k))


def lists_for_subset(model: ALSModel, playlists: DataFrame, k: int = K) -> DataFrame:
    """The lists for the playlists of a ``playlist_idx`` column; the cost grows with them."""
    users, items = factors_of(model)
    return best_lists(users.join(playlists.select("playlist_idx"), "playlist_idx", "left_semi"), items, k).drop("scores")


def recommend_subset(model: ALSModel, playlists: DataFrame, k: int = K) -> DataFrame:
    """The same as ranked rows."""
    return rows_of(lists_for_subset(model, playlists, k))


def lists_unseen(model: ALSModel, seeds: DataFrame, k: int = K) -> DataFrame:
    """Lists of the best ``k`` tracks that are not among a playlist's own, for the playlists of
    ``seeds`` that the model knows."""
    users, items = factors_of(model)
    pairs = seeds.select("playlist_idx", "track_idx")
    return best_lists(users.join(pairs.select("playlist_idx"), "playlist_idx", "left_semi"), items, k, pairs).drop("scores")


def recommend_unseen(model: ALSModel, seeds: DataFrame, k: int = K) -> DataFrame:
    """The same as ranked rows."""
    return rows_of(lists_unseen(model, seeds, k))


def normal_equation_errors(model: ALSModel, interactions: DataFrame) -> DataFrame:
    """(playlist_idx, error): how far each playlist's factors are from solving their own problem,
    given the tracks' factors, which is what the last half-iteration of a fit solves.

    With y the factors of the playlist's tracks, c = alpha * count and Y those of all tracks, the
    gradient is Y'Y x + sum c y (y.x) - sum (1 + c) y + reg n x. It must be zero where a factor is
    positive, and not negative where it is zero; ``error`` is the largest departure as a share
    of the largest entry of sum (1 + c) y. Y'Y is rank x rank, whatever the number of tracks.
    """
    users, items = factors_of(model)
    rank, reg, alpha = model.rank, PARAMETERS["regParam"], PARAMETERS["alpha"]
    y = [F.element_at("y", k + 1).cast("double") for k in range(rank)]
    squares = items.withColumnRenamed("features", "y").agg(*[F.sum(y[i] * y[j]).alias(f"s{i}_{j}") for i in range(rank) for j in range(i, rank)]).first()
    gram = F.array(*[F.array(*[F.lit(squares[f"s{min(i, j)}_{max(i, j)}"]) for j in range(rank)]) for i in range(rank)])

    def product(one, other):
        return F.aggregate(F.zip_with(one, other, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda total, x: total + x)

    pairs = als_rows(interactions).join(items.withColumnRenamed("features", "y"), "track_idx")
    judged = pairs.join(users.withColumnRenamed("features", "x"), "playlist_idx")
    c = F.col("count").cast("double") * alpha
    judged = judged.withColumn("inner", product("y", "x"))
    sums = [F.sum(c * F.col("inner") * y[k]).alias(f"a{k}") for k in range(rank)] + [F.sum((1 + c) * y[k]).alias(f"b{k}") for k in range(rank)]
    summed = judged.groupBy("playlist_idx").agg(F.count(F.lit(1)).alias("n"), *sums).join(users, "playlist_idx")
    x = [F.element_at("features", k + 1).cast("double") for k in range(rank)]
    own = [product(F.element_at(gram, k + 1), "features") + F.col(f"a{k}") + reg * F.col("n") * x[k] - F.col(f"b{k}") for k in range(rank)]
    wrong = [F.when(x[k] > 0, F.abs(own[k])).otherwise(F.greatest(-own[k], F.lit(0.0))) for k in range(rank)]
    largest = F.greatest(*[F.abs(F.col(f"b{k}")) for k in range(rank)])
    return summed.select("playlist_idx", (F.greatest(*wrong) / largest).alias("error"))


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


def save_version(spark: SparkSession, model: ALSModel, root: str, run_id: str) -> None:
    """A time-stamped copy; see :mod:`mixloom.sources.versions`."""
    attempt = new_attempt(root, run_id)
    save_model(model, f"{attempt}/model")
    publish(spark, root, run_id, attempt, FACTOR_TABLES)


def load_newest(spark: SparkSession, root: str) -> ALSModel:
    return load_model(f"{folder_of(spark, root)}/model")


def grid_search(train: DataFrame, validation: DataFrame, grid: list, k: int = K) -> DataFrame:
    """One row per parameter set with its MAP@k on ``validation``.

    The loop runs over the few parameter sets; each fit and score is a Spark job
    over all of ``train`` and ``validation``.
    """
    spark = train.sparkSession
    rows, results = als_input(train), []
    wanted = validation.select("playlist_idx").distinct()
    for parameters in grid:
        lists = staged(lists_for_subset(fit_rows(rows, **parameters), wanted, k), "grid-lists", drop_shuffles=True)
        row = score_summary(scores_of_lists(lists, validation, k)).first()
        drop_staged(lists)
        als = make_als(**parameters)
        results.append(
            (als.getRank(), als.getRegParam(), als.getAlpha(), row["mean_ap"], row["num_playlists"])
        )
    rows.unpersist()
    schema = "rank int, reg_param double, alpha double, mean_ap double, num_playlists bigint"
    return spark.createDataFrame(results, schema).orderBy(F.desc_nulls_last("mean_ap"))
