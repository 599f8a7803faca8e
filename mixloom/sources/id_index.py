"""An index from playlist ids to the slice files that hold them.

A lookup by id without an index reads the whole corpus, unless files are named after their ids.
The index is a Parquet table (pid, file, place, size, modified) sorted by id over range
partitions, so that a filter on ids reads few row groups of it, and a lookup then opens the files
it names and no others.

Each build is a version of its own (:mod:`mixloom.sources.versions`): readers of an older one are
not disturbed. A refresh reads new and changed files only, and takes the rows of all other files
from the newest version. A file that has changed since it was indexed is an error in a lookup,
as its rows may be wrong; a file that is gone is one for the reader.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixloom.operators import cards
from mixloom.operators.flatten import playlists_of
from mixloom.schema import SLICE, SLICE_GLOB, slice_schema
from mixloom.sources.slices import read_slices
from mixloom.sources.versions import newest_run, read_newest, write_version

STATE = ["size", "modified"]


def slice_files(spark: SparkSession, path, name_glob: str = SLICE_GLOB) -> DataFrame:
    """(file, size, modified) of the matching files; none of them is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", name_glob).load(path)
    return listed.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def ids_in(spark: SparkSession, files) -> DataFrame:
    """(pid, file, place) of the playlists in ``files``, a path or several."""
    read = read_slices(spark, files, schema=slice_schema(["pid"]), name_glob="*")
    rows = read.select(F.col("_metadata.file_path").alias("file"), F.posexplode("playlists").alias("place", "one"))
    return rows.select("one.pid", "file", "place").filter("pid is not null")


def _written(rows: DataFrame, root: str, run_id: str) -> None:
    write_version(rows.repartitionByRange("pid", "file").sortWithinPartitions("pid", "file", "place"), root, run_id)


def build_index(spark: SparkSession, path, root: str, run_id: str, name_glob: str = SLICE_GLOB) -> None:
    """Index all matching files below ``path`` as version ``run_id`` of the index at ``root``."""
    files = slice_files(spark, path, name_glob)
    read = read_slices(spark, path, name_glob, slice_schema(["pid"]))
    rows = read.select(F.col("_metadata.file_path").alias("file"), F.posexplode("playlists").alias("place", "one"))
    _written(rows.select("one.pid", "file", "place").filter("pid is not null").join(files, "file"), root, run_id)


def refresh_index(spark: SparkSession, path, root: str, run_id: str, name_glob: str = SLICE_GLOB) -> list:
    """A new version after files came, changed or went; gives the paths of those it read. They
    are as many as changed, which is what reading them takes anyway."""
    files, old = slice_files(spark, path, name_glob), read_newest(spark, root)
    known = old.select("file", *STATE).distinct()
    kept = old.join(files, ["file", *STATE], "left_semi")
    fresh = [row["file"] for row in files.join(known, ["file", *STATE], "left_anti").select("file").collect()]
    if fresh:
        added = ids_in(spark, fresh).join(files, "file").select(kept.columns)
        kept = kept.unionByName(added)
    _written(kept, root, run_id)
    return sorted(fresh)


def index_version(spark: SparkSession, root: str) -> str:
    return newest_run(spark, root)


def files_with(spark: SparkSession, root: str, items: list, limit: int | None = None) -> list:
    """The files that hold the ids and ranges of ``items``, in order of name. They are collected,
    as a reader takes paths; their number is at most that of the ids that are there."""
    found = cards.lookup(read_newest(spark, root), items, limit).select("file", *STATE).distinct().collect()
    paths = sorted({row["file"] for row in found})
    if paths:
        now = {row["file"]: tuple(row) for row in slice_files(spark, paths, "*").collect()}
        changed = sorted(row["file"] for row in found if now.get(row["file"]) != tuple(row))
        if changed:
            raise ValueError(f"changed since it was indexed: {changed[0]}")
    return paths


def indexed_playlists(spark: SparkSession, root: str, items: list, limit: int | None = None) -> DataFrame:
    """The playlists of the ids and ranges in ``items``, each file opened only if it holds one."""
    paths = files_with(spark, root, items, limit)
    slices = read_slices(spark, paths, name_glob="*") if paths else spark.createDataFrame([], SLICE)
    return cards.lookup(playlists_of(slices), items, limit)
