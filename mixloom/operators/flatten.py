"""From nested slices to flat playlists and entries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.schema import TRACK_PREFIX


def playlists_of(slices: DataFrame) -> DataFrame:
    """One row per playlist, tracks still nested. Null or empty arrays give none."""
    return slices.select(F.explode("playlists").alias("playlist")).select("playlist.*")


def playlists_in_file_order(slices: DataFrame) -> DataFrame:
    """As :func:`playlists_of`, with ``seen_at`` = (file name, place in the file)."""
    return slices.select(
        F.col("_metadata.file_name").alias("file"),
        F.posexplode("playlists").alias("place", "playlist"),
    ).select(F.struct("file", "place").alias("seen_at"), "playlist.*")


def entries_of(playlists: DataFrame, fields: list | None = None) -> DataFrame:
    """One row per track entry: ``pid``, its ``ordinal`` (0-based) and the track
    ``fields`` (all that are there by default).

    The named fields are zipped before the explode, so a columnar scan reads
    those alone; an explode of the whole struct would read every field.
    """
    if fields is None:
        fields = playlists.schema["tracks"].dataType.elementType.names
    kept = [name for name in ("seen_at",) if name in playlists.columns]
    zipped = F.arrays_zip(*[F.col(f"tracks.{name}") for name in fields])
    exploded = playlists.select("pid", *kept, F.posexplode(zipped).alias("ordinal", "track"))
    return exploded.select("pid", *kept, "ordinal", *[F.col("track")[name].alias(name) for name in fields])


def implicit_entries(entries: DataFrame) -> DataFrame:
    """(playlist_id, track_uri, track_name, artist_name, count = 1)."""
    return entries.select(
        F.col("pid").alias("playlist_id"),
        "track_uri",
        "track_name",
        "artist_name",
        F.lit(1).alias("count"),
    )


FLAT_FIELDS = ["track_uri", "track_name", "artist_name"]


def flatten_entries(slices: DataFrame) -> DataFrame:
    return implicit_entries(entries_of(playlists_of(slices), FLAT_FIELDS))


def keep_tracks(flat: DataFrame) -> DataFrame:
    """Both keys present and the URI one of a track."""
    return flat.filter(
        F.col("playlist_id").isNotNull()
        & F.col("track_uri").isNotNull()
        & F.col("track_uri").startswith(TRACK_PREFIX)
    )


def clean_entries(slices: DataFrame) -> DataFrame:
    return keep_tracks(flatten_entries(slices))


def dedup_entries(flat: DataFrame, order: list | None = None) -> DataFrame:
    """One row per (playlist_id, track_uri).

    ``order`` names the columns that decide which names survive; without it the
    smallest names do, so the result never depends on the partitioning.
    """
    names = F.struct("track_name", "artist_name")
    kept = F.min_by(names, F.struct(*order)) if order else F.min(names)
    return (
        flat.groupBy("playlist_id", "track_uri")
        .agg(kept.alias("kept"))
        .select("playlist_id", "track_uri", "kept.track_name", "kept.artist_name", F.lit(1).alias("count"))
    )


def interactions_of(flat: DataFrame) -> DataFrame:
    """The distinct (playlist_id, track_uri) pairs.

    The names are dropped first: the pairs alone aggregate in a hash map, where
    carrying strings as aggregate state would fall back to sorting.
    """
    return flat.select("playlist_id", "track_uri").distinct()
