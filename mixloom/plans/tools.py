"""The dataset tools over a folder of slices: statistics, descriptions, checks,
lookup and cards.

Each gives DataFrames by name. ``first_files`` limits a tool to the first n
slices in name order, for a quick look. The slices are parsed once and staged
as Parquet, and every result reads only the fields it needs from there.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixloom.functions.text import date_text, normalize_name
from mixloom.operators import cards, quality, stats
from mixloom.operators.flatten import entries_of, playlists_in_file_order, playlists_of
from mixloom.schema import PLAYLIST
from mixloom.sources.id_index import indexed_playlists
from mixloom.sources.slices import first_slice_paths, read_raw_slices, read_slices
from mixloom.storage import staged

# Fixed value: a slice file holds this many ids and is named after them.
IDS_PER_FILE = 1000

PLAYLIST_ORDER = ["seen_at"]
ENTRY_ORDER = ["seen_at", "ordinal"]
URIS = ["track_uri", "album_uri", "artist_uri"]
NAMES = ["track_name", "artist_name"]


def _chosen(spark: SparkSession, path: str, first_files: int | None):
    return path if first_files is None else first_slice_paths(spark, path, first_files)


def staged_playlists(spark: SparkSession, path: str, first_files: int | None = None) -> DataFrame:
    """The playlists with ``seen_at``, their place in the corpus, as a written table."""
    slices = read_slices(spark, _chosen(spark, path, first_files))
    return staged(playlists_in_file_order(slices), "playlists")


def _values(spark: SparkSession, path: str, first_files: int | None) -> tuple[DataFrame, DataFrame]:
    """Staged counts of all values of the playlists, and of their entries: one pass each."""
    playlists = staged_playlists(spark, path, first_files)
    of_playlists = staged(stats.playlist_values(playlists, PLAYLIST_ORDER), "playlist-values")
    entries = entries_of(playlists, [*URIS, *NAMES])
    return of_playlists, staged(stats.entry_values(entries, ENTRY_ORDER), "entry-values")


def statistics(spark: SparkSession, path: str, first_files: int | None = None) -> dict:
    """Totals and the top-20 histograms; ties in the order of first sight. The playlists are read
    once, and their entries once."""
    of_playlists, of_entries = _values(spark, path, first_files)
    whole = {name: stats.histogram_of(of_playlists, name, name, kind="bigint") for name in ("num_edits", "modified_at", "num_tracks", "num_followers")}
    modified = whole["modified_at"]
    return {
        "totals": stats.totals_of(of_playlists, of_entries),
        "titles": stats.histogram_of(of_playlists, "name", "title", value=normalize_name),
        "tracks": stats.histogram_of(of_entries, "track", "track"),
        "artists": stats.histogram_of(of_entries, "artist_name", "artist"),
        "edits": whole["num_edits"],
        "modified": modified.select("modified_at", date_text("modified_at").alias("date"), "count"),
        "lengths": whole["num_tracks"],
        "followers": whole["num_followers"],
    }


def deep_statistics(spark: SparkSession, path: str, first_files: int | None = None) -> dict:
    """Slice records, totals, all titles, and the 10,000 most frequent tracks and artists."""
    of_playlists, of_entries = _values(spark, path, first_files)
    return {
        "info": stats.slice_info(read_raw_slices(spark, _chosen(spark, path, first_files))),
        "totals": stats.totals_of(of_playlists, of_entries, descriptions=False),
        "full_titles": stats.histogram_of(of_playlists, "name", "title", None, F.lower),
        "titles": stats.histogram_of(of_playlists, "name", "title", None, normalize_name),
        "tracks": stats.histogram_of(of_entries, "track", "track", stats.TOP_DEEP),
        "artists": stats.histogram_of(of_entries, "artist_name", "artist", stats.TOP_DEEP),
    }


def descriptions(spark: SparkSession, path: str, first_files: int | None = None) -> dict:
    """All descriptions by frequency, as they are and normalized."""
    playlists = staged_playlists(spark, path, first_files)
    return {
        "descriptions": stats.description_counts(playlists, seen=PLAYLIST_ORDER),
        "normalized": stats.description_counts(playlists, normalized=True, seen=PLAYLIST_ORDER),
    }


def check(
    spark: SparkSession, path: str, n: int = quality.CORPUS_PLAYLISTS, first_files: int | None = None
) -> dict:
    """All violations, damaged files and values among them, and the errors per rule.

    The slices are read once, as text; the typed playlists are made from that. The
    violations are counted while they are written.
    """
    raw = staged(read_raw_slices(spark, _chosen(spark, path, first_files), damaged="report"), "raw-slices")
    texts = raw.select("file", F.posexplode("playlists").alias("place", "text"))
    typed = F.from_json("text", PLAYLIST).alias("playlist")
    playlists = staged(texts.select(F.struct("file", "place").alias("seen_at"), typed).select("seen_at", "playlist.*"), "playlists")
    found, summary = quality.written_with_summary(quality.all_violations(playlists, n, raw))
    return {"violations": found, "summary": summary}


def _slices_named_after(path: str, items: list) -> list:
    """The paths of the slices that hold these ids and ranges, by their names."""
    ids, ranges = cards.wanted_ids(items)
    lows = {pid - pid % IDS_PER_FILE for pid in ids if pid >= 0}
    for start, end in ranges:
        if 0 <= start < end:
            lows |= set(range(start - start % IDS_PER_FILE, end, IDS_PER_FILE))
    return [f"{path}/mpd.slice.{low}-{low + IDS_PER_FILE - 1}.json" for low in sorted(lows)]


CARDS = {
    "pretty": cards.pretty_cards,
    "compact": cards.compact_cards,
    "raw": cards.raw_cards,
    "full": cards.full_cards,
}


def show(
    spark: SparkSession,
    path: str,
    pids: list | None = None,
    start=None,
    end=None,
    style: str = "pretty",
    limit: int | None = None,
    named_files: bool = False,
    index: str | None = None,
) -> DataFrame:
    """Cards of the playlists named by ``pids``, which may mix ids and ranges
    (``["1000-1020", 1989, "99870-99999"]``), of the ids in [start, end), or of all.

    The ids decide, in whatever file they are. With ``named_files`` only the slices
    named after the wanted ids are opened, however many; one that is not there is an
    error. With ``index``, the folder of an index (:mod:`mixloom.sources.id_index`), only the
    files that hold wanted ids are opened, whatever their names. ``limit`` skips ids from it on.
    """
    if pids is None and start is not None:
        try:
            pids = [f"{int(start)}-{int(end)}"] if int(start) >= 0 else []
        except (TypeError, ValueError) as problem:
            raise ValueError("bad pid") from problem
    if index is not None and pids is not None:
        return CARDS[style](indexed_playlists(spark, index, pids, limit))
    files = _slices_named_after(path, pids) if named_files and pids else path
    playlists = playlists_of(read_slices(spark, files))
    if pids is not None:
        playlists = cards.lookup(playlists, pids, limit)
    return CARDS[style](playlists)
