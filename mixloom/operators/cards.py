"""Looking up playlists and writing them out as text lines.

A card is a set of rows (pid, line_no, text); sorted by both they read as the
printed card. All lines come from the nested row, so there is no shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.functions.text import date_text, time_text


def wanted_ids(items: list) -> tuple[list, list]:
    """The single ids and the [start, end) ranges named by ``items``: whole numbers, their
    text, or text like ``1000-1020``, whose end is not included. Anything else raises
    ``ValueError``."""
    ids, ranges = [], []
    for item in items:
        try:
            bounds = [int(part) for part in item.split("-")] if isinstance(item, str) and "-" in item else [int(item)]
        except (TypeError, ValueError) as problem:
            raise ValueError(f"bad pid: {item!r}") from problem
        if len(bounds) > 2:
            raise ValueError(f"bad pid: {item!r}")
        ids.append(bounds[0]) if len(bounds) == 1 else ranges.append(tuple(bounds))
    return ids, ranges


def _usable(start: int, end: int, limit: int | None) -> bool:
    return 0 <= start <= end and (limit is None or end <= limit)


def lookup(playlists: DataFrame, items: list, limit: int | None = None) -> DataFrame:
    """The playlists of all the ids and ranges in ``items``, each once. Ids below 0, and with
    a ``limit`` those from it on, are skipped, and so are ranges that are not within them."""
    ids, ranges = wanted_ids(items)
    found = F.col("pid").isin([pid for pid in ids if _usable(pid, pid + 1, limit)])
    for start, end in ranges:
        if _usable(start, end, limit):
            found = found | ((F.col("pid") >= start) & (F.col("pid") < end))
    return playlists.filter(found)


def lookup_pids(playlists: DataFrame, pids: list | None = None, limit: int | None = None) -> DataFrame:
    """The playlists with these ids; without ids, all playlists."""
    return playlists if pids is None else lookup(playlists, [int(pid) for pid in pids], limit)


def lookup_pid_range(playlists: DataFrame, start, end, limit: int | None = None) -> DataFrame:
    """Ids in [start, end): the end is not included. A range that is not
    0 <= start <= end (<= limit) gives no rows; a bound that is no number raises
    ``ValueError``."""
    try:
        start, end = int(start), int(end)
    except (TypeError, ValueError) as problem:
        raise ValueError("bad pid") from problem
    if not _usable(start, end, limit):
        return playlists.limit(0)
    return playlists.filter((F.col("pid") >= start) & (F.col("pid") < end))


def _lines(playlists: DataFrame, *blocks: Column) -> DataFrame:
    return playlists.select("pid", F.posexplode(F.concat(*blocks)).alias("line_no", "text"))


def _block(*lines) -> Column:
    return F.array(*[F.coalesce(line, F.lit("")) for line in lines])


# The layouts below are fixed values: the printed form of a card.


def _text(layout: str, *values) -> Column:
    return F.format_string(layout, *values)


def _track_lines(line) -> Column:
    none = F.array().cast("array<string>")
    return F.coalesce(F.transform("tracks", line), none)


def compact_cards(playlists: DataFrame, zone: str = "UTC") -> DataFrame:
    """Id, name, followers, date and edits."""
    return _lines(playlists, _short_head(zone))


def pretty_cards(playlists: DataFrame, zone: str = "UTC") -> DataFrame:
    """The compact card and one "pos track - album" line per track."""
    tracks = _track_lines(
        lambda track: _text("%3d %s - %s", track["pos"], track["track_name"], track["album_name"])
    )
    return _lines(playlists, _short_head(zone), tracks, _block(F.lit("")))


def _short_head(zone: str) -> Column:
    return _block(
        _text("=== %d ===", "pid"),
        F.col("name"),
        _text("  followers %d", "num_followers"),
        F.concat(F.lit("  modified "), date_text("modified_at", zone)),
        _text("  edits %d", "num_edits"),
        F.lit(""),
    )


def full_cards(playlists: DataFrame, zone: str = "UTC") -> DataFrame:
    """Totals and one "n track - album - artist" line per track, n from 1."""
    head = _block(
        _text("===== %d ====", "pid"),
        F.concat(F.lit("name:           "), "name"),
        F.concat(F.lit("last_modified:  "), time_text("modified_at", zone)),
        _text("num edits:  %d", "num_edits"),
        _text("num followers:  %d", "num_followers"),
        _text("num artists:  %d", "num_artists"),
        _text("num albums:  %d", "num_albums"),
        _text("num tracks:  %d", "num_tracks"),
        F.lit(""),
    )
    tracks = _track_lines(
        lambda track, place: _text(
            "   %3d %s - %s - %s",
            place + 1,
            track["track_name"],
            track["album_name"],
            track["artist_name"],
        )
    )
    return _lines(playlists, head, tracks, _block(F.lit("")))


def raw_cards(playlists: DataFrame) -> DataFrame:
    """(pid, json): the whole record, indented."""
    record = F.struct(*playlists.columns)
    return playlists.select("pid", F.to_json(record, {"pretty": "true"}).alias("json"))
