"""Corpus totals and histograms."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.functions.text import date_text, normalize_name

TOP = 20
TOP_DEEP = 10_000


def corpus_totals(playlists: DataFrame, entries: DataFrame, descriptions: bool = True) -> DataFrame:
    """One row of totals over the corpus.

    Each grain is first reduced to its distinct titles or its distinct
    (track, album, artist) triples, with map-side partial counts, so the
    several distinct counts expand that small table and not every row. The two
    one-row results are unioned and folded, which needs no cross join.
    """
    titles = playlists.groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"),
        *([F.count("description").alias("described")] if descriptions else []),
    )
    by_playlist = titles.agg(
        F.sum("rows").alias("playlists"),
        F.count_distinct("name").alias("titles"),
        *([F.sum("described").alias("with_description")] if descriptions else []),
        F.count_distinct(normalize_name("name")).alias("normalized_titles"),
    )
    triples = entries.groupBy("track_uri", "album_uri", "artist_uri").agg(F.count(F.lit(1)).alias("rows"))
    by_entry = triples.agg(
        F.sum("rows").alias("entries"),
        F.count_distinct("track_uri").alias("tracks"),
        F.count_distinct("album_uri").alias("albums"),
        F.count_distinct("artist_uri").alias("artists"),
    )
    return _fold(by_playlist, by_entry)


def approximate_totals(playlists: DataFrame, entries: DataFrame, log_size: int = 14) -> DataFrame:
    """The same totals with sketched distinct counts: one pass, no shuffle of
    keys. A sketch has 2**log_size cells; 14 gives an error of about 1 %."""

    def about(value, name):
        # Sketched by hash, as a sketch of strings passes over the empty string.
        value = F.col(value) if isinstance(value, str) else value
        hashed = F.when(value.isNotNull(), F.xxhash64(value))
        return F.hll_sketch_estimate(F.hll_sketch_agg(hashed, log_size)).alias(name)

    by_playlist = playlists.agg(
        F.count(F.lit(1)).alias("playlists"),
        about("name", "titles"),
        F.count("description").alias("with_description"),
        about(normalize_name("name"), "normalized_titles"),
    )
    by_entry = entries.agg(
        F.count(F.lit(1)).alias("entries"),
        about("track_uri", "tracks"),
        about("album_uri", "albums"),
        about("artist_uri", "artists"),
    )
    return _fold(by_playlist, by_entry)


def _fold(by_playlist: DataFrame, by_entry: DataFrame) -> DataFrame:
    both = by_playlist.unionByName(by_entry, allowMissingColumns=True)
    row = both.agg(*[F.max(name).alias(name) for name in both.columns])
    return row.select(
        *[F.coalesce(name, F.lit(0)).alias(name) for name in both.columns],
        (F.col("entries") / F.nullif(F.col("playlists"), F.lit(0))).alias("mean_length"),
    )


def histogram(
    df: DataFrame,
    value,
    name: str = "value",
    n: int | None = TOP,
    seen: list | None = None,
    first_by: list | None = None,
) -> DataFrame:
    """(value, count) by falling count; the first ``n`` or all.

    Ties go to the smaller value, or, with ``seen``, to the value that occurs
    first in the order of those columns. The count is reduced before its
    shuffle, and the cut is a top-n per partition, not a full sort.

    ``first_by`` names the columns ``value`` is made of where they repeat often:
    they are counted first, and ``value`` is computed once for each.
    """
    value = F.col(value) if isinstance(value, str) else value
    rows, first = F.count(F.lit(1)), F.min(F.struct(*seen)) if seen else None
    if first_by:
        reduced = [rows.alias("_rows")] + ([first.alias("_first")] if seen else [])
        df = df.groupBy(*first_by).agg(*reduced)
        rows, first = F.sum("_rows"), F.min("_first") if seen else None
    aggregates = [rows.alias("count")] + ([first.alias("_first")] if seen else [])
    counted = df.groupBy(value.alias(name)).agg(*aggregates)
    ranked = counted.orderBy(F.desc("count"), "_first" if seen else name)
    if n is not None:
        ranked = ranked.limit(n)
    return ranked.select(name, "count")


def counted_values(df: DataFrame, values: dict, seen: list | None = None) -> DataFrame:
    """(of, value, count, first): how often each value of several columns occurs, in one pass.

    ``values`` are columns by name; their values are counted as text. Every row becomes one for
    each column and is counted before the shuffle, so ``df`` is read once however many histograms
    are made of it. ``first`` is the least ``seen``, where that is named.
    """
    each = F.array(*[F.struct(F.lit(name).alias("of"), value.cast("string").alias("value")) for name, value in values.items()])
    first = F.struct(*seen) if seen else F.lit(None).cast("int")
    exploded = df.select(F.explode(each).alias("one"), first.alias("first")).select("one.*", "first")
    return exploded.groupBy("of", "value").agg(F.count(F.lit(1)).alias("count"), F.min("first").alias("first"))


PLAYLIST_VALUES = {
    "name": F.col,
    "num_edits": F.col,
    "modified_at": F.col,
    "num_tracks": F.col,
    "num_followers": F.col,
    "description": lambda name: F.col(name).isNotNull(),
}
ENTRY_VALUES = {
    "track": lambda _: F.concat("track_name", F.lit(" by "), "artist_name"),
    "artist_name": F.col,
    "track_uri": F.col,
    "album_uri": F.col,
    "artist_uri": F.col,
}


def playlist_values(playlists: DataFrame, seen: list | None = None) -> DataFrame:
    """All that histograms and totals need of the playlists; see :func:`counted_values`."""
    return counted_values(playlists, {name: of(name) for name, of in PLAYLIST_VALUES.items()}, seen)


def entry_values(entries: DataFrame, seen: list | None = None) -> DataFrame:
    """All that histograms and totals need of the entries."""
    return counted_values(entries, {name: of(name) for name, of in ENTRY_VALUES.items()}, seen)


def histogram_of(counted: DataFrame, of: str, name: str, n: int | None = TOP, value=None, kind: str = "string", by_first: bool = True) -> DataFrame:
    """(name, count) of one of the columns of :func:`counted_values`, as :func:`histogram` gives
    them. ``value`` makes what is counted from a column's text."""
    text = F.col("value") if value is None else value("value")
    rows = counted.filter(F.col("of") == of).groupBy(text.cast(kind).alias(name))
    ranked = rows.agg(F.sum("count").alias("count"), F.min("first").alias("_first")).orderBy(F.desc("count"), "_first" if by_first else name)
    return (ranked if n is None else ranked.limit(n)).select(name, "count")


def totals_of(of_playlists: DataFrame, of_entries: DataFrame, descriptions: bool = True) -> DataFrame:
    """The row of :func:`corpus_totals` from :func:`playlist_values` and :func:`entry_values`."""

    def only(of: str, value: Column) -> Column:
        return F.when(F.col("of") == of, value)

    described = F.coalesce(F.sum(only("description", F.when(F.col("value") == "true", F.col("count")))), F.lit(0))
    by_playlist = of_playlists.agg(
        F.sum(only("name", F.col("count"))).alias("playlists"),
        F.count(only("name", F.col("value"))).alias("titles"),
        *([described.alias("with_description")] if descriptions else []),
        F.count_distinct(only("name", normalize_name("value"))).alias("normalized_titles"),
    )
    by_entry = of_entries.agg(
        F.sum(only("track_uri", F.col("count"))).alias("entries"),
        *[F.count(only(f"{name}_uri", F.col("value"))).alias(f"{name}s") for name in ("track", "album", "artist")],
    )
    return _fold(by_playlist, by_entry)


def normalized_titles(playlists: DataFrame, n: int | None = TOP, seen: list | None = None) -> DataFrame:
    return histogram(playlists, normalize_name("name"), "title", n, seen, ["name"])


def lowered_titles(playlists: DataFrame, n: int | None = None, seen: list | None = None) -> DataFrame:
    return histogram(playlists, F.lower("name"), "title", n, seen, ["name"])


def track_counts(entries: DataFrame, n: int | None = TOP, seen: list | None = None) -> DataFrame:
    """Entries per "track by artist" label; two pairs of names may give one label."""
    label = F.concat("track_name", F.lit(" by "), "artist_name")
    return histogram(entries, label, "track", n, seen, ["track_name", "artist_name"])


def artist_counts(entries: DataFrame, n: int | None = TOP, seen: list | None = None) -> DataFrame:
    return histogram(entries, "artist_name", "artist", n, seen)


def edit_counts(playlists: DataFrame, n: int | None = TOP, seen: list | None = None) -> DataFrame:
    return histogram(playlists, "num_edits", "num_edits", n, seen)


def follower_counts(playlists: DataFrame, n: int | None = TOP, seen: list | None = None) -> DataFrame:
    return histogram(playlists, "num_followers", "num_followers", n, seen)


def length_counts(playlists: DataFrame, n: int | None = TOP, seen: list | None = None) -> DataFrame:
    """Playlists per declared ``num_tracks``, not per array size."""
    return histogram(playlists, "num_tracks", "num_tracks", n, seen)


def modified_counts(
    playlists: DataFrame, n: int | None = TOP, seen: list | None = None, zone: str = "UTC"
) -> DataFrame:
    """Playlists per second of last change; shown as dates, so a date may repeat."""
    counted = histogram(playlists, "modified_at", "modified_at", n, seen)
    return counted.select("modified_at", date_text("modified_at", zone).alias("date"), "count")


def description_counts(
    playlists: DataFrame, normalized: bool = False, n: int | None = None, seen: list | None = None
) -> DataFrame:
    """Playlists per description, absent ones left out and empty ones kept."""
    described = playlists.filter(F.col("description").isNotNull())
    value = normalize_name("description") if normalized else F.col("description")
    return histogram(described, value, "description", n, seen)


def slice_info(raw_slices: DataFrame) -> DataFrame:
    """Every field of every slice's ``info`` record as (key, value) rows, also
    fields the format does not know. Takes the raw slices."""
    fields = F.from_json("info", "map<string, string>")
    return raw_slices.select(F.explode(fields).alias("key", "value"))
