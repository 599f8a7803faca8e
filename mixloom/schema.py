"""Schemas of the playlist corpus.

The source is always read with an explicit schema: no inference pass over the
files, and an optional field that first turns up late cannot change the types.
"""

from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields):
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


TEXT, WHOLE = StringType(), LongType()

# The field names of the corpus format.
INFO = _struct(generated_on=TEXT, slice=TEXT, version=TEXT)

TRACK = _struct(
    pos=WHOLE,
    track_uri=TEXT,
    track_name=TEXT,
    album_uri=TEXT,
    album_name=TEXT,
    artist_uri=TEXT,
    artist_name=TEXT,
    duration_ms=WHOLE,
)

PLAYLIST = _struct(
    pid=WHOLE,
    name=TEXT,
    description=TEXT,
    collaborative=TEXT,
    modified_at=WHOLE,
    num_tracks=WHOLE,
    num_albums=WHOLE,
    num_artists=WHOLE,
    num_followers=WHOLE,
    num_edits=WHOLE,
    duration_ms=WHOLE,
    tracks=ArrayType(TRACK, True),
)

SLICE = _struct(info=INFO, playlists=ArrayType(PLAYLIST, True))


def _only(struct, names):
    unknown = set(names) - set(struct.names)
    if unknown:
        raise ValueError(f"unknown fields: {sorted(unknown)}")
    return StructType([field for field in struct.fields if field.name in names])


def slice_schema(playlist_fields: list | None = None, track_fields: list | None = None) -> StructType:
    """The slice schema cut to some fields; ``info`` is left out, and ``tracks``
    is read only if track fields are named."""
    playlist = _only(PLAYLIST, playlist_fields or [])
    if track_fields:
        track = ArrayType(_only(TRACK, track_fields), True)
        playlist = StructType([one for one in playlist.fields if one.name != "tracks"]).add("tracks", track)
    return _struct(playlists=ArrayType(playlist, True))


# The same file with the nested objects left as JSON text, for rules that need
# to tell an absent field from a null one.
RAW_SLICE = _struct(info=TEXT, playlists=ArrayType(TEXT, True))

OPTIONAL_PLAYLIST_FIELDS = ["description"]
REQUIRED_PLAYLIST_FIELDS = [
    name for name in PLAYLIST.names if name not in OPTIONAL_PLAYLIST_FIELDS
]
REQUIRED_TRACK_FIELDS = list(TRACK.names)
REQUIRED_INFO_FIELDS = list(INFO.names)

TRACK_PREFIX = "spotify:track:"
ALBUM_PREFIX = "spotify:album:"
ARTIST_PREFIX = "spotify:artist:"
SLICE_GLOB = "mpd.slice.*.json{,.gz}"
