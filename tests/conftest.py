import copy
import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def track(number, pos, artist=None, album=None, **changes):
    artist = number if artist is None else artist
    album = number if album is None else album
    return {
        "pos": pos,
        "track_uri": f"spotify:track:{number}",
        "track_name": f"Song {number}",
        "album_uri": f"spotify:album:{album}",
        "album_name": f"Album {album}",
        "artist_uri": f"spotify:artist:{artist}",
        "artist_name": f"Artist {artist}",
        "duration_ms": 1000 + number,
        **changes,
    }


def playlist(pid, numbers, **changes):
    tracks = [track(number, pos) for pos, number in enumerate(numbers)]
    return {
        "pid": pid,
        "name": f"List {pid}",
        "collaborative": "false",
        "modified_at": 1500000000 + pid,
        "num_tracks": len(tracks),
        "num_albums": len({one["album_uri"] for one in tracks}),
        "num_artists": len({one["artist_uri"] for one in tracks}),
        "num_followers": 1,
        "num_edits": 1,
        "duration_ms": sum(one["duration_ms"] for one in tracks),
        "tracks": tracks,
        **changes,
    }


INFO = {"generated_on": "2017-12-03", "slice": "0-999", "version": "v1"}


def corpus():
    """Two slices; each odd playlist breaks one rule or two."""
    numbers = [1, 2, 3, 4, 5]
    good = playlist(0, numbers, description="Road trip!!  2017")
    empty_text = playlist(1, numbers, description="")
    null_text = playlist(2, numbers, description=None)
    extra = playlist(3, numbers, colour="red")
    missing = playlist(4, numbers)
    del missing["num_edits"]
    repeated = playlist(0, [6, 7, 8, 9, 10])
    disordered = playlist(5, numbers)
    disordered["tracks"][1]["pos"], disordered["tracks"][2]["pos"] = 2, 1
    local = playlist(6, numbers)
    local["tracks"][0]["track_uri"] = "spotify:local:1"
    local["tracks"][1]["note"] = "x"
    renamed = playlist(7, numbers)
    renamed["tracks"][3]["track_name"] = "Song four"
    totals = playlist(8, numbers, num_tracks=9, num_albums=9, num_artists=9, duration_ms=9)
    short = playlist(9, [1, 2], name="", num_followers=0, num_edits=0, modified_at=1509494401)
    no_tracks = playlist(10, [], tracks=None)
    empty_tracks = playlist(11, [])
    twice = playlist(12, [1, 1, 2, 3, 4])
    del twice["tracks"][4]["album_name"]
    first = [good, empty_text, null_text, extra, missing, repeated, disordered]
    second = [local, renamed, totals, short, no_tracks, empty_tracks, twice]
    return copy.deepcopy([first, second])


@pytest.fixture(scope="session")
def slice_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("slices")
    first, second = corpus()
    bad_info = {"generated_on": "2017-12-03", "slice": "1000-1999", "licence": "open"}
    for name, info, playlists in (
        ("mpd.slice.0-999.json", INFO, first),
        ("mpd.slice.1000-1999.json", bad_info, second),
        ("other.json", INFO, [playlist(99, [1, 2, 3, 4, 5])]),
    ):
        # The source spreads one object over many lines.
        (folder / name).write_text(json.dumps({"info": info, "playlists": playlists}, indent=2))
    return str(folder)
