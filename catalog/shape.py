"""The playlist corpus as the test tables give it, in SQL that Spark and DuckDB
both read.

A playlist is an order and its entries are the order's lines. The shape of a
column is written once, so that both engines start from the same corpus; what
is computed from it is written twice. Some rows break a rule on purpose.
"""

CHUNK = 250  # entries of one playlist; further lines of an order open another
NEXT_CHUNK = 1_000_000_000_000
SLICE_SIZE = 1000

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]

PLAYLIST = {
    "name": (
        "case when o_orderkey % 89 = 0 then '' "
        "when o_orderkey % 3 = 0 then concat('#', lower(o_orderpriority), ' / vol. ', o_custkey % 40) "
        "when o_orderkey % 3 = 1 then concat('  ', o_orderpriority, chr(9), '~', o_orderstatus, '!') "
        "else concat(o_orderpriority, ' & ', o_orderstatus, '''s mix') end"
    ),
    "collaborative": "case when o_orderkey % 2 = 0 then 'true' else 'false' end",
    "num_followers": "o_custkey % 50",
    "num_edits": "o_orderkey % 40",
}

MODIFIED_AT = "{seconds} + case when o_orderkey % 61 = 0 then 632448000 else 0 end"
SPARK_SECONDS = "unix_date(cast(o_orderdate as date)) * 86400L"
DUCK_SECONDS = "cast(epoch(o_orderdate) as bigint)"

ENTRY = {
    "track_uri": (
        "concat(case when l_partkey % 101 = 0 then 'spotify:local:' else 'spotify:track:' end, l_partkey)"
    ),
    "track_name": (
        "concat(p_name, case when l_partkey % 53 = 0 and l_suppkey % 10 = 3 then ' (live)' else '' end)"
    ),
    "album_uri": (
        "concat(case when l_partkey % 103 = 0 then 'spotify:single:' else 'spotify:album:' end, "
        "l_partkey - l_partkey % 8)"
    ),
    "album_name": (
        "concat('Album ', l_partkey - l_partkey % 8, "
        "case when l_partkey % 17 = 0 and l_suppkey % 10 = 4 then ' deluxe' else '' end)"
    ),
    "artist_uri": (
        "concat(case when l_partkey % 107 = 0 then 'spotify:band:' else 'spotify:artist:' end, p_brand)"
    ),
    "artist_name": (
        "case when l_partkey % 59 = 0 and l_suppkey % 10 = 5 then upper(p_brand) else p_brand end"
    ),
    "duration_ms": "cast(l_quantity as bigint) * 1000",
}
