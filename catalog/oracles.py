"""What each registered query must return, in SQL over the same tables."""

from catalog import shape, views
from mixloom.functions.text import DROPPED
from mixloom.operators.quality import LATEST_CHANGE
from mixloom.operators.ranking import CHUNK
from mixloom.operators.split import RANGES

K = views.DEPTH
ORDER = ", ".join(shape.LINE_ORDER)
ENTRY = ", ".join(f"{sql} as {name}" for name, sql in shape.ENTRY.items())
HEAD = ", ".join(f"{sql} as {name}" for name, sql in shape.PLAYLIST.items())
MODIFIED = shape.MODIFIED_AT.format(seconds=shape.DUCK_SECONDS)

# Python's white space, spelled out for an engine whose \s is ASCII.
SPACES = (
    r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)


def norm(text: str) -> str:
    blanks = " " * len(DROPPED)
    return f"trim(regexp_replace(translate(lower({text}), '{DROPPED}', '{blanks}'), '{SPACES}', ' ', 'g'))"


# Not materialized: sharing this table among many branches hits an internal error
# of DuckDB 2.0.0 ("dict-surviving cache") in some runs. The rows are the same.
LINES = f"""placed as not materialized (
  select *, row_number() over (partition by l_orderkey order by {ORDER}) - 1 as place
  from lineitem)"""
PID = f"l_orderkey + (place // {shape.CHUNK}) * {shape.NEXT_CHUNK}"

FLAT_ONLY = f"""flat as (
  select {PID} as pid, {ORDER}, {ENTRY}
  from placed join part on p_partkey = l_partkey)"""
FLAT = f"{LINES}, {FLAT_ONLY}"

# A playlist is an order, or each chunk of a long one.
HEADS_ONLY = f"""chunks as (select distinct l_orderkey, {PID} as chunk_pid from placed),
head as (
  select coalesce(chunk_pid, o_orderkey) as pid, {HEAD}, {MODIFIED} as modified_at, text as description
  from orders left join chunks on l_orderkey = o_orderkey left join documents on doc_id = o_orderkey)"""
HEADS = f"{LINES}, {HEADS_ONLY}"

ENTRIES_ONLY = f"""entry as not materialized (
  select {PID} as pid, cast(place % {shape.CHUNK} as int) as ordinal,
    cast(place % {shape.CHUNK}
      + case when l_suppkey % 37 = 0 and l_partkey % 5 = 0 then 1 else 0 end as bigint) as pos,
    {ENTRY}
  from placed join part on p_partkey = l_partkey)"""
PLACED = f"{LINES}, {ENTRIES_ONLY}"

NESTED = f"""{LINES}, {HEADS_ONLY}, {ENTRIES_ONLY},
sized as (
  select pid, count(*) as tracks, count(distinct album_uri) as albums,
    count(distinct artist_uri) as artists, cast(sum(duration_ms) as bigint) as duration
  from entry group by all),
nested as (
  select head.pid, name, description, collaborative, modified_at,
    num_followers, num_edits, coalesce(tracks, 0) as tracks, coalesce(albums, 0) as albums,
    coalesce(artists, 0) as artists, coalesce(duration, 0) as duration
  from head left join sized on sized.pid = head.pid),
playlist as (
  select *,
    tracks + case when pid % 97 = 0 then 1 else 0 end as num_tracks,
    albums + case when pid % 83 = 0 then 1 else 0 end as num_albums,
    artists + case when pid % 79 = 0 then 1 else 0 end as num_artists,
    duration + case when pid % 73 = 0 then 1 else 0 end as duration_ms
  from nested)"""

SIZED = f"""{HEADS},
counted as (select {PID} as line_pid, count(*) as n from placed group by 1),
sized_playlist as (
  select pid, name, collaborative, num_followers, num_edits, modified_at,
    coalesce(n, 0) + case when pid % 97 = 0 then 1 else 0 end as num_tracks
  from head left join counted on line_pid = pid)"""

DICTIONARIES = """playlist_dict as (
  select playlist_id, cast(row_number() over (order by playlist_id) - 1 as int) as playlist_idx
  from (select distinct playlist_id from pair)),
track_dict as (
  select track_uri, cast(row_number() over (order by track_uri) - 1 as int) as track_idx
  from (select distinct track_uri from pair))"""


def pairs(ctes: str, source: str) -> str:
    return f"""{ctes},
pair as (select distinct pid as playlist_id, track_uri from {source} where track_uri like 'spotify:track:%'),
{DICTIONARIES}"""


PAIRS = pairs(FLAT, "flat")

INTERACTIONS = """inter as (
  select distinct cast(o_custkey as int) as playlist_idx, cast(l_partkey as int) as track_idx,
    1 as count
  from lineitem join orders on o_orderkey = l_orderkey)"""


def key_hash(*keys: str) -> str:
    text = " || '|' || ".join([f"cast({key} as varchar)" for key in keys] + ["'42'"])
    return f"cast(('0x' || substr(md5({text}), 1, 8)) as bigint)"


# The hash from which on a row belongs to the tenth that is held out.
TENTH = round((1 - 0.1) * RANGES["md5"])


HELD = f"""{INTERACTIONS},
marked as (select *, {key_hash("playlist_idx", "track_idx")} >= {TENTH} as is_test from inter),
train as (select playlist_idx, track_idx, count from marked where not is_test),
truth as (select playlist_idx, track_idx, count from marked where is_test)"""

# The most popular training tracks each playlist does not have. A playlist with
# s seeds finds its K fresh ones among the first K + s ranks.
RANKED = f"""{HELD},
popular as (
  select track_idx, row_number() over (order by n desc, track_idx) as place
  from (select track_idx, count(*) as n from train group by 1)),
seeded as (select playlist_idx, count(*) as n from train group by 1),
walk as (
  select playlist_idx, track_idx, place from seeded join popular on place <= n + {K}),
fresh as (select * from walk anti join train using (playlist_idx, track_idx)),
ranked as (
  select playlist_idx, cast(rank as int) as rank, track_idx from (
    select *, row_number() over (partition by playlist_idx order by place) as rank from fresh)
  where rank <= {K})"""

DECODER = f"""tracks as (
  select cast(p_partkey as int) as track_idx, {shape.ENTRY["track_uri"].replace("l_partkey", "p_partkey")} as track_uri
  from part where p_partkey % 101 <> 0),
playlists as (
  select cast(c_custkey as int) as playlist_idx, c_custkey + 1000000 as playlist_id from customer)"""

SCORED = f"""{RANKED},
sizes as (select playlist_idx, count(*) as actual_size from truth group by 1),
listed as (select distinct playlist_idx from ranked),
hit as (
  select playlist_idx, rank, track_idx,
    row_number() over (partition by playlist_idx order by rank) as hits
  from ranked semi join truth using (playlist_idx, track_idx)),
gained as (select playlist_idx, sum(hits / rank) as total from hit group by 1)"""

SCORE = f"""scored as (
  select playlist_idx, coalesce(total / least(actual_size, {K}), 0.0) as map_score
  from sizes semi join listed using (playlist_idx) left join gained using (playlist_idx))"""

SCORE_ZERO = f"""scored as (
  select playlist_idx, coalesce(total / least(actual_size, {K}), 0.0) as map_score
  from sizes left join gained using (playlist_idx))"""

METRICS = """round(avg(map_score), 9) as mean_ap, count(map_score) as num_playlists,
  round(stddev(map_score), 9) as std_dev, round(min(map_score), 9) as min_ap,
  round(max(map_score), 9) as max_ap"""

SUBMISSION = f"""with {RANKED},
{DECODER}
select playlist_id, coalesce(string_agg(track_uri, ',' order by rank), '') as recommended_track_uris
from playlists left join ranked using (playlist_idx) left join tracks using (track_idx)
group by playlist_id"""

PAST = "cast(null as int) as pos"
ONE = "cast(1 as bigint) as errors"


def top(ctes: str, source: str, value: str, name: str, n: int | None = 20) -> str:
    limit = "" if n is None else f"order by 2 desc, 1 limit {n}"
    return f"with {ctes} select {value} as {name}, count(*) as count from {source} group by 1 {limit}"


def first_seen(ctes: str, source: str, value: str, name: str, seen: str) -> str:
    return f"""with {ctes},
numbered as (select {value} as {name}, row_number() over (order by {seen}) as seen_no from {source})
select {name}, count(*) as count from numbered group by 1 order by 2 desc, min(seen_no) limit 20"""


def playlist_checks(source: str) -> str:
    checks = [
        ("empty_name", "length(name) = 0", "''"),
        ("few_tracks", "tracks < 5", "tracks"),
        ("few_followers", "num_followers < 1", "num_followers"),
        ("few_edits", "num_edits <= 0", "num_edits"),
        ("changed_late", f"modified_at > {LATEST_CHANGE}", "modified_at"),
        ("few_artists", "artists < 3", "artists"),
        ("few_albums", "albums < 2", "albums"),
        ("num_albums", "albums <> num_albums", "albums || ' <> ' || num_albums"),
        ("num_artists", "artists <> num_artists", "artists || ' <> ' || num_artists"),
        ("num_tracks", "tracks <> num_tracks", "tracks || ' <> ' || num_tracks"),
        ("duration", "duration <> duration_ms", "duration || ' <> ' || duration_ms"),
    ]
    return " union all ".join(
        f"select '{rule}' as rule, pid, {PAST}, cast({detail} as varchar) as detail, {ONE}"
        f" from {source} where {failed}"
        for rule, failed, detail in checks
    )


URI_CHECKS = " union all ".join(
    f"select '{kind}_uri' as rule, pid, ordinal as pos, {kind}_uri as detail, {ONE} from entry"
    f" where not starts_with({kind}_uri, 'spotify:{kind}:')"
    for kind in ("track", "album", "artist")
)

POSITION = (
    f"select 'position' as rule, pid, ordinal as pos, ordinal || ' <> ' || pos as detail, {ONE}"
    " from entry where ordinal <> pos"
)

NAMES = " union all ".join(
    f"select '{kind}_name' as rule, pid, ordinal as pos,"
    f" {kind}_name || ' <> ' || first_name as detail, {ONE} from ("
    f"select *, first_value({kind}_name) over (partition by {kind}_uri order by pid, ordinal) as first_name"
    f" from entry) where {kind}_name <> first_name"
    for kind in ("artist", "album", "track")
)


def missing_ids(source: str, n: str) -> str:
    return f"""select 'missing_pid' as rule, id as pid, {PAST}, '' as detail, {ONE}
from (select unnest(range({n})) as id) where id not in (select pid from {source})
union all
select 'pid_count' as rule, cast(null as bigint) as pid, {PAST}, found || ' <> ' || wanted as detail, {ONE}
from (select count(distinct pid) as found, {n} as wanted from {source}) where found <> wanted"""


def oracle_sql() -> dict:
    flat_columns = "pid as playlist_id, track_uri, track_name, artist_name, 1 as count"
    clean = "where starts_with(track_uri, 'spotify:track:')"
    sql = {}

    sql["flatten_entries"] = f"with {PLACED} select {flat_columns} from entry"
    sql["clean_entries"] = f"with {PLACED} select {flat_columns} from entry {clean}"
    sql["dedup_entries"] = f"""with {FLAT} select {flat_columns} from (
select *, row_number() over (partition by pid, track_uri order by {ORDER}) as copy from flat {clean})
where copy = 1"""
    sql["norm_names"] = (
        f"with {HEADS} select pid, {norm('name')} as norm_name, {norm('description')} as norm_description from head"
    )

    plain = f"""(select count(*) from head) as playlists, (select count(distinct name) from head) as titles,
  (select count(distinct {norm("name")}) from head) as normalized_titles,
  (select count(*) from flat) as entries, (select count(distinct track_uri) from flat) as tracks,
  (select count(distinct album_uri) from flat) as albums,
  (select count(distinct artist_uri) from flat) as artists,
  round((select count(*) from flat) / (select count(*) from head), 9) as mean_length"""
    sql["corpus_totals"] = (
        f"with {HEADS}, {FLAT_ONLY} select {plain}, (select count(description) from head) as with_description"
    )
    sql["corpus_totals_plain"] = f"with {HEADS}, {FLAT_ONLY} select {plain}"

    label = "track_name || ' by ' || artist_name"
    sql["hist_titles_norm"] = top(HEADS, "head", norm("name"), "title")
    sql["hist_titles_norm_all"] = top(HEADS, "head", norm("name"), "title", None)
    sql["hist_titles_lower"] = top(HEADS, "head", "lower(name)", "title", None)
    sql["hist_tracks"] = top(FLAT, "flat", label, "track")
    sql["hist_tracks_deep"] = top(FLAT, "flat", label, "track", 10000)
    sql["hist_tracks_first_seen"] = first_seen(FLAT, "flat", label, "track", f"pid, {ORDER}")
    sql["hist_artists"] = top(FLAT, "flat", "artist_name", "artist")
    sql["hist_artists_deep"] = top(FLAT, "flat", "artist_name", "artist", 10000)
    sql["hist_edits"] = top(HEADS, "head", "num_edits", "num_edits")
    sql["hist_edits_first_seen"] = first_seen(HEADS, "head", "num_edits", "num_edits", "pid")
    sql["hist_modified"] = f"""with {HEADS}
select modified_at, strftime(make_timestamp(modified_at * 1000000), '%Y-%m-%d') as date, count(*) as count
from head group by 1 order by 3 desc, 1 limit 20"""
    sql["hist_lengths"] = top(SIZED, "sized_playlist", "num_tracks", "num_tracks")
    sql["hist_followers"] = top(HEADS, "head", "num_followers", "num_followers")
    sql["hist_artists_sketched"], sql["hist_tracks_sketched"] = sql["hist_artists"], sql["hist_tracks"]
    sql["totals_one_pass"] = sql["corpus_totals"]
    parts = {"num_edits": "hist_edits", "num_followers": "hist_followers", "num_tracks": "hist_lengths", "title": "hist_titles_norm_all"}
    sql["hist_one_pass"] = " union all ".join(
        f"select cast({of} as varchar) as value, count, '{of}' as of from ({sql[name]})" for of, name in parts.items()
    )
    described = "(select * from head where description is not null)"
    sql["hist_descriptions"] = top(HEADS, described, "description", "description", None)
    sql["hist_descriptions_norm"] = top(HEADS, described, norm("description"), "description", None)

    sql["dict_playlists"] = f"with {PAIRS} select playlist_id, playlist_idx from playlist_dict"
    sql["dict_tracks"] = f"with {PAIRS} select track_uri, track_idx from track_dict"
    encoded = "select playlist_idx, track_idx, 1 as count from pair join playlist_dict using (playlist_id) join track_dict using (track_uri)"
    sql["encode_interactions"] = f"with {PAIRS} {encoded}"
    sql["encode_colocated"] = sql["encode_interactions"]
    sql["etl_roundtrip"] = f"with {pairs(PLACED, 'entry')} {encoded}"

    sql["dq_playlist_rules"] = f"""with {NESTED},
twice as (select *, unnest(case when pid % 499 = 0 then [0, 1] else [0] end) as copy from playlist)
{playlist_checks("twice")}
union all select 'repeated_pid', pid, {PAST}, count(*) || ' times', count(*) - 1
from twice group by pid having count(*) > 1"""
    sql["dq_entry_rules"] = f"with {PLACED} {URI_CHECKS}"
    sql["dq_position"] = f"with {PLACED} {POSITION}"
    sql["dq_name_mismatch"] = f"with {PLACED} {NAMES}"
    sql["dq_missing_pids"] = f"""with listed as (select l_orderkey as pid from lineitem)
{missing_ids("listed", "(select count(*) from orders)")}"""
    number = f"(pid // {shape.SLICE_SIZE})"
    fields = f"""select 'extra_info_field' as rule, cast(null as bigint) as pid, {PAST}, 'licence' as detail, {ONE}
  from slice where slice_no % 3 = 0
union all select 'missing_info_field', null, null, 'version', 1 from slice where slice_no % 5 = 0
union all select 'extra_playlist_field', pid, null, 'colour', 1 from nested where pid % 71 = 0
union all select 'missing_playlist_field', pid, null, 'collaborative', 1 from nested where pid % 67 = 0
union all select 'missing_playlist_field', pid, null, 'tracks', 1 from nested where tracks = 0
union all select 'extra_track_field', pid, ordinal, 'note', 1 from entry where duration_ms % 9000 = 0
union all select 'missing_track_field', pid, ordinal, 'album_name', 1 from entry where duration_ms % 11000 = 0"""
    sql["dq_fields"] = f"with {NESTED}, slice as (select distinct {number} as slice_no from nested) {fields}"
    sql["dq_damaged"] = f"""with {NESTED},
whole as (select *, {number} % 4 <> 1 as readable from nested)
select distinct 'unreadable_slice' || '' as rule, cast(null as bigint) as pid, {PAST}, cast(null as varchar) as detail, {ONE}, {number} as s
  from whole where not readable
union all select 'wrong_type', case when pid % 59 <> 0 then pid end, null, 'num_followers', 1, null from whole where readable and pid % 71 = 0
union all select 'wrong_type', null, null, 'pid', 1, null from whole where readable and pid % 59 = 0
union all select 'wrong_type', case when pid % 59 <> 0 then pid end, ordinal, 'pos', 1, null
  from entry where pos = 2 and pid % 53 = 0 and {number} % 4 <> 1"""
    sql["dq_damaged"] = f"select * exclude (s) from ({sql['dq_damaged']})"
    doubled = "unnest(case when pid % 499 = 0 then [0, 1] else [0] end) as copy"
    over_copies = f"{URI_CHECKS} union all {POSITION} union all {NAMES}".replace("from entry", "from entry_twice")
    sql["dq_summary"] = f"""with {NESTED},
slice as (select distinct {number} as slice_no from nested),
twice as (select *, {doubled} from playlist),
entry_twice as (select *, {doubled} from entry),
violation as ({playlist_checks("twice")} union all {over_copies}
union all {missing_ids("playlist", "(select count(*) + 25 from orders)")}
union all select 'repeated_pid', pid, {PAST}, count(*) || ' times', count(*) - 1 from twice group by pid having count(*) > 1
union all {fields})
select rule, cast(sum(errors) as bigint) as errors from violation group by rule"""

    sql["ground_truth"] = f"""with {HELD}
select playlist_idx, 0 as chunk, string_agg(track_idx, ',' order by track_idx) as tracks from truth group by 1"""
    for name, length in (("salted_collect", CHUNK), ("chunked_collect", 25)):
        sql[name] = f"""with {HELD},
placed as (select *, row_number() over (partition by playlist_idx order by track_idx) - 1 as place from train)
select playlist_idx, cast(place // {length} as int) as chunk, string_agg(track_idx, ',' order by track_idx) as tracks
from placed group by 1, 2"""
    sql["salted_collect_hot"] = """with keyed as (select distinct l_returnflag, l_orderkey * 8 + l_linenumber as line from lineitem),
placed as (select *, row_number() over (partition by l_returnflag order by line) - 1 as place from keyed)
select l_returnflag, cast(place // 2500 as int) as chunk, string_agg(line, ',' order by line) as lines from placed group by 1, 2"""
    sql["topk_ids"] = f"""with {RANKED}
select playlist_idx, string_agg(track_idx, ',' order by rank) as track_idxs from ranked group by 1"""
    sql["ranked_rows"] = f"with {RANKED} select playlist_idx, rank, track_idx from ranked"
    sql["recs_without_seeds"] = sql["ranked_rows"]
    sql["decode_inner"] = f"""with {RANKED}, {DECODER}
select playlist_idx, rank, track_idx, track_uri from ranked join tracks using (track_idx)"""
    sql["decode_left"] = f"""with {RANKED}, {DECODER}
select playlist_idx, rank, track_idx, track_uri from ranked left join tracks using (track_idx)"""
    sql["eval_join"] = f"""with {SCORED}
select playlist_idx, rank, track_idx, actual_size from hit join sizes using (playlist_idx)"""
    sql["ap_at_k"] = f"with {SCORED}, {SCORE} select playlist_idx, round(map_score, 9) as map_score from scored"
    sql["ap_at_k_relational"] = sql["ap_at_k"]
    sql["map_metrics"] = f"with {SCORED}, {SCORE} select {METRICS} from scored"
    sql["map_metrics_zero"] = f"with {SCORED}, {SCORE_ZERO} select {METRICS} from scored"
    sql["submission"] = SUBMISSION
    sql["submission_write"] = SUBMISSION
    sql["run_metrics_append"] = f"""with {SCORED}, {SCORE}, metric as (select {METRICS} from scored)
select run.ts as timestamp, mean_ap as map_score, num_playlists, run.seconds as training_time
from metric, (values ('20171101_000000', cast(1.5 as double)), ('20171102_000000', cast(2.5 as double)))
  run(ts, seconds)"""

    side = key_hash("playlist_idx")
    sql["split_train"] = f"with {INTERACTIONS} select playlist_idx, track_idx, count from inter where {side} < {TENTH}"
    sql["split_test"] = f"with {INTERACTIONS} select playlist_idx, track_idx, count from inter where {side} >= {TENTH}"
    sql["split_summary"] = f"""with {INTERACTIONS}
select count(*) as total_rows, count(*) filter ({side} < {TENTH}) as train_rows,
  count(*) filter ({side} >= {TENTH}) as test_rows,
  round(count(*) filter ({side} >= {TENTH}) / count(*), 9) as test_share from inter"""
    sql["split_holdout_tail"] = f"""with {PLACED}
select pid, ordinal, track_uri, ordinal >= n - floor(n * cast(0.1 as double))
    - cast({key_hash("pid")} / cast({RANGES["md5"]} as double) < n * cast(0.1 as double) - floor(n * cast(0.1 as double)) as int) as is_test
from (select *, count(*) over (partition by pid) as n from entry)"""
    sql["split_roundtrip"] = f"""with {INTERACTIONS}
select playlist_idx, count(*) as rows, cast(1 as bigint) as sides from inter group by 1"""

    sql["als_input"] = f"""with {INTERACTIONS}
select playlist_idx, track_idx, cast(1 as float) as count from inter
where track_idx % 113 <> 0 and track_idx % 7 <> 0"""
    sql["train_summary"] = f"""with {HELD}
select '20171101_000000' as timestamp, count(*) as num_interactions, 10 as num_iterations, 32 as rank,
  cast(0.08 as double) as reg_param, cast(20 as double) as alpha, 64 as num_blocks from train"""
    factors = """(select distinct 'playlist' as side, playlist_idx as id from train
union all select distinct 'track', track_idx from train)"""
    sql["als_factor_shapes"] = f"with {HELD} select side, id, 32 as rank, 0 as negative from {factors}"
    sql["als_model_roundtrip"] = f"with {HELD} select side, id, 32 as rank, 0 as differing from {factors}"
    known = "known as (select count(distinct track_idx) as n from train)"
    for name, wanted in (("all", "train"), ("subset", "train where playlist_idx in (select playlist_idx from truth)")):
        sql[f"recommend_{name}_sizes"] = f"""with {HELD}, {known}
select distinct playlist_idx, least({K}, n) as tracks, least({K}, n) as distinct_tracks, least({K}, n) as last_rank
from (select playlist_idx from {wanted}), known"""
    sql["als_normal_equations"] = f"with {HELD} select distinct playlist_idx, true as holds from train"
    sql["recommend_all_scored"] = f"with {HELD} select distinct playlist_idx, true as in_range from train"
    sql["inner_product_topk"] = """with v as (
  select vec_id, list_transform(embedding, lambda x: floor(16 * x::double)) as x from embeddings
  where len(list_filter(embedding, lambda x: x is null or not abs(x) < 1e6)) = 0),
scored as (select q.vec_id as playlist_idx, c.vec_id as track_idx, list_inner_product(q.x, c.x)::bigint as score from v q join v c on q.vec_id <> c.vec_id),
ranked as (select *, row_number() over (partition by playlist_idx order by score desc, track_idx) as rank from scored)
select playlist_idx::int as playlist_idx, rank::int as rank, track_idx::int as track_idx, score from ranked where rank <= 20"""
    sql["recommend_unseen_sizes"] = f"""with {HELD}, {known},
fresh as (
  select playlist_idx, least({K}, (select n from known) - count(*)) as n from train group by playlist_idx)
select playlist_idx, n as tracks, n as distinct_tracks, cast(0 as bigint) as own_tracks, n as last_rank
from fresh where n > 0"""
    scored = "select count(distinct playlist_idx) as n from truth where playlist_idx in (select playlist_idx from train)"
    sql["als_evaluate_counts"] = f"""with {HELD}
select n as num_playlists, (select count(distinct playlist_idx) from truth) - n as num_left_out, true as in_range from ({scored})"""
    sql["als_grid_counts"] = f"""with {HELD}
select 32 as rank, cast(reg as double) as reg_param, cast(alpha as double) as alpha, n as num_playlists, true as in_range
from ({scored}), (values (0.08, 20), (0.2, 20), (0.08, 1)) as grid(reg, alpha)"""
    sql["als_grid_side_by_side"] = sql["als_grid_counts"]
    sql["als_submit_checks"] = f"""with {HELD}, {DECODER}
select playlist_id, playlist_idx in (select playlist_idx from train) as listed, cast(0 as bigint) as doubled, cast(0 as bigint) as own_uris
from playlists"""
    sql["end_to_end_sizes"] = f"""with {pairs(PLACED, 'entry')},
sized as (
  select playlist_id, least({K}, (select count(*) from track_dict) - count(*)) as n from pair group by playlist_id)
select playlist_id, n as uris, n as distinct_uris, cast(0 as bigint) as own_uris from sized"""
    sql["split_fast_sides"] = sql["split_roundtrip"]
    totals = ["playlists", "titles", "normalized_titles", "entries", "tracks", "albums", "artists", "mean_length", "with_description"]
    sql["corpus_totals_within"] = "select " + ", ".join(f"true as {name}" for name in totals)

    sql["scan_slices"] = f"""with {PLACED}
select pid, ordinal, pos, track_uri, track_name, album_uri, album_name, artist_uri, artist_name, duration_ms
from entry"""
    sql["scan_large_slice"] = sql["scan_slices"]
    sql["scan_first_n_files"] = f"""with {NESTED}
select pid, name, num_tracks, modified_at from playlist
where {number} in (select distinct {number} as slice_no from playlist order by 1 limit 6)"""
    sql["slice_info"] = f"""with {NESTED},
slice as (select distinct {number} as slice_no from nested)
select 'generated_on' as key, '2017-12-03 08:41:42' as value from slice
union all select 'slice', (slice_no * {shape.SLICE_SIZE}) || '-' || (slice_no * {shape.SLICE_SIZE} + {shape.SLICE_SIZE - 1}) from slice
union all select 'version', 'v1' from slice"""
    sql["versioned_write"] = f"with {HELD} select playlist_idx, track_idx, count from train"

    looked = "select pid, name, collaborative, num_followers, num_edits, modified_at, num_tracks from sized_playlist"
    sql["lookup_pids"] = f"with {SIZED} {looked} where pid in (7, 5, 1008, 1120)"
    sql["lookup_pid_range"] = f"with {SIZED} {looked} where pid >= 1000 and pid < 1020"

    moment = "make_timestamp(modified_at * 1000000)"
    short = [
        "'=== ' || pid || ' ==='",
        "name",
        "'  followers ' || num_followers",
        f"'  modified ' || strftime({moment}, '%Y-%m-%d')",
        "'  edits ' || num_edits",
        "''",
    ]
    long = [
        "'===== ' || pid || ' ===='",
        "'name:           ' || name",
        f"'last_modified:  ' || strftime({moment}, '%Y-%m-%d %H:%M:%S')",
        "'num edits:  ' || num_edits",
        "'num followers:  ' || num_followers",
        "'num artists:  ' || num_artists",
        "'num albums:  ' || num_albums",
        "'num tracks:  ' || num_tracks",
        "''",
    ]

    def card(head: list, line: str | None, wanted: str = "true") -> str:
        parts = [
            f"select pid, {number} as line_no, {text} as text from playlist where {wanted}" for number, text in enumerate(head)
        ]
        if line:
            parts.append(f"select pid, cast({len(head)} + ordinal as int), {line} from entry where {wanted}")
            parts.append(f"select pid, cast({len(head)} + tracks as int), '' from playlist where {wanted}")
        return f"with {NESTED} " + " union all ".join(parts)

    pretty_line = "printf('%3d %s - %s', pos, track_name, album_name)"
    full_line = "printf('   %3d %s - %s - %s', ordinal + 1, track_name, album_name, artist_name)"
    sql["cards_raw_fields"] = f"""with {NESTED}
select pid, name, modified_at, num_tracks, duration_ms, tracks, duration from playlist"""
    sql["cards_compact"] = card(short, None)
    sql["cards_pretty"] = card(short, pretty_line)
    sql["cards_full"] = card(long, full_line)
    sql["show_ids"] = card(short, pretty_line, "(pid >= 1000 and pid < 1020 or pid in (7, 5, 1120))")
    sql["show_indexed"] = sql["show_ids"]
    sql["show_range"] = card(long, full_line, "(pid >= 1000 and pid < 1300)")
    return sql
