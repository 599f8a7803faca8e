"""Periodic runs of words: Lyndon arrays by Baier's grouping, Lyndon roots extended into runs.

A run is a stretch of a text with smallest period q that no neighbouring word extends. Every
run of exponent 2 or more holds a Lyndon word of length q that is the longest one to start at
its place, in one of two orders of the words, each the other's reverse. So the two Lyndon
arrays name every period and a place inside every run.

*Grouping.* Positions start in groups by word. The groups are taken from the highest on. Each
position of a group points to the nearest one before it that is still in a lower group; a
position pointed to by ``l`` of them leaves its group for a new one right above, whose common
prefix is the old one followed by ``l`` times the prefix of the group that points. When a
group is taken, its prefix is the longest Lyndon word that starts at its positions: phase one
of the suffix sorter is the Lyndon array. Positions not yet taken form a linked list, so all
pointers together cost linear time.

*Extension.* A root (i, q) is kept where the q words at i and at i + q have equal prefix
hashes, and then extended to both sides by comparing the words themselves, in steps that
double. A run of three periods or more holds such a root. Roots inside a run already found
with their period are passed over.

*Stretches.* In a run of ``min_exponent`` periods each word occurs that often, so words that
occur less often in their document (then in their stretch, until nothing changes) belong to
no run. They cut the document into stretches; those too short are left out, all others go
through the grouping whole.

Each document is worked on in one task, with memory in proportion to its length; rows are
only mapped, so no group of rows meets anywhere.

Defined results: a null or empty text has no runs and an empty text is left; ids may be null
or repeated, rows are independent; an empty table gives no rows; other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.blocks import Words, sub_batches

BATCH_BYTES = 1 << 20
PRIME = (1 << 31) - 1  # prefix hashes are modulo this prime; they only choose what is compared
BASE = 1_103_515_245
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def lyndon_array(ranks: list[int]) -> list[int]:
    """By position the length of the longest Lyndon word that starts there. Rank 0 is a border
    that no word crosses; the last position must be one."""
    n = len(ranks)
    order = sorted(set(ranks))
    name = {rank: k for k, rank in enumerate(order)}
    group = [name[rank] for rank in ranks]
    members: list[list[int]] = [[] for _ in order]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [1] * len(order)
    below = list(range(-1, len(order) - 1))
    above = list(range(1, len(order) + 1))
    left, right = list(range(-1, n)), list(range(1, n + 2))  # of the positions not yet taken; n and -1 are ends
    lyndon = [1] * n
    top = len(order) - 1
    while top > 0:  # borders, group 0, are the lowest and lead nowhere
        length = size[top]
        pointed: list[tuple[int, int]] = []  # (position, pointers to it), in rising order
        target, pointers = -2, 0
        for i in members[top]:
            if group[i] != top:
                continue
            lyndon[i] = length
            before, after = left[i], right[i]  # those of its group before it are taken already
            if before == target:
                pointers += 1
            else:
                pointed.append((target, pointers))
                target, pointers = before, 1
            right[before] = after
            left[after] = before
        pointed.append((target, pointers))
        fresh: dict[tuple[int, int], list[int]] = {}
        for j, pointers in pointed:
            if j >= 0 and group[j] > 0:
                fresh.setdefault((pointers, group[j]), []).append(j)
        for pointers, old in sorted(fresh, reverse=True) if len(fresh) > 1 else fresh:
            number, moved = len(size), fresh[pointers, old]
            size.append(size[old] + pointers * length)
            members.append(moved)
            for j in moved:
                group[j] = number
            higher = above[old]
            below.append(old)
            above.append(higher)
            above[old] = number
            below[higher] = number
        top = below[top]
    return lyndon


def _powers(n: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    factor = BASE
    while len(out) < n:
        out = np.concatenate([out, out * factor % PRIME])
        factor = factor * factor % PRIME
    return out[:n]


def square_roots(ranks: np.ndarray, lyndon: np.ndarray) -> np.ndarray:
    """The positions i whose next two stretches of ``lyndon[i]`` words have equal hashes."""
    n = len(ranks)
    power = _powers(n + 1)
    spread = ranks.astype(np.int64) * 40_503 % PRIME + 1
    hashed = np.concatenate([[0], np.cumsum(spread * power[:n] % PRIME)]) % PRIME
    at = np.flatnonzero(np.arange(n) + 2 * lyndon <= n)
    q = lyndon[at]
    one, two = (hashed[at + q] - hashed[at]) % PRIME, (hashed[at + 2 * q] - hashed[at + q]) % PRIME
    return at[one * power[q] % PRIME == two]


def common_extension(words: np.ndarray, i: int, j: int, end: int) -> int:
    """How many words from ``i`` on equal those from ``j`` on, ``j`` staying below ``end``."""
    found, step = 0, 16
    while (room := min(step, end - j - found)) > 0:
        same = words[i + found : i + found + room] == words[j + found : j + found + room]
        if not same.all():
            return found + int(np.argmin(same))
        found, step = found + room, 2 * step
    return found


def runs_of(words: np.ndarray, begin: np.ndarray, end: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int, int]]:
    """(stretch, start, length, period) of the runs of stretches begin..end of ``words``,
    starts counted in ``words``."""
    if not len(begin):
        return []
    size = end - begin
    first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])  # each stretch is followed by a border
    inside = np.ones(int((size + 1).sum()), bool)
    inside[first + size] = False
    place = np.repeat(begin - first, size + 1) + np.arange(len(inside))  # of every position in ``words``
    ranks = np.zeros(len(inside), np.int64)
    _, known = np.unique(words[place[inside]], return_inverse=True)
    ranks[inside] = known + 1
    owner = np.repeat(np.arange(len(begin)), size + 1)
    backward = ranks[::-1]
    top = int(ranks.max()) + 1
    found: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for order in (ranks, np.where(inside, top - ranks, 0)):
        lyndon = np.array(lyndon_array(order.tolist()), np.int64)
        lyndon[~inside] = len(ranks)
        ends: dict[int, int] = {}  # by period: where the last run found with it ends
        for i in square_roots(ranks, lyndon).tolist():
            q, stretch = int(lyndon[i]), int(owner[i])
            if i + q <= ends.get(q, 0):
                continue
            low, high = int(first[stretch]), int(first[stretch] + size[stretch])
            start = i - common_extension(backward, len(ranks) - i - q, len(ranks) - i, len(ranks) - low)
            stop = i + q + common_extension(ranks, i, i + q, high)
            ends[q] = stop
            if stop - start >= max(min_length, min_exponent * q):
                found[start, q] = (stretch, int(place[start]), stop - start, q)
    return [found[key] for key in sorted(found)]


def _changes(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def stretches(words: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the stretches that may hold runs: consecutive words of one document,
    each of which occurs ``min_exponent`` times or more in its stretch."""
    at, part = np.arange(len(words)), doc
    width = int(words.max(initial=0)) + 1
    while len(at):
        _, where, counts = np.unique(part * width + words[at], return_inverse=True, return_counts=True)
        kept = counts[where] >= min_exponent
        left, part = at[kept], part[kept]
        cut = np.concatenate([[True], (np.diff(left) != 1) | (np.diff(part) != 0)]) if len(left) else np.zeros(0, bool)
        part = np.cumsum(cut) - 1
        long = np.bincount(part)[part] >= min_length if len(left) else np.zeros(0, bool)
        left, part = left[long], part[long]
        if len(left) == len(at):
            break
        at = left
    begin = _changes(part)
    return at[begin], np.append(at[begin[1:] - 1], at[-1:]) + 1


def _runs_batch(texts: list[bytes | None], min_length: int, min_exponent: int) -> tuple[list, list]:
    """By text: its runs in order of start and period, and the text without their repeats."""
    w = Words(texts)
    ids = w.ids.astype(np.int64)
    begin, end = stretches(ids, w.text_of, min_length, min_exponent)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    gone = np.zeros(len(ids) + 1, np.int64)
    for stretch, start, length, period in runs_of(ids, begin, end, min_length, min_exponent):
        text = int(w.text_of[begin[stretch]])
        runs[text].append((start - int(w.starts[text]), length, period))
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone)[:-1] == 0
    collapsed = []
    for text, (low, high) in enumerate(zip(w.starts[:-1].tolist(), w.starts[1:].tolist(), strict=True)):
        if runs[text]:
            some = ids[low:high][kept[low:high]]
            collapsed.append(b" ".join([w.dictionary[i] for i in some]))
        else:
            collapsed.append(b" ".join((texts[text] or b"").split()))
    return [sorted(r) for r in runs], collapsed


def periodic_runs(
    docs: DataFrame, min_length: int = 24, min_exponent: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: the runs (start, length, period) of at least
    ``min_length`` words and ``min_exponent`` periods, by start and period, and the text without
    the words that a run holds after its first period, joined by one space."""
    if min_exponent < 3:
        raise ValueError("a run of fewer than three periods may hold no squared root after its start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 1, BATCH_BYTES):
            runs, collapsed = _runs_batch(batch.column(1).cast(pa.binary()).to_pylist(), min_length, min_exponent)
            named = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in some] for some in runs]
            columns = [batch.column(0), pa.array(named, pa.list_(RUN_TYPE)), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, SCHEMA)
