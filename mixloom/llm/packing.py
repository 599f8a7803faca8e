"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each task packs the documents of its own partition, so there is no shuffle and no
shared state; a task that is run again after a lost executor packs the same rows.

Placement. A document fills whole windows first. What is left, fewer ids than a
window, goes to the fill level that keeps the sum of squared counts of partly filled
windows smallest: ``levels[f]`` counts the open windows that hold ``f`` ids, moving a
window from ``f`` to ``f + n`` changes the sum by ``1 - 2 * levels[f]`` and
``1 + 2 * levels[f + n]``, and a window that gets full leaves the array. Ties go to
the fullest window. The array has one entry per level whatever the input's size.

Closing. When a partition ends, its open windows are topped up with pieces cut from
the emptiest ones. Of the one window that stays partly filled, the pieces are cut at
powers of two into sequences that need no padding.

Defined results: a null or empty text is one piece with the end id alone; a null id is
kept as null; repeated rows are packed as separate documents; an empty table gives no
rows; columns other than the id and the text are not read.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.byte_bpe import byte_encoding

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
#: The upper bits of a sequence's number are its partition's.
SEQUENCE_BITS = 40
FLUSH_ROWS = 20_000


class Packer:
    """Packs pieces (doc, start, ids, total) of one partition; full windows leave at once."""

    def __init__(self, window: int, first_sequence: int):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]  # by fill; each window is a list of pieces
        self.next_sequence = first_sequence
        self.rows: list[tuple] = []

    def _emit(self, pieces) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
            self.rows.append((doc, start, len(ids), crc, total, self.next_sequence, offset))
            offset += len(ids)
        self.next_sequence += 1

    def _level_for(self, n: int) -> int:
        """The fill level (0: a new window) where ``n`` more ids cost least."""
        top = self.window - n
        cost = 1 - 2 * self.levels[: top + 1]
        cost[0] = 0
        cost += 1 + 2 * self.levels[n:]
        cost[top] -= 1 + 2 * self.levels[self.window]  # a full window is not counted
        allowed = self.levels[: top + 1] > 0
        allowed[0] = True
        cost[~allowed] = np.iinfo(np.int64).max
        return top - int(np.argmin(cost[::-1]))

    def add(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.window:
            self._emit([(doc, start, ids[start : start + self.window], total)])
            start += self.window
        rest = total - start
        if not rest:
            return
        level = self._level_for(rest)
        pieces = self.open[level].pop() if level else []
        self.levels[level] -= bool(level)
        pieces.append((doc, start, ids[start:].copy(), total))
        if level + rest == self.window:
            self._emit(pieces)
        else:
            self.open[level + rest].append(pieces)
            self.levels[level + rest] += 1

    def close(self) -> None:
        left = [(fill, pieces) for fill in range(self.window - 1, 0, -1) for pieces in self.open[fill]]
        low, loose = len(left) - 1, []
        for at, (fill, pieces) in enumerate(left):
            if at > low:
                break
            if at == low:
                loose = [*pieces, *loose]
                break
            while fill < self.window:
                if not loose:
                    if low <= at:
                        break
                    loose, low = list(left[low][1]), low - 1
                doc, start, ids, total = loose.pop()
                took = min(len(ids), self.window - fill)
                pieces.append((doc, start, ids[:took], total))
                if took < len(ids):
                    loose.append((doc, start + took, ids[took:], total))
                fill += took
            if fill == self.window:
                self._emit(pieces)
            else:
                loose = pieces
        self._close_at_powers(loose)

    def _close_at_powers(self, pieces: list) -> None:
        left, pieces = sum(len(ids) for _, _, ids, _ in pieces), list(reversed(pieces))
        while left:
            size = min(1 << (left.bit_length() - 1), self.window)
            left, sequence = left - size, []
            while size:
                doc, start, ids, total = pieces.pop()
                took = min(size, len(ids))
                sequence.append((doc, start, ids[:took], total))
                if took < len(ids):
                    pieces.append((doc, start + took, ids[took:], total))
                size -= took
            self._emit(sequence)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack_documents(
    docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece of a document: where it starts in the document's ids, how long
    it is, and its place (``sequence_id``, ``offset``) in a sequence of at most ``window``
    ids. ``tokenizer`` is the path of a byte-level BPE file that every executor has."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoding(tokenizer)
        packer = Packer(window, TaskContext.get().partitionId() << SEQUENCE_BITS)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc, np.append(encode(text.as_py() or ""), np.uint32(end_id)))
                if len(packer.rows) >= FLUSH_ROWS:
                    yield _table(packer.rows)
                    packer.rows = []
        packer.close()
        yield _table(packer.rows)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(packed, SCHEMA)
