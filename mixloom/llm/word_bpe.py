"""Word-level BPE over a contiguous rank array, with its decoder.

Each short word is held as an array of part boundaries and the rank of every part with
its right neighbour. The smallest rank is looked for by a scan, the boundary behind it is
deleted, and the ranks at its two sides are looked up anew, until no pair has a rank. A
scan per merge is quadratic in the word's length, so words of ``LONG`` bytes and more,
which are rare, keep the same ranks in a heap instead; the parts they end with are equal.

Words repeat, so a worker remembers the words it has encoded, in a table of bounded size.

Defined results: a null text is empty and has no ids; columns other than the id and the
text are not read; repeated rows and null ids give a row each.
"""

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.byte_bpe import byte_of_char

NONE = 1 << 60
LONG = 256
REMEMBERED = 200_000

#: Fixed value: Unicode white space, and the split pattern of the vocabulary file.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")

#: The first code point that no version of Unicode has assigned.
FIRST_UNASSIGNED = "\u0378"


def merge_by_scan(parts: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """Merge the ids in ``parts``; ``pairs`` has (rank, merged id) by left << 32 | right."""
    get, none = pairs.get, (NONE, -1)
    ranks = [get(a << 32 | b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while ranks:
        best = min(ranks)
        if best[0] == NONE:
            break
        at = ranks.index(best)
        parts[at] = best[1]
        del parts[at + 1], ranks[at]
        if at < len(ranks):
            ranks[at] = get(parts[at] << 32 | parts[at + 1], none)
        if at:
            ranks[at - 1] = get(parts[at - 1] << 32 | parts[at], none)
    return parts


def merge_by_heap(parts: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """The same result in n log n, for words too long to scan again and again."""
    n = len(parts)
    right, left, heap = [*range(1, n), -1], [-1, *range(n - 1)], []

    def offer(at: int) -> None:
        if at >= 0 and right[at] >= 0 and (got := pairs.get(parts[at] << 32 | parts[right[at]])):
            heapq.heappush(heap, (got[0], at, parts[at], parts[right[at]], got[1]))

    for at in range(n):
        offer(at)
    while heap:
        _, at, a, b, merged = heapq.heappop(heap)
        after = right[at]
        if parts[at] != a or after < 0 or parts[after] != b:
            continue
        parts[at], parts[after], right[at] = merged, -1, right[after]
        if right[at] >= 0:
            left[right[at]] = at
        offer(left[at])
        offer(at)
    return [p for p in parts if p >= 0]


class Words(dict):
    """Word -> (number of ids, the ids as text, the decoded tokens), encoded when first met."""

    def __init__(self, coder: "WordBpe"):
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> tuple[int, str, str]:
        ids = self.coder.encode_word(word)
        got = len(ids), " ".join(map(str, ids)), self.coder.decode(ids)
        if len(word) < LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = got
        return got


class WordBpe:
    """The encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, self.end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.pairs = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        self.path, self.library, self.to_byte = path, None, byte_of_char()
        char = {b: c for c, b in self.to_byte.items()}
        self.inner = [vocab[char[b]] for b in range(256)]
        self.last = [vocab[char[b] + self.end] for b in range(256)]
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words = Words(self)

    def encode_word(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        data = word.encode()
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        return (merge_by_scan if len(parts) < LONG else merge_by_heap)(parts, self.pairs)

    def split_words(self, text: str) -> list[str]:
        """Special tokens as they are; other text composed, in lower case, cut by the pattern."""
        found = []
        for k, part in enumerate(self.split.split(text) if "<|" in text else [text]):
            if k % 2:
                found.append(part)
            elif part and max(part) >= FIRST_UNASSIGNED and any(unicodedata.category(c) == "Cn" for c in set(part)):
                found += self._split_by_library(part)
            elif part:
                part = unicodedata.normalize("NFC", part)
                # lower() alone would turn a sigma at a word's end into its other form
                found += WORD.findall(part.replace("\u03a3", "\u03c3").lower())
        return found

    def _split_by_library(self, part: str) -> list[str]:
        """For characters newer than Python's tables, whose case and class only the library knows."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
        return [bytes(map(self.to_byte.__getitem__, piece)).decode() for piece, _ in pieces]

    def encode(self, text: str) -> list[int]:
        return [i for word in self.split_words(text) for i in self.encode_word(word)]

    def decode(self, ids) -> str:
        """The tokens of the ids, joined by one space."""
        return " ".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """The coder of a vocabulary file, kept per Python worker."""
    return WordBpe(path)


def _mapped(docs: DataFrame, id_col: str, column, kind: str, of, schema: str, names: list[str], types: list) -> DataFrame:
    """Rows ``(id, *of(value))`` for each row's ``column``, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = of()
        for batch in batches:
            rows = [one(value.as_py()) for value in batch.column(1)]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(column).cast(kind)).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""

    def of():
        coder = word_bpe(vocabulary)
        return lambda text: (coder.encode(text or ""),)

    return _mapped(docs, id_col, text_col, "string", of, "doc_id long, ids array<int>", ["doc_id", "ids"], [pa.list_(pa.int32())])


def decode_documents(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the decoded text of each row's ids; null ids decode to nothing."""

    def of():
        coder = word_bpe(vocabulary)
        return lambda ids: (coder.decode(ids or ()),)

    return _mapped(encoded, id_col, ids_col, "array<int>", of, "doc_id long, text string", ["doc_id", "text"], [pa.string()])


def code_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and
    decoded in one pass so that neither the ids nor the decoded text leave the task."""

    def of():
        coder = word_bpe(vocabulary)

        def one(text):
            found = [coder.words[word] for word in coder.split_words(text or "")]
            ids, decoded = " ".join([f[1] for f in found]), " ".join([f[2] for f in found])
            return (
                sum([f[0] for f in found]),
                hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )

        return one

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, id_col, text_col, "string", of, schema, names, [pa.int64(), pa.string(), pa.string()])
