"""A hierarchical Pitman-Yor language model, sampled on the cluster.

Tokens are lower-cased words and one end per text. Every context seen in training (the start
of a text, and every word as the word before) has a restaurant; all of them share the root
restaurant as parent, whose base is uniform over the known tokens and one class for all others.
After a word that training never saw the root itself predicts, as in an empty restaurant. A
token is a customer of its context's restaurant; each table there sends one customer to the
root.

Seating is sampled by blocked Gibbs: in a sweep all customers of every dish are seated anew, at
a table in proportion to its size less the discount, or at a new one in proportion to strength
and parent probability (see ``Tables``). The totals of a restaurant are frozen during a pass,
which is what lets dishes be sampled side by side; they are refreshed between passes, and the
second pass goes on from the seating the first has reached.
All contexts of a word are in one bucket, so what its tables send to the root is known there.
What passes between buckets are the totals of each restaurant: a bucket sends its share of
every context it holds to that context's shard, and gets the sums back in the same order.
Shards number their contexts when they first hear of them, so that hashes travel once and
differences of numbers after that.
Predictive probabilities are averaged over the samples kept, each with the totals it had.

Blocks of documents send their distinct words with the contexts they follow and training
counts; buckets answer with counts and log-probabilities in the same order, so no key goes
back. A frequent word costs its bucket one entry per block and context it follows there.

Random numbers come from the seed and the bucket alone: a task that is run again, and a later
pass with the same totals, draw the same.

Defined results: a null or empty text is one end; a document is held out when the CRC-32 of
its id as text (null: no text) leaves no remainder; repeated rows count and are scored row by
row; without any training document every score is 0; an empty table gives no rows; other
columns are not read.
"""

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.blocks import Words, by_bucket, from_payload, pack, stage_blocks, text_bytes, unpack
from mixloom.storage import drop_staged, staged

FOLDS = 10
BUCKET_BYTES = 4 << 20
MODEL_BLOCK_BYTES = 6 << 20  # of text: a larger block has fewer cells for its tokens
DISCOUNT, STRENGTH = 0.8, 1.0  # of the context restaurants
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 10.0
BURN_IN, SAMPLES = 3, 3  # sweeps of a pass before and at which samples are kept
SMALL = 128  # customers up to which the tables of a dish are drawn from the listed distribution
NOT_SEATED = -1e300  # in the place of a log chance: any seating is better
PROPOSALS, ROOT_PROPOSALS = 4, 16  # seatings proposed per sweep and larger dish
END = b"\n"  # no word holds white space; also the context at the start of a text


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == 0


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as hold them all."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def planes(counts: np.ndarray) -> np.ndarray:
    """Counts byte by byte, the lowest bytes of all first, which packs small ones well; ``whole``
    puts them together again."""
    counts = narrow(counts)
    size = counts.dtype.itemsize
    return np.append(np.uint8(size), counts.view(np.uint8).reshape(-1, size).T.ravel())


def whole(split: np.ndarray) -> np.ndarray:
    size = int(split[0])
    return np.ascontiguousarray(split[1:].reshape(size, -1).T).view(f"u{size}").ravel().astype(np.int64)


def steps(numbers: np.ndarray) -> np.ndarray:
    """Rising numbers, or hashes, as their packed differences."""
    return planes(np.diff(numbers, prepend=numbers.dtype.type(0)))


def summed(split: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """What ``steps`` was given."""
    return np.cumsum(whole(split).view(kind))


class Block:
    """The token sequences of a block: ``tokens`` (numbers of its dictionary) and the ``cells``
    (token after context, numbered alike) they fall in."""

    def __init__(self, payload: bytes):
        rows = from_payload(payload)
        self.doc_ids = rows.column(0).to_pylist()
        words = Words(rows.column(1).cast(pa.binary()).to_pylist(), lower=True)
        self.dictionary = [*words.dictionary, END]
        docs, end = len(self.doc_ids), len(words.dictionary)
        self.lengths = words.counts + 1
        last = np.cumsum(self.lengths) - 1
        self.tokens = np.full(int(self.lengths.sum()), end, np.int64)
        is_word = np.ones(len(self.tokens), bool)
        is_word[last] = False
        self.tokens[is_word] = words.ids
        self.doc = np.repeat(np.arange(docs), self.lengths)
        self.held_out = np.array([is_held_out(i) for i in self.doc_ids], bool)
        self.in_training = ~self.held_out[self.doc]
        self.before = np.empty(len(self.tokens), np.int64)
        self.before[1:] = self.tokens[:-1]  # the end of a text stands before the next one's start
        self.before[:1] = end

    def find_cells(self) -> None:
        size = len(self.dictionary)
        cells, self.cell_of = np.unique(self.tokens * size + self.before, return_inverse=True)
        self.cell_token, self.cell_context = cells // size, cells % size
        self.cell_train = np.bincount(self.cell_of, self.in_training, len(cells)).astype(np.uint32)
        dictionary = Words.__new__(Words)
        dictionary.dictionary = self.dictionary
        self.hash = dictionary.hashes()[0]
        self.cells_of_token = np.bincount(self.cell_token, minlength=len(self.dictionary))

    def parts(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, its tokens, its cells), both in the block's order."""
        begin = np.concatenate([[0], np.cumsum(self.cells_of_token)])
        for bucket, tokens in by_bucket(self.hash % np.uint64(buckets), buckets):
            n = self.cells_of_token[tokens]
            cells = np.repeat(begin[tokens] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield bucket, tokens, cells


@lru_cache
def log_seatings(discount: float) -> list[np.ndarray]:
    """By customers, up to ``SMALL``: the log of the generalised Stirling numbers of 1, 2, ... tables."""
    out = [np.zeros(0), np.zeros(1)]
    for n in range(1, SMALL):
        stay = out[n] + np.log(n - discount * np.arange(1, n + 1))
        out.append(np.logaddexp(np.append(stay, -np.inf), np.append(-np.inf, out[n])))
    return out


def log_falling(size: np.ndarray, discount: float) -> np.ndarray:
    """log of gamma(size - discount) / gamma(size), up to a constant."""
    exact = np.concatenate([[0.0], np.cumsum(np.log1p(-discount / np.arange(1, 2048)))])
    far = np.maximum(size, 2048).astype(float)
    tail = -discount * np.log(far / 2048) + discount * (discount + 1) / 2 * (1 / far - 1 / 2048) + exact[-1]
    return np.where(size <= 2048, exact[np.minimum(size, 2048) - 1], tail)


class Tables:
    """Numbers of tables of many dishes, each of ``customers`` (2 or more) in one restaurant.

    With frozen totals, t tables have a chance in proportion to S(customers, t) weight**t, S
    being generalised Stirling numbers. Up to ``SMALL`` customers that is listed and drawn from.
    Beyond, it is the law of a Poisson number of tables, weight / discount at the mean, of
    independent sizes P(n) = discount (1 - discount)...(n - 1 - discount) / n!, given that the
    sizes add up to the customers. A seating of all customers is proposed: every table but the
    first customer's from that law, thinned by ratio**size so that the sizes add up to about
    the customers, and the first customer's is what is left. Its chance over that of being
    proposed is f(left) ratio**left, f(n) = gamma(n - discount) / gamma(n), which decides
    between it and the seating before (Metropolis-Hastings). ``first`` is the size of the first
    customer's table, 0 before any proposal fitted; what is proposed does not depend on it.
    """

    def __init__(self, customers: np.ndarray, discount: float, proposals: int):
        self.customers, self.discount, self.proposals = customers, discount, proposals
        self.tables = np.ones(len(customers), np.int64)
        self.large = np.flatnonzero(customers > SMALL)
        self.first = np.zeros(len(self.large), np.int64)
        order = np.argsort(customers, kind="stable")
        sizes, begin = np.unique(customers[order], return_index=True)
        dishes = np.split(order, begin[1:]) if len(begin) else []
        self.small = [(int(n), at) for n, at in zip(sizes, dishes, strict=True) if n <= SMALL]

    def sweep(self, weight: np.ndarray, rng: np.random.Generator) -> None:
        """All customers of every dish are seated again."""
        for n, at in self.small:
            logs = log_seatings(self.discount)[n] + np.log(weight[at])[:, None] * np.arange(1, n + 1)
            upto = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
            self.tables[at] = 1 + (upto[:, :-1] <= (rng.random(len(at)) * upto[:, -1])[:, None]).sum(axis=1)
        if len(self.large):
            self._propose(weight[self.large], rng)

    def _propose(self, weight: np.ndarray, rng: np.random.Generator) -> None:
        customers, d = self.customers[self.large], self.discount
        log_ratio = np.log1p(-self._loss(customers, weight))
        tables, fresh = self.tables[self.large], self.first == 0
        tables[fresh] = np.minimum(customers, 1 + np.rint(weight / d)).astype(np.int64)[fresh]
        value = np.where(fresh, NOT_SEATED, log_falling(np.maximum(self.first, 1), d) + self.first * log_ratio)
        for _ in range(self.proposals):
            number = rng.poisson(weight / d)
            dish = np.repeat(np.arange(len(customers)), number)
            # these sizes are geometric with a beta chance; one above the customers never fits
            size = np.minimum(rng.geometric(np.maximum(rng.beta(d, 1 - d, len(dish)), 1e-15)), customers[dish])
            kept = np.log(1 - rng.random(len(dish))) < size * log_ratio[dish]
            others = np.bincount(dish[kept], minlength=len(customers))
            left = customers - np.bincount(dish[kept], size[kept], len(customers)).astype(np.int64)
            new = np.where(left > 0, log_falling(np.maximum(left, 1), d) + left * log_ratio, -np.inf)
            taken = (left > 0) & (np.log(1 - rng.random(len(left))) < new - value)
            tables, self.first = np.where(taken, 1 + others, tables), np.where(taken, left, self.first)
            value = np.where(taken, new, value)
        self.tables[self.large] = tables

    def _loss(self, customers: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """1 - ratio: where the proposed sizes add up to the customers on the average."""
        low, high = np.log(1e-3 / customers), np.full(len(customers), np.log(0.99))
        for _ in range(30):
            middle = (low + high) / 2
            above = weight * -np.expm1(middle) * np.exp((self.discount - 1) * middle) > customers
            low, high = np.where(above, middle, low), np.where(above, high, middle)
        return np.exp(low)


class Bucket:
    """All tokens of one bucket with their contexts, and the sampler over them.

    ``contexts`` are its contexts in rising order, by their hashes or, once ``numbered``, their
    numbers; ``width`` is one more than they are: the last place stands for the root itself."""

    def __init__(self, number: int, packets: list[bytes]):
        parts = [unpack(p) for p in packets]
        hashes, self.lengths = (np.concatenate([p[c] for p in parts]) for c in (0, 1))
        contexts = np.concatenate([summed(p[2], np.uint64)[whole(p[3])] for p in parts])
        train = np.concatenate([whole(p[4]) for p in parts])
        self.part_tokens = [len(p[0]) for p in parts]
        self.part_cells = [len(whole(p[3])) for p in parts]
        self.contexts, contexts = np.unique(contexts, return_inverse=True)
        width = len(self.contexts) + 1
        words, self.word_of_entry = np.unique(hashes, return_inverse=True)
        keys = np.repeat(self.word_of_entry, self.lengths) * width + contexts
        cells, self.cell_of_entry = np.unique(keys, return_inverse=True)
        count = np.bincount(self.cell_of_entry, train, len(cells)).astype(np.int64)
        self._set(number, width, cells // width, cells % width, count, len(words))

    def _set(self, number: int, width: int, word: np.ndarray, context: np.ndarray, count: np.ndarray, words: int) -> None:
        self.number, self.width, self.words = number, width, words
        self.word, self.context, self.count = word, context, count
        self.known = np.bincount(word, count, words).astype(np.int64)

    def cells(self) -> bytes:
        """What sampling needs of the bucket but its contexts; ``entries`` has what the blocks
        asked for."""
        lengths = np.bincount(self.word, minlength=self.words)
        return pack(*map(planes, (lengths, self.context, self.count)))

    def numbered(self, numbers: np.ndarray, customers: np.ndarray, dishes: np.ndarray) -> bytes:
        """The bucket with its contexts by number, and what all buckets have of each: customers
        and distinct dishes. The order of cells stays."""
        order = np.argsort(numbers)
        place = np.append(np.argsort(order), self.width - 1)
        self.context = place[self.context]
        return pack(steps(numbers[order]), planes(customers[order]), planes(dishes[order]), self.cells())

    def entries(self) -> bytes:
        """By block the words and cells it asked for, the cells counted from their word's first."""
        first = np.searchsorted(self.word, np.arange(self.words))
        after = self.cell_of_entry - np.repeat(first[self.word_of_entry], self.lengths)
        sizes = np.array(self.part_tokens), np.array(self.part_cells)
        return pack(*map(planes, (*sizes, self.word_of_entry, self.lengths, after)))

    def split(self, entries: bytes, by_word: np.ndarray, by_cell: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is known by word and by cell, for the entries of each block."""
        tokens, cells, words, lengths, after = map(whole, unpack(entries))
        first = np.searchsorted(self.word, np.arange(self.words))
        at = np.repeat(first[words], lengths) + after
        of_words = np.split(by_word[words], np.cumsum(tokens)[:-1])
        return zip(of_words, np.split(by_cell[at], np.cumsum(cells)[:-1]), strict=True)

    @classmethod
    def from_cells(cls, number: int, cells: bytes, contexts: np.ndarray) -> "Bucket":
        self = cls.__new__(cls)
        self.contexts = contexts
        lengths, context, count = map(whole, unpack(cells))
        word = np.repeat(np.arange(len(lengths)), lengths)
        self._set(number, len(contexts) + 1, word, context, count, len(lengths))
        return self

    @classmethod
    def from_numbered(cls, number: int, packet: bytes) -> tuple["Bucket", np.ndarray, np.ndarray]:
        """(bucket, customers, dishes) of what ``numbered`` gave."""
        numbers, customers, dishes, cells = unpack(packet)
        return cls.from_cells(number, cells, summed(numbers)), whole(customers), whole(dishes)

    @classmethod
    def from_hashed(cls, number: int, cells: bytes, contexts: bytes) -> "Bucket":
        """The bucket with its contexts by their hashes."""
        return cls.from_cells(number, cells, summed(unpack(contexts)[0], np.uint64))

    def totals(self) -> np.ndarray:
        """By context: customers and distinct dishes; the last row's dishes are the known words."""
        inside = np.bincount(self.context, self.count, self.width)
        dishes = np.bincount(self.context, self.count > 0, self.width)
        dishes[-1] = (self.known > 0).sum()
        return np.stack([inside, dishes])

    def samples(self, model: "Totals", seed: int, begin: bytes | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(tables per cell, root customers and root tables per word) of each sample kept, going
        on from the seating ``begin``. Where that has led to is then in ``reached``."""
        rng = np.random.default_rng([seed, self.number, begin is not None])
        seated = (self.context < self.width - 1) & (self.count > 0)
        direct = np.bincount(self.word, np.where(seated, 0, self.count), self.words).astype(np.int64)
        tables = np.where(seated, 1, 0).astype(np.int64)
        several = np.flatnonzero(seated & (self.count > 1))
        into = model.strengths()[self.context[several]]
        seating = Tables(self.count[several], DISCOUNT, PROPOSALS)
        if begin is None:
            customers = direct + np.bincount(self.word, tables, self.words).astype(np.int64)
            at_root = np.minimum(customers, 1)
        else:
            customers, at_root, of_large, first = map(whole, unpack(begin))
            seating.tables[seating.large], seating.first = of_large, first
        for sweep in range(BURN_IN + SAMPLES):
            seating.sweep(into * model.root(customers, at_root)[self.word[several]], rng)
            tables = tables.copy()
            tables[several] = seating.tables
            customers = direct + np.bincount(self.word, tables, self.words).astype(np.int64)
            shared = np.flatnonzero(customers > 1)
            root = Tables(customers[shared], ROOT_DISCOUNT, ROOT_PROPOSALS)
            root.sweep(np.full(len(shared), model.root_weight()), rng)
            at_root = np.minimum(customers, 1)
            at_root[shared] = root.tables
            self.reached = pack(*map(planes, (customers, at_root, seating.tables[seating.large], seating.first)))
            if sweep >= BURN_IN:
                yield tables, customers, at_root

    def sampled_totals(self, model: "Totals", seed: int, begin: bytes | None = None) -> np.ndarray:
        """By sample: tables per context, then customers and tables of the root."""
        rows = []
        for tables, customers, at_root in self.samples(model, seed, begin):
            rows.append([*np.bincount(self.context, tables, self.width)[:-1], customers.sum(), at_root.sum()])
        return np.array(rows)

    def log_probabilities(self, model: "Totals", realised: list["Totals"], seed: int, begin: bytes | None = None) -> np.ndarray:
        """log10 of every cell's predictive probability, averaged over the samples."""
        total = np.zeros(len(self.word))
        for (tables, customers, at_root), now in zip(self.samples(model, seed, begin), realised, strict=True):
            parent = now.root(customers, at_root)[self.word]
            held, own = now.customers[self.context], self.count - DISCOUNT * tables
            inside = (own + now.strengths()[self.context] * parent) / (STRENGTH + held)
            total += np.where(self.context == self.width - 1, parent, inside)
        return np.log10(total / len(realised))


class Totals:
    """What a pass knows of all buckets: customers and tables by context, and the root's."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray, root_customers: float, root_tables: float, known: float):
        self.customers, self.tables = customers, tables
        self.root_customers, self.root_tables, self.known = root_customers, root_tables, known

    def strengths(self) -> np.ndarray:
        return STRENGTH + DISCOUNT * self.tables

    def root_weight(self) -> float:
        return (ROOT_STRENGTH + ROOT_DISCOUNT * self.root_tables) / (self.known + 1)

    def root(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        return (customers - ROOT_DISCOUNT * tables + self.root_weight()) / (ROOT_STRENGTH + self.root_customers)


def shards_of(contexts: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its contexts) of hashes or numbers."""
    return by_bucket(contexts % contexts.dtype.type(shards), shards)


def received(contexts: np.ndarray, shards: int, answers: list[dict]) -> tuple[bytes | None, list[np.ndarray]]:
    """The packet a bucket kept, and what the shards say of each of its contexts."""
    found = {a["shard"]: unpack(a["packet"]) for a in answers}
    kept = next((items[0] for items in found.values() if items[0] is not None), None)
    sums = [np.zeros(len(contexts), np.int64) for _ in next(iter(found.values()))[1:]]
    for shard, at in shards_of(contexts, shards):
        for total, part in zip(sums, found[shard][1:], strict=True):
            total[at] = whole(part)
    return kept, sums


def _listed(answers: DataFrame) -> DataFrame:
    """(bucket, answers) of what shards told."""
    return answers.groupBy("bucket").agg(F.collect_list(F.struct("shard", "packet")).alias("answers"))


class PitmanYor:
    """The model of one corpus, learned from its training documents."""

    def __init__(self, docs: DataFrame, seed: int = 7):
        self.seed = seed
        self.buckets = int(max(16, text_bytes(docs) // BUCKET_BYTES))
        self.blocks = stage_blocks(docs, block_bytes=MODEL_BLOCK_BYTES)
        self.cells = self._cells()
        self._learn()

    def _cells(self) -> DataFrame:
        """Staged (bucket, blocks, contexts, cells, entries): what all blocks have of a bucket's words."""
        buckets = self.buckets

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    block = Block(payload.as_py())
                    block.find_cells()
                    rows = []
                    for bucket, tokens, cells in block.parts(buckets):
                        contexts, context = np.unique(block.hash[block.cell_context[cells]], return_inverse=True)
                        counts = planes(block.cell_train[cells])
                        packet = pack(block.hash[tokens], narrow(block.cells_of_token[tokens]), steps(contexts), planes(context), counts)
                        rows.append((bucket, number, packet))
                    columns = list(zip(*rows, strict=True))
                    types = [pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "block", "packet"])

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, parts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    parts = parts.as_py()
                    bucket = Bucket(number, [p["packet"] for p in parts])
                    columns = [[number], [[p["block"] for p in parts]], [pack(steps(bucket.contexts))], [bucket.cells()], [bucket.entries()]]
                    types = [pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
                    names = ["bucket", "blocks", "contexts", "cells", "entries"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        sent = self.blocks.mapInArrow(send, "bucket int, block long, packet binary")
        parts = F.sort_array(F.collect_list(F.struct("block", "packet"))).alias("parts")
        schema = "bucket int, blocks array<long>, contexts binary, cells binary, entries binary"
        return staged(sent.groupBy("bucket").agg(parts).mapInArrow(build, schema), "model-cells", drop_shuffles=True)

    def _summed(self, rows: DataFrame, of, own_sums: int, hashed: bool = False) -> tuple[DataFrame, np.ndarray]:
        """Lets buckets add up what they have of each context. ``of`` gives for a row of
        ``rows``: the bucket, counts (each an array by its contexts), the bucket's own numbers,
        and a packet to keep. Returns staged answers by bucket and shard, to be listed and read by
        ``received``, and the sums of the buckets' own numbers. Where contexts are still ``hashed``, the answers
        begin with their places in the shard."""
        shards = self.buckets

        def keys(contexts: np.ndarray) -> np.ndarray:
            return steps(contexts if hashed else contexts // shards)

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    bucket, counts, own, kept = of(*(c[row].as_py() for c in batch.columns))
                    home, out = bucket.number % shards, {}
                    for shard, at in shards_of(bucket.contexts, shards):
                        out[shard] = [keys(bucket.contexts[at]), *(planes(c[at]) for c in counts)]
                    out.setdefault(home, [keys(bucket.contexts[:0]), *[planes(np.zeros(0, np.int64))] * len(counts)])
                    packets = [pack(np.array(own if s == home else [], np.float64), kept if s == home else None, *x) for s, x in out.items()]
                    columns = [pa.array(list(out), pa.int32()), pa.array([bucket.number] * len(out), pa.int32()), pa.array(packets, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "bucket", "packet"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, parts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    parts = parts.as_py()
                    numbers, items = [p["bucket"] for p in parts], [unpack(p["packet"]) for p in parts]
                    asked = [summed(i[2], np.uint64 if hashed else np.int64) for i in items]
                    ends = np.cumsum([len(x) for x in asked])[:-1]
                    contexts, at = np.unique(np.concatenate(asked), return_inverse=True)
                    sums = [np.bincount(at, np.concatenate([whole(x) for x in c]), len(contexts)).astype(np.int64) for c in list(zip(*items, strict=True))[3:]]
                    told = [np.arange(len(contexts)), *sums] if hashed else sums
                    packets = [pack(i[1], *(planes(c[a]) for c in told)) for i, a in zip(items, np.split(at, ends), strict=True)]
                    own = [np.sum([i[0] for i in items if len(i[0])], axis=0).tolist() if any(len(i[0]) for i in items) else None]
                    lists = pa.array(own + [None] * (len(numbers) - 1), pa.list_(pa.float64()))
                    columns = [pa.array(numbers, pa.int32()), pa.array([shard] * len(numbers), pa.int32()), pa.array(packets, pa.binary()), lists]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "shard", "packet", "own"])

        sent = rows.mapInArrow(send, "shard int, bucket int, packet binary")
        parts = F.sort_array(F.collect_list(F.struct("bucket", "packet"))).alias("parts")
        answers = staged(sent.groupBy("shard").agg(parts).mapInArrow(add, "bucket int, shard int, packet binary, own array<double>"), "model-totals", drop_shuffles=True)
        own = answers.agg(*[F.sum(F.get("own", F.lit(k))).alias(f"own{k}") for k in range(own_sums)]).first()
        return answers, np.array([x or 0.0 for x in own])

    def _learn(self) -> None:
        """The first pass samples with a table a dish, the second with what came of it."""
        seed, shards = self.seed, self.buckets

        def count(number: int, cells: bytes, contexts: bytes):
            bucket = Bucket.from_hashed(number, cells, contexts)
            customers, dishes = bucket.totals().astype(np.int64)
            return bucket, [customers[:-1], dishes[:-1]], [dishes[-1], customers.sum(), dishes[:-1].sum()], None

        cells = self.cells.select("bucket", "cells", "contexts")
        told, (known, train_tokens, tables) = self._summed(cells, count, 3, hashed=True)
        known = float(known)
        self.known, self.train_tokens = known, int(train_tokens)
        root = tables, known
        self.numbered = self._numbered(self.cells.join(_listed(told), "bucket"))
        drop_staged(told)
        drop_staged(self.cells)

        def first(number: int, packet: bytes):
            bucket, customers, dishes = Bucket.from_numbered(number, packet)
            rows = sampled(bucket, customers, dishes * SAMPLES, root)
            return bucket, [rows[:, :-2].sum(axis=0)], rows[:, -2:].ravel(), bucket.reached

        def second(number: int, packet: bytes, answers: list[dict]):
            bucket, customers, _ = Bucket.from_numbered(number, packet)
            begin, (tables,) = received(bucket.contexts, shards, answers)
            rows = sampled(bucket, customers, tables, root, begin)
            return bucket, list(rows[:, :-2]), rows[:, -2:].ravel(), pack(planes(tables), begin)

        def sampled(bucket: Bucket, customers: np.ndarray, tables: np.ndarray, root: tuple[float, float], begin: bytes | None = None):
            model = Totals(np.append(customers, 0), np.append(tables / SAMPLES, 0), *root, known)
            return bucket.sampled_totals(model, seed, begin).astype(np.int64)

        for step in (first, second):
            self.sampled_with = root
            rows, heard = self.numbered.select("bucket", "numbered"), told
            told, own = self._summed(rows if step is first else rows.join(_listed(heard), "bucket"), step, 2 * SAMPLES)
            if step is second:
                drop_staged(heard)
            self.realised = np.reshape(own, (SAMPLES, 2))
            root = tuple(self.realised.mean(axis=0))
        # one table for the scores: what it is made of is gone before they need disk of their own
        self.asked = staged(self.numbered.join(_listed(told), "bucket"), "model-asked", drop_shuffles=True)
        drop_staged(self.numbered)
        drop_staged(told)

    def _numbered(self, counted: DataFrame) -> DataFrame:
        """Staged (bucket, numbered, blocks, entries): the buckets with the numbers that shards gave
        their contexts."""
        shards = self.buckets

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    own, cells, contexts, answers = (batch.column(c)[row].as_py() for c in range(4))
                    bucket = Bucket.from_hashed(own, cells, contexts)
                    _, (places, customers, dishes) = received(bucket.contexts, shards, answers)
                    numbers = places * shards + (bucket.contexts % np.uint64(shards)).astype(np.int64)
                    packet = bucket.numbered(numbers, customers, dishes)
                    passed = [batch.column(c).slice(row, 1) for c in (4, 5)]
                    columns = [pa.array([own], pa.int32()), pa.array([packet], pa.binary()), *passed]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "numbered", "blocks", "entries"])

        schema = "bucket int, numbered binary, blocks array<long>, entries binary"
        chosen = counted.select("bucket", "cells", "contexts", "answers", "blocks", "entries")
        return staged(chosen.mapInArrow(number, schema), "model-numbered", drop_shuffles=True)

    def scores(self) -> DataFrame:
        """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
        seed, buckets, root, realised = self.seed, self.buckets, self.sampled_with, self.realised
        train_tokens, known = self.train_tokens, float(self.known)

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    number, packet, blocks, entries, totals = (c[row].as_py() for c in batch.columns)
                    bucket, customers, _ = Bucket.from_numbered(number, packet)
                    kept, counts = received(bucket.contexts, buckets, totals)
                    tables, begin = unpack(kept)
                    customers = np.append(customers, 0)
                    model = Totals(customers, np.append(whole(tables) / SAMPLES, 0), *root, known)
                    samples = [Totals(customers, np.append(t, 0), *r, known) for t, r in zip(counts, realised, strict=True)]
                    by_cell = bucket.log_probabilities(model, samples, seed, begin).astype(np.float32)
                    packets = [pack(c, w) for w, c in bucket.split(entries, bucket.known, by_cell)]
                    columns = [[number] * len(blocks), blocks, packets]
                    types = [pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "block", "packet"])

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            for batch in batches:
                for payload, answers in zip(batch.column(0), batch.column(1), strict=True):
                    block = Block(payload.as_py())
                    block.find_cells()
                    found = {a["bucket"]: a["packet"] for a in answers.as_py()}
                    counts, logs = np.zeros(len(block.dictionary)), np.zeros(len(block.cell_token))
                    for bucket, tokens, cells in block.parts(buckets):
                        logs[cells], counts[tokens] = unpack(found[bucket])
                    docs = len(block.doc_ids)
                    base = np.log10((counts + 0.1) / (train_tokens + 0.1 * (known + 1)))
                    columns = [
                        block.doc_ids, block.held_out, block.lengths,
                        np.bincount(block.doc, counts[block.tokens] > 0, docs).astype(np.int64), np.full(docs, train_tokens),
                        np.bincount(block.doc, base[block.tokens], docs), np.bincount(block.doc, logs[block.cell_of], docs),
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        sent = self.asked.mapInArrow(answer, "bucket int, block long, packet binary")
        answers = sent.groupBy("block").agg(F.collect_list(F.struct("bucket", "packet")).alias("answers"))
        schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        return self.blocks.join(answers, "block").select("payload", "answers").mapInArrow(score, schema)


def language_scores(docs: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and model scores of every document; see ``PitmanYor.scores``."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return PitmanYor(chosen, seed).scores()


def perplexity(scores: DataFrame, score: str = "score") -> float:
    """Of the held-out documents: 10 to the mean negative log10 probability of a token."""
    row = scores.filter("held_out").agg(F.sum(score).alias("s"), F.sum("n_tokens").alias("n")).first()
    return 10 ** (-row["s"] / row["n"]) if row["n"] else float("nan")
