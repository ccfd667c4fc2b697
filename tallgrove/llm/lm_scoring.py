"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Counting: tasks hash the words of whole texts, add up their one- and two-word grams in sorted arrays and
deal these by hash into shards; a shard's task merges them. Each shard becomes its
exact word counts and a Bloom filter, in which a gram of count c stands as often as its count's
logarithm has steps: (gram, 1), (gram, 2), ... A count is read back by probing step after step
until one is missing.

Scoring: documents are packed into blocks of about ``BLOCK_BYTES``. A block asks for each of its distinct grams
once: the sorted hashes go to the shards that know them, levels and counts come back in the same order and meet
the block again. Every gram is asked once a block, however many shards there are, so what is moved and
stored follows the text; nothing of the model reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrove.llm.frames import ready, schema_with, settled, without
from tallgrove.llm.words import BASE, SPACED, Words, mix, words

BITS = 10  # of the filter for each entry
PROBES = 4
STEP = 1.5  # ratio of neighbouring count levels
WEIGHT = 0.6  # of two-word grams
SHARD_BYTES = 8_000_000  # of text for each shard
ROUND_BYTES = 64_000_000  # of the model, in a task that looks grams up
LOOKUPS = 256  # tasks that look grams up, unless ROUND_BYTES asks for more
TOGETHER = 500_000  # grams that are looked up together
BLOCK_BYTES = 8_000_000  # of documents that ask together
FLUSH = 1_000_000  # grams a task holds before it deals them out
END = np.uint64(0x2545F4914F6CDD1D)
START = np.uint64(0x9FB21C651E98DF25)
OUTPUT = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokens_of(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words followed by its end, and the row of each."""
    ends = np.cumsum(w.counts())
    return np.insert(w.hash, ends, END), np.insert(w.doc, ends, np.arange(w.rows))


def before(tokens: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The token that each token follows; a text's first follows the start."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.r_[True, rows[1:] != rows[:-1]]] = START
    return out


def pairs_of(tokens: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return mix(before(tokens, rows) * np.uint64(BASE) + tokens)


def level(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, one more for each factor of STEP."""
    return 1 + np.floor(np.log(counts) / math.log(STEP) + 1e-9).astype(np.int64)


#: The count a level stands for: the middle of its range.
COUNT_OF = np.array([0.0, 1.0, *((STEP ** (j - 1) + max(STEP ** (j - 1), STEP**j - 1)) / 2 for j in range(2, 120))])


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """By range of the hash, so that shards in order are keys in order."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def step_hash(keys: np.ndarray, step: int) -> np.ndarray:
    return mix(keys + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))


def bit_places(mixed: np.ndarray, probe: int, sizes: np.ndarray) -> np.ndarray:
    """Bits of a gram's step: from one hash, turned by an odd number for each probe; sizes are below 2**32."""
    turned = (mixed + np.uint64(probe) * ((mixed << np.uint64(32)) | np.uint64(1))) >> np.uint64(32)
    return (turned * sizes) >> np.uint64(32)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    everything, number = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(everything, kind="stable")
    everything, number = everything[order], number[order]
    if not len(everything):
        return everything, number
    first = np.flatnonzero(np.r_[True, everything[1:] != everything[:-1]])
    return everything[first], np.add.reduceat(number, first)


def bloom(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of one shard."""
    steps = level(counts)
    size = max(64, (int(steps.sum()) * BITS + 7) // 8 * 8)
    bits = np.zeros(size, bool)
    for step in range(1, int(steps.max(initial=0)) + 1):
        mixed = step_hash(keys[steps >= step], step)
        for probe in range(PROBES):
            bits[bit_places(mixed, probe, np.uint64(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


DEALT = "shard int, kind int, keys binary, counts binary"


def count_grams(shards: int):
    """Map over texts to the grams' sorted hashes and counts, dealt into shards; kind 1 words, 2 pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list] = {1: [], 2: []}
        held = 0

        def flush() -> pa.RecordBatch:
            columns: list[list] = [[], [], [], []]
            for kind, parts in open_.items():
                if not parts:
                    continue
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                cuts = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
                for s in range(shards):
                    a, b = cuts[s], cuts[s + 1]
                    if a < b:
                        row = (s, kind, keys[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes())
                        for column, value in zip(columns, row):
                            column.append(value)
                parts.clear()
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "kind", "keys", "counts"]
            )

        for batch in batches:
            for w in words(batch.column(0), SPACED):
                tokens, rows = tokens_of(w)
                open_[1] += [tokens, np.full(w.rows, START, np.uint64)]
                open_[2].append(pairs_of(tokens, rows))
                held += len(tokens)
                if held >= FLUSH:
                    yield flush()
                    held = 0
        yield flush()

    return run


BUILT = "shard int, words long, tokens long, keys binary, counts binary, filter binary"


def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge whole shards of a partition that is sorted by shard."""
    now, parts = None, {1: ([], []), 2: ([], [])}

    def finish() -> pa.RecordBatch:
        none = ([np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)])
        words_, counts = merged(*(parts[1] if parts[1][0] else none))
        pairs, times = merged(*(parts[2] if parts[2][0] else none))
        bits = bloom(np.concatenate([words_, pairs]), np.concatenate([counts, times]))
        own = words_ != START
        narrow = np.uint32 if counts.max(initial=0) < 2**32 else np.int64
        row = (now, int(own.sum()), int(counts[own].sum()), words_.tobytes(), counts.astype(narrow).tobytes(), bits)
        schema = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row, schema)],
            names=["shard", "words", "tokens", "keys", "counts", "filter"],
        )

    for batch in batches:
        for shard, kind, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if shard != now:
                if now is not None:
                    yield finish()
                now, parts = shard, {1: ([], []), 2: ([], [])}
            parts[kind][0].append(np.frombuffer(keys, np.uint64))
            parts[kind][1].append(np.frombuffer(counts, np.uint32).astype(np.int64))
    if now is not None:
        yield finish()


def counts_of(row) -> np.ndarray:
    wide = len(row["counts"]) == len(row["keys"])
    return np.frombuffer(row["counts"], np.int64 if wide else np.uint32)


class Shards(NamedTuple):
    """What one range of shards knows: the shards' words in order, and their filters end to end."""

    first: int
    last: int
    of: int
    keys: np.ndarray
    counts: np.ndarray
    bits: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of_rows(cls, rows: list, first: int, last: int, of: int) -> Shards:
        bits = {r["shard"]: np.frombuffer(r["filter"], np.uint8) for r in rows}
        rows = sorted(rows, key=lambda r: r["shard"])
        parts = [bits.get(s, np.zeros(8, np.uint8)) for s in range(first, last)]
        lengths = np.array([len(p) for p in parts])
        none = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        return cls(
            first, last, of,
            np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows] or none[0]),
            np.concatenate([counts_of(r) for r in rows] or none[1]),
            np.concatenate(parts), (np.cumsum(lengths) - lengths) * 8, (lengths * 8).astype(np.uint64),
        )

    def exact(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0).astype(np.int64)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Probe level by level until an entry is missing."""
        shard = shard_of(keys, self.of) - self.first
        start, size = self.starts[shard], self.sizes[shard]
        found = np.zeros(len(keys), np.uint8)
        open_ = np.arange(len(keys))
        for step in range(1, len(COUNT_OF)):
            mixed = step_hash(keys[open_], step)
            for probe in range(PROBES):
                place = start[open_] + bit_places(mixed, probe, size[open_]).astype(np.int64)
                hit = (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                open_, mixed = open_[hit], mixed[hit]
            if not len(open_):
                break
            found[open_] = step
        return found


class Model:
    """Counts of a corpus, as stored shards; ``ranges`` are the shards that are asked together."""

    def __init__(self, docs: DataFrame, shard_bytes: int = SHARD_BYTES, round_bytes: int = ROUND_BYTES) -> None:
        self.spark = ready(docs.sparkSession)
        texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
        self.texts, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
        self.count = max(1, -(-size // shard_bytes))
        dealt = texts.mapInArrow(count_grams(self.count), DEALT)
        built = dealt.repartition(self.count, "shard").sortWithinPartitions("shard").mapInArrow(build, BUILT)
        self.table = settled(built, "gram-shards")
        known = self.table.select(
            "shard", "words", "tokens", (F.length("keys") + F.length("counts") + F.length("filter")).alias("bytes")
        ).orderBy("shard").collect()  # one small row for each shard
        self.tokens = sum(r["tokens"] for r in known)
        self.words = sum(r["words"] for r in known)
        sizes = {r["shard"]: r["bytes"] for r in known}
        bound = min(round_bytes, sum(sizes.values()) // LOOKUPS)
        self.ranges, first, held = [], 0, 0
        for shard in range(self.count):
            if held and held + sizes.get(shard, 0) > bound:
                self.ranges.append((first, shard))
                first, held = shard, 0
            held += sizes.get(shard, 0)
        self.ranges.append((first, self.count))


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as the bytes of their differences, plane by plane: the upper ones are empty."""
    planes = np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def shrunk(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values), codec="zstd", asbytes=True)


def grown(data: bytes, n: int, kind: type) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, size, codec="zstd", asbytes=True) if n else b"", kind)


BLOCK = "block long, part int, data binary, n_words int, words binary, n_pairs int, pairs binary"
BLOCK_TYPES = (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.binary())
BLOCK_NAMES = ("block", "part", "data", "n_words", "words", "n_pairs", "pairs")
#: The part of the rows that must stand first: a range's model, a block's documents.
FIRST = -1


def block_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(BLOCK_TYPES), BLOCK_TYPES)], names=list(BLOCK_NAMES)
    )


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents, whole rows, as blocks of about ``BLOCK_BYTES``; a block is written once and read as it is."""
    task, number = TaskContext.get().partitionId() << 32, 0
    open_: list[pa.RecordBatch] = []

    def close() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, open_[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for batch in open_:
                out.write_batch(batch)
        return block_rows([(task + number, FIRST, sink.getvalue().to_pybytes(), 0, b"", 0, b"")])

    held = 0
    for batch in batches:
        if open_ and held + batch.nbytes > BLOCK_BYTES:
            yield close()
            open_, held, number = [], 0, number + 1
        open_.append(batch)
        held += batch.nbytes
    if open_:
        yield close()


def block_of(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def grams_of(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a block's texts, the row of each, and the pair that ends with each."""
    parts: list[tuple] = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for w in words(texts, SPACED):
        tokens, rows = tokens_of(w)
        parts.append((tokens, rows + w.first, pairs_of(tokens, rows)))
    return tuple(np.concatenate(c) for c in zip(*parts))


def ask(ranges: list[tuple[int, int]], shards: int):
    """Map of blocks to their distinct words and pairs, cut by the ranges that know them."""
    borders = np.array([first for first, _ in ranges] + [shards])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                tokens, _, pairs = grams_of(block_of(data.as_buffer()).column("text"))
                asked, cuts = [np.unique(tokens), np.unique(pairs)], []
                for keys in asked:
                    cuts.append(np.searchsorted(shard_of(keys, shards), borders).tolist())
                rows = []
                for part in range(len(ranges)):
                    some = [keys[at[part] : at[part + 1]] for keys, at in zip(asked, cuts)]
                    if len(some[0]) or len(some[1]):
                        rows.append((block, part, None, len(some[0]), packed(some[0]), len(some[1]), packed(some[1])))
                yield block_rows(rows)

    return run


def answers_to(rows: list[dict], known: Shards) -> pa.RecordBatch:
    """The rows' grams are looked up together, each distinct one once."""
    asked = [unpacked(r[c], r[f"n_{c}"]) for r in rows for c in ("words", "pairs")]
    keys, which = np.unique(np.concatenate(asked), return_inverse=True)
    levels = np.split(known.levels(keys)[which], np.cumsum([len(a) for a in asked])[:-1])
    counts = np.split(known.exact(np.concatenate(asked[::2])), np.cumsum([len(a) for a in asked[::2]])[:-1])
    return block_rows([
        (r["block"], r["part"], shrunk(count), r["n_words"], shrunk(word), r["n_pairs"], shrunk(pair))
        for r, count, word, pair in zip(rows, counts, levels[::2], levels[1::2])
    ])


def answer(ranges: list[tuple[int, int]], shards: int):
    """Map of a range's model and then its questions to answers: levels and counts of words, levels of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, held, open_, waiting = None, None, [], [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if open_ and (r["part"] != now or waiting >= TOGETHER):
                    yield answers_to(open_, known)
                    open_, waiting = [], 0
                if r["part"] != now:
                    now, known, held = r["part"], None, []
                if r["block"] == FIRST:
                    held.append({"shard": r["n_words"], "keys": r["words"], "counts": r["pairs"], "filter": r["data"]})
                    continue
                if known is None:
                    known, held = Shards.of_rows(held, *ranges[now], shards), []
                open_.append(r)
                waiting += r["n_words"] + r["n_pairs"]
        if open_:
            yield answers_to(open_, known)

    return run


def score(docs: DataFrame, model: Model, weight: float = WEIGHT) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score.

    A text's tokens are its words and one end. ``base_score`` adds the log10 of (c + 1) / (N + V + 1)
    with exact counts. ``score`` is the model's log10 probability: of each token the pair's share of its
    predecessor, mixed by ``weight`` with the smoothed share of the word alone, from the filter's quantised
    counts; a predecessor that was never seen leaves the word alone. A null or empty text is its end alone. Without
    training text all counts are 0. Input columns named like the output are replaced.
    """
    base = without(docs, *OUTPUT)
    total, distinct, ranges, shards = model.tokens, model.words, model.ranges, model.count
    names = base.columns
    final = schema_with(
        base, n_tokens="long", n_known="long", train_tokens="long", base_score="double", score="double"
    )
    started = int(level(np.array([model.texts]))[0]) if model.texts else 0
    floor = math.log10(total + distinct + 1)

    def likelihoods(rows: np.ndarray, word_levels: np.ndarray, pair_levels: np.ndarray, texts: int) -> np.ndarray:
        word, pair = COUNT_OF[word_levels], COUNT_OF[pair_levels]
        context = np.r_[COUNT_OF[started], word[:-1]]
        context[np.r_[True, rows[1:] != rows[:-1]]] = COUNT_OF[started]
        alone = np.minimum(1.0, (word + 1) / (total + distinct + 1))
        share = np.minimum(1.0, pair / np.maximum(context, 1))
        both = np.where(context > 0, weight * share + (1 - weight) * alone, alone)
        return np.bincount(rows, np.log10(both), texts)

    def finish(data: bytes, said: list[dict]) -> Iterator[pa.RecordBatch]:
        """said: the answers to a block, by range, which is the order of its sorted grams."""
        table = block_of(data)
        tokens, rows, pairs = grams_of(table.column("text"))
        count = [np.concatenate([np.zeros(0, np.int64), *(grown(r["data"], r["n_words"], np.int64) for r in said)])]
        count += [
            np.concatenate([np.zeros(0, np.uint8), *(grown(r[c], r[f"n_{c}"], np.uint8) for r in said)])
            for c in ("words", "pairs")
        ]
        asked, which = np.unique(tokens, return_inverse=True)
        asked_pairs, which_pair = np.unique(pairs, return_inverse=True)
        if (len(asked), len(asked_pairs)) != (len(count[0]), len(count[2])):
            raise ValueError(f"{len(asked)} words and {len(asked_pairs)} pairs asked, {len(count[0])} and {len(count[2])} answered")
        n, known = table.num_rows, count[0][which]
        columns = [
            np.bincount(rows, minlength=n).astype(np.int64), np.bincount(rows, known > 0, n).astype(np.int64),
            np.full(n, total), np.bincount(rows, np.log10(known + 1.0) - floor, n),
            likelihoods(rows, count[1][which], count[2][which_pair], n),
        ]
        for name, column in zip(OUTPUT, columns):
            table = table.append_column(name, pa.array(column))
        yield from table.select([*names, *OUTPUT]).to_batches()

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, data, said = None, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] != now:
                    if now is not None:
                        yield from finish(data, said)
                    now, data, said = r["block"], r["data"], []
                else:
                    said.append(r)
        if now is not None:
            yield from finish(data, said)

    # A block is one long row, so row groups are closed by size after each.
    blocks = settled(base.mapInArrow(pack, BLOCK), "blocks", **{
        "parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1,
    })
    questions = blocks.select("block", "data").mapInArrow(ask(ranges, shards), BLOCK)
    part = F.size(F.filter(F.lit([first for first, _ in ranges]), lambda first: first <= F.col("shard"))) - 1
    shelves = model.table.select(
        F.lit(FIRST).cast("long").alias("block"), part.cast("int").alias("part"), F.col("filter").alias("data"),
        F.col("shard").alias("n_words"), F.col("keys").alias("words"), F.lit(0).alias("n_pairs"), F.col("counts").alias("pairs"),
    )
    answers = settled(
        questions.unionByName(shelves).repartition(len(ranges), "part").sortWithinPartitions("part", "block").mapInArrow(
            answer(ranges, shards), BLOCK
        ),
        "answers",
    )
    parts = max(1, -(-blocks.count() // 2))
    met = blocks.unionByName(answers).repartition(parts, "block").sortWithinPartitions("block", "part")
    return met.mapInArrow(rate, final)


def held_out(identity: Column, parts: int = 7, part: int = 2) -> Column:
    """By the checksum of the id as text; a null id reads as ''."""
    return F.crc32(F.coalesce(identity.cast("string"), F.lit(""))) % parts == part
