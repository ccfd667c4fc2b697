"""Byte-level BPE encoding and decoding with a rank file.

Merging is a fold of Spark's higher-order functions over a word's bytes: the state is one array of the word's
pieces and, between them, the rank of every neighbouring pair, and each step joins the pair of least rank. Ranks
come from a literal map of pairs, dealt into buckets because a map is searched key by key. A piece of rank r is always
joined from the same two pieces, those that the ranks below r leave of it, so one pair a rank is enough;
``merges`` finds the pairs and refuses ranks where that does not hold.

Only distinct words are folded:

1. A map counts the words of whole texts. The commonest words, at most ``MOST_WORDS`` of at most
   ``LONGEST_WORD`` characters, are folded once and broadcast with their ids (some 20 MB at any size of corpus).
2. A second map splits every text again, takes the ids of known words from the broadcast and hands each
   document's other distinct words to the same fold, whose ids a third map puts in their places. All three run in
   one stage; no document and no word is shuffled for it.

A word of more than ``WINDOW`` bytes is folded in overlapping windows that are joined at a token which both
windows hold: a token row is the encoding of its bytes if every two neighbours are the encoding of theirs.
Where two windows share no token the whole word is folded. Decoding joins the pieces of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache, cached_property
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrove.llm.frames import ready, schema_with, stored, without

MOST_WORDS = 800_000
LONGEST_WORD = 64
FLUSH_WORDS = 500_000
BUCKETS = 16381
#: More than any id. A piece is its id + WIDE in the fold, and left * TWICE_WIDE + right names a pair of pieces.
WIDE = 1 << 24
TWICE_WIDE = 2 * WIDE
WINDOW = 128
NONE = 2**31 - 1
#: Bytes of text or ids that a map works on at once; a longer text is worked on whole.
AT_ONCE = 1 << 18
#: Ids whose pieces are joined at once.
TAKEN = 1 << 20
OUTPUT = ("token_ids",)


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file of lines ``base64 rank``; every single byte must be there."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    missing = [i for i in range(256) if bytes([i]) not in ranks]
    if missing:
        raise ValueError(f"no rank for bytes {missing}")
    return ranks


# ------------------------------------------------------------------ words


@cache
def members(name: str) -> list[int]:
    """The characters of a class as the tokenizer library knows it; engines follow Unicode at different versions."""
    import regex
    import tiktoken

    space = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    chars = regex.findall(name, space)
    # Twice the character is one piece, and so one token, if and only if the library's pattern joins them.
    pieces = [bytes([i]) for i in range(256)] + [(c + c).encode() for c in chars]
    library = tiktoken.Encoding(
        "classes", pat_str=rf"{name}+|[\s\S]", mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={}
    )
    return [ord(c) for c in chars if len(library.encode_ordinary(c + c)) == 1]


def ranges_of(name: str, top: int) -> str:
    """The characters of a class up to ``top``, as the inside of a bracket expression."""
    runs: list[list[int]] = []
    for c in members(name):
        if c > top:
            break
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in runs)


def explicit(pattern: str, top: int) -> str:
    r"""``pattern`` with \p{..}, \s and \S as explicit ranges of the characters up to ``top``."""
    known: dict[str, str] = {}
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.DOTALL):
        if part in (r"\s", r"\S") or part.startswith(r"\p"):
            # White space as Unicode has it; some engines add the separators 0x1C-0x1F.
            name = r"\p{White_Space}" if part in (r"\s", r"\S") else part
            known[name] = known.get(name) or ranges_of(name, top) or r"\U0010ffff-\U0010ffff"
            if inside and part == r"\S":
                raise ValueError(r"\S inside brackets")
            out.append(known[name] if inside else f"[{'^' if part == r'\S' else ''}{known[name]}]")
            continue
        inside = (inside or part == "[") and part != "]"
        out.append(part)
    return "".join(out)


def splitter(pattern: str) -> Callable[[], Callable[[str], list[str]]]:
    """A function that makes, in a worker, the function from a text to its matches."""
    texts = [explicit(pattern, top) for top in (0x7F, 0xFFFF, 0x10FFFF)]

    def make():
        ascii_only, basic, full = (re.compile(t).findall for t in texts)
        beyond = re.compile("[\U00010000-\U0010ffff]").search

        def words(text: str) -> list[str]:
            return ascii_only(text) if text.isascii() else full(text) if beyond(text) else basic(text)

        return words

    return make


# ------------------------------------------------------------------- fold


def merges(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left, right, joined) ids of the pair that makes every piece of more than one byte."""
    out = []
    for piece, rank in ranks.items():
        if len(piece) < 2:
            continue
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 2:
            at = [ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
            least = min(at)
            if least >= rank:
                raise ValueError(f"piece {piece!r} is not made by the ranks below its own")
            i = at.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out.append((ranks[parts[0]], ranks[parts[1]], rank))
    return out


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The literal: an array of maps from pair to rank, by the pair's remainder."""
    buckets: list[dict[int, int]] = [{} for _ in range(BUCKETS)]
    for left, right, rank in merges(ranks):
        pair = (left + WIDE) * TWICE_WIDE + right + WIDE
        buckets[pair % BUCKETS][pair] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,bigint>>").cast("array<map<bigint,bigint>>")


def lengths(ranks: dict[bytes, int]) -> Column:
    """The literal: the number of bytes by id."""
    by_id = [0] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        by_id[rank] = len(piece)
    return F.from_json(F.lit(json.dumps(by_id)), "array<int>")


def byte_ids(ranks: dict[bytes, int]) -> np.ndarray:
    return np.array([ranks[bytes([i])] for i in range(256)], np.int32)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _none() -> Column:
    return F.lit(NONE).cast("bigint")


def _rank(table: Column, left: Column, right: Column) -> Column:
    """The rank of a pair of pieces, given as in a row of the fold."""
    pair = left * TWICE_WIDE + right
    return F.coalesce(F.get(table, pair % BUCKETS)[pair], _none())


def _merge(row: Column, table: Column) -> Column:
    """Join the first pair of least rank, which is the joined piece's id."""

    def joined(row: Column, k: Column) -> Column:
        # The rank is the k-th; its pieces stand beside it, then the ranks that go, then the pieces beyond.
        rank = F.get(row, k - 1)
        piece = rank + WIDE
        before, after = _rank(table, F.get(row, k - 4), piece), _rank(table, piece, F.get(row, k + 2))
        parts = F.array(F.slice(row, F.lit(1), k - 3), F.array(before, piece, after), F.slice(row, k + 3, F.size(row)))
        return F.when(rank >= WIDE, row).otherwise(F.flatten(parts))

    # A fold over one place, which unlike _let copies no array.
    return F.aggregate(F.array(F.array_position(row, F.array_min(row)).cast("int")), row, joined)


def _pieces(word: Column, table: Column) -> Column:
    """The ids of one word, given as the ids of its bytes.

    The fold's row holds pieces (id + ``WIDE``, so above all ranks) and between every two the rank of their pair, with
    ``NONE`` twice at both ends, so that a join is one cut and every pair has neighbours.
    """
    end = F.array(_none(), _none())
    at = lambda w: w.cast("bigint") + WIDE
    pairs = F.transform(word, lambda w, i: F.array(at(w), _rank(table, at(w), at(F.get(word, i + 1)))))
    # The last piece has no right neighbour, so its rank is the first NONE of the end.
    row = F.flatten(F.concat(F.array(end), pairs, F.array(F.array(_none()))))
    # Every join shortens the word by one, so there are at most so many.
    done = F.aggregate(F.slice(word, F.lit(2), F.size(word)), row, lambda s, _: _merge(s, table))
    ids = F.transform(F.filter(done, lambda x: x < NONE), lambda x: (x - WIDE).cast("int"))
    return F.when(F.size(word) < 2, word).otherwise(ids)


def _windows(word: Column, table: Column, sizes: Column) -> Column:
    """The ids of a long word, from windows that overlap by half."""
    step = WINDOW // 2
    last = F.ceil((F.size(word) - WINDOW) / step).cast("int")

    def located(k: Column) -> Column:
        def walk(s: Column, piece: Column) -> Column:
            token = F.struct(s["at"].alias("at"), piece.alias("id"))
            return F.struct((s["at"] + F.get(sizes, piece)).alias("at"), F.concat(s["out"], F.array(token)).alias("out"))

        start = k * step
        none = F.slice(F.array(F.struct(start.alias("at"), F.lit(0).alias("id"))), 1, 0)
        part = F.slice(word, start + 1, F.lit(WINDOW))
        return F.aggregate(_pieces(part, table), F.struct(start.alias("at"), none.alias("out")), walk, lambda s: s["out"])

    def joined(tokens: Column) -> Column:
        def meet(k: Column) -> Column:
            return F.array_min(F.array_intersect(F.get(tokens, k), F.get(tokens, k + 1)))["at"]

        def cut(cuts: Column) -> Column:
            def part(k: Column) -> Column:
                first, end = F.coalesce(F.get(cuts, k - 1), F.lit(0)), F.coalesce(F.get(cuts, k), F.lit(NONE))
                return F.transform(F.filter(F.get(tokens, k), lambda x: (x["at"] >= first) & (x["at"] < end)), lambda x: x["id"])

            parts = F.flatten(F.transform(F.sequence(F.lit(0), last), part))
            return F.when(F.exists(cuts, lambda c: c.isNull()), _pieces(word, table)).otherwise(parts)

        return _let(F.transform(F.sequence(F.lit(0), last - 1), meet), cut)

    return _let(F.transform(F.sequence(F.lit(0), last), located), joined)


def fold_words(words: Column, ranks: dict[bytes, int]) -> Column:
    """array<array<int>>: the ids of every word of an array of words, given as ids of bytes."""

    def all_words(table: Column, sizes: Column) -> Column:
        return F.transform(words, lambda w: F.when(F.size(w) <= WINDOW, _pieces(w, table)).otherwise(_windows(w, table, sizes)))

    return _let(rank_table(ranks), lambda table: _let(lengths(ranks), lambda sizes: all_words(table, sizes)))


# ----------------------------------------------------------------- corpus


def word_counts(docs: DataFrame, make: Callable) -> DataFrame:
    """(word, n) of the words of at most ``LONGEST_WORD`` characters, as often as a task met them twice and more.

    Only the choice of the words that are folded once rests on it; no result does.
    """

    def count(batches):
        words, seen = make(), Counter()

        def rows():
            often = [(w, n) for w, n in seen.items() if n > 1 and len(w) <= LONGEST_WORD]
            seen.clear()
            for at in range(0, len(often), 20_000):
                part = often[at : at + 20_000]
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array([w for w, _ in part], pa.string()), "n": pa.array([n for _, n in part], pa.int64()),
                })

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(words(text))
                    if len(seen) > FLUSH_WORDS:
                        yield from rows()
        yield from rows()

    partial = docs.select("text").mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def known_words(spark: SparkSession, docs: DataFrame, make: Callable, ranks: dict[bytes, int], most: int) -> pa.Table:
    """(word, ids) of the commonest words, at most ``most``: whole steps of a logarithmic scale of counts."""
    counts = stored(word_counts(docs, make), "words")
    step = F.floor(F.log2("n") * 4).cast("int")
    total, least = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        total += row["n"]
        if total > most:
            break
        least = row["step"]
    chosen = counts.filter(step >= least) if least is not None else counts.limit(0)
    tasks = max(32, spark.sparkContext.defaultParallelism)
    of_byte = byte_ids(ranks)

    def spell(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), spelled(batch.column(0).to_pylist(), of_byte)], names=["word", "bytes"])

    # Few bytes but long work, so the words are dealt out anew.
    spread = chosen.select("word").repartition(tasks, "word").mapInArrow(spell, "word string, bytes array<int>")
    return spread.select("word", F.get(fold_words(F.array("bytes"), ranks), F.lit(0)).alias("ids")).toArrow()


def spelled(words: list[str], of_byte: np.ndarray) -> pa.ListArray:
    """Every word as the ids of its bytes."""
    data = [w.encode() for w in words]
    ends = np.cumsum([0, *map(len, data)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(of_byte[np.frombuffer(b"".join(data), np.uint8)]))


class Known:
    """The words that are folded once, as a worker looks them up; what a worker derives stays for its next tasks."""

    def __init__(self, words: pa.Table) -> None:
        self.words = words.combine_chunks()

    @cached_property
    def lookup(self) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
        """The place of each word; where its ids start, how many they are, and all ids, each with one more behind.

        It takes the place of the table, which a worker need not hold as well.
        """
        words, self.words = self.words, None
        ids = words.column("ids").combine_chunks()
        ids = ids if isinstance(ids, pa.Array) else ids.chunk(0)
        sizes = np.append(ids.value_lengths().to_numpy(zero_copy_only=False), 0).astype(np.int64)
        flat = np.append(ids.flatten().to_numpy(zero_copy_only=False), 0).astype(np.int32)
        place = {}
        for part in words.column("word").chunks:
            for at in range(0, len(part), 10_000):
                for word in part.slice(at, 10_000).to_pylist():
                    place[word] = len(place)
        return place, np.cumsum(sizes) - sizes, sizes, flat


def some_rows(batch: pa.RecordBatch, sizes: pa.Array) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose sizes add up to some ``AT_ONCE``; no row is cut."""
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // AT_ONCE)) + 1
    for a, b in pairwise([0, *cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def filled(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def put_in(tokens: pa.ListArray, words: pa.ListArray) -> pa.ListArray:
    """``tokens`` with the ids of a row's k-th word in place of -1 - k."""
    held = tokens.flatten().to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))])
    at = np.flatnonzero(held < 0)
    first = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))])
    word = first[np.searchsorted(cuts, at, "right") - 1] - 1 - held[at]
    spelt = words.flatten()
    lengths_ = spelt.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths_) - lengths_
    n = np.ones(len(held), np.int64)
    n[at] = lengths_[word]
    ends = np.concatenate([[0], np.cumsum(n)])
    out = np.repeat(held, n)
    out[filled(ends[at], n[at])] = spelt.flatten().to_numpy(zero_copy_only=False)[filled(starts[word], n[at])]
    return pa.ListArray.from_arrays(pa.array(ends[cuts], pa.int32()), pa.array(out, pa.int32()))


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, most_words: int = MOST_WORDS, keep_text: bool = True,
    derive: Callable[[pa.ListArray], dict[str, pa.Array]] | None = None, **derived: str,
) -> DataFrame:
    """``docs`` with token_ids (array of int): every match of ``pattern`` in the whole text encoded by ``ranks``.

    There are no special tokens. A null or empty text has no tokens; an empty table gives no rows; rows are
    encoded one by one, so repeated rows and nulls in other columns stay as they are. An input column
    named token_ids is replaced. ``keep_text=False`` leaves the text out of the result. ``derive`` makes further
    columns, given by name and type, of the finished token_ids of a batch.
    """
    spark = ready(docs.sparkSession)
    docs = without(docs, *OUTPUT, *derived)
    make, of_byte = splitter(pattern), byte_ids(ranks)
    known = spark.sparkContext.broadcast(Known(known_words(spark, docs, make, ranks, most_words)))
    names = [c for c in docs.columns if keep_text or c != "text"]
    others = docs.select(*names)
    schema = schema_with(others, _tokens="array<int>", _rare="array<array<int>>")

    def look_up(batches):
        place, starts, sizes, flat = known.value.lookup
        get, words = place.get, make()
        for whole in batches:
            for batch in some_rows(whole, pc.binary_length(whole.column("text"))):
                found, cuts = [], [0]
                for text in batch.column("text").to_pylist():
                    if text:
                        found += words(text)
                    cuts.append(len(found))
                codes = np.fromiter(map(get, found, repeat(-1)), np.int64, len(found))
                unknown = np.flatnonzero(codes < 0)
                codes[unknown] = 0
                # The ids of a document's own words come later; one place holds such a word's number.
                begins, n = starts[codes], sizes[codes]
                n[unknown] = 1
                ends = np.concatenate([[0], np.cumsum(n)])
                tokens = flat[filled(begins, n)]
                rare, rare_cuts, own, row = [], [0], {}, 0
                rows = np.searchsorted(cuts, unknown, "right") - 1
                for i, r, at in zip(unknown.tolist(), rows.tolist(), ends[unknown].tolist()):
                    while row < r:
                        rare.extend(own)
                        rare_cuts.append(len(rare))
                        own, row = {}, row + 1
                    tokens[at] = -1 - own.setdefault(found[i], len(own))
                rare.extend(own)
                rare_cuts += [len(rare)] * (batch.num_rows - row)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c) for c in names],
                    pa.ListArray.from_arrays(pa.array(ends[cuts], pa.int32()), pa.array(tokens, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(rare_cuts, pa.int32()), spelled(rare, of_byte)),
                ], names=schema.names)

    def put_together(batches):
        for whole in batches:
            for batch in some_rows(whole, whole.column("_tokens").value_lengths()):
                ids = put_in(batch.column("_tokens"), batch.column("_ids"))
                more = derive(ids) if derive else {}
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in names], ids, *[more[c] for c in derived]], names=[*names, *OUTPUT, *derived]
                )

    split = docs.mapInArrow(look_up, schema)
    folded = split.select(*names, "_tokens", fold_words(F.col("_rare"), ranks).alias("_ids"))
    return folded.mapInArrow(put_together, schema_with(others, token_ids="array<int>", **derived))


DIGESTS = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def digests(ranks: dict[bytes, int]) -> Callable[[pa.ListArray], dict[str, pa.Array]]:
    """For ``encode``: number, digest of the decimal ids joined by commas, and digest of the decoded bytes of each row.

    Taking the pieces of a row's ids lays them one behind the other, which is the row decoded.
    """
    by_rank = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        by_rank[rank] = piece
    pieces = pa.array(by_rank, pa.binary())
    numbers = pa.array([b",%d" % i for i in range(len(by_rank))], pa.binary())

    def digest(texts: pa.Array, ids: pa.Array, skip: int) -> str:
        found = hashlib.sha256()
        for at in range(0, len(ids), TAKEN):
            part = texts.take(ids.slice(at, TAKEN))
            _, offsets, data = part.buffers()
            if data is not None:
                found.update(memoryview(data)[0 if at else skip : np.frombuffer(offsets, np.int32)[len(part)]])
        return found.hexdigest()

    def derive(rows: pa.ListArray) -> dict[str, pa.Array]:
        ids, cuts = rows.values, rows.offsets.to_pylist()
        each = [ids.slice(a, b - a) for a, b in pairwise(cuts)]
        return {
            "n_tokens": pa.array([len(x) for x in each], pa.int64()),
            "ids_sha256": pa.array([digest(numbers, x, 1) for x in each], pa.string()),
            "decoded_sha256": pa.array([digest(pieces, x, 0) for x in each], pa.string()),
        }

    return derive


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids: their binary pieces one after the other. An unknown id is left out, null stays null."""
    by_rank = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        by_rank[rank] = piece
    coded = json.dumps([base64.b64encode(p).decode() for p in by_rank])
    # As strings the pieces can be joined in one go; a cast changes no byte.
    pieces = F.from_json(F.lit(coded), "array<binary>").cast("array<string>")
    return _let(pieces, lambda p: F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")).cast("binary")
