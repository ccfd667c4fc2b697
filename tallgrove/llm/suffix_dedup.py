"""Exact removal of repeated byte strings: a radix sort of suffixes that ends at the threshold's depth.

A byte goes if a string of ``length`` bytes over it begins elsewhere too. Suffixes are ordered by
most-significant-digit passes of growing depth, and only suffixes whose group still has a partner go on;
at full depth equal groups are exactly the repeated strings. Two things keep the passes small:

* In a pass of depth d a suffix is grouped by the least of the d-byte strings in its window (all ties), at its
  offset. Equal windows agree on it, and one anchor stands for about (length - d) / 2 suffixes.
* In the first pass anchors whose whole surroundings repeat settle all windows they stand for. Such a
  window stays on as a witness, once for each content, while unsettled ones may equal it.

Only anchors (hashes and positions) and the bytes around unsettled places are shuffled, and each text once. Groups are
counted with map-side sums and joined back, so a passage that a third of all texts share is never one task's group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrove.llm.frames import ready, stored
from tallgrove.llm.windows import Anchors, Piece, byte_pieces, sliding, spread, whole_windows

LENGTH = 400
FIRST_DEPTH = 200
SECOND_DEPTH = 360
NO_ID = -(2**63)
OUTPUT = ("n_bytes", "n_removed", "n_spans", "kept")
ID = ["doc", "digest"]
PLACE = [*ID, "start"]


def runs_of(mask: np.ndarray) -> np.ndarray:
    """(start, end) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return edge.reshape(-1, 2)


def lists(batch: pa.RecordBatch, name: str, first: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Flattened values of a list column's rows, and the row of each."""
    part = batch.column(name).slice(first, rows)
    values = part.flatten().to_numpy(zero_copy_only=False)
    sizes = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return values, np.repeat(np.arange(rows), sizes)


def cut_out(data: bytes, removed: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, runs removed, what is left) for the sorted disjoint runs of removed bytes."""
    at, kept = 0, []
    for a, b in removed.tolist():
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return int((removed[:, 1] - removed[:, 0]).sum()), len(removed), b"".join(kept)


def covered(windows: np.ndarray, length: int, size: int) -> np.ndarray:
    """Runs of bytes under the windows whose starts are the (start, end) runs."""
    return runs_of(spread(windows[:, 0], np.minimum(windows[:, 1] - 1 + length, size), size)) if len(windows) else windows.reshape(-1, 2)


class Repeats:
    """The passes over one table's texts."""

    def __init__(self, texts: DataFrame, length: int, first: int, second: int) -> None:
        self.texts, self.length, self.first, self.second = texts, length, first, second

    def anchor_rows(self) -> DataFrame:
        length, depth = self.length, self.first

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for p in byte_pieces(batch.column("text")):
                    at = Anchors(p, length, depth, whole_windows(p, length)).at
                    row = np.searchsorted(p.bounds, at, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(n).take(pa.array(row + p.first)) for n in ID
                        ] + [
                            pa.array((at - p.bounds[row]).astype(np.int32)), pa.array(p.hash(at, depth).view(np.int64)),
                            pa.array(surroundings(p, at, row, length, depth).view(np.int64)),
                        ],
                        names=[*ID, "pos", "key", "around"],
                    )

        return self.texts.mapInArrow(run, "doc long, digest long, pos int, key long, around long")

    def first_pass(self) -> DataFrame:
        """(doc, digest, pos, full, witness): for each text the anchors whose string stands elsewhere too."""
        rows = stored(self.anchor_rows(), "anchors")
        again = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
        return marks(rows, again, ID)

    def judge(self, marked: DataFrame) -> DataFrame:
        """Per text: settled window runs, and the zones of windows that stay open or bear witness."""
        length, depth = self.length, self.first
        schema = (
            "doc long, digest long, n_bytes long, settled binary, open boolean, kept binary, n_removed long, n_spans long, "
            "zones array<struct<start:int,flags:binary,bytes:binary>>, text string"
        )
        zone = pa.struct([("start", pa.int32()), ("flags", pa.binary()), ("bytes", pa.binary())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text")
                for p in byte_pieces(texts):
                    valid = whole_windows(p, length)
                    chosen = Anchors(p, length, depth, valid)
                    lonely, settled, bears = verdict(batch, p, chosen)
                    settled &= valid & ~lonely
                    bears &= settled
                    still = valid & ~settled & ~lonely
                    yield Repeats.verdicts(batch, p, settled, still, bears, texts, zone, length)

        joined = self.texts.join(marked, ID, "left")
        return joined.mapInArrow(run, schema)

    @staticmethod
    def verdicts(batch, p: Piece, settled, still, bears, texts, zone, length) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(7)]
        flags = still.astype(np.uint8) + 2 * bears.astype(np.uint8)
        kept_texts = texts.slice(p.first, p.rows)
        is_open = []
        for i, (a, b) in enumerate(zip(p.bounds[:-1].tolist(), p.bounds[1:].tolist())):
            data, windows = p.data[a:b], runs_of(settled[a:b])
            open_ = bool(still[a:b].any())
            zones = [
                {"start": x, "flags": flags[a + x : a + y].tobytes(), "bytes": data[x : y - 1 + length]}
                for x, y in runs_of(flags[a:b] > 0).tolist()
            ]
            removed, spans, left = (None, None, None) if open_ else cut_out(data, covered(windows, length, len(data)))
            for column, value in zip(columns, (len(data), windows.astype(np.int64).tobytes(), open_, left, removed, spans, zones)):
                column.append(value)
            is_open.append(open_)
        kinds = (pa.int64(), pa.binary(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.list_(zone))
        arrays = [batch.column(n).slice(p.first, p.rows) for n in ID]
        arrays += [pa.array(c, k) for c, k in zip(columns, kinds)]
        text = pa.array([t if o else None for t, o in zip(kept_texts.to_pylist(), is_open, strict=True)], pa.string())
        names = [*ID, "n_bytes", "settled", "open", "kept", "n_removed", "n_spans", "zones", "text"]
        return pa.RecordBatch.from_arrays([*arrays, text], names=names)

    def later_passes(self, zones: DataFrame) -> DataFrame:
        """(doc, digest, starts): the open windows that repeat, as (start, end) runs in a flat list."""
        length, depth = self.length, self.second
        width = length - depth + 1

        def deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for p in byte_pieces(batch.column("bytes")):
                    flags = zone_flags(batch, p)
                    at = Anchors(p, length, depth, flags > 0).at
                    row = np.searchsorted(p.bounds, at, "right") - 1
                    near = sliding(np.concatenate([np.zeros(width - 1, np.uint8), flags & 1]), width, np.maximum)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(n).take(pa.array(row + p.first)) for n in PLACE]
                        + [
                            pa.array((at - p.bounds[row]).astype(np.int32)), pa.array(p.hash(at, depth).view(np.int64)),
                            pa.array(surroundings(p, at, row, length, depth).view(np.int64)),
                            pa.array(near[at].astype(bool)),
                        ],
                        names=[*PLACE, "pos", "key", "around", "near"],
                    )

        rows = stored(
            zones.mapInArrow(
                deeper, "doc long, digest long, start int, pos int, key long, around long, near boolean"
            ),
            "deeper-anchors",
        )
        again = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("near").alias("any")).filter("n > 1 and any")
        alive = marks(rows, again.select("key"), PLACE)

        def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for p in byte_pieces(batch.column("bytes")):
                    flags = zone_flags(batch, p)
                    chosen = Anchors(p, length, depth, flags > 0)
                    lonely, settled, bears = verdict(batch, p, chosen)
                    settled &= (flags > 0) & ~lonely
                    left = np.where((flags > 0) & ~lonely & (~settled | bears), flags & ~(settled.astype(np.uint8)) | 2, 0)
                    sure = settled & (flags & 1 == 1)
                    starts = batch.column("start").to_numpy()[p.first : p.first + p.rows].tolist()
                    bounds = p.bounds.tolist()
                    arrays = [batch.column(n).slice(p.first, p.rows) for n in PLACE]
                    runs = [(runs_of(sure[a:b]) + x).ravel() for a, b, x in zip(bounds, bounds[1:], starts)]
                    kept = [left[a:b] for a, b in zip(bounds, bounds[1:])]
                    arrays += [
                        pa.array(runs, pa.list_(pa.int32())),
                        pa.array([k.astype(np.uint8).tobytes() if k.any() else None for k in kept], pa.binary()),
                        pa.array([p.data[a:b] if k.any() else None for k, a, b in zip(kept, bounds, bounds[1:])], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*PLACE, "sure", "flags", "bytes"])

        decided = stored(
            zones.join(alive, PLACE).mapInArrow(
                decide, "doc long, digest long, start int, sure array<int>, flags binary, bytes binary"
            ),
            "decided-zones",
        )

        def deepest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for p in byte_pieces(batch.column("bytes")):
                    flags = zone_flags(batch, p)
                    begin = np.flatnonzero(flags)
                    row = np.searchsorted(p.bounds, begin, "right") - 1
                    data = p.data
                    codes = np.frombuffer(
                        b"".join(xxhash.xxh3_128_digest(data[a : a + length]) for a in begin.tolist()), np.int64
                    ).reshape(-1, 2)
                    starts = batch.column("start").to_numpy()[row + p.first] + begin - p.bounds[row]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(n).take(pa.array(row + p.first)) for n in ID]
                        + [
                            pa.array(starts.astype(np.int32)), pa.array(codes[:, 0].copy()), pa.array(codes[:, 1].copy()),
                            pa.array((flags[begin] & 1).astype(bool)),
                        ],
                        names=[*ID, "pos", "h1", "h2", "open"],
                    )

        last = stored(
            decided.filter("flags is not null").mapInArrow(
                deepest, "doc long, digest long, pos int, h1 long, h2 long, open boolean"
            ),
            "deepest",
        )
        twice = stored(
            last.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("any")).filter("n > 1 and any").select(
                "h1", "h2"
            ),
            "deepest-repeated",
        )
        single = last.filter("open").join(twice, ["h1", "h2"]).select(*ID, F.array("pos", F.col("pos") + 1).alias("runs"))
        runs = decided.filter(F.size("sure") > 0).select(*ID, F.col("sure").alias("runs"))
        return runs.unionByName(single).groupBy(*ID).agg(F.flatten(F.collect_list("runs")).alias("starts"))


def marks(rows: DataFrame, again: DataFrame, by: list[str]) -> DataFrame:
    """(*by, pos, full, witness lists): of each text or zone the anchors whose string stands elsewhere too.

    ``again`` are the keys to go on with. Full anchors repeat with all their surroundings; of each such class one
    bears witness if its key also has anchors that do not.
    """
    rows = stored(rows.join(stored(again, "repeated-keys"), "key"), "repeated-anchors")
    name = F.struct(*by, "pos")
    classes = stored(
        rows.groupBy("key", "around").agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("one")), "anchor-classes"
    )
    # stored, so that no sum stands between shuffle and join, and Spark may split a key of very many classes
    mixed = stored(classes.filter("n = 1").select("key").distinct(), "mixed-keys").withColumn("mixed", F.lit(True))
    full = stored(classes.filter("n > 1").join(mixed, "key", "left"), "full-classes")
    judged = rows.join(full, ["key", "around"], "left").select(
        *by, "pos", F.col("n").isNotNull().alias("full"), (F.coalesce("mixed", F.lit(False)) & (F.col("one") == name)).alias("witness")
    )
    return judged.groupBy(*by).agg(
        F.collect_list("pos").alias("pos"), F.collect_list("full").alias("full"), F.collect_list("witness").alias("witness")
    )


def surroundings(p: Piece, at: np.ndarray, row: np.ndarray, length: int, depth: int) -> np.ndarray:
    """Hash of all bytes that windows around each anchor can hold, and of where the anchor stands in them."""
    begin = np.maximum(p.bounds[row], at - (length - depth))
    end = np.minimum(p.bounds[row + 1], at + length)
    data = p.data
    codes = np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(begin.tolist(), end.tolist())], np.uint64)
    return codes * np.uint64(1024) + (at - begin).astype(np.uint64)


def verdict(batch: pa.RecordBatch, p: Piece, chosen: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the window at each byte: whether its own anchor stands alone, is full, bears witness."""
    where, row = lists(batch, "pos", p.first, p.rows)
    full, _ = lists(batch, "full", p.first, p.rows)
    witness, _ = lists(batch, "witness", p.first, p.rows)
    where = where.astype(np.int64) + p.bounds[row]
    return (
        chosen.windows_of(np.setdiff1d(chosen.at, where)),
        chosen.windows_of(where[full.astype(bool)]),
        chosen.windows_of(where[witness.astype(bool)]),
    )


def zone_flags(batch: pa.RecordBatch, p: Piece) -> np.ndarray:
    """Flag of the window at each byte of the zones' bytes; 0 where none begins."""
    flags = np.zeros(len(p.data), np.uint8)
    for i, held in enumerate(batch.column("flags").slice(p.first, p.rows).to_pylist()):
        flags[p.bounds[i] : p.bounds[i] + len(held)] = np.frombuffer(held, np.uint8)
    return flags


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, first_depth: int = FIRST_DEPTH, second_depth: int = SECOND_DEPTH
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes left) of every row.

    Texts are UTF-8 bytes, null is empty; a text shorter than ``length`` loses nothing. Rows that repeat id and text are
    two texts that lose all they repeat. A null id is carried. An empty table gives no rows.
    """
    ready(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("digest"), text.alias("text")
    )
    passes = Repeats(texts, length, first_depth, second_depth)
    judged = stored(passes.judge(passes.first_pass()), "judged-texts")
    zones = judged.select(*ID, F.explode("zones").alias("zone")).select(*ID, "zone.*").distinct()
    found = passes.later_passes(zones)
    rest = judged.filter("open").select(*ID, "n_bytes", "settled", "text").join(found, ID, "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], []]
            for settled, text, starts in zip(*(batch.column(n).to_pylist() for n in ("settled", "text", "starts"))):
                data = text.encode()
                windows = np.concatenate([np.frombuffer(settled, np.int64), np.array(starts or [], np.int64)]).reshape(-1, 2)
                for column, value in zip(columns, cut_out(data, covered(windows, length, len(data)))):
                    column.append(value)
            arrays = [batch.column("doc"), batch.column("n_bytes")]
            arrays += [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", *OUTPUT])

    finished = rest.mapInArrow(finish, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    done = judged.filter("not open").select("doc", *OUTPUT)
    return done.unionByName(finished).select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), *OUTPUT)
