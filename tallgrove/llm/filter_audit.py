"""What every order of a set of filters keeps, removes and wastes, by wide packed counters.

A document fails some of the filters: a mask. What happens to it at every step of every order
follows from its mask and its labels, so each (mask, labels) has one big integer whose 64-bit fields hold all
the outcomes at once: kept, removed, redundant, unique_fails, good_lost and toxic_lost for each of the
``orders x steps``, and a field for the document itself. Integers of a part are summed; a field is never larger
than the number of documents, which is below 2**63, so no field runs into the next and the sum is unpacked as it is.

Plan: the texts are scanned once, into a narrow table of ids, parts, masks and digests. The least id per digest
is found with map-side minima and joined on (id, digest), so that copies of one text never meet in a task. Tasks add
integers up per part, salted sums of sums follow, and one row per part is unpacked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrove.llm.frames import UPPER, ready, stored

FIELD_BYTES = 8
#: Sums a task holds at once; beyond that it gives out what it has and goes on.
PARTS_HELD = 500
SALTS = 64
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
OUTPUT = ("part", "filter_order", "step", *MEASURES, "shapley")


def text_filters() -> dict[str, Column]:
    """Failure conditions on ``text`` alone: too short, repetitive, shouting, odd signs."""
    text = F.coalesce("text", F.lit(""))
    # White space is 0x09-0x0D and the space; splitting at one character needs no regular expression.
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), "")
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": upper * 100 > F.length(text) * 10,
        "D": F.length(F.translate(text, "#$%&*|", "")) < F.length(text),
    }


class Counters:
    """The packed integers of all masks for one set of filters, and how to read their sums.

    Bit i of a mask is the i-th filter of ``names``. Bit 0 of ``label`` is good, bit 1 toxic.
    """

    def __init__(self, names: str) -> None:
        self.names = names
        self.orders = ["".join(p) for p in permutations(names)]
        self.steps = len(names)
        self.fields = len(self.orders) * self.steps * len(MEASURES) + 1
        self.packed = [self._pack(mask, label) for mask in range(1 << self.steps) for label in range(4)]

    def _pack(self, mask: int, label: int) -> int:
        fields = np.zeros(self.fields, "<u8")
        at = 0
        for order in self.orders:
            gone = False
            for name in order:
                fails = bool(mask >> self.names.index(name) & 1)
                removed = fails and not gone
                redundant = fails and gone
                gone = gone or fails
                fields[at : at + 6] = (
                    not gone, removed, redundant, fails and mask.bit_count() == 1,
                    removed and label & 1, removed and label >> 1,
                )
                at += 6
        fields[at] = 1
        return int.from_bytes(fields.tobytes(), "little")

    def unpack(self, total: int) -> tuple[np.ndarray, int]:
        """(orders, steps, measures) and the number of documents."""
        fields = np.frombuffer(total.to_bytes(self.fields * FIELD_BYTES, "little"), "<i8")
        return fields[:-1].reshape(len(self.orders), self.steps, len(MEASURES)), int(fields[-1])

    def rows(self, part: str, total: int) -> dict[str, list]:
        counts, _ = self.unpack(total)
        removed = dict.fromkeys(self.names, 0)
        for order, steps in zip(self.orders, counts):
            for name, step in zip(order, steps):
                removed[name] += int(step[1])
        flat = counts.reshape(-1, len(MEASURES))
        letters = [name for order in self.orders for name in order]
        return {
            "part": [part] * len(flat),
            "filter_order": [order for order in self.orders for _ in order],
            "step": [k + 1 for _ in self.orders for k in range(self.steps)],
            **{m: flat[:, i] for i, m in enumerate(MEASURES)},
            "shapley": [removed[name] for name in letters],
        }


def failing(docs: DataFrame, part: str, filters: dict[str, Column]) -> DataFrame:
    """(doc_id, part, mask, digest): the filters on texts that every document fails, and its text's digest."""
    mask = F.lit(0)
    for i, fails in enumerate(filters.values()):
        mask = mask + F.when(fails, 1 << i).otherwise(0)
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    return docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.alias("mask"), digest.alias("digest"))


def with_copies(found: DataFrame, bit: int) -> DataFrame:
    """Set ``bit`` where a smaller id has the same text; a null id is neither smaller nor larger than another."""
    first = found.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL")
    # Joined on the id too: a text that a third of all documents share has one partner here.
    joined = found.join(first.withColumn("_first", F.lit(True)), ["doc_id", "digest"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    return joined.withColumn("mask", F.col("mask") + F.when(copy, 1 << bit).otherwise(0)).drop("_first", "digest")


def with_labels(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds label: 1 if some label row of the id has quality 1, and 2 if some has toxic 1."""
    flags = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, 2).otherwise(0))).alias("label")
    )
    return found.join(flags, "doc_id", "left").withColumn("label", F.coalesce("label", F.lit(0)))


def sums(counters: Counters) -> Callable:
    """A map that adds integers up per part: rows of (part, mask, label) to rows of (part, total, salt)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        rows = 0
        for batch in batches:
            codes = (pa.compute.add(pa.compute.multiply(batch.column("mask"), 4), batch.column("label"))).to_pylist()
            for part, code in zip(batch.column("part").to_pylist(), codes):
                held[part] = held.get(part, 0) + counters.packed[code]
            rows += len(codes)
            if len(held) > PARTS_HELD:
                yield from packed_rows(held, counters, rows)
                held = {}
        yield from packed_rows(held, counters, rows)

    return step


def packed_rows(held: dict[str, int], counters: Counters, salt: int) -> Iterator[pa.RecordBatch]:
    names, size = list(held), counters.fields * FIELD_BYTES
    for at in range(0, len(names), 100):
        part = names[at : at + 100]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.string()),
            "total": pa.array([held[p].to_bytes(size, "little") for p in part], pa.binary()),
            "salt": pa.array([salt % SALTS] * len(part), pa.int32()),
        })


def merged(counters: Counters) -> Callable:
    """A map over rows sorted by part: one sum per run of equal parts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for part, total in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist()):
                if part not in held and len(held) > PARTS_HELD:
                    yield from packed_rows(held, counters, 0)
                    held = {}
                held[part] = held.get(part, 0) + int.from_bytes(total, "little")
        yield from packed_rows(held, counters, 0)

    return step


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", filters: dict[str, Column] | None = None, copies: str = "E") -> DataFrame:
    """One row per part, order of all filters and step: (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    ``filters`` are failure conditions by letter, by default ``text_filters()``; the last filter, ``copies``, fails
    what has the text of a smaller doc_id. A null or empty text is the text without a character; a null part
    is ''; rows with a null id are counted and are no copies; each of several rows with one id counts, and none
    is a copy of another. Labels of an id are taken together; null labels count as 0, and a null id has no labels. An empty table of documents gives no rows,
    an empty one of labels no losses. Other columns are not read, whatever their names.
    """
    ready(docs.sparkSession)
    filters = text_filters() if filters is None else filters
    if len(filters) > 5:
        raise ValueError("more than six filters: the orders grow as their factorial")
    counters = Counters("".join(filters) + copies)
    assert len(counters.orders) == factorial(counters.steps)
    found = stored(failing(docs, part, filters), "masks")
    judged = with_labels(with_copies(found, len(filters)), labels).select("part", "mask", "label")
    kind = "part string, total binary, salt int"
    partial = judged.mapInArrow(sums(counters), kind)
    # Two steps: at most SALTS sums of a part reach the last one.
    for keys in (["part", "salt"], ["part"]):
        partial = partial.repartition(*keys).sortWithinPartitions(*keys[:1]).mapInArrow(merged(counters), kind)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, total in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist()):
                yield pa.RecordBatch.from_pydict(counters.rows(name, int.from_bytes(total, "little")), schema=ARROW)

    return partial.mapInArrow(unpack, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in OUTPUT[3:]))


ARROW = pa.schema([
    ("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(c, pa.int64()) for c in OUTPUT[3:]],
])
