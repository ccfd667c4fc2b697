"""Ranked lexical search: the best documents for every item of a query set, by presence masks.

1. Texts are scanned once per block of items (one block unless the items are larger than ``ITEM_BYTES``): a
   document's number of terms and its counts of the items' terms become a narrow stored table.
2. Document frequencies, the number of documents and of all terms are sums over that table.
3. A map over it takes documents in blocks of ``BLOCK`` rows. Every term has a bitmap of the block's documents; for
   an item the bitmaps of its terms are turned into one mask per document, and equal masks are grouped. A mask's score is
   bounded by its terms' weights times the largest contribution each has in the block. Masks are scored by falling bound
   until the next bound is below the item's last place, which is kept from block to block.
4. Each task gives out its best documents per item, which are ranked by item.

No pair of an item and a document leaves a task unless it is among that task's best for the item.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallgrove.llm.decontamination import item_groups
from tallgrove.llm.frames import ready, stored

TOP = 10
BLOCK = 1024
ITEM_BYTES = 1 << 20
#: Masks scored at a time; the bound is looked at between two such groups.
STEP = 64
SCALE = 1_000_000_000
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
OUTPUT = ("item_id", "rank", "doc_id", "score")


def terms(text: str | None) -> list[bytes]:
    """Runs of digits, ASCII letters and all beyond ASCII, A-Z lower-cased."""
    return TERM.findall(text.encode().translate(LOWER)) if text else []


class Items:
    """A block of items: the vocabulary and each item's distinct terms with their repeats."""

    def __init__(self, texts: list[str | None]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.repeats: list[np.ndarray] = []
        for text in texts:
            counts = Counter(terms(text))
            numbers = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in counts]
            self.terms.append(np.array(numbers, np.int64))
            self.repeats.append(np.fromiter(counts.values(), np.int64, len(counts)))


def postings(docs: DataFrame, known) -> DataFrame:
    """(doc_id, n, terms, counts): the number of terms, and which terms of the items occur how often (int32 arrays as bytes)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.vocabulary.get
        for batch in batches:
            n, which, counts = [], [], []
            for text in batch.column("text").to_pylist():
                found = Counter(map(number, terms(text)))
                n.append(found.total())
                found.pop(None, None)
                which.append(np.fromiter(found, np.int32, len(found)).tobytes())
                counts.append(np.fromiter(found.values(), np.int32, len(found)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(which, pa.binary()), pa.array(counts, pa.binary())],
                names=["doc_id", "n", "terms", "counts"],
            )

    df = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, "doc_id long, n long, terms binary, counts binary")
    return df.filter("n > 0")


def weights(found: DataFrame, size: int, documents: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of every term; document frequencies are added up map-side."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            data = b"".join(batch.column("terms").to_pylist())
            total += np.bincount(np.frombuffer(data, np.int32), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["term", "df"])

    df = found.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    known = dict(df.collect())  # one row a term of the items' block
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * known.get(t, 0) + 1))) for t in range(size)], np.int64)


class Best:
    """The best documents of one item so far: score falling, then id rising, null ids last."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    @property
    def least(self) -> int:
        """Only scores of at least this can still enter."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        enters = score >= self.least
        if not enters.any():
            return
        score, doc, null = (np.concatenate([a, b[enters]]) for a, b in ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[: self.top]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def masks_of(bitmaps: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct masks of the rows that hold a term (bits, one row a mask), the rows sorted by mask, and where each mask's rows begin."""
    held = np.unpackbits(np.bitwise_or.reduce(bitmaps, axis=0), count=rows).nonzero()[0]
    bits = np.unpackbits(bitmaps, axis=1, count=rows)[:, held].T
    if not len(held):
        return bits, held, np.zeros(1, np.int64)
    packed = np.ascontiguousarray(np.packbits(bits, axis=1))
    _, first, number = np.unique(packed.view(f"V{packed.shape[1]}").ravel(), return_index=True, return_inverse=True)
    order = np.argsort(number, kind="stable")
    starts = np.r_[0, np.cumsum(np.bincount(number))]
    return bits[first], held[order], starts


def search_block(items: Items, weight: np.ndarray, m: np.ndarray, which: list[bytes], counts: list[bytes], doc: np.ndarray, null: np.ndarray, best: list[Best]) -> None:
    """Score one block of documents against all items."""
    rows = len(m)
    term = np.frombuffer(b"".join(which), np.int32)
    tf = np.frombuffer(b"".join(counts), np.int32).astype(np.int64)
    row = np.repeat(np.arange(rows), [len(w) // 4 for w in which])
    # Terms of the block are numbered anew, so the matrix is as wide as the block needs.
    here, column = np.unique(term, return_inverse=True)
    part = SCALE * tf // (1000 * tf + 8 * m[row])
    worth = np.zeros((rows, len(here)), np.int64)
    worth[row, column] = part
    most = worth.max(axis=0, initial=0)
    present = np.zeros((len(here), rows), bool)
    present[column, row] = True
    bitmaps = np.packbits(present, axis=1)
    place = np.full(len(weight), -1)
    place[here] = np.arange(len(here))
    for k, best_of in enumerate(best):
        columns = place[items.terms[k]]
        mine = columns >= 0
        columns = columns[mine]
        factor = (items.repeats[k] * weight[items.terms[k]])[mine]
        # A term that all documents hold may weigh nothing; it divides no mask.
        columns, factor = columns[factor > 0], factor[factor > 0]
        if not len(columns) or int(most[columns] @ factor) < best_of.least:
            continue
        bits, order, starts = masks_of(bitmaps[columns], rows)
        bound = bits.astype(np.int64) @ (factor * most[columns])
        by_bound = np.argsort(-bound, kind="stable")
        for at in range(0, len(by_bound), STEP):
            some = by_bound[at : at + STEP]
            some = some[bound[some] >= best_of.least]
            if not len(some):
                break
            chosen = np.concatenate([order[starts[i] : starts[i + 1]] for i in some])
            best_of.add(worth[np.ix_(chosen, columns)] @ factor, doc[chosen], null[chosen])


def candidates(found: DataFrame, known, weight: np.ndarray, documents: int, length: int, top: int) -> DataFrame:
    """(item, doc_id, score): the best ``top`` documents of each task for every item."""
    weighed = found.sparkSession.sparkContext.broadcast(weight)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = known.value, weighed.value
        best = [Best(top) for _ in items.terms]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                n = block.column("n").to_numpy(zero_copy_only=False)
                m = np.array([25 + 75 * int(x) * documents // length for x in n], np.int64)
                ids = block.column("doc_id")
                search_block(
                    items, weight, m, block.column("terms").to_pylist(), block.column("counts").to_pylist(),
                    ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), best,
                )
        for k, b in enumerate(best):
            if len(b.score):
                yield pa.RecordBatch.from_arrays([
                    pa.array([k] * len(b.score), pa.int32()), pa.array(b.doc, pa.int64(), mask=b.null), pa.array(b.score, pa.int64()),
                ], names=["item", "doc_id", "score"])

    return found.select("doc_id", "n", "terms", "counts").mapInArrow(search, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with score above 0; equal scores by rising doc_id.

    A null or empty text has no terms: such a document is never found and such an item finds nothing. Every row of ``items``
    is an item of its own, also if ids repeat or are null; every row of ``docs`` is a document of its own, null ids come after
    equal scores with ids. Empty tables give no rows. Other columns are not read, whatever their names.
    """
    spark = ready(docs.sparkSession)
    results = [_search_group(spark, docs, items, rows, top) for rows in item_groups(items, item_bytes)]
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _search_group(spark: SparkSession, docs: DataFrame, items: DataFrame, rows: list, top: int) -> DataFrame:
    block = Items([r["text"] for r in rows])
    known = spark.sparkContext.broadcast(block)
    found = stored(postings(docs, known), "postings")
    documents, length = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    names = pa.table({
        "item": pa.array(range(len(rows)), pa.int32()), "item_id": pa.array([r["item_id"] for r in rows]),
    })
    names = spark.createDataFrame(names, f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
    if not documents:
        return names.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    weight = weights(found, len(block.vocabulary), documents)
    each = candidates(found, known, weight, documents, length, top)
    # The window's limit is pushed below its shuffle, so tasks send their best only once more.
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
