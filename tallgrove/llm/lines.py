"""Reversible line deduplication: sharded cuckoo filters before exact reference tables.

The exact side is two logs, a table per change: postings (line key, document, +1 or -1), and the change of each key's
reference count, the number of documents that hold it, with the largest document added. The filters hold the
keys whose count has reached the threshold, dealt into shards by hash: insertions of documents add keys to them, deletions
take keys out again. A lookup probes the filters first; only the hits meet the logged counts, where a filter's false
positives fall out, and only the keys found repeated meet the postings. Where a deletion may have taken a key's
largest document, that is looked up in the key's postings.

Keys are 128-bit hashes and evenly dealt; a line that a third of all documents hold is one key
in the filters, and in the joins with postings its rows are the side that can be split.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrove.llm.frames import ascii_lower, ready, schema_with, stored, without

MIN_CHARS = 20
MIN_DOCS = 3
#: Least number of shards, and distinct keys that a shard is made for; shards double as the keys grow.
SHARDS = 64
SHARD_KEYS = 250_000
#: White space stripped from both ends of a line: [\x20\x09-\x0D].
BLANK = " \t\n\x0b\x0c\r"
NO_ID = -(2**63)
OUTPUT = ("n_lines", "n_dropped", "kept_text")


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a full table gets another behind it."""

    SLOTS = 4
    KICKS = 200
    FIRST_BUCKETS = 1 << 8

    def __init__(self, tables: list[np.ndarray] | None = None) -> None:
        self.tables = tables or []

    @classmethod
    def of_bytes(cls, parts: list[bytes]) -> CuckooFilter:
        return cls([np.frombuffer(p, np.uint16).reshape(-1, cls.SLOTS).copy() for p in parts])

    def to_bytes(self) -> list[bytes]:
        return [t.tobytes() for t in self.tables]

    @staticmethod
    def fingerprints(keys: np.ndarray) -> np.ndarray:
        """Never 0, which marks an empty slot."""
        return (keys.astype(np.uint64) >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)

    @staticmethod
    def buckets(keys: np.ndarray, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(size - 1)
        first = (keys.astype(np.uint64) >> np.uint64(8)) & mask
        return first.astype(np.int64), ((first ^ (prints * np.uint64(0x5BD1E995))) & mask).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found, prints = np.zeros(len(keys), bool), self.fingerprints(keys)
        for table in self.tables:
            a, b = self.buckets(keys, prints, len(table))
            found |= ((table[a] == prints[:, None]) | (table[b] == prints[:, None])).any(1)
        return found

    def add(self, keys: np.ndarray) -> None:
        prints = self.fingerprints(keys)
        for i in range(len(keys)):
            self._add_one(keys[i : i + 1], prints[i : i + 1])

    def _add_one(self, key: np.ndarray, print_: np.ndarray) -> None:
        if not self.tables:
            self.tables.append(np.zeros((self.FIRST_BUCKETS, self.SLOTS), np.uint16))
        table = self.tables[-1]
        a, b = (int(x[0]) for x in self.buckets(key, print_, len(table)))
        value, mask = int(print_[0]), len(table) - 1
        path: list[tuple[int, int]] = []
        at = a if (table[a] == 0).any() else b
        for kick in range(self.KICKS):
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = value
                return
            slot = kick % self.SLOTS
            value, table[at, slot] = int(table[at, slot]), value
            path.append((at, slot))
            at = (at ^ (value * 0x5BD1E995)) & mask
        for at, slot in reversed(path):  # undo, and go on in a table of twice the size
            value, table[at, slot] = int(table[at, slot]), value
        self.tables.append(np.zeros((2 * len(table), self.SLOTS), np.uint16))
        self._add_one(key, print_)

    def remove(self, keys: np.ndarray) -> None:
        """Take out one fingerprint of each key; the keys must have been added."""
        prints = self.fingerprints(keys)
        for i in range(len(keys)):
            for table in reversed(self.tables):
                places = self.buckets(keys[i : i + 1], prints[i : i + 1], len(table))
                at = next(((int(p[0]), s) for p in places for s in np.flatnonzero(table[p[0]] == prints[i])), None)
                if at:
                    table[at] = 0
                    break


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def postings_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """Distinct (hi, lo, doc) of the lines long enough to count; a null id is the least."""
    keys = F.filter(F.transform(split_lines(F.col("text")), line_key), lambda k: F.length(k) >= min_chars)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.explode(F.array_distinct(keys)).alias("key")
    )
    return rows.select(
        F.xxhash64("key").alias("hi"), F.xxhash64(F.lit(1), "key").alias("lo"), "doc"
    ).distinct()


class LineIndex:
    """Line keys of the documents inserted so far; every change gives a new index and keeps the old one valid."""

    def __init__(
        self,
        spark: SparkSession,
        min_docs: int = MIN_DOCS,
        min_chars: int = MIN_CHARS,
        shards: int = SHARDS,
        log: tuple[DataFrame, ...] = (),
        counted: tuple[DataFrame, ...] = (),
        filters: DataFrame | None = None,
        shard_keys: int = SHARD_KEYS,
    ) -> None:
        self.spark, self.min_docs, self.min_chars, self.shards = ready(spark), min_docs, min_chars, shards
        self.log, self.counted, self.filters, self.shard_keys = log, counted, filters, shard_keys

    def _changed(self, postings: DataFrame, counts: DataFrame, shards: int) -> LineIndex:
        """With a further change in the logs, before the filters follow."""
        logs = (*self.log, postings), (*self.counted, counts)
        same = self.filters if shards == self.shards else None
        return LineIndex(self.spark, self.min_docs, self.min_chars, shards, *logs, same, self.shard_keys)

    def _with_filters(self, filters: DataFrame) -> LineIndex:
        return LineIndex(
            self.spark, self.min_docs, self.min_chars, self.shards, self.log, self.counted, filters, self.shard_keys
        )

    def postings(self, keys: DataFrame | None = None) -> DataFrame:
        """Distinct (hi, lo, doc) that hold now, of the distinct keys asked for."""
        rows = reduce(DataFrame.unionByName, self.log)
        if keys is not None:
            rows = rows.join(keys.select("hi", "lo"), ["hi", "lo"])
        if len(self.log) == 1:
            return rows.filter("sign > 0").select("hi", "lo", "doc")
        return rows.groupBy("hi", "lo", "doc").agg(F.sum("sign").alias("n")).filter("n > 0").drop("n")

    def counts(self, keys: DataFrame | None = None) -> DataFrame:
        """(hi, lo, n, last) of the distinct keys asked for: reference count and largest document."""
        rows = reduce(DataFrame.unionByName, self.counted)
        if keys is not None:
            rows = rows.join(keys.select("hi", "lo"), ["hi", "lo"])
        if len(self.counted) == 1:
            return rows
        totals = rows.groupBy("hi", "lo").agg(
            F.sum("n").alias("n"), F.max("last").alias("last"), F.max((F.col("n") < 0)).alias("shrunk")
        ).filter("n > 0")
        shrunk = self.postings(totals.filter("shrunk")).groupBy("hi", "lo").agg(F.max("doc").alias("held"))
        exact = F.when(F.col("shrunk"), F.col("held")).otherwise(F.col("last"))
        return totals.join(shrunk, ["hi", "lo"], "left").select("hi", "lo", "n", exact.alias("last"))

    def _crossed(self, change: DataFrame) -> DataFrame:
        """The keys of a change (hi, lo, n) whose count it takes over the threshold, up or down."""
        before = F.lit(0)
        if self.counted:
            rows = reduce(DataFrame.unionByName, self.counted).join(change.select("hi", "lo"), ["hi", "lo"])
            sums = rows.groupBy("hi", "lo").agg(F.sum("n").alias("before"))
            change = change.join(sums, ["hi", "lo"], "left")
            before = F.coalesce("before", F.lit(0))
        least = F.lit(self.min_docs)
        return change.filter((before >= least) != (before + F.col("n") >= least)).select("hi", "lo")

    def _shard(self) -> Column:
        return F.pmod("lo", F.lit(self.shards)).cast("int").alias("shard")

    def _with_keys(self, added: DataFrame | None, removed: DataFrame | None) -> DataFrame:
        """Filters after keys have come and gone; each shard is one group, and keys are evenly dealt."""
        parts = [df.select(self._shard(), "hi", F.lit(up).alias("up")) for df, up in ((added, True), (removed, False)) if df is not None]
        changes = reduce(DataFrame.unionByName, parts)
        schema = "shard int, tables array<binary>"

        def change(key, now: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            cuckoo = CuckooFilter.of_bytes(list(now["tables"].iloc[0]) if len(now) else [])
            cuckoo.remove(rows["hi"][~rows["up"]].to_numpy())
            cuckoo.add(rows["hi"][rows["up"]].to_numpy())
            return pd.DataFrame({"shard": [key[0]], "tables": [cuckoo.to_bytes()]})

        now = self.filters if self.filters is not None else self.spark.createDataFrame([], schema)
        made = now.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, schema)
        return stored(made, "line-filters")

    def _wanted_shards(self, new: int) -> int:
        """Enough for all keys, held and new; those of several changes count more than once."""
        keys, shards = new + sum(df.count() for df in self.counted), self.shards
        while shards * self.shard_keys < keys:
            shards *= 2
        return shards

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add documents; those of an id that is held already add only the lines that are new to it."""
        batch = postings_of(docs, self.min_chars)
        if self.log:
            batch = batch.join(self.postings(), ["hi", "lo", "doc"], "left_anti")
        batch = stored(batch.withColumn("sign", F.lit(1)), "line-postings")
        sums = batch.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("last"))
        new = stored(sums, "line-counts")
        after = self._changed(batch, new, self._wanted_shards(new.count()))
        if self.filters is not None and after.filters is None:  # more shards: deal all keys anew
            held = after.counts().filter(F.col("n") >= self.min_docs)
            return after._with_filters(after._with_keys(held, None))
        return after._with_filters(after._with_keys(self._crossed(new), None))

    def delete(self, ids: DataFrame) -> LineIndex:
        """Take out whole documents by ``doc_id``; ids that are not held change nothing."""
        gone = ids.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")).distinct()
        if not self.log:
            return self
        batch = stored(
            self.postings().join(gone, "doc", "left_semi").select("hi", "lo", "doc", F.lit(-1).alias("sign")), "line-postings"
        )
        sums = batch.groupBy("hi", "lo").agg((-F.count(F.lit(1))).alias("n"), F.lit(None).cast("long").alias("last"))
        lost = stored(sums, "line-counts")
        after = self._changed(batch, lost, self.shards)
        return after._with_filters(after._with_keys(None, self._crossed(lost)))

    def maybe_repeated(self, keys: DataFrame) -> DataFrame:
        """Those of the distinct (hi, lo) that the filters have; a superset of the repeated ones."""

        def probe(key, now: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(now):
                return rows.iloc[:0][["hi", "lo"]]
            return rows.loc[CuckooFilter.of_bytes(list(now["tables"].iloc[0])).has(rows["hi"].to_numpy()), ["hi", "lo"]]

        dealt = keys.select("hi", "lo", self._shard())
        return self.filters.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(probe, "hi long, lo long")

    def repeated(self, keys: DataFrame) -> DataFrame:
        """Exact (hi, lo, n, last) of those distinct keys that at least ``min_docs`` documents hold."""
        return self.counts(self.maybe_repeated(keys)).filter(F.col("n") >= self.min_docs)


def drop_repeated(docs: DataFrame, index: LineIndex, inserted: bool = False) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text, judged by an index that holds them.

    A repeated line goes from every document but the one with the largest id. A null or empty
    text is one empty line. Rows with one id are one document; a null id is below all others.
    An empty table gives no rows. Input columns named like an output column are replaced.
    """
    base = without(docs, *OUTPUT)
    if inserted and len(index.log) == 1:  # the documents are the one insertion, whose keys are counted already
        held, keys = index.postings(), index.counted[0]
    else:
        held = postings_of(base, index.min_chars)
        keys = held.select("hi", "lo").distinct()
    over = stored(index.repeated(keys), "line-repeated").select("hi", "lo", "last")
    lost = held.join(over, ["hi", "lo"]).filter("doc < last").groupBy("doc").agg(F.collect_list("lo").alias("_lost"))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    joined = base.join(lost.withColumnRenamed("doc", "_doc"), doc == F.col("_doc"), "left").drop("_doc")
    coded = joined.withColumn(
        "_codes", F.when(
            F.col("_lost").isNotNull(), F.transform(split_lines(F.col("text")), lambda x: F.xxhash64(F.lit(1), line_key(x)))
        ),
    )
    names = base.columns
    schema = schema_with(base, n_lines="long", n_dropped="long", kept_text="string")
    out = schema.names

    def cut(batches):
        for batch in batches:
            total, gone, kept = [], [], []
            lost, codes = batch.column("_lost"), batch.column("_codes")
            for i, text in enumerate(batch.column("text").to_pylist()):
                text = text or ""
                if not lost[i].is_valid:
                    total.append(text.count("\n") + 1)
                    gone.append(0)
                    kept.append(text)
                    continue
                parts = text.split("\n")
                drop = np.isin(codes[i].values.to_numpy(), lost[i].values.to_numpy())
                total.append(len(parts))
                gone.append(int(drop.sum()))
                kept.append("\n".join(p for p, d in zip(parts, drop.tolist(), strict=True) if not d))
            columns = [batch.column(n) for n in names]
            columns += [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=out)

    return coded.mapInArrow(cut, schema)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shards: int = SHARDS) -> DataFrame:
    """Insert all documents into an empty index and drop what it finds repeated."""
    index = LineIndex(docs.sparkSession, min_docs, min_chars, shards).insert(docs)
    return drop_repeated(docs, index, inserted=True)
