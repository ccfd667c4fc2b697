"""MinHash near-deduplication by an LSH forest: sorted signature orders, and exact checks of whole shingle sets.

1. Every text becomes its set of 5-word shingles (64-bit hashes) and, for each tree, a
   label of ``DEPTH`` minima. Equal sets fall together first; one representative goes on.
2. All labels are sorted by (tree, label) over range partitions. In one pass over the order the run
   of neighbours that share the first ``least_depth`` minima with the one before is tied to
   the run's first document, however long the run. Runs that overlap over the trees form regions;
   two texts above the threshold are in one region but for a chance of
   (1 - s**least_depth)**trees. The trees follow the threshold (12 at 0.85, 17 at 0.8), so the chance is at most ``MISSED``.
3. The depth of a prefix is fixed, since a deeper one would lose pairs: the minima beyond ``least_depth`` only order
   the rows of a run. Of a region too large for one task the text of least id is the pivot. Texts that match
   the pivot are settled; blocks compare all others with the whole region.
4. In a region whole sets are compared by sparse intersection counts; only ties of a spanning forest leave a
   task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrove.llm.components import components
from tallgrove.llm.frames import ready, stored, without
from tallgrove.llm.words import SPACED, Words, grams, mix, words

SHINGLE = 5
DEPTH = 8
LEAST_DEPTH = 4
#: Bound of the chance that no tree brings a pair at the threshold together.
MISSED = 0.00015
#: Texts of a region that one task compares; larger regions are cut into blocks of so many.
BLOCK = 256
NO_ID = -(2**63)
OUTPUT = ("n_shingles", "component_id", "kept")


def trees_for(percent: int, least_depth: int = LEAST_DEPTH) -> int:
    """Trees after which a pair of that similarity is missed with a chance of at most ``MISSED``."""
    met = (percent / 100) ** least_depth
    trees = math.ceil(math.log(MISSED) / math.log1p(-met)) if 0 < met < 1 else 1
    if met <= 0 or trees > 255:
        raise ValueError(f"{percent} percent is too low for prefixes of {least_depth} minima; take a smaller least_depth")
    return trees


def hash_family(trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of the minima of all trees."""
    draw = np.random.default_rng(20240607)
    factors = draw.integers(1, 2**63, trees * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, draw.integers(0, 2**63, trees * DEPTH, dtype=np.uint64)


def shingle_sets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, in order; too short a text is one shingle."""
    codes, first = grams(w, SHINGLE)
    rows = w.doc[first]
    counts = w.counts()
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        at = np.cumsum(counts) - counts
        extra = np.zeros(len(short), np.uint64)
        for i, row in enumerate(short.tolist()):
            for h in w.hash[at[row] : at[row] + counts[row]].tolist():
                extra[i] = mix(np.array([int(extra[i]) ^ h], np.uint64))[0] + np.uint64(1)
        codes, rows = np.concatenate([codes, extra]), np.concatenate([rows, short])
    order = np.lexsort((codes, rows))
    codes, rows = codes[order], rows[order]
    if len(codes):
        new = np.r_[True, (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1])]
        codes, rows = codes[new], rows[new]
    return rows, codes


SIGNED = "doc long, n_shingles long, s1 long, s2 long, labels array<binary>"


def sign(trees: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Map of texts to set size, 128-bit digest of the set, and the trees' labels."""
    factors, shifts = hash_family(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for w in words(batch.column(1), SPACED):
                rows, codes = shingle_sets(w)
                n = np.bincount(rows, minlength=w.rows)
                full = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[full]
                labels = np.zeros((len(full), trees * DEPTH), ">u4")
                for k in range(trees * DEPTH if len(full) else 0):
                    labels[:, k] = np.minimum.reduceat((codes * factors[k] + shifts[k]) >> np.uint64(32), starts)
                digest = np.zeros((w.rows, 2), np.int64)
                bounds = [*starts.tolist(), len(codes)]
                for i, row in enumerate(full.tolist()):
                    digest[row] = np.frombuffer(xxhash.xxh3_128_digest(codes[bounds[i] : bounds[i + 1]].tobytes()), np.int64)
                whole = labels.tobytes()
                place = np.full(w.rows, -1, np.int64)
                place[full] = np.arange(len(full))
                width = DEPTH * 4
                lists = [
                    [whole[(p * trees + t) * width : (p * trees + t + 1) * width] for t in range(trees)] if p >= 0 else None
                    for p in place.tolist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[w.first : w.first + w.rows], pa.int64()), pa.array(n, pa.int64()),
                        pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(lists, pa.list_(pa.binary())),
                    ],
                    names=["doc", "n_shingles", "s1", "s2", "labels"],
                )

    return run


def forest_ties(labels: DataFrame, least_depth: int) -> DataFrame:
    """(a, b) ties of each run of sorted labels that share ``least_depth`` minima to its first document.

    A run may cross partitions: each partition also gives its first and last run, and those
    few rows (two a partition) are tied on the driver.
    """
    width = 4 * least_depth
    order = labels.repartitionByRange("tree", "label", "doc").sortWithinPartitions("tree", "label", "doc")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, first, opening = None, None, None
        for batch in batches:
            ties: list[tuple[int, int]] = []
            for tree, label, doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = bytes([tree]) + label[:width]
                if key == head:
                    ties.append((first, doc))
                else:
                    head, first = key, doc
                    opening = opening or (key, doc)
            yield rows(ties, [None] * len(ties), 0)
        if opening:
            yield rows([(opening[1], first)], [opening[0] + head], 1)

    def rows(pairs: list, keys: list, kind: int) -> pa.RecordBatch:
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(keys, pa.binary()), pa.array([kind] * len(a), pa.int32())],
            names=["a", "b", "keys", "kind"],
        )

    found = stored(order.mapInArrow(runs, "a long, b long, keys binary, kind int"), "forest-runs")
    ends = sorted((bytes(r["keys"]), r["a"], r["b"]) for r in found.filter("kind = 1").collect())
    cut = width + 1
    across = [
        (before[2], after[1]) for before, after in zip(ends, ends[1:]) if before[0][cut:] == after[0][:cut]
    ]
    ties = found.filter("kind = 0").select("a", "b")
    if across:
        ties = ties.unionByName(labels.sparkSession.createDataFrame(across, "a long, b long"))
    return ties


def spanning(sets: list[np.ndarray], apart: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs (i, j) of sets that reach the similarity, i below j.

    apart: group of each set; pairs of group 1 among themselves are left out. Members that equal
    rows of the forest already tie are not compared again.
    """
    n = len(sets)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets])
    everything = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(everything, kind="stable")
    value, owner_by_value = everything[order], owner[order]
    starts = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.zeros(0, int)
    lengths = np.diff(np.r_[starts, len(value)])
    place = np.empty(len(value), np.int64)
    place[order] = np.repeat(np.arange(len(starts)), lengths)
    offsets = np.r_[0, np.cumsum(sizes)]
    ties = []
    for i in range(n):
        mine = place[offsets[i] : offsets[i + 1]]
        mine = mine[lengths[mine] > 1]
        if not len(mine):
            continue
        # All holders of my shingles, as ranges of the value order.
        count = lengths[mine]
        at = np.repeat(starts[mine] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(int(count.sum()))
        common = np.bincount(owner_by_value[at], minlength=n)
        near = 100 * common >= percent * (sizes + sizes[i] - common)
        near[: i + 1] = False
        if apart[i]:
            near &= apart == 0
        for j in np.flatnonzero(near).tolist():
            x, y = root(i), root(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                ties.append((i, j))
    return ties


def sets_of(texts: pa.Array) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for w in words(texts, SPACED):
        rows, codes = shingle_sets(w)
        out.extend(np.split(codes, np.cumsum(np.bincount(rows, minlength=w.rows))[:-1]))
    return out


def grouped(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Whole groups of equal values in the first ``width`` columns of a sorted partition."""
    open_: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:width]]
        change = np.zeros(batch.num_rows, bool)
        for c in names:
            change[1:] |= c[1:] != c[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            now = tuple(c[a] for c in names)
            if now != key and open_:
                yield pa.Table.from_batches(open_)
                open_ = []
            key = now
            open_.append(batch.slice(a, b - a))
    if open_:
        yield pa.Table.from_batches(open_)


def ties_of_groups(percent: int, width: int):
    """Map over partitions sorted by their first ``width`` columns: (keys..., doc, text, apart) to ties."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for table in grouped(batches, width):
            docs = table.column("doc").to_numpy()
            ties = spanning(sets_of(table.column("text")), table.column("apart").to_numpy(), percent)
            a.extend(int(docs[i]) for i, _ in ties)
            b.extend(int(docs[j]) for _, j in ties)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def links(members: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b) ties that connect what the exact links connect, from stored (region, n, pivot, doc, text) rows.

    n and pivot are the region's size and least document. Small regions are one group each. In a large one every text is first held against the pivot; those that
    match are settled, and only the others (in blocks) are compared with all blocks of the region.
    """
    sized = members.withColumn("apart", F.lit(0))
    small = sized.filter(F.col("n") <= block).select("region", "doc", "text", "apart")
    found = small.repartition("region").sortWithinPartitions("region", "doc").mapInArrow(
        ties_of_groups(percent, 1), "a long, b long"
    )
    large = sized.filter(F.col("n") > block)
    if large.isEmpty():
        return found
    pivots = large.filter("doc = pivot").select(F.col("region").alias("at"), F.col("text").alias("pivot_text"))

    def near_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot_of: dict[str, np.ndarray] = {}
            near = []
            for mine, pivot in zip(sets_of(batch.column("text")), batch.column("pivot_text").to_pylist(), strict=True):
                if pivot not in pivot_of:
                    pivot_of = {pivot: sets_of(pa.array([pivot]))[0]}
                other = pivot_of[pivot]
                common = len(np.intersect1d(mine, other, assume_unique=True))
                near.append(100 * common >= percent * (len(mine) + len(other) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("region", "doc", "text", "pivot")] + [pa.array(near, pa.bool_())],
                names=["region", "doc", "text", "pivot", "near"],
            )

    judged = stored(
        large.join(pivots, F.col("region") == F.col("at")).select("region", "doc", "text", "pivot", "pivot_text").mapInArrow(
            near_pivot, "region long, doc long, text string, pivot long, near boolean"
        ),
        "near-pivot",
    )
    found = found.unionByName(judged.filter("near and doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")))
    left = stored(judged.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.sum((~F.col("near")).cast("int")).alias("far")
    ).filter("far > 0"), "unsettled")
    # Unsettled texts are dealt into blocks that all blocks of the region meet.
    cells = judged.join(left, "region").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn(
        "far_blocks", F.ceil(F.col("far") / block).cast("int")
    ).withColumn("place", F.xxhash64("doc"))
    settled = cells.filter("near").withColumn("column", F.pmod("place", F.col("blocks")).cast("int")).select(
        "region", F.explode(F.sequence(F.lit(0), F.col("far_blocks") - 1)).alias("row"), "column", "doc", "text",
        F.lit(1).alias("apart"),
    )
    far = cells.filter("not near").withColumn("mine", F.pmod("place", F.col("far_blocks")).cast("int"))
    against_settled = far.select(
        "region", F.col("mine").alias("row"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("column"), "doc", "text",
        F.lit(0).alias("apart"),
    )
    among_far = far.select(
        "region", "mine", "doc", "text", F.explode(F.sequence(F.lit(0), F.col("far_blocks") - 1)).alias("other")
    ).select(
        "region", F.least("mine", "other").alias("row"), (-1 - F.greatest("mine", "other")).alias("column"), "doc", "text",
        F.lit(0).alias("apart"),
    )
    blocks = settled.unionByName(against_settled).unionByName(among_far)
    return found.unionByName(
        blocks.repartition("region", "row", "column").sortWithinPartitions("region", "row", "column", "doc").mapInArrow(
            ties_of_groups(percent, 3), "a long, b long"
        )
    )


def near_groups(
    docs: DataFrame, percent: int = 85, least_depth: int = LEAST_DEPTH, block: int = BLOCK
) -> DataFrame:
    """(doc, n_shingles, component) of every row; links are pairs with at least ``percent`` similarity."""
    ready(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")
    signed = stored(texts.mapInArrow(sign(trees_for(percent, least_depth)), SIGNED), "signatures")
    sets = signed.filter("n_shingles > 0").groupBy("s1", "s2").agg(F.min("doc").alias("rep"), F.first("labels").alias("labels"))
    sets = stored(sets, "sets")
    labels = sets.select(F.col("rep").alias("doc"), F.posexplode("labels").alias("tree", "label")).select("tree", "label", "doc")
    regions = stored(components(forest_ties(labels, least_depth)), "regions")
    members = sets.join(regions, F.col("rep") == F.col("node")).select(F.col("rep").alias("of"), F.col("component").alias("region")).distinct()
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("of").alias("pivot"))
    members = stored(members.join(sizes, "region"), "region-members")
    # Merged at every size: which side is small enough to send must not change what is moved.
    with_text = members.join(texts.hint("merge"), F.col("of") == F.col("doc")).select("region", "n", "pivot", "doc", "text")
    ties = links(stored(with_text, "region-texts"), percent, block)
    placed = signed.select("doc", "n_shingles", "s1", "s2").join(
        sets.select("s1", "s2", "rep"), ["s1", "s2"], "left"
    )
    placed = placed.select("doc", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).alias("rep"))
    # Rows of one id are one document, whatever their texts.
    twice = placed.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").select("doc", "a")
    same_id = placed.select("doc", F.col("rep").alias("b")).join(twice, "doc").filter("a < b").select("a", "b")
    found = stored(components(ties.unionByName(same_id)), "groups")
    return placed.join(found, F.col("rep") == F.col("node"), "left").select(
        "doc", "n_shingles", F.coalesce("component", "rep", "doc").alias("component")
    )


def near_duplicates(docs: DataFrame, percent: int = 85, least_depth: int = LEAST_DEPTH, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    A text without words, empty or null has no shingles and is linked with nothing. Rows that share an
    id are one document (and all kept or none); a null id reads as the least id and comes back null.
    An empty table gives no rows.
    """
    none = F.lit(NO_ID)
    return near_groups(docs, percent, least_depth, block).select(
        F.nullif("doc", none).alias("doc_id"),
        "n_shingles",
        F.nullif("component", none).alias("component_id"),
        (F.col("doc") == F.col("component")).alias("kept"),
    )


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` less all but the least id of each group of near duplicates."""
    gone = near_duplicates(without(docs, *OUTPUT), percent).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
