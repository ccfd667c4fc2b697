"""Near-duplicate vectors: spherical k-means cells, blocked cosine products in the cells.

Equal vectors of a label fall together first and count with their number. The cells' centres are
fitted by MLlib's k-means with cosine distance on a bounded sample (``SAMPLE_PER_CELL`` vectors a cell). Neighbouring
cells make a district, so that a task can hold what a label has of one (``CHUNK`` vectors; more are cut into
pieces). A vector is held in its own district and streamed past another one in which a partner could be: a
partner turns by at most acos(threshold), so the border must be as near as that. Of two districts one
visits the other, so a pair meets in one task only. In a task the products are blocked by cells: a
vector meets the cells whose border is within half that angle and whose radius (over the members held) reaches as far.
All bounds are exact, no pair is lost. Links stay in the task: out come counts and the ties of a spanning forest.
Tasks run in waves, each of which moves about as much as the distinct vectors take, whatever the number of visits.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrove.llm.components import components
from tallgrove.llm.frames import ready, settled, stored, without
from tallgrove.llm.words import BASE, mix

THRESHOLD = 0.98
#: Distinct vectors a cell should hold, over all labels; with MAX_CELLS cells the centres of 64 dimensions take 2 MB.
#: Finer cells save products, but in many dimensions most vectors are near some border.
CELL = 8192
MAX_CELLS = 4096
SAMPLE_PER_CELL = 300
#: Vectors that a task holds; others stream past them.
CHUNK = 262_144
#: Rows that stream past at once.
VISITORS = 65_536
#: Of a wave, in multiples of the distinct vectors.
WAVE = 1.25
#: Rows and columns of a product that are held at once, and numbers of a slab's cosines to the centres.
STRIP, TILE, SLAB = 256, 2048, 1 << 22
NO_ID = -(2**63)
OUTPUT = ("n_links", "component_id", "kept")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that very large and very small ones keep their direction."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centres_of(vectors: DataFrame, n: int, cell: int, seed: int) -> np.ndarray:
    """Unit centres, fitted on about ``SAMPLE_PER_CELL`` vectors a cell, chosen by the vectors' hash."""
    cells = min(MAX_CELLS, max(1, -(-n // cell)))
    if cells == 1:
        return np.zeros((0, 0))
    share = min(1.0, cells * SAMPLE_PER_CELL / n)
    chosen = vectors.filter(F.pmod("h1", F.lit(1 << 20)) < round(share * (1 << 20)))
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    scaled = F.transform("vector", lambda x: x.cast("double") / largest)
    sample = stored(chosen.select(scaled.alias("v")), "vector-sample").select(array_to_vector("v").alias("features"))
    model = KMeans(k=cells, distanceMeasure="cosine", initMode="random", maxIter=8, seed=seed).fit(sample)
    return unit(np.array(model.clusterCenters()))


def districts_of(centres: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Unit centres of n districts: a spherical k-means over the cells' centres."""
    n = min(n, len(centres))
    if n < 2:
        return np.zeros((0, 0))
    found = centres[np.random.default_rng(seed).choice(len(centres), n, replace=False)]
    for _ in range(20):
        near = (centres @ found.T).argmax(1)
        sums = np.stack([centres[near == i].sum(0) for i in range(n)])
        full = np.abs(sums).max(1) > 1e-9
        found[full] = unit(sums[full])
    return found


def visits(n: int) -> np.ndarray:
    """[i, j]: whether i is streamed past j; of each two numbers below n one is, and all about as often."""
    apart = np.subtract.outer(np.arange(n), np.arange(n)).T % max(n, 1)
    return (apart > 0) & (2 * apart < n) | (2 * apart == n) & (np.arange(n)[:, None] < np.arange(n))


def gaps_of(centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T)) if len(centres) else centres


class Vectors:
    """Rows of a task, with their directions as 32-bit numbers; ``own`` are the vectors as they came."""

    def __init__(self, batches: list[pa.RecordBatch], number: np.dtype) -> None:
        self.h1, self.h2, self.ids, self.copies = (
            np.concatenate([b.column(n).to_numpy() for b in batches]) for n in ("h1", "h2", "id", "copies")
        )
        raw = [np.frombuffer(b"".join(b.column("vector").to_pylist()), number).reshape(b.num_rows, -1) for b in batches]
        self.own = np.concatenate(raw)
        self.x = np.concatenate([unit(r.astype(np.float64)).astype(np.float32) for r in raw])

    def take(self, order: np.ndarray) -> None:
        for name, value in vars(self).items():
            setattr(self, name, value[order])


def rows_of(bits: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits, count=n))


class Held:
    """Vectors that a task holds, in order of their cells; what is linked with them.

    Of two partners in two cells one is within half the threshold's angle of the border between them. So the
    vectors that are as near to a cell are multiplied with that cell's, from both sides; a link that is met
    from both counts once.
    """

    def __init__(self, vectors: Vectors, centres: np.ndarray, threshold: float) -> None:
        self.vectors, self.threshold = vectors, threshold
        x = vectors.x
        n = len(x)
        self.centres = centres.astype(np.float32)
        # What the error of a 32-bit product can make of a cosine.
        self.off = (x.shape[1] + 16) * 2.0**-23
        angle = float(np.arccos(np.clip(threshold, -1, 1)))
        if len(centres):
            # How far the cosine to another centre may fall behind that to the own one.
            self.slack = (np.sin(angle / 2) * gaps_of(centres) + 4 * self.off).astype(np.float32)
            home, away = (np.concatenate(v) for v in zip(*((c.argmax(0), c.max(0)) for c in self.cosines(x))))
            order = np.argsort(home, kind="stable")
            vectors.take(order)
            self.home, away = home[order], away[order]
            self.cells, starts, self.cell_at = np.unique(self.home, return_index=True, return_inverse=True)
            reach = np.arccos(np.clip(np.minimum.reduceat(away, starts).astype(np.float64) - 4 * self.off, -1, 1))
            self.least = (np.cos(np.minimum(np.pi, reach + angle)) - 4 * self.off).astype(np.float32)
            self.bits = np.concatenate([self.borders(c, c.argmax(0)) for c in self.cosines(vectors.x)], 1)
        else:
            self.home, self.cells, starts = np.zeros(n, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.blocks = list(zip(starts.tolist(), [*starts[1:].tolist(), n]))
        self.total, self.root = np.zeros(n, np.int64), np.arange(n)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def cosines(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """[cell, row] of slabs of rows; but for the last they are whole bytes of bits."""
        step = max(STRIP, SLAB // len(self.centres) // 8 * 8)
        return (self.centres @ x[at : at + step].T for at in range(0, len(x), step))

    def borders(self, cosines: np.ndarray, home: np.ndarray) -> np.ndarray:
        """[cell, row / 8], as bits: whether the row is near the border to the cell."""
        best = cosines[home, np.arange(len(home))]
        return np.packbits(best - cosines <= self.slack[:, home], axis=1)

    def pairs(self, others: Vectors, rows: np.ndarray, mine: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links (row of others, row held) of some rows with some that are held."""
        for left in range(0, len(mine), TILE):
            tile = mine[left : left + TILE]
            y = self.vectors.x[tile].T
            for at in range(0, len(rows), STRIP):
                strip = rows[at : at + STRIP]
                cosine = others.x[strip] @ y
                near = cosine >= self.threshold - self.off
                if not near.any():
                    continue
                i, j = np.nonzero(near)
                unsure = np.flatnonzero(cosine[i, j] < self.threshold + self.off)
                i, j = strip[i], tile[j]
                if len(unsure):
                    linked = np.ones(len(i), bool)
                    for some in np.array_split(unsure, -(-len(unsure) // 16384)):
                        a, b = (unit(v.astype(np.float64)) for v in (others.own[i[some]], self.vectors.own[j[some]]))
                        linked[some] = np.einsum("ij,ij->i", a, b) >= self.threshold
                    i, j = i[linked], j[linked]
                yield i, j

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        apart = a != b
        if apart.any():
            self.pending.append((a[apart], b[apart]))
            self.waiting += len(self.pending[-1][0])
            if self.waiting > len(self.root) + 100_000:
                self.settle()

    def settle(self) -> None:
        """Roots of all that is tied so far; a root is the least row of its group."""
        if not self.pending:
            return
        a, b = (np.concatenate(c) for c in zip(*self.pending))
        self.pending, self.waiting, root = [], 0, self.root
        while True:
            a, b = root[a], root[b]
            apart = a != b
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := root[root], root):
                root = up
        self.root = root

    def meet_itself(self) -> None:
        mine = self.vectors

        def link(i: np.ndarray, j: np.ndarray) -> None:
            np.add.at(self.total, i, mine.copies[j])
            np.add.at(self.total, j, mine.copies[i])
            self.tie(i, j)

        for first, last in self.blocks:
            for at in range(first, last, STRIP):
                for i, j in self.pairs(mine, np.arange(at, min(at + STRIP, last)), np.arange(at, last)):
                    after = j > i
                    link(i[after], j[after])
        if len(self.blocks) == 1:
            return
        for (first, last), cell, least in zip(self.blocks, self.cells.tolist(), self.least):
            rows = rows_of(self.bits[cell], len(mine.x))
            rows = rows[(rows < first) | (rows >= last)]
            rows = rows[mine.x[rows] @ self.centres[cell] >= least]
            for i, j in self.pairs(mine, rows, np.arange(first, last)):
                home = self.home[i]
                back = self.bits[home, j >> 3] >> (7 - (j & 7)).astype(np.uint8) & 1 == 1
                once = (home < cell) | ~back
                link(i[once], j[once])

    def meet(self, others: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """Of each streamed row how many it is linked with, and the first row held of them."""
        n = len(others.x)
        total, partner = np.zeros(n, np.int64), np.full(n, -1)

        def link(i: np.ndarray, j: np.ndarray) -> None:
            np.add.at(total, i, self.vectors.copies[j])
            np.add.at(self.total, j, others.copies[i])
            new = np.flatnonzero(partner[i] < 0)[::-1]
            partner[i[new]] = j[new]
            self.tie(partner[i], j)

        if not len(self.centres):
            for i, j in self.pairs(others, np.arange(n), np.arange(len(self.home))):
                link(i, j)
            return total, partner
        homes, near = [], []
        for cosines in self.cosines(others.x):
            homes.append(cosines.argmax(0))
            near.append(self.borders(cosines, homes[-1])[self.cells])
        home, bits = np.concatenate(homes), np.concatenate(near, 1)
        for (first, last), cell, least, some in zip(self.blocks, self.cells.tolist(), self.least, bits):
            rows = rows_of(some, n)
            rows = rows[others.x[rows] @ self.centres[cell] >= least]
            for i, j in self.pairs(others, rows, np.arange(first, last)):
                link(i, j)
        order = np.argsort(home, kind="stable")
        cells, starts = np.unique(home[order], return_index=True)
        for cell, rows in zip(cells.tolist(), np.split(order, starts[1:])):
            held = rows_of(self.bits[cell], len(self.home))
            for i, j in self.pairs(others, rows, held[self.home[held] != cell]):
                met = bits[self.cell_at[j], i >> 3] >> (7 - (i & 7)).astype(np.uint8) & 1 == 1
                link(i[~met], j[~met])
        return total, partner


def links_of(v: Vectors, pick: np.ndarray, total: np.ndarray, partners: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(pick), 1 << 16):
        some = pick[at : at + (1 << 16)]
        columns = (v.h1[some], v.h2[some], total[some], v.ids[some], partners[at : at + (1 << 16)])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["h1", "h2", "n", "a", "b"])


def duplicate_vectors(
    table: DataFrame, threshold: float = THRESHOLD, cell: int = CELL, chunk: int = CHUNK, seed: int = 5
) -> DataFrame:
    """``table`` with n_links, component_id and kept.

    Vectors are compared within a label. Null, empty or zero vectors, those with null or non-finite
    components and those without a label link with nothing; vectors of different lengths do not link.
    Rows that repeat a vector link with each other. A null vec_id reads as the least id and comes back as null.
    An empty table gives no rows. Input columns named like the output are replaced.
    """
    spark = ready(table.sparkSession)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = (
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )
    base = without(table, *OUTPUT)
    keyed = (
        base.withColumn("_id", F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)))
        .withColumn("_valid", F.coalesce(valid, F.lit(False)))
        .withColumn("_h1", F.when(F.col("_valid"), F.xxhash64("label", "embedding")))
        .withColumn("_h2", F.when(F.col("_valid"), F.xxhash64(F.lit(1), "label", "embedding")))
    )
    distinct = settled(
        keyed.filter("_valid").groupBy(F.col("_h1").alias("h1"), F.col("_h2").alias("h2")).agg(
            F.min("_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
            F.first("embedding").alias("vector"),
        ).withColumn("size", F.size("vector")),
        "vectors",
    )
    by_class = distinct.groupBy("size", "label").count()
    sizes = by_class.groupBy("size").agg(F.sum("count").alias("count"), F.max("count").alias("most")).orderBy(
        F.desc("count"), "size"
    ).limit(1).collect()
    main, n, most = (sizes[0]["size"], sizes[0]["count"], sizes[0]["most"]) if sizes else (0, 0, 0)
    centres = centres_of(distinct.filter(F.col("size") == main), n, cell, seed)
    districts = districts_of(centres, -(-most // chunk), seed)
    known = spark.sparkContext.broadcast((centres, districts))
    single = table.schema["embedding"].dataType.elementType.simpleString() == "float"
    number = np.dtype("<f4" if single else "<f8")
    sine = np.sin(min(np.arccos(np.clip(threshold, -1, 1)), np.pi / 2))

    def places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row's district, and the (row, district) visits."""
        heart, size = known.value[1], batch.column("size").to_numpy()
        home, none = np.full(len(size), -1), np.zeros(0, np.int64)
        usual = np.flatnonzero(size == main)
        if not len(heart) or not len(usual):
            return home, none, none
        flat = batch.column("vector").take(pa.array(usual)).flatten().to_numpy(zero_copy_only=False)
        near = unit(flat.astype(np.float64).reshape(len(usual), main)) @ heart.T
        own, here = near.argmax(1), np.arange(len(usual))
        home[usual] = own
        border = near[here, own][:, None] - near <= (sine + 1e-9) * gaps_of(heart)[own] + 1e-12
        at, to = np.nonzero(border & visits(len(heart))[own])
        return home, usual[at], to

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(known.value[1]) + 1
        for batch in batches:
            kinds, kind = np.unique(batch.column("class").to_numpy(), return_inverse=True)
            home, at, to = places(batch)
            held = np.bincount(kind * width + home + 1, minlength=len(kinds) * width)
            guests = np.bincount(kind[at] * width + to + 1, minlength=len(kinds) * width)
            some = np.flatnonzero(held + guests)
            columns = (kinds[some // width], some % width - 1, held[some], guests[some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["class", "district", "held", "guests"]
            )

    rows = distinct.select(F.xxhash64("label", "size").alias("class"), "size", "id", "h1", "h2", "copies", "vector")
    if len(districts):
        counted = rows.select("class", "size", "vector").mapInArrow(
            count, "class long, district long, held long, guests long"
        )
    else:
        counted = by_class.select(
            F.xxhash64("label", "size").alias("class"), F.lit(-1).cast("long").alias("district"),
            F.col("count").alias("held"), F.lit(0).cast("long").alias("guests"),
        )
    counts = settled(
        counted.groupBy("class", "district").agg(F.sum("held").alias("held"), F.sum("guests").alias("guests")).withColumn(
            "pieces", F.greatest(F.lit(1), F.ceil(F.col("held") / chunk))
        ),
        "vector-counts",
    )
    # At most one row for CHUNK vectors.
    cut = spark.sparkContext.broadcast(
        {(r["class"], r["district"]): r["pieces"] for r in counts.filter("pieces > 1").select("class", "district", "pieces").collect()}
    )
    moved, all_held, tasks = counts.agg(
        F.sum(F.col("held") * (F.col("pieces") + 1) / 2 + F.col("guests") * F.col("pieces")), F.sum("held"), F.sum("pieces")
    ).first()
    waves = max(1, int(-(-moved // (WAVE * all_held)))) if all_held else 1
    schema = "class long, district int, piece int, streamed boolean, id long, h1 long, h2 long, copies long, vector binary"

    def deal(wave: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces_of = cut.value
            for batch in batches:
                kind, split = batch.column("class").to_numpy(), batch.column("h2").to_numpy()
                home, at, to = places(batch)
                row, district = np.r_[np.arange(len(home)), at], np.r_[home, to]
                piece, streamed = np.zeros(len(row), np.int64), np.arange(len(row)) >= len(home)
                if pieces_of:
                    number_of = np.array([pieces_of.get(k, 1) for k in zip(kind[row].tolist(), district.tolist())])
                    again = np.repeat(np.arange(len(row)), number_of)
                    piece = np.arange(len(again)) - np.repeat(np.cumsum(number_of) - number_of, number_of)
                    row, district, streamed, number_of = row[again], district[again], streamed[again], number_of[again]
                    own = split[row] % number_of
                    apart = (piece - own) % number_of
                    passes = (2 * apart < number_of) | (2 * apart == number_of) & (own < piece)
                    stays = streamed | (apart == 0) | passes
                    streamed = streamed | (apart != 0)
                    row, district, piece, streamed = row[stays], district[stays], piece[stays], streamed[stays]
                if waves > 1:
                    task = mix(kind[row].view(np.uint64) + mix((district + 1).astype(np.uint64) * np.uint64(BASE) + piece.astype(np.uint64)))
                    now = np.flatnonzero(task % np.uint64(waves) == wave)
                    row, district, piece, streamed = row[now], district[now], piece[now], streamed[now]
                vectors = batch.column("vector")
                flat = np.ascontiguousarray(vectors.flatten().to_numpy(zero_copy_only=False), number)
                ends = np.r_[0, np.cumsum(batch.column("size").to_numpy())] * number.itemsize
                raw = pa.Array.from_buffers(
                    pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)]
                )
                taken = pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("class", "id", "h1", "h2", "copies")), raw],
                    names=["class", "id", "h1", "h2", "copies", "vector"],
                ).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        taken.column("class"), pa.array(district.astype(np.int32)), pa.array(piece.astype(np.int32)),
                        pa.array(streamed), *(taken.column(c) for c in ("id", "h1", "h2", "copies", "vector")),
                    ],
                    names=["class", "district", "piece", "streamed", "id", "h1", "h2", "copies", "vector"],
                )

        return run

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (
            ((tuple(batch.column(c)[a].as_py() for c in keys), batch.column("streamed")[a].as_py()), batch.slice(a, b - a))
            for batch in batches
            for a, b in itertools.pairwise(runs(batch))
        )
        for _, parts in itertools.groupby(slices, lambda part: part[0][0]):
            held = None
            for streamed, some in itertools.groupby(parts, lambda part: part[0][1]):
                if not streamed:
                    vectors = Vectors([batch for _, batch in some], number)
                    usual = vectors.x.shape[1] == main
                    held = Held(vectors, known.value[0] if usual else np.zeros((0, 0)), threshold)
                    held.meet_itself()
                elif held is not None:
                    for slab in slabs_of(batch for _, batch in some):
                        others = Vectors(slab, number)
                        total, partner = held.meet(others)
                        pick = np.flatnonzero(total)
                        yield from links_of(others, pick, total, held.vectors.ids[partner[pick]])
            if held is not None:
                held.settle()
                pick = np.flatnonzero(held.total)
                yield from links_of(held.vectors, pick, held.total, held.vectors.ids[held.root[pick]])

    def runs(batch: pa.RecordBatch) -> list[int]:
        change = np.zeros(max(0, batch.num_rows - 1), bool)
        for c in (*keys, "streamed"):
            values = batch.column(c).to_numpy(zero_copy_only=False)
            change |= values[1:] != values[:-1]
        return [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows] if batch.num_rows else []

    def slabs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        open_: list[pa.RecordBatch] = []
        for batch in batches:
            open_.append(batch)
            if sum(b.num_rows for b in open_) >= VISITORS:
                yield open_
                open_ = []
        if open_:
            yield open_

    keys = ["class", "district", "piece"]
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(2000, 4 * int(tasks or 0)))
    found = None
    for wave in range(waves):
        dealt = rows.mapInArrow(deal(wave), schema)
        links = settled(
            dealt.repartition(partitions, *keys).sortWithinPartitions(*keys, "streamed", "h1", "h2").mapInArrow(
                multiply, "h1 long, h2 long, n long, a long, b long"
            ),
            "vector-links",
        )
        found = links if found is None else found.unionByName(links)
    # Rows of one id are one node.
    seen = distinct.select("h1", "h2", "id", "copies")
    linked = found.groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    groups = settled(components(found.select("a", "b")), "vector-groups")
    judged = (
        seen.join(linked, ["h1", "h2"], "left")
        .join(groups, F.col("id") == F.col("node"), "left")
        .select(
            F.col("h1").alias("_r1"), F.col("h2").alias("_r2"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("_component"),
        )
    )
    component = F.coalesce("_component", "_id")
    return keyed.join(judged, (F.col("_h1") == F.col("_r1")) & (F.col("_h2") == F.col("_r2")), "left").select(
        *base.columns,
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.nullif(component, F.lit(NO_ID)).alias("component_id"),
        (F.col("_id") == component).alias("kept"),
    )
