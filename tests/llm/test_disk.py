"""What operators leave on disk while they run."""

from __future__ import annotations

import random
import time
from pathlib import Path

import brute
import numpy as np
import pytest

from tallgrove.llm import embedding_dedup, frames, lm_scoring


def shuffle_files(spark) -> set[str]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}


def tables_below(spark) -> dict[Path, int]:
    root = Path(frames.scratch_path(spark, "x").removeprefix("file:")).parent
    return {p: sum(f.stat().st_size for f in p.glob("*.parquet")) for p in root.glob("*")}


def test_shuffle_files_go_with_their_query(spark):
    before, setting = shuffle_files(spark), spark.conf.get(frames.FREED, None)
    table = frames.settled(spark.range(1000).repartition(4, "id"), "settled")
    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and table.count() == 1000 and spark.conf.get(frames.FREED, None) == setting


def test_lm_scoring_stores_documents_once(spark):
    draw = random.Random(4)
    rows = [(i, " ".join(f"{draw.getrandbits(64):x}" for _ in range(60))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    model, before = lm_scoring.Model(docs, 10_000, 10_000), set(tables_below(spark))
    assert len(model.ranges) > 20
    assert lm_scoring.score(docs, model).count() == 300
    # However many ranges of shards the model has, what is stored holds the texts once, and the answers.
    new = {p: n for p, n in tables_below(spark).items() if p not in before}
    assert sum(new.values()) < 2 * sum(len(text) for _, text in rows)


def test_lm_hashes_travel_whole():
    draw = np.random.default_rng(8)
    some = np.unique(lm_scoring.mix(np.arange(5000, dtype=np.uint64)))
    for keys in (some[:0], np.array([0, 1, 2**64 - 1], np.uint64), some):
        assert (lm_scoring.unpacked(lm_scoring.packed(keys), len(keys)) == keys).all()
        levels = draw.integers(0, 120, len(keys)).astype(np.uint8)
        assert (lm_scoring.grown(lm_scoring.shrunk(levels), len(keys), np.uint8) == levels).all()
    assert len(lm_scoring.packed(some)) < 7.5 * len(some)


def vectors(spark, n: int, tight: int):
    """Rows in two labels, without a direction that is rarer than others; some are near others, ``tight`` very near each other."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(n, 24))
    x[: n // 4] = x[n // 2 : n // 2 + n // 4] + draw.normal(scale=0.13, size=(n // 4, 24))
    x[-tight:] = x[-1] + draw.normal(scale=0.02, size=(tight, 24))
    x = np.float32(x)
    label = np.r_[np.arange(n // 2) % 2, np.arange(n - n // 2) % 2]
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5), x.astype(float), label


@pytest.mark.parametrize("cell, chunk", [(40, 90), (40, 10_000), (10_000, 300)])
def test_vectors_meet_once_in_districts_and_pieces(spark, cell, chunk):
    df, x, label = vectors(spark, 1600, 150)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    root = brute.groups(range(len(x)), [*zip(*np.nonzero(np.triu(linked)))])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.duplicate_vectors(df, cell=cell, chunk=chunk).collect()}
    assert 100 < len(set(root.values())) < 1500
    assert got == {i: (int(linked[i].sum()), root[i], root[i] == i) for i in range(len(x))}


def test_vectors_are_stored_once(spark):
    df, x, _ = vectors(spark, 3000, 10)
    before = set(tables_below(spark))
    embedding_dedup.duplicate_vectors(df, cell=60, chunk=100).count()
    new = {p: n for p, n in tables_below(spark).items() if p not in before}
    # Most vectors visit several districts; none is written for that, and each wave's shuffle goes with it.
    assert max(new.values()) < 8 * x.size and sum(new.values()) < 16 * x.size
    assert sum("vector-links" in p.name for p in new) > 2


def test_one_of_two_districts_visits_the_other():
    for n in range(12):
        one = embedding_dedup.visits(n)
        assert (one ^ one.T == ~np.eye(n, dtype=bool)).all() and (not n or np.ptp(one.sum(1)) <= 1)
