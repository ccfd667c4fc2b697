"""Line, near, suffix and vector deduplication against brute force."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from tallgrove.llm import components, embedding_dedup, frames, lines, near_dedup, suffix_dedup
from tallgrove.llm.lines import CuckooFilter, LineIndex

WORDS = [f"w{i}" for i in range(60)] + ["été", "straße", "ñandú", "日本"]


def copies(seed: int, n: int = 60, size: int = 70) -> dict[int, str | None]:
    """Texts, near copies and exact copies of them, shared passages, empty and short ones."""
    draw = random.Random(seed)
    base = [" ".join(draw.choices(WORDS, k=draw.randint(5, size))) for _ in range(n // 3)]
    texts: dict[int, str | None] = {0: None, 1: "", 2: "a b", 3: "A  b", 4: " \n\t ", 5: "one\ntwo", 6: "x" * 900, 7: "xy" * 300}
    for i in range(8, n):
        words = draw.choice(base).split(" ")
        kind = draw.random()
        if kind < 0.4:
            words[draw.randrange(len(words))] = draw.choice(WORDS)
        elif kind < 0.6:
            words = words + base[0].split(" ")
        texts[i] = " ".join(words) if kind < 0.9 else " ".join(words).replace(" w1", "\nw1")
    return texts


def frame(spark, texts: dict, **more):
    rows = [(i, t, "clash", 1) for i, t in texts.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, n_links int").repartition(5)


@pytest.mark.parametrize("block", [256, 4])
def test_near_duplicates(spark, block):
    texts = copies(1)
    got = near_dedup.near_duplicates(frame(spark, texts), block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute.near(texts)


def test_large_region_with_stragglers(spark):
    """One region of near copies of which some only reach others than the pivot."""
    draw = random.Random(5)
    words = [f"t{i}" for i in range(120)]
    texts, now = {}, list(words)
    for i in range(40):
        texts[i] = " ".join(now)
        now[draw.randrange(120)] = f"n{i}"  # a chain: neighbours are near, the ends are not
    got = near_dedup.near_duplicates(frame(spark, texts), block=6).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute.near(texts)


def test_near_edge_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (2, None), (3, "A B c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(near_dedup.near_duplicates(df).collect(), key=str)
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, None, True)]
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"] == 2} == {(2, 2, True)}
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 3)} == {None}
    kept = near_dedup.keep_one(df).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept if r["doc_id"] is not None) == [(False, 2), (False, 2)]
    assert near_dedup.near_duplicates(df.limit(0)).collect() == []


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 60), (60, 60), (101, 100)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = brute.groups(sorted({x for e in edges for x in e}), edges)
    assert {r["node"]: r["component"] for r in got} == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_suffix_dedup(spark, seed):
    texts = copies(seed)
    got = suffix_dedup.remove_repeats(frame(spark, texts), length=40, first_depth=20, second_depth=32).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got} == brute.repeats(texts, 40)


def test_suffix_edge_rows(spark):
    long = "abc " * 200
    df = spark.createDataFrame([(1, long), (1, long), (None, "short"), (2, None)], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(df).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in got) == [
        (0, 5, 0, b"short"), (1, 800, 800, b""), (1, 800, 800, b""), (2, 0, 0, b"")
    ]
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


def test_suffix_classes_of_one_key_are_split(spark, monkeypatch):
    """An anchor string with very many surroundings is dealt over several tasks (before: all its classes in one)."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    plans = {}

    def stored(df, label):
        df.collect()
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return frames.stored(df, label)

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    hot = [(i, i, 0, 7, around) for i, around in enumerate([*range(2000), *range(2000), -1])]
    cold = [(i, i, 1, 100 + i % 40, i % 40) for i in range(80)]
    rows = spark.createDataFrame(hot + cold, "doc long, digest long, pos int, key long, around long")
    again = spark.createDataFrame([(7,), *((100 + i,) for i in range(40))], "key long")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = suffix_dedup.marks(rows, again, suffix_dedup.ID).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plans["full-classes"]
    marked = sorted((r["doc"], p, f, w) for r in got for p, f, w in zip(r["pos"], r["full"], r["witness"]))
    want = [(i, 0, i < 4000, i < 2000) for i in range(4001)] + [(i, 1, True, False) for i in range(80)]
    assert marked == sorted(want)


def line_texts(seed: int) -> dict[int, str | None]:
    draw = random.Random(seed)
    pool = [f"  Line number {i} WITH some text{' ' * (i % 3)}" for i in range(12)] + ["short", "", "exactly twenty chars"]
    texts = {i: "\n".join(draw.choices(pool, k=draw.randint(1, 6))) for i in range(30)}
    return {**texts, 30: None, 31: "", 32: "\n\n"}


def test_line_dedup(spark):
    texts = line_texts(1)
    got = lines.dedup_lines(frame(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got} == brute.lines(texts)
    assert lines.dedup_lines(frame(spark, texts).limit(0)).collect() == []


def test_line_index_is_reversible(spark):
    texts = line_texts(2)
    early, late = ({i: t for i, t in texts.items() if (i < 12) == first} for first in (True, False))
    index = LineIndex(spark, shards=4).insert(frame(spark, early)).insert(frame(spark, late))
    whole = lines.drop_repeated(frame(spark, texts), index).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in whole} == brute.lines(texts)
    gone = spark.createDataFrame([(i,) for i in range(20, 33)] + [(999,)], "doc_id long")
    rest = {i: t for i, t in texts.items() if i < 20}
    after = lines.drop_repeated(frame(spark, rest), index.delete(gone)).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in after} == brute.lines(rest)
    back = index.delete(gone).insert(frame(spark, {i: t for i, t in texts.items() if i >= 20}))
    again = lines.drop_repeated(frame(spark, texts), back).collect()
    assert {r["doc_id"]: r["kept_text"] for r in again} == {i: v[2] for i, v in brute.lines(texts).items()}


def test_line_index_counts_and_grows(spark):
    texts = line_texts(5)
    parts = [{i: t for i, t in texts.items() if i % 3 == k} for k in range(3)]
    index = LineIndex(spark, shards=1, shard_keys=3)
    for part in parts:
        index = index.insert(frame(spark, part))
    assert index.shards >= 4
    index = index.delete(spark.createDataFrame([(29,), (28,), (None,)], "doc_id long"))
    rest = {i: t for i, t in texts.items() if i not in (28, 29)}
    held: dict[str, set[int]] = {}
    for i, text in rest.items():
        for line in (text or "").split("\n"):
            key = line.strip(lines.BLANK).lower()
            if len(key) >= 20:
                held.setdefault(key, set()).add(i)
    got = sorted((r["n"], r["last"]) for r in index.counts().collect())
    assert got == sorted((len(v), max(v)) for v in held.values())
    kept = lines.drop_repeated(frame(spark, rest), index).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in kept} == brute.lines(rest)


def test_line_lookups_meet_hits_only(spark):
    index = LineIndex(spark).insert(frame(spark, line_texts(6)))
    # The filters are probed first and only their hits are joined with the counts; no posting is read.
    plan = index.repeated(index.counted[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("FlatMapCoGroupsInPandas")
    assert "Aggregate" not in plan and "doc#" not in plan


def test_cuckoo_filter_adds_and_removes():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 6000)
    cuckoo = CuckooFilter()
    cuckoo.add(keys)
    assert cuckoo.has(keys).all() and len(cuckoo.tables) > 1
    cuckoo = CuckooFilter.of_bytes(cuckoo.to_bytes())
    cuckoo.remove(keys[:3000])
    assert cuckoo.has(keys[3000:]).all() and cuckoo.has(keys[:3000]).mean() < 0.02


def test_vectors_against_all_pairs(spark):
    draw = np.random.default_rng(3)
    centre = draw.normal(size=(12, 16))
    v = np.repeat(centre, 12, 0) + draw.normal(scale=0.09, size=(144, 16))
    rows = [(i, [float(x) for x in np.float32(row)], int(i % 2), "x") for i, row in enumerate(v)]
    rows += [(200, None, 0, ""), (201, [0.0] * 16, 0, ""), (202, [float("nan")] * 16, 0, ""), (203, [None] * 16, 0, ""),
             (204, rows[0][1], None, ""), (205, rows[0][1], 0, ""), (206, [2 * x for x in rows[0][1]], 0, ""), (207, [1.0], 0, ""), (208, [], 0, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string").repartition(4)
    got = {r["vec_id"]: r for r in embedding_dedup.duplicate_vectors(df, cell=20, chunk=16).collect()}
    unit = {}
    for i, e, label, _ in rows:
        if e and label is not None and all(x is not None and np.isfinite(x) for x in e) and any(e):
            x = np.array(np.float32(e), float)
            unit[i] = (label, x / np.linalg.norm(x))
    links = [
        (a, b) for a in unit for b in unit
        if a < b and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.98
    ]
    root = brute.groups([r[0] for r in rows], links)
    assert len(links) > 50
    for i, r in got.items():
        assert (r["n_links"], r["component_id"], r["kept"]) == (sum(i in x for x in links), root[i], root[i] == i)
    assert embedding_dedup.duplicate_vectors(df.limit(0)).collect() == []
