"""Decontamination, mixing, scores and languages against brute force."""

from __future__ import annotations

import itertools
import random

import brute
import numpy as np
import pytest
from conftest import CHECK, SMALL
from pyspark.sql import functions as F

from tallgrove.llm import decontamination, language_id, lm_scoring, mixing, queries
from tallgrove.llm.language_id import CHAIN, Chains

WORDS = ["alpha", "Beta", "gamma", "delta", "été", "x1", "o", "zeta"]


def texts_and_items(seed: int):
    draw = random.Random(seed)
    items = [(k, " ".join(draw.choices(WORDS, k=draw.choice([1, 3, 6, 9, 20])))) for k in range(12)]
    items += [(50, None), (51, "..."), (items[0][0], items[0][1]), (None, "delta delta delta delta")]
    texts: dict[int, str | None] = {0: None, 1: "", 2: "!?"}
    for i in range(3, 40):
        words = draw.choices(WORDS, k=draw.randint(1, 30))
        if draw.random() < 0.4:
            words += (draw.choice(items)[1] or "").split(" ")
        texts[i] = ", ".join(words)
    return texts, items


@pytest.mark.parametrize("group_bytes", [10**6, 60])
def test_decontamination(spark, group_bytes):
    texts, items = texts_and_items(4)
    docs = spark.createDataFrame([(i, t, 7) for i, t in texts.items()], "doc_id long, text string, n_hit int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(docs, bench, window=5, group_bytes=group_bytes).collect()
    want = brute.contamination(texts, [("" if k is None else k, t) for k, t in items], window=5)
    assert {r["doc_id"]: tuple(r[c] for c in decontamination.OUTPUT) for r in got} == want
    for r in got:
        assert len(brute.alnum(r["clean_text"])) == r["n_words"] - r["n_hit"]
    empty = decontamination.decontaminate(docs, bench.limit(0)).collect()
    assert len(empty) == len(texts) and not any(r["contaminated"] for r in empty)


def mixed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, target int")
    return mixing.mix(df).collect()


@pytest.mark.parametrize("share,least", [(0.3, 3), (0.08, 1), (0.7, 7), (1 / 3, 4), (0.05, 1), (1.0, 10)])
def test_contamination_share_is_exact(spark, share, least):
    """Of ten words the share asked for, not the nearest 1/n."""
    hit = "p q r s t u v w x y".split()
    rows = [(k, " ".join(hit[:k] + [f"z{i}" for i in range(10 - k)])) for k in range(1, 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(hit[:k])) for k in range(1, 11)], "item_id long, text string")
    got = decontamination.decontaminate(docs, bench, least_share=share).collect()
    assert {r["doc_id"]: r["n_hit"] for r in got} == {k: k for k in range(1, 11)}
    assert {r["doc_id"] for r in got if r["contaminated"]} == set(range(least, 11))


def test_mixing(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice(["a", "b", "b", "b", "é", "Z", None]), "w " * draw.randint(0, 40), 1) for i in range(300)]
    rows += [(900, "big", "y z " * 3000, 1), (901, "none", None, 1), (902, "none", "", 1)]
    got = mixed(spark, rows)
    want = brute.mixing([r[:3] for r in rows])
    assert {r["doc_id"]: (r["size"], r["source_size"], r["taken"]) for r in got} == {i: (v[0], v[1], v[3]) for i, v in want.items()}
    for r in got:
        assert r["target"] == pytest.approx(want[r["doc_id"]][2])
        assert r["taken"] <= 2 * r["size"]
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixed(spark, rows)), key=str)


def test_mixing_edge_tables(spark):
    assert mixed(spark, [(1, "a", None, 0), (1, "a", None, 0)])[0]["taken"] == 0
    twice = mixed(spark, [(1, "a", "x y", 0), (1, "a", "x y", 0), (None, "b", "z", 0)])
    assert sum(r["taken"] for r in twice) == 7 and len(twice) == 3
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string, text string")).collect() == []


def test_mixing_stays_native(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = mixing.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("round_bytes", [10**9, 400])
def test_lm_base_scores(spark, round_bytes):
    texts, _ = texts_and_items(9)
    texts[99] = "new words " * 3
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, score int")
    train = docs.filter("doc_id <> 99")
    model = lm_scoring.Model(train, shard_bytes=200, round_bytes=round_bytes)
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, model).collect()}
    want, n = brute.base_scores(texts, lambda i: i != 99)
    for i, (tokens, known, base) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    # Seen text is likelier than by its words alone.
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())
    if round_bytes < 10**9:
        assert len(model.ranges) > 1
        one = {r["doc_id"]: r["score"] for r in lm_scoring.score(docs, lm_scoring.Model(train, 200)).collect()}
        assert {i: r["score"] for i, r in got.items()} == pytest.approx(one)


def test_lm_levels_read_back():
    keys = lm_scoring.mix(np.arange(4000, dtype=np.uint64))
    counts = np.random.default_rng(1).geometric(0.2, 4000) ** 2
    bits = np.frombuffer(lm_scoring.bloom(keys, counts), np.uint8)
    none = np.zeros(0, np.uint64)
    shards = lm_scoring.Shards(0, 1, 1, none, none.astype(np.int64), bits, np.array([0]), np.array([8 * len(bits)], np.uint64))
    found = shards.levels(keys)
    assert (found >= lm_scoring.level(counts)).all() and (found == lm_scoring.level(counts)).mean() > 0.97
    assert (shards.levels(lm_scoring.mix(np.arange(9000, 13000, dtype=np.uint64))) > 0).mean() < 0.03


def test_lm_without_training_text(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, lm_scoring.Model(docs.limit(0))).collect()}
    assert (got[2]["n_tokens"], got[2]["n_known"], got[2]["train_tokens"], got[2]["base_score"]) == (3, 0, 0, 0.0)


def test_language_accuracy_on_held_out_rows(spark):
    got = queries.op7_language_id(spark, CHECK)
    truth = spark.read.parquet(f"{CHECK}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").filter("held_out and lang is not null").collect()
    assert len(rows) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_rows(spark):
    rows = [(i, "the cat sat there " * 5, "en") for i in range(6)] + [(10 + i, "die Katze saß dort " * 5, "de") for i in range(6)]
    train = spark.createDataFrame([*rows, (50, None, "en"), (51, "x", None)], "doc_id long, text string, lang string")
    model = language_id.train(train)
    odd = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "12 34 !", 1), (4, "the cat 7", 1), (4, "the cat 7", 1), (5, "die Katze " * 500 + "the cat sat", 1)],
        "doc_id long, text string, score int",
    )
    got = language_id.identify(odd, model, spans=True).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 6 and [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and by[1]["score"] == 0.0
    assert by[4]["lang_pred"] == "en" and by[5]["lang_pred"] == "de" and by[5]["spans"][-1]["lang"] == "en"
    assert {r["lang_pred"] for r in language_id.identify(odd, None).collect()} == {"und"}
    assert language_id.train(train.limit(0)) is None
    assert language_id.identify(odd.limit(0), model).collect() == []


def test_unknown_languages_are_told_by_letters(spark):
    """A text of four languages in equal parts stays, and so do all lettered texts where nothing is labelled."""
    draw = random.Random(5)
    own = {lang: ["".join(draw.choice(letters) for _ in range(6)) for _ in range(40)] for lang, letters in zip("abcd", ("abcde", "fghij", "klmno", "pqrst"))}

    def text(lang: str) -> str:
        return " ".join(draw.choice(own[lang]) for _ in range(64))

    rows = [(i, text("abcd"[i % 4]), "abcd"[i % 4]) for i in range(120)]
    rows += [(200 + k, " ".join(text(lang) for lang in "abcd"), None) for k in range(3)] + [(300, "12 !", None), (301, None, "a"), (302, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = {*range(120), 200, 201, 202}
    assert {r["doc_id"] for r in language_id.reject_unknown(docs).collect()} == want
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in language_id.reject_unknown(bare).collect()} == want


def test_the_model_decides_which_languages_stay(spark):
    """Unlabelled rows and rows of other labels are judged by their text; no letter rule gives these rows."""
    en = ["the cat sat there and slept", "there the dog and the cat sat", "and there sat the old dog"]
    de = ["die Katze saß dort und schlief", "dort saßen der Hund und die Katze", "und der alte Hund saß dort"]
    rows = [(i, f"{en[i % 3]} " * 4, "en") for i in range(30)] + [(100 + i, f"{de[i % 3]} " * 4, "de") for i in range(30)]
    rows += [(200, "the cat and the dog sat there", None), (201, "die Katze und der Hund saßen dort", None), (202, "12 !", "en")]
    rows += [(203, "die Katze und der Hund saßen dort", "en"), (204, "the dog sat there and the cat slept", "de"), (205, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"] for r in language_id.reject_unknown(docs, ["en"]).collect()}
    assert got == {*range(30), 200, 203, 204}
    assert {r["doc_id"] for r in language_id.reject_unknown(docs).collect()} == {r[0] for r in rows} - {202, 205}


def test_language_sample_moves_no_other_text(spark):
    """The least draws of every label, found from counts; the texts that are shuffled are about as many as asked for."""
    rows = [(i, f"word{i} x", "hot" if i % 10 else "rare") for i in range(5000)] + [(9000, "only one", "one"), (9001, None, "one"), (9002, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    draw = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 30) - 1)).alias("d"))
    want = set()
    for lang in ("hot", "rare", "one"):
        want |= {(lang, r["text"]) for r in draw.filter(F.col("lang") == lang).orderBy("d").limit(50).collect()}
    assert set(language_id.training_chains(docs, 50, 4)) == want and len(want) == 101


def test_forward_backward_sums_over_all_paths():
    draw = np.random.default_rng(1)
    doc = np.array([0, 0, 0, 1, 2, 2])
    scores, moves, opening = draw.normal(size=(6, 3)), draw.normal(size=(3, 3)), draw.normal(size=3)
    chance, both, total = Chains(doc).marginals(scores, moves, opening)
    want, logs = np.zeros((6, 3)), 0.0
    for d in range(3):
        at = np.flatnonzero(doc == d)
        paths = list(itertools.product(range(3), repeat=len(at)))
        weight = np.array([
            np.exp(opening[p[0]] + sum(scores[i, y] for i, y in zip(at, p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))) for p in paths
        ])
        logs += np.log(weight.sum())
        for p, x in zip(paths, weight / weight.sum()):
            for i, y in zip(at, p):
                want[i, y] += x
    assert np.allclose(chance, want) and np.isclose(total, logs) and np.isclose(both.sum(), 3)
    assert CHAIN > 6
