"""The pipeline against brute force, its stages on odd tables, and the library without this package."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import brute
import pytest
from conftest import SMALL

import corpus_pipeline
from tallgrove.llm import near_dedup, oracle, queries

ROOT = Path(__file__).resolve().parents[2]


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs if r["text"] and any(c.isalpha() for c in r["text"])}
    texts = {i: v[2] for i, v in brute.lines(texts).items()}
    texts = {i: texts[i] for i, v in brute.near(texts, percent=80).items() if v[2]}
    texts = {i: texts[i] for i, v in brute.contamination(texts, items).items() if not v[4]}
    source = {r["doc_id"]: r["source"] for r in docs}
    want = {i: v for i, v in brute.mixing([(i, source[i], t) for i, t in texts.items()]).items() if v[3]}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"]: (r["text"], r["n_chars"], r["taken"]) for r in got} == {
        i: (texts[i], len(texts[i]), v[3]) for i, v in want.items()
    }


ODD = [
    (1, None, None, None, None, 1, "s"), (2, "", "en", "a", 0, 1, "s"), (3, "12 !", "en", "a", 3, 1, "s"),
    (None, "the cat sat on the mat there", "en", None, 5, 1, "s"), (4, "the cat sat on the mat there", "en", "a", 5, 1, "s"),
    (4, "the cat sat on the mat there", "en", "a", 5, 1, "s"), (5, "die Katze " * 4000, "de", "b", 5, 1, "s"),
]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_tables(spark, name, stage):
    """Nulls, repeated rows, long texts and columns named like what the operators make."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, kept_text string"
    docs = spark.createDataFrame(ODD, schema)
    out = stage(spark, docs, SMALL)
    rows = out.collect()
    assert out.columns[: len(docs.columns)] == docs.columns
    assert {r["doc_id"] for r in rows} >= {5} and all(r["score"] == 1 and r["kept_text"] == "s" for r in rows)
    if name == "language_id":
        assert sorted(str(r["doc_id"]) for r in rows) == ["4", "4", "5", "None"]
    if name == "line_dedup":
        assert len(rows) == len(ODD)
    assert stage(spark, docs.limit(0), SMALL).collect() == []


def test_near_stage_links_from_80_percent(spark):
    """Pairs with 41 of 50 shingles in common (0.82) go; pairs with 39 of 50 (0.78) stay, as do those of op9 at 0.82."""
    def pair(i: int, common: int) -> list[str]:
        ends = 50 - common  # shingles of either text alone, half of them each
        same = [f"w{i}x{k}" for k in range(common + 4)]
        return [" ".join([f"l{i}x{k}" for k in range(ends // 2)] + same), " ".join(same + [f"r{i}x{k}" for k in range(ends - ends // 2)])]

    texts = dict(enumerate(t for i in range(20) for t in pair(i, 41 if i < 10 else 39)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = {i for i, v in brute.near(texts, 80).items() if v[2]}
    assert len(want) == 30
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()} == want
    assert near_dedup.near_duplicates(docs).filter("kept").count() == 40
    assert (near_dedup.trees_for(85), near_dedup.trees_for(80)) == (12, 17)
    assert all((1 - (p / 100) ** 4) ** near_dedup.trees_for(p) <= 0.00015 for p in range(45, 100))


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(oracle.ORACLE) <= set(queries.QUERIES)


def test_library_without_this_package(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'auc' in q and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
