"""Filter audit, byte-level BPE and lexical search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import SMALL
from pyspark.sql import functions as F

from tallgrove.llm import byte_bpe, filter_audit, lexical_search, queries

FILE = "byte_bpe_multi_50k.tiktoken"


# ------------------------------------------------------------------ audit


def brute_audit(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)"""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts: dict[str, list] = {}
    for i, text, lang in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (x or "") == t for j, x, _ in rows),
        }
        parts.setdefault(lang or "", []).append((i, fails))
    out = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = list(docs)
            for k, name in enumerate(order):
                gone = [d for d in left if d[1][name]]
                left = [d for d in left if not d[1][name]]
                shapley[name] += len(gone)
                fail = [d for d in docs if d[1][name]]
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), len(fail) - len(gone), sum(sum(f.values()) == 1 for _, f in fail),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for order in permutations("ABCDE"):
            for k, name in enumerate(order):
                out[part, "".join(order), k + 1].append(shapley[name])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, lang string, kept int").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, marks).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (*filter_audit.MEASURES, "shapley")) for r in got}
    assert len(found) == len(got)
    return found


def test_audit_against_brute_force(spark):
    draw = random.Random(3)
    texts = [" ".join(draw.choice([f"w{k}", "Same", "BIG", "x#y", "é"]) for k in range(draw.choice([3, 99, 100, 130]))) for _ in range(40)]
    texts += [None, "", " \x0b ", "A" * 50_000, "a b\tc " * 40_000]
    rows = [(i, draw.choice(texts), draw.choice(["en", "de", None, ""])) for i in range(160)]
    # Copies across parts, ids that repeat with equal and other texts, null ids.
    rows += [(7, "one and the same", "en"), (7, "one and the same", "de"), (7, "other", "en"), (900, "other", "xx"), (None, "other", "en"), (None, "", None)]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 160, 2)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (5000, 1, 1)]
    assert audited(spark, rows, labels) == brute_audit(rows, labels)


def test_audit_edge_tables(spark):
    assert audited(spark, [], []) == {}
    one = audited(spark, [(1, None, None)], [])
    assert len(one) == 600 and one["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_audit_sums_of_sums(spark, monkeypatch):
    """More parts than a task holds at once."""
    monkeypatch.setattr(filter_audit, "PARTS_HELD", 2)
    rows = [(i, "x" * (i % 5), f"p{i % 9}") for i in range(90)]
    assert audited(spark, rows, []) == brute_audit(rows, [])


def test_packed_fields_do_not_run_over():
    counters = filter_audit.Counters("ABC")
    many = (1 << 62) // 3
    total = sum(counters.packed[code] * many for code in (3, 7 * 4 + 3, 4 + 1))
    counts, documents = counters.unpack(total)
    assert documents == 3 * many
    assert (counts[:, :, 0].min(), counts[:, :, 1].max()) == (many, 2 * many)


# -------------------------------------------------------------------- bpe


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path(FILE))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    draw = random.Random(1)
    texts = [
        None, "", "a", " ", "  a", "\x1c\x1d x\x85y  z", "I'll we've 'tis <|endoftext|>", "日本語の文章" * 300,
        "." * 1000 + " " * 777 + "q", "\U0001f600\U0001f601 hi \U00020000", "é", "x" * 3000, "abc" * 2000, "word " * 30_000,
    ]
    texts.append("".join(draw.choice("ACGT") for _ in range(5000)))
    for _ in range(150):
        kinds = [lambda: draw.randrange(32, 127), lambda: draw.randrange(0x800), lambda: draw.randrange(0xE000, 0x110000), lambda: 32]
        texts.append("".join(chr(draw.choice(kinds)()) for _ in range(draw.randrange(1, 60))))
    return texts


@pytest.mark.parametrize("most", [byte_bpe.MOST_WORDS, 0])
def test_bpe_against_the_library(spark, ranks, library, most):
    rows = [(i, t, 1) for i, t in enumerate(odd_texts())] + [(None, "twice", None), (None, "twice", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids int").repartition(8)
    coded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, most)
    got = coded.select("text", "token_ids", byte_bpe.decode(F.col("token_ids"), ranks).alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["token_ids"] == library.encode_ordinary(r["text"] or "")
        assert bytes(r["back"]) == (r["text"] or "").encode()


def test_bpe_of_an_empty_table(spark, ranks):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).collect() == []


def test_every_token_is_its_own_encoding(ranks, library):
    """What joining windows at a common token rests on."""
    assert all(library._core_bpe.encode_single_piece(piece) == [rank] for piece, rank in ranks.items())


def test_every_character_splits_as_in_the_library(library):
    words = byte_bpe.splitter(public_tokenizers.PATTERN)()
    for first in range(0, 0x110000, 4096):
        text = "".join(f"a{chr(c)}1 {chr(c)}" for c in range(first, first + 4096) if not 0xD800 <= c < 0xE000)
        ids = [i for w in words(text) for i in library._core_bpe.encode_single_piece(w.encode())]
        assert ids == library.encode_ordinary(text), hex(first)


def test_bpe_query_against_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op12_byte_bpe(spark, SMALL).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_digests_stay_in_arrow(spark, ranks, library, monkeypatch):
    """Words known and not, rows without text, ids taken in several parts: the digests are those of the ids."""
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 8)
    texts = [None, "", "new1 old old", "old" * 3, "new2 new3 new2 old", None, "q", " " * 9 + "new4"]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int").repartition(2)
    coded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, derive=byte_bpe.digests(ranks), **byte_bpe.DIGESTS)
    assert coded.columns == ["doc_id", "text", "token_ids", *byte_bpe.DIGESTS]
    for r in coded.collect():
        ids = library.encode_ordinary(r["text"] or "")
        assert (r["token_ids"], r["n_tokens"]) == (ids, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_bpe_digests_of_a_row_taken_in_parts(ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "TAKEN", 3)
    texts = ["", "a b c d e f g h", "été " * 40]
    coded = [library.encode_ordinary(t) for t in texts]
    got = byte_bpe.digests(ranks)(pa.array(coded, pa.list_(pa.int32())))
    assert got["n_tokens"].to_pylist() == [len(c) for c in coded]
    assert got["ids_sha256"].to_pylist() == [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in coded]
    assert got["decoded_sha256"].to_pylist() == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_ids_of_own_words_take_their_places():
    """Sliced batches too; a word may stand twice, have no place, or many ids."""
    tokens = pa.array([[9], [-1, 5, -2, -1], [], [-2, -1]], pa.list_(pa.int32()))
    words = pa.array([[], [[1, 2], [3]], [], [[7], [4, 4, 4]]], pa.list_(pa.list_(pa.int32())))
    want = [[9], [1, 2, 5, 3, 1, 2], [], [4, 4, 4, 7]]
    assert byte_bpe.put_in(tokens, words).to_pylist() == want
    assert byte_bpe.put_in(tokens.slice(1, 3), words.slice(1, 3)).to_pylist() == want[1:]


# ----------------------------------------------------------------- search


def brute_search(docs, items, top=10):
    words = [(i, Counter(lexical_search.terms(t))) for i, t in docs]
    words = [(i, c) for i, c in words if c]
    total, length = len(words), sum(c.total() for _, c in words)
    df = Counter(t for _, c in words for t in c)
    out = []
    for item, text in items:
        asked, scored = lexical_search.terms(text), []
        for i, c in words:
            m = 25 + 75 * c.total() * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in asked if t in c
            )
            if score:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("item_bytes,block", [(1 << 20, 1024), (200, 7)])
def test_search_against_brute_force(spark, monkeypatch, item_bytes, block):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    monkeypatch.setattr(lexical_search, "STEP", 3)
    draw = random.Random(8)
    vocabulary = ["the", "The", "été", "x1", "ÉTÉ", *(f"t{k}" for k in range(90))]
    common = [2.0 ** -(k / 9) for k in range(len(vocabulary))]
    docs = [(i, " ".join(draw.choices(vocabulary, common, k=draw.choice([1, 5, 40, 300])))) for i in range(150)]
    docs += [(200 + i, "t1 t2-t3, the") for i in range(30)]  # ties
    docs += [(500, None), (501, ""), (502, "?!"), (None, "t1 t2-t3, the"), (3, "t1 t2-t3, the"), (900, "t5 " * 50_000)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([1, 4, 30, 90])))) for k in range(25)]
    items += [(60, None), (61, "..."), (62, "nowhere"), (None, "t1 t2 t2"), (4, "the the T1"), (4, "the the T1")]
    given = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int").repartition(4)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    got = [tuple(r) for r in lexical_search.search(given, asked, item_bytes=item_bytes).collect()]
    assert sorted(got, key=str) == brute_search(docs, items)
    assert lexical_search.search(given.limit(0), asked).collect() == []
    assert lexical_search.search(given, asked.limit(0)).collect() == []
