"""Language of texts by a linear-chain conditional random field over their words.

A word's features are its letter n-grams, its affixes and the lexicons it stands in, hashed into
``BUCKETS`` weights a label; neighbouring words are tied by learned transitions. Forward-backward gives every
word of the whole text its labels' probabilities, also where languages change inside a text; a text's language
is the one with the largest mean. Chains are cut after ``CHAIN`` words, so that all chains of a batch are
run side by side as arrays.

The model is fitted on the driver, on at most ``SAMPLE`` texts a language and ``PER_TEXT`` chains of each, both
chosen by hash and position over all labelled rows; everything else is a map.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrove.llm.frames import ready, schema_with, stored, without
from tallgrove.llm.words import ALNUM, BASE, Words, mix, powers, words

SAMPLE = 240
PER_TEXT = 4
CHAIN = 64
BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
AFFIXES = (1, 2, 3)
LEXICON = 400
ROUNDS = 30
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
OUTPUT = ("lang_pred", "score")


class Features(NamedTuple):
    word: np.ndarray
    bucket: np.ndarray


def strings(w: Words, start: np.ndarray, length: int, kind: int, sums: np.ndarray) -> np.ndarray:
    down = powers(len(w.data) + 1)[1]
    code = (sums[start + length] - sums[start]) * down[start] + np.uint64(kind * 0x51ED270B)
    return (mix(code * np.uint64(BASE)) % np.uint64(BUCKETS)).astype(np.int32)


def features(w: Words, chosen: np.ndarray) -> Features:
    """N-grams and affixes of the chosen words, as (place in chosen, bucket) pairs."""
    up = powers(len(w.data) + 1)[0]
    sums = np.zeros(len(w.data) + 1, np.uint64)
    np.cumsum((w.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    start, end = w.start[chosen], w.end[chosen]
    size = end - start
    of, bucket = [], []
    for n in GRAMS:
        count = np.maximum(size - n + 1, 0)
        word = np.repeat(np.arange(len(chosen)), count)
        at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(len(word))
        of.append(word)
        bucket.append(strings(w, at, n, n, sums))
    for n in AFFIXES:
        word = np.flatnonzero(size >= n)
        of += [word, word]
        bucket += [strings(w, start[word], n, 10 + n, sums), strings(w, end[word] - n, n, 20 + n, sums)]
    return Features(np.concatenate(of), np.concatenate(bucket))


class Lexicon(NamedTuple):
    """Frequent words' hashes in order, and how their uses are shared out among the labels."""

    keys: np.ndarray
    shares: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(hashes), self.shares.shape[1]))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            known = self.keys[at] == hashes
            out[known] = self.shares[at[known]]
        return out


class Model(NamedTuple):
    labels: list[str]
    weights: np.ndarray  # labels x BUCKETS
    lexicon: Lexicon
    lexicon_weights: np.ndarray  # labels x labels
    transitions: np.ndarray
    opening: np.ndarray

    def emissions(self, w: Words) -> np.ndarray:
        """Scores of each word's labels; each distinct word is looked at once."""
        hashes, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        found = features(w, first)
        scores = np.stack(
            [np.bincount(found.word, row[found.bucket], len(first)) for row in self.weights], 1
        )
        return (scores + self.lexicon.of(hashes) @ self.lexicon_weights)[inverse]


class Chains:
    """Words laid out as rows of at most CHAIN neighbours of one text."""

    def __init__(self, doc: np.ndarray) -> None:
        n = len(doc)
        opens = np.r_[True, doc[1:] != doc[:-1]] if n else np.zeros(0, bool)
        first = np.flatnonzero(opens)
        place = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
        self.step = place % CHAIN
        self.chain = np.cumsum(self.step == 0) - 1
        self.length = np.bincount(self.chain, minlength=0)

    def marginals(self, scores: np.ndarray, transitions: np.ndarray, opening: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Forward-backward: labels' probabilities of each word, expected transitions, log partition."""
        n, labels = len(self.length), scores.shape[1]
        top = scores.max(1)
        seen = np.ones((CHAIN, n, labels))
        seen[self.step, self.chain] = np.exp(scores - top[:, None])
        move = np.exp(transitions)
        steps = int(self.length.max(initial=0))
        ahead, scale = np.zeros((steps, n, labels)), np.ones((steps, n))
        for t in range(steps):
            ahead[t] = (np.exp(opening) if t == 0 else ahead[t - 1] @ move) * seen[t]
            scale[t] = ahead[t].sum(1)
            ahead[t] /= scale[t][:, None]
        back = np.ones((steps, n, labels))
        both = np.zeros((labels, labels))
        for t in range(steps - 2, -1, -1):
            inner = (self.length > t + 1)[:, None]
            after = seen[t + 1] * back[t + 1] / scale[t + 1][:, None]
            both += (np.where(inner, ahead[t], 0).T @ np.where(inner, after, 0)) * move
            back[t] = np.where(inner, after @ move.T, 1.0)
        chances = (ahead * back)[self.step, self.chain]
        total = float(np.log(scale[self.step, self.chain]).sum() + top.sum())
        return chances / chances.sum(1, keepdims=True), both, total


def fit(rows: list[tuple[str, str]], rounds: int = ROUNDS, penalty: float = 1e-4) -> Model | None:
    """From (label, chain of words) rows; lexicons come from one half, weights from the other."""
    rows = sorted(rows)
    labels = sorted({label for label, _ in rows})
    if not labels:
        return None
    number = {label: i for i, label in enumerate(labels)}
    k = len(labels)
    lexicon = lexicon_of([r for r in rows[::2]], number)
    rest = rows[1::2] or rows
    w = next(words(pa.array([text for _, text in rest]), ALNUM, 1 << 40))
    truth = np.array([number[label] for label, _ in rest])[w.doc]
    hashes, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
    found, listed = features(w, first), lexicon.of(hashes)
    model = Model(labels, np.zeros((k, BUCKETS)), lexicon, np.zeros((k, k)), np.zeros((k, k)), np.zeros(k))
    chains = Chains(w.doc)
    same = chains.step[1:] > 0
    moves = np.zeros((k, k))
    np.add.at(moves, (truth[:-1][same], truth[1:][same]), 1)
    opens = np.bincount(truth[chains.step == 0], minlength=k)
    parts = [model.weights, model.lexicon_weights, model.transitions, model.opening]
    squares = [np.full_like(p, 1e-8) for p in parts]
    for _ in range(rounds):
        scores = (
            np.stack([np.bincount(found.word, row[found.bucket], len(first)) for row in parts[0]], 1) + listed @ parts[1]
        )[inverse]
        chance, both, _ = chains.marginals(scores, parts[2], parts[3])
        away = -chance
        away[np.arange(len(truth)), truth] += 1
        by_word = np.stack([np.bincount(inverse, away[:, j], len(first)) for j in range(k)], 1)
        slopes = [
            np.stack([np.bincount(found.bucket, by_word[found.word, j], BUCKETS) for j in range(k)]),
            listed.T @ by_word,
            moves - both,
            opens - chance[chains.step == 0].sum(0),
        ]
        for part, slope, square in zip(parts, slopes, squares):
            slope = slope / len(truth) - penalty * part
            square += slope**2
            part += 0.3 * slope / np.sqrt(square)
    return model


def lexicon_of(rows: list[tuple[str, str]], number: dict[str, int]) -> Lexicon:
    w = next(words(pa.array([text for _, text in rows]), ALNUM, 1 << 40))
    label = np.array([number[name] for name, _ in rows])[w.doc]
    hashes, inverse = np.unique(w.hash, return_inverse=True)
    uses = np.stack([np.bincount(inverse[label == j], minlength=len(hashes)) for j in range(len(number))], 1)
    picked = np.unique(np.concatenate([np.argsort(-uses[:, j], kind="stable")[:LEXICON] for j in range(len(number))]))
    picked = picked[uses[picked].sum(1) >= 3]
    return Lexicon(hashes[picked], uses[picked] / uses[picked].sum(1, keepdims=True))


def training_chains(labelled: DataFrame, sample: int, per_text: int) -> list[tuple[str, str]]:
    """Bounded sample of (label, chain): texts by hash of their id, chains spread over the whole text."""
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 30) - 1))
    # Counts by (lang, eighth of an octave of the draw): a few hundred rows a language tell the least draw
    # below which it has enough texts, so the map that follows keeps about ``sample`` of them.
    step = F.floor(F.log2(draw + 1) * 8).cast("int")
    counts = usable.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    bounds: dict[str, int] = {}
    for lang in {r["lang"] for r in counts}:
        total = 0
        for n, at in sorted((r["step"], r["n"]) for r in counts if r["lang"] == lang):
            bounds[lang], total = n, total + at
            if total >= sample:
                break
    if not bounds:
        return []
    bound = F.element_at(F.from_json(F.lit(json.dumps(bounds)), "map<string,int>"), F.col("lang"))
    near = usable.filter(step <= bound).select("lang", "doc_id", "text", draw.alias("_draw"))
    order = Window.partitionBy("lang").orderBy("_draw", "doc_id")
    chosen = near.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= sample).select("lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, chains = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                all_words = text.split()
                pieces = [all_words[i : i + CHAIN] for i in range(0, len(all_words), CHAIN)]
                spread = {round(i * (len(pieces) - 1) / max(1, per_text - 1)) for i in range(per_text)} if pieces else ()
                for i in sorted(spread):
                    names.append(lang)
                    chains.append(" ".join(pieces[i]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(chains, pa.string())], names=["lang", "chain"])

    rows = stored(chosen.mapInArrow(cut, "lang string, chain string"), "language-sample").collect()
    return [(r["lang"], r["chain"]) for r in rows if any(c.isalnum() for c in r["chain"])]


def train(labelled: DataFrame, sample: int = SAMPLE, per_text: int = PER_TEXT) -> Model | None:
    """A model of all ``lang`` values of (doc_id, text, lang) rows; None if nothing is labelled."""
    ready(labelled.sparkSession)
    return fit(training_chains(labelled.select("doc_id", "text", "lang"), sample, per_text))


def identify(docs: DataFrame, model: Model | None, spans: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score (the mean probability), judged by ``text`` alone.

    Null texts and those without a letter are 'und' with score 0, as is every text without a model. With ``spans`` a column
    of (start, end, lang) byte ranges tells where languages change. An empty table gives no rows. Input columns
    named like the output are replaced.
    """
    known = ready(docs.sparkSession).sparkContext.broadcast(model)
    base = without(docs, *OUTPUT, *(["spans"] if spans else []))
    names = base.columns
    schema = schema_with(
        base, lang_pred="string", score="double",
        **({"spans": "array<struct<start:bigint,end:bigint,lang:string>>"} if spans else {}),
    )
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
    out = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        for batch in batches:
            texts = batch.column("text")
            label: list[str] = [UNKNOWN] * batch.num_rows
            score = np.zeros(batch.num_rows)
            ranges: list[list] = [[] for _ in label]
            lettered = [bool(t) and LETTER.search(t) is not None for t in texts.to_pylist()]
            for w in words(texts, ALNUM) if model else ():
                if not len(w.hash):
                    continue
                chance, _, _ = Chains(w.doc).marginals(model.emissions(w), model.transitions, model.opening)
                counts = w.counts()
                mean = np.stack([np.bincount(w.doc, c, w.rows) for c in chance.T], 1) / np.maximum(counts, 1)[:, None]
                best = mean.argmax(1)
                for i in np.flatnonzero(counts).tolist():
                    if lettered[w.first + i]:
                        label[w.first + i] = model.labels[best[i]]
                        score[w.first + i] = min(1.0, mean[i, best[i]])
                if spans:
                    of = chance.argmax(1)
                    change = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (w.doc[1:] != w.doc[:-1])])
                    for a, b in zip(change, np.r_[change[1:], len(of)]):
                        row = int(w.doc[a])
                        if lettered[w.first + row]:
                            at = int(w.bounds[row])
                            ranges[w.first + row].append(
                                {"start": int(w.start[a]) - at, "end": int(w.end[b - 1]) - at, "lang": model.labels[of[a]]}
                            )
            columns = [batch.column(n) for n in names] + [pa.array(label, pa.string()), pa.array(score)]
            if spans:
                columns.append(pa.array(ranges, kind))
            yield pa.RecordBatch.from_arrays(columns, names=out)

    return base.mapInArrow(run, schema)


def held_out(identity: Column, parts: int = 4, part: int = 2) -> Column:
    """By the checksum of the id as text; a null id reads as ''."""
    return F.crc32(F.coalesce(identity.cast("string"), F.lit(""))) % parts == part


def reject_unknown(docs: DataFrame, languages: Iterable[str] | None = None) -> DataFrame:
    """``docs`` less the rows that are in none of ``languages`` by a model learned from their own labels.

    By default the languages are those that rows are labelled with. The model judges the rows without a label and
    those labelled with a language that is not asked for; a label that is asked for is kept without a
    judgement. A row that nothing is known of ('und': null texts and those without a letter) goes, whatever its label.
    No score is asked for: in a text of several languages the best mean is low however sure each word is. Where
    nothing is labelled, only null texts and those without a letter go.
    """
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    base = without(docs, *OUTPUT)
    if model:
        wanted = sorted(languages) if languages is not None else list(model.labels)
        known = F.col("lang_pred") != UNKNOWN
        keeps = F.col("lang").isin(wanted) if languages is not None else F.col("lang").isNotNull()
        return identify(base, model).filter(known & (F.coalesce(keeps, F.lit(False)) | F.col("lang_pred").isin(wanted))).drop(*OUTPUT)

    def lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(t) and LETTER.search(t) is not None for t in batch.column("text").to_pylist()], pa.bool_()))

    return base.mapInArrow(lettered, base.schema)
