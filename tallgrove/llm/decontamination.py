"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton is built over word numbers of the normalised items. Documents stream past
it: whole batches are hashed, runs of words that occur in no item are skipped, and the
rest is walked word by word with the length of the longest match that ends there. Where
that length reaches the window, the window's words are hit.

The benchmark's size is measured before it leaves the executors. It is cut into groups of
at most ``group_bytes`` of text; each group becomes one broadcast automaton and one map over the
documents, which passes its hits on as a column. No document is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrove.llm.frames import ready, schema_with, without
from tallgrove.llm.words import ALNUM, words
from tallgrove.operators.sampling import exact_share

WINDOW = 13
GROUP_BYTES = 16_000_000
OUTPUT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
HITS = "struct<spans:binary,items:array<string>>"


class SuffixAutomaton:
    """States of all substrings of the items; which items and short items end where."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int) -> None:
        """items: (id, word hashes). Items without words are left out."""
        self.window = window
        items = [(name, row) for name, row in items if len(row)]
        self.vocabulary = np.unique(np.concatenate([row for _, row in items])) if items else np.zeros(0, np.uint64)
        self.least = min([window, *(len(row) for _, row in items)])
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, ends = [-1], [0], [-1]
        names: list[str] = []
        self.shared: dict[int, list[str]] = {}
        whole: dict[int, list[tuple[int, str]]] = {}
        for name, row in items:
            last = 0
            numbers = np.searchsorted(self.vocabulary, row).tolist()
            for word in numbers:
                last = self._extend(last, word)
                ends.extend([-1] * (len(self.next) - len(ends)))
                names.append(name)
                if ends[last] < 0:
                    ends[last] = len(names) - 1
                else:  # another item with the same prefix ends in this state
                    self.shared.setdefault(last, []).append(name)
            if len(numbers) < window:
                whole.setdefault(last, []).append((len(numbers), name))
        self._order(ends, names)
        #: Nearest state on the suffix path (itself included) at which a short item is complete.
        self.complete = whole
        self.nearest = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            above = self.link[state]
            self.nearest[state] = state if state in whole else (self.nearest[above] if above >= 0 else -1)
        self._of: dict[int, frozenset[str]] = {}

    def _extend(self, last: int, word: int) -> int:
        follow, link, length = self.next, self.link, self.length
        if word in follow[last]:
            to = follow[last][word]
            if length[to] == length[last] + 1:
                return to
            return self._split(last, word, to)
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and word not in follow[at]:
            follow[at][word] = new
            at = link[at]
        if at >= 0:
            to = follow[at][word]
            link[new] = to if length[to] == length[at] + 1 else self._split(at, word, to)
        return new

    def _split(self, at: int, word: int, to: int) -> int:
        """Give the suffixes of ``to`` up to ``at`` plus word a state of their own."""
        copy = len(self.next)
        self.next.append(dict(self.next[to]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[to])
        self.link[to] = copy
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _order(self, ends: list[int], names: list[str]) -> None:
        """Lay the link tree out so that the items below a state are one range."""
        children: list[list[int]] = [[] for _ in self.next]
        for state, above in enumerate(self.link):
            if above >= 0:
                children[above].append(state)
        ends.extend([-1] * (len(self.next) - len(ends)))
        self.items: list[str] = []
        self.range: list[tuple[int, int]] = [(0, 0)] * len(self.next)
        stack = [(0, False)]
        while stack:
            state, left = stack.pop()
            if left:
                self.range[state] = (self.range[state][0], len(self.items))
                continue
            self.range[state] = (len(self.items), 0)
            if ends[state] >= 0:
                self.items.append(names[ends[state]])
                self.items.extend(self.shared.get(state, ()))
            stack.append((state, True))
            stack.extend((child, False) for child in children[state])

    def holders(self, state: int) -> frozenset[str]:
        """Items that contain the strings of a state."""
        found = self._of.get(state)
        if found is None:
            at, to = self.range[state]
            found = self._of[state] = frozenset(self.items[at:to])
        return found

    def walk(self, numbers: list[int], at: int, spans: list[tuple[int, int]], found: set[str]) -> None:
        """Stream word numbers; add hit spans (from ``at`` on) and the items of windows that occur."""
        follow, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i, word in enumerate(numbers, at):
            while state and word not in follow[state]:
                state = link[state]
                matched = length[state]
            if word not in follow[state]:
                continue
            state = follow[state][word]
            matched += 1
            if matched >= window:
                holder = state
                while length[link[holder]] >= window:
                    holder = link[holder]
                spans.append((i - window + 1, i + 1))
                found |= self.holders(holder)
            short = self.nearest[state]
            while short >= 0:
                for n, name in self.complete[short]:
                    if n <= matched:
                        spans.append((i - n + 1, i + 1))
                        found.add(name)
                above = link[short]
                short = self.nearest[above] if above >= 0 else -1


def united(spans: np.ndarray) -> np.ndarray:
    """Sorted, disjoint spans with the same union."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    return np.stack([spans[first, 0], np.maximum.reduceat(spans[:, 1], first)], 1)


def scan(automaton: SuffixAutomaton, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, set[str]]]:
    """(row, words, hit spans, items) of each text."""
    vocabulary, least = automaton.vocabulary, automaton.least
    for w in words(texts, ALNUM):
        counts = w.counts()
        firsts = np.cumsum(counts) - counts
        hits: dict[int, tuple[list, set]] = {}
        if len(vocabulary) and len(w.hash):
            number = np.minimum(np.searchsorted(vocabulary, w.hash), len(vocabulary) - 1)
            known = vocabulary[number] == w.hash
            starts = np.r_[True, w.doc[1:] != w.doc[:-1]]
            opens = np.flatnonzero(known & (starts | np.r_[True, ~known[:-1]]))
            closes = np.flatnonzero(known & np.r_[starts[1:] | ~known[1:], True]) + 1
            long = closes - opens >= least
            for a, b in zip(opens[long].tolist(), closes[long].tolist(), strict=True):
                row = int(w.doc[a])
                spans, found = hits.setdefault(row, ([], set()))
                automaton.walk(number[a:b].tolist(), a - int(firsts[row]), spans, found)
        for row in range(w.rows):
            spans, found = hits.get(row, ((), set()))
            yield w.first + row, int(counts[row]), united(np.array(spans, np.int64).reshape(-1, 2)), found


def item_groups(items: DataFrame, group_bytes: int) -> list[list]:
    """The items' rows in groups whose texts have at most ``group_bytes`` bytes, or one longer text."""
    size = F.octet_length(F.coalesce("text", F.lit("")))
    groups, total = [], items.agg(F.sum(size)).first()[0] or 0
    if total <= group_bytes:
        return [items.select("item_id", "text").collect()]
    count = int(total // group_bytes) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        groups.append(items.filter(part == k).select("item_id", "text").collect())
    return groups


def automaton_of(rows: list, window: int) -> SuffixAutomaton:
    texts = pa.array([row["text"] for row in rows], pa.string())
    hashes: list[np.ndarray] = []
    for w in words(texts, ALNUM):
        hashes.extend(np.split(w.hash, np.cumsum(w.counts())[:-1]))
    return SuffixAutomaton([("" if r["item_id"] is None else str(r["item_id"]), h) for r, h in zip(rows, hashes)], window)


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``docs`` with n_words, and _hits: the hit word spans (int64 pairs) and the items that occur."""
    context = ready(docs.sparkSession).sparkContext
    df = docs.withColumn("n_words", F.lit(0).cast("long")).withColumn("_hits", F.lit(None).cast(HITS))
    for rows in item_groups(items, group_bytes):
        known = context.broadcast(automaton_of(rows, window))

        def step(batches, known=known):
            automaton = known.value
            for batch in batches:
                table = pa.Table.from_batches([batch])
                before = table.column("_hits").to_pylist()
                counts, merged = [], []
                for row, n, spans, found in scan(automaton, table.column("text")):
                    counts.append(n)
                    if before[row] is not None:
                        old = np.frombuffer(before[row]["spans"], np.int64).reshape(-1, 2)
                        spans, found = united(np.concatenate([old, spans])), found | set(before[row]["items"])
                    merged.append({"spans": spans.astype(np.int64).tobytes(), "items": sorted(found)} if found else None)
                kind = table.schema.field("_hits").type
                table = table.set_column(table.schema.get_field_index("n_words"), "n_words", pa.array(counts, pa.int64()))
                table = table.set_column(table.schema.get_field_index("_hits"), "_hits", pa.array(merged, kind))
                yield from table.to_batches()

        df = df.mapInArrow(step, df.schema)
    return df


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, least_share: float = 0.05, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256, contaminated and clean_text.

    A document is contaminated if at least ``least_share`` of its words (and at least one) are
    hit. ``clean_text`` is the text without the hit spans. A null or empty text has no words and
    is clean; items that are null or have no words are ignored; a null item id reads as ''; equal
    ids count once. Empty tables give no rows or no hits. Input columns named like an output
    column are replaced.
    """
    names = without(docs, *OUTPUT, "clean_text").columns
    found = hits(without(docs, *OUTPUT, "clean_text"), items, window, group_bytes)
    share = exact_share(least_share)
    part, whole = share.numerator, share.denominator
    schema = schema_with(
        found.select(*names, "n_words"), n_hit="long", n_items="long", items_sha256="string", contaminated="boolean",
        clean_text="string",
    )
    out = schema.names

    def finish(batches):
        for batch in batches:
            spans, lists, texts = [], batch.column("_hits").to_pylist(), batch.column("text")
            total = batch.column("n_words").to_pylist()
            spans = [np.frombuffer(h["spans"], np.int64).reshape(-1, 2) if h else np.zeros((0, 2), np.int64) for h in lists]
            n_hit = [int((s[:, 1] - s[:, 0]).sum()) for s in spans]
            items_of = [h["items"] if h else [] for h in lists]
            digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items_of]
            clean = [cut(t, s) if len(s) else t for t, s in zip(texts.to_pylist(), spans)]
            columns = [batch.column(n) for n in names] + [
                batch.column("n_words"),
                pa.array(n_hit, pa.int64()),
                pa.array([len(x) for x in items_of], pa.int64()),
                pa.array(digest, pa.string()),
                pa.array([h > 0 and whole * h >= part * n for h, n in zip(n_hit, total)], pa.bool_()),
                pa.array(clean, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=out)

    return found.mapInArrow(finish, schema)


def cut(text: str, spans: np.ndarray) -> str:
    """The text without the words of the spans and what stands between them."""
    w = next(words(pa.array([text]), ALNUM, len(text) * 4 + 1))
    data, at, kept = text.encode(), 0, []
    for first, last in spans.tolist():
        kept.append(data[at : w.start[first]])
        at = int(w.end[last - 1])
    return b"".join([*kept, data[at:]]).decode()
