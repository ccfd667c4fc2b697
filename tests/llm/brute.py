"""Plain Python versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

BLANK = " \t\n\x0b\x0c\r"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def spaced(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UPPER)) if w]


def alnum(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def groups(nodes: list, links: list[tuple]) -> dict:
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def repeats(texts: dict[int, str | None], length: int) -> dict[int, tuple]:
    data = {i: (t or "").encode() for i, t in texts.items()}
    seen = Counter(b[p : p + length] for b in data.values() for p in range(len(b) - length + 1))
    out = {}
    for i, b in data.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[i] = (len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


def lines(texts: dict[int, str | None], min_docs: int = 3, min_chars: int = 20) -> dict[int, tuple]:
    holders = defaultdict(set)

    def key(line):
        return line.strip(BLANK).translate(UPPER)

    for i, t in texts.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = {}
    for i, t in texts.items():
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out[i] = (len(all_lines), len(all_lines) - len(kept), "\n".join(kept))
    return out


def shingles(text: str | None) -> set:
    w = spaced(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near(texts: dict[int, str | None], percent: int = 85) -> dict[int, tuple]:
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = groups(ids, links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in ids}


def contamination(texts: dict[int, str | None], items: list[tuple], window: int = 13) -> dict[int, tuple]:
    windows = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(x) for x in windows}
    out = {}
    for i, t in texts.items():
        w, hit, found = alnum(t), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                names = windows.get(tuple(w[p : p + n]))
                if names:
                    hit.update(range(p, p + n))
                    found |= names
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def mixing(rows: list[tuple]) -> dict[int, tuple]:
    """rows: (doc_id, source, text)"""
    size = {i: len(spaced(t)) for i, _, t in rows}
    total = Counter()
    for i, s, _ in rows:
        total[s] += size[i]
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, list(names), 1.5 * sum(total.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] >= 2 * total[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= target[s]
            open_.remove(s)
    out = {}
    for s in names:
        mine = sorted((i for i, x, _ in rows if x == s), key=lambda i: int(hashlib.md5(f"11:{i}".encode()).hexdigest()[:15], 16))
        budget = math.floor(target[s] + 1e-9)
        whole, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for i in mine:
            part = max(0, min(size[i], rest))
            rest -= part
            out[i] = (size[i], total[s], target[s], whole * size[i] + part)
    return out


def base_scores(texts: dict[int, str | None], trained) -> tuple[dict[int, tuple], int]:
    def tokens(t):
        return [*spaced(t), "\n"]

    counts = Counter(w for i, t in texts.items() if trained(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)))
        for i, t in texts.items()
    }, n


def crc_is(i, parts: int, part: int) -> bool:
    return zlib.crc32(str(i).encode()) % parts == part
