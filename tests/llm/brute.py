"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def lower(text: str) -> str:
    return text.translate(LOWER)


def contamination(docs, items, size=10):
    """{doc_id: (n_words, n_hit, sorted item names)}"""
    windows = defaultdict(set)
    for name, text in items:
        w = WORD.findall(lower(text or ""))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add("null" if name is None else str(name))
    sizes = sorted({len(w) for w in windows})
    out = {}
    for d, text in docs:
        w = WORD.findall(lower(text or ""))
        hit, names = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    names |= got
                    hit.update(range(i, i + n))
        out[d] = (len(w), len(hit), sorted(names))
    return out


def token_stream(docs, encode, end=2):
    """[(doc_id, start, n_tokens, crc)] in ascending doc_id order."""
    import numpy as np

    out, at = [], 0
    for d, text in sorted(docs, key=lambda x: x[0]):
        ids = [*encode(text or ""), end]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


BLANK_FREE = re.compile("[^\x20\x09-\x0d]+")


def h256(text):
    return sha(text)


def merkle_paths(nodes, fanout=16):
    """The root over the digests, and the siblings of each, level by level."""
    at, proofs = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, a in enumerate(at):
            run = nodes[a // fanout * fanout : a // fanout * fanout + fanout]
            proofs[k] += run[: a % fanout] + run[a % fanout + 1 :]
            at[k] = a // fanout
        nodes = [sha("".join(nodes[a : a + fanout])) for a in range(0, len(nodes), fanout)]
    return nodes[0] if nodes else None, proofs


def merkle(rows, fields):
    """[(row, leaf, subroot, root, proof)] of rows that have a source and a doc_id."""
    coded = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, sha("".join(coded(r[f]) for f in fields)), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for s in order:
        groups[s].sort(key=lambda x: x[:3])
        inner[s] = merkle_paths([x[2] for x in groups[s]])
    root, tops = merkle_paths([inner[s][0] for s in order])
    return [(x[3], x[2], inner[s][0], root, "".join(p + top)) for s, top in zip(order, tops) for x, p in zip(groups[s], inner[s][1])]


def periodic_runs(words, least=6, repeats=4):
    """[(start, length, period)] by start and period."""
    found, n = {}, len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, repeats * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    w = BLANK_FREE.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    often = defaultdict(int)
    for x in windows:
        often[x] += 1
    covered = {k for i, x in enumerate(windows) if often[x] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if BLANK_FREE.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def robust_distances(points, floors, steps, bins, half, inner):
    """Squared distances of a group's points (rows of whole numbers) under its minimum-covariance-determinant estimate."""
    import numpy as np

    x = np.array(points, float)
    ridge = np.diag(np.array(floors) ** 2)

    def estimate(rows):
        return rows.mean(0), np.cov(rows.T, bias=True) + ridge

    def distances(m, c):
        y = x - m
        return np.einsum("ij,jk,ik->i", y, np.linalg.inv(c), y)

    med = np.median(x, 0)
    scale = np.sqrt((1.4826 * np.median(abs(x - med), 0)) ** 2 + np.array(floors) ** 2)
    t = np.round(np.tanh((x - med) / scale) * 1024)
    s = np.cov(t.T, bias=True)
    with np.errstate(all="ignore"):
        r = s / np.sqrt(np.outer(np.diag(s), np.diag(s)))
    r = np.where(np.isfinite(r), r, np.eye(len(s)))
    ended = []
    for m, c in [(med, np.diag(scale**2)), estimate(x), (med, np.outer(scale, scale) * r + ridge)]:
        taken = None
        for _ in range(steps):
            b = np.floor(bins * np.log2(1 + distances(m, c))).astype(int)
            cut = max(k for k in set(b.tolist()) if 2 * (b < k).sum() < len(x) + 6)
            if taken is not None and np.array_equal(taken, b <= cut):
                break
            taken = b <= cut
            m, c = estimate(x[taken])
        ended.append((np.linalg.slogdet(c)[1], m, c))
    _, m, c = min(ended, key=lambda e: round(e[0], 9))
    wide = (2 ** ((np.median(np.floor(64 * np.log2(1 + distances(m, c)))) + 0.5) / 64) - 1) / half
    m, c = estimate(x[distances(m, c * max(wide, 1)) <= inner])
    return distances(m, c)
