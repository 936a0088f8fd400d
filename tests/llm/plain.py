"""Plain Python versions of the operators' rules, for comparison."""

import re

import duckdb
import numpy as np
import xxhash

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rows(name, columns, folder=FOLDER):
    return duckdb.connect().sql(f"SELECT {columns} FROM '{folder}/{name}.parquet'").fetchall()


def words(text):
    return WORDS.findall(text or "")


def fingerprint(text, shingle=4):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [
        xxhash.xxh64_intdigest(" ".join(w[i : i + shingle]).encode(), 42)
        for i in range(max(1, len(w) - shingle + 1))
    ]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def class_of(points, bits):
    """Smallest id reachable over links of at most bits differing bits; points: id -> fingerprint."""
    ids = sorted(points)
    x = np.array([points[i] for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in zip(*np.nonzero(np.triu(np.bitwise_count(x[:, None] ^ x[None, :]) <= bits, 1)), strict=True):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: ids[find(k)] for k, i in enumerate(ids)}


def repeat_words(w, n=5):
    seen, cover = {}, set()
    for i in range(len(w) - n + 1):
        seen.setdefault(tuple(w[i : i + n]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            cover |= {p + k for p in places for k in range(n)}
    return len(cover)


def without_repeats(docs, length=13):
    """docs: list of (id, text). Kept words per row."""
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < d:
                gone |= set(range(i, i + length))
        out.append((d, len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return out
