"""Near-duplicate classes by SimHash and vantage-point trees.

A text's fingerprint has bit k set if more than half of its shingle hashes have it set.
Fingerprints that differ in ``bits`` bits or fewer are linked; classes are the connected
components of the links.

Exact search: equal fingerprints are merged first, so a group of copies is one point however
large it is. The 64 bits are split into blocks; two fingerprints within ``bits`` agree on some
block up to ``bits // blocks`` bits (pigeonhole). For every block a vantage-point tree splits
the points by their Hamming distance on that block from a vantage point. Whole fingerprints
of unrelated texts lie at 32 +- 4 bits from any point, where a radius of 4 prunes almost
nothing; on 21 bits the radius is 1 against a spread of 2.3. The upper part of each tree is
built on a bounded sample and deals points to shards: a point lives in one shard and is also
sent, as a query, to every later shard that its ball may reach by the triangle inequality.
Inside a shard the tree goes on, down to leaves that are compared in full on all 64 bits.
Which points make the sample changes the shape of the trees, never the result. A shard that
distances cannot split further is dealt to several tasks by hash, with all its queries in each.

A task reports a spanning forest of its links, not all pairs: a dense group costs as many rows
as it has members. Links of all tasks meet in components().

Cases: NULL or empty texts, and texts of spaces, have the fingerprint zero and are linked like
any other. Shorter texts have one shingle. Repeated documents give repeated rows of one class.
A NULL doc_id is kept, in the class of its fingerprint. An empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage
from .base import named_apart, query, table
from .components import components, local_roots
from .wordbytes import blocks, text_bytes, word_bounds

SEED = 42
SAMPLE = 16_384
#: Points that a shard should hold at most.
SHARD = 100_000
LEAF = 256
#: Comparisons that are held in memory at once.
CHUNK = 1 << 20
BLOCKS = 3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints_of(column: pa.Array, shingle: int) -> np.ndarray:
    raw_all, offsets = text_bytes(column)
    out = np.zeros(len(offsets) - 1, np.uint64)
    for i, j in blocks(offsets):
        raw = _LOWER[raw_all[offsets[i] : offsets[j]]]
        starts, stops, first = word_bounds(raw, offsets[i : j + 1] - offsets[i])
        if not len(starts):
            continue
        # Words of all documents, one space after each.
        lengths = stops - starts
        begin = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths + 1, out=begin[1:])
        text = np.full(begin[-1], 32, np.uint8)
        shift = np.repeat(starts - begin[:-1], lengths)
        to = np.arange(len(shift)) + np.repeat(np.arange(len(starts)), lengths)
        text[to] = raw[to + shift]
        view = memoryview(text)
        for d in range(j - i):
            a, b = first[d], first[d + 1]
            if a == b:
                continue
            n = max(1, b - a - shingle + 1)
            lo = begin[a : a + n].tolist()
            hi = (begin[a + shingle : a + shingle + n] - 1).tolist() if b - a > shingle else [int(begin[b]) - 1]
            digest = b"".join([xxhash.xxh64_digest(view[p:q], SEED) for p, q in zip(lo, hi, strict=True)])
            total = np.zeros(64, np.int64)
            for at in range(0, len(digest), 8 * 65_536):
                part = np.frombuffer(digest, np.uint8, min(8 * 65_536, len(digest) - at), at)
                total += np.unpackbits(part.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            out[i + d] = np.frombuffer(np.packbits(2 * total > n).tobytes(), ">u8")[0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed 64-bit number."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints_of(batch.column(1), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


class Block:
    """A group of adjacent bits of the fingerprint."""

    def __init__(self, k: int, of: int):
        low, high = 64 * k // of, 64 * (k + 1) // of
        self.mask = np.uint64(((1 << high) - 1) ^ ((1 << low) - 1))

    def distance(self, points: np.ndarray, vantage: np.uint64) -> np.ndarray:
        return np.bitwise_count((points ^ vantage) & self.mask)


def split(block: Block, points: np.ndarray) -> tuple[np.uint64, int] | None:
    """Vantage point and radius: d <= radius goes inside. None if all distances are equal."""
    best = None
    for v in points[:: max(1, len(points) // 8)][:8]:
        d = block.distance(points, v)
        spread = float(d.std())
        if spread > 0 and (best is None or spread > best[0]):
            radius = min(int(np.median(d)), int(d.max()) - 1)
            best = spread, v, radius
    return best and (best[1], best[2])


def upper_tree(block: Block, sample: np.ndarray, total: float, reach: int, shards: list[int]):
    """Nested (vantage, radius, inside, outside), or the index of a shard.

    shards gets, for each shard, the number of parts its points are dealt to.
    """
    cut = split(block, sample) if total > SHARD and len(sample) >= 32 else None
    if cut:
        d = block.distance(sample, cut[0])
        near, far = d <= cut[1] + reach, d > cut[1] - reach
        if near.mean() + far.mean() < 1.8:  # else nearly all points would go both ways
            inside = d <= cut[1]
            share = inside.mean()
            left = upper_tree(block, sample[inside], total * share, reach, shards)
            return cut[0], cut[1], left, upper_tree(block, sample[~inside], total * (1 - share), reach, shards)
    shards.append(max(1, math.ceil(total / SHARD)))
    return len(shards) - 1


def visited(node, block: Block, points: np.ndarray, rows: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, rows of the points whose ball of the given radius may reach it)."""
    if not len(rows):
        return
    if isinstance(node, int):
        yield node, rows
        return
    vantage, radius, inside, outside = node
    d = block.distance(points[rows], vantage).astype(np.int64)
    yield from visited(inside, block, points, rows[d <= radius + reach], reach)
    yield from visited(outside, block, points, rows[d > radius - reach], reach)


def forest(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every linked point to the root of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = local_roots(len(nodes), at[: len(a)], at[len(a) :])
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def compare(points: np.ndarray, homes: np.ndarray, others: np.ndarray, bits: int):
    """Links between all homes and all others, a spanning forest for each chunk."""
    step = max(1, CHUNK // max(1, len(others)))
    for i in range(0, len(homes), step):
        part = homes[i : i + step]
        x, y = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[others][None, :]) <= bits)
        apart = part[x] != others[y]
        x, y = part[x[apart]], others[y[apart]]
        if len(x):
            yield forest(points, x, y) if len(x) > len(part) else (x, y)


def shard_links(block: Block, points: np.ndarray, homes: np.ndarray, reach: int, bits: int):
    """Spanning links between homes and all points (homes and queries), by a tree in memory."""
    found_a, found_b, held = [], [], 0
    stack = [(homes, np.arange(len(points)))]
    while stack:
        h, q = stack.pop()
        cut = split(block, points[h]) if len(h) > LEAF else None
        if cut:
            d, e = block.distance(points[h], cut[0]), block.distance(points[q], cut[0]).astype(np.int64)
            near, far = e <= cut[1] + reach, e > cut[1] - reach
            if near.sum() + far.sum() < 1.9 * len(q):
                inside = d <= cut[1]
                stack += [(h[inside], q[near]), (h[~inside], q[far])]
                continue
            for part in np.array_split(h, math.ceil(len(h) / LEAF)):
                for a, b in compare(points, part, q, bits):
                    found_a.append(a), found_b.append(b)
                    held += len(a)
        else:
            for a, b in compare(points, h, q, bits):
                found_a.append(a), found_b.append(b)
                held += len(a)
        if held > 4 * len(points) + CHUNK:
            a, b = forest(points, np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b, held = [a], [b], len(a)
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(points, np.concatenate(found_a), np.concatenate(found_b))


def links(points: DataFrame, bits: int, blocks_n: int = BLOCKS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp), enough to connect every class."""
    n = points.count()
    rows = points.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    sample = np.array([r.fp for r in rows], np.int64).view(np.uint64)
    reach = bits // blocks_n
    trees, parts = [], []
    for k in range(blocks_n):
        own: list[int] = []
        trees.append(upper_tree(Block(k, blocks_n), sample, n, reach, own))
        parts.append(own)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            x = fp.view(np.uint64)
            every = np.arange(len(x))
            salt = (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            for k in range(blocks_n):
                block, out = Block(k, blocks_n), []
                home = np.full(len(x), -1)
                for shard, at in visited(trees[k], block, x, every, 0):
                    home[at] = shard
                for shard, at in visited(trees[k], block, x, every, reach):
                    at = at[home[at] <= shard]
                    own = home[at] == shard
                    m = parts[k][shard]
                    for part in range(m):
                        out.append((shard, part, at, own & (salt[at] % np.uint64(m) == part)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(len(o[2]), o[0] * blocks_n + k, np.int64) for o in out])),
                        pa.array(np.concatenate([np.full(len(o[2]), o[1], np.int32) for o in out])),
                        pa.array(fp[np.concatenate([o[2] for o in out])]),
                        pa.array(np.concatenate([o[3] for o in out])),
                    ],
                    ["shard", "part", "fp", "home"],
                )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        x = group["fp"].to_numpy().view(np.uint64)
        block = Block(int(group["shard"].iloc[0]) % blocks_n, blocks_n)
        a, b = shard_links(block, x, np.flatnonzero(group["home"].to_numpy()), reach, bits)
        return pd.DataFrame({"a": x[a].view(np.int64), "b": x[b].view(np.int64)})

    dealt = points.select("fp").mapInArrow(deal, "shard long, part int, fp long, home boolean")
    return dealt.groupBy("shard", "part").applyInPandas(search, "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): one row per document; component_id is the class's smallest id."""
    marked = stage(fingerprints(docs, id_col, text, shingle), "fingerprints")
    points = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-points")
    roots = components(links(points, bits))
    at_root = points.join(roots, points.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    at_root = stage(at_root, "fingerprint-roots")
    low = at_root.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id"))
    by_fp = at_root.join(low, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    return marked.join(by_fp, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = 4) -> DataFrame:
    """One document of each class, that of the smallest id; with the columns of docs.

    Rows that share an id are told apart by their texts: of the smallest id of a class, the row of the smallest
    xxhash64(text) stays, and one of rows that are equal in both. Rows with a NULL id stay.
    """
    name = named_apart(docs, "id", "code", "kept")
    known = docs.where(F.col(id_col).isNotNull()).withColumn(name["code"], F.xxhash64(text))
    who = F.struct(F.col(id_col).alias("id"), F.col(name["code"]).alias("code"))
    found = classes(known.select(who.alias("who"), F.col(text).alias("text")), "who", "text", shingle, bits)
    first = found.where("doc_id = component_id").select(F.col("doc_id.id").alias(name["id"]), F.col("doc_id.code").alias(name["kept"]))
    same = (F.col(id_col) == F.col(name["id"])) & (F.col(name["code"]) == F.col(name["kept"]))
    kept = known.join(first, same, "left_semi")
    once = kept.dropDuplicates([id_col, name["code"]]).drop(name["code"])
    return once.unionByName(docs.where(F.col(id_col).isNull()))


@query("op9_simhash_classes")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = classes(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
