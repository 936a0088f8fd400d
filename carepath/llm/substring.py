"""Removal of word sequences that an earlier document has, found by difference-cover anchors.

A window is ``length`` consecutive words. Hashes of shorter anchors are taken only where the
position modulo PERIOD lies in the difference cover COVER: for any two positions i and j there
is a shift d < PERIOD that brings both into the cover. An anchor has length - PERIOD + 1 words,
so two equal windows always share an anchor at the same shift. Documents that share no anchor
with another one have nothing in common of that length.

1. Tasks hash the anchors of their texts in runs of bounded size. An anchor that a run has in
   two documents is known to be shared at once; of every anchor only the smallest document goes
   to the exchange, so an anchor in a third of all documents arrives once per run. Hashes are
   sorted, packed as differences and dealt by range of the hash.
2. Documents with shared anchors are extended: the windows around these anchors, and only they,
   are hashed in full, and the same exchange gives the smallest document of every window.
3. Each text loses the words that such windows cover.

Step 1 compares 48 bits of a hash and so may name a few documents in vain; step 2 decides on 96
bits of the whole window.

Cases: NULL text has no words and stays NULL. Texts shorter than a window stay as they are. A
NULL id has no order, so its row is neither cut nor used. Rows that repeat an id count as one
document for the comparison and are each cut. Equal texts: all but that of the smallest id lose
every word of theirs that a window covers. Ids must be whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import named_apart, query, table, words
from .wordbytes import blocks, mix, text_bytes, window_hashes, word_bounds, word_hashes

LENGTH = 13
PERIOD = 7
COVER = (0, 1, 3)
#: Hashes that a task holds before it sorts and sends them, and that one bucket receives on average.
RUN = 1 << 20
LEAST_BUCKETS = 64
KEY_BITS = np.uint64(16)  # anchors are compared without so many low bits

_CHECK = np.uint64(0xD6E8FEB86659FD93)
EXCHANGE = "bucket int, kind int, doc_id long, payload binary"


def pack(*columns: np.ndarray) -> bytes:
    """64-bit columns byte by byte: bytes that are mostly zero compress to nothing."""
    return b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)


def unpack(data: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view(np.uint64).ravel() for p in planes]


def pack_sorted(key: np.ndarray, *columns: np.ndarray) -> bytes:
    return pack(np.diff(key, prepend=np.uint64(0)), *columns)


def unpack_sorted(data: bytes, columns: int) -> list[np.ndarray]:
    key, *rest = unpack(data, columns)
    return [np.cumsum(key, dtype=np.uint64), *rest]


class Run:
    """Hashes of one task on their way to the exchange.

    seen_twice: report every document of a hash that two documents have (anchors); else
    report the documents after the first one (windows).
    """

    def __init__(self, n_buckets: int, seen_twice: bool):
        self.n_buckets, self.seen_twice = n_buckets, seen_twice
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0
        self.turn = 0

    def add(self, keys: np.ndarray, checks: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(keys), RUN):
            self.parts.append((keys[i : i + RUN], checks[i : i + RUN], docs[i : i + RUN]))
            self.held += len(self.parts[-1][0])
            if self.held >= RUN:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        key, check, doc = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        key, check, doc, first = by_key(key, check, doc)
        rows = []
        heads = np.flatnonzero(first)
        sizes = np.diff(np.append(heads, len(key)))
        told = np.repeat(sizes > 1, sizes) if self.seen_twice else ~first
        for d, found in per_document(doc[told], key[told]):
            self.turn = (self.turn * 31 + int(found[0] >> np.uint64(40))) % 2147483647
            rows.append((self.turn % self.n_buckets, 1, int(d), pack_sorted(found)))
        key, check, doc = key[heads], check[heads], doc[heads]
        width = -(-(1 << 32) // self.n_buckets)
        cuts = np.searchsorted(key >> np.uint64(32), np.arange(self.n_buckets + 1, dtype=np.uint64) * np.uint64(width))
        cuts[-1] = len(key)
        for b in np.flatnonzero(np.diff(cuts)):
            s = slice(cuts[b], cuts[b + 1])
            rows.append((int(b), 0, None, pack_sorted(key[s], check[s], doc[s].view(np.uint64))))
        for i in range(0, len(rows), 4096):
            yield exchange_batch(rows[i : i + 4096])


def exchange_batch(rows: list[tuple]) -> pa.RecordBatch:
    bucket, kind, doc, payload = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(doc, pa.int64()), pa.array(payload, pa.binary())],
        ["bucket", "kind", "doc_id", "payload"],
    )


def by_key(key: np.ndarray, check: np.ndarray, doc: np.ndarray):
    """Sorted and without repeats; first marks the first row, of the smallest document, of a key."""
    order = np.lexsort((doc, check, key))
    key, check, doc = key[order], check[order], doc[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    fresh = first.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    return key[fresh], check[fresh], doc[fresh], first[fresh]


def per_document(docs: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(docs):
        return
    order = np.lexsort((keys, docs))
    docs, keys = docs[order], keys[order]
    at = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
    for i, j in zip(at, np.append(at[1:], len(docs)), strict=True):
        yield docs[i], keys[i:j]


def shared(rows: DataFrame, seen_twice: bool) -> DataFrame:
    """(doc_id, keys): what the exchange finds out, one row per document with packed keys."""

    def settle(group: pa.Table) -> pa.Table:
        docs, keys = [], []
        parts = []
        for kind, doc, payload in zip(*(group.column(c).to_pylist() for c in ("kind", "doc_id", "payload")), strict=True):
            if kind:
                docs.append(doc), keys.append(payload)
            else:
                parts.append(unpack_sorted(payload, 3))
        if parts:
            key, check, doc, first = by_key(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            doc = doc.view(np.int64)
            heads = np.flatnonzero(first)
            sizes = np.diff(np.append(heads, len(key)))
            told = np.repeat(sizes > 1, sizes) if seen_twice else ~first
            for d, found in per_document(doc[told], key[told]):
                docs.append(int(d)), keys.append(pack_sorted(found))
        return pa.table({"doc_id": pa.array(docs, pa.int64()), "keys": pa.array(keys, pa.binary())})

    told = rows.groupBy("bucket").applyInArrow(settle, "doc_id long, keys binary")
    return told.groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))


def squeezed(docs: DataFrame, text: str) -> DataFrame:
    """docs with the column text compressed, so that a shuffle moves less."""
    place = docs.columns.index(text)
    names = docs.columns
    fields = ", ".join(f"`{c}` {'binary' if c == text else t}" for c, t in docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(place)]
            small = pa.array([None if t is None else press.compress(t.encode()) for t in texts], pa.binary())
            arrays = [small if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(run, fields)


def restored(column: pa.Array) -> pa.Array:
    expand = zstandard.ZstdDecompressor()
    texts = [None if t is None else expand.decompress(t) for t in column.to_pylist()]
    return pa.array(texts, pa.large_binary()).view(pa.large_string())


def key_set(packed: list[bytes]) -> np.ndarray:
    return np.unique(np.concatenate([unpack_sorted(p, 1)[0] for p in packed]))


def anchor_starts(first: np.ndarray, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes at cover positions where an anchor fits, and their documents."""
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    fits = place + anchor <= counts[doc]
    at = np.flatnonzero(fits & np.isin(np.arange(PERIOD), COVER)[place % PERIOD])
    return at, doc[at]


def anchors(docs: DataFrame, length: int, n_buckets: int) -> DataFrame:
    """docs: (doc_id, text)."""
    anchor = length - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Run(n_buckets, seen_twice=True)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            raw, offsets = text_bytes(batch.column(1))
            for i, j in blocks(offsets):
                part = raw[offsets[i] : offsets[j]]
                starts, stops, first = word_bounds(part, offsets[i : j + 1] - offsets[i])
                at, doc = anchor_starts(first, anchor)
                key = window_hashes(word_hashes(part, starts, stops), at, anchor)
                key = key >> KEY_BITS << KEY_BITS
                yield from out.add(key, np.zeros(len(key), np.uint64), ids[i + doc].astype(np.int64))
        yield from out.flush()

    return docs.mapInArrow(run, EXCHANGE)


def windows(docs: DataFrame, length: int, n_buckets: int) -> DataFrame:
    """docs: (doc_id, squeezed text, keys), keys being the document's shared anchors."""
    anchor = length - PERIOD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Run(n_buckets, seen_twice=False)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            raw, offsets = text_bytes(restored(batch.column(1)))
            for d in range(len(ids)):
                part = raw[offsets[d] : offsets[d + 1]]
                starts, stops, first = word_bounds(part, np.array([0, len(part)]))
                if len(starts) < length:
                    continue
                hashes = word_hashes(part, starts, stops)
                at, _ = anchor_starts(first, anchor)
                key = window_hashes(hashes, at, anchor) >> KEY_BITS << KEY_BITS
                at = at[np.isin(key, key_set(batch.column(2)[d].as_py()))]
                near = np.zeros(len(starts) + 1, np.int64)
                np.add.at(near, np.maximum(at - (length - anchor), 0), 1)
                np.add.at(near, at + 1, -1)
                at = np.flatnonzero(np.cumsum(near)[: len(starts) - length + 1])
                check = window_hashes(mix(hashes ^ _CHECK), at, length) >> np.uint64(32)
                yield from out.add(window_hashes(hashes, at, length), check, np.full(len(at), ids[d], np.int64))
        yield from out.flush()

    return docs.mapInArrow(run, EXCHANGE)


def cut(text: bytes, keys: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """The text without the words of the given windows; its words and how many went.

    What separates kept words stays as it is.
    """
    raw = np.frombuffer(text, np.uint8)
    starts, stops, _ = word_bounds(raw, np.array([0, len(raw)]))
    at = np.arange(max(0, len(starts) - length + 1))
    at = at[np.isin(window_hashes(word_hashes(raw, starts, stops), at, length), keys)]
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + length, -1)
    gone = np.cumsum(cover)[:-1] > 0
    if not gone.any():
        return text, len(starts), 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    out, upto = [], 0
    for i, j in edge.reshape(-1, 2):  # words i to j - 1 go
        last = j == len(starts)
        begin = (stops[i - 1] if i else 0) if last else starts[i]
        out.append(text[upto:begin])
        upto = stops[j - 1] if last else starts[j]
    out.append(text[upto:])
    return b"".join(out), len(starts), int(gone.sum())


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with shortened texts and the columns n_words (before) and n_removed."""
    if length < PERIOD:
        raise ValueError(f"windows have {PERIOD} words at least")
    bare = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    size = bare.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Words have about six bytes with the space after them.
    n_buckets = max(LEAST_BUCKETS, math.ceil(size / 6 * len(COVER) / PERIOD / RUN))
    hits = shared(anchors(bare, length, n_buckets), seen_twice=True)
    hits = hits.withColumnRenamed("doc_id", "hit_id")
    candidates = squeezed(bare, "text").join(hits, F.col("doc_id") == F.col("hit_id")).select("doc_id", "text", "keys")
    repeats = shared(windows(candidates, length, n_buckets), seen_twice=False)

    name = named_apart(docs, "hit_id", "keys")
    right = repeats.toDF(name["hit_id"], name["keys"])
    joined = squeezed(docs, text).join(right, F.col(id_col).cast("long") == F.col(name["hit_id"]), "left").drop(name["hit_id"])
    place = docs.columns.index(text)
    taken = [c for c in ("n_words", "n_removed") if c in docs.columns]
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c not in taken)
    keep = [i for i, c in enumerate(docs.columns) if c not in taken]
    names = [*(docs.columns[i] for i in keep), "n_words", "n_removed"]

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = restored(batch.column(place)).cast(pa.string())
            raw, offsets = text_bytes(column)
            counts = np.zeros(len(column), np.int64)
            for i, j in blocks(offsets):
                _, _, first = word_bounds(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                counts[i:j] = np.diff(first)
            removed = np.zeros(len(column), np.int64)
            keys = batch.column(batch.num_columns - 1)
            new = {}
            for d in np.flatnonzero(keys.is_valid().to_numpy(zero_copy_only=False)):
                short, _, removed[d] = cut(raw[offsets[d] : offsets[d + 1]].tobytes(), key_set(keys[d].as_py()), length)
                if removed[d]:
                    new[d] = short.decode()
            if new:
                texts = column.to_pylist()
                for d, short in new.items():
                    texts[d] = short
                column = pa.array(texts, column.type)
            arrays = [column if i == place else batch.column(i) for i in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts), pa.array(removed)], names)

    return joined.mapInArrow(shorten, f"{fields}, n_words long, n_removed long")


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13),
wins AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS win FROM starts),
earliest AS (SELECT win, min(doc_id) AS first_id FROM wins GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM wins JOIN earliest USING (win) WHERE first_id < doc_id),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS body
  FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query("op8_drop_repeats", SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    short = drop_repeats(table(spark, folder, "documents", "doc_id", "text"))
    kept = F.sha2(F.array_join(words(F.col("text")), " "), 256)
    return short.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))
