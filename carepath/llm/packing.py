"""Packing of documents into sequences by first-fit decreasing.

A document's ids end with an end id. They are cut into full sequences from the front; what
remains is packed. Documents are dealt to groups by a hash of id and text. Inside a group,
remainders go from the longest to the shortest into the first sequence with room, found in a
tournament tree of the free room of all sequences: every node has the larger room of its two
children, so the first fit is one walk from the root. A group has about GROUP documents, so a
task's work and memory do not grow with the corpus, and half a sequence per group or so stays
open at the end.

Cases: NULL and empty texts have the end id only. A NULL id is an id like any other. Repeated
rows are packed each. No documents give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import query, table
from .chunks import encoder

LENGTH = 1024
GROUP = 4096
#: Chunks that a task's encoder remembers: memory beside that of earlier stages.
CHUNKS = 300_000
TOKENIZER = "byte_bpe_50k.json"
END = 0


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size (1 to room), bins numbered from 0 in order of opening."""
    width = 1 << max(0, int(len(sizes) - 1).bit_length())
    tree = [room] * (2 * width)
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        node = 1
        while node < width:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i], offsets[i] = node - width, room - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            top = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == top:
                break
            tree[node] = top
    return bins, offsets


def tokens(docs: DataFrame, id_col: str, text: str, name: str, end: int, groups: int) -> DataFrame:
    """(group, doc_id, ids): ids as little-endian numbers of two or four bytes."""
    bare = docs.select(
        F.pmod(F.xxhash64(id_col, text), F.lit(groups)).alias("group"),
        F.col(id_col).alias("doc_id"),
        F.col(text).alias("text"),
    )
    kind = bare.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, CHUNKS)
        width = "<u2" if max(enc.size, end + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                flat, at = enc.ids(part.column(2))
                ids = [np.append(flat[at[k] : at[k + 1]], np.uint32(end)).astype(width).tobytes() for k in range(len(at) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(ids, pa.binary()), pa.array([int(width[-1])] * len(ids), pa.int32())],
                    ["group", "doc_id", "ids", "width"],
                )

    return bare.mapInArrow(run, f"group long, doc_id {kind}, ids binary, width int")


def pack(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
    tokenizer: str = TOKENIZER, end: int = END,
) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian, 32 bits each), doc_tokens, sequence_id, offset."""
    groups = max(1, math.ceil(docs.count() / GROUP))
    coded = tokens(docs, id_col, text, tokenizer, end, groups)
    kind = coded.schema["doc_id"].dataType.simpleString()

    def place(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        g = group.column("group")[0].as_py()
        ids = [
            np.frombuffer(x.as_buffer(), f"<u{w}") for x, w in zip(group.column("ids"), group.column("width").to_pylist(), strict=True)
        ]
        n = np.array([len(x) for x in ids])
        full, rest = n // length, n % length
        left = np.flatnonzero(rest)
        bins, offsets = first_fit_decreasing(rest[left], length)
        next_full = int(bins.max()) + 1 if len(left) else 0
        row, start, size, sequence, offset = [], [], [], [], []
        for d in np.flatnonzero(full):
            for k in range(full[d]):
                row.append(d), start.append(k * length), size.append(length)
                sequence.append(next_full), offset.append(0)
                next_full += 1
        row += left.tolist()
        start += (full[left] * length).tolist()
        size += rest[left].tolist()
        sequence += bins.tolist()
        offset += offsets.tolist()
        pieces = [ids[d][s : s + m].astype("<u4").tobytes() for d, s, m in zip(row, start, size, strict=True)]
        long = lambda x: pa.array(np.array(x, np.int64))
        return pa.table(
            {
                "doc_id": group.column("doc_id").take(pa.array(np.array(row, np.int64))),
                "start": long(start),
                "length": long(size),
                "ids": pa.array(pieces, pa.binary()),
                "doc_tokens": long(n[row]),
                "sequence_id": long(np.array(sequence, np.int64) + (g << 32)),
                "offset": long(offset),
            }
        )

    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return coded.groupBy("group").applyInArrow(place, schema)


@query("op6_pack_ffd")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(table(spark, folder, "documents", "doc_id", "text"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
