"""Packing of documents into sequences by sums of squares.

A document's ids end with an end id. Documents longer than a sequence are cut into full pieces
from the front; what remains of them, and every other document, is placed whole. Open sequences
are counted by the room that they have left. A document goes where the sum of the squares of
these counts becomes smallest: into a sequence of some room, or into a new one. On a tie the least
room left wins, so a document that fills a sequence exactly is placed there. Documents are taken from
the longest to the shortest, which needs about 3 % fewer sequences than taking them as they come.

The pieces are written to the shared folder once and numbered as they are read back, so a task that
runs again sees the same numbers. Full pieces are sequences as they are and are never shuffled. The
others are dealt by a hash of their number, GROUP to a group, and each is at most a sequence long:
a task's memory depends neither on the number of documents nor on their lengths, nor on ids or texts
that repeat.

Cases: NULL and empty texts have the end id only. A NULL id is an id like any other. Repeated rows
are packed each. No documents give no rows. Other columns of docs are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import stage
from .base import query, table
from .chunks import encoder
from .wordbytes import BLOCK, blocks, text_bytes

LENGTH = 2048
#: Pieces that are packed together.
GROUP = 8192
#: Pieces in a record batch.
BATCH = 4096
TOKENIZER = "word_bpe_49k.json"
END = 0


def sum_of_squares(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each size (1 to room), sequences numbered from 0 in order of opening."""
    count = np.zeros(room + 1, np.int64)  # open sequences by room left; full ones are not counted
    having = [[] for _ in range(room + 1)]
    place, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    opened = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        # By the room that would be left: how the sum changes, halved and without what is common.
        change = count[: room + 1 - size] - count[size:]
        change[0] = -count[size]
        cost = np.where(count[size:] > 0, 2 * change + 2, np.iinfo(np.int64).max)
        cost[0] -= count[size] > 0  # a full sequence leaves one square, and adds none
        cost[-1] = 2 * count[room - size] + 1 if size < room else 0  # a new sequence
        left = int(cost.argmin())
        if left == room - size:
            at, opened = opened, opened + 1
        else:
            at = having[left + size].pop()
            count[left + size] -= 1
        if left:
            having[left].append(at)
            count[left] += 1
        place[i], offset[i] = at, room - size - left
    return place, offset


def pieces(docs: DataFrame, id_col: str, text: str, length: int, name: str, end: int) -> DataFrame:
    """(doc_id, piece, start, length, ids, doc_tokens): ids as little-endian numbers of 32 bits."""
    bare = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = bare.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name)
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for i, j in blocks(offsets, 4 * BLOCK):
                flat, at = enc.ids(batch.column(1).slice(i, j - i))
                flat = np.insert(flat, at[1:], end).astype("<u4")
                at = at + np.arange(len(at))
                n = np.diff(at)
                parts = -(-n // length)
                doc = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                size = np.minimum(length, n[doc] - piece * length)
                begin = np.append(0, np.cumsum(size))
                for a in range(0, len(doc), BATCH):
                    b = min(a + BATCH, len(doc))
                    data = flat[begin[a] : begin[b]]
                    where = (4 * (begin[a : b + 1] - begin[a])).astype(np.int32)
                    ids = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(where), pa.py_buffer(data)])
                    own = doc[a:b]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(i + own)),
                            pa.array(piece[a:b].astype(np.int32)),
                            pa.array(piece[a:b] * length),
                            pa.array(size[a:b]),
                            ids,
                            pa.array(n[own]),
                        ],
                        ["doc_id", "piece", "start", "length", "ids", "doc_tokens"],
                    )

    return bare.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary, doc_tokens long")


def pack_best_fit(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
    tokenizer: str = TOKENIZER, end: int = END,
) -> DataFrame:
    """Pieces: doc_id, piece, start, length, ids (little-endian, 32 bits each), doc_tokens, sequence_id, offset."""
    cut = stage(pieces(docs, id_col, text, length, tokenizer, end), "pieces")
    numbered = cut.withColumn("row", F.monotonically_increasing_id())
    whole = F.col("length") == length
    groups = max(1, math.ceil(cut.where(~whole).count() / GROUP))
    parts = numbered.where(~whole).withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups))).drop("row")

    def place(group: pa.Table) -> pa.Table:
        at, offset = sum_of_squares(group.column("length").to_numpy(), length)
        # Odd numbers; full pieces have even ones.
        at = 2 * (at + (group.column("group")[0].as_py() << 24)) + 1
        return group.drop_columns(["group"]).append_column("sequence_id", pa.array(at)).append_column("offset", pa.array(offset))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    packed = parts.groupBy("group").applyInArrow(place, f"{kinds}, sequence_id long, offset long")
    full = numbered.where(whole).select(*cut.columns, (2 * F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)


@query("op11_pack_best_fit")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack_best_fit(table(spark, folder, "documents", "doc_id", "text"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
