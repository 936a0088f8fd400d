"""Token ids in files coded by a static range asymmetric numeral system.

Format: Parquet files of segments, in ascending order of (part, segment). A segment holds up to
SEGMENT ids of consecutive documents and one frequency table, counted on exactly these ids,
that all its blocks share. A block has up to BLOCK ids, dealt to LANES coders in turn (id i goes
to coder i mod LANES) whose 32-bit words are interleaved in reading order. Every block starts
from its own states and carries a CRC-32 of its ids, so blocks are independent; every
CHECKPOINT steps the states and the place in the words are stored as well, so one block can be
decoded at several places at once. Nothing has to be known of the whole corpus before writing:
one pass sorts, encodes and writes.

Fields of a segment: version, part, segment, before (ids of the part before it), n_ids,
symbols and frequencies (delta coded, compressed), doc_ids, doc_counts, first_from (ids of the
first document that earlier segments hold), and per block n_ids, crc32, checkpoints, words.

Documents are put in order of id by range partitioning; a table of ids per part (one small row
per task) turns places within parts into places in the corpus.

Cases: NULL and empty texts are the end id only. NULL ids come first. Rows that repeat an id
follow each other in order of text. No documents give no segments and no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import staging_folder
from ..sources.tables import literal_rows
from .base import query, table
from .chunks import encoder

VERSION = 1
BITS = 18
LANES = 128
BLOCK = 1 << 17
CHECKPOINT = 256
SEGMENT = 1 << 21
#: Parts whose totals are broadcast (16 bytes each).
MAX_PARTS = 1_000_000
TOKENIZER = "word_bpe_49k.json"
END = 2

_TOTAL = 1 << BITS
#: States lie in [_LOW, _LOW << 32), below 2 ** 53, so that floating-point division is exact.
_LOW = 1 << 20

SCHEMA = (
    "version int, part int, segment int, before long, n_ids long, symbols binary, frequencies binary, "
    "doc_ids array<long>, doc_counts array<long>, first_from long, "
    "blocks array<struct<n_ids: int, crc32: long, checkpoints: binary, words: binary>>"
)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and their frequencies, at least 1 each and 2 ** BITS together."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    if len(symbols) > _TOTAL:
        raise ValueError(f"more than {_TOTAL} distinct ids in a segment")
    spare = _TOTAL - len(symbols)
    scaled = 1 + counts * spare // counts.sum()
    scaled[np.argmax(counts)] += _TOTAL - scaled.sum()
    return symbols.astype(np.uint32), scaled.astype(np.uint32)


def encode_blocks(index: np.ndarray, freq: np.ndarray) -> list[tuple[bytes, bytes]]:
    """(checkpoints, words) of blocks of equal length: index is (blocks, steps, LANES) into freq."""
    n, steps, _ = index.shape
    index = np.ascontiguousarray(index.transpose(1, 0, 2))
    divisor = freq.astype(np.float64)
    limit = divisor * float(_LOW << 32 >> BITS)
    spread = _TOTAL - freq.astype(np.int64)
    start = np.cumsum(freq, dtype=np.int64) - freq
    state = np.full((n, LANES), _LOW, np.int64)
    out = np.zeros((steps, n, LANES), np.uint32)
    sent = np.zeros((steps, n, LANES), bool)
    marks = {}
    for t in range(steps - 1, -1, -1):
        s = index[t]
        full = state >= limit[s]
        out[t], sent[t] = state & 0xFFFFFFFF, full
        state = np.where(full, state >> 32, state)
        # state // f * 2 ** BITS + state % f + start
        state = state + (state / divisor[s]).astype(np.int64) * spread[s] + start[s]
        if t % CHECKPOINT == 0:
            marks[t] = state
    words = []
    for b in range(n):
        read = np.append(0, np.cumsum(sent[:, b, :].sum(axis=1)))
        points = b"".join(
            np.append(read[t], marks[t][b]).astype("<i8").tobytes() for t in range(0, steps, CHECKPOINT)
        )
        words.append((points, out[:, b, :][sent[:, b, :]].tobytes()))
    return words


def encode_ids(ids: np.ndarray) -> tuple[bytes, bytes, list[dict]]:
    """Symbols, frequencies and blocks of one segment."""
    symbols, freq = frequencies(ids)
    place = np.zeros(int(symbols[-1]) + 1, np.int64)
    place[symbols] = np.arange(len(symbols))
    index = place[ids]
    filler = int(np.argmax(freq))
    blocks = []
    whole = len(ids) // BLOCK
    groups = [index[: whole * BLOCK].reshape(whole, BLOCK // LANES, LANES)] if whole else []
    if rest := len(ids) - whole * BLOCK:
        steps = -(-rest // LANES)
        last = np.full(steps * LANES, filler)
        last[:rest] = index[whole * BLOCK :]
        groups.append(last.reshape(1, steps, LANES))
    for group in groups:
        for points, words in encode_blocks(group, freq):
            own = ids[len(blocks) * BLOCK : (len(blocks) + 1) * BLOCK].astype("<u4")
            blocks.append({"n_ids": len(own), "crc32": zlib.crc32(own.tobytes()), "checkpoints": points, "words": words})
    deltas = np.diff(symbols, prepend=np.uint32(0)).astype("<u4")
    return zlib.compress(deltas.tobytes(), 1), zlib.compress(freq.astype("<u4").tobytes(), 1), blocks


def decode_ids(symbols: bytes, freq_bytes: bytes, blocks: list[dict]) -> np.ndarray:
    """The ids of a segment; all checkpoints of all its blocks run side by side."""
    names = np.cumsum(np.frombuffer(zlib.decompress(symbols), "<u4"), dtype=np.uint32)
    freq = np.frombuffer(zlib.decompress(freq_bytes), "<u4").astype(np.int64)
    of = np.repeat(np.arange(len(freq)), freq)
    slot_id, slot_freq = names[of], freq[of]
    slot_rest = np.arange(_TOTAL) - (np.cumsum(freq) - freq)[of]
    words = np.concatenate([np.frombuffer(b["words"], "<u4") for b in blocks] + [np.zeros(1, np.uint32)]).astype(np.int64)
    base, at, state, home, steps = 0, [], [], [], []
    for k, b in enumerate(blocks):
        points = np.frombuffer(b["checkpoints"], "<i8").reshape(-1, 1 + LANES)
        total = -(-b["n_ids"] // LANES)
        at.append(base + points[:, 0])
        state.append(points[:, 1:])
        home += [(k, i) for i in range(len(points))]
        steps += [min(CHECKPOINT, total - i * CHECKPOINT) for i in range(len(points))]
        base += len(b["words"]) // 4
    at, state, steps = np.concatenate(at), np.concatenate(state), np.array(steps)
    order = np.argsort(-steps, kind="stable")
    at, state = at[order], state[order]
    live = np.searchsorted(-steps[order], -np.arange(CHECKPOINT), "left")  # rows with a step t
    got = np.zeros((CHECKPOINT, len(at), LANES), np.uint32)
    for t in range(int(steps.max())):
        m = live[t]
        x = state[:m]
        slot = x & (_TOTAL - 1)
        got[t, :m] = slot_id[slot]
        x = slot_freq[slot] * (x >> BITS) + slot_rest[slot]
        need = x < _LOW
        count = np.cumsum(need, axis=1)
        fed = words[np.minimum(at[:m, None] + count - 1, len(words) - 1)]
        state[:m] = np.where(need, (x << 32) | fed, x)
        at[:m] += count[:, -1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    out, row = [], 0
    for k, b in enumerate(blocks):
        parts = []
        while row < len(home) and home[row][0] == k:
            parts.append(got[: steps[row], rank[row]].reshape(-1))
            row += 1
        ids = np.concatenate(parts)[: b["n_ids"]]
        if zlib.crc32(ids.astype("<u4").tobytes()) != b["crc32"]:
            raise ValueError(f"checksum of block {k} does not fit")
        out.append(ids)
    return np.concatenate(out)


class _Writer:
    """Cuts one part's documents into segments."""

    def __init__(self, part: int, size: int):
        self.part, self.size, self.segment, self.before = part, size, 0, 0
        self.ids: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        self.held = self.first_from = 0

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = 0
        while True:
            piece = ids[at : at + self.size - self.held]
            if at == 0 and len(piece) < len(ids) and self.held and len(ids) <= self.size:
                yield self.flush(0)  # a document is only cut if it fits in no segment
                continue
            self.ids.append(piece), self.docs.append(doc), self.counts.append(len(piece))
            self.held += len(piece)
            at += len(piece)
            if self.held == self.size:
                yield self.flush(at if at < len(ids) else 0)
            if at == len(ids):
                return

    def flush(self, next_from: int) -> pa.RecordBatch:
        ids = np.concatenate(self.ids)
        symbols, freq, blocks = encode_ids(ids)
        row = {
            "version": VERSION, "part": self.part, "segment": self.segment, "before": self.before, "n_ids": len(ids),
            "symbols": symbols, "frequencies": freq, "doc_ids": self.docs, "doc_counts": self.counts,
            "first_from": self.first_from, "blocks": blocks,
        }
        self.segment, self.before = self.segment + 1, self.before + len(ids)
        self.ids, self.docs, self.counts, self.held, self.first_from = [], [], [], 0, next_from
        return pa.RecordBatch.from_pylist([row], schema=_ARROW)


_ARROW = pa.schema(
    [
        ("version", pa.int32()), ("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()),
        ("n_ids", pa.int64()), ("symbols", pa.binary()), ("frequencies", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_counts", pa.list_(pa.int64())), ("first_from", pa.int64()),
        ("blocks", pa.list_(pa.struct([("n_ids", pa.int32()), ("crc32", pa.int64()), ("checkpoints", pa.binary()), ("words", pa.binary())]))),
    ]
)


def write(
    docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end: int = END,
    segment: int = SEGMENT,
) -> None:
    """Encode all documents in ascending order of id and write them under path."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        writer = _Writer(TaskContext.get().partitionId(), segment)
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                flat, at = enc.ids(part.column(1))
                for k, doc in enumerate(part.column(0).to_pylist()):
                    yield from writer.add(doc, np.append(flat[at[k] : at[k + 1]], np.uint32(end)))
        if writer.held:
            yield writer.flush(0)

    # Coded words do not compress any further.
    ordered.mapInArrow(run, SCHEMA).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of documents: part, doc_id, start (ids of all documents
    before it), piece_from (ids of the document before the piece), n_ids, ids (little-endian,
    32 bits each). A document has several pieces only if it is longer than a segment.
    """
    segments = spark.read.schema(SCHEMA).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    totals = parts.select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")
    ).limit(MAX_PARTS + 1).collect()
    if len(totals) > MAX_PARTS:
        raise ValueError(f"more than {MAX_PARTS} parts")
    base = literal_rows(spark, [(r.part, r.base) for r in totals], "base_part int, base long")
    placed = segments.join(F.broadcast(base), F.col("part") == F.col("base_part"))  # MAX_PARTS rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                s = batch.slice(k, 1).to_pylist()[0]
                if s["version"] != VERSION:
                    raise ValueError(f"version {s['version']} is not known")
                ids = decode_ids(s["symbols"], s["frequencies"], s["blocks"]).astype("<u4")
                counts = np.array(s["doc_counts"], np.int64)
                at = np.append(0, np.cumsum(counts))
                skip = np.zeros(len(counts), np.int64)
                skip[0] = s["first_from"]
                start = s["base"] + s["before"] + at[:-1] - skip
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(counts), s["part"], np.int32)),
                        pa.array(s["doc_ids"], pa.int64()),
                        pa.array(start), pa.array(skip), pa.array(counts),
                        pa.array([ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                    ],
                    ["part", "doc_id", "start", "piece_from", "n_ids", "ids"],
                )

    return placed.mapInArrow(run, "part int, doc_id long, start long, piece_from long, n_ids long, ids binary")


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo the CRC-32 one, lowest power in the top bit."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc32(crcs: list[int], lengths: list[int]) -> int:
    """CRC-32 of byte strings put together, from their own CRCs and lengths."""
    out = crcs[0]
    for crc, n in zip(crcs[1:], lengths[1:], strict=True):
        shift, power, bits = 1 << 31, 1 << 23, n  # x^0 and x^8
        while bits:
            if bits & 1:
                shift = _times(shift, power)
            power = _times(power, power)
            bits >>= 1
        out = _times(shift, out) ^ crc
    return out


def _joined(crcs: pd.Series, lengths: pd.Series) -> pd.Series:
    return pd.Series([joined_crc32(list(map(int, c)), list(map(int, n))) for c, n in zip(crcs, lengths, strict=True)])


@query("op2_rans_tokens")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{staging_folder(spark).rstrip('/')}/rans-{uuid.uuid4().hex}"
    write(table(spark, folder, "documents", "doc_id", "text"), path)
    pieces = read(spark, path).select("doc_id", "start", "piece_from", "n_ids", F.crc32("ids").alias("crc"))
    # A document is known by its place; the pieces of a long one are few and small here.
    whole = pieces.groupBy("doc_id", "start").agg(
        F.sum("n_ids").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("piece_from", "crc", "n_ids"))).alias("p")
    )
    joined = F.pandas_udf(_joined, "long")
    return whole.select(
        "doc_id", "start", "n_tokens", joined(F.col("p.crc"), F.transform("p.n_ids", lambda n: 4 * n)).alias("ids_crc32")
    )
