"""Alignment of the tokens of two tokenizers over the same texts.

A: byte-level BPE over a space and the text. B: sentence pieces of the text, before which the model
puts a space. Where a token of A and one of B end at the same byte, the text can be cut. A document is
divided there and conquered: the tokens of A near the middle of an interval are looked up among the ends of B by
bisection, nearest first; at a common end both halves are intervals of their own, and an interval without
one is a leaf, a group of tokens that belong together. All intervals of a block of texts are
divided at once, level by level.

Every pair of an A and a B token whose bytes overlap is a link: one for each stretch between two
neighbouring ends of either. Pairs of ids are counted over the whole corpus. A task numbers the distinct
pairs of a run of documents and writes them beside the documents, which hold numbers only. Pairs
are summed over the runs, the sums go back to the runs, and each run's documents meet them in one
group of bounded size. A pair that every document has is one row per run, and nothing is broadcast.

Cases: NULL and empty texts have no tokens, nor have texts whose tokens don't spell the space and
the text again. Strings of special tokens are plain text. Repeated rows are counted each. NULL ids are
ids like any other. No documents give no rows. Other columns are not read. A run holds RUN bytes of text or one longer document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..sources.staging import stage
from .base import query, table
from .chunks import Encoder, encoder
from .wordbytes import BLOCK, blocks, text_bytes

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text whose documents share their numbers of pairs.
RUN = 16 << 20
#: Rows in a record batch.
BATCH = 20_000


class PieceEncoder(Encoder):
    """Ids of texts that begin with a space, from a dictionary of chunks cut before spaces.

    No piece has a space after another character, so the ids of a text are those of its chunks.
    """

    def __init__(self, name: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.size = self.model.get_piece_size()
        self.pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        assert not any("▁" in p.lstrip("▁") for p in self.pieces)
        self.space = self.model.piece_to_id("▁")
        self._clear()

    def _learn(self) -> None:
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if not fresh:
            return
        # The model puts the space back, but not before nothing.
        ids = [x or [self.space] for x in self.model.encode([c[1:] for c in fresh], num_threads=1)]
        sizes = np.array([len(x) for x in ids], np.int64)
        none = np.zeros(len(fresh), np.int64)
        self.begin = np.append(self.begin, len(self.flat) + np.cumsum(sizes) - sizes)
        self.count = np.append(self.count, sizes)
        self.seen = np.append(self.seen, none)
        self.flat = np.append(self.flat, np.array([i for x in ids for i in x], np.uint32))
        self.characters += sum(map(len, fresh))

    def _number_block(self, raw: np.ndarray, offsets: np.ndarray, fine: bool = True) -> tuple[np.ndarray, ...]:
        space = raw == 0x20
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        cut[offsets] = True
        cut[-1] = True
        at = np.flatnonzero(cut)
        chunks = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(raw)).dictionary_encode()
        known = self.numbered(chunks.dictionary.to_pylist())
        return known[chunks.indices.to_numpy()], np.searchsorted(at, offsets), at


@lru_cache(maxsize=2)
def piece_encoder(name: str) -> PieceEncoder:
    return PieceEncoder(name)


@lru_cache(maxsize=2)
def plain_tokenizer(name: str) -> Tokenizer:
    out = Tokenizer.from_file(public_tokenizers.path(name))
    out.encode_special_tokens = True
    return out


@lru_cache(maxsize=2)
def bytes_of_a(name: str) -> pa.Array:
    """The bytes of each id of a byte-level vocabulary.

    There, bytes that are printable characters of Latin-1 stand for themselves, the others for
    the characters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    tok = plain_tokenizer(name)
    return pa.array([bytes(byte[c] for c in tok.id_to_token(i) or "") for i in range(tok.get_vocab_size())], pa.binary())


@lru_cache(maxsize=2)
def bytes_of_b(name: str) -> pa.Array:
    enc = piece_encoder(name)
    alone = [enc.model.is_byte(i) for i in range(enc.size)]
    return pa.array(
        [bytes([int(p[1:-1], 16)]) if one else p.replace("▁", " ").encode() for p, one in zip(enc.pieces, alone, strict=True)],
        pa.binary(),
    )


def ids_of_a(texts: pa.Array, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts, strings of special tokens being plain text, and where each text's begin."""
    enc = encoder(name)
    odd = np.zeros(len(texts), bool)
    for token in enc.special:
        odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
    if not odd.any():
        return enc.ids(texts)
    flat, at = enc.ids(pc.if_else(pa.array(odd), "", texts))
    own = {i: plain_tokenizer(name).encode(texts[i].as_py(), add_special_tokens=False).ids for i in np.flatnonzero(odd).tolist()}
    parts = [np.array(own[i], np.uint32) if odd[i] else flat[at[i] : at[i + 1]] for i in range(len(texts))]
    return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))


def spelled(ids: np.ndarray, spelling: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the tokens, and the byte at which each ends."""
    taken = spelling.take(pa.array(ids)).cast(pa.large_binary())
    if not len(ids):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, data = taken.buffers()
    return np.frombuffer(data, np.uint8), np.frombuffer(offsets, np.int64)[1 : len(ids) + 1]


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Ascending numbers of the A tokens that end where a B token ends.

    last: number of the last A token of each document; documents end alike in A and B.
    """

    def shared(k: np.ndarray) -> np.ndarray:
        at = np.searchsorted(ends_b, ends_a[k])
        return ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a[k]

    done = [last]
    low, high = np.append(0, last[:-1] + 1), last  # the end of token high is a cut already
    while len(low):
        low, high = low[high > low], high[high > low]
        middle = (low + high - 1) // 2
        cut = np.full(len(low), -1)
        here = shared(middle)
        cut[here] = middle[here]
        near = 1  # distances from near to 2 * near - 1 are looked at together
        open_ = np.flatnonzero(cut < 0)
        while len(open_):
            away = np.arange(near, 2 * near)
            probe = middle[open_, None] + np.stack([-away, away], 1).reshape(-1)[None, :]
            inside = (probe >= low[open_, None]) & (probe < high[open_, None])
            hit = np.zeros(probe.shape, bool)
            hit[inside] = shared(probe[inside])
            found = hit.any(axis=1)
            cut[open_[found]] = probe[found, hit[found].argmax(axis=1)]
            near *= 2
            open_ = open_[~found & (inside.any(axis=1))]
        split = cut >= 0  # the others are leaves
        done.append(cut[split])
        low, high = (
            np.concatenate([low[split], cut[split] + 1]),
            np.concatenate([cut[split], high[split]]),
        )
    return np.sort(np.concatenate(done))


@lru_cache(maxsize=1)
def numerals(size: int) -> pa.Array:
    """Decimal numbers below size after nothing, a comma, a semicolon and a bar."""
    return pa.array([mark + str(i) for mark in ("", ",", ";", "|") for i in range(size)], pa.string())


class Aligned:
    """The alignment of a block of texts."""

    def __init__(self, texts: pa.Array, a: str, b: str):
        empty = pc.equal(pc.fill_null(texts, ""), "")
        texts = pc.if_else(empty, "", pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), ""))
        raw, offsets = text_bytes(texts)
        self.ids_a, at_a = ids_of_a(texts, a)
        self.ids_b, at_b = piece_encoder(b).ids(texts)
        (raw_a, self.ends_a), (raw_b, self.ends_b) = spelled(self.ids_a, bytes_of_a(a)), spelled(self.ids_b, bytes_of_b(b))
        self._drop_unlike(raw, offsets, raw_a, at_a, raw_b, at_b, a, b)
        here = np.flatnonzero(np.diff(self.at_a) > 0)
        last = self.at_a[here + 1] - 1
        self.cuts = common_ends(self.ends_a, self.ends_b, last) if len(here) else np.zeros(0, np.int64)
        #: Number of the B token that ends with each group.
        self.cuts_b = np.searchsorted(self.ends_b, self.ends_a[self.cuts])
        self.n_groups = np.diff(np.searchsorted(self.cuts, self.at_a))

    def _drop_unlike(self, raw, offsets, raw_a, at_a, raw_b, at_b, a, b) -> None:
        """Take the tokens from the texts that they do not spell."""
        same = []
        for mine, ends, at in ((raw_a, self.ends_a, at_a), (raw_b, self.ends_b, at_b)):
            byte = np.append(0, ends)[at]
            alike = np.diff(byte) == np.diff(offsets)
            for d in np.flatnonzero(alike):
                alike[d] = np.array_equal(mine[byte[d] : byte[d + 1]], raw[offsets[d] : offsets[d + 1]])
            same.append(alike)
        keep = same[0] & same[1]
        if not keep.all():
            n_a, n_b = np.diff(at_a), np.diff(at_b)
            self.ids_a, self.ids_b = self.ids_a[np.repeat(keep, n_a)], self.ids_b[np.repeat(keep, n_b)]
            at_a, at_b = np.append(0, np.cumsum(n_a * keep)), np.append(0, np.cumsum(n_b * keep))
            self.ends_a, self.ends_b = spelled(self.ids_a, bytes_of_a(a))[1], spelled(self.ids_b, bytes_of_b(b))[1]
        self.at_a, self.at_b = at_a, at_b

    def groups(self) -> tuple[memoryview, np.ndarray]:
        """Text of all groups (a1,a2|b1;a3|b2,b3), and where each document's begins."""
        size = max(bytes_size(A), bytes_size(B), int(self.ids_a.max(initial=0)) + 1, int(self.ids_b.max(initial=0)) + 1)
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        group_a = np.searchsorted(self.cuts, np.arange(n_a))
        group_b = np.searchsorted(self.cuts_b, np.arange(n_b))
        place_a = np.arange(n_a) + np.append(0, self.cuts_b + 1)[group_a]
        place_b = np.arange(n_b) + self.cuts[group_b] + 1
        mark_a, mark_b = np.ones(n_a, np.int64), np.ones(n_b, np.int64)
        mark_a[np.append(0, self.cuts + 1)[:-1]] = 2
        mark_a[self.at_a[:-1][np.diff(self.at_a) > 0]] = 0
        mark_b[np.append(0, self.cuts_b + 1)[:-1]] = 3
        shown = np.empty(n_a + n_b, np.int64)
        shown[place_a], shown[place_b] = mark_a * size + self.ids_a, mark_b * size + self.ids_b
        text = numerals(size).take(pa.array(shown)).cast(pa.large_string())
        at = self.at_a + self.at_b
        if not len(shown):
            return memoryview(b""), at
        _, offsets, data = text.buffers()
        return memoryview(data), np.frombuffer(offsets, np.int64)[at]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pair of ids (A above 32 bits) of each link, and where each document's links begin."""
        ends = np.union1d(self.ends_a, self.ends_b)
        a, b = np.searchsorted(self.ends_a, ends), np.searchsorted(self.ends_b, ends)
        pair = (self.ids_a[a].astype(np.int64) << 32) | self.ids_b[b]
        return pair, np.searchsorted(ends, np.append(0, self.ends_a)[self.at_a], "right")


def bytes_size(name: str) -> int:
    return len(bytes_of_a(name) if name.endswith(".json") else bytes_of_b(name))


def lists(rows: pa.Array, values: np.ndarray) -> pa.Array:
    """Binary cells of 32-bit numbers; rows: where each cell begins among the values."""
    values = np.ascontiguousarray(values, "<u4")
    return pa.Array.from_buffers(pa.binary(), len(rows) - 1, [None, pa.py_buffer((4 * rows).astype(np.int32)), pa.py_buffer(values)])


def encoded(docs: DataFrame, id_col: str, text: str, a: str, b: str, with_groups: bool) -> DataFrame:
    """Rows of documents, and rows of the pairs of a run (pair, n; doc columns NULL).

    A document has its distinct pairs as numbers of its run (slots), and how often it has each (times).
    """
    bare = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = bare.schema["doc_id"].dataType.simpleString()
    names = ["run", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "slots", "times", "slot", "pair", "n"]
    types = dict(n_a=pa.int64(), n_b=pa.int64(), n_groups=pa.int64(), n_links=pa.int64(), groups_sha256=pa.string(), groups=pa.string(),
                 slots=pa.binary(), times=pa.binary(), slot=pa.int32(), pair=pa.int64(), n=pa.int64())

    def batch_of(size: int, id_type: pa.DataType, **columns) -> pa.RecordBatch:
        none = lambda c: pa.nulls(size, id_type if c == "doc_id" else types[c])
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else none(c) for c in names], names)

    def run_of(slots: dict, counts: list, run: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        pair, n = np.fromiter(slots, np.int64, len(slots)), np.array(counts, np.int64)
        for i in range(0, len(pair), BATCH):
            part = slice(i, min(i + BATCH, len(pair)))
            size = part.stop - i
            yield batch_of(
                size, id_type, run=pa.array(np.full(size, run)), slot=pa.array(np.arange(i, part.stop, dtype=np.int32)),
                pair=pa.array(pair[part]), n=pa.array(n[part]),
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 32
        slots, counts, held, id_type = {}, [], 0, None
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            id_type = batch.column(0).type
            for i, j in blocks(offsets):
                if held + offsets[j] - offsets[i] > RUN and slots:
                    yield from run_of(slots, counts, run, id_type)
                    slots, counts, held, run = {}, [], 0, run + 1
                held += offsets[j] - offsets[i]
                found = Aligned(batch.column(1).slice(i, j - i), a, b)
                shown, at = found.groups()
                pair, first = found.links()
                distinct, inverse = np.unique(pair, return_inverse=True)
                number = np.fromiter((slots.setdefault(p, len(slots)) for p in distinct.tolist()), np.int64, len(distinct))
                counts += [0] * (len(slots) - len(counts))
                for s, n in zip(number.tolist(), np.bincount(inverse, minlength=len(distinct)).tolist(), strict=True):
                    counts[s] += n
                n_links = np.diff(first)
                own = np.repeat(np.arange(j - i) << 32, n_links) | number[inverse]
                own, times = np.unique(own, return_counts=True)
                rows = np.searchsorted(own, np.arange(j - i + 1) << 32)
                texts = [bytes(shown[at[k] : at[k + 1]]) for k in range(j - i)]
                hexes = [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
                more = {"groups": pa.array([t.decode() for t in texts], pa.string())} if with_groups else {}
                yield batch_of(
                    j - i, id_type, run=pa.array(np.full(j - i, run)), doc_id=batch.column(0).slice(i, j - i),
                    n_a=pa.array(np.diff(found.at_a)), n_b=pa.array(np.diff(found.at_b)), n_groups=pa.array(found.n_groups),
                    n_links=pa.array(n_links), groups_sha256=pa.array(hexes, pa.string()),
                    slots=lists(rows, own & 0xFFFFFFFF), times=lists(rows, times), **more,
                )
        if slots:
            yield from run_of(slots, counts, run, id_type)

    schema = (
        f"run long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
        "slots binary, times binary, slot int, pair long, n long"
    )
    return bare.mapInArrow(work, schema)


def flat_numbers(cells: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of binary cells in a row, and where each cell's begin."""
    cells = cells.cast(pa.large_binary()).combine_chunks()
    _, offsets, data = cells.buffers()
    at = np.frombuffer(offsets, np.int64, len(cells) + 1, 8 * cells.offset)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), "<u4"), (at - at[0]) // 4


def align(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", a: str = A, b: str = B, with_groups: bool = False
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; with_groups: the groups as well."""
    both = stage(encoded(docs, id_col, text, a, b, with_groups), "aligned")
    pairs = both.where("slots IS NULL").select(F.col("run").alias("of_run"), "slot", "pair", "n")
    rows = both.where("slots IS NOT NULL").drop("slot", "pair", "n", *([] if with_groups else ["groups"]))
    # From here on: pairs once per run, at most as many as two vocabularies allow.
    total = pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    top = total.groupBy(F.col("b").alias("top_b")).agg(F.max("count").alias("top"))
    scored = total.join(top, F.col("b") == F.col("top_b")).select(
        F.col("pair").alias("of"), "count", (F.col("count") == F.col("top")).alias("best")
    )
    known = pairs.join(scored, F.col("pair") == F.col("of")).select("of_run", "slot", "count", "best")

    def finish(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        n = theirs.num_rows
        count, best = np.zeros(n, np.int64), np.zeros(n, bool)
        slot = theirs.column("slot").to_numpy()
        count[slot] = theirs.column("count").to_numpy()
        best[slot] = theirs.column("best").to_numpy()
        slots, at = flat_numbers(mine.column("slots"))
        times = flat_numbers(mine.column("times"))[0].astype(np.int64)
        sums = lambda x: pa.array(np.diff(np.append(0, np.cumsum(x))[at]))
        out = mine.drop_columns(["run", "slots", "times"])
        return out.append_column("n_best", sums(times * best[slots])).append_column("count_sum", sums(times * count[slots]))

    shape = [f for f in rows.schema.fields if f.name not in ("run", "slots", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shape) + ", n_best long, count_sum long"
    return rows.groupBy("run").cogroup(known.groupBy("of_run")).applyInArrow(finish, schema)


@query("op12_align_tokens")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = align(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
