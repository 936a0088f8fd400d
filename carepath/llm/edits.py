"""Token counts that follow edits: a segment tree of pre-tokens per document.

A tokenizer's pre-tokens never cross a place where white space follows something else, and
whether a place is such a cut depends on the two characters beside it only. A document's leaves
are runs of LEAF pre-tokens between such cuts; its tree keeps the characters and ids below
every node. An edit finds its leaves by walking down the characters; they are encoded anew,
together with the neighbour where the edit reaches a leaf's edge (the boundary context), and the
sums on the way up are corrected. All other leaves keep their counts unseen.

Edits of a document apply one after the other, each to the text that the former has left:
``start`` and ``length`` in characters, then the text put in. They are clipped to the text.

Cases: NULL text is empty, and so has no ids; after an edit it is what was put in. A NULL start
is the end of the text, a NULL length 0, a NULL insertion empty; NULL edits and lists of edits
do nothing. Repeated documents each get their row. Documents without edits keep their count. An
empty table gives none. Columns n_tokens, tree and reencoded_chars of the caller are replaced; all others stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import named_apart, query, table
from .chunks import Encoder, encoder

TOKENIZER = "byte_bpe_50k.json"
LEAF = 16
CUT = re.compile(r"(?<=\S)(?=[\x20\x09-\x0D])")
EDITS = "array<struct<start:int,length:int,text:string>>"


class Tree:
    """Characters and ids of leaves, summed up to the root (node 1)."""

    def __init__(self, chars: np.ndarray, ids: np.ndarray):
        self.leaves = len(chars)
        self.width = 1 << max(0, int(len(chars) - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width : self.width + len(chars), 0] = chars
        self.sums[self.width : self.width + len(chars), 1] = ids
        low = self.width
        while low > 1:  # level by level
            self.sums[low // 2 : low] = self.sums[low : 2 * low : 2] + self.sums[low + 1 : 2 * low : 2]
            low //= 2

    @classmethod
    def of_chunks(cls, chars: np.ndarray, ids: np.ndarray) -> Tree:
        at = np.arange(0, len(chars), LEAF)
        if not len(at):
            return cls(np.zeros(1, np.int64), np.zeros(1, np.int64))
        return cls(np.add.reduceat(chars, at), np.add.reduceat(ids, at))

    @classmethod
    def load(cls, data: bytes) -> Tree:
        tree = cls.__new__(cls)
        numbers = np.frombuffer(data, "<i8")
        tree.leaves = int(numbers[0])
        tree.sums = numbers[1:].reshape(-1, 2).copy()
        tree.width = len(tree.sums) // 2
        return tree

    def dump(self) -> bytes:
        return np.append(self.leaves, self.sums.ravel()).astype("<i8").tobytes()

    @property
    def total(self) -> int:
        return int(self.sums[1, 1])

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (the last leaf for the end), and where it begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place >= begin + self.sums[node, 0] and self.sums[node + 1, 0]:
                begin += int(self.sums[node, 0])
                node += 1
        return node - self.width, begin

    def put(self, leaf: int, chars: int, ids: int) -> None:
        node = leaf + self.width
        change = np.array([chars, ids]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2


class Document:
    """A text and its tree while edits are made."""

    def __init__(self, text: str, tree: Tree):
        self.text, self.tree, self.anew = text, tree, 0

    def change(self, e: dict) -> list[str]:
        """Put an edit into the text; the chunks that have to be encoded for settle()."""
        text, tree = self.text, self.tree
        start = len(text) if e["start"] is None else min(max(e["start"], 0), len(text))
        stop = min(start + max(e["length"] or 0, 0), len(text))
        new = e["text"] or ""
        self.first, begin = tree.find(max(start - 1, 0))  # the leaf before, if the edit is at an edge
        self.last, end = tree.find(min(stop + 1, len(text)))
        end += int(tree.sums[self.last + tree.width, 0])
        region = text[begin:start] + new + text[stop:end]
        self.text = text[:start] + new + text[stop:]
        cuts = [0, *(m.start() for m in CUT.finditer(region)), len(region)]
        self.chunks = [region[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]
        self.anew += len(region)
        return self.chunks

    def settle(self, counts: np.ndarray) -> None:
        """Bring the tree up to date with the ids of the changed chunks."""
        tree, first, last = self.tree, self.first, self.last
        chars = np.array([len(c) for c in self.chunks], np.int64)
        if len(chars) <= 4 * LEAF * (last - first + 1):
            for leaf in range(first + 1, last + 1):
                tree.put(leaf, 0, 0)
            tree.put(first, int(chars.sum()), int(counts.sum()))
        else:  # much text came in: new leaves for it, the sums of the others are kept
            old = tree.sums[tree.width : tree.width + tree.leaves]
            at = np.arange(0, len(chars), LEAF)
            fresh = np.stack([np.add.reduceat(chars, at), np.add.reduceat(counts, at)], axis=1)
            rows = np.concatenate([old[:first], fresh, old[last + 1 :]])
            self.tree = Tree(rows[:, 0], rows[:, 1])


def edit_all(documents: list[Document], edits: list[list[dict | None]], enc: Encoder) -> None:
    """Edits of many documents, the first ones of all encoded together, then the second ones."""
    queues = [[e for e in own if e is not None] for own in edits]
    for k in range(max(map(len, queues), default=0)):
        busy = [d for d, own in zip(documents, queues, strict=True) if k < len(own)]
        chunks = [d.change(own[k]) for d, own in zip(documents, queues, strict=True) if k < len(own)]
        counts = enc.counts([c for own in chunks for c in own])
        at = np.append(0, np.cumsum([len(own) for own in chunks]))
        for d, i, j in zip(busy, at[:-1], at[1:], strict=True):
            d.settle(counts[i:j])


def count(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """docs with n_tokens and tree (binary), what later edits start from."""
    place = docs.columns.index(text)
    taken = [c for c in docs.columns if c in ("n_tokens", "tree")]
    keep = [i for i, c in enumerate(docs.columns) if c not in taken]
    names = [docs.columns[i] for i in keep] + ["n_tokens", "tree"]
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c not in taken)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                trees = [Tree.of_chunks(chars, ids) for chars, ids in enc.sizes(part.column(place))]
                new = [pa.array([t.total for t in trees], pa.int64()), pa.array([t.dump() for t in trees], pa.binary())]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *new], names)

    return docs.mapInArrow(run, f"{fields}, n_tokens long, tree binary")


def recount(counted: DataFrame, edits: str, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """counted (from count()) after the edits in the array column edits: text, n_tokens and tree
    are brought up to date, and reencoded_chars says how much was encoded for it.
    """
    names = [c for c in counted.columns if c not in (edits, "reencoded_chars")]
    at = {c: counted.columns.index(c) for c in (text, "n_tokens", "tree", edits)}
    keep = [(counted.columns.index(c), c) for c in names]
    fields = ", ".join(f"`{c}` {t}" for c, t in counted.select(*[f"`{c}`" for c in names]).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                old = part.column(at[text]).to_pylist()
                trees = map(Tree.load, part.column(at["tree"]).to_pylist())
                made = [Document(t or "", tree) for t, tree in zip(old, trees, strict=True)]
                edit_all(made, [e or [] for e in part.column(at[edits]).to_pylist()], enc)
                fresh = {
                    text: pa.array([d.text if d.text or t is not None else None for d, t in zip(made, old, strict=True)], pa.string()),
                    "n_tokens": pa.array([d.tree.total for d in made], pa.int64()),
                    "tree": pa.array([d.tree.dump() for d in made], pa.binary()),
                }
                arrays = [fresh.get(c, part.column(k)) for k, c in keep]
                anew = pa.array([d.anew for d in made], pa.int64())
                yield pa.RecordBatch.from_arrays([*arrays, anew], [*names, "reencoded_chars"])

    return counted.mapInArrow(run, f"{fields}, reencoded_chars long")


def with_edits(counted: DataFrame, edits: DataFrame, id_col: str = "doc_id", column: str = "edits") -> DataFrame:
    """counted with an array column of its edits, from rows (id, seq, start, length, text)."""
    one = F.struct("seq", F.col("start").cast("int").alias("start"), F.col("length").cast("int").alias("length"), "text")
    name = named_apart(counted, "edited", "edits")
    lists = edits.groupBy(F.col(id_col).alias(name["edited"])).agg(F.sort_array(F.collect_list(one)).alias(name["edits"]))
    joined = counted.join(lists, F.col(id_col) == F.col(name["edited"]), "left")
    plain = F.transform(name["edits"], lambda e: F.struct(e["start"].alias("start"), e["length"].alias("length"), e["text"].alias("text")))
    return joined.withColumn(column, plain).drop(*name.values())


@query("op7_edit_counts")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Five edits of every document, made from its own text: a replacement, a joining of words,
    an insertion, an addition at the end and a deletion at the beginning."""
    counted = count(table(spark, folder, "documents", "doc_id", "text"))
    n = F.coalesce(F.char_length("text"), F.lit(0))
    edit = lambda start, length, text: F.struct(
        F.lit(start).cast("int").alias("start") if start is None else start.cast("int").alias("start"),
        F.lit(length).alias("length"),
        text.alias("text"),
    )
    changes = F.array(
        edit(F.floor(n / 3), 5, F.substring("text", 1, 12)),
        edit(F.floor(n / 2), 1, F.lit("")),
        edit(F.floor(2 * n / 3), 0, F.lit(" [edit]\n")),
        edit(None, 0, F.lit(" end.")),
        edit(F.lit(0), 3, F.lit("")),
    )
    before = counted.withColumns({"edits": changes, "n_before": F.col("n_tokens")})
    after = recount(before, "edits")
    return after.select(
        "doc_id", F.col("n_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_after"), "reencoded_chars",
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
