"""Language identification: averaged hashed subword embeddings and a linear softmax.

A word's subwords are its character n-grams with marks for both ends, hashed into BUCKETS rows
of an embedding table. A text is the mean of the embeddings of all its subwords; a linear layer
and softmax give the probability of each language. Both layers are trained together by
stochastic gradient descent in numpy, on a sample of at most MAX_SAMPLE labelled texts per
language and MAX_ROWS in all (the smallest by hash of id and text; a repeated row counts once),
each cut to WINDOWS windows of TRAIN_CHARS characters for training only. Every fifth text of the
sample is kept from training: on these, read whole as in prediction, a temperature is fitted, which
makes the score a probability, and a rejection threshold, the smallest one above which a share of at
least PRECISION of the predictions is right. Rejection is a column of its own.

Prediction reads whole texts. As the layers are linear, a subword's embedding times the linear
layer is one row of logits; the logits of each distinct word of a block of texts are summed
once and added up per text. The model (BUCKETS x languages numbers) goes along with the tasks.

Cases: NULL texts and texts without a letter get ``und`` with score 0 and are rejected; so do
all texts if there is nothing to learn from. Equal texts get equal answers. Labels that are NULL
are not learned from. One language only is predicted with score 1. More than MAX_LANGUAGES labels are
refused. An empty table gives no rows; columns besides id, text and label are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .base import query, table
from .wordbytes import BLOCK, SPACE, blocks, mix, text_bytes

BUCKETS = 1 << 15
DIMENSIONS = 16
GRAMS = (1, 2, 3)
#: Labelled texts per language that are learned from and calibrated on.
MAX_SAMPLE = 2_000
#: The same for all languages together.
MAX_ROWS = 40_000
MAX_LANGUAGES = 500
TRAIN_CHARS = 200
WINDOWS = 4
EPOCHS = 5
BATCH = 64
RATE = 0.5
PRECISION = 0.99
UNKNOWN = "und"

BEGIN, STOP = 2, 3  # marks for the ends of a word
_FACTOR = np.uint64(0x9E3779B97F4A7C13)


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: is it a letter; does it belong to words (letters, marks, apostrophe)."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    letter = np.array([k == "L" for k in kinds])
    inner = letter | np.array([k == "M" for k in kinds])
    inner[ord("'")] = True
    return letter, inner


def grams(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(buckets, index of the text) for every length of n-gram, texts ascending; letters per text."""
    letter, inner = _classes()
    joined = "\0".join(t.replace("\0", " ").lower() for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    owner = np.cumsum(codes == 0)
    letters = np.bincount(owner[letter[codes]], minlength=len(texts))
    solid = np.concatenate([[False], inner[codes], [False]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    starts, stops = edge[::2], edge[1::2]
    if not len(starts):
        return [], letters
    # All words in a row, each between its marks.
    size = stops - starts + 2
    begin = np.cumsum(size) - size
    word = np.repeat(np.arange(len(starts)), size)
    marked = np.full(begin[-1] + size[-1], STOP, np.uint64)
    marked[begin] = BEGIN
    inside = np.arange(len(marked)) - begin[word]
    middle = (inside > 0) & (inside < size[word] - 1)
    marked[middle] = codes[(starts[word] + inside - 1)[middle]]
    owner = owner[starts][word]
    out, value = [], np.zeros(len(marked), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        m = len(marked) - n + 1
        value = mix(value[:m] * _FACTOR + marked[n - 1 :])
        if n in GRAMS:
            at = np.flatnonzero(word[:m] == word[n - 1 :])
            out.append(((value[at] % np.uint64(BUCKETS)).astype(np.int64), owner[at]))
    return out, letters


def summed(rows: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each owner; owners ascending."""
    out = np.zeros((n, rows.shape[1]))
    if len(owner):
        at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[at]] = np.add.reduceat(rows, at, axis=0)
    return out


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # BUCKETS x languages: embeddings times the linear layer
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = sums / np.maximum(counts, 1)[:, None] + self.bias
        return softmax(z / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def bags(texts: list[str]) -> list[np.ndarray]:
    """Buckets of all n-grams of each text."""
    parts, _ = grams(texts)
    cuts = [np.searchsorted(owner, np.arange(len(texts) + 1)) for _, owner in parts]
    return [
        np.concatenate([np.zeros(0, np.int64), *(b[c[i] : c[i + 1]] for (b, _), c in zip(parts, cuts, strict=True))])
        for i in range(len(texts))
    ]


def pieces_of(text: str) -> list[str]:
    """At most WINDOWS pieces of at most TRAIN_CHARS characters, evenly over the text."""
    n = max(1, min(WINDOWS, -(-len(text) // TRAIN_CHARS)))
    at = [k * len(text) // n for k in range(n + 1)]
    return [text[i : min(j, i + TRAIN_CHARS)] for i, j in zip(at, at[1:], strict=False)]


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Fit the model on labelled texts; every fifth text of a language calibrates."""
    languages = sorted(set(labels))
    index = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    turn: dict[str, int] = {}
    pieces, targets, held_texts, held_targets = [], [], [], []
    for text, lang in zip(texts, labels, strict=True):
        turn[lang] = turn.get(lang, 0) + 1
        if turn[lang] % 5 == 0:
            held_texts.append(text), held_targets.append(index[lang])
            continue
        for piece in pieces_of(text):
            pieces.append(piece), targets.append(index[lang])
    examples = [(b, y) for b, y in zip(bags(pieces), targets, strict=True) if len(b)]
    n = len(languages)
    table_ = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    linear = np.zeros((DIMENSIONS, n))
    bias = np.zeros(n)
    steps = EPOCHS * -(-len(examples) // BATCH)
    done = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            part = [examples[i] for i in order[at : at + BATCH]]
            rows = np.concatenate([b for b, _ in part])
            sizes = np.array([len(b) for b, _ in part])
            cuts = np.append(0, np.cumsum(sizes)[:-1])
            mean = np.add.reduceat(table_[rows], cuts, axis=0) / sizes[:, None]
            error = softmax(mean @ linear + bias)
            error[np.arange(len(part)), [y for _, y in part]] -= 1
            rate = RATE * (1 - done / steps)
            back = error @ linear.T
            linear -= rate * mean.T @ error / len(part) * DIMENSIONS
            bias -= rate * error.mean(axis=0)
            np.add.at(table_, rows, -rate * np.repeat(back / sizes[:, None], sizes, axis=0))
            done += 1
    model = Model(languages, (table_ @ linear).astype(np.float32), bias, 1.0, 0.0)
    held = [(b, y) for b, y in zip(bags(held_texts), held_targets, strict=True) if len(b)]
    if held:
        sums = np.stack([model.logits[b].sum(axis=0) for b, _ in held])
        calibrate(model, sums, np.array([len(b) for b, _ in held]), np.array([y for _, y in held]))
    return model


def calibrate(model: Model, sums: np.ndarray, counts: np.ndarray, y: np.ndarray) -> None:
    """Temperature of least log loss, then the smallest threshold of enough precision.

    sums: summed logits of the subwords of each text; counts: their number; y: the language.
    """
    losses = []
    doubt = 1 / (len(y) + 2)  # a finite sample never shows certainty
    grid = np.geomspace(0.02, 20, 61)
    for model.temperature in grid:
        p = model.probabilities(sums, counts)
        own = p[np.arange(len(y)), y]
        losses.append(-((1 - doubt) * np.log(own + 1e-300) + doubt * np.log(1 - own + 1e-300)).mean())
    model.temperature = float(grid[int(np.argmin(losses))])
    p = model.probabilities(sums, counts)
    order = np.argsort(-p.max(axis=1), kind="stable")
    right = (p.argmax(axis=1) == y)[order]
    share = np.cumsum(right) / np.arange(1, len(right) + 1)
    good = np.flatnonzero(share >= PRECISION)
    model.threshold = float(p.max(axis=1)[order][good[-1]]) if len(good) else 1.0


def sampled(docs: DataFrame, id_col: str, text: str, label: str) -> DataFrame | None:
    """(lang, turn, text): at most MAX_SAMPLE texts per language and MAX_ROWS in all, written once.

    Repeated rows are one candidate, combined before the exchange, so no id or text can fill the
    sample or a task; the candidates are few more than the texts that are kept.
    """
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.xxhash64(F.col(id_col).cast("string"), F.col(text)).alias("key"),
        F.col(label).alias("lang"),
        F.col(text).alias("text"),
    )
    counts = known.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    most = max(5, min(MAX_SAMPLE, MAX_ROWS // len(counts)))
    # A little more than asked for, by hash; the rest is cut by rank.
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 1.1 * most / r["n"]))])
    some = known.where(F.pmod("key", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * float(1 << 30))
    once = some.groupBy("lang", "key").agg(F.min("text").alias("text"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    return stage(once.select("lang", turn.alias("turn"), "text").where(F.col("turn") <= most), "language-sample")


def learn(docs: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang") -> Model | None:
    """A model from docs, of whose sample only windows and summed logits reach the driver."""
    sample = sampled(docs, id_col, text, label)
    if sample is None:
        return None
    rows = sample.select("lang", "turn", windows_of(F.col("text")).alias("text")).collect()
    rows.sort(key=lambda r: (r["lang"], r["turn"]))
    model = train([r["text"] for r in rows], [r["lang"] for r in rows])
    if model is not None:
        # The texts that train() kept from learning, whole.
        held = summed_logits(sample.where(F.col("turn") % 5 == 0), model).where("n > 0").collect()
        if held:
            index = {lang: i for i, lang in enumerate(model.languages)}
            held.sort(key=lambda r: (r["lang"], r["turn"]))
            sums, counts = np.array([r["sums"] for r in held]), np.array([r["n"] for r in held])
            calibrate(model, sums, counts, np.array([index[r["lang"]] for r in held]))
    return model


def summed_logits(texts: DataFrame, model: Model) -> DataFrame:
    """(lang, turn, sums, n): logits of all subwords of a text, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            found = scorer.sums(batch.column(2))
            sums = pa.array(found[:, :-2].tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sums, pa.array(found[:, -2])], ["lang", "turn", "sums", "n"]
            )

    return texts.select("lang", "turn", "text").mapInArrow(run, "lang string, turn int, sums array<double>, n double")


def windows_of(text):
    """The windows of a text that are trained on, so that the sample's size is bounded."""
    step = F.greatest(F.lit(TRAIN_CHARS), F.floor(F.char_length(text) / WINDOWS).cast("int"))
    return F.when(F.char_length(text) <= TRAIN_CHARS * WINDOWS, text).otherwise(
        F.array_join(
            F.transform(
                F.sequence(F.lit(0), F.lit(WINDOWS - 1)),
                lambda k: F.substring(text, k * step + 1, F.lit(TRAIN_CHARS)),
            ),
            " ",
        )
    )


class _Scorer:
    """Summed logits and number of subwords of each distinct word, kept within a task."""

    LIMIT = 400_000

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.table = np.zeros((0, len(self.model.languages) + 2))

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities, and whether the text has a letter."""
        sums = self.sums(texts)
        return self.model.probabilities(sums[:, :-2], sums[:, -2]), sums[:, -1] > 0.5

    def sums(self, texts: pa.Array) -> np.ndarray:
        """Summed logits, number of subwords and of chunks with a letter of each text."""
        raw, offsets = text_bytes(texts)
        n = len(offsets) - 1
        sums = np.zeros((n, len(self.model.languages) + 2))
        for i, j in blocks(offsets, 4 * BLOCK):
            part, bounds = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            space = SPACE[part]
            cut = np.zeros(len(part) + 1, bool)
            cut[1:-1] = space[1:] & ~space[:-1]
            cut[bounds] = True
            cut[-1] = True
            at = np.flatnonzero(cut)
            if len(at) < 2:
                continue
            chunks = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(part)).dictionary_encode()
            own = self.values(chunks.dictionary.to_pylist())[chunks.indices.to_numpy()]
            total = np.vstack([np.zeros((1, own.shape[1])), np.cumsum(own, axis=0)])
            first = np.searchsorted(at, bounds)
            sums[i:j] = total[first[1:]] - total[first[:-1]]
        return sums

    def values(self, chunks: list[str]) -> np.ndarray:
        """Logits, subwords and letters (0 or 1) of chunks, which end at white space."""
        if len(self.number) > self.LIMIT:
            self.clear()
        fresh = []
        for c in chunks:
            if c not in self.number:
                self.number[c] = len(self.number)
                fresh.append(c)
        if fresh:
            parts, letters = grams(fresh)
            value = np.zeros((len(fresh), self.table.shape[1]))
            for buckets, owner in parts:
                value[:, :-2] += summed(self.model.logits[buckets], owner, len(fresh))
                value[:, -2] += np.bincount(owner, minlength=len(fresh))
            value[:, -1] = letters > 0
            self.table = np.vstack([self.table, value])
        return self.table[np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))]


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, accepted) for every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model) if model else None
        for batch in batches:
            if scorer:
                p, letters = scorer.score(batch.column(1))
                names = np.array(scorer.model.languages, object)[p.argmax(axis=1)]
                score = np.where(letters, p.max(axis=1), 0.0)
                names = np.where(letters, names, UNKNOWN)
                accepted = letters & (score >= scorer.model.threshold)
            else:
                names = np.full(batch.num_rows, UNKNOWN, object)
                score, accepted = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(accepted)],
                ["doc_id", "lang_pred", "score", "accepted"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = learn(docs.where(~held))
    found = identify(docs, model)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")
