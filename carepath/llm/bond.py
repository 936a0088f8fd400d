"""Hard negatives by branch and bound on decomposed data.

Vectors are compared by their integer inner product. Rows are dealt to blocks and each block is
turned into columns, one per dimension. An anchor reads the columns in descending order of its own
magnitudes, a few at a time. What the unread ones can still add to any row of the block lies
between the sums of their least and greatest contributions, so every row has a lower and an upper
bound; rows that can no longer be wanted leave the candidate bitmap, and the few that stay get
exact scores.

Two sweeps of all anchors over all rows, anchors and rows in blocks of bounded size: the first finds each anchor's
best rows of its own label (positives), the second the best rows of other labels whose scores
lie within the window that each positive opens. A block returns its own best few for an anchor;
Spark ranks them. No group is formed by label, so a label that most rows have does no harm.

Cases: rows with a NULL id, label or vector, or a component that is NULL or not finite, take no
part. Of rows with the same id the smallest by label and vector counts. A shorter vector has zeros at its end. Equal
scores are ordered by id. An anchor without positives, and a positive whose window no row is in,
give no rows; so do a positive score below zero (its window is empty) and an empty table. Other
columns are not read. Scores that need more than 63 bits raise an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .base import query, table

#: Rows and anchors of a block.
ROWS, ANCHORS = 4096, 512
#: Columns read between two looks at the bounds.
STEP = 8
#: An exact float.
FLOAT = 1 << 53


def usable(rows: DataFrame, id_col: str, vector: str, label: Column, anchor: Column, scale: int) -> DataFrame:
    """(id, label, v, anchor): components as floor(scale * x), one row per id."""
    x = F.transform(vector, lambda c: c.cast("double"))
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    known = rows.where(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & ~odd)
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    kept = known.select(
        F.col(id_col).cast("long").alias("id"), F.struct(label.cast("long").alias("label"), whole.alias("v")).alias("row"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    return kept.groupBy("id").agg(F.min("row").alias("row"), F.max("anchor").alias("anchor")).select("id", "row.*", "anchor")


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Columns by dimension: width x rows, zeros where a vector is shorter."""
    vectors = vectors.combine_chunks()
    offsets = vectors.offsets.to_numpy()
    flat, size = vectors.values.to_numpy()[offsets[0] : offsets[-1]], np.diff(offsets)
    out = np.zeros((width, len(size)), np.int64)
    out[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), np.repeat(np.arange(len(size)), size)] = flat
    return out


class Columns:
    """A block of rows, dimension by dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, largest: int):
        self.ids, self.labels = ids, labels
        bound = largest * int(np.abs(x).max(axis=1, initial=0).astype(object).sum())
        if bound >= 1 << 63:
            raise ValueError("vectors too long for scores of 63 bits")
        #: Floats as long as they are exact.
        self.kind = np.float64 if bound < FLOAT else np.int64
        self.x = x.astype(self.kind)
        self.low, self.high = self.x.min(axis=1), self.x.max(axis=1)

    def scores(self, q: np.ndarray, rows: np.ndarray, wanted) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores of the rows that wanted(lower, upper), given bounds, keeps to the end."""
        q = q.astype(self.kind)
        order = np.argsort(-np.abs(q), kind="stable")
        ends = np.stack([q * self.low, q * self.high])[:, order]
        # What the columns from the k-th on can add at least and at most.
        least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        score = np.zeros(len(rows), self.kind)
        for k in range(0, len(order), STEP):
            if not len(rows):
                break
            read = order[k : k + STEP]
            part = self.x[read] if len(rows) == len(self.ids) else self.x[read[:, None], rows]
            score += q[read] @ part
            done = min(k + STEP, len(order))
            stay = wanted(score + least[done], score + most[done])
            if not stay.all():
                rows, score = rows[stay], score[stay]
        return rows, score


def kth(values: np.ndarray, k: int):
    """The k-th largest value; less than any if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def best(rows: Columns, at: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k highest scores, ties by id."""
    first = np.lexsort((rows.ids[at], -score))[:k]
    return rows.ids[at[first]], score[first].astype(np.int64)


def positives_of(rows: Columns, own: int, label: int, q: np.ndarray, k: int):
    same = np.flatnonzero((rows.labels == label) & (rows.ids != own))
    at, score = rows.scores(q, same, lambda low, high: high >= kth(low, k))
    return best(rows, at, score, k)


def negatives_of(rows: Columns, label: int, q: np.ndarray, windows: list[tuple[int, int]], k: int):
    """For each window (low, high) the k best rows of another label with a score inside."""

    def wanted(low, high):
        keep = np.zeros(len(low), bool)
        for a, b in windows:
            inside = low[(low >= a) & (high <= b)]
            keep |= (high >= max(a, kth(inside, k))) & (low <= b)
        return keep

    at, score = rows.scores(q, np.flatnonzero(rows.labels != label), wanted)
    return [best(rows, at[f := (score >= a) & (score <= b)], score[f], k) for a, b in windows]


def sweep(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, search, schema: str) -> DataFrame:
    """search(Columns, anchor table, anchor matrix) for every block of anchors against every block of rows."""
    r, a = max(1, math.ceil(n_rows / ROWS)), max(1, math.ceil(n_anchors / ANCHORS))
    part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("id", "label", "v", part(r).alias("r"), each(a).alias("a"))
    right = anchors.select("*", part(a).alias("a"), each(r).alias("r"))

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not (mine.num_rows and theirs.num_rows):
            return out.empty_table()
        width = max(max(t.column("v").combine_chunks().value_lengths().to_numpy()) for t in (mine, theirs))
        q = matrix(theirs.column("v"), width)
        block = Columns(
            mine.column("id").to_numpy(), mine.column("label").to_numpy(), matrix(mine.column("v"), width),
            int(np.abs(q).max(initial=0)),
        )
        found = search(block, theirs.drop_columns(["v", "r", "a"]).to_pylist(), q)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in found], schema=out)

    out = pa.schema([(n, pa.int64()) for n in schema.split()])
    return left.groupBy("r", "a").cogroup(right.groupBy("r", "a")).applyInArrow(meet, ", ".join(f"{n} long" for n in schema.split()))


def ranked(found: DataFrame, keys: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: Column | None = None,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchor: which rows are anchors. A negative's score lies between low and high hundredths of
    the positive's, both included.
    """
    label = F.col("label") if label is None else label
    base = stage(usable(rows, id_col, vector, label, anchor, scale), "vectors")
    anchors = base.where("anchor").drop("anchor")
    n_rows, n_anchors = base.count(), anchors.count()

    def near(block, these, q):
        out = [[], [], []]
        for k, t in enumerate(these):
            ids, scores = positives_of(block, t["id"], t["label"], q[:, k], positives)
            out[0] += [t["id"]] * len(ids)
            out[1] += ids.tolist()
            out[2] += scores.tolist()
        return out

    found = sweep(base, anchors, n_rows, n_anchors, near, "anchor_id positive_id positive_score")
    chosen = ranked(found, ["anchor_id"], "positive_score", "positive_id", positives)
    pairs = F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    chosen = chosen.groupBy("anchor_id").agg(pairs)  # as many as positives at most
    led = stage(anchors.join(chosen, F.col("id") == F.col("anchor_id")).drop("anchor_id"), "anchors")

    def far(block, these, q):
        out = [[] for _ in range(5)]
        for k, t in enumerate(these):
            given = [p for p in t["positives"] if p["positive_score"] >= 0]
            windows = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in given]
            for p, (ids, scores) in zip(given, negatives_of(block, t["label"], q[:, k], windows, negatives), strict=True):
                out[0] += [t["id"]] * len(ids)
                out[1] += [p["positive_id"]] * len(ids)
                out[2] += ids.tolist()
                out[3] += [p["positive_score"]] * len(ids)
                out[4] += scores.tolist()
        return out

    found = sweep(base, led, n_rows, n_anchors, far, "anchor_id positive_id negative_id positive_score negative_score")
    top = ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return top.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM e a JOIN e r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.other AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM pos p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""


@query("op13_hard_negatives", SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    own = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label=own)
