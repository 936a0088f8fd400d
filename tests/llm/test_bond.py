import math
import random

import numpy as np
from oracle import compare, connect
from plain import FOLDER, rows
from pyspark.sql import functions as F

from carepath.llm import ORACLES, QUERIES, bond


def brute(vectors, anchors, n_pos=5, n_neg=10, scale=256):
    """vectors: (id, label, components)."""
    ok = [
        (i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in vectors
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    own = {}
    for i, lab, v in sorted(ok, key=lambda r: (r[1], r[2])):
        own.setdefault(i, (lab, v))
    out = set()
    for a in anchors & set(own):
        lab, q = own[a]
        scored = [(-sum(x * y for x, y in zip(q, v)), i, l2) for i, (l2, v) in own.items() if i != a]  # noqa: B905
        for minus_p, p, _ in sorted(s for s in scored if s[2] == lab)[:n_pos]:
            inside = sorted(s for s in scored if s[2] != lab and 30 * -minus_p <= 100 * -s[0] <= 90 * -minus_p)
            out |= {(a, p, k + 1, i, -minus_p, -s) for k, (s, i, _) in enumerate(inside[:n_neg])}
    return out


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    vec = lambda: [rng.gauss(0.05, 0.2) for _ in range(24)]
    data = [(i, i % 4 if rng.random() < 0.5 else 0, vec()) for i in range(400)]
    data += [(500 + i, 1, data[3][2]) for i in range(40)]  # ties
    data += [(600, None, vec()), (601, 1, None), (602, 1, [float("nan")] * 24), (603, 2, [None, *vec()[1:]]), (604, 2, [float("inf")] * 24)]
    data += [(None, 1, vec()), (7, 9, vec()), (7, 0, vec()), (8, 8 % 4, [1.0, 2.0]), (605, 3, []), (606, 1, [0.0] * 24), (607, 0, [-x for x in vec()])]
    anchors = {i for i, _, _ in data if i is not None and (i % 20 == 0 or i in (7, 8, 605, 606, 607))}
    df = spark.createDataFrame([(i, lab, v, 1, "x") for i, lab, v in data], "key long, label int, vec array<float>, id int, anchor string")
    data = [(i, lab, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, lab, v in data]
    monkeypatch.setattr(bond, "ROWS", 100)
    monkeypatch.setattr(bond, "ANCHORS", 9)
    chosen = F.col("key").isin(sorted(anchors))
    got = bond.hard_negatives(df, chosen, "key", "vec").collect()
    want = brute(data, anchors)
    assert len(got) == len(want) > 500 and {tuple(r) for r in got} == want
    huge = df.limit(0).union(spark.createDataFrame([(i, 1, [1e15, 1.0], 1, "x") for i in range(3)], df.schema))
    try:
        bond.hard_negatives(huge, F.lit(True), "key", "vec").collect()
        raise AssertionError("no error")
    except Exception as e:
        assert "63 bits" in str(e)


def test_no_rows(spark):
    df = spark.createDataFrame([(1, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert bond.hard_negatives(df, F.lit(True)).collect() == []
    assert bond.hard_negatives(df.limit(0), F.lit(True)).collect() == []


def test_bounds_shrink_the_bitmap():
    rng = np.random.default_rng(2)
    x = rng.integers(-200, 200, (64, 1000)) // np.arange(1, 65)[:, None] ** 2
    block, read = bond.Columns(np.arange(1000), np.zeros(1000), x, 400), []

    def wanted(low, high):
        read.append(len(low))
        return high >= bond.kth(low, 5)

    at, score = block.scores(x[:, 0], np.arange(1000), wanted)
    assert read[0] == 1000 and read[-1] < 30
    assert set(bond.best(block, at, score, 5)[0]) == set(np.argsort(-(x[:, 0] @ x), kind="stable")[:5])


def test_query(spark):
    out = QUERIES["op13_hard_negatives"](spark, FOLDER)
    assert compare(out, connect(FOLDER), ORACLES["op13_hard_negatives"]) == []
    data = rows("embeddings", "vec_id, label, embedding")
    data = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, v) for i, lab, v in data]
    assert {tuple(r) for r in out.collect()} == brute(data, {i for i, _, _ in data if i % 100 == 0})
