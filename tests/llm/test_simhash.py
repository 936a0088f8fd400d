import numpy as np
import pytest
from plain import FOLDER, class_of, fingerprint, rows
from pyspark.sql import functions as F

from carepath.llm import QUERIES, simhash
from carepath.llm.components import components


def test_query_against_brute_force(spark):
    docs = rows("documents", "doc_id, text")
    want = {d: fingerprint(t) for d, t in docs}
    classes = class_of(want, 4)
    got = QUERIES["op9_simhash_classes"](spark, FOLDER).collect()
    assert len(got) == len(docs)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{f:016x}", classes[d]) for d, f in want.items()}


def points(spark, values):
    return spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")


@pytest.mark.parametrize("shard", [20, 200, 10**6])
@pytest.mark.parametrize("bits", [2, 4, 8])
def test_links_find_every_class(spark, monkeypatch, shard, bits):
    """Random points, chains and a dense cluster, over many shards and parts."""
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "LEAF", 8)
    rng = np.random.default_rng(shard + bits)
    x = list(rng.integers(0, 1 << 64, 150, dtype=np.uint64))
    for start in x[:20]:
        for _ in range(6):  # chains
            flips = rng.choice(64, rng.integers(1, bits + 2), replace=False)
            start = start ^ np.uint64(sum(1 << int(k) for k in flips))
            x.append(start)
    center = x[0]
    x += [center ^ np.uint64((1 << int(a)) | (1 << int(b))) for a, b in rng.integers(0, 64, (200, 2))]
    values = sorted({int(v) for v in x})
    found = simhash.links(points(spark, values), bits)
    for r in found.collect():
        assert (r.a ^ r.b) & (1 << 64) - 1 and bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 64
    roots = {r.node: r.root for r in components(found).collect()}
    signed = {int(np.uint64(v).view(np.int64)): v for v in values}
    want = class_of({s: v for s, v in signed.items()}, bits)
    assert {s: roots.get(s, s) for s in signed} == want


def test_cases(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    data = [(5, None), (7, ""), (6, " \n"), (1, "a"), (2, "A"), (3, "a b c"), (3, "a b c"), (8, long), (4, long + " end"), (None, "a b c")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.classes(df).collect()}
    assert [v for k, v in got.items() if k[0] in (5, 6, 7)] == [5, 5, 5]
    assert [v for k, v in got.items() if k[0] in (1, 2)] == [1, 1]
    assert [v for k, v in got.items() if k[0] in (4, 8)] == [4, 4]
    assert {v for k, v in got.items() if k[0] in (3, None)} == {3}
    kept = simhash.keep_first(df.withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(1)), shingle=4)
    assert kept.columns == ["doc_id", "text", "fp", "component_id"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5]
    # Rows that share an id are judged each by its own text.
    far = [(1, "one two three four five"), (1, "six seven eight nine ten"), (2, "six seven eight nine ten"), (1, "six seven eight nine ten")]
    shared = spark.createDataFrame([(d, t, d, "c", "k") for d, t in far], "doc_id long, text string, __id long, __code string, __kept string")
    once = simhash.keep_first(shared)
    assert once.columns == shared.columns
    assert sorted((r.doc_id, r.text) for r in once.collect()) == sorted(set(far[:2]))
    assert simhash.keep_first(shared.limit(0)).count() == 0
    assert simhash.classes(df.where("doc_id > 100")).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 500), (301, 300), (300, 301), (302, 300)]
    star = [(1000, 1001 + i) for i in range(3000)]
    df = spark.createDataFrame(chain + star, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[302] == got[301] == 300
    assert all(got[1001 + i] == 1000 for i in range(3000)) and 500 not in got
    assert components(df.where("a < 0")).count() == 0
