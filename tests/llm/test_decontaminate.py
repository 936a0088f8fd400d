import itertools
import random
import time

import pytest
import regex
from plain import FOLDER, rows, words

from oracle import compare, connect

from carepath.llm import ORACLES, QUERIES, decontaminate


def codes(text):
    return words(regex.sub(r"[\p{P}\p{S}]+", "", (text or "").lower()))


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = codes(t)
        for i, x in items:
            b = codes(x)
            if len(b) < decontaminate.LEAST:
                continue
            n = min(13, len(b))
            best = 0
            for shift in range(-len(b), len(w)):
                same = [0 <= shift + k < len(w) and w[shift + k] == b[k] for k in range(len(b))]
                best = max(best, max(sum(same[k : k + n]) for k in range(len(b) - n + 1)))
            if 10 * best >= 8 * n:
                out.setdefault(d, {})[i] = best
    return out


def test_masks_stand_two_substitutions():
    masks = [[k for k, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    for bad in itertools.combinations(range(13), 2):
        assert any(all(o + k not in bad for k in m) for m in masks for o in range(13 - m[-1])), bad


@pytest.mark.parametrize("segment", [2000, 9])
def test_against_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(decontaminate, "SEGMENT", segment)  # long items in many segments
    rng = random.Random(segment)
    word = lambda: f"W{rng.randrange(40)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((3, 5, 8, 12, 13, 14, 30, 60))]
    items += [(100, None), (101, ""), (102, "a a a a a a a a")]
    docs = []
    for d in range(120):
        body = [word() for _ in range(rng.randrange(0, 40))]
        if rng.random() < 0.7:
            piece = (rng.choice(items[1:8])[1]).split()
            cut = rng.randrange(0, max(1, len(piece) - 12))
            piece = piece[cut : cut + rng.randrange(5, 40)]
            for k in rng.sample(range(len(piece)), min(len(piece), rng.randrange(0, 4))):
                piece[k] = rng.choice(["xx", piece[k].lower() + "!", piece[k]])
            at = rng.randrange(0, len(body) + 1)
            body[at:at] = piece
        docs.append((d, " ".join(body)))
    docs += [(900, None), (901, ""), (902, "a " * 300), (903, docs[0][1]), (903, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    got = decontaminate.report(df, bench).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in docs)
    want = brute(docs, items)
    for r in got:
        found = want.get(r.doc_id, {})
        # Masks are sure to find every allowed substitution, in items of any length.
        assert r.item_ids == sorted(found) and r.matched == max(found.values(), default=0), r
        assert r.short_items == sum(0 < len(codes(t)) < decontaminate.LEAST for _, t in items)
        assert r.contaminated == bool(r.item_ids) and r.n_items == len(r.item_ids)
    clean = decontaminate.keep_clean(df.selectExpr("doc_id", "text AS body", "text AS codes"), bench, text="body")
    assert clean.columns == ["doc_id", "body", "codes"]
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in got if not r.contaminated)


def test_short_items_with_every_substitution(spark):
    """Exactly what brute force finds, for all places that may differ and one more, also at the document's ends."""
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(5, 13)]
    docs = []
    for n, t in items:
        for m in range(4):
            for bad in itertools.combinations(range(n), m):
                w = ["x" if k in bad else x for k, x in enumerate(t.split())]
                docs.append((len(docs), " ".join(["a", "b", *w, "c"])))
        for k in range(4):
            docs += [(len(docs), " ".join(t.split()[k:])), (len(docs) + 1, "a " + " ".join(t.split()[: n - k]))]
    got = decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert {r.doc_id: dict.fromkeys(r.item_ids, r.matched) for r in got.collect() if r.contaminated} == want


def test_blocks_and_empty_tables(spark, monkeypatch):
    items = [(i, " ".join(f"i{i}w{k}" for k in range(20))) for i in range(30)]
    docs = [(i, "start " + t + " end") for i, t in items]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_ROWS", 100)
    got = {r.doc_id: r.item_ids for r in decontaminate.report(df, bench).collect()}
    assert got == {i: [i] for i, _ in items}
    assert decontaminate.report(df.limit(0), bench).count() == 0
    assert not [r for r in decontaminate.report(df, bench.limit(0)).collect() if r.contaminated]


def test_query(spark):
    got = QUERIES["op3_decontaminate"](spark, FOLDER)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "InArrow", "NestedLoop", "Cartesian") if x in plan]
    docs, items = rows("documents", "doc_id, text"), rows("benchmark", "item_id, text")
    grams = {tuple(b[k : k + 11]) for _, t in items for b in [codes(t)] for k in range(len(b) - 10)}
    assert compare(got, connect(FOLDER), ORACLES["op3_decontaminate"]) == []
    found = {r.doc_id: r.contaminated for r in got.collect()}
    assert len(found) == len(docs)
    for d, t in docs:
        w = codes(t)
        if any(tuple(w[k : k + 11]) in grams for k in range(len(w) - 10)):
            assert found[d], d


def test_repeated_words_cost_no_pairs_of_places(spark):
    """One word 20,000 times against an item of it 200 times, and two words in turn: seconds, not hours."""
    docs = [(1, "zero " * 20_000), (2, "a b " * 2_500), (3, "zero " * 5 + "clean words here")]
    items = [(1, "zero " * 200), (2, "a b " * 100), (3, " ".join(f"w{k}" for k in range(20)))]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    decontaminate.report(df.limit(0), bench).collect()
    start = time.monotonic()
    got = {r.doc_id: (r.item_ids, r.matched) for r in decontaminate.report(df, bench).collect()}
    assert time.monotonic() - start < 30
    assert got == {1: ([1], 13), 2: ([2], 13), 3: ([], 0)}


def test_rows_that_share_an_id_and_clashing_columns(spark):
    leak = " ".join(f"w{k}" for k in range(20))
    docs = [(7, leak), (7, "clean one"), (None, leak), (None, "clean two"), (8, "clean three"), (8, "clean three"), (9, None)]
    df = spark.createDataFrame([(d, t, d, "x", 1, 2) for d, t in docs], "doc_id long, text string, __id long, __key string, codes int, part int")
    bench = spark.createDataFrame([(1, leak), (1, leak), (None, leak)], "item_id long, text string")
    kept = decontaminate.keep_clean(df, bench)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted((str(d), t) for d, t in docs if t != leak)
    got = decontaminate.report(df, bench).collect()
    assert sorted((str(r.doc_id), r.contaminated, r.n_items) for r in got) == sorted((str(d), t == leak, 2 * (t == leak)) for d, t in docs)


def test_items_of_one_word_with_least(spark):
    df = spark.createDataFrame([(1, "yes or no"), (2, "maybe")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "Yes!"), (2, "or no"), (3, "no or")], "item_id long, text string")
    got = {r.doc_id: (r.item_ids, r.short_items) for r in decontaminate.report(df, bench, least=1).collect()}
    assert got == {1: ([1, 2], 0), 2: ([], 0)}
    assert {r.short_items for r in decontaminate.report(df, bench).collect()} == {3}
