import math

import pytest
from plain import FOLDER, repeat_words, rows, words
from pyspark.sql import functions as F

from oracle import compare, connect

from carepath.llm import ORACLES, QUERIES, quality

SCHEMA = "doc_id long, text string, lang string"


def measure(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in quality.features(df).collect()}


def expected(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    n = repeat_words(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), n,
            len(w) < 10 or 100 * n > 20 * len(w))


def test_counts(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = [None, "", " \n\t", "a", "a b c d e", "a b c d e f a b c d e", "x y\nx y\n \nx y", "é# *$%&|<> \x0b\x0c z",
             "a a a a a a a", "a a a a a a", long, "p q r s t u p q r s t p q r s t", "A\xa0b c", *(t for (t,) in rows("documents", "text"))]
    got = measure(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == expected(t), t


def test_query_has_one_row_per_document(spark):
    found = QUERIES["op10_quality_rules"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in found) == sorted(d for (d,) in rows("documents", "doc_id"))
    assert not [r for r in found if r.base_failed and r.kept]
    assert compare(QUERIES["op10_quality_rules"](spark, FOLDER), connect(FOLDER), ORACLES["op10_quality_rules"]) == []


def binomial(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_exact_tail(spark):
    cases = [(0, 1), (0, 50), (1, 400), (3, 900), (17, 5000), (0, 3), (40, 20_000)]
    df = spark.createDataFrame(cases, "k long, n long")
    for p in (0.004, 0.02):
        for r in df.where(F.col("k") < p * F.col("n")).select("k", "n", quality.log_tail_below(F.col("k"), F.col("n"), p).alias("x")).collect():
            assert r.x == pytest.approx(math.log(binomial(r.k, r.n, p)), rel=1e-7, abs=1e-9)


def brute_steps(measured, labels, risk=0.02, error=0.05, price=5.0):
    """Stratum -> (step, pooled); 'every' for all strata. Tests on distinct texts, one per line of measured."""
    texts = {}
    for m in measured:
        if not m["base_failed"] and labels.get(m["doc_id"]) is not None:
            key = m["stratum"], m["text"]
            texts[key] = m, min(labels[m["doc_id"]], texts.get(key, (m, 1))[1])
    own = {}
    for (s, _), (m, good) in texts.items():
        own.setdefault(("one", s), []).append((m, good))
        own.setdefault(("every", None), []).append((m, good))
    level = math.log(error / max(1, len(own)))

    def hits(rows, k, good):
        return sum(any(m[r] > quality.CUTOFFS[r][k] for r in quality.RULES) for m, q in rows if q == good)

    out = {}
    for key, rows in own.items():
        n, best = sum(q for _, q in rows), (0, None)
        for k in range(quality.STEPS):
            g, b = hits(rows, k, 1), hits(rows, k, 0)
            if not (g < risk * n and math.log(binomial(g, n, risk)) <= level):
                break
            if b - price * g > best[0]:
                best = (b - price * g, k)
        out[key] = best[1]
    common = out.get(("every", None))
    for (kind, s), rows in own.items():
        n = sum(q for _, q in rows)
        if kind == "one" and n * math.log1p(-risk) > level:
            fits = common is not None and hits(rows, common, 1) <= risk * n
            out[kind, s] = common if fits else None
    return out


def planted(rng, spoilt):
    """Strata with many labels, with few, with odd good documents, with copies only, NULL and unlabelled."""
    docs, labels = [], []

    def add(lang, n, bad_share=0.3, odd=0.0, copies=1, label=True):
        for _ in range(n):
            bad = rng.random() < bad_share
            symbols = "***" if (bad and rng.random() < 0.9) or (not bad and rng.random() < odd) else ""
            text = " ".join(f"w{rng.randrange(9**9)}{symbols}" for _ in range(30))
            for _ in range(copies):
                docs.append((len(docs), text, lang))
                if label:
                    labels.append((len(docs) - 1, 0 if bad else 1))

    add("many", 1500)
    add("few", 60)
    add("odd", 14, odd=0.5)
    if spoilt:  # the pooled sequence fails at its first step
        add("odd and many", 400, odd=0.5)
    add("copies", 20, copies=30)
    add(None, 30)
    add("unlabelled", 40, label=False)
    return docs, labels


@pytest.mark.parametrize("spoilt", [False, True])
def test_cutoffs_against_brute_force(spark, spoilt):
    docs, labels = planted(__import__("random").Random(3), spoilt)
    extra = [(0, labels[0][1]), (1, None), (None, 1), (99_999, 1)]
    df = spark.createDataFrame(docs, SCHEMA)
    measured = quality.features(df)
    label_rows = spark.createDataFrame(labels + extra, "doc_id long, quality int")
    found = quality.learn_cutoffs(measured, label_rows).collect()  # production parameters
    got = {("every" if r.every else "one", r.stratum): r.step for r in found}
    text = {d: t for d, t, _ in docs}
    want = brute_steps([r.asDict() | {"text": text[r.doc_id]} for r in measured.collect()], dict(labels))
    assert got == want
    rows = {r.stratum: r for r in found if not r.every}
    assert got["one", "many"] is not None and not rows["many"].pooled and rows["many"].rejects_good == 0
    assert rows["many"].rejects_bad > 0.8 * rows["many"].n_bad
    for s in ("few", "copies", None):  # too few distinct texts for a cutoff of their own
        assert rows[s].pooled and got["one", s] == got["every", None]
    assert rows["copies"].n_good + rows["copies"].n_bad == 20
    assert got["one", "odd"] is None and got.get(("one", "odd and many")) is None
    assert (got["every", None] is None) == spoilt
    judged = {r.doc_id: r for r in quality.judge(measured, quality.learn_cutoffs(measured, label_rows)).collect()}
    for d, _, lang in docs:
        r, step = judged[d], got["one", lang] if ("one", lang) in got else got["every", None]
        cut = step is not None and any(r[rule] > quality.CUTOFFS[rule][step] for rule in quality.RULES)
        assert r.kept == (not r.base_failed and not cut)
    assert spoilt != any(not judged[d].kept for d, _, lang in docs if lang == "unlabelled")
    kept = quality.keep_good(df, label_rows)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in judged.items() if r.kept}


def test_the_given_labels_reject_bad_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for r in quality.learn_cutoffs(quality.features(docs), labels).collect():
        assert r.step is not None and r.rejects_good <= 0.02 * r.n_good and r.rejects_bad >= 0.9 * r.n_bad
        assert r.every or not r.pooled


def test_too_many_strata_are_refused(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_STRATA", 3)
    df = spark.range(4).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(20)), lambda x: F.concat(F.lit("w"), x)), " ").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError):
        quality.learn_cutoffs(quality.features(df), df.select("doc_id", F.lit(1).alias("quality")))


def test_empty_and_clashing(spark):
    schema = SCHEMA + ", n_words string, stratum int, kept int, `a.b` int, __words int, __stratum int, __cut int, __step int"
    empty = spark.createDataFrame([], schema)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.keep_good(empty, labels).count() == 0
    text = " ".join(f"w{i}" for i in range(12))
    df = spark.createDataFrame([(1, text, None, "x", 1, 2, 3, 4, 5, 6, 7), (1, text, None, "x", 1, 2, 3, 4, 5, 6, 7), (2, None, "e", *[None] * 8), (None, text, "e", "y", *[1] * 7)], schema)
    out = quality.keep_good(df, labels)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r["a.b"]) for r in out.collect()) == [(0, 1), (1, 3), (1, 3)]


def test_native(spark):
    plan = QUERIES["op10_quality_rules"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian") if x in plan]
