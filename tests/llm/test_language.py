import zlib

import numpy as np
import pyarrow as pa
from plain import rows

from carepath.llm import QUERIES, language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, FOLDER).collect()}
    docs = rows("documents", "doc_id, text, lang", FOLDER)
    assert len(found) == len(docs)
    assert all(found[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, _, _ in docs)
    held = [(found[d], lang) for d, _, lang in docs if found[d].held_out]
    right = [r.lang_pred == lang for r, lang in held]
    assert np.mean(right) > 0.98
    sure = [ok for (r, _), ok in zip(held, right, strict=True) if r.accepted]
    assert len(sure) > 0.9 * len(held) and np.mean(sure) >= language.PRECISION
    assert all(0 <= r.score <= 1 for r in found.values())


def toy():
    texts = [("aba bab aab " * k, "x") for k in range(1, 40)] + [("zyz yzz zzy " * k, "y") for k in range(1, 40)]
    return language.train([t for t, _ in texts], [lang for _, lang in texts])


def test_whole_texts_and_blocks():
    model = toy()
    texts = [None, "", "12 !?", "aba", "zyz", "aba " + "zyz " * 50_000, "ABA\x00bab", "aba\n\n bab", "aba bab" * 3]
    p, letters = language._Scorer(model).score(pa.array(texts))
    assert letters.tolist() == [False, False, False, *[True] * 6]
    for t, row in zip(texts, p, strict=True):
        if t and any(c.isalpha() for c in t):
            bag = np.concatenate([b for b, _ in language.grams([t])[0]])
            want = model.probabilities(model.logits[bag].astype(float).sum(axis=0)[None], np.array([len(bag)]))[0]
            assert np.allclose(row, want, atol=1e-4)
    assert [model.languages[k] for k in p[3:6].argmax(axis=1)] == ["x", "y", "y"]


def test_cases(spark):
    docs = [(1, None, "x"), (2, "", "x"), (3, "...", None), (4, "aba bab", None), (4, "aba bab", None), (None, "zyz", "q"), (5, "ж" * 30_000, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang_pred string")
    got = language.identify(df, toy()).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got if r.doc_id != 5) == [(0, "y"), (1, "und"), (2, "und"), (3, "und"), (4, "x"), (4, "x")]
    assert {r.lang_pred for r in language.identify(df, None).collect()} == {"und"}
    labelled = spark.createDataFrame([(i, "aba bab", None if i % 2 else "x") for i in range(20)], "doc_id long, text string, lang string")
    only = language.identify(df, language.learn(labelled)).where("doc_id = 4").first()
    assert (only.lang_pred, only.score) == ("x", 1.0)
    assert language.learn(labelled.where("lang IS NULL")) is None
    assert language.identify(df.limit(0), None).count() == 0


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_SAMPLE", 5)
    seen = []
    monkeypatch.setattr(language, "train", lambda texts, labels: seen.extend(zip(texts, labels, strict=True)))
    df = spark.createDataFrame([(i, f"text {i} " * 400, "ab"[i % 2]) for i in range(300)], "doc_id long, text string, lang string")
    language.learn(df)
    assert 0 < len(seen) <= 10 and max(len(t) for t, _ in seen) <= language.WINDOWS * (language.TRAIN_CHARS + 1)


def test_repeated_rows_are_sampled_once(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_SAMPLE", 50)
    same = spark.range(20_000).selectExpr("7L AS doc_id", "'one text' AS text", "'a' AS lang")
    one_id = spark.range(20_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "concat('text ', id) AS text", "'b' AS lang")
    few = spark.range(30).selectExpr("id AS doc_id", "concat('rare ', id) AS text", "'c' AS lang")
    found = language.sampled(same.unionByName(one_id).unionByName(few), "doc_id", "text", "lang").collect()
    texts = {lang: [r.text for r in found if r.lang == lang] for lang in "abc"}
    assert texts["a"] == ["one text"] and 30 < len(texts["b"]) <= 50 and len(texts["c"]) == 30
    assert len(set(texts["b"])) == len(texts["b"])
    assert sorted(r.turn for r in found if r.lang == "c") == list(range(1, 31))
    monkeypatch.setattr(language, "MAX_ROWS", 30)
    assert spark.createDataFrame(language.sampled(few.unionByName(same), "doc_id", "text", "lang").collect()).count() <= 30


def test_pieces_cover_texts_evenly():
    for n in (0, 1, 199, 200, 201, 399, 605, 800, 803, 5_000):
        pieces = language.pieces_of("x" * n)
        assert len(pieces) <= language.WINDOWS and max(map(len, pieces)) <= language.TRAIN_CHARS
        assert n <= 200 or min(map(len, pieces)) >= 100
        assert n > 800 or sum(map(len, pieces)) == n


def test_calibrated_on_whole_texts(spark):
    docs = [(i, ("aba bab " if i % 2 else "zyz yzz ") * 40 + ("zyz " if i % 2 else "aba ") * (i % 9) * 60, "xy"[i % 2 == 0]) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language.learn(df)
    sample = sorted(language.sampled(df, "doc_id", "text", "lang").collect(), key=lambda r: (r.lang, r.turn))
    held = [r for r in sample if r.turn % 5 == 0]
    bags = language.bags([r.text for r in held])
    sums = np.stack([model.logits[b].astype(float).sum(axis=0) for b in bags])
    want = language.Model(model.languages, model.logits, model.bias, 1.0, 0.0)
    y = np.array([model.languages.index(r.lang) for r in held])
    language.calibrate(want, sums, np.array([len(b) for b in bags]), y)
    assert model.temperature == want.temperature and abs(model.threshold - want.threshold) < 1e-6
