import hashlib
import random

import pytest
from oracle import compare, connect
from plain import FOLDER, without_repeats, words

from carepath.llm import ORACLES, QUERIES, substring


def test_query_agrees_with_sql(spark):
    assert compare(QUERIES["op8_drop_repeats"](spark, FOLDER), connect(FOLDER), ORACLES["op8_drop_repeats"]) == []


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = substring.drop_repeats(df).collect()
    found = sorted((r.doc_id, r.n_words, r.n_removed, " ".join(words(r.text))) for r in got)
    want = sorted((d, n, m, " ".join(kept)) for d, n, m, kept in without_repeats(docs))
    assert found == want
    return got


@pytest.mark.parametrize("run", [64, 1 << 20])
def test_against_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(substring, "RUN", run)
    rng = random.Random(run)
    passages = [" ".join(f"p{rng.randrange(30)}" for _ in range(rng.randrange(11, 40))) for _ in range(12)]
    docs = []
    for i in range(80):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(0, 25))))
            if rng.random() < 0.6:
                parts.append(rng.choice(passages))
        docs.append((i * 7 % 80, rng.choice([" ", "\n", "  \t"]).join(parts)))
    docs += [(200 + i, "x " * n) for i, n in enumerate((12, 13, 14, 400))]
    check(spark, docs)


def test_cases(spark):
    body = " ".join(f"w{i}" for i in range(13))
    long = " ".join(f"v{i}" for i in range(50_000))
    docs = [(1, None), (2, ""), (3, body), (4, body), (4, body + " tail"), (5, "head " + body), (6, long), (7, "z " + long), (8, "é" + body), (9, body.replace(" ", "\n "))]
    got = check(spark, docs)
    texts = {(r.doc_id, r.n_words): r.text for r in got}
    assert texts[1, 0] is None and texts[2, 0] == "" and texts[3, 13] == body and texts[4, 14] == "tail"
    assert substring.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_other_columns(spark):
    body = " ".join(f"w{i}" for i in range(13))
    df = spark.createDataFrame(
        [(1, body, "a", 1, 2, "k"), (2, body, None, None, 3, "k"), (None, body, "c", 4, 5, "k")],
        "doc_id int, text string, keys string, __hit_id int, n_words int, payload string",
    )
    out = substring.drop_repeats(df)
    assert out.columns == ["doc_id", "text", "keys", "__hit_id", "payload", "n_words", "n_removed"]
    assert [(r.doc_id, r["keys"], r.n_removed) for r in sorted(out.collect(), key=lambda r: r.doc_id or 0)] == [(None, "c", 0), (1, "a", 0), (2, None, 13)]


def test_anchors_share_a_place():
    """Any two positions have a common shift into the cover."""
    cover = set(substring.COVER)
    for i in range(7):
        for j in range(7):
            assert any((i + d) % 7 in cover and (j + d) % 7 in cover for d in range(7))


def test_digest_of_kept_words(spark):
    r = QUERIES["op8_drop_repeats"](spark, FOLDER).where("n_removed = 0").first()
    text = spark.read.parquet(f"{FOLDER}/documents.parquet").where(f"doc_id = {r.doc_id}").first().text
    assert hashlib.sha256(" ".join(words(text)).encode()).hexdigest() == r.kept_sha256
