import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from plain import FOLDER, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carepath.llm import QUERIES, align

ODD = [
    None, "", " ", "a", "  ", "a ", "a  b   c", "\n\n", "x\n\n y", "it's  don't\t\tfoo", "中文 字 123", "é́ ñ  x", "🙂 🙂🙂", "a\xa0b",
    "<|endoftext|> hi <s></s> <unk>", "has a ▁ sign", "▁", "x" * 700, "=" * 333 + " " * 97 + "y", "\x00 \x1c",
]
A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


def tokens(text):
    """Ids and bytes of both, or nothing where they do not spell the text."""
    if not text:
        return [], [], [], []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    sa = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a]
    sb = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    want = (" " + text).encode()
    return (a, sa, b, sb) if b"".join(sa) == want == b"".join(sb) else ([], [], [], [])


def brute(docs):
    count, parts = Counter(), []
    for d, t in docs:
        a, sa, b, sb = tokens(t)
        span = lambda s: list(zip(np.cumsum([0, *map(len, s)])[:-1].tolist(), np.cumsum([len(x) for x in s]).tolist()))  # noqa: E731, B905
        pa, pb = span(sa), span(sb)
        links = [(a[i], b[j]) for i, (x, y) in enumerate(pa) for j, (u, v) in enumerate(pb) if x < v and u < y]
        count.update(links)
        cuts = sorted({y for _, y in pa} & {y for _, y in pb})
        groups, low = [], 0
        for c in cuts:
            ga = [a[i] for i, (x, y) in enumerate(pa) if low <= x and y <= c]
            gb = [b[i] for i, (x, y) in enumerate(pb) if low <= x and y <= c]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            low = c
        parts.append((d, len(a), len(b), links, ";".join(groups), len(groups)))
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    return {
        d: (na, nb, n, len(li), sum(count[p] == top[p[1]] for p in li), sum(count[p] for p in li), g)
        for d, na, nb, li, g, n in parts
    }


def found(df):
    out = {}
    for r in df.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
        assert r.doc_id not in out
        out[r.doc_id] = (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)
    return out


@pytest.mark.parametrize("run", [16 << 20, 2000])
def test_equals_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(align, "RUN", run)  # many runs: their pairs are summed
    texts = [t if t is None else t[:1500] for (t,) in rows("documents", "text")[:80]]
    docs = list(enumerate(ODD + ODD + texts))
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, run string, pair int").repartition(3)
    assert found(align.align(df, with_groups=True)) == brute(docs)


def test_ids_of_any_type_and_no_rows(spark):
    df = spark.createDataFrame([("a", "one two"), (None, "two one"), ("a", "one two")], "key string, body string")
    got = align.align(df, "key", "body").collect()
    assert sorted((r.doc_id or "", r.n_a) for r in got) == [("", 2), ("a", 2), ("a", 2)]
    assert align.align(df.limit(0), "key", "body").collect() == []
    assert align.align(df.select("key", F.lit(None).cast("string").alias("body")), "key", "body").count() == 3


def test_common_ends_of_long_leaves():
    rng = np.random.default_rng(3)
    for n in (1, 2, 50, 3000):
        for _ in range(20):
            a = np.sort(rng.choice(np.arange(1, 4 * n + 1), n, replace=False))
            b = np.sort(rng.choice(np.arange(1, 4 * n + 1), n, replace=False))
            end = 4 * n + 5
            a, b = np.append(a, end), np.append(b, end)
            want = np.flatnonzero(np.isin(a, b))
            assert align.common_ends(a, b, np.array([len(a) - 1])).tolist() == want.tolist()
    a, b = np.append(np.arange(2, 400_000, 2), 400_001), np.append(np.arange(1, 400_000, 2), 400_001)
    assert align.common_ends(a, b, np.array([len(a) - 1])).tolist() == [len(a) - 1]  # one leaf


def test_query(spark):
    out = QUERIES["op12_align_tokens"](spark, FOLDER)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = out.collect()
    docs = rows("documents", "doc_id, text")
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in docs)
    sizes = {d: (len(t[0]), len(t[2])) for d, t in ((d, tokens(t)) for d, t in docs)}
    assert {r.doc_id: (r.n_a, r.n_b) for r in got} == sizes
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups for r in got)
