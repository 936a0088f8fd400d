import numpy as np
from plain import FOLDER, rows
from test_tokens import ODD, check_pieces, plain

from carepath.llm import QUERIES, bestfit

NAME = bestfit.TOKENIZER


def brute(sizes, room):
    """Sequences by trying every choice; the rooms left at the end."""
    gaps, out = [], []
    squares = lambda g: sum(g.count(x) ** 2 for x in set(g) if x)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        s = sizes[i]
        choices = [(squares([*gaps, room - s]), room - s, True)]
        choices += [(squares([*[x for k, x in enumerate(gaps) if k != gaps.index(g)], g - s]), g - s, False) for g in set(gaps) if g >= s]
        _, left, new = min(choices)
        if not new:
            gaps.remove(left + s)
        gaps.append(left)
        out.append((i, left))
    return sorted(out), sorted(gaps)


def test_placement_equals_trying_every_choice():
    rng = np.random.default_rng(4)
    for room, n in ((10, 30), (40, 60), (7, 1), (5, 0)):
        for _ in range(15):
            sizes = rng.integers(1, room + 1, n)
            at, offset = bestfit.sum_of_squares(sizes, room)
            want, gaps = brute(sizes.tolist(), room)
            assert [(i, room - offset[i] - sizes[i]) for i in range(n)] == want
            used = np.bincount(at, sizes) if n else np.zeros(0)
            assert sorted((room - used).astype(int).tolist()) == gaps


def test_pieces_and_odd_texts(spark, monkeypatch):
    texts = ODD + ["many words here " * 700, "many words here " * 700, *[ODD[8]] * 30]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in enumerate(texts)], "doc_id long, text string, length int, piece string")
    monkeypatch.setattr(bestfit, "GROUP", 20)
    monkeypatch.setattr(bestfit, "BATCH", 7)
    for length in (2048, 64):
        out = bestfit.pack_best_fit(df, length=length).collect()
        check_pieces(out, list(enumerate(texts)), length, NAME)
        sizes = {d: len(plain(NAME)(t)) + 1 for d, t in enumerate(texts)}
        for r in out:  # only longer documents are cut, from the front
            assert r.start == r.piece * length and r.length == min(length, sizes[r.doc_id] - r.start)
    assert bestfit.pack_best_fit(df.limit(0)).collect() == []
    same = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "key string, body string")
    assert sorted(r.length for r in bestfit.pack_best_fit(same, "key", "body").collect()) == [1, 3, 3]


def test_query_uses_few_sequences(spark):
    out = QUERIES["op11_pack_best_fit"](spark, FOLDER)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = out.collect()
    docs = rows("documents", "doc_id, text")
    need = sum(len(plain(NAME)(t)) + 1 for _, t in docs) / bestfit.LENGTH
    assert len({r.sequence_id for r in got}) <= 1.03 * need + 1
