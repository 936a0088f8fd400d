import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from plain import FOLDER, rows
from tokenizers import Tokenizer

from carepath.llm import QUERIES, chunks, edits, packing, rans

ODD = [
    None, "", "a", "  ", "\n\n", "a\xa0  b", "!\x1c x", " <|endoftext|> hi  <|endoftext|>", "<|ENDOFTEXT|>x", "it's  don't\t\tfoo\n\n bar ",
    "é́ ñ  x", " ́a", "a≯b", "中文 字 123 4567 a1b2", "x" * 3000, "🙂 🙂🙂", "İstanbul ΑΣ Σ ﬁ", "word,word.*** 'tis 'S <a|b>", "  a　 b",
]


def plain(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunked_ids_are_the_tokenizers(monkeypatch, name):
    want, enc = plain(name), chunks.Encoder(name)
    texts = ODD + [t for (t,) in rows("documents", "text")]
    flat, at = enc.ids(pa.array(texts))
    for i, t in enumerate(texts):
        assert flat[at[i] : at[i + 1]].tolist() == want(t), t
    monkeypatch.setattr(chunks, "CHUNKS", 500)  # the dictionary forgets and learns again
    for _ in range(2):
        for i in range(0, len(texts), 20):
            flat, at = enc.ids(pa.array(texts[i : i + 20]))
            assert flat.tolist() == [k for t in texts[i : i + 20] for k in want(t)]
    assert enc.ids(pa.array([], pa.string()))[0].tolist() == []


def check_pieces(pieces, docs, length, name="byte_bpe_50k.json", end=0):
    want = plain(name)
    own = {}
    for p in pieces:
        own.setdefault(p.doc_id, []).append(p)
    for d, t in docs:
        ids, at = [*want(t), end], 0
        for p in sorted(own[d], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert np.frombuffer(p.ids, "<u4").tolist() == ids[at : at + p.length]
            at += p.length
        assert at == len(ids)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return sequences


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    docs = [*enumerate([*ODD, "w " * 5000])] + [(1000 + d, t) for d, t in rows("documents", "doc_id, text")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, offset int, `group` string")
    check_pieces(packing.pack(df).collect(), docs, 1024)
    pieces = packing.pack(df, length=16).collect()
    check_pieces(pieces, docs, 16)
    repeated = spark.createDataFrame([(1, "a b")] * 5 + [(None, "a b")] * 2, "doc_id long, text string")
    assert packing.pack(repeated).count() == 7
    assert packing.pack(df.limit(0)).count() == 0


def test_first_fit_decreasing():
    rng = random.Random(2)
    for n in [*range(1, 12), 400]:
        sizes = [rng.randrange(1, 101) for _ in range(n)]
        bins, offsets = packing.first_fit_decreasing(np.array(sizes), 100)
        room = []
        for i in sorted(range(n), key=lambda i: -sizes[i]):
            b = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
            if b == len(room):
                room.append(100)
            assert (bins[i], offsets[i]) == (b, 100 - room[b])
            room[b] -= sizes[i]


def test_packing_query(spark):
    found = QUERIES["op6_pack_ffd"](spark, FOLDER).collect()
    want = plain("byte_bpe_50k.json")
    texts = dict(rows("documents", "doc_id, text"))
    for p in found:
        ids = [*want(texts[p.doc_id]), 0][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    n = sum(p.length for p in found)
    assert n == sum(len(want(t)) + 1 for t in texts.values())
    assert n > 0.97 * 1024 * len({p.sequence_id for p in found})


@pytest.mark.parametrize("n", [1, 127, 128, 129, 5000, 131_072, 131_073, 300_000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in ((rng.zipf(1.3, n) % 49_000).astype(np.uint32), np.full(n, 7, np.uint32), rng.integers(0, 200_000, n).astype(np.uint32)[: 200_000]):
        coded = rans.encode_ids(ids)
        assert (rans.decode_ids(*coded) == ids).all()
    bits = 8 * sum(len(b["words"]) for b in rans.encode_ids(ids)[2]) / len(ids)
    if n >= 5000:
        counts = np.unique(ids, return_counts=True)[1] / len(ids)
        assert bits < -(counts * np.log2(counts)).sum() * 1.05 + 0.6


def test_rans_checksum():
    symbols, freq, blocks = rans.encode_ids(np.arange(1000, dtype=np.uint32))
    words = bytearray(blocks[0]["words"])
    words[100] ^= 4
    blocks[0]["words"] = bytes(words)
    with pytest.raises(ValueError, match="checksum"):
        rans.decode_ids(symbols, freq, blocks)


def test_joined_checksums():
    parts = [b"hello", b"", b"world" * 1000, b"x"]
    assert rans.joined_crc32([zlib.crc32(p) for p in parts], [len(p) for p in parts]) == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("segment", [500, 1 << 21])
def test_token_files(spark, tmp_path, segment):
    docs = [(i * 3 % 41, t) for i, t in enumerate([*ODD, "w " * 3000])] + [(100, "b"), (100, "a"), (None, "n")]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, part int")
    path = str(tmp_path / f"s{segment}")
    rans.write(df, path, segment=segment)
    want = plain("word_bpe_49k.json")
    at = 0
    pieces = sorted(rans.read(spark, path).collect(), key=lambda p: (p.start, p.piece_from))
    got = {}
    for p in pieces:
        got.setdefault((p.doc_id, p.start), []).extend(np.frombuffer(p.ids, "<u4").tolist())
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = [*want(t), 2]
        assert got[d, at] == ids
        at += len(ids)
    assert len(got) == len(docs)
    rans.write(df.limit(0), str(tmp_path / "none"))
    assert rans.read(spark, str(tmp_path / "none")).count() == 0


def test_token_query(spark):
    found = sorted(QUERIES["op2_rans_tokens"](spark, FOLDER).collect())
    want, at = plain("word_bpe_49k.json"), 0
    for r, (d, t) in zip(found, sorted(rows("documents", "doc_id, text")), strict=True):
        ids = [*want(t), 2]
        assert tuple(r) == (d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def apply(text, changes):
    text = text or ""
    for e in changes:
        if e is None:
            continue
        start = len(text) if e["start"] is None else min(max(e["start"], 0), len(text))
        stop = min(start + max(e["length"] or 0, 0), len(text))
        text = text[:start] + (e["text"] or "") + text[stop:]
    return text


def test_edited_counts_against_full_ones():
    rng, enc, want = random.Random(4), chunks.Encoder("byte_bpe_50k.json"), plain("byte_bpe_50k.json")
    letters = "ab é\n\t 1.,'\xa0 \x1c "
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    for _ in range(400):
        text = some(rng.choice([0, 1, 5, 30, 600]))
        chars, ids = next(iter(enc.sizes(pa.array([text]))))
        tree = edits.Tree.load(edits.Tree.of_chunks(chars, ids).dump())
        assert (tree.total, tree.sums[1, 0]) == (len(want(text)), len(text))
        for _ in range(5):
            e = {"start": rng.choice([None, 0, rng.randint(-2, len(text) + 3)]), "length": rng.choice([None, 0, 1, rng.randint(0, 50)]),
                 "text": rng.choice([None, "", " ", "x", some(rng.choice([3, 40, 1500]))])}
            doc = edits.Document(text, tree)
            edits.edit_all([doc, edits.Document("", edits.Tree.of_chunks(chars[:0], ids[:0]))], [[None, e], []], enc)
            assert doc.text == apply(text, [e])
            text, tree = doc.text, doc.tree
            assert (tree.total, tree.sums[1, 0]) == (len(want(text)), len(text)), e
    text = "word " * 20_000
    chars, ids = next(iter(enc.sizes(pa.array([text]))))
    doc = edits.Document(text, edits.Tree.of_chunks(chars, ids))
    edits.edit_all([doc], [[{"start": 50_001, "length": 3, "text": "x y"}]], enc)
    assert doc.anew < 400  # of 100,000 characters


def test_edit_tables(spark):
    want = plain("byte_bpe_50k.json")
    docs = [(1, "one two three"), (1, "one two three"), (2, None), (3, ""), (4, "x" * 2000), (None, "n")]
    df = spark.createDataFrame([(d, t, "k", 0) for d, t in docs], "doc_id long, text string, seq string, n_tokens int")
    changes = [(1, 2, 0, 3, "zero"), (1, 1, None, None, " four"), (2, 1, 0, 0, "new text"), (4, 1, 1000, 0, " cut "), (9, 1, 0, 0, "none")]
    rows_ = spark.createDataFrame(changes, "doc_id long, seq int, start int, length int, text string")
    counted = edits.count(df)
    assert counted.columns == ["doc_id", "text", "seq", "n_tokens", "tree"]
    after = edits.recount(edits.with_edits(counted, rows_), "edits").collect()
    assert sorted((r.doc_id or 0, r.text, r.n_tokens) for r in after if r.text is not None) == sorted(
        (d or 0, t, len(want(t)))
        for d, t in [(1, "zero two three four")] * 2 + [(2, "new text"), (3, ""), (4, "x" * 1000 + " cut " + "x" * 1000), (None, "n")]
    )
    assert edits.recount(edits.with_edits(counted.limit(0), rows_), "edits").count() == 0


def test_edit_query(spark):
    want = plain("byte_bpe_50k.json")
    got = {r.doc_id: r for r in QUERIES["op7_edit_counts"](spark, FOLDER).collect()}
    for d, t in rows("documents", "doc_id, text"):
        n = len(t)
        after = apply(t, [dict(start=s, length=k, text=x) for s, k, x in (
            (n // 3, 5, t[:12]), (n // 2, 1, ""), (2 * n // 3, 0, " [edit]\n"), (None, 0, " end."), (0, 3, ""))])
        r = got[d]
        assert (r.n_tokens, r.n_tokens_after, r.text_crc32) == (len(want(t)), len(want(after)), zlib.crc32(after.encode()))


def test_odd_spaces_do_not_make_a_text_one_chunk(spark):
    rng, odd = random.Random(8), "\xa0\u3000\u2003\x85\x1c\u2028"
    text = " ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))) for _ in range(18_000))[:100_000]
    text = text[:5000] + "".join(f"x{c} {c}  y {c}{c} z" for c in odd) + text[5000:]
    want, enc = plain("byte_bpe_50k.json"), chunks.Encoder("byte_bpe_50k.json")
    assert enc.ids(pa.array([text]))[0].tolist() == want(text)
    change = [(70_000, 3, "new words")]
    after = text[:70_000] + "new words" + text[70_003:]
    df = spark.createDataFrame([(1, text, change)], f"doc_id long, text string, edits {edits.EDITS}")
    row = edits.recount(edits.count(df), "edits").first()
    assert row.text == after and row.n_tokens == len(want(after)) and row.reencoded_chars < 400
    # Any order of words with such spaces at their edges.
    parts = ["a", " ", "  ", "\n", "b1", *odd, "\xa0 ", " \xa0", "\u3000\u3000"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    flat, at = enc.ids(pa.array(texts))
    for i, t in enumerate(texts):
        assert flat[at[i] : at[i + 1]].tolist() == want(t), repr(t)
