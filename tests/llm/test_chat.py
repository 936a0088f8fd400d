import random

from oracle import compare, connect
from plain import FOLDER
from pyspark.sql import functions as F

from carepath.llm import ORACLES, QUERIES, chat

SCHEMA = "conv_id long, turn int, role string, text string"


def test_query_agrees_with_sql(spark):
    df = QUERIES["op5_chat_format"](spark, FOLDER)
    assert compare(df, connect(FOLDER), ORACLES["op5_chat_format"]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "InArrow") if x in plan]


def test_round_trip(spark):
    rng = random.Random(8)
    pieces = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[NEXT]", "\\", "<\\/s>", "[\\\\INST]", "[", "<", "s>", "/INST]",
              "NEXT]", " ", "\n", "ok", "é🙂", "$1", "<", "]"]
    roles = ["user", "assistant", "system", "tool", "", None, "[/ROLE]", "a</s>"]
    turns = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 9)):
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12)))
            turns.append((conv, turn, rng.choice(roles[: rng.choice([2, 8])]), rng.choice([text, text, None])))
    turns += [(500, None, "user", "b"), (500, 3, "user", "a"), (500, 3, "user", "a"), (None, 0, "assistant", "x"), (501, 0, "user", "w " * 100_000)]
    turns += [(502, i, "assistant", "t") for i in range(300)]
    rng.shuffle(turns)
    df = spark.createDataFrame(turns, SCHEMA).withColumn("formatted", F.lit(1)).withColumn("loss_spans", F.lit(2))
    found = chat.format_chats(df).select("*", chat.parse_chats(F.col("formatted")).alias("turns")).collect()
    want = {}
    for conv, turn, role, text in turns:
        want.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert len(found) == len(want)
    unescape = lambda t: __import__("re").sub(r"([<\[])\\(\\*)(/?s>|/?SYS\]|/?INST\]|/?ROLE\]|NEXT\])", r"\1\2\3", t)
    for r in found:
        own = [(x[2], x[3]) for x in sorted(want[r.conv_id])]
        assert [(t.role, t.text) for t in r.turns] == own
        loss = [unescape(r.formatted[s.start : s.start + s.length]) for s in r.loss_spans]
        assert loss == [t for role, t in own if role == "assistant"]
        runs = 1 + sum(a[0] != b[0] for a, b in zip(own[:-1], own[1:], strict=True))
        assert r.formatted.count("[NEXT]") == len(own) - runs


def test_empty(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
