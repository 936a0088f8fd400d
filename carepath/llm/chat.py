r"""Conversations as training texts, by Spark expressions on collected turns.

Template: ``<s>``, then for every run of adjacent turns of one role
``[SYS]body[/SYS]``, ``[INST]body[/INST]``, ``body</s>`` (assistant) or
``[ROLE]name[/ROLE]body</s>`` (any other role). The texts of a run are joined by ``[NEXT]``, so
merging loses nothing. What looks like one of these control strings inside a text or a role's
name, with any number of backslashes after its bracket, gets one more; reading takes one away.
No text can therefore end its turn or open another one.

The loss mask is a list of spans in code points: one per assistant text, without the markers.

A conversation is one output row; its turns are what is collected. Long ones cost time in
proportion to their text, and the offsets of n turns n^2 / 2 additions.

Cases: NULL text or role is empty. Equal turn numbers go by role, then text; NULL turns come
first. A NULL conv_id is a conversation of its own. No rows give no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import literal_rows
from .base import let, query, table

BEGIN, CLOSE, NEXT = "<s>", "</s>", "[NEXT]"
TAIL = r"(/?s>|/?SYS\]|/?INST\]|/?ROLE\]|NEXT\])"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){TAIL}", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){TAIL}", r"$1$2$3")


def opening(role: Column) -> Column:
    return (
        F.when(role == "system", F.lit("[SYS]"))
        .when(role == "user", F.lit("[INST]"))
        .when(role == ASSISTANT, F.lit(""))
        .otherwise(F.concat(F.lit("[ROLE]"), escaped(role), F.lit("[/ROLE]")))
    )


def closing(role: Column) -> Column:
    return F.when(role == "system", F.lit("[/SYS]")).when(role == "user", F.lit("[/INST]")).otherwise(F.lit(CLOSE))


def runs_of(turns: Column) -> Column:
    """Adjacent turns of one role as (role, texts, open, close); a run's texts are escaped."""
    n = F.size(turns)
    heads = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )
    return let(
        heads,
        lambda h: F.transform(
            h,
            lambda s, k: F.struct(
                F.get(turns, s)["role"].alias("role"),
                F.transform(
                    F.slice(turns, s + 1, F.coalesce(F.get(h, k + 1), n) - s), lambda t: escaped(t["text"])
                ).alias("texts"),
                opening(F.get(turns, s)["role"]).alias("open"),
                closing(F.get(turns, s)["role"]).alias("close"),
            ),
        ),
    )


def spans_of(runs: Column) -> Column:
    """Start and length (code points) of every assistant text in the formatted conversation."""
    pieces = F.flatten(
        F.transform(
            runs,
            lambda r: F.transform(
                r["texts"],
                lambda t, k: F.struct(
                    F.when(k == 0, F.char_length(r["open"])).otherwise(len(NEXT)).alias("before"),
                    F.char_length(t).alias("chars"),
                    F.when(k == F.size(r["texts"]) - 1, F.char_length(r["close"])).otherwise(0).alias("after"),
                    (r["role"] == ASSISTANT).alias("loss"),
                ),
            ),
        )
    )
    empty = F.array().cast("array<struct<start:int,length:int>>")
    return F.aggregate(
        pieces,
        F.struct(F.lit(len(BEGIN)).alias("at"), empty.alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + p["before"] + p["chars"] + p["after"]).alias("at"),
            F.when(
                p["loss"],
                F.array_append(
                    a["spans"], F.struct((a["at"] + p["before"]).alias("start"), p["chars"].alias("length"))
                ),
            ).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, formatted, loss_spans), one row per conversation."""
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    collected = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    runs = collected.select("conv_id", runs_of(F.col("turns")).alias("runs"))
    rendered = F.transform("runs", lambda r: F.concat(r["open"], F.array_join(r["texts"], NEXT), r["close"]))
    return runs.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(rendered, "")).alias("formatted"),
        spans_of(F.col("runs")).alias("loss_spans"),
    )


RUN = (
    r"(?s)\[SYS\].*?\[/SYS\]|\[INST\].*?\[/INST\]|\[ROLE\].*?\[/ROLE\].*?</s>|.*?</s>"
)


def parse_chats(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as they were before merging."""
    body = F.substring(formatted, len(BEGIN) + 1, F.char_length(formatted))

    def turns(run: Column) -> Column:
        named = run.startswith("[ROLE]")
        role = (
            F.when(run.startswith("[SYS]"), F.lit("system"))
            .when(run.startswith("[INST]"), F.lit("user"))
            .when(named, unescaped(F.regexp_extract(run, r"(?s)^\[ROLE\](.*?)\[/ROLE\]", 1)))
            .otherwise(F.lit(ASSISTANT))
        )
        texts = F.regexp_replace(run, r"(?s)^(\[SYS\]|\[INST\]|\[ROLE\].*?\[/ROLE\])|(\[/SYS\]|\[/INST\]|</s>)$", "")
        return F.transform(
            F.split(texts, r"\[NEXT\]"), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text"))
        )

    return F.flatten(F.transform(F.regexp_extract_all(body, F.lit(RUN), F.lit(0)), turns))


SAMPLE = "</s>[INST] ok [/INST]"

SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (
  SELECT *, row_number() OVER w AS rn,
         coalesce(lag(role) OVER w = role, false) AS goes_on, coalesce(lead(role) OVER w = role, false) AS continues,
         length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?SYS\]|/?INST\]|/?ROLE\]|NEXT\])')) AS chars,
         length(role) + len(regexp_extract_all(role, '[<\[]\\*(?:/?s>|/?SYS\]|/?INST\]|/?ROLE\]|NEXT\])')) AS role_chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(chars
         + CASE WHEN goes_on THEN 6 WHEN role = 'system' THEN 5 WHEN role = 'user' THEN 6
                WHEN role = 'assistant' THEN 0 ELSE 13 + role_chars END
         + CASE WHEN continues THEN 0 WHEN role = 'system' THEN 6 WHEN role = 'user' THEN 7 ELSE 4 END)
         AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""


@query("op5_chat_format", SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    extra = literal_rows(spark, [(-1, 0, "user", SAMPLE), (-1, 1, ASSISTANT, SAMPLE)], turns.schema)
    chats = format_chats(turns.unionByName(extra))
    joined = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    read = chats.select("conv_id", "formatted", parse_chats(F.col("formatted")).alias("turns"), F.array_join(loss, "").alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(joined, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
