"""Benchmark passages in documents, found by spaced-seed hashing.

Words are compared in lower case without punctuation. A mask covers a few consecutive words and
ignores some of them; the hash of the words it keeps is a seed. Seeds of the benchmark are
joined with the seeds at every position of every document. A hit fixes how document and item
lie against each other; the aligned words around it are then compared, and a hit counts if
some WINDOW consecutive words of the item agree in SHARE of the places (a shorter item: all of
its words). The two masks are chosen so that every window with up to two substituted words is
hit by one of them at some offset, which tests/llm checks by trying all substitutions. A shorter
item has masks of its own (short_masks): its words are cut into PARTS parts, and a mask leaves out
as many parts as words may differ, so every allowed substitution misses one of the masks.

Hits that follow each other on one alignment are verified once, at the first of them: where
words repeat, n places of a document and m of an item cost about n + m verifications, not n x m.

Spark functions only, and no shuffle of texts: positions are generated, hashed, looked up and
verified inside one stage. Long items are cut into segments that share WINDOW - 1 words, so every
window lies in one. Segments are dealt by hash to blocks of about BLOCK_ROWS seeds, and a block is
broadcast, one pass over the documents for each: neither more nor longer items make a broadcast grow.

Cases: NULL and empty texts or items have no words and match nothing. Items of fewer than
``least`` words match nothing; report() says how many there are. With least=1 they match exactly. What
lies beyond either end of a document counts as different words. A document is known by its id
and its text: rows that share an id (or have none) are judged each by its own text, repeated rows each
get their row. Repeated items count once per item_id. Other columns may have any names.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import let, named_apart, query, table, words

MASKS = ("11010111", "11010001011")
WINDOW = 13
SHARE = 0.8
LEAST = 5
#: Words of a segment of an item, without those that the next one shares.
SEGMENT = 2000
#: Parts that an item of fewer than WINDOW words is cut into.
PARTS = 5
#: Seed rows that are broadcast at once (32 bytes each).
BLOCK_ROWS = 500_000


def word_codes(text: Column) -> Column:
    """A 64-bit code for each word: lower case, letters and digits only."""
    plain = F.regexp_replace(F.lower(text), r"[\p{P}\p{S}]+", "")
    return F.transform(words(plain), lambda w: F.xxhash64(w))


def seed(codes: Column, at: Column, number: int, mask: str) -> Column:
    """Hash of the words that the mask keeps; NULL where it does not fit."""
    kept = [F.get(codes, at + k) for k, c in enumerate(mask) if c == "1"]
    return F.when(at + len(mask) <= F.size(codes), F.xxhash64(F.lit(number), *kept))


def seeds(rows: DataFrame, codes: str, masks: tuple[str, ...], keep: list[str]) -> DataFrame:
    """keep, place and seed for every position of the array column codes and every mask."""
    n = len(masks)
    slots = F.when(F.size(codes) > 0, F.sequence(F.lit(0), F.size(codes) * n - 1))
    slot = F.col("__slot")
    place = (slot / n).cast("int")
    value = reduce(
        lambda out, k: F.when(slot % n == k, seed(F.col(codes), place, k, masks[k])).otherwise(out),
        range(n),
        F.lit(None).cast("long"),
    )
    every = rows.select(*keep, codes, F.explode(slots).alias("__slot"))
    return every.select(*keep, codes, place.alias("place"), value.alias("seed")).where("seed IS NOT NULL")


def short_masks(n: int) -> list[tuple[int, str]]:
    """(offset, mask) in an item of n words, so that any words that may differ are ignored by one of them.

    A mask begins and ends with a word that it keeps: words beyond it may lie outside the document.
    """
    part = [k * PARTS // n for k in range(n)]
    differ = n - math.ceil(n * SHARE)
    found = []
    for out in itertools.combinations(range(PARTS), differ):
        mask = "".join("0" if p in out else "1" for p in part)
        found.append((mask.index("1"), mask.strip("0")))
    return sorted(set(found))


#: Words from a hit's place on that a window around it, or around the hit after it, can have.
AHEAD = WINDOW + 3


def around(words_: Column, place: Column) -> Column:
    """The words of an array from WINDOW before a place to AHEAD after it."""
    begin = F.greatest(place - WINDOW, F.lit(0))
    return F.slice(words_, begin + 1, place - begin + AHEAD)


def overlap() -> Column:
    """Most agreeing places in WINDOW consecutive ones around a hit (all of a shorter item), by running sums.

    mine: words of the document around the hit; what is missing there agrees with nothing.
    """
    ahead = F.least(F.col("place"), F.lit(WINDOW)) - F.least(F.col("item_place"), F.lit(WINDOW))
    same = F.transform(
        around(F.col("item_codes"), F.col("item_place")),
        lambda x, k: F.when(k + ahead >= 0, F.coalesce((F.get("mine", k + ahead) == x).cast("int"), F.lit(0))).otherwise(0),
    )
    width = F.least(F.lit(WINDOW), F.size("item_codes"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("best"))

    def step(s: Column, a: Column, k: Column) -> Column:
        n = a["n"] + F.get(s, k) - F.when(k >= width, F.get(s, k - width)).otherwise(0)
        return let(n, lambda t: F.struct(t.alias("n"), F.when(k >= width - 1, F.greatest(a["best"], t)).otherwise(0).alias("best")))

    return let(same, lambda s: F.aggregate(F.sequence(F.lit(0), F.size(s) - 1), zero, lambda a, k: step(s, a, k))["best"])


def follows() -> Column:
    """True where as many words as a mask has agree from one place before, on the same alignment.

    That place is a hit of the same mask then, so only the first hit of such a run is left.
    """
    span = max(map(len, MASKS))
    before = F.slice("mine", F.least(F.col("place"), F.lit(WINDOW)), span) == F.slice("item_codes", F.col("item_place"), span)
    return F.when((F.size("item_codes") >= WINDOW) & (F.col("place") > 0) & (F.col("item_place") > 0), before).otherwise(False)


def coded_items(benchmark: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """Distinct (item_id, item_codes) of items with words."""
    coded = benchmark.select(F.col(item_col).alias("item_id"), word_codes(F.col(item_text)).alias("item_codes"))
    return coded.where(F.size("item_codes") > 0).distinct()


def segments(items: DataFrame) -> DataFrame:
    """Items in segments of bounded length that share WINDOW - 1 words; any window lies in one."""
    last = F.greatest(F.lit(0), F.floor((F.size("item_codes") - WINDOW) / SEGMENT)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), last), lambda k: F.slice(F.col("item_codes"), k * SEGMENT + 1, F.lit(SEGMENT + WINDOW - 1))
    )
    return items.select("item_id", F.explode(cut).alias("item_codes"))


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
    item_col: str = "item_id", item_text: str = "text", least: int = LEAST,
) -> DataFrame:
    """(doc_id, text_key, item_id, matched): items that a document has a window of, and its best match.

    text_key: xxhash64 of the text.
    """
    items = segments(coded_items(benchmark, item_col, item_text).where(F.size("item_codes") >= least))
    items = items.select(F.xxhash64("item_id", "item_codes").alias("part"), "item_id", "item_codes")
    short = sorted(
        r.n for r in items.where(F.size("item_codes") < WINDOW).select(F.size("item_codes").alias("n")).distinct().collect()
    )  # fewer than WINDOW numbers
    own = [(n, at, mask) for n in short for at, mask in short_masks(n)]
    masks = (*MASKS, *sorted({mask for _, _, mask in own}))
    item_seeds = seeds(items, "item_codes", MASKS, ["part"]).select("part", "place", "seed")
    if own:
        short_seeds = [
            F.struct(
                F.lit(at).alias("place"),
                F.when(F.size("item_codes") == n, seed(F.col("item_codes"), F.lit(at), masks.index(mask), mask)).alias("seed"),
            )
            for n, at, mask in own
        ]
        few = items.where(F.size("item_codes") < WINDOW).select("part", F.inline(F.array(*short_seeds)))
        item_seeds = item_seeds.union(few.where("seed IS NOT NULL"))
    item_seeds = item_seeds.select(
        F.col("part").alias("seed_part"), F.col("place").alias("item_place"), F.col("seed").alias("item_seed")
    )
    n_blocks = max(1, math.ceil(item_seeds.count() / BLOCK_ROWS))
    coded = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), word_codes(F.col(text)).alias("codes")
    )
    at = seeds(coded, "codes", masks, ["doc_id", "text_key"])
    found = []
    for b in range(n_blocks):
        some_seeds = F.broadcast(item_seeds.where(F.pmod("seed_part", F.lit(n_blocks)) == b))
        some_items = F.broadcast(items.where(F.pmod("part", F.lit(n_blocks)) == b))
        # A hit carries a few words along, not the document.
        hits = at.join(some_seeds, F.col("seed") == F.col("item_seed")).select(
            "doc_id", "text_key", "seed_part", "place", "item_place", around(F.col("codes"), F.col("place")).alias("mine")
        )
        first = hits.join(some_items, F.col("seed_part") == F.col("part")).where(~follows())
        need = F.ceil(F.least(F.lit(WINDOW), F.size("item_codes")) * F.lit(SHARE))
        found.append(
            first.select("doc_id", "text_key", "item_id", overlap().alias("matched"), need.alias("need"))
            .where("matched >= need")
            .groupBy("doc_id", "text_key", "item_id")
            .agg(F.max("matched").alias("matched"))
        )
    every = reduce(DataFrame.union, found)
    # Segments of an item can be in several blocks.
    return every if n_blocks == 1 else every.groupBy("doc_id", "text_key", "item_id").agg(F.max("matched").alias("matched"))


def report(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
    item_text: str = "text", least: int = LEAST,
) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (ascending), best match and the items too short to be looked for, for every row."""
    short = coded_items(benchmark, item_col, item_text).where(F.size("item_codes") < least).count()
    per_doc = (
        leaks(docs, benchmark, id_col, text, item_col, item_text, least)
        .groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"))
        .agg(
            F.sort_array(F.collect_list("item_id")).alias("item_ids"),
            F.count("*").alias("n_items"),
            F.max("matched").alias("matched"),
        )
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"))
    joined = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left")
    return joined.select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("item_ids", F.array().cast(joined.schema["item_ids"].dataType)).alias("item_ids"),
        F.coalesce("matched", F.lit(0)).cast("long").alias("matched"),
        F.lit(short).cast("long").alias("short_items"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **items) -> DataFrame:
    """docs without the documents that hold a passage of the benchmark."""
    name = named_apart(docs, "id", "key")
    bad = leaks(docs, benchmark, id_col, text, **items).select(
        F.col("doc_id").alias(name["id"]), F.col("text_key").alias(name["key"])
    )
    same = F.col(id_col).eqNullSafe(F.col(name["id"])) & (F.xxhash64(text) == F.col(name["key"]))
    return docs.join(bad.distinct(), same, "left_anti")


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           regexp_replace(lower(coalesce(text, '')), '[\p{P}\p{S}]+', '', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
           regexp_replace(lower(coalesce(text, '')), '[\p{P}\p{S}]+', '', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
bw AS (SELECT item_id, least(13, len(w)) AS width, unnest(w) AS word, unnest(range(len(w))) AS q FROM b WHERE len(w) >= 5),
same AS (
  SELECT doc_id, item_id, width, p - q AS shift, q FROM dw JOIN bw USING (word)),
placed AS (
  SELECT doc_id, item_id, width, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY q
           RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS n
  FROM same),
hits AS (
  SELECT doc_id, item_id, max(n) AS matched FROM placed WHERE 10 * n >= 8 * width GROUP BY doc_id, item_id),
per_doc AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids,
         max(matched) AS matched
  FROM hits GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items,
       coalesce(item_ids, '') AS item_ids, coalesce(matched, 0) AS matched,
       (SELECT count(*) FROM b WHERE len(w) BETWEEN 1 AND 4) AS short_items
FROM d LEFT JOIN per_doc USING (doc_id)
"""


@query("op3_decontaminate", SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = report(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark"))
    return found.withColumn("item_ids", F.array_join("item_ids", ","))
