"""Quality rules whose cutoffs are selected on labelled documents with a bounded risk.

Every document gets a few rates (symbols, repeated words, repeated lines, capitals, marks). A
step is a cutoff for each of them; a step rejects a document when one of its rates exceeds its
cutoff. The steps are fixed beforehand, from the laxest to the strictest, and each rejects all that
those before it reject, so a document has one number: the first step that rejects it.

Per stratum, the steps are tried in that order on the labelled good documents. A step is
certified when the exact binomial test says: if it rejected more than ``risk`` of the good documents,
so few of them would be hit with probability ``error / tests`` at most. The first
step that fails ends the sequence, which therefore needs no further correction. There is a test for
each stratum and one for all strata pooled, and ``tests`` is their number (Bonferroni): with probability
1 - error, no stratum with a cutoff of its own loses more than ``risk`` of its good documents. Of
the certified steps the one with the most labelled bad documents rejected, less ``price`` times
the good ones, is used.

A stratum that can't have a cutoff of its own, because even no hit among its good documents would
prove nothing yet (rare, NULL or unlabelled strata), gets the pooled one, which bounds the risk over
all strata together and is marked as pooled; but none if it hits more than ``risk`` of
the stratum's own labelled good documents. Copies prove nothing new, so each distinct text of a
stratum counts once.

Spark functions only. Counts and rates are computed inside each row; what is shuffled is a
narrow row per document for the join with the labels, and sums per stratum and step.

Cases: NULL or empty text has no words and all counts 0 (base_failed). A stratum that is NULL
is one of its own. Documents without a label are judged but teach nothing; a text labelled
more than once is good only if all its labels are 1; labels NULL are ignored.
With no labels there are no cutoffs and only the base test rejects. Repeated documents give
repeated rows. Windows are compared by 64-bit hashes within one document. More than MAX_STRATA strata with
labels are refused.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .base import SPACE, let, named_apart, query, table, words

WINDOW = 5
#: Laxest and strictest cutoff of each rule; fixed before any label is seen.
RANGES = {
    "symbol_rate": (0.5, 0.01),
    "repeat_rate": (0.5, 0.15),
    "dup_line_rate": (0.9, 0.3),
    "capital_rate": (0.9, 0.3),
    "mark_rate": (0.5, 0.1),
}
RULES = tuple(RANGES)
STEPS = 40
#: The cutoffs of each rule by step, falling by the same factor from step to step.
CUTOFFS = {
    r: tuple(round(lax * (strict / lax) ** (k / (STEPS - 1)), 6) for k in range(STEPS)) for r, (lax, strict) in RANGES.items()
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Strata with labels, whose cutoffs are broadcast; more is refused, as a stratum should be a coarse class.
MAX_STRATA = 10_000


def repeated_words(tokens: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the array."""

    def starts_of_repeats(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            keyed,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
        return F.aggregate(
            starts,
            zero,
            lambda a, p: F.struct(
                (a["n"] + p + WINDOW - F.greatest(p, a["upto"])).alias("n"), (p + WINDOW).alias("upto")
            ),
            lambda a: a["n"],
        )

    def of_hashes(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            covered(starts_of_repeats(hashes))
        )

    def of_words(hashed: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashed) - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(WINDOW)]),
        )
        return let(windows, of_hashes)

    return F.when(
        F.size(tokens) > WINDOW, let(F.transform(tokens, lambda w: F.xxhash64(w)), of_words)
    ).otherwise(F.lit(0))


def without(text: Column, characters: str) -> Column:
    """Code points of text that are none of the characters."""
    return F.char_length(F.regexp_replace(text, characters, ""))


def with_counts(docs: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """docs with the base counts and the rates of the rules, under the given names."""
    n = names
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    rate = lambda part, whole: F.col(n[part]) / F.greatest(F.col(n[whole]), F.lit(1))
    out = docs.withColumns({n["words"]: words(F.col(text)), n["lines"]: lines})
    counted = {
        "n_words": F.size(n["words"]),
        "word_chars": F.char_length(F.array_join(n["words"], "")),
        "n_symbols": F.char_length(body) - without(body, r"[#*$%&|<>]+"),
        "n_capitals": F.char_length(body) - without(body, r"\p{Lu}+"),
        "n_marks": F.char_length(body) - without(body, "[!?]+"),
        "n_lines": F.size(n["lines"]),
        "n_dup_lines": F.size(n["lines"]) - F.size(F.array_distinct(n["lines"])),
        "n_repeat_words": repeated_words(F.col(n["words"])),
    }
    # As the rows of a generator, counts are computed once, however often filters name them.
    row = F.struct(*[c.cast("long").alias(n[k]) for k, c in counted.items()])
    out = out.select("*", F.inline(F.array(row)))
    return out.withColumns(
        {
            n["base_failed"]: (F.col(n["n_words"]) < 10)
            | (100 * F.col(n["n_repeat_words"]) > 20 * F.col(n["n_words"])),
            n["symbol_rate"]: rate("n_symbols", "word_chars"),
            n["repeat_rate"]: rate("n_repeat_words", "n_words"),
            n["dup_line_rate"]: rate("n_dup_lines", "n_lines"),
            n["capital_rate"]: rate("n_capitals", "word_chars"),
            n["mark_rate"]: rate("n_marks", "word_chars"),
        }
    )


def count_names(docs: DataFrame) -> dict[str, str]:
    extra = ("words", "lines", "n_lines", "n_capitals", "n_marks", "base_failed")
    return named_apart(docs, *COUNTS, *RULES, *extra)


def features(docs: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """One narrow row per document: doc_id, stratum, text_key, counts, rates and base_failed."""
    kept = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text).alias("__body"), F.col(stratum).cast("string").alias("stratum"),
        F.xxhash64(text).alias("text_key"),
    )
    n = count_names(kept)
    out = with_counts(kept, "__body", n)
    return out.select("doc_id", "stratum", "text_key", *[F.col(n[c]).alias(c) for c in (*COUNTS, *RULES, "base_failed")])


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1, by Stirling's series ten steps further up."""
    y = x + 10
    series = (y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727)
    series = series + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    step = F.lit(0.0)
    for k in range(10):
        step = step + F.log(x + k)
    return series - step


#: Terms of a binomial tail that are summed one by one; what lies below is bounded above.
TERMS = 5000


def log_tail_below(k: Column, n: Column, p: float) -> Column:
    """ln P(X <= k) for X ~ Bin(n, p) and k < n p: terms from k downwards.

    Below TERMS terms the rest is bounded by a geometric series, which errs towards a larger
    probability and so never certifies wrongly.
    """
    k, n = k.cast("double"), n.cast("double")
    odds = (1 - p) / p
    top = (
        log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    last = F.least(k, F.lit(float(TERMS)))
    acc = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    down = F.aggregate(
        F.when(last >= 1, F.sequence(F.lit(0), last.cast("int") - 1)).otherwise(F.array().cast("array<int>")),
        acc,
        lambda a, j: let(
            a["term"] * (k - j) / (n - k + j + 1) * odds,
            lambda t: F.struct(t.alias("term"), (a["total"] + t).alias("total")),
        ),
    )
    i = k - last
    shrink = i / (n - i + 1) * odds
    return let(down, lambda d: top + F.log(d["total"] + d["term"] * shrink / (1 - shrink)))


def first_step(rates: dict[str, Column]) -> Column:
    """The first step that rejects a document of these rates; STEPS if none does."""
    out = F.lit(STEPS)
    for k in reversed(range(STEPS)):
        hit = F.lit(False)
        for r in RULES:
            hit = hit | (rates[r] > CUTOFFS[r][k])
        out = F.when(hit, F.lit(k)).otherwise(out)
    return out


def labelled(measured: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """(stratum, step, good): one row per distinct labelled text of a stratum that passes the base test."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("doc_id"))
        .agg((F.min(F.col(label).cast("int")) == 1).alias("good"))
    )
    once = measured.where(~F.col("base_failed")).select(
        "doc_id", "stratum", "text_key", "n_words", "word_chars", *RULES
    )
    texts = once.join(known, "doc_id").groupBy("stratum", "text_key", "n_words", "word_chars").agg(
        F.min("good").alias("good"), *[F.first(r).alias(r) for r in RULES]
    )
    return texts.select("stratum", "good", first_step({r: F.col(r) for r in RULES}).alias("step"))


def learn_cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label: str = "quality",
    risk: float = 0.02,
    error: float = 0.05,
    price: float = 5.0,
) -> DataFrame:
    """Per stratum with labels: step (NULL: no cutoffs), pooled, n_good, n_bad, rejects_good, rejects_bad.

    One more row, of ``every`` true, is that of all strata pooled, for strata without labels.
    measured: as features() gives it. labels: id_col and label, 1 for good.
    """
    spark = measured.sparkSession
    by_step = labelled(measured, labels, id_col, label).groupBy("stratum", "step").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    few = by_step.groupBy("stratum").agg(F.collect_list(F.struct("step", "good", "bad")).alias("steps"))
    rows = few.limit(MAX_STRATA + 1).collect()  # at most STEPS + 1 entries each
    if len(rows) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata; choose a coarser column")
    known = spark.createDataFrame(
        [(r.stratum, s.step, s.good, s.bad) for r in rows for s in r.steps], "stratum string, step int, good long, bad long"
    )
    # From here on: rows per stratum and step, whatever the number of documents.
    n_tests = len(rows) + 1
    every = known.select(F.lit(True).alias("every"), F.lit(None).cast("string").alias("stratum"), "step", "good", "bad")
    each = known.select(F.lit(False).alias("every"), "stratum", "step", "good", "bad")
    total = each.unionByName(every).groupBy("every", "stratum").agg(
        F.sum("good").alias("n_good"),
        F.sum("bad").alias("n_bad"),
        *[
            F.array(*[F.coalesce(F.sum(F.when(F.col("step") <= k, F.col(c))), F.lit(0)) for k in range(STEPS)]).alias(f"hit_{c}")
            for c in ("good", "bad")
        ],
    )
    tried = total.select("*", F.posexplode("hit_good").alias("k", "hits")).withColumn("hits_bad", F.get("hit_bad", F.col("k")))
    possible = (F.col("n_good") > 0) & (F.col("hits") < risk * F.col("n_good"))
    ln_p = F.when(possible, log_tail_below(F.col("hits"), F.col("n_good"), risk))
    sequence = Window.partitionBy("every", "stratum").orderBy("k")
    passes = F.coalesce(ln_p <= math.log(error / n_tests), F.lit(False))
    gain = F.col("hits_bad") - price * F.col("hits")
    best = F.max(
        F.when(F.col("certified") & (gain > 0), F.struct(gain.alias("gain"), (-F.col("k")).alias("laxest"), "k"))
    )
    chosen = (
        tried.withColumn("passes", passes)
        .withColumn("certified", F.min("passes").over(sequence))
        .groupBy("every", "stratum", "n_good", "n_bad", "hit_good", "hit_bad")
        .agg(best["k"].alias("own"))
    )
    pooled = chosen.where("every").select(F.col("own").alias("common"))  # one row, if any
    # No hit at all among so many good documents would prove nothing.
    rare = F.col("n_good") * math.log1p(-risk) > math.log(error / n_tests)
    fits = F.get("hit_good", F.col("common")) <= risk * F.col("n_good")
    step = F.when(F.col("every") | ~rare, F.col("own")).when(fits, F.col("common"))
    found = chosen.join(F.broadcast(pooled), F.lit(True), "left").select(
        "every", "stratum", step.alias("step"), (F.col("every") | rare).alias("pooled"), "n_good", "n_bad", "hit_good", "hit_bad"
    )
    at = lambda c: F.coalesce(F.get(c, F.col("step")), F.lit(0))
    return found.select(
        "every", "stratum", "step", "pooled", "n_good", "n_bad", at("hit_good").alias("rejects_good"), at("hit_bad").alias("rejects_bad")
    )


def with_step(df: DataFrame, cutoffs: DataFrame, stratum: str, out: str) -> DataFrame:
    """df with the step of its stratum, or of all strata where the stratum has no labels."""
    rows = cutoffs.select("every", "stratum", "step").collect()  # MAX_STRATA + 1 at most
    common = next((r.step for r in rows if r.every), None)
    name = named_apart(df, "stratum", "step")
    few = df.sparkSession.createDataFrame(
        [(r.stratum, r.step) for r in rows if not r.every], f"{name['stratum']} string, {name['step']} int"
    ).withColumn(out, F.coalesce(name["step"], F.lit(STEPS)))
    same = F.col(stratum).cast("string").eqNullSafe(F.col(name["stratum"]))
    joined = df.join(F.broadcast(few), same, "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(STEPS if common is None else common))).drop(*name.values())


def rejected(step: str, names: dict[str, str]) -> Column:
    """True where a rate exceeds its cutoff of the step; no step rejects nothing."""
    out = F.lit(False)
    for r in RULES:
        cut = F.get(F.array(*[F.lit(c) for c in CUTOFFS[r]]), F.col(step))
        out = out | F.coalesce(F.col(names[r]) > cut, F.lit(False))
    return out


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """measured with kept: neither the base test nor the step of the stratum rejects."""
    own = named_apart(measured, "cut")["cut"]
    joined = with_step(measured, cutoffs, "stratum", own)
    kept = ~F.col("base_failed") & ~rejected(own, {r: r for r in RULES})
    return joined.withColumn("kept", kept).drop(own)


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str = "lang", **risk
) -> DataFrame:
    """The documents that pass, with the columns of docs.

    Texts are measured twice, once narrowly for learning and once here, and never shuffled.
    """
    cutoffs = learn_cutoffs(features(docs, id_col, text, stratum), labels, id_col, **risk)
    n = count_names(docs)
    counted = with_counts(docs, text, n)
    own = named_apart(counted, "cut")["cut"]
    joined = with_step(counted, cutoffs, stratum, own)
    return joined.where(~F.col(n["base_failed"]) & ~rejected(own, n)).select(*[F.col(f"`{c}`") for c in docs.columns])


def _sql(risk: float = 0.02, error: float = 0.05, price: float = 5.0) -> str:
    """The same in SQL: words by text, tails by the logarithm of the gamma function."""
    steps = ", ".join(
        f"({k}, " + ", ".join(f"CAST({CUTOFFS[r][k]} AS DOUBLE)" for r in RULES) + ")" for k in range(STEPS)
    )
    names = ", ".join(f"c_{r}" for r in RULES)
    over = " OR ".join(f"{r} > c_{r}" for r in RULES)
    return rf"""
WITH w AS (
  SELECT doc_id, lang AS stratum, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5),
wins AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS win FROM starts),
twice AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
cover AS (SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
counted AS (
  SELECT doc_id, stratum, t, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         length(t) - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')) AS n_capitals,
         length(t) - length(regexp_replace(t, '[!?]+', '', 'g')) AS n_marks,
         len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cover USING (doc_id)),
rated AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols / greatest(word_chars, 1) AS symbol_rate, n_repeat_words / greatest(n_words, 1) AS repeat_rate,
         n_dup_lines / greatest(n_lines, 1) AS dup_line_rate, n_capitals / greatest(word_chars, 1) AS capital_rate,
         n_marks / greatest(word_chars, 1) AS mark_rate
  FROM counted),
known AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
steps(k, {names}) AS (VALUES {steps}),
texts AS (
  SELECT stratum, bool_and(good) AS good, {", ".join(f"min({r}) AS {r}" for r in RULES)}
  FROM rated JOIN known USING (doc_id) WHERE NOT base_failed GROUP BY stratum, t),
hit AS (SELECT stratum, good, k, {over} AS hit FROM texts, steps),
counted_hits AS (
  SELECT false AS pooled, stratum, k, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE good AND hit) AS g,
         count(*) FILTER (WHERE NOT good AND hit) AS b FROM hit GROUP BY ALL
  UNION ALL
  SELECT true, NULL, k, count(*) FILTER (WHERE good), count(*) FILTER (WHERE good AND hit),
         count(*) FILTER (WHERE NOT good AND hit) FROM hit GROUP BY k),
limits AS (SELECT ln(CAST({error} AS DOUBLE) / count(DISTINCT (pooled, stratum))) AS ln_error FROM counted_hits),
tested AS (
  SELECT *, n_good * ln(1 - {risk}) > ln_error AS rare,
         g < {risk} * n_good AND ln(list_sum(list_transform(range(g + 1), lambda i: exp(
             lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({risk}) + (n_good - i) * ln(1 - {risk})))))
           <= ln_error AS passes
  FROM counted_hits, limits),
certified AS (
  SELECT *, bool_and(passes) OVER (PARTITION BY pooled, stratum ORDER BY k) AS sure, b - {price} * g AS gain FROM tested),
own AS (
  SELECT pooled, stratum, k FROM certified WHERE sure AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY pooled, stratum ORDER BY gain DESC, k) = 1),
common AS (SELECT k FROM own WHERE pooled),
chosen AS (
  SELECT DISTINCT c.stratum, CASE WHEN NOT c.rare THEN o.k
                                  WHEN p.g <= {risk} * p.n_good THEN p.k END AS k
  FROM (SELECT DISTINCT stratum, rare FROM tested WHERE NOT pooled) c
  LEFT JOIN own o ON NOT o.pooled AND o.stratum IS NOT DISTINCT FROM c.stratum
  LEFT JOIN (SELECT * FROM tested WHERE NOT pooled AND k = (SELECT k FROM common)) p
    ON p.stratum IS NOT DISTINCT FROM c.stratum),
placed AS (
  SELECT r.*, CASE WHEN EXISTS (SELECT 1 FROM chosen c WHERE c.stratum IS NOT DISTINCT FROM r.stratum)
                   THEN (SELECT max(k) FROM chosen c WHERE c.stratum IS NOT DISTINCT FROM r.stratum)
                   ELSE (SELECT max(k) FROM common) END AS k
  FROM rated r)
SELECT doc_id, {", ".join(COUNTS)}, base_failed, NOT base_failed AND NOT coalesce({over}, false) AS kept, {", ".join(RULES)}
FROM placed LEFT JOIN steps USING (k)
"""


@query("op10_quality_rules", _sql())
def op10(spark: SparkSession, folder: str) -> DataFrame:
    measured = stage(features(table(spark, folder, "documents", "doc_id", "text", "lang")), "quality-features")
    labels = table(spark, folder, "labels", "doc_id", "quality")
    judged = judge(measured, learn_cutoffs(measured, labels))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", *RULES)
