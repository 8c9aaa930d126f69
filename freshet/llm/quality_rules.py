"""Quality rules with risk-controlled thresholds (SQL functions only).

Base counts of a text decide the plain rules. For every further rule (a ratio
that is high in bad texts) and every stratum (a band of text length), cutoffs
are taken from a fixed grid. The labelled documents are the holdout: no rule is
fitted on them, so of n good ones the number k that a cutoff rejects is
binomial. A cutoff is allowed if, at a false rejection rate of
ALPHA / rules, k or fewer would be seen with a probability of at most
DELTA / (rules * strata * cutoffs): the exact binomial tail with Bonferroni's
correction, which holds for all cutoffs at once, so that choosing among the
allowed ones is free. The one with the most bad less good rejections is used
(the highest of equals; none where no cutoff gains). With probability 1 - DELTA
the rules together reject at most ALPHA of the good documents of any stratum
that the base rules leave. With too few labels no cutoff is allowed.

Null or empty text: no words, base_failed. Null labels and null doc_ids in
labels count for nothing; of several labels of one document the lowest counts.
Repeated rows are judged each on its own. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.shared import WORD, WORD_GAP, written

#: Share of a stratum's good documents that all rules together may reject.
ALPHA = 0.04
#: Chance that this fails anywhere.
DELTA = 0.05
#: Factorials whose remainders are listed; beyond, three terms of the series are exact to 1e-12.
LISTED = 32
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOLS = "[#*$%&|<>]"
#: Upper bounds of a stratum's word count; the last stratum has none.
STRATA = (200, 600)
#: Cutoffs in thousandths: a rule rejects a text whose value is greater.
CUTOFFS = tuple(range(50, 1000, 50))
#: Rules and what they divide, in thousandths.
RULES = ("symbols", "bars", "dup_lines", "repeats")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def repeated_words(hashes: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more.

    hashes: of the windows, in order. Where all differ there is nothing to do.
    Else they are sorted with their places, and equal neighbours are repeats;
    each covers its words up to the next repeated window.
    """

    def repeats(pairs: Column) -> Column:
        return F.filter(
            pairs,
            lambda x, i: F.get(pairs, i - 1)["h"].eqNullSafe(x["h"]) | F.get(pairs, i + 1)["h"].eqNullSafe(x["h"]),
        )

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return _total(gaps)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    at = _let(pairs, lambda p: F.sort_array(F.transform(repeats(p), lambda x: x["at"])))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(_let(at, covered))


def window_hashes(words: Column) -> Column:
    last = F.size(words) - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts and base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD))
    df = docs.withColumns({"_words": words_of(F.col(text)), "_lines": lines})
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_bars": F.regexp_count(whole, F.lit("[|]")).cast("long"),
            "_windows": window_hashes(F.col("_words")),
        }
    ).drop("_words", "_lines")
    df = df.withColumn("n_repeat_words", repeated_words(F.col("_windows"))).drop("_windows")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def rule_values() -> Column:
    """The rules' values of a row with base counts, whole thousandths."""

    def share(part: str, whole: str) -> Column:
        return F.floor(1000 * F.col(part) / F.greatest(F.col(whole), F.lit(1))).cast("long")

    parts = {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "bars": share("n_bars", "n_words"),
    }
    return F.array(*(F.struct(F.lit(r).alias("rule"), parts[r].alias("value")) for r in RULES))


def stratum() -> Column:
    out = F.lit(len(STRATA))
    for i in reversed(range(len(STRATA))):
        out = F.when(F.col("n_words") < STRATA[i], F.lit(i)).otherwise(out)
    return out


def _factorial_rest(n: Column) -> Column:
    """What Stirling's formula leaves of ln n!: listed for small n, a series from there on."""
    small = [math.lgamma(i + 1) - (0.5 * math.log(2 * math.pi * i) + i * math.log(i) - i) for i in range(1, LISTED)]
    listed = F.get(F.array(F.lit(0.0), *map(F.lit, small)), F.least(n, F.lit(LISTED)).cast("int"))
    return F.when(n < LISTED, listed).otherwise(1 / (12 * n) - 1 / (360 * n * n * n) + 1 / (1260 * n * n * n * n * n))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), k at most the mean; exact for any n.

    The term of k comes from Stirling's formula with what that leaves out. The
    terms below it are made of it one by one, each smaller than the one before;
    after twelve standard deviations they are under 1e-30 of it and end.
    """
    k, n, q = k.cast("double"), n.cast("double"), 1 - p
    above = n - k
    rest = _factorial_rest(n) - _factorial_rest(k) - _factorial_rest(above)
    far = k * F.ln(k / (n * p)) + above * F.ln(above / (n * q))
    largest = F.exp(rest - far) * F.sqrt(n / (2 * math.pi * k * above))
    top = F.when(k == 0, F.exp(n * math.log1p(-p))).otherwise(largest)
    count = F.least(k, F.ceil(12 * F.sqrt(n * p * q)) + 60).cast("long")

    def smaller(a: Column, j: Column) -> Column:
        return a["term"] * (k - j) / (n - k + j + 1) * (q / p)

    return F.aggregate(
        F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1)).otherwise(F.array().cast("array<long>")),
        F.struct(top.alias("term"), top.alias("total")),
        lambda a, j: F.struct(smaller(a, j).alias("term"), (a["total"] + smaller(a, j)).alias("total")),
        lambda a: a["total"],
    )


def cutoffs(based: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The cutoff used for each (rule, stratum): at most rules x strata rows.

    based: rows with base counts; labels: doc_id, quality. The rows shuffle as
    one count per rule, stratum and value, so a hot stratum costs a thousand rows.
    """
    marked = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").alias("_label_id"))
        .agg(F.min("quality").alias("_quality"))
    )
    held = based.filter(~F.col("base_failed")).join(marked, F.col("doc_id") == F.col("_label_id"))
    counts = (
        held.select((F.col("_quality") == 1).alias("good"), stratum().alias("stratum"), F.explode(rule_values()).alias("r"))
        .groupBy("stratum", F.col("r.rule").alias("rule"), F.least(F.col("r.value"), F.lit(1000)).alias("value"))
        .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    )

    def over(which: str, cutoff: int) -> Column:
        return F.sum(F.when(F.col("value") > cutoff, F.col(which)).otherwise(0))

    tried = (
        counts.groupBy("stratum", "rule")
        .agg(
            F.sum("good").alias("n"),
            F.array(
                *(F.struct(F.lit(c).alias("cutoff"), over("good", c).alias("k"), over("bad", c).alias("hits")) for c in CUTOFFS)
            ).alias("c"),
        )
        .select("stratum", "rule", "n", F.inline("c"))
    )
    tests = len(RULES) * (len(STRATA) + 1) * len(CUTOFFS)
    rate = alpha / len(RULES)
    # A count above the mean has a tail of about a half; it needs no sum.
    allowed = tried.filter(F.col("k") <= rate * F.col("n")).filter(
        binomial_tail(F.col("k"), F.col("n"), rate) <= delta / tests
    )
    gain = F.col("hits") - F.col("k")
    best = F.max(F.when(gain > 0, F.struct(gain.alias("gain"), F.col("cutoff"))))
    return allowed.groupBy("stratum", "rule").agg(best.alias("b")).select("stratum", "rule", F.col("b.cutoff").alias("cutoff"))


def judge(based: DataFrame, allowed: DataFrame) -> DataFrame:
    """Adds kept: not base_failed, and no value over its allowed cutoff."""
    by_stratum = allowed.groupBy(F.col("stratum").alias("_stratum")).agg(
        *(F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_max_{r}") for r in RULES)
    )
    # At most len(STRATA) + 1 rows.
    df = based.withColumns({"_at": stratum(), "_values": rule_values()}).join(
        F.broadcast(by_stratum), F.col("_at") == F.col("_stratum"), "left"
    )
    over = [F.coalesce(F.col("_values")[i]["value"] > F.col(f"_max_{r}"), F.lit(False)) for i, r in enumerate(RULES)]
    rejected = over[0]
    for o in over[1:]:
        rejected = rejected | o
    return df.withColumn("kept", ~F.col("base_failed") & ~rejected).select(*based.columns, "kept")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed and kept of every row of docs.

    Texts are read once: their counts, a few numbers a row, are written to the
    shared folder and read for the holdouts and for the verdicts.
    """
    based = written(with_base(docs.select("doc_id", "text")).drop("text"))
    return judge(based, cutoffs(based, labels))
