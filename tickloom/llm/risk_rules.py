"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule rejects a text whose statistic is above a cutoff. On labelled good texts of a stratum
(language), the number that a cutoff rejects is binomial; a cutoff may be used if the exact
probability of so few rejections at a true rate of `risk` is small. Each rule's cutoffs are tested
from the loosest on and the last one before a failure is used, which needs no correction within the
rule; over rules and strata the level is divided by their number (Bonferroni). So with probability
1 - `level`, no rule in any stratum rejects more than `risk` of its good texts, and all rules together
not more than len(RULES) times that, 3 % with the figures here. A rule without a usable cutoff rejects
nothing: with 20 tests a cutoff that rejects no labelled text at all needs 996 good texts of its
language, so small tables have base rules alone.

Base rules reject before that: fewer than 10 words, or over a fifth of the words in repeated 5-word
windows. Windows are compared by a 64-bit hash within one text.

Cases: a null text has no words and fails the base rules; a null language is a stratum of its own; a
doc_id labelled several times is good if all its labels are; null labels are ignored; repeated rows
are judged alike and count as often as they occur; without labels only the base rules reject; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.texts import saved

#: Share of good texts that one rule may reject in a stratum, and the chance of exceeding it anywhere.
RISK, LEVEL = 0.006, 0.05
MIN_WORDS, WINDOW, MOST_REPEATED = 10, 5, 20

SPACE = r"[\x20\x09-\x0D]+"

#: Rules: numerator and denominator of the statistic, and its cutoffs from loose to strict.
RULES: dict[str, tuple[str, str, list[float]]] = {
    "symbols": ("n_symbols", "n_words", [5.0, 3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1]),
    "dup_lines": ("n_dup_lines", "n_words", [0.2, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01]),
    "long_words": ("word_chars", "n_words", [40.0, 30.0, 20.0, 15.0, 12.0, 11.0, 10.0, 9.0, 8.0]),
    "short_words": ("n_words", "word_chars", [1.0, 0.7, 0.5, 0.4, 0.35, 0.3, 0.27, 0.25, 0.23]),
    "repeats": ("n_repeat_words", "n_words", [0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02, 0.01]),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, computed once per row."""
    return F.transform(F.array(value), body).getItem(0)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more among `words`, a bound array."""

    def covered(hashes: Column) -> Column:
        # windows sorted by hash: one that equals a neighbour is repeated
        def of_sorted(s: Column) -> Column:
            here = lambda e, k: (e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"])
            places = F.array_sort(F.transform(F.filter(s, here), lambda e: e["i"]))
            start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("words"))
            step = lambda a, i: F.struct(
                i.alias("last"), (a["words"] + F.least(F.lit(window), i - a["last"])).alias("words")
            )
            return F.aggregate(places, start, step, lambda a: a["words"])

        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(ordered, of_sorted))

    starts = F.sequence(F.lit(0), F.size(words) - window)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(window)]))
    return F.when(F.size(words) < window, 0).otherwise(let(hashes, covered))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the base figures of every text."""
    text = F.coalesce("text", F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0)
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    return docs.select(
        "doc_id",
        "lang",
        let(words, of_words).alias("w"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines, of_lines).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "lang", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")


def with_base(figures: DataFrame) -> DataFrame:
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return figures.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | repeated)


def statistic(rule: str) -> Column:
    above, below, _ = RULES[rule]
    return F.col(above) / F.when(F.col(below) > 0, F.col(below))


def log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series at n + 9."""
    x = n + F.lit(9.0)
    series = (x - 0.5) * F.ln(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    below = F.lit(0.0)
    for k in range(1, 9):
        below = below + F.ln(n + k)
    return series - below


def at_most(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) of a binomial X; beyond the mean, where no test passes, 1.

    Below the mean the terms k, k - 1, ... fall; those under 1e-18 of the first are not added, of
    which a double could not tell anyway.
    """
    first = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.ln(F.lit(rate)) + (n - k) * F.log1p(F.lit(-rate))
    spread = F.sqrt(n * rate)
    steps = F.when(k >= 1, F.sequence(F.lit(1), F.least(k, F.ceil(12 * spread + 100)).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    odds = (1 - rate) / rate

    def step(a: Column, i: Column) -> Column:
        term = a["term"] * (k - i + 1) / (n - k + i) * odds
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    total = F.exp(first) * F.aggregate(steps, start, step, lambda a: a["sum"])
    return F.when(k > n * rate, 1.0).otherwise(F.least(total, F.lit(1.0)))


def cutoffs(figures: DataFrame, good: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """lang and, per rule, the strictest cutoff that keeps the risk (null: none).

    `figures`: rows with base figures; `good`: doc_ids of good labelled texts.
    """
    held = with_base(figures).where("not base_failed").join(good, "doc_id", "left_semi")
    counts = [
        F.sum((statistic(rule) > cut).cast("long")).alias(f"{rule}_{i}")
        for rule, (_, _, grid) in RULES.items()
        for i, cut in enumerate(grid)
    ]
    counted = saved(held.groupBy("lang").agg(F.count("*").alias("n"), *counts), "counted")
    tests = [
        F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("i"), F.lit(cut).alias("cut"), F.coalesce(f"{rule}_{i}", F.lit(0)).alias("k"))
        for rule, (_, _, grid) in RULES.items()
        for i, cut in enumerate(grid)
    ]
    each = counted.select("lang", "n", F.explode(F.array(*tests)).alias("t")).select("lang", "n", "t.*")
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    tested = max(1, counted.count()) * len(RULES)
    passes = at_most(k, n, risk) <= F.lit(level) / F.lit(tested)
    upto = Window.partitionBy("lang", "rule").orderBy("i")
    judged = each.withColumn("passes", passes).withColumn("all_pass", F.min(F.col("passes").cast("int")).over(upto))
    best = [F.min(F.when((F.col("rule") == r) & (F.col("all_pass") == 1), F.col("cut"))).alias(f"cut_{r}") for r in RULES]
    return judged.groupBy("lang").agg(*best)


def good_ids(labels: DataFrame) -> DataFrame:
    given = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return given.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """doc_id, lang, the base figures, base_failed, kept."""
    figures = saved(statistics(docs), "figures")
    chosen = cutoffs(figures, good_ids(labels), risk, level).withColumnRenamed("lang", "of")
    joined = with_base(figures).join(chosen, F.col("lang").eqNullSafe(F.col("of")), "left")
    broken = F.lit(False)
    for rule in RULES:
        broken = broken | F.coalesce(statistic(rule) > F.col(f"cut_{rule}"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~broken).drop("of", *[f"cut_{r}" for r in RULES])
