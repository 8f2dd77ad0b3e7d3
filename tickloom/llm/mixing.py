"""Mixing documents to target weights by soft domain membership, in DataFrame functions only.

A naive Bayes model of character counts, learned from a labelled table, gives each document a
posterior over domains. Which characters are counted is learned too: those that tell most about the
domain (mutual information) in CHOSEN_FROM labelled documents, whatever the alphabet; all other
characters are one class, and capitals and symbols are two more. Projected-gradient least squares then fits a rate for each document so that
the expected tokens of each domain, the sum of rate x tokens x posterior, meet target totals: every
step measures the residuals in one aggregate over the documents, and moves each rate against its
own posterior's share of them, down to the lowest rate allowed. Residuals are scaled by the domains'
sizes and steps by the documents' sizes, so that a step of one cannot overshoot.

A rate is carried out by repeating a row: its whole part, and once more with the chance of the rest,
decided by a hash of doc_id and text.

Cases: a null text is the empty text; documents without tokens get rates like others and weigh
nothing; labels without a domain are ignored, several labels of a doc_id all count; a target domain
that no label names cannot be met and is left out; without any labelled text all rates are the start
rate 1; repeated rows get equal rates; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.texts import free_name, saved, text_key

#: Characters that are counted one by one, and labelled documents at most that they are chosen from.
CHARACTERS, CHOSEN_FROM = 21, 4000
GROUPS = {"symbols": r"[#*$%&|<>!]", "capitals": r"\p{Lu}"}
WORD = r"[^\x20\x09-\x0D]+"
#: How many characters' worth of evidence a text of n characters has: EVIDENCE * sqrt(n).
EVIDENCE = 3.0
#: The fit ends when no domain is off by more than PRECISION of its size, or when a step no longer lowers
#: the squared residuals by a thousandth: then rates at their lowest keep the targets out of reach, which
#: the totals reached show. STEPS only guards against a fit without end.
STEPS, PRECISION, PROGRESS = 300, 1e-3, 0.999


def names_of(letters: list[str]) -> list[str]:
    """The columns of the character counts."""
    return [f"c{i}" for i in range(len(letters))] + list(GROUPS) + ["others"]


def telling_characters(docs: DataFrame, labels: DataFrame, count: int = CHARACTERS) -> list[str]:
    """The lower-case characters that share most information with the domain, in labelled documents."""
    known = labels.where(F.col("domain").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "domain")
    # of bounded size, so it can be sent to the texts
    taught = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(CHOSEN_FROM))
    texts = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text")).join(taught, "doc_id")
    each = texts.select("domain", F.explode(F.split("text", "")).alias("character")).where(~F.col("character").rlike(r"^\s?$"))
    counts = saved(each.groupBy("domain", "character").agg(F.count("*").cast("double").alias("n")), "character-counts")
    of_domain = counts.groupBy("domain").agg(F.sum("n").alias("in_domain"))
    of_all = counts.groupBy("character").agg(F.sum("n").alias("in_all"))
    total = counts.agg(F.sum("n")).first()[0] or 1.0
    joined = counts.join(of_domain, "domain").join(of_all, "character")
    told = F.col("n") / total * F.ln(F.col("n") * total / (F.col("in_domain") * F.col("in_all")))
    best = joined.groupBy("character").agg(F.sum(told).alias("told")).orderBy(F.desc("told"), "character").limit(count)
    return [r["character"] for r in best.collect()]


def measured(docs: DataFrame, letters: list[str], *columns) -> DataFrame:
    """`columns`, text_key, tokens (words) and the character counts of each row.

    A text is lower-cased once, in a projection of its own.
    """
    text = F.coalesce("text", F.lit(""))
    held = docs.select(*columns, text.alias("text"), F.lower(text).alias("lower"), text_key(F.col("text")).alias("text_key"))
    # bytes are counted, as their number is known without reading the text again
    lost = [F.octet_length("lower") - F.octet_length(F.replace("lower", F.lit(c), F.lit(""))) for c in letters]
    found = [(n / len(c.encode())).cast("int") for n, c in zip(lost, letters)]
    found += [F.regexp_count("text", F.lit(p)) for p in GROUPS.values()]
    names = names_of(letters)
    counted = held.select(
        *columns,
        "text_key",
        F.regexp_count("text", F.lit(WORD)).cast("double").alias("tokens"),
        *[c.alias(n) for c, n in zip(found, names)],
        F.length("text").alias("n_chars"),
    )
    rest = F.greatest(F.col("n_chars") - _sum([F.col(n) for n in names[:-1]]), F.lit(0))
    return counted.withColumn("others", rest).drop("n_chars")


@dataclass
class Classifier:
    """log P(character class | domain) and log P(domain): domains x classes numbers."""

    domains: list[str]
    names: list[str] = field(default_factory=list)
    priors: list[float] = field(default_factory=list)
    logs: list[list[float]] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return [f"p{k}" for k in range(len(self.domains))]

    def posteriors(self, features: DataFrame) -> DataFrame:
        """`features` (the columns of `measured`) with p0, p1, ...: one per domain.

        Scores are columns of their own, so that each is computed once.
        """
        scores = [f"score{k}" for k in range(len(self.domains))]
        weight = F.lit(EVIDENCE) / F.sqrt(F.greatest(_sum([F.col(n) for n in self.names]), F.lit(1)))
        scored = features.withColumn("weight", weight)
        for name, prior, logs in zip(scores, self.priors, self.logs):
            scored = scored.withColumn(name, F.lit(prior) + F.col("weight") * _dot([F.col(n) for n in self.names], logs))
        shares = {
            p: 1.0 / _sum([F.exp(F.least(F.col(o) - F.col(s), F.lit(700.0))) for o in scores])
            for p, s in zip(self.columns, scores)
        }
        return scored.drop(*self.names).withColumns(shares).drop("weight", *scores)


def _sum(columns: list[Column]) -> Column:
    return sum(columns[1:], columns[0]) if columns else F.lit(0)


def _dot(columns: list[Column], numbers: list[float]) -> Column:
    return _sum([c * F.lit(x) for c, x in zip(columns, numbers)]) if columns else F.lit(0.0)


def classifier(features: DataFrame, labels: DataFrame, names: list[str]) -> Classifier:
    """Learn from `features` (doc_id and the columns of `measured`) and `labels` (doc_id, domain)."""
    taught = features.join(labels.where(F.col("domain").isNotNull()).select("doc_id", "domain"), "doc_id")
    found = taught.groupBy("domain").agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names]).orderBy("domain").collect()
    model, texts = Classifier([], names), sum(r["n"] for r in found)
    for r in found:
        total = sum(r[n] + 1 for n in names)
        model.domains.append(r["domain"])
        model.priors.append(math.log(r["n"] / texts))
        model.logs.append([math.log((r[n] + 1) / total) for n in names])
    return model


@dataclass
class Mix:
    """A fitted mix: how to find a document's rate from its posterior."""

    model: Classifier
    letters: list[str]
    lowest: float
    moves: list[list[float]]  # per step and domain: scaled residual
    targets: list[float]
    reached: list[float]

    def rate(self) -> Column:
        """From the columns p0, p1, ..."""
        posterior = [F.col(n) for n in self.model.columns]
        rate = F.lit(1.0)
        for move in self.moves:
            rate = F.greatest(F.lit(self.lowest), rate - _dot(posterior, move))
        return rate


def fit(docs: DataFrame, labels: DataFrame, weights: dict[str, float], lowest: float = 0.0) -> tuple[Mix, DataFrame]:
    """The mix, and the saved table (doc_id, text_key, tokens, p0, p1, ...) that it was fitted on.

    `weights`: share of the tokens that each domain is to have; domains not named get none. The
    total is the documents' tokens, or if rates may not fall below `lowest`, as many as that takes.
    """
    letters = telling_characters(docs, labels)
    features = saved(measured(docs, letters, "doc_id"), "characters")
    model = classifier(features, labels, names_of(letters))
    size, own = len(model.domains), model.columns
    table = saved(model.posteriors(features), "posteriors")
    posterior = [F.col(n) for n in own]

    def totals(rate: Column) -> list[float]:
        got = table.agg(*[F.sum(rate * F.col("tokens") * p).alias(n) for p, n in zip(posterior, own)]).first()
        return [float(x or 0.0) for x in got]

    mix = Mix(model, letters, lowest, [], [], [])
    if not size:
        return mix, table
    sizes = totals(F.lit(1.0))
    named = sum(weights.get(d, 0.0) for d in model.domains)
    shares = [weights.get(d, 0.0) / named if named else s / max(1.0, sum(sizes)) for d, s in zip(model.domains, sizes)]
    total = max([sum(sizes), *(lowest * s / w for s, w in zip(sizes, shares) if w > 0)])
    mix.targets = [w * total for w in shares]
    mix.reached, kept, before = sizes, 0, math.inf
    for step in range(STEPS):
        move = [(r - t) / s if s > 0 else 0.0 for r, t, s in zip(mix.reached, mix.targets, sizes)]
        loss = sum(m * m * s for m, s in zip(move, sizes))
        if max(map(abs, move)) < PRECISION or loss > PROGRESS * before:
            break
        before = loss
        mix.moves.append(move)
        # the rates so far; a long chain of steps is not written out again each time
        if "rate" not in table.columns:
            rate = mix.rate()
        else:
            rate = F.col("rate")
            for later in mix.moves[kept:]:
                rate = F.greatest(F.lit(lowest), rate - _dot(posterior, later))
        if step % 10 == 9:
            table = saved(table.withColumn("rate", rate), "rates")
            rate, kept = F.col("rate"), len(mix.moves)
        mix.reached = totals(rate)
    return mix, table.drop("rate")


def copies(rate: Column, doc_id: Column, key: Column) -> Column:
    """How often a row is repeated: the rate, its fraction decided by a hash."""
    chance = F.pmod(F.xxhash64(doc_id, key, F.lit("mix")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("int")


def rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float], lowest: float = 0.0) -> DataFrame:
    """doc_id, tokens, posterior (one per domain in order of name), domains, targets, reached, rate, copies per row.

    `targets` and `reached` are the domains' token totals: wanted, and expected with these rates.
    """
    mix, table = fit(docs, labels, weights, lowest)
    posterior = [F.col(n) for n in mix.model.columns]
    rate = mix.rate()
    names = [F.lit(d) for d in mix.model.domains]
    return table.select(
        "doc_id",
        F.col("tokens").cast("long").alias("tokens"),
        (F.array(*names) if names else F.array().cast("array<string>")).alias("domains"),
        (F.array(*posterior) if names else F.array().cast("array<double>")).alias("posterior"),
        *[F.array(*map(F.lit, x)).cast("array<double>").alias(n) for n, x in (("targets", mix.targets), ("reached", mix.reached))],
        rate.alias("rate"),
        copies(rate, F.col("doc_id"), F.col("text_key")).alias("copies"),
    )


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float], lowest: float = 0.0) -> DataFrame:
    """`docs` with every row repeated as its rate says. Rates are found again from the texts: no join."""
    mix, _ = fit(docs, labels, weights, lowest)
    times = free_name(docs, "mix_copies")
    held = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    shown = measured(held, mix.letters, "row", "doc_id")
    shown = mix.model.posteriors(shown).withColumn("rate", mix.rate())
    again = shown.select("row", copies(F.col("rate"), F.col("doc_id"), F.col("text_key")).alias(times))
    return again.select("row", F.explode(F.array_repeat(F.lit(0), F.col(times)))).select("row.*")
