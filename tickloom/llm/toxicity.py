"""Toxicity of deobfuscated text.

Noisy channel: a hidden spelling may have been written with look-alike characters (0 for o), with
spacers between its letters, or with letters repeated. Chunks of a text that show such signs become a
lattice of possible letters; the Viterbi path under a character trigram model of the corpus and
the channel's costs is the restored spelling. All other chunks have one path, themselves.

The restored words, and their beginnings of four to six letters, are hashed to features. Document
counts in toxic and clean labelled texts choose those that speak for toxicity and weigh them by their
log-likelihood ratio. A logistic curve over a text's sum of weights and its number of features, fitted
to a quarter of the labelled texts that the weights do not see, turns them into a score.

Cases: a null text is the empty text and scores PRIOR, as does any text without a weighed feature; a label
that occurs several times for a doc_id counts as toxic if one of them does; null labels are ignored;
without toxic labels nothing is evidence; repeated rows score alike; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.langid import letters
from tickloom.llm.texts import code_points, fold, groups, rows

SYMBOLS = 64
BUCKETS = 1 << 20
#: Score of a text without evidence.
PRIOR = 0.01
#: Labelled documents that the features are chosen from, about; all if there are fewer.
TAUGHT = 40_000
#: A feature has to be in so many toxic texts, and so many standard deviations above its share of all.
LEAST_TEXTS, LEAST_DEVIATION = 5, 5.0
#: Words whose features a worker process keeps.
KEPT_WORDS = 150_000

# Look-alikes and the letters that they stand for; fixed values.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
SPACERS = frozenset(" \t\n\r\v\f.-_*~^'`,/\\·")
COST_LOOKALIKE, COST_SPACER, COST_REPEAT, COST_BORDER = 1.0, 0.5, 0.5, 1.0
#: Of a look-alike before a word that is only punctuation; one letter less is worth about as much.
COST_FRONT = 3.0

_EDGES = "\"'.,;:?!*#%&|()[]{}<>-_/\\~^`«»„“”¿¡…=+"
# A letter three times in a row, or two letters that are doubled.
_TRIPLE = re.compile(r"([^\W\d_])\1\1|([^\W\d_])\2.*?([^\W\d_])\3")
# Look-alikes that may stand for the first letter of a word.
_FRONT = "(!|+"
_MIXED = re.compile(r"[^\W\d_]")
# Single letters or look-alikes apart from each other, over any white space.
_ONE = r"(?:[^\W_]|[@$!|+€£(])"
_SPACED = re.compile(rf"(?<!\S){_ONE}(?:[\s.\-_*]{{1,4}}{_ONE}){{2,}}(?!\S)")
_MAY_BE_SPACED = re.compile(r"(?:^|\s)\S\s+\S\s+\S(?:\s|$)")


def symbol_table() -> np.ndarray:
    """Symbol of every code point: 0 for a border, 1-26 for a-z, 27-63 for the other letters."""
    points = np.arange(0x110000)
    table = np.where(letters(), 27 + points % (SYMBOLS - 27), 0).astype(np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return table


def symbol(letter: str) -> int:
    code = ord(letter)
    return code - 96 if 97 <= code <= 122 else 27 + code % (SYMBOLS - 27)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(code, n): symbol trigrams of all texts; a border as middle symbol hides what is before it."""
    schema = pa.schema([("code", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = symbol_table(), np.zeros(SYMBOLS**3, np.int64)
        for _, texts in groups(batches):
            seen = table[code_points("  " + "  ".join(texts).lower() + "  ")].astype(np.int32)
            first = np.where(seen[1:-1] == 0, 0, seen[:-2])
            codes = (first * SYMBOLS + seen[1:-1]) * SYMBOLS + seen[2:]
            total += np.bincount(codes[(seen[1:-1] > 0) | (seen[2:] > 0)], minlength=SYMBOLS**3)
        used = np.flatnonzero(total)
        yield rows(schema, used.astype(np.int32), total[used])

    counted = docs.select("text").mapInArrow(count, "code int, n long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame, strength: float = 5.0) -> np.ndarray:
    """log P(c | a, b) as a table of SYMBOLS**3 values, learned from every text.

    The counts come from the whole corpus; there are at most 64**3 of them, and the table has 1 MB.
    """
    counts = np.zeros(SYMBOLS**3)
    for r in trigram_counts(docs).collect():
        counts[r["code"]] = r["n"]
    three = counts.reshape((SYMBOLS,) * 3)
    lower = np.full(SYMBOLS, 1 / SYMBOLS)
    for given in (three.sum(axis=(0, 1)), three.sum(axis=0), three):
        lower = (given + strength * lower) / (given.sum(axis=-1, keepdims=True) + strength)
    return np.log(lower).astype(np.float32)


def core_of(chunk: str) -> str:
    """A chunk without the punctuation around it; a look-alike right before its first letter stays."""
    core = chunk.strip(_EDGES)
    at = chunk.find(core) - 1
    return chunk[at] + core if core and at >= 0 and chunk[at] in _FRONT and core[0].isalpha() else core


def suspicious(core: str) -> bool:
    """Whether a chunk (without edge punctuation) may hide another spelling."""
    if core.isalpha():
        return _TRIPLE.search(core) is not None
    return _MIXED.search(core) is not None and any(c in LOOKALIKES or c in SPACERS for c in core)


def restore_chunk(chunk: str, model: np.ndarray) -> str:
    """The likeliest spelling behind a lower-cased chunk: a Viterbi search over (last two symbols)."""
    states = {(0, 0): (0.0, None)}  # cost, chain of letters (letter, chain before)
    previous = ""
    for c in chunk:
        ways: list[tuple[str, float]] = []
        if c.isalpha():
            ways.append((c, 0.0))
        for letter in LOOKALIKES.get(c, ""):
            ways.append((letter, COST_LOOKALIKE))
        if c in SPACERS:
            ways.append(("", COST_SPACER))
            ways.append((" ", COST_BORDER))
        if c == previous:
            ways.append(("", COST_REPEAT))
        if not previous and c in _FRONT:
            ways.append((" ", COST_FRONT))
        previous = c
        if not ways:
            ways = [(" ", COST_BORDER)]
        following: dict = {}
        for (a, b), (cost, chain) in states.items():
            for letter, extra in ways:
                if not letter:
                    key, total, link = (a, b), cost + extra, chain
                else:
                    s = 0 if letter == " " else symbol(letter)
                    if s == 0 and b == 0:
                        key, total, link = (a, b), cost + extra, chain
                    else:
                        key = (b, s) if s else (0, 0)
                        total = cost + extra - float(model[a, b, s])
                        link = (letter, chain)
                if key not in following or total < following[key][0]:
                    following[key] = (total, link)
        states = following
    closed = [(cost - (float(model[a, b, 0]) if b else 0.0), chain) for (a, b), (cost, chain) in states.items()]
    chain, out = min(closed, key=lambda x: x[0])[1], []
    while chain:
        out.append(chain[0])
        chain = chain[1]
    return "".join(reversed(out)).strip()


def restore(text: str, model: np.ndarray) -> str:
    """A text, lower-cased, with every suspicious chunk replaced by its likeliest spelling."""
    text = text.lower()
    if _MAY_BE_SPACED.search(text):
        text = _SPACED.sub(lambda m: restore_chunk(m[0], model), text)
    out = []
    for chunk in text.split():
        core = core_of(chunk)
        out.append(chunk.replace(core, restore_chunk(core, model), 1) if suspicious(core) else chunk)
    return " ".join(out)


def _features(word: str) -> list[int]:
    parts = [word, *("^" + word[:n] for n in (4, 5, 6) if len(word) >= n)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) & (BUCKETS - 1) for p in parts]


class Reader:
    """Features of texts. Frequent chunks are kept with their number of features and the wanted ones."""

    def __init__(self, model: np.ndarray, weights: dict[int, float] | None = None):
        """Without `weights` every feature is wanted."""
        self.model, self.weights, self.known = model, weights, {}

    def chunk(self, chunk: str) -> tuple[int, tuple[int, ...]]:
        core = core_of(chunk)
        words = restore_chunk(core, self.model).split() if suspicious(core) else [core]
        parts = {f for w in words if w for f in _features(w)}
        found = len(parts), tuple(parts if self.weights is None else parts & self.weights.keys())
        if len(self.known) < KEPT_WORDS:
            self.known[chunk] = found
        return found

    def features(self, text: str) -> tuple[list[int], int]:
        """(distinct wanted features, number of features of the distinct chunks)."""
        text = text.lower()
        chunks = set(text.split())
        if _MAY_BE_SPACED.search(text):
            chunks.update(w for m in _SPACED.finditer(text) for w in restore_chunk(m[0], self.model).split())
        known, out, size = self.known.get, set(), 0
        for c in chunks:
            count, found = known(c) or self.chunk(c)
            size += count
            if found:
                out.update(found)
        return sorted(out), size

    def weighed(self, text: str) -> tuple[float, int]:
        found, size = self.features(text)
        return math.fsum(self.weights[f] for f in found), size


@dataclass
class Evidence:
    """Weights of the features that speak for toxicity, and the curve over (1, sum, log sum, log size)."""

    weights: dict[int, float]
    curve: tuple[float, ...] = (-4.6, 10.0, 0.0, 0.0)

    def score(self, weight: float, size: int) -> float:
        if not weight:
            return PRIOR
        z = sum(b * x for b, x in zip(self.curve, _position(weight, size)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _position(weight: float, size: int) -> tuple[float, ...]:
    return 1.0, weight / 10, math.log1p(weight), math.log1p(size)


def taught_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, part of about TAUGHT labelled documents, chosen by a hash; part 0 is for the curve.

    The ids are broadcast to the texts: so many have 0.6 MB.
    """
    given = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    given = given.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, TAUGHT / max(1, given.count()))
    given = given.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    given = given.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).cast("int"))
    return docs.select("doc_id", "text").join(F.broadcast(given), "doc_id").select("text", "toxic", "part")


def feature_weights(taught: DataFrame, model: np.ndarray) -> dict[int, float]:
    """feature -> log-likelihood ratio, for features that are clearly more frequent in toxic texts."""
    schema = pa.schema([("feature", pa.int32()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total, texts_of = Reader(model), np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for columns, texts in groups(batches):
            for text, toxic in zip(texts, columns["toxic"]):
                total[toxic, reader.features(text)[0]] += 1
                texts_of[toxic] += 1
        used = np.flatnonzero(total.any(axis=0))
        # feature -1 counts the texts
        yield rows(schema, np.append(used, -1), *(np.append(total[k, used], texts_of[k]) for k in (1, 0)))

    counted = taught.where("part > 0").select("text", "toxic").mapInArrow(count, "feature int, toxic long, clean long")
    summed = counted.groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    found = summed.where(f"feature = -1 or t >= {LEAST_TEXTS}").collect()
    toxic, clean = next(((r["t"], r["c"]) for r in found if r["feature"] == -1), (0, 0))
    weights = {}
    for r in found:
        t, c = r["t"], r["c"]
        if r["feature"] == -1 or not toxic:
            continue
        overall = (t + c) / (toxic + clean)
        deviation = (t / toxic - overall) / math.sqrt(overall * (1 - overall) / toxic + 1e-12)
        if deviation >= LEAST_DEVIATION:
            weights[r["feature"]] = max(0.0, math.log(t / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)))
    return weights


def evidence(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> Evidence:
    """Weights and curve, learned from `labels` (doc_id, toxic) and their texts."""
    taught = taught_texts(docs, labels)
    found = Evidence(feature_weights(taught, model))
    schema = pa.schema([("weight", pa.float64()), ("size", pa.int64()), ("toxic", pa.int32())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model, found.weights)
        for columns, texts in groups(batches):
            yield rows(schema, *zip(*(reader.weighed(t) for t in texts)), columns["toxic"])

    held = taught.where("part = 0").select("text", "toxic").mapInArrow(weigh, "weight double, size long, toxic int")
    points = held.where("weight > 0").toPandas()  # a quarter of TAUGHT at most
    if points["toxic"].nunique() == 2:
        x = np.array([_position(w, n) for w, n in zip(points["weight"], points["size"])])
        curve, y = np.zeros(x.shape[1]), points["toxic"].to_numpy()
        for _ in range(50):  # Newton steps with a slight pull to zero
            p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
            slope = x.T @ (x * (p * (1 - p))[:, None]) + 0.01 * np.eye(len(curve))
            curve = curve + np.linalg.solve(slope, x.T @ (y - p) - 0.01 * curve)
        found.curve = tuple(curve.tolist())
    return found


def scorer(model: np.ndarray, found: Evidence):
    """Column function: text -> score."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model, found.weights)
        for texts in batches:
            yield pd.Series([found.score(*reader.weighed(t or "")) for t in texts], dtype="float64")

    return score


def learned(docs: DataFrame, labels: DataFrame):
    """A column function text -> score, learned from the corpus and the labelled rows given."""
    model = character_model(docs)
    return scorer(model, evidence(docs, labels, model))


def outside(labels: DataFrame, folds: int, held_out: int) -> DataFrame:
    return labels.where(fold(F.col("doc_id"), folds) != held_out)


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; labels of the held-out fold are not used."""
    value = learned(docs, outside(labels, folds, held_out))(F.col("text"))
    out = docs.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), value.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def restored(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """doc_id and the restored text."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: restore(t or "", model))

    return docs.select("doc_id", run("text").alias("restored"))


