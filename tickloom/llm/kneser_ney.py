"""Quality by an interpolated modified Kneser-Ney model of characters.

The model is trained on all trusted text. Counts of character 4-grams, their continuation counts of
orders three to one and the context totals are tables that hash-partitioned joins combine order by
order. A document's perplexity is compared with quantiles of the trusted documents' perplexity in
its language, at both ends: scrambled text is too surprising, endlessly repeated text too little.

Symbols are the lower-cased characters themselves, white space (runs count once) being one; a gram is
four of them, 16 bits each. Characters beyond the first plane share the 6,400 code points that Unicode
leaves to private use. The tables grow with what is trusted. Up to BROADCAST entries, a size that is
counted first, they are sent to the tasks; larger ones stay where they are, and the documents' distinct
grams are joined with them order by order. Both ways give the same perplexities.

Cases: a null text is the empty text; a text without symbols has perplexity 1 and is kept; a null
language is a language of its own; a language without trusted text is held to the quantiles of all
trusted text; without any trusted text all rows are kept; a doc_id labelled several times is trusted
if all its labels are; repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.line_dedup import member
from tickloom.llm.texts import code_points, groups, rows, saved

BITS, ORDER = 16, 4
#: The base of the lowest order: any of so many symbols may come.
SYMBOLS = 1 << BITS
BORDER = 0x20
PRIVATE, PRIVATE_SIZE = 0xE000, 6400
#: Entries of all tables that may be sent to every task, 16 bytes each there.
BROADCAST = 4_000_000
#: Quantiles of trusted documents between which a document is kept.
LOW, HIGH = 0.001, 0.999
#: A short text's mean is uncertain: it is moved towards the middle by so many standard errors.
ERRORS, SPREAD = 3.0, 2.5
# White space beyond ASCII's: next line and no-break space.
_SPACES = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0], np.uint32)


def symbols(text: str) -> np.ndarray:
    """A text's symbols behind three borders and with one border after it; runs of white space count once."""
    codes = code_points(text.lower())
    codes = np.where(codes > 0xFFFF, PRIVATE + codes % PRIVATE_SIZE, codes)
    codes = np.where(np.isin(codes, _SPACES), BORDER, codes)
    codes = np.concatenate([codes, [BORDER]])
    first = np.concatenate([[True], (codes[1:] != BORDER) | (codes[:-1] != BORDER)])
    # white space at the beginning is part of the borders before it
    first[0] = codes[0] != BORDER
    return np.concatenate([[BORDER] * 3, codes[first]]).astype(np.uint64)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(each symbol with the three before it as one number, text of each symbol)."""
    found = [symbols(t) for t in texts]
    seen = np.concatenate(found) if found else np.zeros(0, np.uint64)
    sizes = np.array([len(f) for f in found], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(seen)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    bits = np.uint64(BITS)
    codes = ((seen[:-3] << bits | seen[1:-2]) << bits | seen[2:-1]) << bits | seen[3:]
    own = place[3:] >= 3
    return codes[own].view(np.int64), owner[3:][own]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n) over all texts."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in groups(batches):
            yield rows(schema, *np.unique(grams(texts)[0], return_counts=True))

    return docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    given = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return given.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts of trusted documents; a bitmap of bounded size keeps most others out of the shuffle."""
    trusted = saved(trusted_ids(labels), "trusted")
    likely = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    likely = likely.where(member(trusted, "doc_id")("doc_id"))
    return likely.join(trusted.hint("shuffle_hash"), "doc_id").select("text")


def discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ from the numbers of grams that occur once, twice, three and four times."""
    n = {r["n"]: r["k"] for r in counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    n1, n2, n3, n4 = (max(1, n.get(i, 0)) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [min(max(d, 0.1), i - 0.05) for i, d in enumerate(found, 1)]


def _shorter(order: int):
    """A gram of `order` symbols without its first one."""
    return F.col("gram").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))


def order_tables(top: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For orders 1 to 4: (gram, p) of the seen grams and (context, back) of the seen contexts.

    Lower orders count the different symbols that stand before a gram. p is interpolated with the
    next lower order: p = (n - D(n)) / total + back * p(shorter), joined on the shorter gram.
    """
    counts = {ORDER: top}
    for order in range(ORDER - 1, 0, -1):
        shorter = counts[order + 1].groupBy(_shorter(order + 1).alias("gram"))
        counts[order] = saved(shorter.agg(F.count("*").alias("n")), f"grams{order}")
    tables = []
    for order in range(1, ORDER + 1):
        d1, d2, d3 = discounts(counts[order])
        n = F.col("n")
        off = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        seen = counts[order].withColumn("context", F.shiftrightunsigned("gram", BITS))
        back = seen.groupBy("context").agg(F.sum("n").alias("total"), (F.sum(off) / F.sum("n")).alias("back"))
        back = saved(back, f"contexts{order}")
        own = seen.join(back, "context").withColumn("own", (n - off) / F.col("total"))
        if order == 1:
            p = own.select("gram", (F.col("own") + F.col("back") / SYMBOLS).alias("p"))
        else:
            lower = tables[-1][0].select(F.col("gram").alias("shorter"), F.col("p").alias("lower"))
            own = own.withColumn("shorter", _shorter(order))
            p = own.join(lower, "shorter").select("gram", (F.col("own") + F.col("back") * F.col("lower")).alias("p"))
        tables.append((saved(p, f"probabilities{order}"), back.select("context", "back")))
    return tables


def train(docs: DataFrame, labels: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    return order_tables(saved(gram_counts(trusted_texts(docs, labels)), "grams"))


class Model:
    """The tables as sorted arrays, for tasks."""

    def __init__(self, tables: list[tuple[DataFrame, DataFrame]]):
        self.orders = [(self._sorted(p, "gram", "p"), self._sorted(back, "context", "back")) for p, back in tables]

    @staticmethod
    def _sorted(table: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
        found = table.select(key, value).toArrow()
        keys, values = (found[c].to_numpy() for c in (key, value))
        order = np.argsort(keys)
        return keys[order], values[order]

    @staticmethod
    def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each key is in the table, its value or 1)."""
        known, values = table
        if not len(known):
            return np.zeros(len(keys), bool), np.ones(len(keys))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        there = known[at] == keys
        return there, np.where(there, values[at], 1.0)

    def probabilities(self, keys: np.ndarray) -> np.ndarray:
        """P(last symbol | the others) of grams of the highest order, seen or not."""
        result = np.full(len(keys), 1 / SYMBOLS)
        for order, (p, back) in enumerate(self.orders, 1):
            mask = np.uint64((1 << BITS * order) - 1)
            own = (keys.view(np.uint64) & mask) if order < ORDER else keys.view(np.uint64)
            _, weight = self._found(back, (own >> np.uint64(BITS)).view(np.int64))
            there, value = self._found(p, own.view(np.int64))
            result = np.where(there, value, weight * result)
        return result


def entries(tables: list[tuple[DataFrame, DataFrame]]) -> int:
    return sum(t.count() for pair in tables for t in pair)


def perplexities(docs: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """doc_id, lang, n_symbols, bits (mean per symbol; 0 for none)."""
    return _sent(docs, tables) if entries(tables) <= BROADCAST else _joined(docs, tables)


def _sent(docs: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    form = "doc_id long, lang string, n_symbols long, bits double"
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_symbols", pa.int64()), ("bits", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(Model(tables))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for columns, texts in groups(batches):
            codes, owner = grams(texts)
            distinct, place = np.unique(codes, return_inverse=True)
            logs = np.log2(model.probabilities(distinct))[place]
            n = np.bincount(owner, minlength=len(texts))
            empty = np.array([not t.strip() for t in texts], bool)
            total = -np.bincount(owner, logs, minlength=len(texts))
            n, total = np.where(empty, 0, n), np.where(empty, 0, total)
            yield rows(schema, columns["doc_id"], columns["lang"], n, total / np.maximum(n, 1))

    return docs.select("doc_id", "lang", "text").mapInArrow(each, form)


def _joined(docs: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The same by joins: all distinct grams with the tables, order by order, then each document's with those."""
    schema = pa.schema([("number", pa.int64()), ("gram", pa.int64()), ("times", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, texts in groups(batches):
            kept = [k for k, t in enumerate(texts) if t.strip()]
            for k in kept:
                codes, times = np.unique(grams([texts[k]])[0], return_counts=True)
                yield rows(schema, np.full(len(codes), columns["number"][k]), codes, times)

    numbered = saved(
        docs.select("doc_id", "lang", "text").withColumn("number", F.monotonically_increasing_id()), "numbered"
    )
    each_gram = saved(numbered.select("number", "text").mapInArrow(each, "number long, gram long, times long"), "document-grams")
    asked = each_gram.select("gram").distinct().withColumn("p", F.lit(1 / SYMBOLS))
    for order, (p, back) in enumerate(tables, 1):
        own = _shorter(order + 1) if order < ORDER else F.col("gram")
        asked = asked.withColumn("own", own).withColumn("context", F.shiftrightunsigned("own", BITS))
        asked = asked.join(back, "context", "left")
        asked = asked.join(p.select(F.col("gram").alias("own"), F.col("p").alias("seen")), "own", "left")
        asked = asked.select("gram", F.coalesce("seen", F.coalesce("back", F.lit(1.0)) * F.col("p")).alias("p"))
    sums = each_gram.join(asked, "gram").groupBy("number")
    sums = sums.agg(F.sum("times").alias("n"), (-F.sum(F.col("times") * F.log2("p"))).alias("total"))
    found = numbered.select("number", "doc_id", "lang").join(sums, "number", "left")
    n = F.coalesce("n", F.lit(0))
    return found.select("doc_id", "lang", n.alias("n_symbols"), F.coalesce(F.col("total") / F.col("n"), F.lit(0.0)).alias("bits"))


def judge(docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, lowest, highest (bits allowed), kept."""
    scored = saved(perplexities(docs, train(docs, labels)), "perplexities")
    slack = F.lit(ERRORS * SPREAD) / F.sqrt(F.greatest("n_symbols", F.lit(1)))
    scored = scored.withColumns({"at_least": F.col("bits") - slack, "at_most": F.col("bits") + slack})
    trusted = scored.where("n_symbols > 0").join(trusted_ids(labels), "doc_id", "left_semi")
    bounds = [
        F.percentile_approx("at_most", F.lit(low), 10_000).alias("lowest"),
        F.percentile_approx("at_least", F.lit(high), 10_000).alias("highest"),
    ]
    by_lang = trusted.groupBy("lang").agg(*bounds).withColumn("known", F.lit(True))
    overall = trusted.agg(*bounds).select(F.col("lowest").alias("all_lowest"), F.col("highest").alias("all_highest")).first()
    found = scored.join(by_lang.withColumnRenamed("lang", "of"), F.col("lang").eqNullSafe(F.col("of")), "left").drop("of")
    edges = {
        "lowest": F.coalesce("lowest", F.lit(overall["all_lowest"]).cast("double")),
        "highest": F.coalesce("highest", F.lit(overall["all_highest"]).cast("double")),
    }
    inside = (F.col("at_most") >= F.col("lowest")) & (F.col("at_least") <= F.col("highest"))
    kept = (F.col("n_symbols") == 0) | F.coalesce(inside, F.lit(True))
    return found.withColumns(edges).select(
        "doc_id", "lang", "n_symbols", F.pow(F.lit(2.0), "bits").alias("perplexity"), "lowest", "highest", kept.alias("kept")
    )
