"""Packing by cutting-stock column generation.

A document is cut into pieces of the sequence length and one rest. Rests of up to 2 * EXACT tokens have
a class for each length; longer ones are rounded up to classes whose width doubles with the length, so
that a rest is rounded by less than one part in EXACT. The histogram of the classes is a cutting-stock problem: a pattern says how many
rests of each class share a sequence. The linear program over patterns is solved by the revised
simplex method, from first-fit's patterns on; a knapsack dynamic program prices new patterns against
the dual values until these prove the total to be within TOLERANCE of the optimum. Pattern counts are
rounded down, those with more than half a sequence left are cut once more where the rests allow it, and
what remains is placed first-fit by decreasing class. Documents are ranked within their class, and ranks are mapped
to the patterns' places by ranges, so any number of documents is assigned by joins and windows.

The histogram has at most a few hundred classes, whatever the number of documents; only it and the
patterns are on the driver. A pattern's pieces stand without gaps, so a sequence is short by what its
rounded lengths and its pattern leave over.

Cases: a null or empty text is the end id alone; repeated rows are packed as often as they occur; an
empty table gives an empty result; a null doc_id is kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.texts import groups, rows, saved
from tickloom.llm.tokens import BATCH_CHARS, Encoder

LENGTH = 2048
#: Lengths up to twice as many tokens have a class each; above, each doubling of the length has as many classes.
EXACT = 64
#: Relative gap to the linear program's optimum at which no more patterns are sought.
TOLERANCE = 2e-4
#: How far the priced dual values are drawn towards the best known ones.
PULL = 0.8


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: pieces of at most `length` tokens, end id included."""
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for columns, texts in groups(batches, most=BATCH_CHARS):
            ids, borders = encoder.encode(texts)
            raw, out = ids.astype("<u4", copy=False), []
            for doc_id, begin, end in zip(columns["doc_id"], borders[:-1].tolist(), borders[1:].tolist()):
                for at in range(begin, end, length):
                    stop = min(end, at + length)
                    out.append((doc_id, at - begin, stop - at, zlib.crc32(raw[at:stop]), end - begin))
            yield rows(schema, *zip(*out))
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(cut, ", ".join(f"{n} long" for n in names))


def steps(length: int, exact: int = EXACT) -> list[tuple[int, int, int]]:
    """(low, high, width): lengths in (low, high] are rounded up to low and a multiple of `width`, or to `high`."""
    found, low, width = [], 0, 1
    while low < length:
        high = min(2 * exact * width, length)
        found.append((low, high, width))
        low, width = high, 2 * width
    return found


def class_sizes(length: int, exact: int = EXACT) -> np.ndarray:
    """The largest length of each class, ascending."""
    return np.array([min(high, at + width) for low, high, width in steps(length, exact) for at in range(low, high, width)])


def class_of(size: Column, length: int, exact: int = EXACT) -> Column:
    """The class of a length, from 1: the place in `class_sizes` of the first that is no less."""
    found, number = F, 0
    for low, high, width in steps(length, exact):
        found = found.when(size <= high, F.ceil((size - low) / width) + number)
        number += -(-(high - low) // width)
    return found.cast("int")


def knapsack(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """For every space up to `room`: the best value, and the class to take first (-1: leave a unit free).

    Class i takes sizes[i] units, ascending, and may be taken again.
    """
    best, first = np.zeros(room + 1), np.full(room + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(room + 1), side="right").tolist()
    for space in range(1, room + 1):
        best[space] = best[space - 1]
        if fitting[space]:
            take = values[: fitting[space]] + best[space - sizes[: fitting[space]]]
            k = int(take.argmax())
            if take[k] > best[space] + 1e-12:
                best[space], first[space] = take[k], k
    return best, first


def pattern(first: np.ndarray, sizes: np.ndarray, room: int, start: int) -> np.ndarray:
    """Counts per class of the best pattern that has class `start`."""
    counts, space = np.zeros(len(sizes), np.int64), room - int(sizes[start])
    counts[start] = 1
    while space > 0:
        if first[space] < 0:
            space -= 1
        else:
            counts[first[space]] += 1
            space -= int(sizes[first[space]])
    return counts


def patterns(
    demand: np.ndarray, sizes: np.ndarray | None = None, tolerance: float = TOLERANCE, together: int = 32, report: dict | None = None
) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is cut, so that every class i meets its demand exactly.

    Class i takes sizes[i] units, i + 1 if not given; a sequence has as many units as the last class.
    First-fit gives the first columns. Each pricing offers the best pattern of each class; up to
    `together` of them enter the basis while they still improve it, until the dual values prove the total
    to be within `tolerance` of the linear program's optimum. `report` is given the number of pricings,
    the total and that bound.
    """
    sizes = np.arange(1, len(demand) + 1) if sizes is None else sizes
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    room, size = int(sizes[-1]), sizes[used]
    need = demand[used].astype(float)
    basis = [np.bincount([i], minlength=len(used)) * (room // s) for i, s in enumerate(size)]
    inverse = np.diag([1 / (room // s) for s in size])
    amount = inverse @ need
    columns = [p[used] for p, _ in first_fit(demand.astype(np.int64), sizes)]
    # sizes as shares of a sequence are dual values that no pattern exceeds; the search starts from them
    centre = size / room
    total, bound, idle, pricings, pull = np.inf, float(centre @ need), 0, 0, PULL
    # pivots that free no part of a sequence could go round in a circle; the basis is feasible at any time
    while idle < 2 * len(used):
        for column in columns:
            if inverse.sum(axis=0) @ column <= 1 + 1e-9:
                continue
            change = inverse @ column
            ratio = np.where(change > 1e-9, amount / np.maximum(change, 1e-9), np.inf)
            out = int(np.argmin(ratio))
            step = ratio[out]
            amount = np.maximum(amount - step * change, 0)
            amount[out] = step
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
            basis[out] = column
        idle = 0 if amount.sum() < total - 1e-9 else idle + 1
        total = min(total, amount.sum())
        duals = inverse.sum(axis=0)
        # prices of duals drawn towards the best ones so far swing less from round to round
        values = pull * centre + (1 - pull) * np.maximum(duals, 0)
        best, first = knapsack(values, size, room)
        pricings += 1
        # values divided by the best pattern's are feasible duals, so what they are worth bounds the optimum
        worth = float(values @ need) / max(1.0, float(best[room]))
        if worth > bound:
            bound, centre = worth, values / max(1.0, float(best[room]))
        if total <= bound * (1 + tolerance):
            break
        prices = values + best[room - size]
        found = [pattern(first, size, room, int(k)) for k in np.argsort(-prices, kind="stable")[:together]]
        columns = [c for c in found if duals @ c > 1 + 1e-9]
        pull = pull if columns else pull / 2 if pull > 0.01 else 0.0
        if not columns and not pull:
            break
    if report is not None:
        report |= {"pricings": pricings, "total": float(total), "bound": bound}
    found, left = [], demand.astype(np.int64).copy()
    whole = np.zeros((len(used), len(demand)), np.int64)
    whole[:, used] = basis
    counts = np.floor(amount + 1e-9).astype(np.int64)
    for column, times in zip(whole, counts.tolist()):
        times = min(times, int(np.min(left[column > 0] // column[column > 0])))
        if times:
            found.append((column, times))
            left -= times * column
    # of the broken parts, the largest first, those are cut once more that the rest still fills
    for k in np.argsort(counts - amount, kind="stable").tolist():
        if amount[k] - counts[k] > 0.5 and (left >= whole[k]).all():
            found.append((whole[k], 1))
            left -= whole[k]
    return found + first_fit(left, sizes)


def first_fit(left: np.ndarray, sizes: np.ndarray | None = None) -> list[tuple[np.ndarray, int]]:
    """Patterns for what rounding leaves over: repeatedly the largest classes that still fit."""
    sizes = np.arange(1, len(left) + 1) if sizes is None else sizes
    found, left = [], left.copy()
    while left.any():
        pattern, room = np.zeros(len(left), np.int64), int(sizes[-1])
        for k in np.flatnonzero(left)[::-1]:
            pattern[k] = min(left[k], room // sizes[k])
            room -= pattern[k] * sizes[k]
        times = int(np.min(left[pattern > 0] // pattern[pattern > 0]))
        found.append((pattern, times))
        left -= times * pattern
    return found


def ranked(items: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """`items` with `rank`, 0, 1, ... within each `class`; `sizes` has the number of items of each class.

    A large class is dealt to parts by a hash and numbered per part, from the counts of the parts before.
    """
    spark = items.sparkSession
    share = sum(sizes.values()) // (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    target = max(500, share)
    parts = F.element_at(F.array(*[F.lit(max(1, -(-sizes.get(c, 0) // target))) for c in range(1, max(sizes) + 1)]), F.col("class"))
    keys = ["doc_id", "start", "ids_crc32"]
    dealt = items.withColumn("part", F.pmod(F.xxhash64(*keys, F.col("salt")), parts))
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("class", "part").count()
    counts = counts.select("class", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("class", "part").orderBy(*keys, "salt")) - 1
    numbered = dealt.withColumn("number", number).join(counts, ["class", "part"])
    return numbered.withColumn("rank", F.col("before") + F.col("number")).drop("part", "number", "before")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, exact: int = EXACT) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: each piece and its place."""
    spark = docs.sparkSession
    room = class_sizes(length, exact)
    # `salt` spreads rows that are equal in all else
    cut = pieces(docs, tokenizer, length).withColumn("class", class_of(F.col("length"), length, exact))
    cut = saved(cut.withColumn("salt", F.monotonically_increasing_id()), "pieces")
    sizes = {r["class"]: r["count"] for r in cut.groupBy("class").count().collect()}
    if not sizes:
        return cut.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", *(F.lit(0).cast("long").alias(c) for c in ("sequence_id", "offset")))
    demand = np.zeros(len(room), np.int64)
    for c, n in sizes.items():
        demand[c - 1] = n
    places, taken, sequences = [], np.zeros(len(room), np.int64), 0
    for pattern, times in patterns(demand, room):
        for k in np.flatnonzero(pattern).tolist():
            low, each = int(taken[k]), int(pattern[k])
            places.append((k + 1, low, low + times * each, each, sequences))
            taken[k] += times * each
        sequences += times
    form = "class int, low long, high long, each long, first long"
    # one row per class of each pattern: bounded by the classes, not by the documents
    where = F.broadcast(spark.createDataFrame(places, form))
    inside = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    here = ranked(cut, sizes).alias("p").join(where.alias("w"), (F.col("p.class") == F.col("w.class")) & inside)
    sequence = F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))
    here = here.select("p.*", sequence.alias("sequence_id"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    return here.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset)
