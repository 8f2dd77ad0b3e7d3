"""Ordered scans for few keys with long histories.

`Window.partitionBy("benchmark")` puts a whole history into one task, and one benchmark may
hold a third of all rows. Here the order itself is cut into chunks of a fixed number of rows:

* `with_chunk` sorts the rows by ranges, numbers them and writes them once; a chunk is a stretch of
  those numbers, so no border is kept anywhere, on the driver or in the plan;
* `with_halo` gives each (key, chunk) the last rows before it, for lag and row frames;
* `running` gives each (key, chunk) the totals before it, for running sums, maxima and last values.

An ordinary window over (key, chunk) does the rest, so no task holds more than one chunk's rows.
What crosses chunk borders is scanned on two levels: chunks inside blocks of 1,024, then blocks, whose
totals are added back. A task sees a block's chunks of a key, or a key's blocks, never all its chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.columns import order_key
from tickloom.session import scratch_path

CHUNK = "chunk"
HALO = "halo"
EVENT_ORDER = ("time", "event_id")
ARRIVAL_ORDER = ("arrival_us", "event_id")
#: Rows of a chunk, a power of two.
CHUNK_ROWS = 1 << 18
#: Chunk numbers that share a block: 2 to this power.
BLOCK_BITS = 10
HISTORY_CHUNK = -1
_BLOCK = "_block"


def with_chunk(df: DataFrame, order_by: Sequence[str] = EVENT_ORDER, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """`df`, written once in order, with column `chunk`; a later chunk holds only later rows of the order.

    Spark deals the rows to ranges of the whole order, so a crowded moment is split like any other; a
    range begins a chunk. Rows without a position come first. The table stays in the shared scratch
    folder, so all that reads it sees the same chunks, also after a lost executor.
    """
    spark = df.sparkSession
    if chunk_rows & (chunk_rows - 1):
        raise ValueError("a chunk has a power of two rows")
    # a row's number: its task in the high bits, its place there in the low 33
    placed = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn(CHUNK, F.monotonically_increasing_id())
    path = scratch_path(spark, "ordered")
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    return stored.withColumn(CHUNK, F.shiftright(CHUNK, chunk_rows.bit_length() - 1))


def scan(by: Sequence[str], order_by: Sequence[str] = EVENT_ORDER, reverse: bool = False) -> WindowSpec:
    """The window inside one (key, chunk)."""
    order = [F.col(c).desc() if reverse else F.col(c).asc() for c in order_by]
    return Window.partitionBy(*by, CHUNK).orderBy(*order)


def with_halo(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    rows: int,
    columns: Sequence[str],
    reverse: bool = False,
) -> DataFrame:
    """Add to each (key, chunk) the `rows` rows before it, flagged `halo`; drop them after the window.

    The edge of a chunk is a top-k that Spark applies per input partition before the shuffle.
    An edge can be shorter than `rows`, so up to `rows` earlier edges are joined end to end.
    `reverse` scans from late to early, for lead.
    """
    keys = [*by, CHUNK]
    kept = list(dict.fromkeys([*keys, *order_by, *columns]))
    inner = [c for c in kept if c not in keys]
    nearest = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() if reverse else F.col(c).desc() for c in order_by])
    edges = (
        df.select(*kept)
        .withColumn("_rank", F.row_number().over(nearest))
        .where(F.col("_rank") <= rows)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct(F.negative("_rank").alias("_rank"), *inner))).alias("_edge"))
    )
    seen = _edges_before(edges, by, rows, reverse)
    halo = seen.withColumn("_row", F.explode("_seen")).select(*keys, *[F.col("_row")[c].alias(c) for c in inner])
    return df.withColumn(HALO, F.lit(False)).unionByName(halo.withColumn(HALO, F.lit(True)), allowMissingColumns=True)


def _last(rows: Column, count: int) -> Column:
    """The last `count` elements of an array."""
    return F.slice(rows, F.greatest(F.size(rows) - (count - 1), F.lit(1)), count)


def _edges_before(edges: DataFrame, by: Sequence[str], rows: int, reverse: bool) -> DataFrame:
    """by, chunk, `_seen`: the last `rows` rows of all edges before each chunk, found per block and over blocks."""

    def signed(column: str | Column) -> Column:
        return F.negative(column) if reverse else F.col(column) if isinstance(column, str) else column

    def flat(part: Column) -> Column:
        return F.flatten(F.transform(part, lambda e: e["_edge"]))

    # a block's edges are one row: 1,024 of them at most, of `rows` rows each
    ends = F.sort_array(F.collect_list(F.struct(signed(CHUNK).alias("at"), "_edge")))
    blocks = edges.groupBy(*by, F.shiftright(CHUNK, BLOCK_BITS).alias(_BLOCK)).agg(ends.alias("_ends"))
    # an edge has a row at least, so `rows` edges, or blocks, before are enough
    before = Window.partitionBy(*by).orderBy(signed(_BLOCK)).rowsBetween(-rows, -1)
    carried = blocks.withColumn("_end", _last(flat(_last(F.col("_ends"), rows)), rows)).withColumn(
        "_carry", _last(F.flatten(F.collect_list("_end").over(before)), rows)
    )

    def seen(e: Column, i: Column) -> Column:
        own = F.slice("_ends", F.greatest(i - (rows - 1), F.lit(1)), F.least(i, F.lit(rows)))
        return F.struct(e["at"].alias("at"), _last(F.concat("_carry", flat(own)), rows).alias("seen"))

    each = carried.select(*by, F.explode(F.transform("_ends", seen)).alias("_e"))
    return each.select(*by, signed(F.col("_e.at")).alias(CHUNK), F.col("_e.seen").alias("_seen"))


def running(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    initial: DataFrame | None = None,
    summarize: DataFrame | None = None,
) -> DataFrame:
    """Running sums, maxima and last non-null values from the start of the order up to each row.

    `initial` holds totals from before the first row, one row per key with the output columns.
    `summarize` is a cheaper frame with the same rows, when `df` already went through other scans.
    """
    sums, maxes, lasts = sums or {}, maxes or {}, lasts or {}
    keys = [*by, CHUNK]
    key = order_key(order_by)
    totals = [F.sum(c).alias(n) for n, c in sums.items()]
    totals += [F.max(c).alias(n) for n, c in maxes.items()]
    totals += [F.max_by(c, F.when(c.isNotNull(), key)).alias(n) for n, c in lasts.items()]
    summary = (df if summarize is None else summarize).groupBy(*keys).agg(*totals)
    if initial is not None:
        summary = summary.unionByName(initial.withColumn(CHUNK, F.lit(HISTORY_CHUNK).cast("long")))
    carry = _totals_before(summary, by, sums, maxes, lasts)
    here = scan(by, order_by).rowsBetween(Window.unboundedPreceding, 0)
    joined = df.join(carry.hint("shuffle_hash"), keys)
    zero = F.lit(0.0)
    return joined.withColumns(
        {
            **{n: F.coalesce(F.col(f"_{n}"), zero) + F.coalesce(F.sum(c).over(here), zero) for n, c in sums.items()},
            **{n: F.greatest(F.col(f"_{n}"), F.max(c).over(here)) for n, c in maxes.items()},
            **{n: F.coalesce(F.last(c, ignorenulls=True).over(here), F.col(f"_{n}")) for n, c in lasts.items()},
        }
    ).drop(*[f"_{n}" for n in [*sums, *maxes, *lasts]])


def _totals_before(summary: DataFrame, by: Sequence[str], sums=(), maxes=(), lasts=()) -> DataFrame:
    """Per (key, chunk) and column n of the summary, `_n`: what all chunks before have, per block and over blocks."""
    blocked = summary.withColumn(_BLOCK, F.shiftright(CHUNK, BLOCK_BITS))
    blocks = blocked.groupBy(*by, _BLOCK).agg(
        *[F.sum(n).alias(n) for n in sums],
        *[F.max(n).alias(n) for n in maxes],
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col(CHUNK))).alias(n) for n in lasts],
    )

    def before(keys: list[str], order: str, name: str) -> list[Column]:
        spec = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return [
            *[F.sum(n).over(spec).alias(f"{name}{n}") for n in sums],
            *[F.max(n).over(spec).alias(f"{name}{n}") for n in maxes],
            *[F.last(n, ignorenulls=True).over(spec).alias(f"{name}{n}") for n in lasts],
        ]

    inside = blocked.select(*by, CHUNK, _BLOCK, *before([*by, _BLOCK], CHUNK, "_in_"))
    outside = blocks.select(*by, _BLOCK, *before([*by], _BLOCK, "_out_"))
    own, other = lambda n: F.col(f"_in_{n}"), lambda n: F.col(f"_out_{n}")
    return inside.join(outside, [*by, _BLOCK]).select(
        *by,
        CHUNK,
        *[F.coalesce(own(n) + other(n), own(n), other(n)).alias(f"_{n}") for n in sums],
        *[F.greatest(own(n), other(n)).alias(f"_{n}") for n in maxes],
        *[F.coalesce(own(n), other(n)).alias(f"_{n}") for n in lasts],
    )


def with_sequence(
    df: DataFrame, order_by: Sequence[str] = EVENT_ORDER, name: str = "seq", summarize: DataFrame | None = None
) -> DataFrame:
    """Number all rows of a chunked frame from 0 along the order, across keys."""
    counted = (df if summarize is None else summarize).groupBy(CHUNK).agg(F.count("*").alias("rows"))
    carry = _totals_before(counted, [], ["rows"])
    numbered = df.join(carry.hint("shuffle_hash"), CHUNK)
    position = F.row_number().over(scan([], order_by)) - 1
    return numbered.withColumn(name, F.coalesce("_rows", F.lit(0)) + position).drop("_rows")
