"""Chunked scans against brute force in plain Python, for any chunks."""

import random
from datetime import timedelta
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tests.conftest import START
from tickloom.operators import ordered
from tickloom.operators.ordered import CHUNK, EVENT_ORDER, HALO, scan

KEY = ["benchmark"]


def history(rows: int, crowded: int, seed: int = 7):
    """Ticks of three keys, one of them rare; `crowded` of them share one microsecond."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        at = 500.0 if i < crowded else rng.uniform(0, 1000)
        key = rng.choices(["A", "B", "C"], [60, 39, 1])[0]
        out.append((i, START + timedelta(seconds=round(at, 3)), key, float(rng.randint(1, 99))))
    return out


def frame(spark, rows):
    rows = rows[:]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "event_id long, time timestamp_ntz, benchmark string, price double")


def by_key(rows):
    ordered_rows = sorted(rows, key=lambda r: (r[1], r[0]))
    return {k: [r for r in ordered_rows if r[2] == k] for k in {r[2] for r in rows}}


CASES = [(400, 0, 512), (400, 0, 2), (400, 150, 32)]


@pytest.fixture(autouse=True, params=[1, 10])
def blocks(request, monkeypatch):
    """Blocks of two chunks as well, so that rows come over several."""
    monkeypatch.setattr(ordered, "BLOCK_BITS", request.param)


@pytest.mark.parametrize("rows,crowded,size", CASES)
def test_chunks_keep_the_order_and_their_size(spark, rows, crowded, size):
    data = history(rows, crowded)
    found = ordered.with_chunk(frame(spark, data), chunk_rows=size).collect()
    assert len(found) == rows
    placed = sorted(found, key=lambda r: (r["time"], r["event_id"]))
    numbers = [r[CHUNK] for r in placed]
    assert numbers == sorted(numbers)
    assert max(numbers.count(n) for n in set(numbers)) <= size


@pytest.mark.parametrize("rows,crowded,size", CASES)
@pytest.mark.parametrize("width", [1, 30])
@pytest.mark.parametrize("reverse", [False, True])
def test_halo_gives_the_rows_before(spark, rows, crowded, size, width, reverse):
    data = history(rows, crowded)
    chunked = ordered.with_chunk(frame(spark, data), chunk_rows=size)
    haloed = ordered.with_halo(chunked, KEY, EVENT_ORDER, width, ["price"], reverse)
    seen = F.collect_list("price").over(scan(KEY, EVENT_ORDER, reverse).rowsBetween(-width, 0))
    found = {r["event_id"]: r["seen"] for r in haloed.withColumn("seen", seen).where(~F.col(HALO)).collect()}
    want = {}
    for group in by_key(data).values():
        group = group[::-1] if reverse else group
        for i, row in enumerate(group):
            want[row[0]] = [r[3] for r in group[max(0, i - width) : i + 1]]
    assert found == want


@pytest.mark.parametrize("rows,crowded,size", CASES)
def test_running_totals(spark, rows, crowded, size):
    data = history(rows, crowded)
    chunked = ordered.with_chunk(frame(spark, data), chunk_rows=size)
    even = F.when(F.col("event_id") % 5 == 0, F.col("price"))
    out = ordered.running(
        chunked, KEY, EVENT_ORDER, sums={"total": F.col("price")}, maxes={"top": F.col("price")}, lasts={"last": even}
    )
    found = {r["event_id"]: (r["total"], r["top"], r["last"]) for r in out.collect()}
    want = {}
    for group in by_key(data).values():
        totals = accumulate(r[3] for r in group)
        tops = accumulate((r[3] for r in group), max)
        last = None
        for row, total, top in zip(group, totals, tops):
            last = row[3] if row[0] % 5 == 0 else last
            want[row[0]] = (total, top, last)
    assert found == want


@pytest.mark.parametrize("rows,crowded,size", CASES)
def test_sequence_counts_over_all_keys(spark, rows, crowded, size):
    data = history(rows, crowded)
    out = ordered.with_sequence(ordered.with_chunk(frame(spark, data), chunk_rows=size))
    found = {r["event_id"]: r["seq"] for r in out.collect()}
    assert found == {r[0]: i for i, r in enumerate(sorted(data, key=lambda r: (r[1], r[0])))}


def test_empty_input(spark):
    empty = frame(spark, history(5, 0)).where("event_id < 0")
    assert ordered.with_chunk(empty).count() == 0


def test_a_row_without_position_comes_first(spark):
    data = [(1, None, "A", 1.0), (0, START, "A", 2.0), (2, START + timedelta(seconds=1), "A", 3.0)]
    out = ordered.running(ordered.with_chunk(frame(spark, data), chunk_rows=1), KEY, EVENT_ORDER, sums={"total": F.col("price")})
    assert {r["event_id"]: r["total"] for r in out.collect()} == {1: 1.0, 0: 3.0, 2: 6.0}


def test_ten_thousand_chunks(spark, monkeypatch):
    """The plan has the same size whatever the number of chunks, and no group grows with it."""
    monkeypatch.setattr(ordered, "BLOCK_BITS", 7)
    rows = 40_000
    ticks = spark.range(rows).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 7919) AS time",
        "IF(id % 100 < 98, 'A', 'B') AS benchmark", "CAST(id % 97 AS DOUBLE) AS price",
    )
    plans, found = {}, {}
    for size in (4, 1 << 18):
        chunked = ordered.with_chunk(ticks, chunk_rows=size)
        out = ordered.running(chunked, KEY, EVENT_ORDER, sums={"total": F.col("price")}, lasts={"last": F.col("price")})
        haloed = ordered.with_halo(out, KEY, EVENT_ORDER, 5, ["price"])
        back = haloed.withColumn("back", F.lag("price", 5).over(scan(KEY))).where(~F.col(HALO))
        plans[size] = out._jdf.queryExecution().optimizedPlan().toString()
        found[size] = back.selectExpr("count(*)", "sum(total)", "sum(hash(event_id, total, last, back))").first()
        if size == 4:
            numbers = chunked.groupBy("benchmark", CHUNK).count().withColumn("block", F.shiftright(CHUNK, ordered.BLOCK_BITS))
            assert numbers.where("benchmark = 'A'").count() >= 10_000
            per_block = numbers.groupBy("benchmark", "block").count()
            assert per_block.agg(F.max("count")).first()[0] <= 1 << ordered.BLOCK_BITS
            # what a key's last step sees: its blocks
            assert per_block.groupBy("benchmark").count().agg(F.max("count")).first()[0] <= 100
    assert found[4] == found[1 << 18]
    assert abs(len(plans[4]) - len(plans[1 << 18])) < 200


def test_hot_key_is_split(spark):
    """A key with nearly all rows is spread over many groups."""
    data = [(i, START + timedelta(seconds=i), "A" if i % 50 else "B", 1.0) for i in range(1000)]
    groups = ordered.with_chunk(frame(spark, data), chunk_rows=64).groupBy("benchmark", CHUNK).count()
    assert groups.agg(F.max("count")).first()[0] <= 64
