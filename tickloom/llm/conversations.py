"""Repair of conversation structure by a shortest path over scalar big integers.

A conversation's turns are edited until their role initials read `(s?(ua)+)?`. Keep costs 0, Rerole (to
user or assistant) 2, Delete 3, Insert (an empty user or assistant turn) 2; a truncated turn that is
not deleted adds 1, blank and duplicate turns have to be deleted. Of the cheapest edits those count
whose initials in order, the audit, are least in ASCII order.

One integer says both: the high digits are the cost, the low digits, base 8 and of a fixed number, are
the audit's letters from the left (D 1, I 2, K 3, R 4), with zeros behind its end. A node of the graph
is (turns consumed, inserts made just now, what the roles so far ask for); an edge adds its cost and its
letter's digit at the place that follows; a node keeps the least integer. That is right because two
audits that lead to one node at one cost are never a prefix of each other: they consume the same turns,
so the longer one would have inserts behind, and cost more.

Conversations of any length: turns are sorted by ranges of (conv_id, turn), so one conversation spreads
over tasks. Each stretch of SEGMENT turns of one conversation yields the shortest paths from each of the
four states to each, found per BLOCK turns (equal blocks of a task once) and put together by the same
integers. Stretches are put together per conversation, and its texts pass by as a stream: an order-bound
digest of a whole conversation cannot be had otherwise, and only one turn is held at a time.

Cases: a null role or text counts as one space, so it is no role and a blank turn; turns of a
conversation are taken by turn (nulls first), then role and text; turns equal in all three are
neighbours and all but the first are duplicates; null conv_id is a conversation of its own; an initial
other than s, u, a cannot be kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.texts import free_name, rows, saved

#: Turns whose paths are found in one go, and places of one stretch, a power of two.
BLOCK, SEGMENT = 64, 4096
SPACES = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED_COSTS = 1
LETTERS = "DIKR"
DIGITS = str.maketrans(LETTERS, "1234")
NAMES = str.maketrans("1234", LETTERS)
# What the roles so far ask for: nothing yet, a user after system, an assistant, a user or the end.
START, SYSTEM, USER, DONE = range(4)
STATES = range(4)
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (DONE, "u"): USER, (USER, "a"): DONE}
ROLES = {"u": "user", "a": "assistant"}
# Faults of a turn.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = ("su", "ua", "au")

#: A path's cost and audit.
Path = tuple[int, str]


def wanted(state: int) -> str:
    """The one role that an inserted or reroled turn can have."""
    return "a" if state == USER else "u"


def inserted(nodes: dict[int, tuple[int, int]], width: int) -> dict[int, tuple[int, int]]:
    """The nodes after no, one or two inserts; a third would lead round in a circle."""
    best, layer = dict(nodes), nodes
    for _ in range(2):
        step: dict[int, tuple[int, int]] = {}
        for state, (value, length) in layer.items():
            reach(step, FOLLOWS[state, wanted(state)], value + edge(INSERT, "I", length, width), length + 1)
        for state, node in step.items():
            reach(best, state, *node)
        layer = step
    return best


def reach(nodes: dict, key, value: int, length: int) -> None:
    """A node keeps the least value that comes to it."""
    if key not in nodes or value < nodes[key][0]:
        nodes[key] = value, length


def edge(cost: int, letter: str, length: int, width: int) -> int:
    """What one edit adds to a path of `length` letters."""
    return (cost << 3 * width) + (LETTERS.index(letter) + 1 << 3 * (width - length - 1))


def scalar(path: Path, width: int) -> int:
    cost, audit = path
    return (cost << 3 * width) + (int(audit.translate(DIGITS) or "0", 8) << 3 * (width - len(audit)))


def path_of(value: int, length: int, width: int) -> Path:
    digits = (value >> 3 * (width - length)) & ((1 << 3 * length) - 1)
    return value >> 3 * width, oct(digits)[2:].translate(NAMES) if length else ""


@lru_cache(maxsize=4096)
def block_paths(turns: str) -> dict[tuple[int, int], Path]:
    """(state before, state after) -> path, for turns given as initial and fault, two characters each."""
    width, found = 3 * (len(turns) // 2), {}
    for begin in STATES:
        nodes = {begin: (0, 0)}
        for k in range(0, len(turns), 2):
            initial, fault, after = turns[k], int(turns[k + 1]), {}
            more = TRUNCATED_COSTS if fault == TRUNCATED else 0
            for state, (value, length) in inserted(nodes, width).items():
                reach(after, state, value + edge(DELETE, "D", length, width), length + 1)
                if fault in (BLANK, DUPLICATE):
                    continue
                if (state, initial) in FOLLOWS:
                    reach(after, FOLLOWS[state, initial], value + edge(KEEP + more, "K", length, width), length + 1)
                reach(after, FOLLOWS[state, wanted(state)], value + edge(REROLE + more, "R", length, width), length + 1)
            nodes = after
        found |= {(begin, end): path_of(value, length, width) for end, (value, length) in nodes.items()}
    return found


def joined(first: dict[tuple[int, int], Path], second: dict[tuple[int, int], Path]) -> dict[tuple[int, int], Path]:
    """The paths through two stretches, one after the other."""
    width = max(len(a) for _, a in first.values()) + max(len(a) for _, a in second.values())
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for (begin, middle), head in first.items():
        for (again, end), tail in second.items():
            if again == middle:
                path = head[0] + tail[0], head[1] + tail[1]
                reach(best, (begin, end), scalar(path, width), len(path[1]))
    return {k: path_of(value, length, width) for k, (value, length) in best.items()}


def finished(paths: dict[tuple[int, int], Path]) -> Path:
    """The best path of a whole conversation, with what has to be inserted at its end."""
    own = {end: path for (begin, end), path in paths.items() if begin == START}
    width = max(len(a) for _, a in own.values()) + 2
    nodes = inserted({end: (scalar(path, width), len(path[1])) for end, path in own.items()}, width)
    return path_of(*min(nodes[s] for s in (START, DONE) if s in nodes), width)


def shortest(turns: str, block: int = BLOCK) -> dict[tuple[int, int], Path]:
    found = block_paths(turns[: 2 * block])
    for at in range(2 * block, len(turns), 2 * block):
        found = joined(found, block_paths(turns[at : at + 2 * block]))
    return found


def identity(conv_id: Column) -> Column:
    """A text that tells conversations apart; null is one of them."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def ordered(turns: DataFrame) -> DataFrame:
    """conv, conv_id, turn, role, text, place: a number that counts along conv_id, turn, role and text."""
    filled = turns.select(
        identity(F.col("conv_id")).alias("conv"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = filled.repartitionByRange(parts, "conv", "turn", "role").sortWithinPartitions("conv", "turn", "role", "text")
    return saved(dealt.withColumn("place", F.monotonically_increasing_id()), "turns")


def with_faults(turns: DataFrame) -> DataFrame:
    """conv, place, initial, fault of ordered turns, without their texts."""
    bare = F.rtrim("text", F.lit(SPACES))
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    marked = turns.select(
        "conv", "place", F.substring("role", 1, 1).alias("initial"), digest.alias("digest"),
        (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    # one row per text and task crosses the shuffle; Spark splits the join where one text has many turns
    first = marked.groupBy("conv", "digest").agg(F.min("place").alias("first"), F.count("*").alias("times")).where("times > 1")
    found = marked.join(first.select("conv", "digest", "first"), ["conv", "digest"], "left")
    again = F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("truncated"), TRUNCATED).otherwise(SOUND)
    return found.select("conv", "place", "initial", fault.alias("fault"))


_STRETCH = "segment long, blank long, duplicate long, truncated long, illegal long, first string, last string, ends array<int>, costs array<long>, audits array<string>"
_STRETCH_SCHEMA = pa.schema(
    [("conv", pa.string()), *((n, pa.int64()) for n in ("segment", "blank", "duplicate", "truncated", "illegal")), ("first", pa.string()),
     ("last", pa.string()), ("ends", pa.list_(pa.int32())), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
)


def stretches(faults: DataFrame) -> DataFrame:
    """Per conversation and SEGMENT places: counts, outer initials and paths (`ends`: 4 * state before + state after)."""

    def summary(conv: str, segment: int, initials: list[str], codes: list[int]) -> tuple:
        paths = shortest("".join(f"{i or ' '}{c}" for i, c in zip(initials, codes)))
        counts = [codes.count(c) for c in (BLANK, DUPLICATE, TRUNCATED)]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        kept = sorted((4 * a + b, p) for (a, b), p in paths.items())
        return conv, segment, *counts, illegal, initials[0], initials[-1], [k for k, _ in kept], [p[0] for _, p in kept], [p[1] for _, p in kept]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, initials, codes = None, [], []
        for batch in batches:
            out = []
            for conv, segment, initial, fault in zip(*(batch[n].to_pylist() for n in ("conv", "segment", "initial", "fault"))):
                if (conv, segment) != at:
                    if at is not None:
                        out.append(summary(*at, initials, codes))
                    at, initials, codes = (conv, segment), [], []
                initials.append(initial)
                codes.append(fault)
            if out:
                yield rows(_STRETCH_SCHEMA, *zip(*out))
        if at is not None:
            yield rows(_STRETCH_SCHEMA, *([x] for x in summary(*at, initials, codes)))

    parts = int(faults.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = faults.withColumn("segment", F.shiftright("place", SEGMENT.bit_length() - 1)).repartition(parts, "conv", "segment")
    return dealt.sortWithinPartitions("conv", "place").mapInArrow(each, f"conv string, {_STRETCH}")


class _Conversation:
    """What is known of the conversation that streams by."""

    def __init__(self, conv_id: int | None, gaps: int):
        self.conv_id, self.gaps, self.counts, self.illegal = conv_id, gaps, [0, 0, 0], 0
        self.last: str | None = None
        self.paths: dict[tuple[int, int], Path] = {}
        self.cost, self.audit, self.at, self.state, self.place = 0, "", 0, START, 0
        self.digest = hashlib.sha256()

    def add(self, counts: list[int], illegal: int, first: str, last: str, paths: dict[tuple[int, int], Path]) -> None:
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        self.illegal += illegal + (self.last is not None and self.last + first not in LEGAL)
        self.last = last
        if not self.paths:  # a conversation begins with nothing
            self.paths = {k: p for k, p in paths.items() if k[0] == START}
        else:
            self.paths = joined(self.paths, paths)

    def finish(self) -> None:
        if self.paths:
            (self.cost, self.audit), self.paths = finished(self.paths), {}

    def _put(self, letter: str, role: str, text: str) -> tuple:
        self.digest.update((f"\n{role}:{text}" if self.place else f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.place += 1
        return self.conv_id, self.place - 1, letter, role, text

    def inserts(self) -> Iterator[tuple]:
        """The turns that are inserted here."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role = wanted(self.state)
            self.state = FOLLOWS[self.state, role]
            self.at += 1
            yield self._put("I", ROLES[role], "")

    def take(self, role: str, text: str) -> Iterator[tuple]:
        """Edit the next turn: (conv_id, place, edit, role, text) of what stands there after."""
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            initial = role[:1] if letter == "K" else wanted(self.state)
            self.state = FOLLOWS[self.state, initial]
            yield self._put(letter, role if letter == "K" else ROLES[initial], text)


REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, edit string, role string, text string"


@cache
def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (field.split() for field in ddl.split(", "))])


def _streamed(turns: DataFrame, form: str, of_turn: Callable, of_end: Callable) -> DataFrame:
    """Rows made of each edited turn and at each conversation's end."""
    placed = ordered(turns)
    spans = placed.groupBy("conv", "conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv", "conv_id")
    spans = spans.agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("different"))
    kinds = (
        spans.withColumn("kind", F.lit(0)),
        stretches(with_faults(placed)).withColumn("kind", F.lit(1)).withColumnRenamed("segment", "place"),
        placed.select("conv", "place", "role", "text").withColumn("kind", F.lit(2)),
    )
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = kinds[0].unionByName(kinds[1], allowMissingColumns=True).unionByName(kinds[2], allowMissingColumns=True)
    dealt = both.repartition(parts, "conv").sortWithinPartitions("conv", "kind", "place")
    names = (
        "kind", "conv_id", "low", "high", "different", "blank", "duplicate", "truncated", "illegal", "first", "last", "ends", "costs",
        "audits", "role", "text",
    )
    schema = _schema(form)

    def end(here: _Conversation) -> Iterator[tuple]:
        here.finish()  # a conversation without a turn has no path
        yield from (x for turn in here.inserts() for x in of_turn(turn))
        yield from of_end(here)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: _Conversation | None = None
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch[n].to_pylist() for n in names)):
                kind = row[0]
                if kind == 0:
                    if here is not None:
                        out += end(here)
                    _, conv_id, low, high, different = row[:5]
                    here = _Conversation(conv_id, min(high - low + 1 - different, 2**63 - 1) if different else 0)
                elif kind == 1:
                    paths = {divmod(k, 4): (c, a) for k, c, a in zip(row[11], row[12], row[13])}
                    here.add(row[5:8], *row[8:11], paths)
                else:
                    here.finish()
                    out += (x for turn in here.take(row[14], row[15]) for x in of_turn(turn))
            if out:
                yield rows(schema, *zip(*out))
        if here is not None and (out := list(end(here))):
            yield rows(schema, *zip(*out))

    return dealt.mapInArrow(each, form)


def repair(turns: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, cost, audit and the digest of the repaired turns."""

    def of_end(here: _Conversation) -> Iterator[tuple]:
        yield here.conv_id, here.gaps, *here.counts, here.illegal, here.cost, here.audit, here.digest.hexdigest()

    return _streamed(turns, REPAIRED, lambda turn: (), of_end)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text: the turns of the repaired conversations in order."""
    return _streamed(turns, TURNS, lambda turn: (turn,), lambda here: ())


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after faults set by crc32 of `conv_id:turn` modulo 20; nulls count as one space.

    0 drops the turn, 1 empties its text, 2 removes its marks of sentence ends, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, role, text = F.col("damage"), F.coalesce("role", space), F.coalesce("text", space)
    hit = turns.select("conv_id", "turn", "role", "text").withColumn("damage", F.crc32(key.cast("binary")) % 20).where(kind != 0)
    changed = hit.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return changed.drop("copy")


def repaired_after_damage(turns: DataFrame) -> DataFrame:
    """`repair` of the damaged turns, with a row for each conversation, also for one that lost all turns."""
    found = repair(damaged(turns))
    every = turns.select("conv_id").distinct()
    name = free_name(found, "original")
    joined_ = every.withColumnRenamed("conv_id", name).join(found, F.col(name).eqNullSafe(F.col("conv_id")), "left")
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return joined_.select(
        F.col(name).alias("conv_id"),
        *[F.coalesce(F.col(n), empty.get(n, F.lit(0).cast("long"))).alias(n) for n in found.columns if n != "conv_id"],
    )
