"""Conversation repair against all edits of short conversations, and awkward rows."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tickloom.llm import conversations as conv
from tickloom.llm import queries

SMALL = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    found = []
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return found


def faults(turns):
    seen, found = set(), []
    for role, text in turns:
        marks = SPACE.findall(text)
        kind = conv.BLANK if not marks else conv.DUPLICATE if (role, text) in seen else conv.SOUND if marks[-1] in ".!?" else conv.TRUNCATED
        seen.add((role, text))
        found.append(kind)
    return found


def all_edits(turns, kinds):
    """(cost, audit, repaired turns) of every way with at most two inserts in a row."""

    def go(k, so_far, room):
        if k == len(turns):
            yield so_far
        if room:
            for role in ("user", "assistant"):
                yield from go(k, (so_far[0] + 2, so_far[1] + "I", (*so_far[2], (role, ""))), room - 1)
        if k < len(turns):
            more = kinds[k] == conv.TRUNCATED
            yield from go(k + 1, (so_far[0] + 3, so_far[1] + "D", so_far[2]), 2)
            if kinds[k] not in (conv.BLANK, conv.DUPLICATE):
                yield from go(k + 1, (so_far[0] + more, so_far[1] + "K", (*so_far[2], turns[k])), 2)
                for role in ("user", "assistant"):
                    yield from go(k + 1, (so_far[0] + 2 + more, so_far[1] + "R", (*so_far[2], (role, turns[k][1]))), 2)

    return go(0, (0, "", ()), 2)


def least(turns, kinds):
    fits = (e for e in all_edits(turns, kinds) if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in e[2])))
    return min(fits, key=lambda e: e[:2])


def cheapest(turns, kinds):
    """The same for long conversations: least (cost, audit) per state, turn by turn, over plain strings."""
    ways = {0: (0, "", ())}

    def put(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def inserts(ways):
        best, layer = dict(ways), ways
        for _ in range(2):
            step = {}
            for s, (c, a, t) in layer.items():
                role = "assistant" if s == 2 else "user"
                put(step, 3 if s == 2 else 2, (c + 2, a + "I", (*t, (role, ""))))
            for s, way in step.items():
                put(best, s, way)
            layer = step
        return best

    for (role, text), kind in zip(turns, kinds):
        after = {}
        for s, (c, a, t) in inserts(ways).items():
            put(after, s, (c + 3, a + "D", t))
            if kind in (conv.BLANK, conv.DUPLICATE):
                continue
            more, initial = kind == conv.TRUNCATED, role[:1]
            to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
            if (initial, s) in to:
                put(after, to[initial, s], (c + more, a + "K", (*t, (role, text))))
            put(after, 3 if s == 2 else 2, (c + 2 + more, a + "R", (*t, ("assistant" if s == 2 else "user", text))))
        ways = after
    ways = inserts(ways)
    return min((ways[s] for s in (0, 3) if s in ways), key=lambda e: e[:2])


def expected(rows, best):
    """conv_id -> the contract's columns, by definition."""
    groups = defaultdict(list)
    for r in damaged(rows):
        groups[r[0]].append(r[1:])
    want = {}
    for conv_id in {r[0] for r in rows}:
        found = sorted(groups[conv_id], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns, numbers = [r[1:] for r in found], [r[0] for r in found if r[0] is not None]
        kinds = faults(turns)
        cost, audit, repaired = best(turns, kinds) if turns else (0, "", ())
        initials = [r[:1] for r, _ in turns]
        want[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(kinds.count(k) for k in (conv.BLANK, conv.DUPLICATE, conv.TRUNCATED)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        )
    return want


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
FORM = "conv_id long, turn long, role string, text string, place long, kind int, audit string"


def got(df):
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in df.collect()}


def test_paths_are_the_least_of_all_edits():
    texts = {conv.SOUND: "x.", conv.TRUNCATED: "x", conv.BLANK: " ", conv.DUPLICATE: "x."}
    for n in range(5):
        for initials in itertools.product("sua", repeat=n):
            for kinds in itertools.product(range(4), repeat=n) if n < 3 else [tuple(np.random.default_rng(len(initials)).integers(0, 4, n))]:
                turns = [({"s": "system", "u": "user", "a": "assistant"}[i], texts[k]) for i, k in zip(initials, kinds)]
                path = conv.finished(conv.shortest("".join(f"{i}{k}" for i, k in zip(initials, kinds)), 2)) if n else (0, "")
                assert path == least(turns, kinds)[:2] == cheapest(turns, kinds)[:2], turns


def test_blocks_do_not_change_the_path():
    rng = np.random.default_rng(1)
    turns = "".join(f"{i}{k}" for i, k in zip(rng.choice(list("suax "), 700), rng.integers(0, 4, 700)))
    assert conv.finished(conv.shortest(turns)) == conv.finished(conv.shortest(turns, 7)) == conv.finished(conv.shortest(turns, 350))


def test_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op13_conversations"](spark, SMALL)) == expected(rows, cheapest)


@pytest.fixture(scope="module")
def odd(spark):
    rng, rows = np.random.default_rng(2), []
    roles, texts = ["system", "user", "assistant", None, "", "unknown", "User"], ["Yes.", "No", None, "", " \t\n", "Why?\n", "\u00a0", "x" * 50_000 + "!"]
    for k in range(300):
        turn = None if k % 50 == 0 else int(rng.integers(0, 6))
        rows.append((int(k % 40) if k % 7 else None, turn, roles[rng.integers(0, 7)], texts[rng.integers(0, 8)]))
    rows += [rows[5], rows[5], rows[0]]
    # one conversation that spreads over tasks and stretches
    rows += [(77, k, ("user", "assistant")[(k + k // 37) % 2], f"Turn {k % 911}" + ".!? "[k % 4]) for k in range(9000)]
    return rows


def test_awkward_rows(spark, odd):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in odd], FORM)
    found = got(conv.repaired_after_damage(df))
    assert found == expected(odd, cheapest)
    assert conv.repaired_after_damage(df.limit(0)).count() == 0
    long = found[77]
    assert long[2] > 0 and len(long[6]) > 8000


def test_repaired_turns_have_the_digest(spark, odd):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in odd], FORM)
    texts = defaultdict(list)
    for r in sorted(conv.repaired_turns(conv.damaged(df)).collect(), key=lambda r: (str(r["conv_id"]), r["place"])):
        texts[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for conv_id, want in expected(odd, cheapest).items():
        assert hashlib.sha256("\n".join(texts[conv_id]).encode()).hexdigest() == want[-1]
