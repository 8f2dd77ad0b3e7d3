"""Deleted interpolation against its definition over dictionaries, and awkward rows."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from brute import words
from tickloom.llm import interpolation as lm
from tickloom.llm import queries

SMALL = "/root/testdata/sf0.001"


def brute(docs):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of (doc_id, text) rows."""
    number = {d: zlib.crc32(("" if d is None else str(d)).encode()) for d, _ in docs}
    texts = [(d, ["<s>", *words(t or ""), "</s>"]) for d, t in docs]
    training = [(d, t) for d, t in texts if number[d] % 5 != 1]
    deleted = [(d, t) for d, t in training if number[d] // 5 % lm.DELETED == 0]

    def counts(rows):
        one, two = Counter(), Counter()
        for _, t in rows:
            one.update(t)
            two.update(zip(t, t[1:]))
        return one, two

    (one, two), (one_gone, two_gone) = counts(training), counts(deleted)
    n, v = sum(one.values()) - one["<s>"], len(set(one) - {"<s>"})
    one_left, two_left = one - one_gone, two - two_gone
    n_left, v_left = sum(one_left.values()) - one_left["<s>"], len(set(one_left) - {"<s>"})

    seen = Counter()
    for _, t in deleted:
        for a, b in zip(t, t[1:]):
            seen[one_left[a], two_left[a, b], one_left[b]] += 1
    shares = defaultdict(list)
    for (context, pair, word), times in seen.items():
        row = times, pair / context if context else 0.0, word / max(n_left, 1), 1 / (v_left + 1)
        shares[context.bit_length()].append(row)
        shares[-1].append(row)
    weights, before = {k: [1 / 3] * 3 for k in shares}, -math.inf
    for _ in range(lm.ROUNDS if shares else 0):
        gains = {}
        for k, rows in shares.items():
            rows = np.array(rows)
            parts = rows[:, 1:] * np.array(weights[k])
            p = parts.sum(axis=1)
            ok = p > 0
            times = rows[ok, 0]
            gains[k] = float((times * np.log(p[ok])).sum() / times.sum())
            weights[k] = (times[:, None] * parts[ok] / p[ok, None]).sum(axis=0) / times.sum()
        if gains[-1] - before < lm.GAIN:
            break
        before = gains[-1]

    found = []
    for d, t in texts:
        base = total = 0.0
        for a, b in zip(t, t[1:]):
            base += math.log10((one[b] + 0.5) / (n + 0.5 * (v + 1)))
            mix = np.array(weights.get(one[a].bit_length(), weights.get(-1, [1 / 3] * 3)), float)
            mix = mix * [one[a] > 0, n > 0, 1]
            mix /= mix.sum()
            total += math.log10(mix @ [two[a, b] / max(one[a], 1), one[b] / max(n, 1), 1 / (v + 1)])
        found.append((d, number[d] % 5 == 1, len(t) - 1, sum(one[b] > 0 for b in t[1:]), n, base, total))
    return found


def check(df, docs):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    found, want = sorted((tuple(r) for r in df.collect()), key=key), sorted(brute(docs), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert [r[5] for r in found] == pytest.approx([r[5] for r in want], rel=1e-9)
    assert [r[6] for r in found] == pytest.approx([r[6] for r in want], rel=1e-6)
    return found


def test_documents_by_definition(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = check(queries.QUERIES["op11_deleted_interpolation"](spark, SMALL), docs)
    held = [r for r in found if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_batches_and_buckets_do_not_matter(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for bits in (2, 20):
        monkeypatch.setattr(lm, "bucket_bits", lambda df, bits=bits: bits)
        check(lm.score(df), docs)


def test_awkward_rows(spark):
    docs = [(k, t) for k, t in enumerate([None, "", " \n", "One one ONE", "a b c a b", "\u00c9 x\x1cy \u00e9", "word " * 40_000, "a b c a b"])]
    docs += [(4, "a b c a b"), (None, "no id"), (-(2**63), "a \u00a0 b"), *((k, "the cat sat on the mat " * (k % 5)) for k in range(20, 120))]
    form = "doc_id long, text string, fold int, batch long, level int"
    df = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], form)
    check(lm.score(df), docs)
    assert lm.score(df.limit(0)).count() == 0
    held = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 5 == 1]
    check(lm.score(spark.createDataFrame(held, "doc_id long, text string")), held)
    few = [d for d in docs if zlib.crc32(str(d[0]).encode()) // 5 % lm.DELETED]
    check(lm.score(spark.createDataFrame(few, "doc_id long, text string")), few)
