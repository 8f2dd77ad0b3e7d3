"""The pipeline, stage by stage, against brute force on the smallest tables."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from brute import without_passages, words
from tickloom.llm import queries
from tickloom.llm.texts import saved

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage kept, the documents first."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SMALL), name.replace(" ", "-"))
        found.append(docs.collect())
    return found


def texts(rows):
    return {r["doc_id"]: r["text"] or "" for r in rows}


def test_stage_names(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "substring dedup", "mixing", "packing"]
    columns = set(steps[0][0].asDict())
    assert all(set(rows[0].asDict()) == columns for rows in steps[1:-1])


def test_rejected_documents_are_the_predicted_ones(spark, steps):
    predicted = queries.QUERIES["op1_toxicity"](spark, SMALL).where("predicted = 1").collect()
    assert set(texts(steps[0])) - set(texts(steps[1])) == {r["doc_id"] for r in predicted}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where(F.col("toxic") == 0)
    clean = {r["doc_id"] for r in labels.collect()} & set(texts(steps[0]))
    assert len(clean & set(texts(steps[1]))) >= 0.97 * len(clean)


def fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))


def test_one_document_of_each_group_stays(steps):
    marks = {d: fingerprint(t) for d, t in texts(steps[1]).items()}
    group = {d: d for d in marks}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in marks:
        for b in marks:
            if a < b and (marks[a] ^ marks[b]).bit_count() <= 2:
                low, high = sorted((root(a), root(b)))
                group[high] = low
    assert set(texts(steps[2])) == {root(d) for d in marks}
    assert len(steps[2]) == len(texts(steps[2])) < len(steps[1])


def test_later_passages_go(steps):
    want = without_passages(texts(steps[2]))
    assert texts(steps[3]) == want != texts(steps[2])
    passages = Counter()
    for text in texts(steps[3]).values():
        low = words(text)
        passages.update({tuple(low[k : k + 50]) for k in range(len(low) - 49)})
    assert max(passages.values()) == 1


def test_mixing_repeats_rows_and_loses_none(steps):
    rows = [Counter(tuple(r.asDict().items()) for r in step) for step in steps[3:5]]
    assert set(rows[0]) == set(rows[1]) and all(rows[1][r] >= n for r, n in rows[0].items())


def test_pieces_hold_all_ids_and_sequences_have_no_gap(steps):
    whole, want = Tokenizer.from_file(queries.tokenizer()), Counter()
    for r in steps[4]:
        ids = [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        raw = np.array(ids, "<u4")
        for at in range(0, len(ids), 2048):
            part = raw[at : at + 2048]
            want[r["doc_id"], at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(tuple(r[n] for n in names) for r in steps[5]) == want
    sequences = defaultdict(list)
    for r in steps[5]:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in steps[5]) > 0.9 * 2048 * len(sequences)
