"""SimHash near-dedup by anchor-point covering.

A fingerprint is a majority vote over the hashes of a text's word shingles. Fingerprints that differ
in at most `distance` bits are linked; a group is a set of documents connected by links.

Anchors are the words of a covering code: three copies of the binary Golay code of length 23, each
of covering radius 3, over the 64 bits (the last copy's five spare bits are zero). A fingerprint is
owned by the anchor that it decodes to, at most 9 bits away. Every fingerprint also visits each
anchor that a word within `distance` bits of it decodes to, about 140 for two bits; those lie within
covering radius plus distance. So two linked fingerprints meet at the anchor that owns the smaller
one, exactly once, and comparing owners with visitors per anchor loses no link.

Cases: a null or wordless text has fingerprint zero and is linked like any other; a text of fewer
words than a shingle has one shingle; equal texts are one fingerprint and need no link; a null
doc_id never names a group unless the group has no other id; repeated rows fall into one group;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.texts import rows, saved, text_key

SEED = 42


def fingerprint(text: str, words: int = 3) -> int:
    """Majority bits of the XXH64 of word shingles, A-Z lower-cased, words split at ASCII white space."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    else:
        joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        starts = np.concatenate([[0], ends[:-words] + 1]).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]
    found, total = np.array(hashes, np.uint64), np.zeros(64, np.int64)
    for start in range(0, len(found), 65_536):
        part = found[start : start + 65_536]
        total += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(found)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, text_key, fp: the fingerprint's 64 bits as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t or "", words) for t in batch["text"].to_pylist()], np.uint64)
            yield rows(schema, batch["doc_id"], batch["text_key"], found.view(np.int64))

    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return keyed.mapInArrow(each, "doc_id long, text_key long, fp long")


# The binary Golay code: generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1. Fixed value.
GENERATOR = 0b110001110101
LENGTH, CHECKS = 23, 11


def syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator."""
    word = word.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        word = np.where(word >> bit & 1, word ^ (GENERATOR << (bit - CHECKS)), word)
    return word


def patterns(bits: int, most: int) -> list[int]:
    """Words of `bits` bits with at most `most` ones, lightest first."""
    return [sum(1 << i for i in c) for n in range(most + 1) for c in combinations(range(bits), n)]


def reaches(bits: int, distance: int) -> list[np.ndarray]:
    """For each number of flips d: table[syndrome] of word XOR anchor, for anchors that need d flips.

    `bits`: how many low bits of the block can be flipped. Rows are filled up with -1.
    """
    errors = np.array(patterns(LENGTH, 3))
    leader = np.zeros(1 << CHECKS, np.int64)
    leader[syndrome(errors)] = errors  # a perfect code: each syndrome has exactly one
    flips = np.array(patterns(bits, distance))
    weight = np.array([int(f).bit_count() for f in flips])
    moved = syndrome(flips)
    found = [[[] for _ in range(1 << CHECKS)] for _ in range(distance + 1)]
    for s in range(1 << CHECKS):
        seen = set()
        for offset, d in zip((flips ^ leader[s ^ moved]).tolist(), weight.tolist()):
            if offset not in seen:
                seen.add(offset)
                found[d][s].append(offset)
    tables = []
    for lists in found:
        table = np.full((1 << CHECKS, max(map(len, lists))), -1, np.int64)
        for s, offsets in enumerate(lists):
            table[s, : len(offsets)] = offsets
        tables.append(table)
    return tables


class Anchors:
    """Anchors that own and that are visited by 64-bit fingerprints."""

    BLOCKS = ((0, 23), (23, 23), (46, 18))  # (first bit, bits) of the three blocks

    def __init__(self, distance: int):
        self.distance = distance
        self.tables = [reaches(bits, distance) for _, bits in self.BLOCKS]

    def visits(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of the fingerprint, anchor) for all anchors; fps are uint64."""
        words = [(fps >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in self.BLOCKS]
        near = [
            [np.where((o := table[syn]) >= 0, (o ^ word[:, None]) >> CHECKS, -1) for table in tables]
            for word, tables in zip(words, self.tables)
            for syn in [syndrome(word)]
        ]
        who, where = [], []
        for a in range(self.distance + 1):
            for b in range(self.distance + 1 - a):
                for c in range(self.distance + 1 - a - b):
                    x, y, z = near[0][a][:, :, None, None], near[1][b][:, None, :, None], near[2][c][:, None, None, :]
                    anchor = (x << 24 | y << 12 | z).reshape(len(fps), -1)
                    good = ((x >= 0) & (y >= 0) & (z >= 0)).reshape(len(fps), -1)
                    who.append(np.nonzero(good)[0])
                    where.append(anchor[good])
        return np.concatenate(who), np.concatenate(where)


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (column fp) at most `distance` bits apart."""
    schema = pa.schema([("anchor", pa.int64()), ("fp", pa.int64())])

    def visit(reach: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors = Anchors(reach)
            for batch in batches:
                values = batch["fp"].to_numpy()
                for start in range(0, len(values), 4096):
                    part = values[start : start + 4096]
                    who, where = anchors.visits(part.view(np.uint64))
                    yield rows(schema, where, part[who])

        return run

    form = "anchor long, fp long"
    owners = fps.select("fp").mapInArrow(visit(0), form).withColumnRenamed("fp", "a")
    visitors = fps.select("fp").mapInArrow(visit(distance), form).withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    met = visitors.join(owners.hint("shuffle_hash"), (owners.anchor == visitors.anchor) & (F.col("a") < F.col("b")) & near)
    return met.select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, text_key, fingerprint (16 hex digits), component_id: the smallest doc_id reachable."""
    marked = saved(fingerprints(docs, words), "simhash")
    distinct = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    joined = components(saved(links(distinct, distance), "simhash-links"))
    grouped = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "group", F.coalesce("label", "fp")
    )
    named = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    # one narrow row per distinct fingerprint, then one per document
    labelled = grouped.join(named, "group").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return marked.join(labelled, "fp").select("doc_id", "text_key", digits, "component_id")
