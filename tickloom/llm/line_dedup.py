"""Substring dedup by hashing units of text that do not depend on where lines begin.

Texts are normalised to words (split at ASCII white space, A-Z lower-cased). A passage is any run of
`WORDS` words; of all places that have a passage the one of lowest rank (doc_id, then place in the
text) stays, and the words of every other place are removed. Removed parts are given as code-point
spans of the original text, from the first removed word of a run to its last.

1. Texts are cut into units where a pair of words hashes lower than all pairs within `REACH` words, so
   equal passages are cut alike wherever they stand. Unit digests are grouped over all texts. A passage
   that holds a unit without a second occurrence, with the words that decide its ends, cannot repeat;
   that leaves few places in texts without copies.
2. The passages at the places left are digested and grouped; all but the first occurrence go.

Both groupings first settle what one batch of texts can settle by itself, so a unit or passage of a
third of all texts costs a row per batch in the shuffle, not a row per text, and the sorted rows are
read as a stream. Texts that are equal throughout are one text with the lowest rank of them; a later
copy goes as a whole, whatever the number of copies. The texts that need a second look and those that
change are told from the rest by bitmaps of FILTER_BITS bits; only they are shuffled.

Cases: a null text stays null and has no words, a text of fewer than `words` words is never changed; a
document may lose all its words but not its row; rows that share a doc_id rank alike, so a passage
that they share stays in each of them, and repeated rows get equal results; within a text the later
of two equal passages goes, also if they overlap, so an endlessly repeated phrase is left once; a
null doc_id ranks last; an empty table gives an empty result. Texts are told apart by 96 bits and
passages by 96 bits of hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.texts import free_name, groups, rows, saved

#: Words of a passage; shorter repeats stay.
WORDS = 50
#: A cut is lowest among so many pairs of words on either side.
REACH = 5
#: Size of the bitmaps that keep unconcerned texts out of shuffles; a set bit too many costs time alone.
FILTER_BITS = 1 << 24
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1
# Kinds of unit rows: to be compared, known to repeat, sent to tell the others.
OPEN, KNOWN, TELLER = 0, 1, 2


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(count: int, seed: int) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(2 * seed + 1)) | np.uint64(1)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word of all texts, border of each text in them)."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    coded = split.values.dictionary_encode()
    digest = xxhash.xxh64_intdigest
    known = np.array([digest(w) if w else 0 for w in coded.dictionary.to_pylist()], np.uint64)
    # an empty word stands where white space begins or ends a text
    real = np.array([w != "" for w in coded.dictionary.to_pylist()], bool)
    places = coded.indices.to_numpy(zero_copy_only=False)
    kept = real[places]
    before = np.concatenate([[0], np.cumsum(kept)])
    return known[places[kept]], before[split.offsets.to_numpy() - split.offsets[0].as_py()]


def unit_cuts(hashes: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Places, ascending, before which a unit begins; a text's own borders are none."""
    n = len(hashes)
    if n < 2 * REACH + 2:
        return np.zeros(0, np.int64)
    pair = np.zeros(n, np.uint64)  # pair[i]: the words i - 1 and i
    pair[1:] = _mixed(hashes[1:] * np.uint64(3) + (hashes[:-1] ^ (hashes[:-1] >> np.uint64(9))))
    middle = pair[REACH + 1 : n - REACH]
    lowest = np.ones(len(middle), bool)
    for k in range(1, REACH + 1):
        lowest &= (middle < pair[REACH + 1 - k : n - REACH - k]) & (middle < pair[REACH + 1 + k : n - REACH + k])
    cuts = np.flatnonzero(lowest) + REACH + 1
    owner = np.searchsorted(borders, cuts, side="right") - 1
    return cuts[(cuts - REACH - 1 >= borders[owner]) & (cuts + REACH < borders[owner + 1])]


def units(hashes: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word behind the last, text, digest) of the units between two cuts of one text."""
    cuts = unit_cuts(hashes, borders)
    owner = np.searchsorted(borders, cuts, side="right") - 1
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    starts, ends, texts = cuts[inner], cuts[inner + 1], owner[inner]
    if not len(starts):
        return starts, ends, texts, np.zeros(0, np.uint64)
    place = np.arange(len(hashes)) - np.repeat(np.concatenate([[0], cuts]), np.diff(np.concatenate([[0], cuts, [len(hashes)]])))
    weighted = hashes * _factors(int(place.max()) + 1, 1)[place]
    sums = np.add.reduceat(weighted, cuts)[inner]
    return starts, ends, texts, _mixed(sums + (ends - starts).astype(np.uint64))


def possible(starts: np.ndarray, ends: np.ndarray, first: int, last: int, words: int) -> np.ndarray:
    """Of the places first..last: those from which `words` words hold none of the given units with its edges."""
    if last < first:
        return np.zeros(0, np.int64)
    low, high = np.maximum(ends + REACH + 1 - words, first), np.minimum(starts - REACH - 1, last)
    low, high = low[low <= high], high[low <= high]
    change = np.zeros(last - first + 2, np.int64)
    np.add.at(change, low - first, 1)
    np.add.at(change, high - first + 1, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) == 0) + first


def unit_rows(docs: DataFrame, words: int) -> DataFrame:
    """part, digest, text1, text2, unit, kind: units of each text, and unit -1 for a text that has to be looked at anyway."""
    names = ("part", "digest", "text1", "text2")
    schema = pa.schema([*((n, pa.int64()) for n in names), ("unit", pa.int32()), ("kind", pa.int32())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # a task's texts
        for columns, texts in groups(batches):
            fresh = []
            for k, key in enumerate(zip(columns["text1"], columns["text2"])):
                if key not in seen:
                    seen.add(key)
                    fresh.append(k)
            keys, more = (np.array([columns[n][k] for k in fresh], np.int64) for n in ("text1", "text2"))
            hashes, borders = word_hashes([texts[k] for k in fresh])
            starts, ends, owner, digests = units(hashes, borders)
            long_enough = np.diff(borders) >= words
            bounds = np.searchsorted(owner, np.arange(len(keys) + 1))
            unsettled = [
                k
                for k in np.flatnonzero(long_enough).tolist()
                if len(possible(starts[(u := slice(bounds[k], bounds[k + 1]))], ends[u], borders[k], borders[k + 1] - words, words))
            ]
            number = np.arange(len(owner)) - bounds[owner]
            used = long_enough[owner]
            digests, owner, number = digests[used], owner[used], number[used]
            _, place, count = np.unique(digests, return_inverse=True, return_counts=True)
            again = count[place] > 1
            first = np.zeros(len(digests), bool)
            first[np.unique(digests, return_index=True)[1]] = True
            told = first & again
            signed, text1, text2 = digests.view(np.int64), keys[owner], more[owner]
            yield rows(
                schema,
                np.concatenate([np.where(again, text1, signed), signed[told], keys[unsettled]]),
                np.concatenate([signed, signed[told], np.zeros(len(unsettled), np.int64)]),
                np.concatenate([text1, text1[told], keys[unsettled]]),
                np.concatenate([text2, text2[told], more[unsettled]]),
                np.concatenate([number, number[told], np.full(len(unsettled), -1)]).astype(np.int32),
                np.concatenate([np.where(again, KNOWN, OPEN), np.full(told.sum(), TELLER), np.full(len(unsettled), KNOWN)]).astype(np.int32),
            )

    return docs.mapInArrow(each, "part long, digest long, text1 long, text2 long, unit int, kind int")


def repeated_units(docs: DataFrame, words: int) -> DataFrame:
    """text1, text2, units: the numbers of a text's units that occur twice or more in all texts (-1 is no unit)."""
    schema = pa.schema([("text1", pa.int64()), ("text2", pa.int64()), ("unit", pa.int32())])
    names = ("digest", "text1", "text2", "unit", "kind")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last open row: (its columns, whether the row before has its digest)
        for batch in batches:
            found = [batch[n].to_numpy() for n in names]
            known = found[4] == KNOWN
            yield rows(schema, *(x[known] for x in found[1:4]))
            found = [x[~known] for x in found]
            if not len(found[0]):
                continue
            twin = np.zeros(len(found[0]), bool)
            if held is not None:
                found = [np.concatenate([[h], x]) for h, x in zip(held, found)]
                twin = np.concatenate([[held[5]], twin])
            # the same unit of equal texts that different tasks read is one occurrence
            other = np.ones(len(twin), bool)
            other[1:] = np.any([x[1:] != x[:-1] for x in found], axis=0)
            found, twin = [x[other] for x in found], twin[other]
            same = found[0][1:] == found[0][:-1]
            twin[1:] |= same
            twin[:-1] |= same
            sent = twin & (found[4] == OPEN)
            sent[-1] = False
            yield rows(schema, *(x[sent] for x in found[1:4]))
            held = *(x[-1] for x in found), twin[-1]
        if held is not None and held[5] and held[4] == OPEN:
            yield rows(schema, *([x] for x in held[1:4]))

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = unit_rows(docs, words).repartition(parts, "part").sortWithinPartitions(*names)
    found = sorted_rows.mapInArrow(each, "text1 long, text2 long, unit int")
    return found.groupBy("text1", "text2").agg(F.collect_set("unit").alias("units"))


def passage_rows(texts: DataFrame, words: int) -> DataFrame:
    """part, a, b, rank, text1, text2, start, later: passages to be compared, and those known to be later ones.

    `texts`: one row per text with its rank and its repeated units.
    """
    form = "part long, a long, b int, rank long, text1 long, text2 long, start int, later boolean"
    schema = pa.schema(
        [("part", pa.int64()), ("a", pa.int64()), ("b", pa.int32()), ("rank", pa.int64()), ("text1", pa.int64()),
         ("text2", pa.int64()), ("start", pa.int32()), ("later", pa.bool_())]
    )
    one, two = _factors(words, 2), _factors(words, 3)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, found in groups(batches):
            hashes, borders = word_hashes(found)
            starts, ends, owner, _ = units(hashes, borders)
            bounds = np.searchsorted(owner, np.arange(len(found) + 1))
            at, text = [], []
            for k, repeated in enumerate(columns["units"]):
                single = np.ones(bounds[k + 1] - bounds[k], bool)
                single[[u for u in repeated if 0 <= u < len(single)]] = False
                u = slice(bounds[k], bounds[k + 1])
                places = possible(starts[u][single], ends[u][single], borders[k], borders[k + 1] - words, words)
                at.append(places)
                text.append(np.full(len(places), k))
            at, text = np.concatenate([np.zeros(0, np.int64), *at]), np.concatenate([np.zeros(0, np.int64), *text])
            a, b = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
            for k in range(words):
                word = hashes[at + k]
                a += word * one[k]
                b += word * two[k]
            a, b = a.view(np.int64), (b >> np.uint64(32)).astype(np.uint32).view(np.int32)
            rank, text1, text2 = (np.array(columns[n], np.int64)[text] for n in ("rank", "text1", "text2"))
            start = at - borders[text]
            order = np.lexsort((start, text, rank, b, a))
            a, b, rank, text, text1, text2, start = (x[order] for x in (a, b, rank, text, text1, text2, start))
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            least = rank[np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))] if len(a) else rank
            own = np.zeros(len(a), bool)
            own[1:] = ~new[1:] & (text[1:] == text[:-1])
            later = (rank > least) | own
            yield rows(schema, np.where(later, text1, a), a, b, rank, text1, text2, start.astype(np.int32), later)

    return texts.mapInArrow(each, form)


def later_passages(texts: DataFrame, words: int) -> DataFrame:
    """text1, text2, starts: the places of a text from which a passage of lower rank is repeated."""
    schema = pa.schema([("text1", pa.int64()), ("text2", pa.int64()), ("start", pa.int32())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (a, b, lowest rank) of the passage at hand
        for batch in batches:
            later = batch["later"].to_numpy(zero_copy_only=False)
            a, b, rank, text1, text2, start = (batch[n].to_numpy() for n in ("a", "b", "rank", "text1", "text2", "start"))
            yield rows(schema, text1[later], text2[later], start[later])
            a, b, rank, text1, text2, start = (x[~later] for x in (a, b, rank, text1, text2, start))
            if not len(a):
                continue
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            least = rank[np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))]
            if held is not None and (a[0], b[0]) == held[:2]:
                least[: int(np.argmax(new[1:])) + 1 if new[1:].any() else len(a)] = held[2]
            gone = rank > least
            yield rows(schema, text1[gone], text2[gone], start[gone])
            held = a[-1], b[-1], least[-1]

    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = passage_rows(texts, words).repartition(parts, "part").sortWithinPartitions("a", "b", "rank")
    found = sorted_rows.mapInArrow(each, "text1 long, text2 long, start int")
    return found.groupBy("text1", "text2").agg(F.sort_array(F.collect_set("start")).alias("starts"))


def member(keys: DataFrame, name: str):
    """A test on a long column: false only if the value is not among the keys. At most FILTER_BITS bits are collected."""
    # Spark's buckets and positions count from 1
    place = F.pmod(F.col(name), F.lit(FILTER_BITS)) + 1
    marked = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in marked.collect():
        part = np.frombuffer(r["bits"], np.uint8)
        at = (r["bucket"] - 1) * len(part)
        bits[at : at + len(part)] = part
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        at = values.to_numpy() % FILTER_BITS
        return pd.Series((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return test


def cut_text(text: str | None, starts: np.ndarray, whole: bool, words: int) -> tuple[str | None, list[dict]]:
    """The text without the passages that begin at the given words (or without any word), and their spans."""
    if text is None or not (whole or len(starts)):
        return text, []
    found = [m.span() for m in WORD.finditer(text)]
    gone = np.zeros(len(found) + 1, np.int64)
    if whole:
        if len(found) < words:
            return text, []
        gone[0], gone[-1] = 1, -1
    else:
        np.add.at(gone, starts, 1)
        np.add.at(gone, starts + words, -1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(gone[:-1]) > 0, [0]])))
    spans = [{"start": found[a][0], "end": found[b - 1][1]} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
    stops = [0, *(s["end"] for s in spans)]
    return "".join(text[a:b] for a, b in zip(stops, [*(s["start"] for s in spans), len(text)])), spans


def rank_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(LAST))


def without_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """`docs` with repeated passages cut from `text`, and `removed`: spans in the original text.

    An own column called `removed` is replaced.
    """

    @F.pandas_udf("text string, removed array<struct<start:long,end:long>>")
    def cut(text: pd.Series, starts: pd.Series, whole: pd.Series) -> pd.DataFrame:
        none = np.zeros(0, np.int64)
        done = [cut_text(t, none if s is None else np.asarray(s, np.int64), bool(w), words) for t, s, w in zip(text, starts, whole)]
        return pd.DataFrame({"text": [t for t, _ in done], "removed": [s for _, s in done]})

    docs = docs.drop("removed")
    names = docs.columns
    one, two, filled = F.xxhash64("text"), F.crc32(F.col("text").cast("binary")), docs.where(F.col("text").isNotNull())
    keyed = filled.select(rank_of(F.col("doc_id")).alias("rank"), "text", one.alias("text1"), two.alias("text2"))
    flagged = saved(repeated_units(keyed.select("text1", "text2", "text"), words), "repeated-units")
    # one row per text; copies are told by their key before they are shuffled
    looked = keyed.where(member(flagged, "text1")("text1"))
    looked = looked.groupBy("text1", "text2").agg(F.min("rank").alias("rank"), F.first("text").alias("text"))
    places = later_passages(looked.join(flagged, ["text1", "text2"]), words)
    copied = keyed.groupBy("text1", "text2").agg(F.min("rank").alias("least"), F.max("rank").alias("most"))
    copied = copied.where("least < most").select("text1", "text2", "least", F.lit(None).cast("array<int>").alias("starts"))
    both = copied.unionByName(places.withColumn("least", F.lit(None).cast("long"))).groupBy("text1", "text2")
    both = both.agg(F.min("least").alias("least"), F.first("starts", ignorenulls=True).alias("starts"))
    both = saved(both, "repeated-passages")
    changes = member(both, "text1")
    one_, two_, least, starts, done = (free_name(docs, n) for n in ("key_one", "key_two", "least_rank", "passages", "cut_text"))
    both = both.select(*[F.col(a).alias(b) for a, b in zip(("text1", "text2", "least", "starts"), (one_, two_, least, starts))])
    none = F.array().cast("array<struct<start:bigint,end:bigint>>").alias("removed")
    own = [F.col(f"`{n}`") for n in names]
    # a null text has no key, and a null key is not among the keys
    asked = F.coalesce(changes(F.coalesce(one, F.lit(0))), F.lit(False)) & F.col("text").isNotNull()
    still = docs.where(~asked).select(*own, none)
    hashed = docs.where(asked).withColumns({f"{one_}_": one, f"{two_}_": two})
    joined = hashed.join(both, (F.col(f"{one_}_") == F.col(one_)) & (F.col(f"{two_}_") == F.col(two_)), "left")
    whole = F.coalesce(rank_of(F.col("doc_id")) > F.col(least), F.lit(False))
    joined = joined.withColumn(done, cut("text", F.col(starts), whole))
    changed = joined.select(
        *[F.col(f"{done}.text").alias("text") if n == "text" else F.col(f"`{n}`") for n in names],
        F.col(f"{done}.removed").alias("removed"),
    )
    return still.unionByName(changed)
