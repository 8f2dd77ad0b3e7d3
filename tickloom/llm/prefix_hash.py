"""Document fingerprints by prefix polynomial hashes.

`Prefixes` holds, for one text, the hash of every prefix modulo a prime. Any span's hash is the
difference of two entries, so two spans compare in constant time, and the longest common extension
from two positions, forward or backward, is found by binary search.

A text is cut where the hash of the next WINDOW characters is a multiple of SPACING, that is at places
that its content chooses, about one in SPACING characters whatever the length. A fingerprint is the
spans between cuts, each as its hash and length, and the whole text's hash under two primes. Two texts
are compared by their spans at any offset: each span that both have is widened to the longest common
stretch, as are the two beginnings and the two ends; the likeness is the share of the longer text that
such stretches cover.

Cases: a null text is the empty text; two empty texts are alike (1.0), an empty and a non-empty one
are not (0.0); rows that repeat a doc_id follow one another in the order of their texts' hashes; a
null doc_id counts as the smallest; one document is its own next document; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.texts import code_points, rows, text_key

PRIMES = (2_147_483_647, 2_147_483_629)
BASE = 1_000_003
#: Characters whose hash decides on a cut, and characters between cuts on average.
WINDOW, SPACING = 8, 48

_powers: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, prime: int, count: int) -> np.ndarray:
    """base**0, base**1, ... modulo prime, at least `count` of them."""
    table = _powers.get((base, prime))
    if table is None:
        table = np.ones(1, np.uint64)
    while len(table) < count:
        step = np.uint64(pow(base, len(table), prime))
        table = np.concatenate([table, table * step % np.uint64(prime)])
    _powers[base, prime] = table
    return table


class Prefixes:
    """Prefix hashes of one text: `at[i]` is the hash of its first i characters."""

    def __init__(self, codes: np.ndarray, prime: int = PRIMES[0], head: Prefixes | None = None, shared: int = 0):
        """`head` may give the entries of the first `shared` characters, which must be equal."""
        self.prime, self.n = prime, len(codes)
        tail = (codes[shared:].astype(np.uint64) + np.uint64(1)) * powers(BASE, prime, self.n + 1)[shared : self.n]
        start = head.at[: shared + 1] if head is not None else np.zeros(1, np.uint64)
        tail = (start[-1] + np.cumsum(tail % np.uint64(prime), dtype=np.uint64)) % np.uint64(prime)
        self.at = np.concatenate([start, tail])

    def span(self, start: int, end: int) -> int:
        """Hash of [start, end), as if it began at 0."""
        shift = int(powers(pow(BASE, -1, self.prime), self.prime, start + 1)[start])
        return (int(self.at[end]) - int(self.at[start])) % self.prime * shift % self.prime

    def same(self, start: int, other: Prefixes, other_start: int, length: int) -> bool:
        return self.span(start, start + length) == other.span(other_start, other_start + length)

    def extension(self, start: int, other: Prefixes, other_start: int) -> int:
        """Length of the longest common extension from both positions, by binary search."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.same(start, other, other_start, middle) else (low, middle - 1)
        return low

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of many spans."""
        prime = np.uint64(self.prime)
        unshift = powers(pow(BASE, -1, self.prime), self.prime, self.n + 1)
        return (self.at[ends] + prime - self.at[starts]) % prime * unshift[starts] % prime

    def cuts(self) -> np.ndarray:
        """Where the text is cut, its beginning and end included."""
        places = np.arange(1, max(1, self.n - WINDOW + 1))
        chosen = places[self.spans(places, places + WINDOW) % np.uint64(SPACING) == 0] if len(places) else places
        return np.concatenate([[0], chosen, [self.n]]) if self.n else np.zeros(1, np.int64)


class Marked:
    """A text with its prefix hashes under both primes and its spans."""

    def __init__(self, text: str, head: Marked | None = None, shared: int = 0):
        self.text, codes = text, code_points(text)
        heads = head.prefixes if head else (None, None)
        self.prefixes = tuple(Prefixes(codes, p, h, shared) for p, h in zip(PRIMES, heads))
        cuts = self.prefixes[0].cuts()
        self.starts, self.lengths = cuts[:-1], np.diff(cuts)
        self.hashes = self.prefixes[0].spans(cuts[:-1], cuts[1:])

    @property
    def n(self) -> int:
        return self.prefixes[0].n

    def __str__(self) -> str:
        """The fingerprint: length, hashes of the whole under both primes, hashes and lengths of the spans."""
        whole = "".join(f"{int(p.at[-1]):08x}" for p in self.prefixes)
        return f"{self.n:x}.{whole}.{self.hashes.astype('>u4').tobytes().hex()}.{self.lengths.astype('>u4').tobytes().hex()}"

    def edited(self, following: str) -> Marked:
        cut = len(self.text) // 3
        shared = len(self.text) - cut
        return Marked(self.text[:shared] + following[:cut], self, shared)

    def _reach(self, i: int, other: Marked, j: int, low: int, other_low: int, high: int, other_high: int) -> tuple[int, int]:
        """How far equal text reaches back from (i, j) and forward, within the given bounds, under both primes."""

        def most(limit: int, same) -> int:
            low_, high_ = 0, limit
            while low_ < high_:
                middle = (low_ + high_ + 1) // 2
                low_, high_ = (middle, high_) if same(middle) else (low_, middle - 1)
            return low_

        pairs = list(zip(self.prefixes, other.prefixes))
        back = most(min(i - low, j - other_low), lambda k: all(a.same(i - k, b, j - k, k) for a, b in pairs))
        on = most(min(high - i, other_high - j), lambda k: all(a.same(i, b, j, k) for a, b in pairs))
        return back, on

    def likeness(self, other: Marked) -> float:
        """Share of the longer text that stretches common to both cover; a stretch of either counts once."""
        if not (self.n and other.n):
            return float(self.n == other.n)
        _, begun = self._reach(0, other, 0, 0, 0, self.n, other.n)
        ended, _ = self._reach(self.n, other, other.n, begun, begun, self.n, other.n)
        covered, low, high = begun + ended, begun, self.n - ended
        top = other.n - ended
        theirs: dict[tuple[int, int], list[int]] = {}
        inside = (other.starts + other.lengths > begun) & (other.starts < top)
        for h, size, start in zip(other.hashes[inside].tolist(), other.lengths[inside].tolist(), other.starts[inside].tolist()):
            theirs.setdefault((h, size), []).append(start)
        free, at = Free(begun, top), begun
        for h, size, start in zip(self.hashes.tolist(), self.lengths.tolist(), self.starts.tolist()):
            if start < low or start + size > high or (h, size) not in theirs:
                continue
            here = free.first(theirs[h, size], size, at)
            if here is None:
                continue
            bottom, ceiling = free.around(here, size)
            back, on = self._reach(start, other, here, low, bottom, high, ceiling)
            if on < size:
                continue  # another span of the same hash
            covered += back + on
            low, at = start + on, here + on
            free.take(here - back, here + on)
        return min(1.0, covered / max(self.n, other.n))


class Free:
    """Stretches of a text that no common stretch covers yet."""

    def __init__(self, low: int, high: int):
        self.parts = [(low, high)]

    def around(self, start: int, size: int) -> tuple[int, int] | None:
        """The free stretch that holds the span."""
        k = bisect.bisect_right(self.parts, (start, 1 << 62)) - 1
        return self.parts[k] if k >= 0 and start + size <= self.parts[k][1] else None

    def first(self, places: list[int], size: int, at: int) -> int | None:
        """The first free one of the places from `at` on, else of all; covered ones leave the list for good."""
        for k in (bisect.bisect_left(places, at), 0):
            while k < len(places):
                if self.around(places[k], size):
                    return places[k]
                places.pop(k)
        return None

    def take(self, start: int, end: int) -> None:
        k = bisect.bisect_right(self.parts, (start, 1 << 62)) - 1
        low, high = self.parts[k]
        self.parts[k : k + 1] = [p for p in ((low, start), (end, high)) if p[0] < p[1]]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each compared with the row after it; a row that its range borrowed only follows."""
    waiting, out = None, []
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("bucket", "borrowed", "doc_id", "text")]
        for bucket, borrowed, doc_id, text in zip(*columns):
            if borrowed and waiting is None:
                continue
            here = Marked(text or "")
            if waiting and waiting[0] == bucket:
                own, changed = waiting[2], waiting[2].edited(here.text)
                sha = hashlib.sha256(changed.text.encode("utf-8", "surrogatepass")).hexdigest()
                likeness = own.likeness(changed), own.likeness(here)
                out.append((waiting[1], len(own.text), sha, str(own), str(changed), *likeness))
            waiting = None if borrowed else (bucket, doc_id, here)
            if len(out) >= 500:
                yield rows(_ARROW, *zip(*out))
                out = []
    if out:
        yield rows(_ARROW, *zip(*out))


def next_document_fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprint of each text, of its edited text, and their likeness to each other and the next text's.

    The edited text's last third is replaced by as much of the next document, in descending doc_id;
    the last is followed by the first. One shuffle deals the texts to ranges of doc_id. The row that
    follows a range's last one is sent to that range as well: one text per range.
    `buckets`: number of ranges, four per shuffle partition unless given; ranges come from
    approximate quantiles and only balance the work.
    """
    spark = docs.sparkSession
    smallest = -(2**63)
    ids = F.coalesce(F.col("doc_id"), F.lit(smallest))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * parts
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    cuts = docs.select(ids.alias("i")).agg(F.percentile_approx("i", shares, 100 * buckets)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(i: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, i.to_numpy(), side="left").astype(np.int32))

    tops = sorted(
        (r.b, r.top)
        for r in docs.select(ids.alias("i")).groupBy(bucket_of("i").alias("b")).agg(F.max("i").alias("top")).collect()
    )
    # the largest id of a range follows the range above; the largest of all follows the lowest range
    lends = {top: tops[(k + 1) % len(tops)][0] for k, (_, top) in enumerate(tops)}
    lent_ids = np.array(sorted(lends), np.int64)
    lent_to = np.array([lends[i] for i in lent_ids.tolist()], np.int32)

    @F.pandas_udf("array<struct<bucket:int,borrowed:boolean>>")
    def places(i: pd.Series) -> pd.Series:
        values = i.to_numpy()
        own = np.searchsorted(cuts, values, side="left")
        spot = np.searchsorted(lent_ids, values)
        out = []
        for k, b in enumerate(own.tolist()):
            here = [{"bucket": b, "borrowed": False}]
            if spot[k] < len(lent_ids) and lent_ids[spot[k]] == values[k]:
                here.append({"bucket": int(lent_to[spot[k]]), "borrowed": True})
            out.append(here)
        return pd.Series(out)

    dealt = (
        docs.select("doc_id", "text", ids.alias("i"))
        .withColumn("place", F.explode(places("i")))
        .select("place.bucket", "place.borrowed", "doc_id", "i", "text")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "borrowed", F.desc("i"), F.desc(text_key(F.col("text"))))
        .select("bucket", "borrowed", "doc_id", "text")
    )
    return dealt.mapInArrow(_in_order, RESULT)
