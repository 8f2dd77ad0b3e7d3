"""Language model by deleted interpolation: word bigrams, words and a uniform share, mixed by context frequency.

p(w | v) = a * c(v w) / c(v) + b * c(w) / N + c / (V + 1), where the weights a, b, c depend on how often
the context v was seen (a bucket per doubling). The weights are learned by expectation-maximisation on
held-out counts: one part in DELETED of the training documents is taken out of all counts (c - c_deleted),
and its bigrams are the events. Texts are then scored with the counts of all training documents. The
context of a text's first token is its beginning; every text ends in an end token.

A task puts its documents in batches of about BATCH_CHARS characters. Each batch asks for the counts of
its distinct words and bigrams, which also report the batch's own training counts, so a bigram costs one
entry per batch, however frequent it is. Entries go, packed as binary pieces, to buckets of their hash, where
sums are taken, and the sums come back in the order asked. Buckets, and with them the width of the
hashes (48 bits beside the bucket's number), grow with the corpus, so no task holds more than a bucket
or a batch. Nothing of the model is sent to all tasks but the weights, three for each of at most 64 buckets.

Cases: a null text is the empty text: the end token alone; a null doc_id is in the fold of the empty
text's crc32, 0; repeated rows are each counted and scored; without training documents every token has
the uniform share, 1, and base and score are 0; without deleted documents, or in a context bucket without
events, the weights are those of all events, or equal shares; a component without counts (an unseen
context) gives its weight to the others; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.line_dedup import _mixed, word_hashes
from tickloom.llm.texts import fold, rows, saved

FOLDS, HELD_OUT = 5, 1
#: One training document in so many is deleted from the counts that the weights are learned with.
DELETED = 16
#: Characters of a batch; characters of the corpus for each hash bucket, and buckets at least.
BATCH_CHARS, BUCKET_CHARS, FEWEST_BUCKETS = 4_000_000, 16_000_000, 256
#: Rounds of expectation-maximisation at most, and the gain per event at which it ends.
ROUNDS, GAIN = 60, 1e-7
# The end of a text, its beginning, and the factors that tell orders apart.
END, BEGIN = np.uint64(0x5DEECE66D1234567), np.uint64(0x2545F4914F6CDD1D)
LOW = (1 << 48) - 1
WORDS, PAIRS = 1, 2


class Tokens:
    """The tokens of a batch's texts, its distinct words and bigrams, and where they stand."""

    def __init__(self, texts: list[str], bits: int):
        hashes, borders = word_hashes(texts)
        self.tokens = np.insert(hashes, borders[1:], END)
        self.sizes = np.diff(borders) + 1
        self.owner = np.repeat(np.arange(len(texts)), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.keys, self.places = {}, {}
        before = np.concatenate([[BEGIN], self.tokens[:-1]])
        before[self.first] = BEGIN
        word = _mixed(self.tokens)
        for level, key in ((WORDS, word), (PAIRS, _mixed(word * np.uint64(5) + _mixed(before ^ BEGIN)))):
            if bits < 16:  # the bucket's bits above, 48 others below
                key = (key >> np.uint64(64 - bits) << np.uint64(48)) | (key & np.uint64(LOW))
            self.keys[level], self.places[level] = np.unique(key, return_inverse=True)

    def counts(self, used: np.ndarray, level: int) -> np.ndarray:
        """Occurrences of each distinct entry in the texts marked in `used`."""
        return np.bincount(self.places[level], used[self.owner], minlength=len(self.keys[level])).astype(np.uint32)


def bucket_bits(docs: DataFrame) -> int:
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(FEWEST_BUCKETS, chars // BUCKET_CHARS).bit_length() - 1


def shifted(bits: int) -> int:
    """Bits of a key below its bucket's."""
    return 48 if bits < 16 else 64 - bits


_BATCH = "batch long, deleted boolean, doc_ids array<long>, folds array<int>, lengths array<int>, texts binary"
_BATCH_SCHEMA = pa.schema(
    [("batch", pa.int64()), ("deleted", pa.bool_()), ("doc_ids", pa.list_(pa.int64())), ("folds", pa.list_(pa.int32())),
     ("lengths", pa.list_(pa.int32())), ("texts", pa.binary())]
)


def in_batches(docs: DataFrame) -> DataFrame:
    """Documents in batches, deleted ones in batches of their own."""
    number = fold(F.col("doc_id"), FOLDS)
    part = F.floor(fold(F.col("doc_id"), FOLDS * DELETED) / FOLDS)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", number.cast("int").alias("fold"),
        ((number != HELD_OUT) & (part == 0)).alias("deleted"),
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, press = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(3)
        held: dict[bool, list] = {False: [[], [], [], 0], True: [[], [], [], 0]}

        def row(deleted: bool) -> pa.RecordBatch:
            nonlocal made
            doc_ids, folds, texts, _ = held[deleted]
            held[deleted], made = [[], [], [], 0], made + 1
            packed = press.compress(b"".join(texts))
            return rows(_BATCH_SCHEMA, [made], [deleted], [doc_ids], [folds], [[len(t) for t in texts]], [packed])

        for batch in batches:
            for doc_id, text, number, deleted in zip(*(batch[n] for n in ("doc_id", "text", "fold", "deleted"))):
                into = held[deleted.as_py()]
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                into[0].append(doc_id.as_py())
                into[1].append(number.as_py())
                into[2].append(raw)
                into[3] += len(raw)
                if into[3] >= BATCH_CHARS:
                    yield row(deleted.as_py())
        yield from (row(deleted) for deleted in (False, True) if held[deleted][0])

    return narrow.mapInArrow(each, _BATCH)


def unpacked(texts: bytes, lengths: list[int]) -> list[str]:
    whole, found, at = zstandard.ZstdDecompressor().decompress(texts), [], 0
    for n in lengths:
        found.append(whole[at : at + n].decode("utf-8", "surrogatepass"))
        at += n
    return found


def packed_keys(keys: np.ndarray) -> bytes:
    """The low 48 bits of each key; the rest is the bucket's number."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked_keys(raw: bytes) -> np.ndarray:
    full = np.zeros((len(raw) // 6, 8), np.uint8)
    full[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return full.view("<u8").ravel()


def requests(batches: DataFrame, bits: int) -> DataFrame:
    """bucket, level, batch, deleted, keys, counts: what a batch asks of each bucket, and its own training counts."""
    schema = pa.schema(
        [("bucket", pa.int64()), ("level", pa.int32()), ("batch", pa.int64()), ("deleted", pa.bool_()), ("keys", pa.binary()), ("counts", pa.binary())]
    )
    wide = shifted(bits) > 48 or bits >= 16

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for r in part.to_pylist():
                found = Tokens(unpacked(r["texts"], r["lengths"]), bits)
                training = np.array(r["folds"]) != HELD_OUT
                for level in (WORDS, PAIRS):
                    keys, counts = found.keys[level], found.counts(training, level)
                    bucket = keys >> np.uint64(shifted(bits))
                    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                    cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
                    n = len(cuts)
                    yield rows(
                        schema, bucket[edges[:-1]].astype(np.int64), np.full(n, level, np.int32), np.full(n, r["batch"]),
                        np.full(n, r["deleted"]), [keys[a:b].tobytes() if wide else packed_keys(keys[a:b]) for a, b in cuts],
                        [counts[a:b].tobytes() for a, b in cuts],
                    )

    return batches.mapInArrow(each, "bucket long, level int, batch long, deleted boolean, keys binary, counts binary")


_ANSWER = "batch long, level int, bucket long, counts binary, n long, n_deleted long, v long, v_left long"
_ANSWER_SCHEMA = pa.schema(
    [("batch", pa.int64()), ("level", pa.int32()), ("bucket", pa.int64()), ("counts", pa.binary()), *((c, pa.int64()) for c in ("n", "n_deleted", "v", "v_left"))]
)


def answers(asked: DataFrame, bits: int) -> DataFrame:
    """batch, level, bucket, counts (all, then deleted ones): the sums in the order asked; one row a bucket has its totals."""
    wide = shifted(bits) > 48 or bits >= 16

    def summed(bucket: int, level: int, held: list[tuple]) -> pa.RecordBatch:
        keys = [np.frombuffer(k, "<u8") if wide else unpacked_keys(k) for _, _, k, _ in held]
        own = [np.frombuffer(c, "<u4") for _, _, _, c in held]
        known, place = np.unique(np.concatenate(keys), return_inverse=True)
        gone = np.concatenate([np.full(len(k), d) for (_, d, _, _), k in zip(held, keys)])
        weights = np.concatenate(own).astype(np.float64)
        total = np.bincount(place, weights, minlength=len(known)).astype(np.int64)
        deleted = np.bincount(place, weights * gone, minlength=len(known)).astype(np.int64)
        stops = np.cumsum([len(k) for k in keys])
        back = []
        for (batch, _, _, _), a, b in zip(held, (stops - [len(k) for k in keys]).tolist(), stops.tolist()):
            at = place[a:b]
            back.append((batch, np.concatenate([total[at], deleted[at]]).astype("<u4").tobytes()))
        n, none = len(back), [None] * len(back)
        figures = [int(total.sum()), int(deleted.sum()), int((total > 0).sum()), int((total > deleted).sum())]
        return rows(
            _ANSWER_SCHEMA, [b for b, _ in back], np.full(n, level, np.int32), np.full(n, bucket), [c for _, c in back],
            *([f if level == WORDS else 0, *none[1:]] for f in figures),
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for bucket, level, number, deleted, keys, counts in zip(*(batch[n] for n in ("bucket", "level", "batch", "deleted", "keys", "counts"))):
                here = bucket.as_py(), level.as_py()
                if here != at and held:
                    yield summed(*at, held)
                    held = []
                at = here
                held.append((number.as_py(), deleted.as_py(), keys.as_py(), counts.as_py()))
        if held:
            yield summed(*at, held)

    parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = asked.repartition(parts, "bucket", "level").sortWithinPartitions("bucket", "level", "batch")
    return dealt.mapInArrow(each, _ANSWER)


def counted(batches: DataFrame, found: DataFrame, bits: int, make, form: str) -> DataFrame:
    """What `make` yields of each batch: its row, its tokens and the counts (all, deleted) per level and entry."""
    parts = int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = batches.withColumn("level", F.lit(0)).unionByName(found.select("batch", "level", "bucket", "counts"), allowMissingColumns=True)
    dealt = both.repartition(parts, "batch").sortWithinPartitions("batch", "level", "bucket")

    def closed(row: dict, counts: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(unpacked(row["texts"], row["lengths"]), bits)
        sums = {}
        for level in (WORDS, PAIRS):
            halves = [np.frombuffer(c, "<u4").reshape(2, -1) for c in counts[level]]
            sums[level] = np.concatenate(halves, axis=1).astype(np.int64)
            if sums[level].shape[1] != len(tokens.keys[level]):
                raise RuntimeError(f"batch {row['batch']}: {sums[level].shape[1]} counts for {len(tokens.keys[level])} entries")
        yield from make(row, tokens, sums)

    def each(parts_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, counts = None, {}
        for part in parts_:
            for at, level in enumerate(part["level"].to_pylist()):
                if level == 0:
                    if row is not None:
                        yield from closed(row, counts)
                    row, counts = part.slice(at, 1).to_pylist()[0], {WORDS: [], PAIRS: []}
                else:
                    counts[level].append(part["counts"][at].as_py())
        if row is not None:
            yield from closed(row, counts)

    return dealt.mapInArrow(each, form)


def contexts(tokens: Tokens, words: np.ndarray, beginnings: int) -> np.ndarray:
    """How often each token's context was seen: the word before it, or the beginning of a text."""
    own = words[tokens.places[WORDS]]
    before = np.concatenate([[0], own[:-1]])
    before[tokens.first] = beginnings
    return before


def kind_of(context: np.ndarray) -> np.ndarray:
    """The bucket of a context count: 0 for none, then one per doubling."""
    return np.frexp(context)[1]


def events(batches: DataFrame, found: DataFrame, bits: int, beginnings: int) -> DataFrame:
    """context, pair, word, times: tokens of the deleted documents with what the other training documents know of them."""
    form = "context long, pair long, word long, times long"
    schema = pa.schema([(n, pa.int64()) for n in ("context", "pair", "word", "times")])

    def make(row: dict, tokens: Tokens, sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        words, pairs = (sums[level][0] - sums[level][1] for level in (WORDS, PAIRS))
        seen = np.stack([contexts(tokens, words, beginnings), pairs[tokens.places[PAIRS]], words[tokens.places[WORDS]]], axis=1)
        kinds, times = np.unique(seen, axis=0, return_counts=True)
        yield rows(schema, *kinds.T, times)

    gone = batches.where("deleted")
    mine = found.join(gone.select("batch"), "batch", "left_semi")
    return counted(gone, mine, bits, make, form).groupBy("context", "pair", "word").agg(F.sum("times").alias("times"))


def learned(seen: DataFrame, n: int, v: int) -> dict[int, tuple[float, float, float]]:
    """Weights of bigram, word and uniform share per context bucket; -1 has those of all events."""
    context = F.col("context").cast("double")
    kind = F.when(F.col("context") > 0, F.length(F.bin("context"))).otherwise(0)
    shares = seen.select(
        F.explode(F.array(kind, F.lit(-1))).alias("kind"), F.col("times").cast("double").alias("times"),
        F.when(F.col("context") > 0, F.col("pair") / context).otherwise(0.0).alias("pair"),
        (F.col("word") / float(max(n, 1))).alias("word"), F.lit(1 / (v + 1)).alias("even"),
    )
    shares = saved(shares, "events")
    kinds = [r["kind"] for r in shares.select("kind").distinct().collect()]
    weights, before = {k: (1 / 3,) * 3 for k in kinds}, -math.inf
    for _ in range(ROUNDS):
        own = F.create_map(*[x for k, w in weights.items() for x in (F.lit(k), F.array(*map(F.lit, w)))]) if kinds else None
        if own is None:
            break
        parts = [own[F.col("kind")][i] * F.col(c) for i, c in enumerate(("pair", "word", "even"))]
        total = parts[0] + parts[1] + parts[2]
        step = shares.withColumns({"a": parts[0], "b": parts[1], "c": parts[2], "p": total}).where("p > 0").groupBy("kind")
        step = step.agg(
            *[F.sum(F.col("times") * F.col(c) / F.col("p")).alias(c) for c in "abc"],
            F.sum("times").alias("times"), F.sum(F.col("times") * F.ln("p")).alias("gain"),
        ).collect()
        weights |= {r["kind"]: tuple(r[c] / r["times"] for c in "abc") for r in step}
        gain = next((r["gain"] / r["times"] for r in step if r["kind"] == -1), 0.0)
        if gain - before < GAIN:
            break
        before = gain
    return weights


def mixture(weights: dict[int, tuple[float, float, float]]) -> np.ndarray:
    """The weights of each context bucket as rows, 0 to 63."""
    rest = weights.get(-1, (1 / 3,) * 3)
    return np.array([weights.get(k, rest) for k in range(64)])


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document."""
    bits = bucket_bits(docs)
    batches = saved(in_batches(docs), "batches")
    found = saved(answers(requests(batches, bits), bits), "counts")
    totals = found.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "n_deleted", "v", "v_left")]).first()
    n, v = totals["n"], totals["v"]
    taught = docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    part = fold(F.col("doc_id"), FOLDS * DELETED)
    begun = taught.agg(F.count("*").alias("all"), F.count(F.when(F.floor(part / FOLDS) > 0, 1)).alias("left")).first()
    seen = events(batches, found, bits, begun["left"])
    weights = mixture(learned(seen, n - totals["n_deleted"], totals["v_left"]))
    beginnings = begun["all"]
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    kinds = ("long", "boolean", "long", "long", "long", "double", "double")
    arrow = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    schema = pa.schema([(name, arrow[kind]) for name, kind in zip(names, kinds)])

    def make(row: dict, tokens: Tokens, sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        words, pairs = sums[WORDS][0], sums[PAIRS][0]
        context, own = contexts(tokens, words, beginnings), words[tokens.places[WORDS]]
        mix = weights[kind_of(context)]
        # a component without counts gives its weight to the others
        mix[context == 0, 0] = 0
        mix[:, 1] = mix[:, 1] if n else 0
        mix /= mix.sum(axis=1, keepdims=True)
        p = mix[:, 0] * pairs[tokens.places[PAIRS]] / np.maximum(context, 1) + mix[:, 1] * own / max(n, 1) + mix[:, 2] / (v + 1)
        base = np.log10((own + 0.5) / (n + 0.5 * (v + 1)))
        each = lambda x: np.bincount(tokens.owner, x, minlength=len(tokens.sizes))
        yield rows(
            schema, row["doc_ids"], np.array(row["folds"]) == HELD_OUT, tokens.sizes, each(own > 0).astype(np.int64),
            np.full(len(tokens.sizes), n), each(base), each(np.log10(p)),
        )

    return counted(batches, found, bits, make, ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds)))
