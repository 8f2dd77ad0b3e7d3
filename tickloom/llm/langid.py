"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A letter trigram is bound
into one vector: the first letter's vector permuted twice, the second's once, the third's as it is,
multiplied. A text's profile is the bundle (sum) of its trigrams' vectors; a language's prototype is
the bundle of its training texts. A text gets the language whose prototype has the largest cosine.

Letters are lower-cased; every run of other characters is one word border, and each text begins and
ends with one. Trigrams are bound BLOCK at a time, so memory does not grow with the alphabet.

Cases: null, empty and letterless texts get `und` with score 0; a null language teaches nothing; if
no language was learned all texts get `und`; of equally near languages the first by name wins; rows
that repeat count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.texts import code_points, fold, groups, rows

DIMENSIONS = 1024
BORDER = 32
#: Trigrams that are bound at once: 1,024 bytes each, and four times that as numbers to add up.
BLOCK = 8192
UNKNOWN = "und"

_is_letter: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _is_letter[0]


class Letters:
    """Random letter vectors, and trigram vectors bound from them."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 7):
        self.dimensions, self.seed, self.known = dimensions, seed, {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.known:
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions, np.int8)
            self.known[code] = bits * np.int8(2) - np.int8(1)
        return self.known[code]

    def binder(self, alphabet: np.ndarray):
        """A function that gives the vectors of trigrams, numbers to the base len(alphabet), as floats."""
        own = np.stack([self.letter(int(c)) for c in alphabet])
        once, twice, k = np.roll(own, 1, axis=1), np.roll(own, 2, axis=1), len(alphabet)

        def bound(codes: np.ndarray) -> np.ndarray:
            found = twice[codes // (k * k)]
            found *= once[codes // k % k]
            found *= own[codes % k]
            return found.astype(np.float32)

        return bound


def trigram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(alphabet, trigrams as numbers to the base of its size, text of each trigram)."""
    lowered = [" " + t.lower() for t in texts]
    codes = code_points("\x00".join(lowered) + "\x00")
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in lowered])
    is_letter = letters()[codes]
    # the border before each text, then letters and the first of each run of others
    keep = is_letter | np.concatenate([[True], is_letter[:-1]]) | np.concatenate([[True], owner[1:] != owner[:-1]])
    codes, owner = np.where(is_letter, codes, BORDER)[keep], owner[keep]
    alphabet, place = _alphabet(codes)
    k = len(alphabet)
    whole = (place[:-2] * k + place[1:-1]) * k + place[2:]
    good = (owner[:-2] == owner[2:]) & (codes[1:-1] != BORDER)
    return alphabet, whole[good], owner[:-2][good]


def _alphabet(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    seen = np.zeros(int(codes.max()) + 1, bool)
    seen[codes] = True
    alphabet = np.flatnonzero(seen)
    place = np.zeros(len(seen), np.int64)
    place[alphabet] = np.arange(len(alphabet))
    return alphabet, place[codes]


def prototypes(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = 7) -> tuple[list[str], np.ndarray]:
    """Languages in order of name and their unit prototypes, from rows (text, lang) with a language.

    Each task bundles the texts it reads and sends one vector per language; Spark adds them up. What
    comes to the driver is languages x dimensions numbers, whatever the number of texts.
    """
    schema = pa.schema([("lang", pa.string()), ("dimension", pa.int32()), ("value", pa.int64())])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sums = Letters(dimensions, seed), {}
        for columns, texts in groups(batches):
            if not any(texts):
                continue
            alphabet, codes, owner = trigram_codes(texts)
            langs = np.array(columns["lang"])
            distinct, place = np.unique(codes, return_inverse=True)
            if not len(distinct):
                continue
            times = {
                lang: np.bincount(place[(langs == lang)[owner]], minlength=len(distinct)).astype(np.float32)
                for lang in set(columns["lang"])
            }
            bind = vectors.binder(alphabet)
            for at in range(0, len(distinct), BLOCK):
                bound = bind(distinct[at : at + BLOCK])
                for lang, mine in times.items():
                    sums[lang] = sums.get(lang, 0) + np.rint(mine[at : at + BLOCK] @ bound).astype(np.int64)
        for lang, value in sums.items():
            yield rows(schema, [lang] * dimensions, np.arange(dimensions, dtype=np.int32), value)

    taught = docs.where(F.col("lang").isNotNull()).select("lang", "text")
    found = (
        taught.mapInArrow(bundle, "lang string, dimension int, value long")
        .groupBy("lang", "dimension")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    if found.empty:
        return [], np.zeros((0, dimensions))
    wide = found.pivot(index="lang", columns="dimension", values="value").sort_index().astype(float)
    matrix = wide.to_numpy()
    lengths = np.linalg.norm(matrix, axis=1)
    kept = lengths > 0
    return [x for x, k in zip(wide.index, kept) if k], matrix[kept] / lengths[kept, None]


def predict(docs: DataFrame, languages: list[str], matrix: np.ndarray, seed: int = 7) -> DataFrame:
    """doc_id, lang_pred, score: the nearest language and the cosine to its prototype (0 at least)."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    dimensions = matrix.shape[1] if len(languages) else 0
    matrix = matrix.astype(np.float32)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Letters(dimensions, seed)
        for columns, texts in groups(batches):
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            alphabet, codes, owner = trigram_codes(texts)
            if len(codes) and languages:
                distinct, place = np.unique(codes, return_inverse=True)
                bind = vectors.binder(alphabet)
                # few trigrams are bound once for all texts of the batch, many per text
                whole = bind(distinct) if len(distinct) <= BLOCK else None
                place = place.astype(np.int32)
                ends = np.searchsorted(owner, np.arange(len(texts) + 1))
                for i in range(len(texts)):
                    used, times = np.unique(place[ends[i] : ends[i + 1]], return_counts=True)
                    if len(used):
                        profile = np.zeros(dimensions, np.float32)
                        for at in range(0, len(used), BLOCK):
                            part = used[at : at + BLOCK]
                            profile += times[at : at + BLOCK].astype(np.float32) @ (bind(distinct[part]) if whole is None else whole[part])
                        near = matrix @ profile / max(1e-9, float(np.linalg.norm(profile)))
                        k = int(np.argmax(near))
                        best[i], score[i] = languages[k], min(1.0, max(0.0, float(near[k])))
            yield rows(schema, columns["doc_id"], best, score)

    return docs.select("doc_id", "text").mapInArrow(nearest, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Learn from the rows outside the held-out fold of crc32(doc_id), predict every row."""
    kept = docs.where(fold(F.col("doc_id"), folds) != held_out)
    found = predict(docs, *prototypes(kept))
    return found.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score"
    )
