"""Token ids of whole texts by a public tokenizer file, computed once per distinct word of a batch.

A tokenizer whose pre-tokenizer never joins text across ASCII white space encodes a text as it
encodes the text's words one after another. So a batch is split at ASCII white space by Arrow, each
distinct word goes through the tokenizer once, and the ids are gathered per text. A space is also set
between an ASCII letter and ASCII punctuation other than the apostrophe, where word_bpe_49k.json
starts a new word anyway; that makes words fewer. Short words met early stay in a store, which is
bounded in bytes and lives as long as its task: a worker process keeps the tokenizer alone.

The file's added tokens are found in the text as it stands, before anything is lower-cased, and have an
id each; texts are cut at them first. In the words between, the same letters in upper case are ordinary text.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that the words kept by a task and their ids may take; further words are encoded in every batch.
KEPT_BYTES = 8_000_000
#: Bytes of a word that may be kept.
KEPT_WORD = 32
#: Characters that are encoded at once.
BATCH_CHARS = 1_000_000
END = 1

# Words that only the merges change: lower case, one code point a letter, nothing to normalise.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
# A byte's letter in byte-level vocabularies: itself if printable Latin-1, else the next free one from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: chr(b) for b in _PRINTED}
_BYTE_LETTERS |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _BYTE_LETTERS)}


@cache
def _loaded(path: str):
    """The file's tokenizer, for texts between added tokens: "<|ENDOFTEXT|>" in lower case is none."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


class Encoder:
    """One per task; the words it keeps go with it."""

    def __init__(self, path: str):
        self.between = _loaded(path)
        tokens = self.between.get_added_tokens_decoder()
        if any(not t.special or t.normalized or t.single_word or t.lstrip or t.rstrip for t in tokens.values()):
            raise ValueError(f"{path}: an added token is not plain text")
        self.added = {t.content: k for k, t in tokens.items()}
        # of tokens that begin at the same place the longest is taken
        self.any_added = "(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")"
        self.words = pa.array([], pa.large_string())  # kept words; word k has ids[ends[k]:ends[k + 1]]
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each). Plain words go to the model itself."""
        merge, whole, plain = self.between.model.tokenize, self.between.encode, _PLAIN.fullmatch
        ids, counts = [], []
        for word in words:
            if plain(word):
                if not word.isascii():
                    word = "".join([_BYTE_LETTERS[b] for b in word.encode()])
                found = [t.id for t in merge(word)]
            else:
                found = whole(word, add_special_tokens=False).ids
            ids += found
            counts.append(len(found))
        return np.array(ids, np.uint32), np.array(counts, np.int64)

    def _keep(self, words: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        lengths = pc.binary_length(words).to_numpy(zero_copy_only=False)
        short = np.flatnonzero(lengths <= KEPT_WORD)
        taken = self.words.nbytes + self.ids.nbytes + self.ends.nbytes
        # a word costs its bytes, its ids and two offsets
        room = taken + np.cumsum(lengths[short] + 4 * counts[short] + 16) <= KEPT_BYTES
        short = short[room]
        if len(short):
            stops = np.cumsum(counts)
            whole = np.concatenate([ids[a:b] for a, b in zip((stops - counts)[short].tolist(), stops[short].tolist())])
            self.words = pa.concat_arrays([self.words, words.take(pa.array(short))])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts[short])])
            self.ids = np.concatenate([self.ids, whole])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; border of each text in them: len(texts) + 1)."""
        whole = pa.array(texts, pa.large_string())
        if not self.added or not pc.any(pc.match_substring_regex(whole, self.any_added), min_count=0).as_py():
            return self._encode_parts(whole)
        parts, ends, stops = [], [], [0]
        for text in texts:
            found = re.split(self.any_added, text)
            parts += found[::2]
            ends += [*(self.added[t] for t in found[1::2]), END]
            stops.append(len(parts))
        ids, borders = self._encode_parts(pa.array(parts, pa.large_string()))
        # every part got the end id; behind all but a text's last part stands an added token instead
        ids[borders[1:] - 1] = ends
        return ids, borders[stops]

    def _encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As `encode`, for texts without added tokens."""
        spaced = pc.replace_substring_regex(pc.ascii_lower(parts), r"([a-z])([.,!?;:*#$%&|])", r"\1 \2")
        split = pc.ascii_split_whitespace(spaced)
        # an empty word stands where white space begins or ends a text; it has no ids
        words = split.values.dictionary_encode()
        distinct = words.dictionary
        known = pc.index_in(distinct, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        missing = np.flatnonzero(known < 0)
        new_words = distinct.take(pa.array(missing))
        new_ids, new_counts = self._encode(new_words.to_pylist())
        # the pool: kept words, this batch's new words, the end id
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(new_counts)])
        pool = np.concatenate([self.ids, new_ids, np.array([END], np.uint32)])
        place = known.astype(np.int64)
        place[missing] = len(self.words) + np.arange(len(missing))
        starts = np.append(ends[place], len(pool) - 1)
        counts = np.append(ends[place + 1] - ends[place], 1)
        self._keep(new_words, new_ids, new_counts)
        borders = split.offsets.to_numpy() - split.offsets[0].as_py()
        indices = words.indices.to_numpy(zero_copy_only=False)
        order = np.insert(indices, borders[1:], len(distinct))
        sizes = counts[order]
        stops = np.cumsum(sizes)
        places = np.arange(int(stops[-1]) if len(stops) else 0)
        places += np.repeat(starts[order] - (stops - sizes), sizes)
        word_ends = borders[1:] + np.arange(1, len(parts) + 1)
        return pool[places], np.concatenate([[0], stops[word_ends - 1]])
