"""The training-data operators against brute force, held-out labels and awkward rows."""

import difflib
import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from brute import without_passages
from checks.compare import differences, duck
from tickloom.llm import (
    components,
    cutting_stock,
    interpolation,
    kneser_ney,
    langid,
    line_dedup,
    mixing,
    prefix_hash,
    queries,
    risk_rules,
    simhash,
    token_store,
    toxicity,
)
from tickloom.llm.oracles import ORACLES
from tickloom.llm.tokens import Encoder

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
FORM = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, rate double, text_key long, removed string, bucket int"
TEXTS = [
    None, "", " ", "one", "the same line of five words\nthe same line of five words", "É\x1cx ñ\U0001f600 it's DON'T 12a.b",
    "word " * 30_000, "the quick brown fox jumps over it\nlazy", "the quick brown fox jumps over it\nlazy", "1d10t m0ron!!!",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, None, None, 1.0, 2, 3.0, 4, "x", 5) for i, t in enumerate(TEXTS)]
    rows += [(7, TEXTS[7], "en", "s", 1, None, None, None, None, None, None), (None, "no id here at all", None, *[None] * 8)]
    return spark.createDataFrame(rows, FORM)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (3, 0, 1), (3, 1, 0), (5, None, None), (None, 1, 1), (7, 1, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def operators(tmp):
    return {
        "toxicity": lambda d, l: toxicity.score(d, l),
        "mixing": lambda d, l: mixing.rates(d, queries.domains(d, l), {"en": 1.0}),
        "prefix": lambda d, l: prefix_hash.next_document_fingerprints(d, buckets=3),
        "langid": lambda d, l: langid.identify(d),
        "simhash": lambda d, l: simhash.near_duplicates(d),
        "rules": lambda d, l: risk_rules.judge(d, l),
        "lines": lambda d, l: line_dedup.without_repeats(d),
        "kneser": lambda d, l: kneser_ney.judge(d, l),
    }


@pytest.mark.parametrize("name", list(operators(None)))
def test_awkward_rows_and_empty_tables(spark, odd, labels, name):
    run = operators(None)[name]
    ids = lambda df: Counter(r[0] for r in df.select("doc_id").collect())
    assert ids(run(odd, labels)) == ids(odd)
    assert run(odd.limit(0), labels).count() == 0
    assert ids(run(odd.limit(3), labels.limit(0))) == ids(odd.limit(3))


@pytest.mark.parametrize("name", [*operators(None), "store", "packing", "interpolation"])
def test_texts_longer_than_a_batch(spark, labels, tmp_path, name):
    """One text of more characters than any operator handles at once, between short ones."""
    long = " ".join(f"w{k * 7919 % 300_007}" for k in range(640_000))
    assert len(long) > 4_000_000
    docs = spark.createDataFrame([(1, "a short text of a few words", "en"), (3, long, "en"), (5, "the last one", None)], "doc_id long, text string, lang string")
    docs = docs.withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    if name == "store":
        token_store.write_store(docs, queries.tokenizer(), f"{tmp_path}/s", shards=2)
        found = token_store.read_store(spark, f"{tmp_path}/s").collect()
        whole = Tokenizer.from_file(queries.tokenizer()).encode(long, add_special_tokens=False).ids
        assert {r["doc_id"]: r["n_tokens"] for r in found}[3] == len(whole) + 1
    elif name == "packing":
        found = cutting_stock.pack(docs, queries.tokenizer()).toPandas()
        assert found.groupby("doc_id")["length"].sum().eq(found.groupby("doc_id")["doc_tokens"].max()).all()
    elif name == "interpolation":
        found = {r["doc_id"]: r["n_tokens"] for r in interpolation.score(docs).collect()}
        assert found == {1: 8, 3: 640_001, 5: 4}
    else:
        assert {r[0] for r in operators(None)[name](docs, labels).select("doc_id").collect()} == {1, 3, 5}


def test_stages_keep_the_columns_of_documents(spark, odd, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, str(tmp_path))
            assert found.columns == docs.columns or found.columns == [c for c in docs.columns]
            found.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()
    kept = corpus_pipeline.one_of_each_group(spark, odd, str(tmp_path))
    assert sorted(r[0] for r in kept.select("doc_id").collect() if r[0] is not None) == [0, 3, 4, 5, 6, 7, 9]


def test_store_and_pieces_hold_the_tokenizers_ids(spark, odd, tmp_path):
    whole = Tokenizer.from_file(queries.tokenizer())
    want = Counter()
    for r in odd.collect():
        ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        want[r["doc_id"], len(ids), zlib.crc32(ids.tobytes())] += 1
    token_store.write_store(odd, queries.tokenizer(), f"{tmp_path}/s", shards=3)
    found = token_store.read_store(spark, f"{tmp_path}/s").orderBy("start").collect()
    assert Counter((r["doc_id"], r["n_tokens"], zlib.crc32(r["ids"])) for r in found) == want
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found)])[:-1].tolist()
    assert [r["doc_id"] for r in found[1:]] == sorted(r["doc_id"] for r in found[1:])
    packed = cutting_stock.pack(odd, queries.tokenizer()).toPandas()
    assert packed["length"].sum() == sum(r["n_tokens"] for r in found)
    for _, s in packed.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"] == s["length"].cumsum() - s["length"]).all() and s["length"].sum() <= 2048
    token_store.write_store(odd.limit(0), queries.tokenizer(), f"{tmp_path}/e")
    assert token_store.read_store(spark, f"{tmp_path}/e").count() == 0
    assert cutting_stock.pack(odd.limit(0), queries.tokenizer()).count() == 0


def test_added_tokens_are_ids_of_their_own(spark, tmp_path):
    whole = Tokenizer.from_file(queries.tokenizer())
    texts = [
        "a b <|endoftext|> c", "<|startoftext|>The Cat<|endoftext|><|endoftext|>", "x<|ENDOFTEXT|>y <|endoftext|", "<|endoftext|>",
        "it's<|endoftext|>'s \u00e9<|startoftext|>\u0301e 12\n<|endoftext|>\n", "plain words only", "", "<<|endoftext|>|endoftext|>",
    ]
    want = {k: [*whole.encode(t, add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    assert want[0] == [320, 321, 49407, 322, 1]
    ids, borders = Encoder(queries.tokenizer()).encode(texts)
    assert {k: ids[a:b].tolist() for k, (a, b) in enumerate(zip(borders, borders[1:]))} == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_store.write_store(docs, queries.tokenizer(), f"{tmp_path}/s", shards=2)
    found = token_store.read_store(spark, f"{tmp_path}/s").collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in found} == want
    crcs = {r["doc_id"]: r["ids_crc32"] for r in cutting_stock.pack(docs, queries.tokenizer()).collect()}
    assert crcs == {k: zlib.crc32(np.array(v, "<u4").tobytes()) for k, v in want.items()}


def test_planes_come_back():
    ids = np.random.default_rng(1).integers(0, 49_408, 10_001).astype(np.uint32)
    assert (token_store.join_planes(token_store.shuffle_planes(ids), len(ids)) == ids).all()
    doc_ids, counts, back = token_store.unpack(token_store.pack([5, 6], [1, 10_000], ids))
    assert doc_ids == [5, 6] and counts.tolist() == [1, 10_000] and (back == ids).all()


def test_the_smallest_id_is_not_a_missing_one(spark, tmp_path):
    rows = [(None, "a"), (-(2**63), "b c"), (None, "d"), (0, "e")]
    token_store.write_store(spark.createDataFrame(rows, "doc_id long, text string"), queries.tokenizer(), f"{tmp_path}/s", shards=2)
    found = token_store.read_store(spark, f"{tmp_path}/s").orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [None, None, -(2**63), 0]


def test_patterns_meet_the_demand():
    demand = np.random.default_rng(2).integers(0, 300, 64)
    found = cutting_stock.patterns(demand)
    assert (sum(p * n for p, n in found) == demand).all()
    size = np.arange(1, 65)
    assert all((p * size).sum() <= 64 for p, _ in found)
    assert sum(n for _, n in found) <= sum(n for _, n in cutting_stock.first_fit(demand))


def test_short_pieces_fill_their_sequences(spark):
    lengths = {"same": [17] * 1200, "empty": [1] * 4096, "mixed": np.random.default_rng(3).integers(1, 65, 3000).tolist()}
    for name, sizes in lengths.items():
        docs = spark.createDataFrame([(k, "a " * (n - 1)) for k, n in enumerate(sizes)], "doc_id long, text string")
        found = cutting_stock.pack(docs, queries.tokenizer()).toPandas()
        assert sorted(found["length"]) == sorted(sizes), name
        assert found.groupby("sequence_id")["length"].sum().max() <= 2048, name
        assert found["sequence_id"].nunique() <= math.ceil(sum(sizes) / 2040), name


def test_classes_hold_their_lengths(spark):
    for length in (2048, 1000, 100):
        sizes = cutting_stock.class_sizes(length)
        found = spark.range(1, length + 1).select("id", cutting_stock.class_of(F.col("id"), length)).collect()
        assert [r[1] for r in found] == (np.searchsorted(sizes, np.arange(1, length + 1)) + 1).tolist()
        assert all(sizes[c - 1] - n < n / cutting_stock.EXACT for n, c in found) and sizes[-1] == length


def test_linear_program_of_the_documents_lengths(spark):
    """Pricing runs, its dual values bound the optimum, and rounding stays close to it."""
    sizes = cutting_stock.class_sizes(2048)
    cut = cutting_stock.pieces(spark.read.parquet(f"{MIDDLE}/documents.parquet"), queries.tokenizer()).select("length").toPandas()
    demand = np.bincount(np.searchsorted(sizes, cut["length"]), minlength=len(sizes))
    report = {}
    found = cutting_stock.patterns(demand, sizes, report=report)
    assert (sum(p * n for p, n in found) == demand).all() and all(p @ sizes <= 2048 for p, _ in found)
    assert report["pricings"] > 10 and report["bound"] <= report["total"] <= 1.001 * report["bound"]
    assert sum(n for _, n in found) <= math.ceil(1.005 * report["bound"])


def test_dual_bound_is_one():
    """Where the best packing is known: three of 0.34 never share a sequence."""
    demand, report = np.zeros(100, np.int64), {}
    demand[33], demand[65] = 300, 10  # sizes 34 and 66
    found = cutting_stock.patterns(demand, report=report)
    assert sum(n for _, n in found) == 155 and report["bound"] <= 155.0 + 1e-6 and report["total"] >= 155.0 - 1e-6


def test_column_generation_beats_first_fit():
    sizes, lengths = cutting_stock.class_sizes(2048), np.random.default_rng(4).integers(600, 1100, 100_000)
    demand = np.bincount(np.searchsorted(sizes, lengths), minlength=len(sizes))
    found = cutting_stock.patterns(demand, sizes)
    assert (sum(p * n for p, n in found) == demand).all() and all(p @ sizes <= 2048 for p, _ in found)
    assert sum(n for _, n in found) < 0.98 * sum(n for _, n in cutting_stock.first_fit(demand, sizes))


def test_extensions_and_spans():
    a, b = "the cat sat on the mat", "a cat sat on the rug"
    x, y = (prefix_hash.Prefixes(prefix_hash.code_points(t)) for t in (a, b))
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            assert x.extension(i, y, j) == n


def test_likeness_at_any_offset():
    rng = np.random.default_rng(9)
    prose = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n))
    mark = prefix_hash.Marked
    text, other = prose(200)[:1000], prose(200)
    one = mark(text)
    assert str(mark(text)) == str(one) and one.likeness(mark(text)) == 1.0
    assert one.likeness(mark("x" + text + "y")) > 0.95
    assert one.likeness(mark(text[:300] + "#" + text[300:700] + "#" + text[700:])) > 0.95
    assert one.likeness(mark("a header that was put in front\n\n" + text)) > 0.9
    assert one.likeness(mark(text[500:] + text[:500])) > 0.95
    assert one.likeness(mark(other)) < 0.2 and mark(other).likeness(one) < 0.2
    assert one.likeness(mark("")) == 0.0 and mark("").likeness(mark("")) == 1.0
    assert mark("short").likeness(mark("shirt")) == 0.8 and mark("a").likeness(mark("b")) == 0.0
    long = prose(30_000)
    spread = "".join(c if k % 4000 else "#" for k, c in enumerate(long))
    assert mark(long).likeness(mark(spread)) > 0.95
    assert 0 <= mark("ab" * 3000).likeness(mark("ab" * 2000 + "cd" * 500)) <= 1
    line = "one line that stands there again and again, with nothing new in it\n"
    assert mark(line * 2000).likeness(mark("x" + line * 1500 + prose(100) + line * 1500)) > 0.6


def common_stretches(a, b, least):
    """Characters of the longer text in common stretches, greedily the longest first, by definition."""
    free_a, free_b, total = [(0, len(a))], [(0, len(b))], 0
    while True:
        best = (0, 0, 0)
        for low, high in free_a:
            for under, over in free_b:
                m = difflib.SequenceMatcher(None, a[low:high], b[under:over], autojunk=False).find_longest_match()
                best = max(best, (m.size, low + m.a, under + m.b))
        size, i, j = best
        if size < least:
            return total / max(len(a), len(b))
        total += size
        free_a = [p for low, high in free_a for p in ([(low, i), (i + size, high)] if low <= i < high else [(low, high)]) if p[0] < p[1]]
        free_b = [p for low, high in free_b for p in ([(low, j), (j + size, high)] if low <= j < high else [(low, high)]) if p[0] < p[1]]


def test_likeness_is_near_the_longest_common_stretches(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars between 300 and 1200").orderBy("doc_id").limit(14).collect()
    texts = [r["text"] for r in rows]
    for k, a in enumerate(texts):
        b = texts[(k + 1) % len(texts)]
        for c in (b, a[: len(a) // 2] + b[:200] + a[len(a) // 2 :], b[:100] + a[50:-50]):
            found, want = prefix_hash.Marked(a).likeness(prefix_hash.Marked(c)), common_stretches(a, c, 100)
            assert abs(found - want) < 0.15, (k, found, want)


def test_next_document_is_the_next_lower_id(spark):
    found = {r["doc_id"]: r for r in queries.QUERIES["op3_prefix_fingerprints"](spark, SMALL).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    for here, following in zip(order, [*order[1:], order[0]]):
        cut = len(texts[here]) // 3
        edited = texts[here][: len(texts[here]) - cut] + texts[following][:cut]
        assert found[here]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert found[here]["near_edited"] > 0.6 > found[here]["near_next"]


def brute_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_by_definition():
    for t in ["", "One", "a b", "A b c d e f g a b c", "x\x1cy  z\n w é"]:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_anchors_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    values = [int(b) ^ sum(1 << int(i) for i in rng.choice(64, k, replace=False)) for b in base for k in (0, 1, 2, 2, 3)]
    values = np.unique(np.array([0, 1, 3, 7, *values], np.uint64)).view(np.int64)
    want = {
        (int(min(a, b)), int(max(a, b)))
        for i, a in enumerate(values)
        for b in values[i + 1 :]
        if (int(a) ^ int(b)).bit_count() <= 2 or ((int(a) ^ int(b)) & (2**64 - 1)).bit_count() <= 2
    }
    found = simhash.links(spark.createDataFrame([(int(v),) for v in values], "fp long")).collect()
    assert sorted((r["a"], r["b"]) for r in found) == sorted(want)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = Counter(r["label"] for r in found)
    assert len(found) == 71 and sorted(groups.values()) == [30, 41]


@pytest.mark.parametrize("name", list(ORACLES))
def test_reference_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name]).startswith("= ")


def test_passages_at_any_place(spark):
    """Copies, near copies, overlaps, borders of 49, 50 and 51 words, many tasks."""
    rng = np.random.default_rng(5)
    fresh = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    shared = {n: fresh(n) for n in (49, 50, 51, 400)}
    found = [fresh(200), "a " * 300, None, "", "x\n" * 49, "Y\ty " * 60]
    found += [fresh(int(k)) + " \n" + p.upper() + "\t" + fresh(int(k % 7)) for p in shared.values() for k in rng.integers(0, 90, 6)]
    found += [found[0], found[0].upper(), found[0] + " more", "less " + found[0], shared[400][40:], found[0]]
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(docs).collect()}
    want = without_passages({k: t or "" for k, t in enumerate(found)})
    assert {k: t or "" for k, t in got.items()} == want and got[2] is None
    changed = {k for k, t in enumerate(found) if want[k] != (t or "")}
    assert not changed & set(range(6, 12)) and set(range(13, 18)) <= changed


def test_units_do_not_depend_on_their_surroundings():
    rng = np.random.default_rng(6)
    passage = " ".join(f"w{x}" for x in rng.integers(0, 500, 300))
    texts = ["", "one", passage, "some words before it " + passage + " and behind"]
    hashes, borders = line_dedup.word_hashes(texts)
    starts, ends, owner, digests = line_dedup.units(hashes, borders)
    alone, inside = (set(zip((starts - borders[k])[owner == k] - shift, digests[owner == k])) for k, shift in ((2, 0), (3, 4)))
    assert alone <= inside and len(alone) > 10 and (ends - starts > line_dedup.REACH).all()


def test_binomial_tail(spark):
    cases = [(0, 100), (3, 900), (7, 2000), (50, 100)]
    df = spark.createDataFrame([(float(k), float(n)) for k, n in cases], "k double, n double")
    found = [r[0] for r in df.select(risk_rules.at_most(F.col("k"), F.col("n"), 0.006)).collect()]
    for (k, n), p in zip(cases, found):
        exact = sum(math.comb(n, j) * 0.006**j * 0.994 ** (n - j) for j in range(k + 1))
        assert p == pytest.approx(exact if k <= n * 0.006 else 1.0, rel=1e-9)


def brute_perplexities(trusted, texts):
    """Interpolated modified Kneser-Ney by its definition, over dictionaries of characters."""

    def symbols(text):
        spaced = re.sub("[\t\n\x0b\x0c\r \x85\xa0]+", " ", text.lower()).lstrip(" ") + " "
        return "   " + re.sub(" +$", " ", spaced)

    def grams(text):
        s = symbols(text)
        return [s[i - 3 : i + 1] for i in range(3, len(s))]

    counts = {4: Counter(g for t in trusted for g in grams(t))}
    for order in (3, 2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    discounts, totals, kinds = {}, {}, {}
    for order, seen_grams in counts.items():
        n = [max(1, sum(v == i for v in seen_grams.values())) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        discounts[order] = [min(max(d, 0.1), i + 0.95) for i, d in enumerate(raw)]
        for g, v in seen_grams.items():
            totals[order, g[:-1]] = totals.get((order, g[:-1]), 0) + v
            kinds.setdefault((order, g[:-1]), []).append(min(v, 3))

    def p(gram):
        order = len(gram)
        if not order:
            return 1 / kneser_ney.SYMBOLS
        seen = (order, gram[:-1])
        if seen not in totals:
            return p(gram[1:])
        v, d = counts[order][gram], discounts[order]
        own = max(0, v - d[min(v, 3) - 1]) if v else 0
        return (own + sum(d[k - 1] for k in kinds[seen]) * p(gram[1:])) / totals[seen]

    return [2 ** (-sum(math.log2(p(g)) for g in grams(t)) / len(grams(t))) for t in texts]


def test_perplexities_by_definition(spark, monkeypatch):
    """Sent to the tasks and joined, in four scripts."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars < 1500").orderBy("doc_id").limit(40).collect()
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in rows if r["text"].strip()]
    more = ["Съешь ещё этих мягких французских булок", "Съешь же  ещё\n булок этих", "我能吞下玻璃而不伤身体。我能", "玻璃不伤身体", " \u03b1\u03b2\u03b3 \u03b1\u03b2", "\tx\u00a0y "]
    rows += [(10_000 + k, t, "ru") for k, t in enumerate(more)]
    trusted = [r for i, r in enumerate(rows) if i % 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1) for r in trusted], "doc_id long, quality int")
    want = brute_perplexities([r[1] for r in trusted], [r[1] for r in rows])
    for limit in (kneser_ney.BROADCAST, 0):
        monkeypatch.setattr(kneser_ney, "BROADCAST", limit)
        found = {r["doc_id"]: r["perplexity"] for r in kneser_ney.judge(docs, labels).collect()}
        assert [found[r[0]] for r in rows] == pytest.approx(want, rel=1e-9)


def test_kneser_ney_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat. the end"), (2, "zz9 q \u044f")], "doc_id long, text string")
    model = kneser_ney.Model(kneser_ney.train(docs, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")))
    last = np.arange(kneser_ney.SYMBOLS, dtype=np.uint64)
    for context in ("the", " ca", "xyz", "   ", "z\u044fq"):
        before = np.uint64(0)
        for c in context:
            before = before << np.uint64(16) | np.uint64(ord(c))
        assert model.probabilities((before << np.uint64(16) | last).view(np.int64)).sum() == pytest.approx(1, abs=1e-9)


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    wanted = queries.domains(docs, spark.read.parquet(f"{MIDDLE}/labels.parquet"))
    found = mixing.rates(docs, wanted, queries.WEIGHTS).toPandas()
    totals = (np.stack(found["posterior"]) * (found["rate"] * found["tokens"]).to_numpy()[:, None]).sum(axis=0)
    targets = [queries.WEIGHTS.get(d, 0.0) for d in found["domains"][0]]
    assert np.allclose(totals / totals.sum(), targets, atol=0.005) and (found["rate"] >= 0).all()
    assert np.allclose(found["reached"][0], totals, rtol=1e-6)
    assert np.allclose(np.array(found["targets"][0]) / sum(found["targets"][0]), targets)


def test_posteriors_by_definition(spark):
    """Naive Bayes over the chosen characters, in plain Python, with domains of two alphabets."""
    rng = np.random.default_rng(11)
    rows, labels = [], []
    for k, (alphabet, domain) in enumerate([("абвгдежз", "ru"), ("абвгijkl", "mixed"), ("теснория", "bg"), ("abcdefgh", "en")] * 30):
        rows.append((k, " ".join("".join(rng.choice(list(alphabet), 5)) for _ in range(30)) + " Ab#1"))
        labels += [(k, domain)] if k % 3 else []
    docs = spark.createDataFrame([*rows, (999, None)], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, domain string")
    found = mixing.rates(docs, marks, {"ru": 0.5, "en": 0.5}).collect()
    letters = mixing.telling_characters(docs, marks)
    assert set("жзтиabcdijkl") & set(letters) and len(letters) == mixing.CHARACTERS

    def counts(text):
        low = text.lower()
        got = [low.count(c) for c in letters]
        got += [len(re.findall(r"[#*$%&|<>!]", text)), sum(c.isupper() for c in text)]
        return np.array([*got, max(0, len(text) - sum(got))], float)

    texts, domains = dict(rows), sorted({d for _, d in labels})
    sums = {d: sum(counts(texts[k]) for k, e in labels if e == d) + 1 for d in domains}
    priors = np.log([sum(e == d for _, e in labels) / len(labels) for d in domains])
    logs = np.array([np.log(sums[d] / sums[d].sum()) for d in domains])
    for r in found:
        c = counts(texts.get(r["doc_id"], ""))
        score = priors + mixing.EVIDENCE / math.sqrt(max(1, c.sum())) * (logs @ c)
        want = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
        assert np.allclose(r["posterior"], want, atol=1e-9)
    right = sum(r["domains"][int(np.argmax(r["posterior"]))] == ["ru", "mixed", "bg", "en"][r["doc_id"] % 4] for r in found if r["doc_id"] != 999)
    assert right == len(rows)


def test_held_out_labels(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    tox = queries.QUERIES["op1_toxicity"](spark, MIDDLE).where("held_out").join(labels, "doc_id").toPandas()
    assert (tox["toxic"] == tox["predicted"]).mean() > 0.9
    lang = queries.QUERIES["op4_language"](spark, MIDDLE).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (lang["lang"] == lang["lang_pred"]).mean() > 0.98


def test_short_texts_have_a_language(spark):
    taught = [(k, t, lang) for k, (t, lang) in enumerate([("a b c the", "en"), ("я и ты", "ru")] * 20)]
    asked = [(100, "a", None), (101, "x", None), (102, "I.", None), (103, "a 1", None), (104, "12 !", None), (105, "и", None)]
    found = langid.identify(spark.createDataFrame(taught + asked, "doc_id long, text string, lang string"))
    got = {r["doc_id"]: r["lang_pred"] for r in found.collect()}
    assert got[104] == "und" and got[100] == got[103] == "en" and got[105] == "ru" and "und" not in (got[101], got[102])


def test_blocks_of_trigrams_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole = {r["doc_id"]: (r["lang_pred"], round(r["score"], 5)) for r in langid.identify(docs).collect()}
    languages, matrix = langid.prototypes(docs)
    monkeypatch.setattr(langid, "BLOCK", 50)
    again, other = langid.prototypes(docs)
    assert again == languages and np.allclose(matrix, other)
    texts = [t for t in ("".join(map(chr, range(0x4E00, 0x4E00 + 3000))), "abc")]
    alphabet, codes, _ = langid.trigram_codes(texts)
    bind = langid.Letters().binder(alphabet)
    assert bind(codes[:200]).shape == (200, langid.DIMENSIONS) and len(whole) == docs.count()


def test_risk_rules_use_cutoffs(spark, tmp_path):
    """Over a thousand good texts per language: cutoffs pass, fail at a tie and differ, as in SQL."""
    rng, rows, labels = np.random.default_rng(8), [], []
    # of 40 plain words and m marked ones: en has 30 texts exactly at 0.2, de two at 0.33
    for lang, n, few, marked in (("en", 1500, 30, 10), ("de", 1400, 2, 20), (None, 1300, 0, 0), ("fr", 300, 0, 0)):
        for k in range(n + 60):
            good = k < n
            words = [f"w{x}" for x in rng.integers(0, 10**6, 40)]
            words += [f"#{x}" for x in rng.integers(0, 10**6, marked if k < few else 4 if good and k % 3 else 2 if good else 60)]
            rows.append((len(rows), " ".join(words), lang, "s", 1))
            if good:
                labels.append((len(rows) - 1, 1, 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/d")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/l")
    docs, marks = spark.read.parquet(f"{tmp_path}/d"), spark.read.parquet(f"{tmp_path}/l")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    con.execute(f"CREATE VIEW labels AS SELECT * FROM '{tmp_path}/l/*.parquet'")
    judged = risk_rules.judge(docs, marks)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert differences(judged.select(*names), con, ORACLES["op7_risk_rules"]).startswith("= ")
    kept = judged.groupBy("lang").agg(F.sum((~F.col("kept")).cast("int")).alias("gone")).collect()
    gone = {r["lang"]: r["gone"] for r in kept}
    assert gone == {"en": 60, "de": 60, None: 60, "fr": 0}
    figures = risk_rules.statistics(docs)
    cuts = {r["lang"]: r["cut_symbols"] for r in risk_rules.cutoffs(figures, risk_rules.good_ids(marks)).collect()}
    assert cuts == {"en": 0.2, "de": 0.5, None: 0.1, "fr": None}


def test_restored_spellings():
    counts = np.zeros((64,) * 3)
    for w in "you are an idiot and a loser people look good see this clown moron stupid".split() * 50:
        s = [0, 0, *map(toxicity.symbol, w), 0]
        for a, b, c in zip(s, s[1:], s[2:]):
            counts[a, b, c] += 1
    model = np.log((counts + 0.05) / (counts.sum(axis=-1, keepdims=True) + 3.2)).astype(np.float32)
    cases = {"an 1d10t": "an idiot", "i d i o t": "idiot", "l.o.s.e.r": "loser", "looooser": "loser", "look good": "look good"}
    cases |= {"(lown": "clown", "!diot": "idiot", "iiddiioott": "idiot", "mmoorroonn": "moron", "(see this)": "see this)"}
    cases |= {"i  d  i\n o  t": "idiot", "$ t u p ! d": "stupid", "l\no\ns\ne\nr": "loser"}
    assert {k: toxicity.restore(k, model) for k in cases} == cases
