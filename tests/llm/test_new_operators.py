"""Sharding, periodic runs and collocations: nulls, empty, long and repeated
texts, clashing column names, empty tables, and plain-Python versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from encore.llm import collocations, runs, sharding

SCHEMA = ("doc_id long, text string, lang string, source string, _rid string, _size string, _shard int, "
          "_group string, k1 int, f string, w1 int, `a b` int, `c.d` int")
LOOP = "one two three " * 40
LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))
TEXTS = [(0, LOOP), (1, LOOP), (2, None), (3, ""), (4, " \n\t "), (None, LOOP), (None, None), (5, LONG), (6, "é ß\U0001F600 end"),
         (7, "A b, a B. a b c"), (7, "A b, a B. a b c"), (8, "a " * 500), (9, "x" * 4000)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if n % 3 else "en", "s", "r", "s", 3, "g", 1, "f", 2, 5, 6) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -- op11 -----------------------------------------------------------------------

def check_law(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))


def test_shards_of_odd_rows(docs, empty):
    rows = sharding.shard_documents(docs).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    check_law(rows, 16)
    assert sharding.shard_documents(empty).count() == 0


@pytest.fixture(scope="module")
def corpus(spark):
    """A third of all rows has one text, pairs and triples share others."""
    rng = random.Random(3)
    texts = ["the same text again and again " * 20] * 1000
    for g in range(250):
        texts += [f"group {g} " * rng.randint(5, 120)] * rng.choice((2, 3))
    texts += [f"alone {i} " * rng.randint(1, 200) for i in range(1400)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)


def test_shards_are_even_and_groups_whole(corpus):
    rows = sharding.shard_documents(corpus).collect()
    check_law(rows, 16)
    load, groups, size = Counter(), defaultdict(set), Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
        groups[r["text_crc32"]].add(r["shard"])
        size[r["text_crc32"]] += r["size"]
    mean = sum(load.values()) / 16
    assert len(load) == 16 and max(load.values()) - min(load.values()) < 0.01 * mean
    hot = max(size, key=size.get)
    # one shard cannot hold the hot group; it takes no more shards than needed and one
    assert size[hot] > mean and len(groups[hot]) <= size[hot] // mean + 2
    assert sum(len(s) > 1 for g, s in groups.items() if g != hot) <= 3


def test_links_of_several_groups_pull_to_one_shard(spark):
    """A ring of overlapping groups and free documents: linked ones end together."""
    nodes = spark.createDataFrame([(i, i, 10, i) for i in range(400)], "_rid long, _id long, _size long, _crc long")
    links = spark.createDataFrame([(i, f"g{i // 4}") for i in range(80)] + [(i, f"h{(i // 8)}") for i in range(80)],
                                  "_rid long, _group string")
    got = {r["_rid"]: r["_shard"] for r in sharding.assign(nodes, links, 4).collect()}
    load = Counter(got.values())
    assert set(load.values()) == {100}
    assert sum(len({got[i] for i in range(b, b + 8)}) > 1 for b in range(0, 80, 8)) <= 1


def test_large_documents_are_placed_first(spark):
    texts = ["x" * 5000, "y" * 4900, "z" * 200, "u" * 100, "v" * 90]
    rows = sharding.shard_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards=2)
    load = Counter()
    for r in rows.collect():
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) <= 300


def test_running_sums_cross_slices(spark):
    rows = [(i, "a" if i % 3 else "b", i % 7 + 1) for i in range(3000)]
    got = sharding.running_sum(spark.createDataFrame(rows, "i long, k string, v long"), "k", ["i"], "v", "s").collect()
    sums = Counter()
    want = {}
    for i, k, v in rows:
        sums[k] += v
        want[i] = sums[k]
    assert {r["i"]: r["s"] for r in got} == want


# -- op12 -----------------------------------------------------------------------

def brute_runs(w):
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            s = i
            while i < n and w[i] == w[i - q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                found.setdefault((s - q, i - s + q), q)
    return sorted((s, n_, q) for (s, n_), q in found.items())


def odd_words(rng):
    k = rng.choice((1, 2, 3, 5, 20))
    out = []
    while len(out) < rng.randint(0, 90):
        unit = [b"%d" % rng.randrange(k) for _ in range(rng.randint(1, 9))]
        out += (unit * rng.randint(1, 12))[:rng.randint(1, 80)]
        if rng.random() < .3:
            out += out[:rng.randint(1, 60)]
    return out


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 18])
def test_runs_equal_brute_force(monkeypatch, block):
    monkeypatch.setattr(runs, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        w = odd_words(rng)
        assert runs.periodic_runs(w) == brute_runs(w)


def test_long_periodic_texts():
    assert runs.periodic_runs([b"a"] * 200_000) == [(0, 200_000, 1)]
    assert runs.periodic_runs([b"a", b"b", b"b"] * 50_000) == [(0, 150_000, 3)]
    assert runs.periodic_runs([b"%d" % i for i in range(100_000)]) == []


def brute_digest(i, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(i).encode())
    if i is not None and h % 10 == 0 and n:
        a, p = (h // 10) % n, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = brute_runs(w)
    kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n_ for s, n_, q in found)]
    top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (str(i), len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256("".join(f"{s},{n_},{q}\n" for s, n_, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


def test_run_digests(spark, docs, empty):
    loops = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    more = spark.createDataFrame([(i, " ".join(f"v{k % 31}" for k in range(i + 3))) for i in loops],
                                 "doc_id long, text string")
    for table in (docs, more):
        got = [(str(r.doc_id), *tuple(r)[1:]) for r in runs.run_digests(table).collect()]
        want = [brute_digest(r.doc_id, r.text) for r in table.collect() if r.text != LONG]
        if table is docs:
            assert len(got) == len(TEXTS)
            got = [g for g in got if g[0] != "5"]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert runs.run_digests(empty).count() == 0


def test_run_rows_and_names(docs, empty):
    odd = docs.select(F.col("doc_id").alias("my id"), F.col("text").alias("the.text"), F.lit(1).alias("runs"))
    rows = runs.periodic_run_rows(odd, "my id", "the.text").collect()
    assert len(rows) == len(TEXTS)
    one = next(r for r in rows if r["my id"] == 0)
    assert [tuple(x) for x in one["runs"]] == [(0, 120, 3)] and one["collapsed"] == "one two three"
    assert runs.periodic_run_rows(empty).count() == 0


# -- op13 -----------------------------------------------------------------------

def brute_collocations(rows, least, percent, top):
    freq, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        t = (text or "").encode().lower().decode()
        for c in ".,;:!?\n\x0b\x0c\r":
            t = t.replace(c, "\n")
        for piece in t.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            n[lang] += len(w)
            for size in (1, 2, 3):
                for k in range(len(w) - size + 1):
                    freq[lang, tuple(w[k:k + size])] += 1
    found = {k: f for k, f in freq.items() if len(k[1]) > 1 and f >= least}
    out = []
    for (lang, g), a in found.items():
        if any(x == lang and len(h) > len(g) and any(h[k:k + len(g)] == g for k in range(len(h) - len(g) + 1))
               and 100 * f >= percent * a for (x, h), f in found.items()):
            continue
        cuts = [(1_000_000 * a * a // (freq[lang, g[:k]] * freq[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(g).encode(), a, freq[lang, g[:k]], freq[lang, g[k:]]))
    out.sort()
    ranked, seen = [], Counter()
    for lang, score, _, phrase, a, left, right in out:
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), a, left, right, n[lang], -score))
    return ranked


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block,chunk,bits", [(1 << 20, 1 << 20, 1 << 26), (50, 40, 64), (7, 9, 1 << 20)])
def test_collocations_equal_brute_force(spark, block, chunk, bits):
    rng = random.Random(block)
    vocab = [f"w{i}" for i in range(12)] + ["new york", "NEW  York city", "a\tb", "é", "\x01"]
    rows = []
    for i in range(300):
        words = [rng.choice(vocab) + rng.choice(["", "", "", ".", ",\n", "\x0b"]) for _ in range(rng.randint(0, 60))]
        rows.append((i, rng.choice(["en", "en", "fr", None, "und"]), " ".join(words) if i % 50 else None))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    got = as_rows(collocations.collocations(docs, top=25, block=block, chunk=chunk, filter_bits=bits))
    assert got == sorted(brute_collocations([(x, t) for _, x, t in rows], 10, 50, 25)) and len(got) > 50


def test_collocations_of_odd_rows(docs, empty):
    got = as_rows(collocations.collocations(docs, min_count=2, top=100))
    want = brute_collocations([(None if n % 3 else "en", t) for n, (_, t) in enumerate(TEXTS)], 2, 50, 100)
    assert got == sorted(want)
    assert collocations.collocations(empty).count() == 0


def test_a_word_that_begins_most_phrases_fills_several_slices(spark):
    rows = [(i, "en", " ".join(f"the v{k} the v{k} x{k % 3}." for k in range(i, i + 40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert as_rows(collocations.collocations(docs, top=3000)) == sorted(
        brute_collocations([(x, t) for _, x, t in rows], 10, 50, 3000))
