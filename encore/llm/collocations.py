"""Phrase collocations, estimated from sorted count streams.

Words are counted per language in three orders (one, two and three words).
A task packs blocks of about ``BLOCK`` words into integers, counts them by
sorting, and sends one row for each distinct phrase of a block; Spark adds the
rows up.  Every part of a phrase that occurs ``min_count`` times occurs as
often itself, so only phrases of that count go on, and a three-word phrase is
counted only where both of its pairs pass a bit table of the frequent pairs.
The table has a fixed size (``FILTER_BITS``): a false pass costs a row and
changes no result.

The frequent phrases then form one stream that is written twice: in prefix
order (first word, second, third) and in suffix order (last word, the one
before, the first).  In either order a phrase follows its own beginnings, so
one pass that reads phrases and their shorter parts in lockstep finds the left
counts ``f(w1)`` and ``f(w1 w2)``, and in suffix order the right counts
``f(w3)`` and ``f(w2 w3)``, without a hash table.  The streams are cut into
range slices wherever they are long, so a word that begins a third of all
phrases is spread over many slices; a slice starts with the open counts of
the slice before, one row a slice.  A three-word phrase sees here the counts
of its two pairs, so it alone decides whether it absorbs them, and the absorbed
pairs (at most two for each pair and side) leave by a merge join.

Defined results: a null text is empty and a null language is ``und``.  Repeated
rows count each time.  Languages without a candidate have no rows.  Ties are
settled by the count and then by the phrase's bytes, so ranks are total.  Other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.session import materialize

MIN_COUNT = 10             # occurrences of a candidate
ABSORB_PERCENT = 50        # a longer candidate with this share of the count absorbs it
TOP = 2000                 # reported phrases of a language
BLOCK = 1 << 17            # words counted at once in a task
CHUNK = 1 << 18            # bytes of a text split at once
FILTER_BITS = 1 << 26      # bit table of the frequent pairs (8 MiB)

# Characters that end a piece, and the blanks between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

_STOP = b"."               # ends a piece, so it is never a word
_TABLE = bytes.maketrans(PIECE_ENDS + BLANKS, _STOP * len(PIECE_ENDS) + b" " * len(BLANKS))
_GRAMS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("c", pa.int64())])
_GRAMS_DDL = "lang string, phrase string, c long"       # words joined by one blank, which no word holds
_BITS = pa.schema([("at", pa.int32()), ("mask", pa.int64())])
_WORDS = ["w1", "w2", "w3"]


def _tokens(text: bytes, chunk: int) -> Iterator[list[bytes]]:
    """Words of a text in chunks, a stop wherever a piece ends."""
    t = text.lower().translate(_TABLE).replace(_STOP, b" " + _STOP + b" ")
    at = 0
    while at < len(t):
        end = t.find(b" ", at + chunk)
        end = len(t) if end < 0 else end
        yield t[at:end].split()
        at = end


def _blocks(batches: Iterator[pa.RecordBatch], size: int,
            chunk: int) -> Iterator[tuple[str, list[bytes], int]]:
    """``(lang, words, first)``: phrases that end at ``first`` or later are new."""
    open_: dict[str, list] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("_text")):
            if not text.is_valid:
                continue
            words = open_.setdefault(lang, [[], 0])
            words[0].append(_STOP)
            for part in _tokens(text.as_buffer().to_pybytes(), chunk):
                words[0].extend(part)
                held += len(part) + 1
                if held >= size:
                    for name, (block, first) in open_.items():
                        yield name, block, first
                    # the last two words may begin phrases of the next block
                    open_ = {lang: [words[0][-2:], min(2, len(words[0]))]}
                    words, held = open_[lang], 0
    for name, (block, first) in open_.items():
        yield name, block, first


def _coded(words: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the code of each place, and where no piece ends."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = coded.dictionary
    stop = names.index(pa.scalar(_STOP, pa.binary())).as_py()
    return names.cast(pa.string()), code, code != stop


def _counted(code: np.ndarray, ok: np.ndarray, size: int, first: int):
    """Code columns and counts of the distinct phrases of ``size`` words."""
    n = len(code) - size + 1
    if n <= 0:
        return [np.empty(0, np.int64)] * size, np.empty(0, np.int64)
    base = int(code.max()) + 1
    good, packed = ok[:n].copy(), code[:n].copy()
    for k in range(1, size):
        good &= ok[k:n + k]
        packed *= base
        packed += code[k:n + k]
    good[:max(0, first - size + 1)] = False
    found, count = np.unique(packed[good], return_counts=True)
    cols = []
    for _ in range(size):
        found, word = np.divmod(found, base)
        cols.append(word)
    return cols[::-1], count.astype(np.int64)


def _rows(lang: str, names: pa.Array, cols: list[np.ndarray], count: np.ndarray) -> pa.RecordBatch:
    words = [names.take(pa.array(c)) for c in cols]
    phrase = pc.binary_join_element_wise(*words, " ") if len(words) > 1 else words[0]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(count), np.int64))), phrase, pa.array(count)],
        schema=_GRAMS)


def _short_phrases(size: int, chunk: int):
    """Counts of one and two words; a row without a phrase counts all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, first in _blocks(batches, size, chunk):
            names, code, ok = _coded(words)
            total = pa.array([int(ok[first:].sum())], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.nulls(1, pa.string()), total], schema=_GRAMS)
            for k in (1, 2):
                yield _rows(lang, names, *_counted(code, ok, k, first))
    return run


def _pair_places(left: np.ndarray, right: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two places of a pair in the bit table, from the hashes of its words."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    return [x % np.uint64(bits), (x >> np.uint64(32)) % np.uint64(bits)]


def _word_hashes(names, lang: str) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang)
    return np.array([xxhash.xxh3_64_intdigest(w, seed=seed) for w in names], np.uint64)


def _pair_bits(bits: int):
    """``(at, mask)``: 64 places of the bit table that pairs of this task set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, one, two = (batch.column(c).to_pylist() for c in ("lang", "w1", "w2"))
            seeds = {x: xxhash.xxh32_intdigest(x) for x in set(langs)}
            left, right = (np.array([xxhash.xxh3_64_intdigest(w, seed=seeds[x]) for w, x in zip(ws, langs)], np.uint64)
                           for ws in (one, two))
            place = np.unique(np.concatenate(_pair_places(left, right, bits)))
            at, start = np.unique((place >> np.uint64(6)).astype(np.int32), return_index=True)
            bit = np.uint64(1) << (place & np.uint64(63))
            mask = np.bitwise_or.reduceat(bit, start) if len(bit) else bit
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(mask.view(np.int64))], schema=_BITS)
    return run


def _pair_filter(pairs: DataFrame, bits: int) -> np.ndarray:
    """The bit table of these pairs; at most ``bits / 64`` rows come back."""
    rows = (pairs.select("lang", "w1", "w2").mapInArrow(_pair_bits(bits), "at int, mask long")
            .groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow())
    table = np.zeros(-(-bits // 64), np.uint64)
    table[rows.column("at").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return table


def _long_phrases(shared, bits: int, size: int, chunk: int):
    """Counts of three words whose pairs may both be frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for lang, words, first in _blocks(batches, size, chunk):
            if len(words) < 3:
                continue
            names, code, ok = _coded(words)
            hashes = _word_hashes(names.cast(pa.binary()).to_pylist(), lang)[code]
            pair = np.ones(len(code) - 1, bool)
            for place in _pair_places(hashes[:-1], hashes[1:], bits):
                pair &= (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
            # only words of a phrase that may be frequent take part
            begins = pair[:-1] & pair[1:]
            part = np.zeros(len(code), bool)
            for k in range(3):
                part[k:len(code) - 2 + k] |= begins
            cols, count = _counted(code, ok & part, 3, first)
            yield _rows(lang, names, cols, count)
    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  min_count: int = MIN_COUNT, block: int = BLOCK, chunk: int = CHUNK,
                  filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``(lang, w1, w2, w3, f)`` of phrases of one to three words that occur
    ``min_count`` times (absent words are null), and ``(lang, n)``."""
    src = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
                      F.col(text_col).cast("binary").alias("_text"))
    def counted(rows: DataFrame) -> DataFrame:
        words = F.split("phrase", " ")
        return (rows.groupBy("lang", "phrase").agg(F.sum("c").alias("f"))
                .where(F.col("phrase").isNull() | (F.col("f") >= min_count))
                .select("lang", *[F.get(words, k).alias(w) for k, w in enumerate(_WORDS)], "f"))

    short = materialize(counted(src.mapInArrow(_short_phrases(block, chunk), _GRAMS_DDL)), "phrases")
    totals = short.where("w1 IS NULL").select("lang", F.col("f").alias("n"))
    short = short.where("w1 IS NOT NULL")
    shared = docs.sparkSession.sparkContext.broadcast(_pair_filter(short.where("w2 IS NOT NULL"), filter_bits))
    long = counted(src.mapInArrow(_long_phrases(shared, filter_bits, block, chunk), _GRAMS_DDL))
    return short.unionByName(long), totals


def _open_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each phrase of a sorted slice the count of the last single word
    (``h1``) and of the last pair (``h2``) read before it; -1: none in the slice."""
    last = [-1, -1]
    for batch in batches:
        f = batch.column("f").to_numpy()
        alone = batch.column("k2").is_null().to_numpy(zero_copy_only=False)
        short = batch.column("k3").is_null().to_numpy(zero_copy_only=False)
        out = []
        for k, head in enumerate((alone, short & ~alone)):
            at = np.maximum.accumulate(np.where(head, np.arange(len(f)), -1))
            out.append(np.where(at >= 0, f[at], last[k]).astype(np.int64))
            last[k] = int(out[k][-1]) if len(f) else last[k]
        yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(x) for x in out],
                                         names=batch.schema.names + ["h1", "h2"])


def _lockstep(stream: DataFrame, keys: list, names: tuple[str, str]) -> DataFrame:
    """Writes the stream sorted by ``lang`` and ``keys`` and adds the counts of a
    phrase's first word and first pair in that order under ``names``."""
    spark = stream.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["lang", "k1", "k2", "k3"]
    keyed = stream.select("*", *[k.alias(f"k{i + 1}") for i, k in enumerate(keys)])
    ranged = (keyed.repartitionByRange(slices, *order).sortWithinPartitions(*order)
              .withColumn("_slice", F.spark_partition_id()))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema.fields)
    merged = materialize(ranged.mapInArrow(_open_counts, f"{ddl}, h1 long, h2 long"), "stream")
    single, pair = F.col("k2").isNull(), F.col("k2").isNotNull() & F.col("k3").isNull()
    ends = merged.groupBy("_slice").agg(
        F.max_by("f", F.when(single, F.struct("lang", "k1"))).alias("h1"),
        F.max_by("f", F.when(pair, F.struct("lang", "k1", "k2"))).alias("h2")).orderBy("_slice").collect()
    carried, h1, h2 = [], None, None          # one row a slice
    for r in ends:
        carried.append((r["_slice"], h1, h2))
        h1, h2 = (r["h1"] if r["h1"] is not None else h1), (r["h2"] if r["h2"] is not None else h2)
    before = spark.createDataFrame(carried, "_slice int, _b1 long, _b2 long")
    known = [F.when(F.col(h) >= 0, F.col(h)).otherwise(F.col(b)).alias(n)
             for h, b, n in zip(("h1", "h2"), ("_b1", "_b2"), names)]
    return merged.join(F.broadcast(before), "_slice").select(*stream.columns, *known)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 absorb_percent: int = ABSORB_PERCENT, top: int = TOP, **sizes: int) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of two
    or three words of each language by score, count and phrase.  ``sizes`` are
    the block, chunk and filter sizes of ``phrase_counts``."""
    counts, totals = phrase_counts(docs, text_col, lang_col, min_count, **sizes)
    w1, w2, w3 = (F.col(w) for w in _WORDS)
    prefix = _lockstep(counts, [w1, w2, w3], ("first", "first_two"))
    last = F.coalesce(w3, w2, w1)
    before = F.when(w3.isNotNull(), w2).when(w2.isNotNull(), w1)
    both = _lockstep(prefix, [last, before, F.when(w3.isNotNull(), w1)], ("last", "last_two"))

    three = both.where("w3 IS NOT NULL")
    share = F.lit(100).cast("decimal(20,0)") * F.col("f")
    absorbed = (three.where(share >= absorb_percent * F.col("first_two").cast("decimal(20,0)"))
                .select("lang", "w1", "w2")
                .unionByName(three.where(share >= absorb_percent * F.col("last_two").cast("decimal(20,0)"))
                             .select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"))).distinct())
    two = (both.where("w2 IS NOT NULL AND w3 IS NULL")
           .join(absorbed.hint("merge"), ["lang", "w1", "w2"], "left_anti"))

    def score(left: str, right: str):
        a = "CAST(f AS DECIMAL(15,0))"
        return F.expr(f"(1000000 * ({a} * {a})) DIV (CAST({left} AS DECIMAL(15,0)) * CAST({right} AS DECIMAL(15,0)))")

    def cut(number: int, left: str, right: str):
        return F.struct(score(left, right).alias("score"), F.lit(number).alias("cut"),
                        F.col(left).alias("l"), F.col(right).alias("r"))

    one_cut = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"),
                         cut(1, "first", "last").alias("c"))
    two_cuts = three.select("lang", F.concat_ws(" ", *_WORDS).alias("phrase"), F.col("f").alias("a"),
                            F.least(cut(1, "first", "last_two"), cut(2, "first_two", "last")).alias("c"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = (one_cut.unionByName(two_cuts).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
            .withColumn("rank", rank).where(F.col("rank") <= top))
    return (best.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op13_phrase_collocations(spark, d):
    return collocations(spark.read.parquet(f"{d}/documents.parquet"))


SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
word AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM word GROUP BY lang),
gram AS (
  SELECT lang, size, w[i:i + size - 1] AS g
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM word, (VALUES (1), (2), (3)) AS s(size) WHERE len(w) >= size)),
freq AS (SELECT lang, size, g, count(*) AS f FROM gram GROUP BY lang, size, g HAVING count(*) >= 10),
cut AS (
  SELECT c.lang, c.g, c.f AS a, k, x.f AS l, y.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.f * c.f) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM freq WHERE size > 1) c
  JOIN freq x ON x.lang = c.lang AND x.g = c.g[1:k]
  JOIN freq y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
absorbed AS (
  SELECT DISTINCT b.lang, b.g FROM freq b JOIN freq t ON t.lang = b.lang AND t.size = 3 AND b.size = 2
    AND (t.g[1:2] = b.g OR t.g[2:3] = b.g) WHERE 100 * t.f >= 50 * b.f),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM best WHERE NOT EXISTS (SELECT 1 FROM absorbed x WHERE x.lang = best.lang AND x.g = best.g))
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""

QUERIES = {"op13_phrase_collocations": op13_phrase_collocations}
ORACLE = {"op13_phrase_collocations": SQL}
