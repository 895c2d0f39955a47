"""Byte-level BPE encoding and decoding by recursive DuckDB queries.

Spark splits every text with the tokenizer's pattern.  In each partition the
distinct pieces that are not yet known become rows (word, position, token) of
a DuckDB table, at first one row a byte.  A recursive query joins neighbouring
tokens with the merge table and contracts each word's leftmost pair of minimum
rank; a word leaves when no pair is in the table, its fixpoint.  Ids become
bytes again by an ordered aggregation over (word, position, id) rows.

Texts are encoded in batches of bounded size; what is kept between batches is
a cache of pieces, emptied at ``CACHE_WORDS``.  Words of over ``LONG_BYTES``
bytes take a second form of the query: all occurrences of the minimum pair are
contracted at once, left to right, where the merge table shows that the new
token forms no pair of lower rank, which gives the same result in fewer steps.

Defined results: null and empty texts have no ids.  Equal texts get equal ids.
The vocabulary file is a parameter and is read on every executor from the
installed package; special tokens are not recognised.
"""

from __future__ import annotations

import base64
import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE_WORDS = 400_000
CHUNK_WORDS = 40_000       # words in one recursive query
LONG_BYTES = 200
BATCH_PIECES = 400_000     # pieces encoded at once

# the pattern's classes as Java names them
JAVA_PATTERN = (public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\p{IsWhite_Space}\p{L}\p{N}]")
                .replace(r"(?!\S)", r"(?!\P{IsWhite_Space})").replace(r"\s", r"\p{IsWhite_Space}"))

SHORT = """
WITH RECURSIVE s(w, p, q, t, n, done) AS (
  SELECT w, p, lead(p) OVER word, t, lead(t) OVER word, false FROM start
  WINDOW word AS (PARTITION BY w ORDER BY p)
  UNION ALL
  SELECT s.w, s.p, CASE WHEN s.p = b.p THEN b.q2 ELSE s.q END,
         CASE WHEN s.p = b.p THEN b.m ELSE s.t END,
         CASE WHEN s.p = b.p THEN b.n2 WHEN s.q = b.p THEN b.m ELSE s.n END, b.w IS NULL
  FROM s LEFT JOIN (
    SELECT low.w, low.p, low.m, low.q, x.q AS q2, x.n AS n2
    FROM (SELECT w, (k >> 32)::INT AS m, (k & 4294967295)::INT AS p, q
          FROM (SELECT s.w, min((merges.m::BIGINT << 32) | s.p) AS k,
                       arg_min(s.q, (merges.m::BIGINT << 32) | s.p) AS q
                FROM s JOIN merges ON merges.l = s.t AND merges.r = s.n
                WHERE NOT s.done GROUP BY s.w)) low
    JOIN s x ON x.w = low.w AND x.p = low.q) b ON b.w = s.w
  WHERE NOT s.done AND (b.w IS NULL OR s.p <> b.q))
SELECT w, list(t ORDER BY p) AS ids, unhex(string_agg(hex, '' ORDER BY p)) AS back
FROM s JOIN vocabulary ON id = t WHERE done GROUP BY w
"""

LONG = """
WITH RECURSIVE s(w, p, t, done) AS (
  SELECT w, p, t, false FROM start
  UNION ALL
  SELECT w, p, CASE WHEN hit THEN low ELSE t END, low IS NULL
  FROM (SELECT *, lag(hit) OVER (PARTITION BY w ORDER BY p) AS gone
        FROM (SELECT w, p, t, low,
                     low IS NOT NULL AND m = low
                     AND CASE WHEN alone THEN p = min(CASE WHEN m = low THEN p END) OVER (PARTITION BY w)
                              ELSE (row_number() OVER (PARTITION BY w, m = low, i - j ORDER BY p)) % 2 = 1
                         END AS hit
              FROM (SELECT *, row_number() OVER (PARTITION BY w, m = low ORDER BY p) AS j
                    FROM (SELECT *, min(m) OVER (PARTITION BY w) AS low
                          FROM (SELECT a.w, a.p, a.t, a.i, merges.m, merges.alone
                                FROM (SELECT w, p, t, lead(t) OVER word AS n, row_number() OVER word AS i
                                      FROM s WHERE NOT done WINDOW word AS (PARTITION BY w ORDER BY p)) a
                                LEFT JOIN merges ON merges.l = a.t AND merges.r = a.n)))))
  WHERE gone IS NULL OR NOT gone)
SELECT w, list(t ORDER BY p) AS ids, unhex(string_agg(hex, '' ORDER BY p)) AS back
FROM s JOIN vocabulary ON id = t WHERE done GROUP BY w
"""

DECODE = """
SELECT w, unhex(string_agg(hex, '' ORDER BY p)) AS back
FROM (SELECT w, unnest(ids) AS id, generate_subscripts(ids, 1) AS p FROM coded) JOIN vocabulary USING (id)
GROUP BY w
"""


def pieces(text: Column) -> Column:
    """The text's pieces: the matches of the tokenizer's pattern."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(JAVA_PATTERN), F.lit(0))


class Tokenizer:
    """One vocabulary in an in-process DuckDB, single-threaded like its task."""

    def __init__(self, name: str = VOCABULARY):
        with open(public_tokenizers.path(name), "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "250MB",
                                          "temp_directory": tempfile.gettempdir()})
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], m) for t, m in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        lowest = {}                      # lowest rank of a pair that holds the token
        for left, right, m in pairs:
            for part in (left, right):
                lowest[part] = min(m, lowest.get(part, m))
        l, r, m = zip(*pairs)
        self._table("merges", l=pa.array(l, pa.int32()), r=pa.array(r, pa.int32()), m=pa.array(m, pa.int32()),
                    alone=pa.array([lowest.get(x, x + 1) < x for x in m], pa.bool_()))
        self._table("vocabulary", id=pa.array(list(self.bytes_of), pa.int32()),
                    hex=pa.array([b.hex() for b in self.bytes_of.values()]))
        self.cache: dict[str, tuple[bytes, bytes]] = {}

    def _table(self, name: str, **columns) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given").complete()
        self.con.unregister("given")

    def merge(self, words: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit words, bytes decoded from them) of each
        word, by the recursive queries; a word that is a token has one id."""
        found = [(self.ranks[x].to_bytes(4, "little"), b"") if x in self.ranks else (b"", b"") for x in words]
        whole = [i for i, x in enumerate(found) if x[0]]
        for i, back in zip(whole, self.decode([[int.from_bytes(found[i][0], "little")] for i in whole])):
            found[i] = (found[i][0], back)
        rest = [i for i, x in enumerate(found) if not x[0] and words[i]]
        short = [i for i in rest if len(words[i]) <= LONG_BYTES]
        long = [i for i in rest if len(words[i]) > LONG_BYTES]
        for sql, group, size in ((SHORT, short, CHUNK_WORDS), (LONG, long, 100)):
            for at in range(0, len(group), size):
                part = group[at:at + size]
                length = np.array([len(words[i]) for i in part])
                flat = np.frombuffer(b"".join(words[i] for i in part), np.uint8)
                place = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
                self._table("start", w=np.repeat(np.array(part, np.int32), length),
                            p=place.astype(np.int32), t=self.byte_id[flat])
                out = self.con.sql(sql).to_arrow_table().combine_chunks()
                ids = pa.concat_arrays(out.column("ids").chunks)
                ends = (np.cumsum(pc.list_value_length(ids).to_numpy()) * 4).tolist()
                flat_ids = ids.flatten().to_numpy().astype("<u4").tobytes()
                start = 0
                for w, end, back in zip(out.column("w").to_pylist(), ends, out.column("back").to_pylist()):
                    found[w] = (flat_ids[start:end], back)
                    start = end
        return found

    def decode(self, sequences: list[list[int]]) -> list[bytes]:
        """Bytes of each id sequence by an ordered aggregation."""
        out = [b""] * len(sequences)
        for at in range(0, len(sequences), CHUNK_WORDS):
            part = sequences[at:at + CHUNK_WORDS]
            self._table("coded", w=pa.array(range(at, at + len(part)), pa.int32()),
                        ids=pa.array(part, pa.list_(pa.int32())))
            got = self.con.sql(DECODE).to_arrow_table()
            for w, back in zip(got.column(0).to_pylist(), got.column(1).to_pylist()):
                out[w] = back
        return out

    def learn(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian words, decoded bytes) of each piece."""
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = words
        self.cache.update(zip(new, self.merge([w.encode() for w in new])))
        return [self.cache[w] for w in words]


@lru_cache(maxsize=1)
def tokenizer(name: str = VOCABULARY) -> Tokenizer:
    return Tokenizer(name)


def _slices(lists: pa.ListArray) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + BATCH_PIECES, "right")))
        yield start, stop - start
        start = stop


def _coded(lists: pa.ListArray, name: str) -> Iterator[tuple[bytes, bytes]]:
    """(id bytes, decoded bytes) of each list of pieces."""
    coded = pc.dictionary_encode(lists.flatten())
    known = tokenizer(name).learn(coded.dictionary.to_pylist())
    at, index = 0, coded.indices.to_numpy().tolist()
    for n in pc.list_value_length(lists).to_pylist():
        mine = index[at:at + n]
        at += n
        yield b"".join([known[i][0] for i in mine]), b"".join([known[i][1] for i in mine])


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str = VOCABULARY) -> DataFrame:
    """``(id_col, ids)``: the token ids of every text."""
    rows = docs.select(F.col(id_col).alias("_id"), pieces(F.col(text_col)).alias("_pieces"))

    def run(batches):
        for batch in batches:
            for start, n in _slices(batch.column("_pieces")):
                part = batch.slice(start, n)
                ids = [np.frombuffer(c, "<u4").astype(np.int32) for c, _ in
                       _coded(part.column("_pieces"), vocabulary)]
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=["_id", "ids"])
    out = rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, ids array<int>")
    return out.withColumnRenamed("_id", id_col)


def decode(coded: DataFrame, ids_col: str = "ids", out_col: str = "bytes",
           vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds the bytes of any list of ids (null for a null list)."""
    schema = T.StructType([*coded.schema.fields, T.StructField(out_col, T.BinaryType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = part.column(ids_col).to_pylist()
                found = tokenizer(vocabulary).decode([x or [] for x in ids])
                got = pa.array([b if x is not None else None for x, b in zip(ids, found)], pa.binary())
                yield pa.RecordBatch.from_arrays(part.columns + [got], names=part.schema.names + [out_col])
    return coded.mapInArrow(run, schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            vocabulary: str = VOCABULARY) -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)`` of every text: ids by
    the recursive query, bytes decoded from those ids."""
    rows = docs.select(F.col(id_col).alias("_id"), pieces(F.col(text_col)).alias("_pieces"))

    def run(batches):
        for batch in batches:
            for start, n in _slices(batch.column("_pieces")):
                part = batch.slice(start, n)
                count, ids, back = [], [], []
                for c, b in _coded(part.column("_pieces"), vocabulary):
                    count.append(len(c) // 4)
                    ids.append(hashlib.sha256(c).hexdigest())
                    back.append(hashlib.sha256(b).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(count, pa.int64()), pa.array(ids, pa.string()),
                     pa.array(back, pa.string())], names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    out = rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, n_tokens long, "
                               "ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("_id", id_col)


def op8_bpe(spark, d):
    return digests(spark.read.parquet(f"{d}/documents.parquet"))


QUERIES = {"op8_bpe": op8_bpe}
ORACLE: dict[str, str] = {}
