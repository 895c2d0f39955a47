"""Periodic runs of a text's words, by a sparse diagonal scan.

A lag ``d`` is a diagonal: word ``i`` is compared with word ``i - d``.  Words are
read in order, in blocks.  Each word's earlier occurrences name the lags that
match at this word; a lag that matched at the word before grows by one, another
starts anew.  A lag that stops matching leaves at once, and when it matched
``3 d`` words or more it emits a run: a stretch of ``4 d`` words or more whose
words ``d`` apart are identical.  A run of six words matches on at least five
in a row, so an occurrence counts only together with the four words before it:
in ordinary prose hardly any lag is ever opened.

Inside a stretch whose words recur at the constant lag ``q``, the lags ``2 q``,
``3 q``, ... match as well, from its first word to its last; they are the same
stretch with a longer period and are not opened.  What is held is the open lags
(at most a quarter of the text's words) and the occurrences of one block
(``BLOCK`` pairs, or one word's), so memory grows with the text alone and a text
of one repeated word takes one step a word.  A text with many periodic
stretches of one pattern takes a step for every pair of their occurrences.

Texts are independent, so the scan needs no shuffle.

Defined results: a null or empty text has no word and no run.  Rows with equal
texts have equal runs.  Two runs never have the same ends: of the periods of a
stretch only the smallest counts.  Ties for the strongest run go to the smallest
start, then the smallest period.  Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from encore.llm.names import quoted

MIN_LENGTH = 6             # words of a run
MIN_REPEATS = 4            # periods of a run
BLOCK = 1 << 18            # pairs of occurrences compared at once
_CONTEXT = 5               # a run of MIN_LENGTH words matches this many in a row


def _contexts(words: list[bytes]) -> np.ndarray:
    """Equal numbers where the word and the four before it are equal."""
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    base, size, out = len(ids), len(ids), code
    for k in range(1, _CONTEXT):
        if size > 2**62 // base:
            _, out = np.unique(out, return_inverse=True)
            size = int(out.max()) + 1
        out = out[:-1] * base + code[k:]
        size *= base
    return out


def _steady(lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the first place and the end of the stretch of places that
    have the same nearest lag (0: no earlier occurrence)."""
    cut = np.flatnonzero(np.diff(lag)) + 1
    first = np.concatenate([[0], cut])
    size = np.diff(np.concatenate([first, [len(lag)]]))
    return np.repeat(first, size), np.repeat(first + size, size)


def _pairs(context: np.ndarray, longest: int):
    """For places in order: which earlier occurrences to compare.  Yields blocks
    ``(begin, end, place, lag)``; a block covers the places ``begin .. end - 1``."""
    n = len(context)
    order = np.argsort(context, kind="stable")
    place = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = place                               # where a place stands among its equals
    group = np.cumsum(np.concatenate([[0], np.diff(context[order]) != 0]))
    key = group * (n + 1) + order                     # ascending
    own = group[rank] * (n + 1)
    before = np.concatenate([[-1], order[:-1]])[rank]
    known = np.concatenate([[False], group[1:] == group[:-1]])[rank]
    near = np.where(known, place - before, 0)         # nearest lag
    near[near > longest] = 0
    low = np.searchsorted(key, own + np.maximum(place - longest, 0))
    # inside a steady stretch of lag q, contexts k q back (k > 1) are left out
    first, end = _steady(near)
    q = near
    span = end - first + q + _CONTEXT - 1             # words of the stretch
    steady = (q > 0) & (span >= MIN_REPEATS * q)
    begin = np.maximum(first - q, place - (span - q))  # contexts from here on lie in the stretch
    upto = np.where(steady, np.minimum(np.searchsorted(key, own + np.maximum(begin, 0)), rank), rank)
    upto = np.maximum(upto, low)
    count = upto - low + (steady & (upto < rank))     # the nearest one always stays
    total = np.cumsum(count)
    at = 0
    while at < n:
        done = total[at - 1] if at else 0
        stop = max(int(np.searchsorted(total, done + BLOCK, "right")), at + 1)
        c = count[at:stop]
        here = np.repeat(place[at:stop], c)
        step = np.arange(len(here)) - np.repeat(np.cumsum(c) - c, c)
        source = np.minimum(np.repeat(low[at:stop], c) + step, rank[here] - 1)
        if len(here):
            tail = step == np.repeat(c, c) - 1
            near_one = tail & (steady & (upto < rank))[here]
            source[near_one] = rank[here][near_one] - 1
        yield at, stop, here, here - order[source]
        at = stop


def periodic_runs(words: list[bytes], min_length: int = MIN_LENGTH,
                  min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs by start, then period."""
    if min_length < _CONTEXT + 1 or min_repeats < 4:
        raise ValueError("runs have at least 6 words and 4 periods")
    n = len(words)
    if n < min_length:
        return []
    context = _contexts(words)
    if len(np.unique(context)) == len(context):
        return []
    found: list[tuple[int, int, int]] = []

    def emit(lag, first, last):
        # places are contexts: place p is the words p .. p + 4
        length = last - first + _CONTEXT + lag
        for k in np.flatnonzero(length >= np.maximum(min_length, min_repeats * lag)):
            found.append((int(first[k] - lag[k]), int(length[k]), int(lag[k])))

    open_lag = open_first = np.empty(0, np.int64)     # lags that match at the last place read
    for begin, end, place, lag in _pairs(context, n // min_repeats):
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        new = np.ones(len(lag), bool)
        new[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        at = np.flatnonzero(new)
        first, last = place[at], place[np.append(at[1:], len(place)) - 1] if len(at) else place
        lag = lag[at]
        # a lag that was open goes on where it matches at the block's first place
        goes_on = first == begin
        seat = np.searchsorted(open_lag, lag)
        was = goes_on & (seat < len(open_lag))
        was[was] = open_lag[seat[was]] == lag[was]
        first = first.copy()
        first[was] = open_first[seat[was]]
        closed = np.ones(len(open_lag), bool)
        closed[seat[was]] = False
        emit(open_lag[closed], open_first[closed], np.full(int(closed.sum()), begin - 1))
        ends = last < end - 1
        emit(lag[ends], first[ends], last[ends])
        open_lag, open_first = lag[~ends], first[~ends]
    emit(open_lag, open_first, np.full(len(open_lag), len(context) - 1))
    best: dict[tuple[int, int], int] = {}
    for start, length, period in found:
        best[start, length] = min(period, best.get((start, length), period))
    return sorted((s, n_, p) for (s, n_), p in best.items())


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those after a run's first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop).tolist()) if d == 0]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Greatest length / period; ties: smallest start, then period."""
    top = None
    for r in runs:
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    return top


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's planted loop: for one id in ten the words from a place on
    repeat what begins there; texts without an id stay as they are."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


_OUT = [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
        ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _scan(prepare):
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, text in zip(batch.column("_id").to_pylist(), batch.column("_text")):
                words = prepare(text.as_buffer().to_pybytes().split() if text.is_valid else [], i)
                runs = periodic_runs(words)
                yield batch, runs, kept_words(words, runs)
            yield batch, None, None
    return rows


def _as_given(words: list[bytes], _id) -> list[bytes]:
    return words


def periodic_run_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, runs, collapsed)`` of every row: the runs as an array of
    ``(start, length, period)`` and the text without their repetitions, words
    joined by one space."""
    def run(batches):
        held: list[list] = [[], []]
        for batch, runs, kept in _scan(_as_given)(batches):
            if runs is not None:
                held[0].append([dict(zip(("start", "length", "period"), r)) for r in runs])
                held[1].append(b" ".join(kept).decode())
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array(held[0], _RUNS), pa.array(held[1], pa.string())],
                    names=["_id", "runs", "collapsed"])
                held = [[], []]
    return _mapped(docs, id_col, text_col, run,
                   "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def _mapped(docs: DataFrame, id_col: str, text_col: str, run, columns: str) -> DataFrame:
    src = docs.select(docs[quoted(id_col)].alias("_id"), docs[quoted(text_col)].cast("binary").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(run, f"_id {id_type}, {columns}").withColumnRenamed("_id", id_col)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepare=looped) -> DataFrame:
    """One row per input row: the number of runs, the strongest one, and digests
    of all runs and of the words that stay.  ``prepare(words, id)`` may change
    the words first; by default it plants the contract's loops."""
    def run(batches):
        held: list[tuple] = []
        for batch, runs, kept in _scan(prepare)(batches):
            if runs is not None:
                top = strongest(runs)
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                held.append((len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
                             hashlib.sha256(lines.encode()).hexdigest(),
                             hashlib.sha256(b" ".join(kept)).hexdigest()))
            else:
                cols = list(zip(*held)) if held else [[]] * len(_OUT)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id")] + [pa.array(c, t) for c, (_, t) in zip(cols, _OUT)],
                    names=["_id"] + [n for n, _ in _OUT])
                held = []
    return _mapped(docs, id_col, text_col, run,
                   ", ".join(f"{n} {'long' if t == pa.int64() else 'string'}" for n, t in _OUT))


def op12_periodic_runs(spark, d):
    return run_digests(spark.read.parquet(f"{d}/documents.parquet"))


SQL = r"""
WITH src AS (
  SELECT row_number() OVER () AS rid, doc_id, CAST(doc_id AS VARCHAR) AS id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
hashed AS (
  SELECT *, len(w) AS n, xor(CAST(4294967295 AS BIGINT), list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, len(id) + 1), lambda i: CAST(ascii(id[i]) AS BIGINT))),
      lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
                                    lambda c, k: xor(c >> 1, 3988292384 * (c & 1))))) AS h
  FROM src),
placed AS (
  SELECT rid, doc_id, w, n, h, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a,
         CASE WHEN n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) ELSE 1 END AS p
  FROM hashed),
word AS (
  SELECT rid, n, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS x
  FROM (SELECT *, unnest(range(n)) AS i FROM placed)),
same AS (
  SELECT u.rid, u.i - v.i AS q, u.i FROM word u JOIN word v
    ON u.rid = v.rid AND u.x = v.x AND v.i < u.i AND 4 * (u.i - v.i) <= u.n),
stretch AS (
  SELECT rid, q, min(i) - q AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM same)
  GROUP BY rid, q, island),
run AS (
  SELECT rid, start, length, min(q) AS period FROM stretch
  WHERE length >= 6 AND length >= 4 * q GROUP BY rid, start, length),
top AS (
  SELECT * FROM run
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length / CAST(period AS DOUBLE) DESC, start, period) = 1),
listed AS (
  SELECT rid, count(*) AS n_runs,
         sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
  FROM run GROUP BY rid),
kept AS (
  SELECT rid, sha256(string_agg(x, ' ' ORDER BY i)) AS collapsed_sha256 FROM word
  WHERE NOT EXISTS (SELECT 1 FROM run r WHERE r.rid = word.rid AND word.i >= r.start + r.period
                    AND word.i < r.start + r.length)
  GROUP BY rid)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.start AS BIGINT) AS start,
       CAST(top.length AS BIGINT) AS length, CAST(top.period AS BIGINT) AS period,
       CAST(1000 * top.length // top.period AS BIGINT) AS exponent_milli,
       coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM placed d LEFT JOIN top USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)
"""

QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLE = {"op12_periodic_runs": SQL}
