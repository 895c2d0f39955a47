r"""Quality rules as a short-circuit cascade, in SQL functions only.

A rule is a boolean column (true: the document fails) over the raw text.
``estimate`` times every rule on a small hash-taken sample and measures which share
of the sample it rejects; ``cascade`` orders the rules by rejection per cost and
chains them in one CASE, so a document pays only for the rules up to its first
failure.  The order changes cost, never the verdict: a document is kept when
no rule fails.

Words are runs of ``[^\x20\x09-\x0D]``.  Expressions bind an intermediate (the
word list, the window hashes) with ``_let`` so that it is computed once for a
row inside one expression, however often the formula uses it.

Defined results: a null text has no words, every count is 0, and it fails the
length rule; so does an empty one.  Equal rows get equal verdicts; ids are not
read.  Windows are compared by a 64-bit hash of their eight words.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.names import quoted
from encore.session import materialize

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30      # words in repeated 8-word windows
WINDOW = 8
MAX_SYMBOL_PERCENT = 20      # symbol characters per 100 words
MAX_CAPITAL_PERCENT = 50     # A-Z per 100 word characters
MAX_STUTTER_PERCENT = 30     # words equal to the word before, per 100 words
MAX_DUP_LINE_PERCENT = 60    # repeated lines per 100 lines with a word
MAX_MEAN_WORD = 40           # characters per word

SAMPLE_ROWS = 400            # expected rows of the sample that times the rules
REPEATS = 10                 # evaluations of a rule on each of them

SPACE = r"[\x20\x09-\x0D]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for the row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+", -1), lambda w: w != "")


def word_chars(ws: Column) -> Column:
    return F.char_length(F.array_join(ws, "")).cast("long")


def symbols(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.char_length(t) - F.char_length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long")


def capitals(text: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Z]+", "")).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1),
                    lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def dup_lines(text: Column) -> Column:
    return _let(lines_with_words(text),
                lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"))


def stutters(ws: Column) -> Column:
    return F.size(F.filter(F.transform(ws, lambda w, i: w == F.get(ws, i - 1)), lambda x: x)).cast("long")


def _paired(hs: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on (past the end: alone)."""
    return F.transform(hs, lambda h, i: F.xxhash64(h, F.get(hs, i + step)))


def window_hashes(ws: Column) -> Column:
    """Hashes of all windows of eight words, from pairs of pairs of pairs."""
    eight = _let(F.transform(ws, lambda w: F.xxhash64(w)),
                 lambda h: _let(_paired(h, 1),
                                lambda two: _let(_paired(two, 2), lambda four: _paired(four, 4))))
    return F.slice(eight, 1, F.size(ws) - (WINDOW - 1))


def repeat_words(ws: Column) -> Column:
    """Words covered by eight-word windows that occur twice or more in the row."""
    zero = F.lit(0).cast("long")

    def covered(hs: Column) -> Column:
        ordered = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(z: Column) -> Column:
            twice = F.filter(z, lambda e, j: (e["h"] == F.get(z, j - 1)["h"])
                             | (e["h"] == F.get(z, j + 1)["h"]))
            return F.sort_array(F.transform(twice, lambda e: e["i"]))

        def total(s: Column) -> Column:
            spans = F.transform(s, lambda a, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - a, F.lit(WINDOW))).cast("long"))
            return F.aggregate(spans, zero, lambda acc, x: acc + x)

        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), zero).otherwise(
            _let(ordered, lambda z: _let(starts(z), total)))

    return F.coalesce(F.when(F.size(ws) > WINDOW, _let(window_hashes(ws), covered)), zero)


def statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and the text's counts, each text read once."""
    keep = keep or ["doc_id"]
    return (docs.select(*keep, F.col(text_col).alias("_t"), words(F.col(text_col)).alias("_w"))
            .select(*keep, F.size("_w").cast("long").alias("n_words"),
                    word_chars(F.col("_w")).alias("word_chars"),
                    symbols(F.col("_t")).alias("n_symbols"), dup_lines(F.col("_t")).alias("n_dup_lines"),
                    repeat_words(F.col("_w")).alias("n_repeat_words"), F.col("_t"), F.col("_w")))


def base_rules(text: Column, ws: Column) -> dict[str, Column]:
    return {
        "few_words": F.size(ws) < MIN_WORDS,
        "repeated_windows": F.lit(100) * repeat_words(ws) > F.lit(MAX_REPEAT_PERCENT) * F.size(ws),
    }


def extra_rules(text: Column, ws: Column) -> dict[str, Column]:
    return {
        "symbols": F.lit(100) * symbols(text) > F.lit(MAX_SYMBOL_PERCENT) * F.size(ws),
        "capitals": F.lit(100) * capitals(text) > F.lit(MAX_CAPITAL_PERCENT) * word_chars(ws),
        "stutter": F.lit(100) * stutters(ws) > F.lit(MAX_STUTTER_PERCENT) * F.size(ws),
        "duplicate_lines": F.lit(100) * dup_lines(text)
        > F.lit(MAX_DUP_LINE_PERCENT) * F.size(lines_with_words(text)),
        "long_words": word_chars(ws) > F.lit(MAX_MEAN_WORD) * F.size(ws),
    }


def all_rules(text: Column, ws: Column) -> dict[str, Column]:
    return base_rules(text, ws) | extra_rules(text, ws)


Rules = Callable[[Column, Column], dict[str, Column]]


def estimate(docs: DataFrame, text_col: str, rules: Rules, sample_rows: int = SAMPLE_ROWS) -> list[tuple]:
    """``(name, seconds, rejected share)`` of each rule on about ``sample_rows``
    rows, taken by a hash of the text at a share set by the row count, so any
    partitioning takes the same ones.  Each rule is evaluated ``REPEATS`` times
    on each row, and the time of the same job without a rule is taken off.  The
    sample only orders the rules."""
    share = min(1.0, sample_rows / max(1, docs.count()))
    text = docs[quoted(text_col)]
    rows = materialize(docs.where(F.pmod(F.xxhash64(text), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
                       .select(text.alias("_t")), "sample")
    sample = rows.repartition(1).select("_t", words(F.col("_t")).alias("_w")).persist()
    copies = sample.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def timed(hit: Column) -> tuple[float, int]:
        best = None
        for _ in range(2):
            t = time.perf_counter()
            hits = copies.agg(F.count_if(hit).alias("hits")).first()["hits"]
            best = min(best or 1e9, time.perf_counter() - t)
        return best, hits

    try:
        n = max(1, sample.count() * REPEATS)
        idle, _ = timed(F.col("_r") < 0)
        measured = {name: timed(failed) for name, failed in rules(F.col("_t"), F.col("_w")).items()}
        return [(name, max(sec - idle, 0.0), hits / n) for name, (sec, hits) in measured.items()]
    finally:
        sample.unpersist()


def by_rejection_per_cost(measured: list[tuple]) -> list[str]:
    """Rule names by rejected share per second, best first."""
    return [name for name, sec, share in
            sorted(measured, key=lambda m: (-m[2] / max(m[1], 1e-6), m[1], m[0]))]


def cascade(rules: dict[str, Column], order: list[str]) -> Column:
    """Name of the first failed rule in ``order``, or null when all pass."""
    case = F.when(F.coalesce(rules[order[0]], F.lit(False)), F.lit(order[0]))
    for name in order[1:]:
        case = case.when(F.coalesce(rules[name], F.lit(False)), F.lit(name))
    return case


def keep_good(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    order = by_rejection_per_cost(estimate(docs, text_col, all_rules, sample_rows))
    text = docs[quoted(text_col)]
    return docs.where(_let(words(text), lambda ws: cascade(all_rules(text, ws), order)).isNull())


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts and verdict of every document (``base_failed``, ``kept``)."""
    order = by_rejection_per_cost(estimate(docs, text_col, extra_rules, sample_rows))
    counted = statistics(docs.select(docs[quoted(id_col)].alias("doc_id"), docs[quoted(text_col)].alias("_text")), "_text")
    failed = ((F.col("n_words") < MIN_WORDS)
              | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")))
    verdict = F.when(F.col("base_failed"), F.lit(False)).otherwise(
        cascade(extra_rules(F.col("_t"), F.col("_w")), order).isNull())
    return (counted.withColumn("base_failed", failed).withColumn("kept", verdict)
            .select(F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept"))


def op2_quality_rules(spark, d):
    return judge(spark.read.parquet(f"{d}/documents.parquet"))


SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
pos AS (
  SELECT doc_id, unnest(range(1, len(ws) - {WINDOW - 2})) AS i, ws FROM w WHERE len(ws) > {WINDOW}),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g FROM pos),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
nxt AS (SELECT doc_id, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i,
                                                {WINDOW})) AS span FROM rep),
cov AS (SELECT doc_id, sum(span)::BIGINT AS n FROM nxt GROUP BY doc_id),
s AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS caps,
         len(list_filter(ws, lambda x, i: i > 1 AND x = ws[i - 1])) AS stutter
  FROM w LEFT JOIN cov USING (doc_id)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
             AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > {MAX_SYMBOL_PERCENT} * n_words
            OR 100 * caps > {MAX_CAPITAL_PERCENT} * word_chars
            OR 100 * stutter > {MAX_STUTTER_PERCENT} * n_words
            OR 100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines
            OR word_chars > {MAX_MEAN_WORD} * n_words) AS kept
FROM v
"""

QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLE = {"op2_quality_rules": SQL}
