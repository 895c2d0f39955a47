"""Quality classifier: a sparse ensemble of rules.

1. Statistics of every text are Spark columns (shares of symbols, capitals,
   digits, repeated lines and words, lengths).
2. Boosted shallow trees are fitted on a bounded sample of labelled texts, and
   every path from a root becomes one conjunctive rule over the statistics.
3. A logistic regression with an L1 penalty weighs the rules on the same
   sample; most weights are zero.
4. The rules that remain are compiled into one column expression, so a text is
   scored in the scan, without a model object or Python.

Labels count only where crc32(id as text) mod 4 is not 2; the rest is held
out.  The sample is at most about ``TRAIN_TEXTS`` labelled texts, taken by a
hash of the id; its ids are the only thing broadcast.  Language, source and id
are never inputs.

Defined results: null and empty texts have zero statistics and the score of
such a text.  Without labels of both classes the score is the labels' mean, or
1 without labels.  A null id is not held out.  Repeated rows get equal scores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm import quality_rules as q
from encore.session import materialize

TRAIN_TEXTS = 20_000     # bound of the labelled sample
TRAIN_TASKS = 4          # tasks that hold the written sample while models are fitted
TREES, DEPTH = 12, 3
LASSO = 0.002
THRESHOLD = 0.7


def statistics(text: Column, ws: Column) -> dict[str, Column]:
    t = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.char_length(t), F.lit(1)).cast("double")
    n = F.greatest(F.size(ws), F.lit(1)).cast("double")
    count = lambda pattern: F.char_length(t) - F.char_length(F.regexp_replace(t, pattern, ""))
    lines = F.greatest(F.char_length(t) - F.char_length(F.replace(t, F.lit("\n"), F.lit(""))) + 1, F.lit(1))
    return {
        "log_words": F.log1p(F.size(ws).cast("double")),
        "mean_word": q.word_chars(ws) / n,
        "distinct_words": F.size(F.array_distinct(ws)) / n,
        "symbols": q.symbols(t) / n,
        "capitals": q.capitals(t) / chars,
        "digits": count("[0-9]+") / chars,
        "stops": count("[.,;]+") / n,
        "marks": count("[!?]+") / n,
        "dup_lines": q.dup_lines(t) / lines,
        "words_per_line": F.log1p(F.size(ws) / lines),
    }


def featured(docs: DataFrame, text_col: str, keep: list) -> DataFrame:
    base = docs.select(*keep, F.col(text_col).alias("_t"), q.words(F.col(text_col)).alias("_w"))
    stats = statistics(F.col("_t"), F.col("_w"))
    return base.select(*[c for c in base.columns if c not in ("_t", "_w")],
                       *[c.alias(k) for k, c in stats.items()])


STATISTICS = ["log_words", "mean_word", "distinct_words", "symbols", "capitals", "digits", "stops",
              "marks", "dup_lines", "words_per_line"]

Condition = tuple[int, bool, float]      # feature, greater than, bound


def tree_paths(model) -> list[tuple[Condition, ...]]:
    """The conjunctions of all paths from a root to a node below it."""
    found = set()

    def walk(node, path):
        if path:
            found.add(tuple(sorted(path)))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        at, bound = split.featureIndex(), split.threshold()
        walk(node.leftChild(), path + [(at, False, bound)])
        walk(node.rightChild(), path + [(at, True, bound)])

    for tree in model.trees:
        walk(tree._call_java("rootNode"), [])
    return sorted(found)


def condition(path: tuple[Condition, ...]) -> Column:
    return reduce(lambda a, b: a & b, [
        (F.col(STATISTICS[at]) > bound) if above else (F.col(STATISTICS[at]) <= bound)
        for at, above, bound in path])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", train_texts: int = TRAIN_TEXTS) -> Column:
    """The score as a column over ``featured`` rows."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("double").alias("label")))
    total = known.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).first()
    if not total["n"]:
        return F.lit(1.0)
    if total["mean"] in (0.0, 1.0):
        return F.lit(total["mean"])
    share = min(1.0, train_texts / total["n"])
    sample = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    # at most about train_texts rows of two numbers: a proven bound
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(sample), "_id").select("_text", "label")
    # the tasks that read the texts write the sample; it is gathered only then
    train = materialize(featured(rows, "_text", ["label"]), "train").repartition(TRAIN_TASKS)
    seen = train.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).first()
    if not seen["n"] or seen["mean"] in (0.0, 1.0):
        return F.lit(seen["mean"] if seen["n"] else total["mean"])
    vector = VectorAssembler(inputCols=STATISTICS, outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=11).fit(
        materialize(vector.transform(train).select("features", "label"), "train"))
    paths = tree_paths(trees)
    fired = train.select("label", *[condition(p).cast("double").alias(f"r{i}") for i, p in enumerate(paths)])
    rules = VectorAssembler(inputCols=[f"r{i}" for i in range(len(paths))], outputCol="features")
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, standardization=False).fit(
        materialize(rules.transform(fired).select("features", "label"), "train"))
    weighed = [(p, w) for p, w in zip(paths, lasso.coefficients.toArray()) if w != 0.0]
    z = reduce(lambda a, b: a + b, [F.when(condition(p), F.lit(float(w))).otherwise(F.lit(0.0))
                                    for p, w in weighed], F.lit(float(lasso.intercept)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", train_texts: int = TRAIN_TEXTS) -> DataFrame:
    """``(id_col, held_out, score, predicted)`` of every row of ``docs``."""
    model = fit(docs, labels, id_col, text_col, label_col, train_texts)
    rows = featured(docs, text_col, [F.col(id_col).alias("_id")])
    return (rows.withColumn("score", model)
            .select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def op10_quality_classifier(spark, d):
    return score(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))


QUERIES = {"op10_quality_classifier": op10_quality_classifier}
ORACLE: dict[str, str] = {}
