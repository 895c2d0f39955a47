"""URL filter: rule lists, and gradient-boosted trees where no rule speaks.

Rules such as ``net/es/`` fit a host and all its subdomains when the path
starts with the rule's path; the longest rule that fits decides.  Every URL
that a rule decides is a labelled URL.  Trees learn from the lexical features
of those URLs (length, depth, digit ratio, entropy, parameter counts and the
block rates of the host's suffixes) and judge the rest.

The suffix statistics count all labelled URLs; a training row sees them without
its own quarter of the URLs.  The trees are fitted on at
most about ``TRAIN_URLS`` distinct labelled URLs, taken by a hash of the URL,
so the same URLs are taken at any partitioning.  Rules are a short list given
by the user (at most ``MAX_RULES``); they become column expressions.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is judged by the trees like any other.  When the
labelled URLs know one class only, that class is the verdict, and ``allow``
when there are none.  Equal URLs get equal verdicts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.names import quoted
from encore.session import materialize

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
MAX_RULES = 1000
TRAIN_URLS = 20_000      # bound of the trees' training sample
TRAIN_TASKS = 4          # tasks that hold the written sample while the trees grow
TREES, DEPTH = 8, 3
FOLDS = 4                # a training row's suffix rates leave out its own fold
PRIOR = 10.0             # weight of the overall block rate in a suffix's rate

FEATURES = ["length", "depth", "digit_ratio", "entropy", "n_params", "n_labels", "hyphens",
            "path_length", "rate_1", "rate_2"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.char_length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null where none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules are compiled into expressions")
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    u = F.coalesce(url, F.lit(""))
    n = F.greatest(F.char_length(u), F.lit(1)).cast("double")
    share = lambda c: (F.char_length(u) - F.char_length(F.replace(u, c, F.lit("")))) / n
    chars = F.filter(F.array_distinct(F.split(u, "")), lambda c: c != "")
    labels = F.split(host, r"\.")
    return {
        "length": n,
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")).cast("double"),
        "digit_ratio": (F.char_length(u) - F.char_length(F.regexp_replace(u, "[0-9]+", ""))) / n,
        "entropy": F.aggregate(F.transform(chars, share), F.lit(0.0), lambda acc, p: acc - p * F.log2(p)),
        "n_params": F.size(F.filter(F.split(F.regexp_extract(u, r"(?s)\?([^#]*)", 1), "&"),
                                    lambda p: p != "")).cast("double"),
        "n_labels": F.size(labels).cast("double"),
        "hyphens": F.regexp_count(host, F.lit("-")).cast("double"),
        "path_length": F.char_length(path).cast("double"),
        "suffix_1": F.element_at(labels, -1),
        "suffix_2": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), "."),
    }


def _fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(1)), F.lit(FOLDS)).cast("int")


def _rates(labelled: DataFrame, suffix: str, overall: float) -> DataFrame:
    """Smoothed block rate of each host suffix over all labelled URLs, and
    without those of each fold, for the rows of that fold."""
    fold = _fold(F.col("_url"))

    def rate(where: Column) -> Column:
        return ((F.coalesce(F.sum(F.when(where, F.col("label"))), F.lit(0.0)) + F.lit(PRIOR * overall))
                / (F.count_if(where) + F.lit(PRIOR)))
    return labelled.groupBy(suffix).agg(
        rate(F.lit(True)).alias(suffix.replace("suffix", "rate")),
        F.array(*[rate(fold != k) for k in range(FOLDS)]).alias(suffix.replace("suffix", "without")))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          train_urls: int = TRAIN_URLS) -> DataFrame:
    """``(id_col, host, path, rule, verdict, score)`` of every row; ``score``
    is the trees' probability of ``block``, null where a rule decided."""
    host, path = host_and_path(F.col("_url"))
    rows = (pages.select(pages[quoted(id_col)].alias("_id"), pages[quoted(url_col)].alias("_url"))
            .withColumns({"host": host, "path": path}))
    rule, kind = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "kind": kind})
    seen = materialize(
        rows.where("kind IS NOT NULL").select("_url", "host", "path", "kind").distinct()
        .withColumns(lexical(F.col("_url"), F.col("host"), F.col("path")))
        .withColumn("label", (F.col("kind") == "block").cast("double"))
        .drop("host", "path", "kind"), "urls")
    total = seen.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked")).first()
    n, blocked = total["n"], total["blocked"] or 0.0
    decided = rows.where("kind IS NOT NULL").select(
        F.col("_id").alias(id_col), "host", "path", "rule", F.col("kind").alias("verdict"),
        F.lit(None).cast("double").alias("score"))
    rest = rows.where("kind IS NULL")
    if blocked in (0.0, float(n)):
        only = "block" if n and blocked else "allow"
        judged = rest.select(F.col("_id").alias(id_col), "host", "path", "rule",
                             F.lit(only).alias("verdict"), F.lit(float(only == "block")).alias("score"))
        return decided.unionByName(judged)

    overall = blocked / n
    rates = {s: materialize(_rates(seen, s, overall), "rates") for s in ("suffix_1", "suffix_2")}

    def featured(df: DataFrame, training: bool = False) -> DataFrame:
        df = reduce(lambda x, s: x.join(rates[s], s, "left"), rates, df)
        if training:      # a rate that knows the row's own label would give it away
            df = df.withColumns({f"rate_{k}": F.get(f"without_{k}", _fold(F.col("_url"))) for k in (1, 2)})
        return df.fillna(overall, ["rate_1", "rate_2"])

    share = min(1.0, train_urls / n)
    sample = seen.where(F.pmod(F.xxhash64("_url"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # the sample is written by the tasks that read it, and gathered only then
    train = materialize(vector.transform(featured(sample, training=True)).select("features", "label"), "train")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7).fit(train.repartition(TRAIN_TASKS))
    scored = model.transform(vector.transform(featured(
        rest.withColumns(lexical(F.col("_url"), F.col("host"), F.col("path"))))))
    judged = scored.withColumn("score", vector_to_array("probability")[1]).select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.when(F.col("score") >= 0.5, "block").otherwise("allow").alias("verdict"), "score")
    return decided.unionByName(judged)


def op1_url_filter(spark, d):
    return judge(spark.read.parquet(f"{d}/pages.parquet"))


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLE: dict[str, str] = {}
