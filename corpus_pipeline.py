"""Corpus pipeline: five stages over ``documents``, each one operator.

Every stage takes ``(spark, docs, sf_dir)``; what it returns is written as
Parquet in the shared folder and reread as the next stage's ``docs``.  All but
the last return the columns of ``documents``; the last places every remaining
document in a batch.

What a stage left in the scratch folder is dropped when the next stage begins,
because its result is written by then; folders that the next stage's ``docs``
still read stay.

Defined results: a null or empty text is rejected by the first stage, so later
stages never see one; null ids and repeated rows are rows like others (of equal
texts one row stays); an empty table passes every stage and packs no row;
columns other than those of ``documents`` are not carried.
"""

from functools import wraps

from encore.llm import exact_dedup, near_dedup, packing, pii, quality_rules
from encore.session import materialize, release, scratch_paths

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_left_over: list[str] = []        # scratch folders of the stage before


def stage(f):
    """Drops what the stage before left over, and notes what this one leaves.
    The last stage notes nothing: its result is the pipeline's and may be read
    at any time."""
    @wraps(f)
    def run_stage(spark, docs, sf_dir):
        release(spark, _left_over, docs)
        before = set(scratch_paths(spark))
        out = f(spark, docs, sf_dir)
        _left_over[:] = [p for p in scratch_paths(spark) if p not in before and f is not batches.__wrapped__]
        return out
    return run_stage


@stage
def quality(spark, docs, sf_dir):
    """Documents that a quality rule rejects go."""
    return quality_rules.keep_good(docs).select(COLUMNS)


@stage
def exact_copies(spark, docs, sf_dir):
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.deduplicate(docs).select(COLUMNS)


@stage
def near_copies(spark, docs, sf_dir):
    """One document of each group of near duplicates stays (five words, 0.8)."""
    return near_dedup.deduplicate(docs).select(COLUMNS)


@stage
def personal_data(spark, docs, sf_dir):
    """Personal data becomes pseudonyms of the same format."""
    return pii.mask(docs).select(COLUMNS)


@stage
def batches(spark, docs, sf_dir):
    """Every document gets its length bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("exact dedup", exact_copies), ("near dedup", near_copies),
          ("PII", personal_data), ("packing", batches)]

ORACLE_SQL = None        # near duplicates and packing have no SQL form


def run(spark, sf_dir):
    before = set(scratch_paths(spark))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = materialize(step(spark, docs, sf_dir), "stage")
        release(spark, [p for p in scratch_paths(spark) if p not in before], docs)
    return STAGES[-1][1](spark, docs, sf_dir)
