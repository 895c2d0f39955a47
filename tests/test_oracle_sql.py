"""Every oracle statement binds in DuckDB over the given tables and has the
column names the Spark query produces (compared by name, as the driver does)."""

import duckdb
import pytest

from conftest import SF001
import __spark_entry__ as E
from encore.plans.oracle import ORACLE

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Spark output columns, read from the registered queries' projections.
EXPECTED = {
    "weight_stats": ["n", "total", "mean", "std"],
    "zscore_ratings": ["uid", "mid", "weight", "score"],
    "similar_items": ["mid", "nb_mid", "score", "rank"],
    "realtime_recs_latest": ["uid", "event_id", "mid", "score", "rank"],
    "stream_recs_latest": ["uid", "mid", "score", "rank"],
    "user_dashboard": ["section", "uid", "pos", "mid", "name", "url", "clicks"],
    "user_status": ["uid", "status"],
    "best_config": ["rank", "reg", "rmse"],
    "als_factor_shape": ["mid", "dim"],
    "als_test_pairs": ["n", "n_agree"],
    "als_grid": ["rank", "reg", "n", "has_rmse"],
    "weight_stats_after_clicks": ["n", "total", "mean", "std"],
    "clicked_ratings": ["uid", "mid", "weight"],
    "stream_queue": ["uid", "pos", "mid"],
    "click_candidates": ["event_id", "uid", "mid", "sim", "cand_rank"],
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_oracle_binds(con):
    sqls = E.oracle_sql()
    assert len(ORACLE) == 37 and set(ORACLE) <= set(sqls) <= set(E.queries())
    for name, sql in sqls.items():
        cols = [r[0] for r in con.sql(f"DESCRIBE {sql}").fetchall()]
        assert len(cols) == len(set(cols)), name
        if name in EXPECTED:
            assert sorted(cols) == sorted(EXPECTED[name]), name
