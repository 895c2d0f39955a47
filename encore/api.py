"""User-level API: every function takes and returns DataFrames
(``run_stream`` returns a ``StreamingQuery``).

    from encore import api
    ok, rejects = api.read_interactions(spark, "s3://.../plays/")
    ratings = api.zscore(ok)
    model = api.fit_factors(ratings)
    sims = api.item_similarity(api.item_factors(model))
"""

from encore.operators.factors import (best_config, fit_factors, fit_with_hot_users, grid_search, item_factors,
                                      model_rmse, predict_pairs, rmse, solve_users, split_ratings, train_test)
from encore.operators.normalize import weight_stats, zscore
from encore.operators.realtime import (click_candidates as candidates, latest_recs,
                                       latest_recs_nested, recent_clicks, recent_queue,
                                       replay as score_clicks)
from encore.operators.ratings import RatingTable
from encore.operators.serving import (apply_clicks, enrich_items, user_dashboard,
                                      user_favourites, user_history, user_recs, user_status)
from encore.operators.similarity import cosine_pairs, item_similarity, nest_neighbours
from encore.sources.neighbours import Neighbours, publish as publish_similar
from encore.sources.sinks import read_ratings, write_ratings, write_table
from encore.sources.tables import read_table
from encore.sources.text import (format_click_log, parse_catalog, parse_click_log,
                                 parse_interactions, read_catalog, read_interactions)
from encore.streaming.stream import (compact_stream, latest_stream_recs, run_stream, stream_counts,
                                     stream_queues, stream_user_status)

__all__ = [
    "read_interactions", "read_catalog", "parse_interactions", "parse_catalog", "read_table",
    "write_table", "write_ratings", "read_ratings", "weight_stats", "zscore", "split_ratings",
    "train_test", "fit_factors", "item_factors", "predict_pairs", "rmse", "model_rmse",
    "grid_search", "best_config", "item_similarity", "cosine_pairs", "nest_neighbours",
    "parse_click_log", "format_click_log", "recent_queue", "recent_clicks", "candidates",
    "score_clicks", "latest_recs", "latest_recs_nested", "apply_clicks", "user_history",
    "user_favourites", "user_recs", "user_status", "user_dashboard", "enrich_items",
    "run_stream", "latest_stream_recs", "compact_stream", "stream_user_status", "stream_counts", "stream_queues",
    "RatingTable", "Neighbours", "publish_similar", "fit_with_hot_users", "solve_users",
]
