"""DuckDB SQL for each registered query (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver's
tables, from the semantics in SURVEY §2.  Fragments are named CTEs; each
query lists the fragments it needs and they are pulled in with their
dependencies.  Floating results are rounded exactly where the Spark query
wrappers round them.
"""

from __future__ import annotations

PREFIX = "MUSIC_LISTENING_PREFIX:"

# name -> (sql body, dependencies)
CTE: dict[str, tuple[str, list[str]]] = {
    "weights": ("""
        SELECT CAST(o.o_custkey AS INTEGER) AS uid, CAST(l.l_partkey AS INTEGER) AS mid,
               CAST(SUM(l.l_quantity) AS BIGINT) AS weight
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        GROUP BY 1, 2""", []),
    "stats": ("""
        SELECT count(*) AS n, CAST(sum(weight) AS BIGINT) AS total, CAST(any_value(mean) AS BIGINT) AS mean,
               sqrt(CAST(sum((weight - mean) * (weight - mean)) AS DOUBLE) / count(*)) AS std
        FROM weights CROSS JOIN (SELECT CASE WHEN count(*) > 0 THEN sum(weight) // count(*) END AS mean
                                 FROM weights)""",
              ["weights"]),
    "zscored": ("""
        SELECT w.uid, w.mid, w.weight, CAST(w.weight - s.mean AS DOUBLE) / s.std AS score
        FROM weights w CROSS JOIN stats s""", ["weights", "stats"]),
    "splitted": ("""
        SELECT *, CASE WHEN CAST('0x' || substr(md5(concat_ws('|', uid, mid, '42')), 1, 8)
                                 AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split
        FROM zscored""", ["zscored"]),
    "catalog": ("""
        SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
               '/item/' || CAST(p_partkey AS VARCHAR) AS url
        FROM part""", []),
    "clicks": ("""
        SELECT event_id, CAST(user_id AS INTEGER) AS uid,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
               CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts
        FROM events WHERE event_type = 'click'""", []),
    "stored": ("""
        SELECT CAST(user_id AS INTEGER) AS uid,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid, COUNT(*) AS weight
        FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""", []),
    "log_lines": (f"""
        SELECT event_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S') || ','
                 || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0')
                 || '  INFO --- '
                 || CASE WHEN event_type = 'click'
                         THEN '{PREFIX}' || CAST(user_id AS VARCHAR) || '|'
                              || json_extract_string(props, '$.k') || '|'
                              || CAST(epoch_us(ts) // 1000000 AS VARCHAR)
                         ELSE concat_ws(' ', event_type, CAST(user_id AS VARCHAR),
                                        json_extract_string(props, '$.k')) END AS value
        FROM events""", []),
    "log_parsed": (f"""
        SELECT event_id, value, has, f,
               CASE WHEN regexp_full_match(f[1], '[+-]?[0-9]+') THEN TRY_CAST(f[1] AS INTEGER) END AS uid,
               CASE WHEN regexp_full_match(f[2], '[+-]?[0-9]+') THEN TRY_CAST(f[2] AS INTEGER) END AS mid,
               CASE WHEN regexp_full_match(f[3], '[+-]?[0-9]+') THEN TRY_CAST(f[3] AS BIGINT) END AS ts
        FROM (SELECT event_id, value, contains(value, '{PREFIX}') AS has,
                     string_split(regexp_replace(trim(string_split(value, '{PREFIX}')[-1]),
                                                 '\\|+$', ''), '|') AS f
              FROM log_lines)""", ["log_lines"]),
    "log_checked": ("""
        SELECT *, CASE WHEN NOT has THEN 'no_prefix' WHEN len(f) < 3 THEN 'too_few_fields'
                       WHEN uid IS NULL OR mid IS NULL OR ts IS NULL THEN 'not_an_int' END AS reason
        FROM log_parsed""", ["log_parsed"]),
    "vec": ("""
        SELECT CAST(vec_id AS INTEGER) AS mid, CAST(embedding AS DOUBLE[]) AS v FROM embeddings""", []),
    "cos": ("""
        SELECT a.mid, b.mid AS nb_mid, round(list_cosine_similarity(a.v, b.v), 6) AS score
        FROM vec a JOIN vec b ON a.mid <> b.mid""", ["vec"]),
    "similar_list": ("""
        SELECT * FROM (
          SELECT mid, nb_mid, score,
                 CAST(row_number() OVER (PARTITION BY mid ORDER BY score DESC, nb_mid) AS INTEGER) AS rank
          FROM cos WHERE score > 0.4)
        WHERE rank <= 100""", ["cos"]),
    "sims": ("""
        SELECT * FROM (
          SELECT mid, nb_mid, score,
                 CAST(row_number() OVER (PARTITION BY mid ORDER BY score DESC, nb_mid) AS INTEGER) AS rank
          FROM cos WHERE score > 0.1)
        WHERE rank <= 100""", ["cos"]),
    "seq": ("""
        SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts, event_id) AS seq FROM clicks""",
            ["clicks"]),
    "last_click": ("""
        SELECT uid, event_id FROM (
          SELECT uid, event_id, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn
          FROM clicks) WHERE rn = 1""", ["clicks"]),
    "rated": ("""
        SELECT uid, mid, MIN(from_seq) AS from_seq FROM (
          SELECT uid, mid, 0 AS from_seq FROM stored
          UNION ALL SELECT uid, mid, seq FROM seq) GROUP BY 1, 2""", ["stored", "seq"]),
    "recents": ("""
        SELECT t.event_id, t.uid, s.mid AS r_mid, t.seq - s.seq + 1 AS r_pos
        FROM seq t JOIN seq s ON s.uid = t.uid AND s.seq BETWEEN t.seq - 19 AND t.seq""", ["seq"]),
    "cands": ("""
        SELECT * FROM (
          SELECT t.event_id, t.uid, t.seq, n.nb_mid AS cand, n.score AS sim,
                 row_number() OVER (PARTITION BY t.event_id ORDER BY n.score DESC, n.nb_mid) AS cand_rank
          FROM seq t JOIN sims n ON n.mid = t.mid
          WHERE NOT EXISTS (SELECT 1 FROM rated r
                            WHERE r.uid = t.uid AND r.mid = n.nb_mid AND r.from_seq <= t.seq))
        WHERE cand_rank <= 20""", ["seq", "sims", "rated"]),
    "scored": ("""
        SELECT event_id, uid, mid, score,
               CAST(row_number() OVER (PARTITION BY event_id ORDER BY score DESC, mid) AS INTEGER) AS rank
        FROM (SELECT c.event_id, c.uid, c.cand AS mid,
                     round(AVG(COALESCE(n.score, 0.0)) + log10(COUNT(*)), 9) AS score
              FROM cands c JOIN recents r ON r.event_id = c.event_id
              LEFT JOIN sims n ON n.mid = c.cand AND n.nb_mid = r.r_mid
              GROUP BY 1, 2, 3)""", ["cands", "recents", "sims"]),
    "latest": ("""
        SELECT s.uid, s.event_id, s.mid, s.score, s.rank
        FROM scored s JOIN last_click l ON l.uid = s.uid AND l.event_id = s.event_id""",
               ["scored", "last_click"]),
    "ratings_now": ("""
        SELECT uid, mid, CAST(SUM(weight) AS BIGINT) AS weight FROM (
          SELECT uid, mid, CAST(weight AS BIGINT) AS weight FROM stored
          UNION ALL SELECT uid, mid, 1 FROM clicks) GROUP BY 1, 2""", ["stored", "clicks"]),
    "queue": ("""
        SELECT uid, pos, mid FROM (
          SELECT uid, mid,
                 CAST(row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS INTEGER) AS pos
          FROM clicks) WHERE pos <= 40""", ["clicks"]),
    "history_items": ("""
        SELECT uid, mid, MIN(pos) AS pos FROM queue WHERE pos <= 20 GROUP BY 1, 2""", ["queue"]),
    "fav_items": ("""
        SELECT uid, pos, mid FROM (
          SELECT uid, mid,
                 CAST(row_number() OVER (PARTITION BY uid ORDER BY weight DESC, mid) AS INTEGER) AS pos
          FROM (SELECT uid, mid, MAX(weight) AS weight FROM ratings_now GROUP BY 1, 2))
        WHERE pos <= 20""", ["ratings_now"]),
    "recs_score_items": ("""
        SELECT uid, rank AS pos, mid FROM latest WHERE rank <= 20""", ["latest"]),
    "recs_mid_items": ("""
        SELECT uid, pos, mid FROM (
          SELECT uid, mid,
                 CAST(row_number() OVER (PARTITION BY uid ORDER BY mid DESC) AS INTEGER) AS pos
          FROM latest) WHERE pos <= 20""", ["latest"]),
}


def _enrich(items: str) -> str:
    return f"""
        SELECT i.uid, CAST(i.pos AS INTEGER) AS pos, i.mid, c.name, c.url,
               CAST(COALESCE(r.weight, 0) AS INTEGER) AS clicks
        FROM {items} i JOIN catalog c ON c.mid = i.mid
        LEFT JOIN ratings_now r ON r.uid = i.uid AND r.mid = i.mid"""


CTE["history"] = (_enrich("history_items"), ["history_items", "catalog", "ratings_now"])
CTE["favourites"] = (_enrich("fav_items"), ["fav_items", "catalog", "ratings_now"])
CTE["recs_by_score"] = (_enrich("recs_score_items"), ["recs_score_items", "catalog", "ratings_now"])
CTE["recs_by_mid"] = (_enrich("recs_mid_items"), ["recs_mid_items", "catalog", "ratings_now"])


def _with(final: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in CTE[n][1]:
            visit(dep)
        order.append(n)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTE[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}" if order else final


ITEMS = "SELECT uid, pos, mid, name, url, clicks FROM"

ORACLE = {
    "parse_interactions": _with("""
        SELECT CASE WHEN regexp_full_match(f[1], '[+-]?[0-9]+') THEN TRY_CAST(f[1] AS INTEGER) END AS uid,
               CASE WHEN regexp_full_match(f[2], '[+-]?[0-9]+') THEN TRY_CAST(f[2] AS INTEGER) END AS mid,
               CAST(CASE WHEN regexp_full_match(f[3], '[+-]?[0-9]+') THEN TRY_CAST(f[3] AS INTEGER) END
                    AS BIGINT) AS weight
        FROM (SELECT string_split(regexp_replace(concat_ws(',', uid, mid, weight), ',+$', ''), ',') AS f
              FROM weights)
        WHERE len(f) >= 3""", ["weights"]),
    "parse_catalog": _with("""
        SELECT CAST(f[1] AS INTEGER) AS mid, trim(f[2]) AS name, trim(f[3]) AS url
        FROM (SELECT string_split(regexp_replace(concat_ws(',', mid, name, url), ',+$', ''), ',') AS f
              FROM catalog)
        WHERE len(f) >= 3 AND regexp_full_match(f[1], '[+-]?[0-9]+')""", ["catalog"]),
    "catalog_projection": _with("""
        SELECT CAST(f[1] AS INTEGER) AS mid, trim(f[2]) AS name, trim(f[3]) AS url
        FROM (SELECT string_split(regexp_replace(concat_ws(',', mid, name, url), ',+$', ''), ',') AS f
              FROM catalog)
        WHERE len(f) >= 3 AND regexp_full_match(f[1], '[+-]?[0-9]+')""", ["catalog"]),
    "stored_ratings_roundtrip": _with("SELECT uid, mid, weight, score FROM zscored", ["zscored"]),
    "stored_table_roundtrip": _with("SELECT mid, name, url FROM catalog", ["catalog"]),
    "format_click_log": _with(f"""
        SELECT event_id, '{PREFIX}' || CAST(uid AS VARCHAR) || '|' || CAST(mid AS VARCHAR) || '|'
                         || CAST(ts AS VARCHAR) AS line
        FROM clicks""", ["clicks"]),
    "parse_click_log": _with("""
        SELECT event_id, uid, mid, ts FROM log_checked WHERE reason IS NULL""", ["log_checked"]),
    "click_log_rejects": _with("""
        SELECT event_id, value AS line, reason FROM log_checked WHERE reason IS NOT NULL""",
                               ["log_checked"]),
    "weight_stats": _with("SELECT n, total, mean, std FROM stats", ["stats"]),
    "zscore_ratings": _with("SELECT uid, mid, weight, score FROM zscored", ["zscored"]),
    "train_test_split": _with("SELECT uid, mid, score, split FROM splitted", ["splitted"]),
    "rmse_baseline": _with("""
        SELECT COUNT(*) AS n, round(sqrt(AVG(pow(t.score - p.prediction, 2))), 9) AS rmse
        FROM (SELECT * FROM splitted WHERE split = 'test') t
        JOIN (SELECT mid, AVG(score) AS prediction FROM splitted WHERE split = 'train' GROUP BY mid) p
          ON p.mid = t.mid""", ["splitted"]),
    "item_cosine_pairs": _with("SELECT mid, nb_mid, score FROM cos WHERE score > 0.4", ["cos"]),
    "similar_items": _with("SELECT mid, nb_mid, score, rank FROM similar_list", ["similar_list"]),
    "item_neighbours_nested": _with("SELECT mid, rank AS pos, nb_mid, score FROM similar_list",
                                    ["similar_list"]),
    "recent_queue": _with("SELECT uid, pos, mid FROM queue", ["queue"]),
    "recent_clicks": _with("SELECT uid, pos, mid FROM queue WHERE pos <= 20", ["queue"]),
    "click_candidates": _with("""
        SELECT event_id, uid, cand AS mid, sim, CAST(cand_rank AS INTEGER) AS cand_rank FROM cands""",
                              ["cands"]),
    "realtime_scores": _with("SELECT uid, event_id, mid, score, rank FROM latest", ["latest"]),
    "realtime_recs_all_clicks": _with("SELECT event_id, uid, mid, score, rank FROM scored",
                                      ["scored"]),
    "realtime_recs_latest": _with("SELECT uid, event_id, mid, score, rank FROM latest", ["latest"]),
    "stream_recs_latest": _with("SELECT uid, mid, score, rank FROM latest", ["latest"]),
    "stream_queue": _with("SELECT uid, pos, mid FROM queue", ["queue"]),
    "weight_stats_after_clicks": _with("""
        SELECT CAST(n AS BIGINT) AS n, CAST(total AS BIGINT) AS total, CAST(mean AS BIGINT) AS mean,
               sqrt(CAST(sq - 2 * mean * total + n * mean * mean AS DOUBLE) / n) AS std
        FROM (SELECT n, total, sq, total // n AS mean
              FROM (SELECT count(*) AS n, sum(weight) AS total, sum(CAST(weight AS HUGEINT) * weight) AS sq
                    FROM ratings_now))""", ["ratings_now"]),
    "clicked_ratings": _with("""
        SELECT c.uid, c.mid, s.weight FROM (SELECT DISTINCT uid, mid FROM clicks) c
        LEFT JOIN stored s ON s.uid = c.uid AND s.mid = c.mid""", ["clicks", "stored"]),
    "ratings_after_clicks": _with("SELECT uid, mid, weight FROM ratings_now", ["ratings_now"]),
    "enrich_items": _with(_enrich("(SELECT * FROM queue WHERE pos <= 20)"),
                          ["queue", "catalog", "ratings_now"]),
    "user_history": _with(f"{ITEMS} history", ["history"]),
    "user_favourites": _with(f"{ITEMS} favourites", ["favourites"]),
    "user_recs_by_score": _with(f"{ITEMS} recs_by_score", ["recs_by_score"]),
    "user_recs_by_mid": _with(f"{ITEMS} recs_by_mid", ["recs_by_mid"]),
    "user_status": _with("""
        SELECT u.uid, CASE WHEN h.event_id IS NULL THEN 'waiting'
                           WHEN l.event_id IS NULL OR h.event_id = l.event_id THEN 'done'
                           ELSE 'waiting' END AS status
        FROM (SELECT DISTINCT uid FROM (SELECT uid FROM stored UNION ALL SELECT uid FROM clicks)) u
        LEFT JOIN (SELECT uid, max_by(event_id, (ts, event_id)) AS event_id FROM clicks
                   WHERE ts <= (SELECT min(ts) + (max(ts) - min(ts)) // 2 FROM clicks) GROUP BY uid) h ON h.uid = u.uid
        LEFT JOIN last_click l ON l.uid = u.uid""", ["stored", "clicks", "last_click"]),
    "best_config": """
        SELECT CAST(l_linenumber AS INTEGER) AS rank, l_discount AS reg, avg(l_quantity) AS rmse
        FROM lineitem GROUP BY 1, 2 ORDER BY 3, 1, 2 LIMIT 1""",
    "als_factor_shape": _with("SELECT DISTINCT mid, 100 AS dim FROM zscored WHERE score IS NOT NULL", ["zscored"]),
    "als_grid": _with("""
        SELECT CAST(rank AS INTEGER) AS rank, reg, n, n > 0 AS has_rmse
        FROM (VALUES (50), (100), (200), (300)) AS r(rank),
             (VALUES (CAST(0.01 AS DOUBLE)), (CAST(0.1 AS DOUBLE)), (CAST(1 AS DOUBLE))) AS g(reg),
             (SELECT count(*) AS n FROM splitted t
              WHERE split = 'test' AND score IS NOT NULL
                AND uid IN (SELECT uid FROM splitted WHERE split = 'train' AND score IS NOT NULL)
                AND mid IN (SELECT mid FROM splitted WHERE split = 'train' AND score IS NOT NULL))""", ["splitted"]),
    "als_test_pairs": _with("""
        SELECT count(*) AS n, count(*) AS n_agree FROM splitted t
        WHERE split = 'test' AND score IS NOT NULL
          AND uid IN (SELECT uid FROM splitted WHERE split = 'train' AND score IS NOT NULL)
          AND mid IN (SELECT mid FROM splitted WHERE split = 'train' AND score IS NOT NULL)""", ["splitted"]),
    "user_dashboard": _with(f"""
        SELECT 'history' AS section, * FROM ({ITEMS} history)
        UNION ALL SELECT 'recommendations' AS section, * FROM ({ITEMS} recs_by_score)
        UNION ALL SELECT 'favourites' AS section, * FROM ({ITEMS} favourites)""",
                            ["history", "recs_by_score", "favourites"]),
}
