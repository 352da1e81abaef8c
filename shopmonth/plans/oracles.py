"""The same results as plain SQL on the given tables."""

from __future__ import annotations

_DIRTY = """
dirty AS (
  SELECT event_time, event_type, product_id, category_code, brand, price, user_id, user_session
  FROM (
    SELECT e.ts AS event_time, e.event_type, e.k AS product_id,
           CASE WHEN e.k % 11 = 0 THEN NULL ELSE p.p_type END AS category_code,
           CASE WHEN e.k % 7 = 0 THEN NULL ELSE '  ' || upper(p.p_brand) || ' ' END AS brand,
           CASE WHEN e.event_id % 97 = 0 THEN -e.value
                WHEN e.event_id % 89 = 0 THEN NULL ELSE e.value END AS price,
           CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE e.user_id END AS user_id,
           CASE WHEN e.event_id % 83 = 0 THEN NULL
                ELSE CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) END AS user_session,
           unnest(CASE WHEN e.event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS copy
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
    LEFT JOIN part p ON p.p_partkey = e.k))"""

_FENCE = """
quartiles AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM dirty),
fence AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM quartiles)"""

_FENCE_COLUMNS = ("round(q1, 6) AS q1, round(q3, 6) AS q3, "
                  "round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound")

_KEPT = """
kept AS (
  SELECT DISTINCT event_time, event_type, product_id, coalesce(category_code, 'unknown') AS category_code,
         coalesce(brand, 'unknown') AS brand, price, user_id, user_session
  FROM dirty
  WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND user_session IS NOT NULL),
clean AS (
  SELECT event_time, event_type, product_id, trim(lower(category_code)) AS category_code,
         trim(lower(brand)) AS brand, price, user_id, user_session,
         CAST(year(event_time) AS INTEGER) AS event_year, CAST(month(event_time) AS INTEGER) AS event_month
  FROM kept, fence
  WHERE price >= 0 AND price BETWEEN lower_bound AND upper_bound)"""

_SHOP = """
shop AS (
  SELECT user_id, ts AS event_time, event_type, value AS price,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS user_session
  FROM events)"""

_ACTIVITY = _SHOP + """,
activity AS (
  SELECT user_id,
         count(*) FILTER (WHERE event_type = 'view') AS views,
         count(*) FILTER (WHERE event_type = 'click') AS carts,
         count(*) FILTER (WHERE event_type = 'error') AS removals,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
         count(DISTINCT user_session) AS sessions,
         coalesce(CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE), 0.0) AS total_spent
  FROM shop GROUP BY user_id)"""

_RFM = """
rfm AS (
  SELECT user_id,
         date_sub('day', max(event_time), (SELECT max(event_time) FROM shop)) AS recency,
         count(DISTINCT user_session) AS frequency,
         CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS monetary
  FROM shop GROUP BY user_id)"""

_FEATURES = ("views", "carts", "removals", "purchases", "sessions", "total_spent")

_LENGTHS = "WITH " + _ACTIVITY + "\nSELECT user_id, round(" + " + ".join(
    f"pow(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0.0), 2)"
    for c in _FEATURES) + ", 6) AS squared_length FROM activity"

_SCALED = "WITH " + _ACTIVITY + "\nSELECT user_id, " + ", ".join(
    f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0.0), 6) + 0.0 AS {c}_z"
    for c in _FEATURES) + " FROM activity"

# Distances to the three fixed centres, the lower id first.
_LABELLED = _ACTIVITY + """,
distances AS (
  SELECT *,
         (purchases - 10.0) * (purchases - 10.0) + (total_spent - 2000.0) * (total_spent - 2000.0) AS d0,
         (purchases - 13.0) * (purchases - 13.0) + (total_spent - 3000.0) * (total_spent - 3000.0) AS d1,
         (purchases - 16.0) * (purchases - 16.0) + (total_spent - 4000.0) * (total_spent - 4000.0) AS d2
  FROM activity),
labelled AS (
  SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster
  FROM distances)"""

_SEGMENT_JOIN = "WITH " + _LABELLED + """
SELECT s.user_id, s.event_time, s.event_type, s.price, s.user_session, l.cluster
FROM shop s LEFT JOIN labelled l ON l.user_id = s.user_id"""

_SILHOUETTE = "WITH " + _LABELLED + """,
pairs AS (
  SELECT a.user_id, a.cluster, b.cluster AS other,
         sum((a.purchases - b.purchases) * (a.purchases - b.purchases)
             + (a.total_spent - b.total_spent) * (a.total_spent - b.total_spent)) AS d,
         count(*) AS n
  FROM labelled a CROSS JOIN labelled b GROUP BY a.user_id, a.cluster, b.cluster),
scores AS (
  SELECT user_id, max(CASE WHEN other = cluster THEN n END) AS own_n,
         max(CASE WHEN other = cluster AND n > 1 THEN d / (n - 1) END) AS a,
         min(CASE WHEN other <> cluster THEN d / n END) AS b
  FROM pairs GROUP BY user_id)
SELECT round(avg(CASE WHEN own_n = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM scores"""

# K-means in whole numbers, step by step: moments, rounded values, seeds by hash, rounds for k = 2 … 10.
_Z = [f"z{k}" for k in range(len(_FEATURES))]
_KMEANS_ROUNDS, _MOST_CENTRES = 20, 10


def _distance(a: str, b: str) -> str:
    return "(" + " + ".join(f"({a}.{z} - {b}.{z}) * ({a}.{z} - {b}.{z})" for z in _Z) + ")"


def _whole_number_kmeans() -> str:
    units = {c: 100.0 if c == "total_spent" else 1.0 for c in _FEATURES}
    steps = [_ACTIVITY, "whole AS MATERIALIZED (SELECT user_id, " + ", ".join(
        f"CAST(floor(CAST({c} AS DOUBLE) * {u} + 0.5) AS HUGEINT) AS {c}" for c, u in units.items()) + " FROM activity)",
        "moments AS MATERIALIZED (SELECT " + ", ".join(
            f"CAST(sum({c}) AS DOUBLE) / count(*) AS m_{c}, sqrt(CAST(count(*) * sum({c} * {c}) - sum({c}) * sum({c}) AS DOUBLE) "
            f"/ CAST(count(*) * (count(*) - 1) AS DOUBLE)) AS s_{c}" for c in _FEATURES) + " FROM whole)",
        "points AS MATERIALIZED (SELECT user_id, " + ", ".join(
            f"CASE WHEN s_{c} = 0 THEN 0 ELSE CAST(floor((CAST({c} AS DOUBLE) - m_{c}) / s_{c} * 100000.0 + 0.5) AS BIGINT) END AS {z}"
            for c, z in zip(_FEATURES, _Z)) + " FROM whole, moments)",
        "seeds0 AS MATERIALIZED (SELECT 0 AS id, * EXCLUDE user_id FROM points ORDER BY md5('42:0:' || user_id), user_id LIMIT 1)"]
    for k in range(1, _MOST_CENTRES):
        steps.append(f"""seeds{k} AS MATERIALIZED (SELECT * FROM seeds{k - 1} UNION ALL (
          SELECT {k} AS id, {", ".join(_Z)} FROM (
            SELECT p.*, min({_distance("p", "s")}) AS near FROM points p, seeds{k - 1} s GROUP BY ALL) WHERE near > 0
          ORDER BY -ln(CAST(CAST('0x' || substr(md5('42:{k}:' || user_id), 1, 15) AS BIGINT) + 1 AS DOUBLE) / {float(1 << 60)}) / CAST(near AS DOUBLE),
                   user_id LIMIT 1))""")
    steps.append(f"runs AS (SELECT unnest(range(2, {_MOST_CENTRES + 1})) AS run), centres0 AS MATERIALIZED (SELECT run, s.* FROM runs JOIN seeds{_MOST_CENTRES - 1} s ON s.id < run)")
    for k in range(_KMEANS_ROUNDS + 1):
        steps.append(f"""near{k} AS MATERIALIZED (SELECT run, user_id, min(CAST(d AS HUGEINT) * 16 + id) AS best FROM (
          SELECT run, id, user_id, {_distance("p", "c")} AS d FROM points p, centres{k} c) GROUP BY run, user_id)""")
        moved = ", ".join(f"coalesce(m.{z}, c.{z}) AS {z}" for z in _Z)
        sums = ", ".join(f"CAST(floor(CAST(sum({z}) AS DOUBLE) / count(*) + 0.5) AS BIGINT) AS {z}" for z in _Z)
        steps.append(f"""centres{k + 1} AS MATERIALIZED (SELECT c.run, c.id, {moved} FROM centres{k} c LEFT JOIN (
          SELECT run, CAST(best % 16 AS INTEGER) AS id, {sums} FROM near{k} JOIN points USING (user_id) GROUP BY ALL) m USING (run, id))""")
    return "WITH " + ",\n".join(steps)


_WHOLE_KMEANS = _whole_number_kmeans()
_RANKED = f"""{_WHOLE_KMEANS},
ranked AS (SELECT CAST(row_number() OVER (ORDER BY z5, {", ".join(_Z)}) - 1 AS INTEGER) AS cluster, {", ".join(_Z)}
           FROM centres{_KMEANS_ROUNDS} WHERE run = 4)"""
_FIXED_KMEANS = f"""{_RANKED}
SELECT user_id, CAST(min(CAST({_distance("p", "r")} AS HUGEINT) * 16 + cluster) % 16 AS INTEGER) AS cluster
FROM points p, ranked r GROUP BY user_id"""
_FIXED_ELBOW = f"""{_WHOLE_KMEANS}
SELECT CAST(run AS INTEGER) AS k, round(CAST(sum(best // 16) AS DOUBLE) / 10000000000.0, 6) AS inertia FROM near{_KMEANS_ROUNDS} GROUP BY run"""
_ORDER_FEATURES = {"views": "count(*) FILTER (WHERE o_orderstatus = 'O')", "carts": "count(*) FILTER (WHERE o_orderstatus = 'P')",
                   "removals": "0", "purchases": "count(*) FILTER (WHERE o_orderstatus = 'F')", "sessions": "count(DISTINCT o_orderdate)",
                   "total_spent": "CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE)"}
_SCORED_ORDERS = f"""{_RANKED},
customers AS (SELECT o_custkey AS user_id, {", ".join(f"{e} AS {c}" for c, e in _ORDER_FEATURES.items())} FROM orders GROUP BY o_custkey),
placed AS (SELECT user_id, {", ".join(
    f"CASE WHEN s_{c} = 0 THEN 0 ELSE CAST(least(greatest(floor((floor(CAST({c} AS DOUBLE) * {100.0 if c == 'total_spent' else 1.0} + 0.5) - m_{c}) "
    f"/ s_{c} * 100000.0 + 0.5), -134217728), 134217728) AS BIGINT) END AS {z}" for c, z in zip(_FEATURES, _Z))} FROM customers, moments)
SELECT user_id, CAST(min(CAST({_distance("p", "r")} AS HUGEINT) * 16 + cluster) % 16 AS INTEGER) AS cluster
FROM placed p, ranked r GROUP BY user_id"""

# 10,000 draws with replacement, each at a rank by hash.
_DRAWS = """
ranked AS (SELECT user_id, row_number() OVER (ORDER BY md5('42:' || user_id)) - 1 AS rank, count(*) OVER () AS n FROM activity),
drawn AS (SELECT draw, user_id FROM (SELECT unnest(range(10000)) AS draw) JOIN ranked
          ON rank = CAST('0x' || substr(md5('42:draw:' || draw), 1, 15) AS BIGINT) % n)"""

# A row drawn several times counts so often.
_SAMPLED_SILHOUETTE = "WITH " + _LABELLED + "," + _DRAWS + """,
weighted AS (SELECT l.*, w FROM labelled l JOIN (SELECT user_id, count(*) AS w FROM drawn GROUP BY user_id) USING (user_id)),
sizes AS (SELECT cluster, sum(w) AS n FROM weighted GROUP BY cluster),
pairs AS (
  SELECT a.user_id, a.w, a.cluster, b.cluster AS other,
         sum(b.w * sqrt((a.purchases - b.purchases) * (a.purchases - b.purchases)
                        + (a.total_spent - b.total_spent) * (a.total_spent - b.total_spent))) AS d
  FROM weighted a CROSS JOIN weighted b GROUP BY ALL),
scores AS (
  SELECT user_id, w, max(CASE WHEN other = p.cluster THEN n END) AS own_n,
         max(CASE WHEN other = p.cluster AND n > 1 THEN d / (n - 1) END) AS a,
         min(CASE WHEN other <> p.cluster THEN d / n END) AS b
  FROM pairs p JOIN sizes s ON s.cluster = other GROUP BY user_id, w)
SELECT CAST(sum(w) AS BIGINT) AS rows, round(sum(w * CASE WHEN own_n = 1 OR greatest(a, b) = 0 THEN 0.0
         ELSE (b - a) / greatest(a, b) END) / sum(w), 6) AS silhouette FROM scores"""

_MONTHLY = """
monthly AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
newest AS (SELECT CAST(max(o_orderdate) AS DATE) AS as_of,
                  CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS as_of_month FROM orders)"""

_BUSY = _MONTHLY + """,
counts AS (SELECT month, count(*) AS n FROM monthly GROUP BY month),
busy AS (SELECT month FROM counts
         WHERE n * (SELECT count(*) FROM counts) >= (SELECT sum(n) FROM counts))"""

_WINDOW = """
span AS (SELECT CAST(as_of_month - to_months(CAST(i AS INTEGER)) AS DATE) AS month
         FROM newest, range({0}) r(i))"""

_RETENTION = _MONTHLY + """,
split AS (SELECT m.*, m.month > as_of_month - INTERVAL 12 MONTH AS recent FROM monthly m, newest),
active AS (SELECT DISTINCT o_custkey FROM split WHERE recent)"""

_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

_EVENT = "event_time, event_type, product_id, category_code, brand, price, user_id, user_session"

_DIRTY_ROWS = "WITH " + _DIRTY + f" SELECT {_EVENT} FROM dirty"
_CLEAN_ROWS = "WITH " + _DIRTY + "," + _FENCE + "," + _KEPT + " SELECT * FROM clean"
_BOUNDS = "WITH " + _DIRTY + "," + _FENCE + f" SELECT {_FENCE_COLUMNS} FROM fence"

ORACLES = {
    "row_count": "SELECT count(*) AS row_count FROM events",
    "preview": "SELECT * FROM events ORDER BY event_id LIMIT 5",
    "month_scan": "WITH " + _MONTHLY + f" SELECT {_ORDER}, month FROM monthly, newest WHERE month = as_of_month",
    "fill_and_drop_nulls": "WITH " + _DIRTY + """
        SELECT event_time, event_type, product_id, coalesce(category_code, 'unknown') AS category_code,
               coalesce(brand, 'unknown') AS brand, price, user_id, user_session
        FROM dirty WHERE user_id IS NOT NULL AND product_id IS NOT NULL AND user_session IS NOT NULL""",
    "fill_numeric_nulls": "WITH " + _DIRTY + """
        SELECT event_time, event_type, coalesce(product_id, 0) AS product_id, category_code, brand,
               coalesce(price, 0.0) AS price, coalesce(user_id, 0) AS user_id, user_session FROM dirty""",
    "dedup_rows": "WITH " + _DIRTY + f" SELECT DISTINCT {_EVENT} FROM dirty",
    "valid_prices": _DIRTY_ROWS + " WHERE price >= 0",
    "within_fence": "WITH " + _DIRTY + "," + _FENCE + f"""
        SELECT {_EVENT} FROM dirty, fence WHERE price BETWEEN lower_bound AND upper_bound""",
    "normalized_texts": "WITH " + _DIRTY + """
        SELECT event_time, event_type, product_id, trim(lower(category_code)) AS category_code,
               trim(lower(brand)) AS brand, price, user_id, user_session FROM dirty""",
    "parsed_event_times": """
        SELECT event_id, ts AS event_time, CAST(year(ts) AS INTEGER) AS event_year,
               CAST(month(ts) AS INTEGER) AS event_month
        FROM events WHERE event_type <> 'error'""",
    "clean_events": _CLEAN_ROWS,
    "clean_events_dedup_last": "WITH " + _DIRTY + "," + _FENCE + "," + _KEPT + " SELECT DISTINCT * FROM clean",
    "iqr_bounds_exact": _BOUNDS,
    "iqr_bounds_narrowed": _BOUNDS,
    "iqr_bounds_head": """
        WITH head AS (SELECT value FROM events ORDER BY event_id LIMIT 500),
        quartiles AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM head),
        fence AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower_bound,
                         q3 + 1.5 * (q3 - q1) AS upper_bound FROM quartiles)
        SELECT """ + _FENCE_COLUMNS + " FROM fence",
    "approx_rank_error": """
        SELECT p AS probability, count(value) > 0 AS within_error
        FROM events, (VALUES (CAST(0.25 AS DOUBLE)), (CAST(0.75 AS DOUBLE))) v(p) GROUP BY p""",
    "user_activity": "WITH " + _ACTIVITY + " SELECT * FROM activity",
    "event_type_counts": "WITH " + _ACTIVITY + " SELECT user_id, views, carts, removals, purchases FROM activity",
    "array_value_count": """
        SELECT p_partkey, CAST(len(list_filter(string_split(p_name, ' '), lambda w: w = 'red')) AS BIGINT)
               AS red_count FROM part""",
    "latest_event_time": "SELECT max(ts) AS latest_time FROM events",
    "rfm": "WITH " + _SHOP + "," + _RFM + " SELECT * FROM rfm",
    "user_profile": "WITH " + _ACTIVITY + "," + _RFM + " SELECT * FROM rfm JOIN activity USING (user_id)",
    "rfm_join_activity": "WITH " + _ACTIVITY + "," + _RFM + " SELECT * FROM rfm JOIN activity USING (user_id)",
    "scaled_features": _SCALED,
    "scaler_stage": _SCALED,
    "nearest_centroid": "WITH " + _LABELLED + " SELECT user_id, cluster FROM labelled",
    "named_segments": "WITH " + _LABELLED + """
        SELECT user_id, views, carts, removals, purchases, sessions, total_spent, cluster,
               CASE cluster WHEN 0 THEN 'Occasional Spender' WHEN 2 THEN 'Loyal Customer'
                            ELSE 'Other' END AS cluster_name FROM labelled""",
    "segment_names_joined": "WITH " + _LABELLED + """
        SELECT l.cluster, l.user_id, coalesce(r.r_name, 'Other') AS cluster_name
        FROM labelled l LEFT JOIN region r ON r.r_regionkey * 2 = l.cluster""",
    "events_with_segment": _SEGMENT_JOIN,
    "events_with_segment_split": _SEGMENT_JOIN,
    "kmeans_nearest": """
        SELECT count(DISTINCT user_id) AS users, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS misplaced
        FROM events""",
    "pca_norms": _LENGTHS,
    "silhouette": _SILHOUETTE,
    "latest_model_version": """
        SELECT p_brand, coalesce(max(CASE WHEN p_type <> 'PROMO' THEN p_size END), 0) AS latest_version
        FROM part GROUP BY p_brand""",
    "table_labels": "WITH " + _MONTHLY + """
        SELECT DISTINCT month, strftime(month, '%Y-%b') AS label,
               'data_' || lower(strftime(month, '%Y_%b')) AS table_name,
               'data_' || strftime(month, '%Y-%b') || '.csv.gz' AS file_name FROM monthly""",
    "months_from_names": "WITH " + _MONTHLY + """,
        names AS (SELECT DISTINCT month, CASE o_orderstatus
                    WHEN 'F' THEN 'data_' || strftime(month, '%Y-%b') || '.csv.gz'
                    WHEN 'O' THEN 'data_' || lower(strftime(month, '%Y_%b'))
                    ELSE 'data_' || year(month) || '-Foo.csv.gz' END AS table_name FROM monthly)
        SELECT table_name, month FROM names
        WHERE regexp_matches(table_name, '^data_[0-9]{4}-(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)')""",
    "months_newest_first": "WITH " + _MONTHLY + " SELECT DISTINCT month FROM monthly ORDER BY month DESC",
    "month_window": "WITH " + _MONTHLY + "," + _WINDOW.format(24) + " SELECT month FROM span",
    "pending_months": "WITH " + _BUSY + "," + _WINDOW.format(10) + """
        SELECT month FROM span WHERE month NOT IN (SELECT month FROM busy) ORDER BY month DESC""",
    "ledger_append": "WITH " + _BUSY + "," + _WINDOW.format(10) + """
        SELECT month FROM busy UNION SELECT month FROM span""",
    "ledger_union": "WITH " + _BUSY + "," + _WINDOW.format(10) + """
        SELECT month FROM busy UNION SELECT month FROM span""",
    "ledger_json": "WITH " + _BUSY + """
        SELECT '["' || string_agg(strftime(month, '%Y-%b'), '","' ORDER BY month) || '"]' AS months_json FROM busy""",
    "ledger_from_json": "WITH " + _BUSY + " SELECT month FROM busy",
    "expired_months": "WITH " + _MONTHLY + """
        SELECT DISTINCT month, CAST(month - INTERVAL 13 MONTH AS DATE) AS expired_month FROM monthly""",
    "month_classes": "WITH " + _MONTHLY + """
        SELECT DISTINCT month, CASE WHEN month > as_of_month - INTERVAL 12 MONTH THEN 'recent' ELSE 'old' END
               AS month_class FROM monthly, newest""",
    "recent_months": "WITH " + _MONTHLY + """
        SELECT DISTINCT month FROM monthly, newest WHERE month > as_of_month - INTERVAL 12 MONTH""",
    "active_users": "WITH " + _RETENTION + " SELECT o_custkey FROM active",
    "inactive_users": "WITH " + _RETENTION + """
        SELECT o_custkey FROM split WHERE NOT recent EXCEPT SELECT o_custkey FROM active""",
    "surviving_old_rows": "WITH " + _RETENTION + f"""
        SELECT {_ORDER} FROM split WHERE NOT recent AND o_custkey IN (SELECT o_custkey FROM active)""",
    "retention_survivors": "WITH " + _RETENTION + f"""
        SELECT {_ORDER} FROM split WHERE recent OR o_custkey IN (SELECT o_custkey FROM active)""",
    "retention_report": "WITH " + _RETENTION + """,
        marked AS (SELECT *, o_custkey NOT IN (SELECT o_custkey FROM active) AS gone FROM split WHERE NOT recent)
        SELECT month, count(*) AS rows_before,
               count(DISTINCT o_custkey) FILTER (WHERE gone) AS deleted_users,
               count(*) FILTER (WHERE gone) AS deleted_rows
        FROM marked GROUP BY month""",
    "without_expired_month": "WITH " + _MONTHLY + f"""
        SELECT {_ORDER} FROM monthly, newest WHERE month <> as_of_month - INTERVAL 13 MONTH""",
    "drop_month": "WITH " + _MONTHLY + f"""
        SELECT {_ORDER}, month FROM monthly, newest WHERE month <> as_of_month - INTERVAL 13 MONTH""",
    "retention_run": "WITH " + _RETENTION + f"""
        SELECT {_ORDER}, month FROM split, newest
        WHERE month <> as_of_month - INTERVAL 13 MONTH
          AND (recent OR o_custkey IN (SELECT o_custkey FROM active))""",
    "month_roundtrip": "WITH " + _MONTHLY + f" SELECT {_ORDER}, month FROM monthly",
    "csv_export_roundtrip": _DIRTY_ROWS,
    "append_roundtrip": _DIRTY_ROWS,
    "raw_copy_roundtrip": _DIRTY_ROWS,
    "incremental_ingest": "SELECT * FROM events",
    "monthly_flow": "WITH " + _DIRTY + "," + _FENCE + "," + _KEPT + """
        SELECT *, CAST(date_trunc('month', (SELECT max(ts) FROM events)) AS DATE) AS month,
               true AS has_segment FROM clean""",
    "landed_month": "WITH " + _DIRTY + """
        SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') || ' UTC' AS event_time, event_type, product_id, category_code,
               brand, price, user_id, user_session,
               CASE WHEN event_type = 'purchase' THEN CAST(product_id * 10 AS VARCHAR) END AS category_id FROM dirty""",
    "landed_folder": "WITH " + _DIRTY + """
        SELECT '2024-Feb/a b' AS place, DATE '2024-02-01' AS month, count(*) AS n FROM dirty WHERE event_type = 'purchase'
        UNION ALL
        SELECT 'deep/2024-Mar', DATE '2024-03-01', count(*) FROM dirty WHERE event_type = 'view'""",
    "pending_flow": "WITH " + _DIRTY + "," + _FENCE + "," + _KEPT + """,
        bought AS (SELECT * FROM dirty WHERE event_type = 'purchase'),""" + (_FENCE + "," + _KEPT).replace(
        "dirty", "bought").replace("quartiles", "quartiles_b").replace("fence", "fence_b").replace(
        "kept", "kept_b").replace("clean ", "clean_b ") + """,
        newest AS (SELECT CAST(date_trunc('month', max(ts)) AS DATE) AS month FROM events)
        SELECT clean.*, month FROM clean, newest
        UNION ALL SELECT clean_b.*, CAST(month - INTERVAL 1 MONTH AS DATE) FROM clean_b, newest""",
    "catalog_publish": "WITH " + _MONTHLY + f"""
        SELECT {_ORDER}, month FROM monthly, newest
        WHERE month = as_of_month - INTERVAL 1 MONTH OR (month = as_of_month AND o_orderstatus = 'F')""",
    "event_types_with_nulls": """
        SELECT user_id, """ + ", ".join(
        f"count(*) FILTER (WHERE event_type = '{t}' AND user_id % 7 <> 0) AS {c}"
        for c, t in (("views", "view"), ("carts", "click"), ("removals", "error"), ("purchases", "purchase"))) + """
        FROM events GROUP BY user_id""",
    "event_times_by_zone": """
        SELECT event_id, date_trunc('second', ts) AS event_time, CAST(year(ts) AS INTEGER) AS event_year,
               CAST(month(ts) AS INTEGER) AS event_month FROM events""",
    "emptied_month": "WITH " + _RETENTION + """,
        oldest AS (SELECT min(month) AS first FROM split)
        SELECT month, count(*) AS n FROM split, newest, oldest
        WHERE month <> as_of_month - INTERVAL 13 MONTH AND month <> first
          AND (recent OR o_custkey IN (SELECT o_custkey FROM active)) GROUP BY month""",
    "bootstrap_size": """
        SELECT 2 * count(DISTINCT user_id) AS drawn, CAST(0 AS BIGINT) AS strangers FROM events""",
    "model_roundtrip": """
        SELECT count(DISTINCT user_id) AS users, CAST(0 AS BIGINT) AS changed FROM events""",
    "segments_by_spending": """
        SELECT CAST(4 AS BIGINT) AS segments, CAST(0 AS BIGINT) AS falling FROM events LIMIT 1""",
    "emptied_publish": "WITH " + _MONTHLY + f"""
        SELECT {_ORDER}, month FROM monthly, newest
        WHERE month < as_of_month AND (month <> as_of_month - INTERVAL 1 MONTH OR o_orderstatus = 'F')""",
    "month_table_publish": "WITH " + _MONTHLY + f"""
        SELECT {_ORDER}, month FROM monthly, newest
        WHERE month < as_of_month AND month <> as_of_month - INTERVAL 2 MONTH
          AND (month <> as_of_month - INTERVAL 1 MONTH OR o_orderstatus = 'F')""",
    "csv_file_roundtrip": "WITH " + _ACTIVITY + " SELECT * FROM activity",
    "bulk_copy": "WITH " + _DIRTY + """
        SELECT CASE event_type WHEN 'view' THEN DATE '2024-03-01' ELSE DATE '2024-02-01' END AS month, count(*) AS n,
               count(DISTINCT user_id) AS users, CAST(0 AS BIGINT) AS nameless
        FROM dirty WHERE event_type IN ('view', 'purchase') GROUP BY 1""",
    "emptied_store": "SELECT count(*) AS before, CAST(0 AS BIGINT) AS after, CAST(7 AS BIGINT) AS columns FROM orders",
    "catalog_months": "WITH " + _MONTHLY + """
        SELECT DISTINCT 'data_' || lower(strftime(month, '%Y_%b')) AS table_name FROM monthly, newest
        WHERE month >= as_of_month - INTERVAL 2 MONTH""",
    "landed_months": "WITH " + _DIRTY + """,
        newest AS (SELECT CAST(date_trunc('month', max(ts)) AS DATE) AS month FROM events)
        SELECT CAST(month - to_months(back) AS DATE) AS month, back = 0 AS landed,
               CASE WHEN back = 0 THEN (SELECT count(*) FROM dirty WHERE event_type = 'purchase') ELSE 0 END AS n
        FROM newest, (SELECT CAST(unnest(range(3)) AS INTEGER) AS back)""",
    "guards": """
        SELECT 'columns there' AS guard, CAST(NULL AS VARCHAR) AS message UNION ALL
        SELECT 'columns missing', 'missing columns: price, brand' UNION ALL
        SELECT 'rows there', NULL UNION ALL SELECT 'rows missing', 'events holds no rows'""",
    "variance_shares": """
        SELECT count(DISTINCT user_id) AS users, CAST(1 AS DOUBLE) AS all_shares, true AS two_match,
               CAST(0 AS DOUBLE) AS covariance, CAST(6 AS DOUBLE) AS variance FROM events""",
    "bootstrap_by_rank": "WITH " + _ACTIVITY + "," + _DRAWS + " SELECT draw, user_id FROM drawn",
    "silhouette_sample": _SAMPLED_SILHOUETTE,
    "classifier_against_majority": "WITH " + _LABELLED + """, sizes AS (SELECT cluster, count(*) AS n FROM labelled GROUP BY cluster)
        SELECT CAST(sum(n) AS BIGINT) AS users, round(max(n) / sum(n), 6) AS majority, CAST(8 AS BIGINT) AS settings, true AS better FROM sizes""",
    "kmeans_fixed_point": _FIXED_KMEANS,
    "kmeans_repartitioned": "SELECT count(DISTINCT user_id) AS users, CAST(0 AS BIGINT) AS changed FROM events",
    "elbow_fixed_point": _FIXED_ELBOW,
    "score_by_expression": _SCORED_ORDERS,
    "window_fences": "WITH " + _MONTHLY + """,
        ends AS (SELECT DISTINCT month AS window_end FROM monthly)
        SELECT window_end, count(*) AS sketched_rows, true AS q1_holds, true AS q3_holds FROM ends, monthly
        WHERE month <= window_end AND month > window_end - INTERVAL 3 MONTH GROUP BY window_end""",
    "marks_keep_files": "WITH " + _RETENTION + """,
        present AS (SELECT recent OR o_custkey IN (SELECT o_custkey FROM active) AS stays FROM split, newest
                    WHERE month <> as_of_month - INTERVAL 13 MONTH)
        SELECT count(*) FILTER (WHERE stays) AS left_rows, count(*) FILTER (WHERE NOT stays) AS marked_rows,
               CAST(0 AS BIGINT) AS changed_files FROM present""",
    "late_files": "WITH " + _DIRTY + "," + _FENCE + "," + _KEPT + """
        SELECT *, CAST(date_trunc('month', event_time) AS DATE) AS month, CAST(2 AS BIGINT) AS batches FROM clean""",
}
ORACLES["retention_by_marks"] = ORACLES["retention_run"]
ORACLES["landed_many_files"] = ORACLES["landed_month"]
