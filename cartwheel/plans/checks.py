"""SQL that recomputes the registered queries in another engine, as plain text per key."""

from __future__ import annotations

from cartwheel.operators.cross import PERMUTATION_PASSES
from cartwheel.schemas import NUMERIC_V2
from cartwheel.sources.star import CUSTOMERS_SQL, PRODUCTS_SQL, TRANSACTIONS_SQL

_INPUTS = f"""
tx AS ({TRANSACTIONS_SQL}),
cust AS ({CUSTOMERS_SQL}),
prod AS ({PRODUCTS_SQL}),
dtx AS (SELECT DISTINCT * FROM tx),
sold AS (
  SELECT customer_id, product_id, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
         coalesce(sum(items), 0) AS items
  FROM dtx GROUP BY 1, 2, 3)"""

_JUDGED = """,
judged AS (
  SELECT s.customer_id, s.product_id, s.week, p.brand, p.package, s.items, p.size,
         CAST(s.items > 25 AS INT) AS target, CAST(p.size > 25 AS INT) AS prediction
  FROM sold s JOIN prod p USING (product_id))"""

_GRID = """,
cw AS (SELECT DISTINCT customer_id, week FROM sold),
cp AS (SELECT DISTINCT customer_id, product_id FROM sold),
keys AS (SELECT customer_id, product_id, week FROM cw JOIN cp USING (customer_id)
         WHERE customer_id IN (SELECT customer_id FROM cust)),
grid AS (
  SELECT k.customer_id, k.product_id, k.week, coalesce(s.items, 0) AS items,
         CASE WHEN coalesce(s.items, 0) > 0 THEN 1 ELSE 0 END AS target
  FROM keys k LEFT JOIN sold s
    ON k.customer_id = s.customer_id AND k.product_id = s.product_id AND k.week = s.week)"""

_BALANCED = _GRID + """,
cells AS (
  SELECT * FROM grid WHERE items > 0
  UNION ALL
  SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (
        ORDER BY md5(concat_ws('|', customer_id, product_id,
                               week - DATE '1970-01-01', '42')),
                 customer_id, product_id, week) AS r
    FROM grid WHERE items = 0)
  WHERE r <= (SELECT count(*) FROM grid WHERE items > 0))"""

_SCORED = _GRID + """,
cells AS (SELECT * FROM grid WHERE items >= 0)"""

_FEATURES = """,
rws AS (
  SELECT c.*, d.* EXCLUDE (customer_id), p.* EXCLUDE (product_id),
         round_even(d.X * 1e1, 0) / 1e1 AS zone_X, round_even(d.Y * 1e1, 0) / 1e1 AS zone_Y
  FROM cells c JOIN cust d USING (customer_id) LEFT JOIN prod p USING (product_id)),
zones AS (
  SELECT zone_X, zone_Y, avg(target) AS zone_avg_purchase_freq,
         sum(items) AS zone_total_purchases,
         count(DISTINCT customer_id) AS zone_customer_density
  FROM rws GROUP BY 1, 2),
wins AS (
  SELECT *,
    sum(items) OVER (PARTITION BY customer_id, week) AS total_weekly_purchase,
    avg(items) OVER (PARTITION BY customer_id) AS customer_avg_purchase,
    avg(target) OVER (PARTITION BY customer_id ORDER BY product_id, week
                      ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS recent_purchase_trend,
    avg(items) OVER (PARTITION BY product_id) AS product_avg_purchase,
    lag(week) OVER (PARTITION BY customer_id, product_id ORDER BY week) AS last_purchase_week
  FROM rws),
features AS (
  SELECT customer_id, week, product_id, region_id, zone_id, customer_type, Y, X,
         num_deliver_per_week, num_visit_per_week, brand, category, sub_category, segment,
         package, size, target, total_weekly_purchase, customer_avg_purchase,
         recent_purchase_trend, product_avg_purchase, last_purchase_week,
         CAST(coalesce(week - last_purchase_week, -1) AS INT) AS days_since_last_purchase,
         zone_X, zone_Y, zone_avg_purchase_freq, zone_total_purchases, zone_customer_density
  FROM wins JOIN zones USING (zone_X, zone_Y))"""

_PAST = _BALANCED + """,
dated AS (SELECT s.* FROM sold s WHERE customer_id IN (SELECT customer_id FROM cust)
          AND week IS NOT NULL),
place AS (SELECT customer_id, round_even(X * 1e1, 0) / 1e1 AS zone_X,
                 round_even(Y * 1e1, 0) / 1e1 AS zone_Y FROM cust),
fresh AS (SELECT customer_id, week, count(*) AS products FROM (
            SELECT customer_id, product_id, min(week) AS week FROM dated GROUP BY 1, 2)
          GROUP BY 1, 2),
active AS (SELECT customer_id, week, sum(CASE WHEN items > 0 THEN items ELSE 0 END) AS items,
                  count(*) FILTER (WHERE items > 0) AS bought,
                  coalesce(max(products), 0) AS products
           FROM dated LEFT JOIN fresh USING (customer_id, week) GROUP BY 1, 2),
own AS (SELECT *, lag(week) OVER c AS last_week, lag(items) OVER c AS last_items,
               row_number() OVER c AS n, sum(products) OVER c AS seen,
               sum(items) OVER c - items AS items_before,
               (row_number() OVER c - 1) * (sum(products) OVER c - products) AS cells_before
        FROM active WINDOW c AS (PARTITION BY customer_id ORDER BY week)),
goods AS (SELECT product_id, week, sum(sum(items)) OVER p AS items, sum(count(*)) OVER p AS cells
          FROM dated WHERE items > 0 GROUP BY 1, 2
          WINDOW p AS (PARTITION BY product_id ORDER BY week)),
areas AS (SELECT zone_X, zone_Y, week, sum(sum(items)) OVER z AS items,
                 sum(sum(bought)) OVER z AS bought,
                 sum(sum(n * seen - cells_before)) OVER z AS cells,
                 sum(count(*) FILTER (WHERE n = 1)) OVER z AS customers
          FROM own JOIN place USING (customer_id) GROUP BY 1, 2, 3
          WINDOW z AS (PARTITION BY zone_X, zone_Y ORDER BY week)),
labels AS (SELECT c.customer_id, c.product_id, c.week, o.n,
                  count(s.week) AS hits
           FROM cells c JOIN own o ON o.customer_id = c.customer_id AND o.week = c.week
           JOIN own e ON e.customer_id = c.customer_id AND e.n BETWEEN o.n - 4 AND o.n - 1
           LEFT JOIN dated s ON s.customer_id = c.customer_id AND s.product_id = c.product_id
             AND s.week = e.week AND s.items > 0
           GROUP BY 1, 2, 3, 4)"""

_DRIFT = """,
sides AS (
  SELECT week = (SELECT max(week) FROM features) AS is_new,
    [CAST(""" + " AS DOUBLE), CAST(".join(NUMERIC_V2) + """ AS DOUBLE)] AS v
  FROM features),
spread AS (
  SELECT i, avg(v[i + 1]) AS m, sqrt(var_samp(v[i + 1])) AS d
  FROM sides, range(10) t(i) GROUP BY i),
scales AS (SELECT list(m ORDER BY i) AS m, list(d ORDER BY i) AS d,
                  sqrt(count(*) FILTER (WHERE d > 0)) AS sigma FROM spread),
scaled AS (
  SELECT is_new, [CASE WHEN d[i] > 0 THEN (v[i] - m[i]) / d[i] ELSE 0 END FOR i IN range(1, 11)] AS z
  FROM sides, scales),
drawn AS (
  SELECT j, list(sqrt(-2 * ln(r)) * cos(2 * pi() * a) / sigma ORDER BY i) AS w, any_value(b) AS b
  FROM (SELECT i, j,
      (('0x' || substr(md5('42|r|' || i || '|' || j), 1, 12))::BIGINT + 0.5e0) / 281474976710656e0 AS r,
      (('0x' || substr(md5('42|a|' || i || '|' || j), 1, 12))::BIGINT + 0.5e0) / 281474976710656e0 AS a,
      2 * pi() * (('0x' || substr(md5('42|b|' || j), 1, 12))::BIGINT + 0.5e0) / 281474976710656e0 AS b
    FROM range(10) t(i), range(128) u(j)), scales
  GROUP BY j),
waves AS (SELECT is_new, j, sqrt(2e0 / 128) * cos(list_dot_product(z, w) + b) AS phi
          FROM scaled, drawn),
sums AS (
  SELECT j, sum(phi) FILTER (WHERE is_new) AS s1, sum(phi) FILTER (WHERE NOT is_new) AS s0,
    sum(phi * phi) FILTER (WHERE is_new) AS q1, sum(phi * phi) FILTER (WHERE NOT is_new) AS q0,
    count(*) FILTER (WHERE is_new) AS n1, count(*) FILTER (WHERE NOT is_new) AS n0
  FROM waves GROUP BY j)"""

_RUNS = _JUDGED + """,
runs AS (
  SELECT brand AS experiment, CAST(trial AS INT) AS trial,
         CASE WHEN sum(z) + sum(target) = 0 THEN 0e0
              ELSE 2e0 * sum(z * target) / (sum(z) + sum(target)) END AS valid_f1,
         concat_ws('-', brand, CAST(trial AS INT)) AS run_id
  FROM (SELECT brand, target, trial, CAST(size <= trial * 10 AS INT) AS z
        FROM judged CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS t(trial))
  GROUP BY brand, trial)"""

_REQUESTS = """,
req AS (
  SELECT c_custkey AS customer_id FROM customer
  UNION ALL
  SELECT c_custkey + 1000000000 FROM customer WHERE c_custkey % 10 = 0)"""

_ASKED = _JUDGED + _REQUESTS + """,
hits AS (
  SELECT r.customer_id, j.product_id, j.week
  FROM req r LEFT JOIN (SELECT * FROM judged WHERE prediction = 1) j
    ON r.customer_id = j.customer_id
   AND (r.customer_id % 4 <> 2
        OR j.brand IN ('Brand#' || CAST(1 + r.customer_id % 25 AS VARCHAR), 'Brand#3'))
   AND (r.customer_id % 4 <> 3 OR j.package IN ('hot', 'small')))"""

_POPULAR = """,
totals AS (SELECT product_id, sum(items) AS items FROM tx GROUP BY 1),
top AS (SELECT product_id, items, row_number() OVER (ORDER BY items DESC, product_id) AS r
        FROM totals),
hist AS (SELECT customer_id, product_id, sum(items) AS items FROM tx GROUP BY 1, 2)"""


_PLACED = """,
placed AS (
  SELECT s.customer_id, s.week, round_even(coalesce(X, 0) * 1e1, 0) / 1e1 AS zone_X,
         round_even(coalesce(Y, 0) * 1e1, 0) / 1e1 AS zone_Y
  FROM (SELECT DISTINCT customer_id, week FROM sold WHERE week IS NOT NULL) s
  JOIN cust USING (customer_id))"""


def _sql(body: str, *parts: str) -> str:
    return "WITH " + _INPUTS.strip() + "".join(parts) + "\n" + body.strip()


def _feature(columns: str) -> str:
    return _sql(f"SELECT customer_id, product_id, week, {columns} FROM features",
                _BALANCED, _FEATURES)


def _axis(name: str, key: str) -> str:
    return f""",
{name} AS (
  SELECT {key}, row_number() OVER (
           ORDER BY substr(md5(concat_ws('|', {key}, '0')), 1, 4), {key}) - 1 AS no
  FROM (SELECT DISTINCT {key} FROM sold))"""


def _cross_walk(seed: int = 42) -> str:
    parts = [_axis("ax_c", "customer_id"), _axis("ax_w", "week"), _axis("ax_p", "product_id"), """,
sz AS (SELECT (SELECT count(*) FROM ax_c) AS nc, (SELECT count(*) FROM ax_w) AS nw,
              (SELECT count(*) FROM ax_p) AS np, (SELECT count(*) FROM sold) AS ns,
              (SELECT count(*) FROM sold WHERE items > 0) AS npos),
s0 AS (SELECT k, k % nc AS c, (k // nc) % nw AS w, k // (nc * nw) AS p, nc, nw, np
       FROM (SELECT unnest(range(0, least(nc * nw * np, npos + ns))) AS k, * FROM sz))"""]
    step = 0
    for turn in range(PERMUTATION_PASSES):
        for digit, others, size in (("c", "w, p", "nc"), ("w", "c, p", "nw"), ("p", "c, w", "np")):
            parts.append(f""",
s{step + 1} AS (
  SELECT * REPLACE (({digit} + ('0x' || substr(md5(concat_ws(
      '|', '{turn}{digit}', '{seed}', {others})), 1, 15))::BIGINT) % {size} AS {digit})
  FROM s{step})""")
            step += 1
    parts.append(f""",
free AS (
  SELECT k, customer_id, product_id, week
  FROM s{step} JOIN ax_c ON c = ax_c.no JOIN ax_w ON w = ax_w.no JOIN ax_p ON p = ax_p.no
  WHERE NOT EXISTS (SELECT 1 FROM sold s WHERE s.customer_id = ax_c.customer_id
                    AND s.product_id = ax_p.product_id AND s.week = ax_w.week)),
cells AS (
  SELECT customer_id, product_id, week, items FROM sold WHERE items > 0
  UNION ALL
  SELECT customer_id, product_id, week, 0e0 FROM (
    SELECT *, row_number() OVER (ORDER BY k) AS r FROM free)
  WHERE r <= (SELECT npos FROM sz))""")
    return "".join(parts)


_V1_HISTORY = """,
per AS (
  SELECT product_id, CASE WHEN count(*) > 1
           THEN CAST(max(purchase_date) - min(purchase_date) AS DOUBLE) / (count(*) - 1)
           ELSE 0e0 END AS "Periodicity"
  FROM dtx GROUP BY 1),
ords AS (SELECT customer_id, count(*) AS num_orders FROM dtx GROUP BY 1),
bask AS (
  SELECT customer_id, avg(n) AS avg_items FROM (
    SELECT customer_id, date_trunc('week', purchase_date) AS wk, count(*) AS n
    FROM dtx GROUP BY 1, 2) GROUP BY 1)"""

_NEXT = """,
tops AS (SELECT product_id FROM tx GROUP BY 1 ORDER BY sum(items) DESC, product_id LIMIT 10),
near AS (SELECT customer_id, product_id FROM sold
         UNION SELECT customer_id, product_id FROM cust CROSS JOIN tops),
nxt AS (
  SELECT customer_id, product_id, (SELECT max(week) FROM sold) + 7 AS week
  FROM near JOIN prod USING (product_id) WHERE customer_id IN (SELECT customer_id FROM cust)
   AND (customer_id % 3 <> 1
        OR brand IN ('Brand#' || CAST(1 + customer_id % 25 AS VARCHAR), 'Brand#3'))
   AND (customer_id % 3 <> 0 OR package IN ('hot', 'small')))"""

_MANIFEST = """,
months AS (SELECT DISTINCT strftime(purchase_date, '%Y%m') AS m FROM tx),
old AS (SELECT m FROM months
        WHERE m < (SELECT strftime(max(purchase_date) - 90, '%Y%m') FROM tx))"""

_WEEKS = """,
wk AS (SELECT DISTINCT week FROM sold),
wkn AS (SELECT week, row_number() OVER (ORDER BY week) - 1 AS pos, count(*) OVER () AS n FROM wk),
wks AS (SELECT week, CASE WHEN pos < floor(0.7e0 * n) THEN 'train'
                          WHEN pos < floor(0.85e0 * n) THEN 'val' ELSE 'test' END AS split
        FROM wkn)"""

_GAPPY = """,
gappy AS (
  SELECT t.customer_id, t.product_id, t.order_id, t.items, p.size, p.brand, p.segment
  FROM tx t LEFT JOIN (SELECT * FROM prod WHERE size > 10) p USING (product_id)),
filled AS (SELECT * REPLACE (coalesce(CAST(size AS DOUBLE), (SELECT avg(size) FROM gappy)) AS size)
           FROM gappy)"""

_CODES = """,
seen AS (SELECT * FROM prod WHERE size > 25),
b AS (SELECT brand, row_number() OVER (ORDER BY brand) AS k FROM (SELECT DISTINCT brand FROM seen)),
g AS (SELECT segment, row_number() OVER (ORDER BY segment) AS k
      FROM (SELECT DISTINCT segment FROM seen)),
z AS (SELECT size, row_number() OVER (ORDER BY size) AS k FROM (SELECT DISTINCT size FROM seen)),
coded AS (
  SELECT p.product_id, CAST(b.k AS INT) AS bk, CAST(g.k AS INT) AS gk, CAST(z.k AS INT) AS zk
  FROM prod p LEFT JOIN b ON p.brand = b.brand LEFT JOIN g ON p.segment = g.segment
  LEFT JOIN z ON p.size = z.size)"""

_REPORT = _JUDGED + """,
k(class) AS (VALUES (0), (1)),
per AS (
  SELECT class, (SELECT count(*) FROM judged WHERE target = class) AS support,
         (SELECT count(*) FROM judged WHERE prediction = class) AS said,
         (SELECT count(*) FROM judged WHERE target = class AND prediction = class) AS hit
  FROM k),
sc AS (
  SELECT CAST(class AS VARCHAR) AS class, coalesce(CAST(hit AS DOUBLE) / said, 0) AS precision,
         coalesce(CAST(hit AS DOUBLE) / support, 0) AS recall,
         coalesce(2e0 * hit / (said + support), 0) AS f1, support, hit
  FROM per)"""

CHECKS: dict[str, str] = {
    "scan_transactions": _sql("SELECT * FROM tx"),
    "scan_dimensions": _sql("""
SELECT customer_id, region_id, zone_id, customer_type, Y, X, num_deliver_per_week,
       num_visit_per_week, NULL::BIGINT AS product_id, NULL::VARCHAR AS brand,
       NULL::VARCHAR AS category, NULL::VARCHAR AS sub_category, NULL::VARCHAR AS segment,
       NULL::VARCHAR AS package, NULL::INT AS size FROM cust
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, product_id, brand, category,
       sub_category, segment, package, size FROM prod"""),
    "csv_roundtrip": _sql("SELECT * FROM cust"),
    "archive_range": _sql("""
SELECT strftime(min(purchase_date), '%Y%m%d') AS start_date,
       strftime(max(purchase_date), '%Y%m%d') AS end_date FROM tx"""),
    "detect_new_files": _sql("""
SELECT 'batch_' || m || '.parquet' AS file_name FROM months
WHERE m NOT IN (SELECT m FROM old)""", _MANIFEST),
    "detect_new_count": _sql("""
SELECT n AS extra_files,
       CASE WHEN n >= 0 THEN 'read_new_data' ELSE 'dont_predict' END AS decision
FROM (SELECT (SELECT count(*) FROM months) - (SELECT count(*) FROM old) AS n)""", _MANIFEST),
    "ingest_merge": _sql("""
SELECT * FROM tx WHERE purchase_date >= DATE '1998-01-01'
UNION SELECT * FROM tx WHERE purchase_date < DATE '1999-01-01'"""),
    "ingest_incremental": _sql("""
SELECT * FROM tx WHERE purchase_date < DATE '1999-01-01'
UNION ALL (SELECT * FROM tx WHERE purchase_date >= DATE '1998-01-01'
           EXCEPT SELECT * FROM tx WHERE purchase_date < DATE '1999-01-01')"""),
    "dedupe_transactions": _sql("SELECT * FROM dtx"),
    "enrich_transactions": _sql("""
SELECT * FROM tx LEFT JOIN cust USING (customer_id) LEFT JOIN prod USING (product_id)"""),
    "weekly_sales": _sql("SELECT * FROM sold"),
    "grid_per_customer": _sql("SELECT * FROM keys JOIN cust USING (customer_id)", _GRID),
    "grid_labeled": _sql("SELECT * FROM grid WHERE items >= 0", _GRID),
    "label_target": _sql("""
SELECT customer_id, product_id, week, items - 25e0 AS items,
       CASE WHEN items - 25e0 > 0 THEN 1 ELSE 0 END AS target FROM sold"""),
    "split_pos_neg": _sql("""
SELECT customer_id, CASE WHEN items > 0 THEN 'pos' ELSE 'neg' END AS side,
       count(*) AS cells, sum(items) AS items FROM grid WHERE items >= 0 GROUP BY 1, 2""", _GRID),
    "fill_nulls": _sql("""
SELECT t.customer_id, t.product_id, order_id, purchase_date, items,
       coalesce(region_id, 0) AS region_id, coalesce(zone_id, 0) AS zone_id,
       coalesce(customer_type, '0') AS customer_type, coalesce(Y, 0) AS Y, coalesce(X, 0) AS X,
       coalesce(num_deliver_per_week, 0) AS num_deliver_per_week,
       coalesce(num_visit_per_week, 0) AS num_visit_per_week, coalesce(brand, '0') AS brand,
       coalesce(category, '0') AS category, coalesce(sub_category, '0') AS sub_category,
       coalesce(segment, '0') AS segment, coalesce(package, '0') AS package,
       coalesce(size, -1) AS size
FROM tx t LEFT JOIN (SELECT * FROM cust WHERE num_visit_per_week > 1) c USING (customer_id)
LEFT JOIN (SELECT * FROM prod WHERE size > 10) p USING (product_id)"""),
    "top_products": _sql("SELECT product_id, items FROM top WHERE r <= 10", _POPULAR),
    "rec_history": _sql("SELECT * FROM hist", _POPULAR),
    "avg_items": _sql("SELECT * FROM bask", _V1_HISTORY),
    "num_orders": _sql("""
SELECT customer_id, count(*) AS num_orders, count(DISTINCT order_id) AS distinct_orders
FROM dtx GROUP BY 1"""),
    "periodicity": _sql('SELECT product_id, "Periodicity" AS periodicity FROM per', _V1_HISTORY),
    "periodicity_timestamp": """
WITH t AS (SELECT l_partkey AS product_id, l_shipdate + to_hours(l_linenumber * 3) AS ts
           FROM lineitem),
g AS (SELECT product_id, floor((epoch_us(ts) - epoch_us(
        lag(ts) OVER (PARTITION BY product_id ORDER BY ts))) / 86400000000e0) AS gap FROM t)
SELECT product_id, coalesce(avg(gap), 0e0) AS periodicity FROM g GROUP BY 1""",
    "calendar_features": _sql("""
SELECT DISTINCT purchase_date, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
       CAST(date_trunc('week', purchase_date) AS DATE) + 7 AS next_week,
       CAST(month(purchase_date) AS INT) AS month, CAST(week(purchase_date) AS INT) AS iso_week,
       strftime(purchase_date, '%Y%m%d') AS ymd,
       CAST(purchase_date - CAST(date_trunc('week', purchase_date) AS DATE) AS INT)
           AS days_into_week
FROM tx"""),
    "zone_round": _sql("""
SELECT customer_id, round_even(X * 1e1, 0) / 1e1 AS zone_X,
       round_even(Y * 1e1, 0) / 1e1 AS zone_Y FROM cust"""),
    "balanced_sample": _sql("""
SELECT c.*, sum(s.items) AS total_weekly_purchase
FROM cells c JOIN sold s ON c.customer_id = s.customer_id AND c.week = s.week
GROUP BY ALL""", _BALANCED),
    "temporal_split": _sql("SELECT * FROM sold JOIN wks USING (week)", _WEEKS),
    "random_split": _sql("""
SELECT *, CASE WHEN u < 700000 THEN 'train' WHEN u < 850000 THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, ('0x' || substr(md5(concat_ws('|', customer_id, product_id, week, '42')), 1, 15)
                 )::BIGINT % 1000000 AS u FROM sold)""").replace(
        "SELECT *, CASE", "SELECT * EXCLUDE (u), CASE"),
    "latest_week_split": _sql("""
SELECT *, CASE WHEN week = (SELECT max(week) FROM sold) THEN 'new' ELSE 'ref' END AS side
FROM sold"""),
    "zone_features": _sql("""
SELECT customer_id, zone_X, zone_Y, zone_avg_purchase_freq, zone_total_purchases,
       zone_customer_density
FROM (SELECT DISTINCT customer_id, zone_X, zone_Y FROM rws) JOIN zones USING (zone_X, zone_Y)""",
                          _SCORED, _FEATURES),
    "zone_customers": _sql("""
SELECT zone_X, zone_Y, week, count(DISTINCT customer_id) AS customers,
       (SELECT count(DISTINCT p.customer_id) FROM placed p
        WHERE p.zone_X = w.zone_X AND p.zone_Y = w.zone_Y AND p.week <= w.week) AS customers_so_far
FROM placed w GROUP BY zone_X, zone_Y, week""", _PLACED),
    "zone_customers_sketch": _sql("""
SELECT zone_X, zone_Y, count(DISTINCT customer_id) AS customers, true AS within
FROM placed GROUP BY zone_X, zone_Y""", _PLACED),
    "grid_full_cross": _sql("""
SELECT week, nc * np AS cells, bought, negative, nc * np - bought - negative AS unbought
FROM (SELECT week, count(*) FILTER (items > 0) AS bought, count(*) FILTER (items < 0) AS negative
      FROM sold GROUP BY 1),
     (SELECT count(DISTINCT customer_id) AS nc, count(DISTINCT product_id) AS np FROM sold)"""),
    "grid_next_week": _sql("SELECT customer_id, product_id, week FROM nxt", _NEXT),
    "scoring_set_v1": _sql("""
SELECT c.customer_id, c.product_id, c.week, "Periodicity", num_orders, avg_items,
       d.* EXCLUDE (customer_id), p.* EXCLUDE (product_id)
FROM (SELECT customer_id, product_id, week, coalesce("Periodicity", 0) AS "Periodicity",
             coalesce(num_orders, 0) AS num_orders, coalesce(avg_items, 0) AS avg_items
      FROM nxt LEFT JOIN per USING (product_id) LEFT JOIN ords USING (customer_id)
      LEFT JOIN bask USING (customer_id)) c
LEFT JOIN prod p USING (product_id) LEFT JOIN cust d USING (customer_id)""", _NEXT, _V1_HISTORY),
    "grid_next_week_size": _sql("""
SELECT w AS week, c AS customers, p AS products, c * p AS candidates
FROM (SELECT (SELECT max(week) FROM sold) + 7 AS w, (SELECT count(*) FROM cust) AS c,
             (SELECT count(*) FROM prod) AS p)"""),
    "recommend_batch": _sql("""
SELECT customer_id, CAST(pos - 1 AS INT) AS position, product_id FROM (
  SELECT customer_id, product_id, row_number() OVER (
           PARTITION BY customer_id ORDER BY grp, r) AS pos
  FROM (
    SELECT customer_id, product_id, 0 AS grp, row_number() OVER (
             PARTITION BY customer_id ORDER BY items DESC, product_id) AS r
    FROM hist WHERE customer_id IN (SELECT customer_id FROM req)
    UNION ALL
    SELECT q.customer_id, t.product_id, 1, t.r
    FROM (SELECT DISTINCT customer_id FROM req) q CROSS JOIN (SELECT * FROM top WHERE r <= 10) t
    WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.customer_id = q.customer_id
                      AND h.product_id = t.product_id)))
WHERE pos <= 5""", _POPULAR, _REQUESTS),
    "rec_known_customers": _sql("""
SELECT DISTINCT customer_id, customer_id IN (SELECT customer_id FROM tx) AS known FROM req""",
                                _REQUESTS),
    "rec_backfill": _sql("""
SELECT c.customer_id, t.product_id
FROM (SELECT DISTINCT customer_id FROM hist) c CROSS JOIN (SELECT * FROM top WHERE r <= 10) t
WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.customer_id = c.customer_id
                  AND h.product_id = t.product_id)""", _POPULAR),
    "predict_filter": _sql("""
SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(count(product_id) AS INT) AS n,
       coalesce(string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id, week), '')
           AS products
FROM hits GROUP BY 1""", _ASKED),
    "predict_json": _sql("""
SELECT CAST(customer_id AS VARCHAR) AS customer_id,
       '{"customer_id":"' || CAST(customer_id AS VARCHAR) || '","recommended_products":['
       || coalesce(string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id), '')
       || ']}' AS json
FROM hits GROUP BY customer_id""", _ASKED),
    "predict_stream": _sql("""
SELECT CAST(customer_id AS VARCHAR) AS customer_id,
       '{"customer_id":"' || CAST(customer_id AS VARCHAR) || '","recommended_products":['
       || coalesce(string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id), '')
       || ']}' AS json
FROM hits GROUP BY customer_id""", _ASKED),
    "recommendation_message": _sql("""
SELECT CAST(customer_id AS VARCHAR) AS customer_id,
       CASE WHEN count(product_id) = 0 THEN 'No hay productos recomendados para este cliente.'
            ELSE 'Productos recomendados: ' || string_agg(CAST(product_id AS VARCHAR), ', '
                                                          ORDER BY product_id) END AS message
FROM hits GROUP BY customer_id""", _ASKED),
    "filter_options": _sql("""
SELECT kind, CAST(row_number() OVER (PARTITION BY kind ORDER BY value) - 1 AS INT) AS position,
       value
FROM (SELECT 'brand' AS kind, brand AS value FROM judged
      UNION SELECT 'package', package FROM judged)""", _JUDGED),
    "score_positive": _sql("SELECT * EXCLUDE (prediction) FROM judged WHERE prediction = 1",
                           _JUDGED),
    "class_weight": _sql(
        "SELECT CAST(count(*) AS DOUBLE) / sum(target) AS positive_weight FROM judged", _JUDGED),
    "f1_score": _sql("""
SELECT 2e0 * sum(target * prediction) / (sum(target) + sum(prediction)) AS f1 FROM judged""",
                     _JUDGED),
    "classification_report": _sql("""
SELECT class, precision, recall, f1, support FROM sc
UNION ALL
SELECT 'accuracy', NULL, NULL, CAST(sum(hit) AS DOUBLE) / sum(support), sum(support) FROM sc
UNION ALL
SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM sc
UNION ALL
SELECT 'weighted avg', sum(precision * support) / sum(support),
       sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
FROM sc""", _REPORT),
    "runs_search": _sql("SELECT experiment, run_id, trial, valid_f1 FROM runs", _RUNS),
    "best_run": _sql("""
SELECT experiment, run_id, valid_f1 FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY valid_f1 DESC, run_id) AS r
  FROM runs) WHERE r = 1""", _RUNS),
    "optimization_history": _sql("""
SELECT experiment, trial, valid_f1, max(valid_f1) OVER (
         PARTITION BY experiment ORDER BY trial ROWS UNBOUNDED PRECEDING) AS best_f1
FROM runs""", _RUNS),
    "degradation_decision": _sql("""
SELECT experiment, best_f1, current_f1,
       100e0 * (best_f1 - current_f1) / current_f1 AS degradation_pct,
       CASE WHEN 100e0 * (best_f1 - current_f1) / current_f1 < 5 THEN 'predictions'
            ELSE 'optimize_model' END AS decision
FROM (SELECT experiment, max(valid_f1) AS best_f1, arg_max(valid_f1, trial) AS current_f1
      FROM runs GROUP BY 1)""", _RUNS),
    "weekly_window_events": """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(*) AS rows,
       round(sum(value), 6) AS total
FROM events GROUP BY 1, 2""",
    "standard_scale": _sql("""
SELECT customer_id, product_id, order_id,
       round((items - avg(items) OVER ()) / stddev_pop(items) OVER (), 6) AS items_scaled,
       round((size - avg(size) OVER ()) / stddev_pop(size) OVER (), 6) AS size_scaled
FROM filled""", _GAPPY),
    "minmax_scale": _sql("""
SELECT customer_id, product_id, order_id,
       round((items - min(items) OVER ()) / (max(items) OVER () - min(items) OVER ()), 6)
           AS items_scaled,
       round((size - min(size) OVER ()) / (max(size) OVER () - min(size) OVER ()), 6)
           AS size_scaled
FROM filled""", _GAPPY),
    "impute_numeric": _sql("""
SELECT customer_id, product_id, order_id, items, round(size, 6) AS size_filled FROM filled""",
                           _GAPPY),
    "impute_median": _sql("""
SELECT customer_id, product_id, order_id, CAST(items AS DOUBLE) AS items,
       coalesce(CAST(size AS DOUBLE), (SELECT median(CAST(size AS DOUBLE)) FROM gappy))
           AS size_filled,
       coalesce(CAST(items AS DOUBLE), (SELECT median(CAST(items AS DOUBLE)) FROM gappy))
           AS items_filled
FROM gappy""", _GAPPY),
    "impute_mode": _sql("""
SELECT customer_id, product_id, order_id, items,
       coalesce(brand, (SELECT brand FROM gappy WHERE brand IS NOT NULL GROUP BY 1
                        ORDER BY count(*) DESC, brand LIMIT 1)) AS brand_text,
       coalesce(segment, (SELECT segment FROM gappy WHERE segment IS NOT NULL GROUP BY 1
                          ORDER BY count(*) DESC, segment LIMIT 1)) AS segment_text
FROM gappy""", _GAPPY),
    "encode_onehot": _sql("""
SELECT product_id, coalesce(bk, 0) AS brand_slot, coalesce(gk, 0) AS segment_slot,
       coalesce(zk, 0) AS size_slot, CAST((SELECT count(*) FROM b) AS INT) AS brand_slots,
       CAST((SELECT count(*) FROM g) AS INT) AS segment_slots,
       CAST((SELECT count(*) FROM z) AS INT) AS size_slots
FROM coded""", _CODES),
    "encode_ordinal": _sql("""
SELECT product_id, coalesce(bk - 1, -1) AS brand_code, coalesce(gk - 1, -1) AS segment_code,
       coalesce(zk - 1, -1) AS size_code FROM coded""", _CODES),
    "date_features": _sql("""
SELECT customer_id, product_id, sold.week, CAST(month(sold.week) AS INT) AS month,
       CAST(weekofyear(sold.week) AS INT) AS week1 FROM sold"""),
    "features_with_gaps": _sql("""
SELECT * REPLACE (coalesce(brand, '0') AS brand, coalesce(category, '0') AS category,
                  coalesce(sub_category, '0') AS sub_category, coalesce(segment, '0') AS segment,
                  coalesce(package, '0') AS package, coalesce(size, 0) AS size)
FROM features""", _SCORED, _FEATURES).replace(f"tx AS ({TRANSACTIONS_SQL})", f"""tx AS (
  SELECT * REPLACE (CASE WHEN product_id % 7 = 0 THEN 0 ELSE product_id END AS product_id)
  FROM ({TRANSACTIONS_SQL}) t)""", 1).replace(f"cust AS ({CUSTOMERS_SQL})", f"""cust AS (
  SELECT * REPLACE (CASE WHEN customer_id % 5 = 0 THEN 0e0 ELSE X END AS X,
                    CASE WHEN customer_id % 11 = 0 THEN 0e0 ELSE Y END AS Y)
  FROM ({CUSTOMERS_SQL}) c)""", 1),
    "drift_distance": _sql("""
SELECT CAST(n0 AS BIGINT) AS n_ref, CAST(n1 AS BIGINT) AS n_new, round(
  (sum(s1 * s1) - sum(q1)) / (n1 * (n1 - 1)) + (sum(s0 * s0) - sum(q0)) / (n0 * (n0 - 1))
  - 2 * sum(s1 * s0) / (n1 * n0), 6) AS mmd2
FROM sums GROUP BY n0, n1""", _BALANCED, _FEATURES, _DRIFT),
    "dropped_rows": _sql("""
, t AS (SELECT DISTINCT CASE WHEN order_id % 13 <> 0 THEN customer_id END AS customer_id,
    product_id, order_id, CASE WHEN order_id % 97 <> 0 THEN purchase_date END AS purchase_date,
    CASE WHEN order_id % 31 <> 0 THEN items - 20 END AS items FROM tx),
c AS (SELECT customer_id, product_id, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
    coalesce(sum(items), 0) AS items FROM t GROUP BY 1, 2, 3)
SELECT 'cells' AS what, count(*) AS n FROM c
UNION ALL SELECT 'negative_cells', count(*) FROM c WHERE items < 0
UNION ALL SELECT 'undated_cells', count(*) FROM c WHERE week IS NULL
UNION ALL SELECT 'transactions', count(*) FROM t
UNION ALL SELECT 'undated', count(*) FROM t WHERE purchase_date IS NULL
UNION ALL SELECT 'without_customer', count(*) FROM t WHERE customer_id IS NULL
UNION ALL SELECT 'without_items', count(*) FROM t WHERE items IS NULL"""),
    "weekly_sales_incremental": _sql("SELECT * FROM sold"),
    "archive_same_range": _sql("SELECT DISTINCT * FROM tx"),
    "csv_missing_texts": _sql("""
SELECT customer_id, CASE WHEN customer_id % 13 <> 0 THEN region_id END AS region_id,
  CASE WHEN customer_id % 11 <> 0 THEN zone_id END AS zone_id,
  CASE WHEN customer_id % 7 <> 0 THEN customer_type END AS customer_type,
  CASE WHEN customer_id % 5 <> 0 THEN Y END AS Y, CASE WHEN customer_id % 3 <> 0 THEN X END AS X,
  CASE WHEN customer_id % 17 <> 0 THEN num_deliver_per_week END AS num_deliver_per_week,
  CASE WHEN customer_id % 19 <> 0 THEN num_visit_per_week END AS num_visit_per_week,
  CASE WHEN customer_id % 13 = 0 THEN 'region_id' ELSE '' END AS rejected FROM cust"""),
    "training_set_v2": _sql("SELECT * FROM features", _BALANCED, _FEATURES),
    "scoring_set_v2": _sql("SELECT * FROM features", _SCORED, _FEATURES),
    "training_set_unskewed": _sql("""
SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(concat_ws('|', customer_id,
    product_id, week - DATE '1970-01-01', '42')), customer_id, product_id, week) AS r FROM features)
WHERE target = 1 OR r <= (SELECT count(*) FROM features WHERE target = 1)""", _SCORED, _FEATURES),
    "features_point_in_time": _sql("""
SELECT c.customer_id, c.week, c.product_id, d.* EXCLUDE (customer_id), p.* EXCLUDE (product_id),
  c.target, coalesce(o.last_items, 0) AS total_weekly_purchase,
  coalesce(o.items_before / nullif(o.cells_before, 0), 0) AS customer_avg_purchase,
  coalesce(CAST(l.hits AS DOUBLE) / least(l.n - 1, 4), 0) AS recent_purchase_trend,
  coalesce(g.items / g.cells, 0) AS product_avg_purchase, o.last_week AS last_purchase_week,
  CAST(coalesce(c.week - o.last_week, -1) AS INT) AS days_since_last_purchase, z.zone_X, z.zone_Y,
  coalesce(CAST(a.bought AS DOUBLE) / a.cells, 0) AS zone_avg_purchase_freq,
  coalesce(a.items, 0) AS zone_total_purchases,
  CAST(coalesce(a.customers, 0) AS BIGINT) AS zone_customer_density
FROM cells c JOIN cust d USING (customer_id) JOIN place z USING (customer_id)
JOIN own o ON o.customer_id = c.customer_id AND o.week = c.week
LEFT JOIN prod p ON p.product_id = c.product_id
LEFT JOIN labels l ON l.customer_id = c.customer_id AND l.product_id = c.product_id
  AND l.week = c.week
ASOF LEFT JOIN goods g ON g.product_id = c.product_id AND c.week > g.week
ASOF LEFT JOIN areas a ON a.zone_X = z.zone_X AND a.zone_Y = z.zone_Y AND c.week > a.week""", _PAST),
    "training_set_v1": _sql("""
SELECT c.customer_id, c.product_id, c.week, "Periodicity", num_orders, avg_items,
       d.* EXCLUDE (customer_id), p.* EXCLUDE (product_id),
       CASE WHEN c.items > 0 THEN 1 ELSE 0 END AS target
FROM cells c LEFT JOIN per USING (product_id) LEFT JOIN prod p USING (product_id)
LEFT JOIN ords USING (customer_id) LEFT JOIN bask USING (customer_id)
LEFT JOIN cust d USING (customer_id)""", _cross_walk(), _V1_HISTORY),
    "total_weekly_purchase": _feature("total_weekly_purchase"),
    "customer_avg_purchase": _feature("customer_avg_purchase"),
    "recent_purchase_trend": _feature("recent_purchase_trend"),
    "product_avg_purchase": _feature("product_avg_purchase"),
    "days_since_last": _feature("last_purchase_week, days_since_last_purchase"),
}
