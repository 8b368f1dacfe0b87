"""Plain SQL that gives the same result as each registered query, for a second engine."""

from __future__ import annotations

# ---- shared parts -------------------------------------------------------------------

_FEED = """
feed AS (
 SELECT 'T-' || lpad(cast(l_orderkey AS varchar), 9, '0') || '-' || cast(l_linenumber AS varchar)
     AS transaction_id,
   CASE WHEN l_orderkey % 50 = 7 THEN ''
        ELSE 'C-' || lpad(cast(o_custkey AS varchar), 7, '0') END AS customer_id,
   'SKU-' || lpad(cast(l_partkey AS varchar), 6, '0') AS product_id,
   CASE WHEN l_orderkey % 50 = 11 THEN '-1'
        ELSE cast(cast(l_quantity AS int) AS varchar) END AS quantity,
   cast(l_extendedprice AS varchar) AS unit_price,
   CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' WHEN 2 THEN 'EUR' WHEN 3 THEN 'JPY'
        ELSE 'AUD' END AS currency,
   CASE WHEN l_orderkey % 50 = 13 THEN 'not-a-date'
        ELSE cast(l_shipdate AS varchar) END AS event_ts,
   CASE WHEN l_orderkey % 50 = 17 THEN ' ' || lower(n_name) || ' ' ELSE n_name END AS country,
   l_shipdate < TIMESTAMP '1998-01-01 00:00:00' AS first_delivery
 FROM lineitem
 JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey
),
typed AS (
 SELECT transaction_id, customer_id, product_id,
   try_cast(quantity AS int) AS quantity,
   try_cast(unit_price AS double) AS unit_price,
   trim(currency) AS currency,
   try_cast(event_ts AS timestamp) AS event_ts,
   trim(lower(country)) AS country,
   first_delivery, quantity AS raw_quantity, event_ts AS raw_event_ts
 FROM feed
)"""

_COLUMNS = (
    "transaction_id, customer_id, product_id, quantity, unit_price, currency, event_ts, country"
)
_IS_CLEAN = (
    "transaction_id IS NOT NULL AND event_ts IS NOT NULL AND quantity IS NOT NULL "
    "AND quantity > 0 AND unit_price IS NOT NULL AND unit_price >= 0 "
    "AND customer_id IS NOT NULL AND customer_id <> ''"
)
_REASONS = """concat_ws('; ',
   CASE WHEN transaction_id IS NULL THEN 'transaction_id missing' END,
   CASE WHEN event_ts IS NULL THEN 'event_ts unreadable' END,
   CASE WHEN quantity IS NULL OR quantity <= 0 THEN 'quantity not positive' END,
   CASE WHEN unit_price IS NULL OR unit_price < 0 THEN 'unit_price not valid' END,
   CASE WHEN customer_id IS NULL OR customer_id = '' THEN 'customer_id missing' END)"""


def _ranked(source: str) -> str:
    return f"""
 SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY event_ts DESC NULLS LAST,
   product_id NULLS LAST, quantity NULLS LAST, unit_price NULLS LAST, customer_id NULLS LAST,
   country NULLS LAST, currency NULLS LAST) AS rank
 FROM {source}"""


def _ranked_by_delivery(source: str) -> str:
    return _ranked(source).replace("NULLS LAST,\n", "NULLS LAST, first_delivery,\n", 1)


def _derived(ranked: str) -> str:
    return f"""
 SELECT {_COLUMNS}, quantity * unit_price AS revenue, cast(event_ts AS date) AS event_date
 FROM ({ranked}) r WHERE rank = 1"""


def _money(column: str) -> str:
    return f"cast(sum(cast({column} AS decimal(18,2))) AS double)"


_CLEAN = f", clean AS (SELECT * FROM typed WHERE {_IS_CLEAN})"
_SILVER = _CLEAN + f", silver AS ({_derived(_ranked('clean'))})"
_DAILY = f""", daily AS (
 SELECT cast(event_ts AS date) AS event_date, country, {_money('revenue')} AS gross_revenue,
   count(transaction_id) AS order_count, count(DISTINCT customer_id) AS unique_customers
 FROM silver GROUP BY cast(event_ts AS date), country
)"""
_LTV = f""", ltv AS (
 SELECT customer_id, {_money('revenue')} AS lifetime_revenue, count(transaction_id) AS orders,
   min(event_ts) AS first_seen, max(event_ts) AS last_seen
 FROM silver GROUP BY customer_id
)"""
_UNGATED = f", ungated AS ({_derived(_ranked('typed'))})"
_LAGS = """, lags AS (
 SELECT * FROM (
  SELECT *, lag(gross_revenue, 1) OVER w AS lag_1, lag(gross_revenue, 7) OVER w AS lag_7,
   (lag(gross_revenue, 3) OVER w + lag(gross_revenue, 2) OVER w + lag(gross_revenue, 1) OVER w) / 3
     AS rolling_3,
   cast(isodow(event_date) - 1 AS int) AS day_of_week
  FROM daily WINDOW w AS (PARTITION BY country ORDER BY event_date)
 ) s WHERE lag_1 IS NOT NULL AND lag_7 IS NOT NULL AND rolling_3 IS NOT NULL
)"""
_DELIVERIES = (
    f", first AS ({_derived(_ranked('(SELECT * FROM clean WHERE first_delivery)'))})"
    f", second AS ({_derived(_ranked('(SELECT * FROM clean WHERE NOT first_delivery)'))})"
)
_SILVER_COLUMNS = f"{_COLUMNS}, revenue, event_date"
_MERGED = f"""
 SELECT {_SILVER_COLUMNS} FROM first
 WHERE transaction_id NOT IN (SELECT transaction_id FROM second)
 UNION ALL SELECT {_SILVER_COLUMNS} FROM second"""
_CAUGHT = """CASE WHEN transaction_id IS NULL THEN 'non_null_id'
   WHEN NOT coalesce(quantity > 0, false) THEN 'positive_qty'
   WHEN NOT coalesce(unit_price >= 0, false) THEN 'non_negative_price'
   WHEN event_ts IS NULL THEN 'real_ts' END"""
_SENTENCE = """printf('Customer %s has placed %d orders totaling %.2f in revenue. First seen %s; last seen %s.',
   customer_id, orders, lifetime_revenue,
   strftime(first_seen, '%Y-%m-%d %H:%M:%S'), strftime(last_seen, '%Y-%m-%d %H:%M:%S'))"""

_TOTAL = "list_reduce(list_sort(list({})), lambda a, b: a + b)"
_HITS = f""", documents AS (SELECT customer_id AS id, {_SENTENCE} AS text, orders, lifetime_revenue FROM ltv),
questions(question_id, question) AS (VALUES
  (0, 'Which customer was first seen in 1995 and last seen in 2001?'),
  (1, 'Did customer C-0000007 order in August, on the 17?'), (2, 'Who is our most valuable customer?')),
found AS (SELECT id, word, count(*) AS n FROM (
  SELECT id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS word FROM documents) w GROUP BY id, word),
said AS (SELECT question_id, word, count(*) AS n FROM (
  SELECT question_id, unnest(regexp_extract_all(lower(question), '[a-z0-9_]+')) AS word FROM questions) w GROUP BY question_id, word),
counts AS (SELECT word, count(*) AS documents FROM found GROUP BY word),
n AS (SELECT count(*) AS total FROM documents),
raw AS (SELECT * FROM (
  SELECT id, word, n * ln((total + 1)::DOUBLE / (documents + 1)) AS raw FROM found JOIN counts USING (word), n) r WHERE raw > 0),
asked AS (SELECT * FROM (
  SELECT question_id, word, said.n * ln((total + 1)::DOUBLE / (coalesce(documents, 0) + 1)) AS asked
  FROM said LEFT JOIN counts USING (word), n) a WHERE asked > 0),
norms AS (SELECT id, sqrt({_TOTAL.format("raw * raw")}) AS norm FROM raw GROUP BY id),
lengths AS (SELECT question_id, sqrt({_TOTAL.format("asked * asked")}) AS length FROM asked GROUP BY question_id),
dots AS (SELECT question_id, id, {_TOTAL.format("(raw / norm) * asked")} AS dot
  FROM asked JOIN raw USING (word) JOIN norms USING (id) GROUP BY question_id, id),
hits AS (SELECT question_id, id, text, orders, lifetime_revenue, 2.0::DOUBLE - 2.0::DOUBLE * dot / length AS distance,
   row_number() OVER (PARTITION BY question_id ORDER BY 2.0::DOUBLE - 2.0::DOUBLE * dot / length, id) AS rank
  FROM dots JOIN lengths USING (question_id) JOIN documents USING (id) QUALIFY rank <= 3)"""


def _with(*parts: str) -> str:
    return "WITH " + _FEED + "".join(parts)


def _errors(column: str) -> str:
    return f"""SELECT '{column}' AS forecast,
   round(avg(abs(gross_revenue - {column})), 2) AS mae,
   round(1 - sum((gross_revenue - {column}) * (gross_revenue - {column}))
     / sum((gross_revenue - m) * (gross_revenue - m)), 6) AS r2,
   count(*) AS rows
 FROM lags, (SELECT avg(gross_revenue) AS m FROM lags) a"""


_ERRORS = " UNION ALL ".join(_errors(c) for c in ("lag_1", "lag_7", "rolling_3"))
_RAW_FEED_ROWS = (
    "SELECT transaction_id, nullif(customer_id, '') AS customer_id, product_id, quantity, "
    "unit_price, currency, event_ts, country"
)
_PIVOT = ", ".join(
    f"coalesce(sum(gross_revenue) FILTER (WHERE country = 'nation_{i}'), 0.0) AS nation_{i}"
    for i in range(25)
)
_LISTED = ", ".join(f"'nation_{i}'" for i in range(25))
_PIVOT += (
    f", coalesce(sum(gross_revenue) FILTER (WHERE country IS NULL OR country NOT IN ({_LISTED})), 0.0) AS other"
)

# ---- one statement per query --------------------------------------------------------

SQL: dict[str, str] = {
    "typed_projection": _with() + f" SELECT {_COLUMNS} FROM typed",
    "quality_clean": _with(_CLEAN) + f" SELECT {_COLUMNS} FROM clean",
    "quality_rejects": _with()
    + f""" SELECT {_COLUMNS}, {_REASONS} AS _reason, 'bronze/transactions' AS _bronze_source,
   raw_quantity, raw_event_ts FROM typed WHERE NOT ({_IS_CLEAN})""",
    "quality_reject_reasons": _with()
    + f""" SELECT split_part({_REASONS}, '; ', 1) AS reason, count(*) AS rows
 FROM typed WHERE NOT ({_IS_CLEAN}) GROUP BY 1""",
    "silver_dedup": _with(_SILVER) + " SELECT * FROM silver",
    "gold_daily_revenue": _with(_SILVER, _DAILY)
    + " SELECT * FROM daily ORDER BY event_date, country",
    "gold_customer_ltv": _with(_SILVER, _LTV)
    + " SELECT * FROM ltv ORDER BY lifetime_revenue DESC, customer_id",
    "gold_daily_narrow": _with(_SILVER)
    + f" SELECT event_date, country, {_money('revenue')} AS gross_revenue"
    " FROM silver GROUP BY event_date, country",
    "dashboard_kpis": _with(_SILVER, _DAILY, _LTV)
    + f""" SELECT {_money('gross_revenue')} AS gross_revenue,
   cast(sum(order_count) AS bigint) AS orders,
   (SELECT count(*) FROM ltv) AS unique_customers FROM daily""",
    "revenue_by_country_pivot": _with(_SILVER, _DAILY)
    + f" SELECT event_date, {_PIVOT} FROM daily GROUP BY event_date ORDER BY event_date",
    "top_customers": _with(_SILVER, _LTV)
    + " SELECT * FROM ltv ORDER BY lifetime_revenue DESC, customer_id LIMIT 20",
    "expect_drop": _with() + f" SELECT {_COLUMNS} FROM typed WHERE quantity > 0",
    "expect_quarantine": _with()
    + f" SELECT {_COLUMNS}, 'real_ts' AS _expectation FROM typed WHERE event_ts IS NULL",
    "expect_null_not_violation": _with()
    + f""" SELECT {_COLUMNS},
   CASE WHEN event_ts >= TIMESTAMP '1998-01-01 00:00:00' THEN 'kept' ELSE 'recent' END
     AS _expectation
 FROM typed WHERE event_ts IS NOT NULL""",
    "expect_chain_declarative": _with(_UNGATED)
    + f" SELECT * FROM ungated WHERE {_CAUGHT} IS NULL",
    "expect_chain_rejects": _with(_UNGATED)
    + f" SELECT *, {_CAUGHT} AS _expectation FROM ungated WHERE {_CAUGHT} IS NOT NULL",
    "expect_violations": _with(_UNGATED)
    + f""", caught AS (SELECT {_CAUGHT} AS e FROM ungated)
 SELECT expectation, (SELECT count(*) FROM caught WHERE e = expectation) AS rows
 FROM (VALUES ('non_null_id'), ('positive_qty'), ('non_negative_price'), ('real_ts'))
   v(expectation)""",
    "audit_silver": _with(_SILVER)
    + """ SELECT count(*) AS rows, count(*) - count(transaction_id) AS null_keys,
   count(*) FILTER (WHERE NOT coalesce(quantity > 0, false)) AS non_positive_quantity,
   count(transaction_id) - count(DISTINCT transaction_id) AS duplicate_keys FROM silver""",
    "audit_ungated": _with(_CLEAN)
    + """ SELECT count(*) AS rows, count(*) - count(transaction_id) AS null_keys,
   count(*) FILTER (WHERE NOT coalesce(quantity > 0, false)) AS non_positive_quantity,
   count(transaction_id) - count(DISTINCT transaction_id) AS duplicate_keys FROM clean""",
    "reconcile_gold_silver": _with(_SILVER, _DAILY)
    + f""" SELECT gold_revenue, silver_revenue, abs(gold_revenue - silver_revenue) <= 0.01 AS matches
 FROM (SELECT {_money('gross_revenue')} AS gold_revenue FROM daily) g,
   (SELECT {_money('revenue')} AS silver_revenue FROM silver) s""",
    "schema_contract_report": _with()
    + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM typed"
        for c in _COLUMNS.split(", ")
    ),
    "row_counts": _with(_SILVER, _DAILY, _LTV)
    + f""" SELECT 'bronze' AS layer, count(*) AS rows FROM feed
 UNION ALL SELECT 'silver', count(*) FROM silver
 UNION ALL SELECT 'rejects', count(*) FROM typed WHERE NOT ({_IS_CLEAN})
 UNION ALL SELECT 'daily_revenue', count(*) FROM daily
 UNION ALL SELECT 'customer_ltv', count(*) FROM ltv
 UNION ALL SELECT 'archive', NULL""",
    "lag_features": _with(_SILVER, _DAILY, _LAGS) + " SELECT * FROM lags",
    "lag_features_by_ranges": _with(_SILVER, _DAILY, _LAGS) + " SELECT * FROM lags",
    "row_filter": _with(_SILVER, _DAILY)
    + """ SELECT * FROM daily WHERE country IN (
   SELECT trim(lower(n_name)) FROM nation WHERE 'analyst-' || n_regionkey = 'analyst-2')""",
    "row_filter_admin": _with(_SILVER, _DAILY) + " SELECT * FROM daily",
    "column_mask": _with(_SILVER)
    + " SELECT * REPLACE (sha256(customer_id) AS customer_id) FROM silver",
    "merge_upsert": _with(_CLEAN, _DELIVERIES) + _MERGED,
    "merge_idempotent": _with(_CLEAN, _DELIVERIES) + _MERGED,
    "time_travel_first_version": _with(_CLEAN, _DELIVERIES)
    + f" SELECT {_SILVER_COLUMNS} FROM first",
    "append_doubles": _with()
    + """ SELECT transaction_id, 2 * count(*) AS copies, count(*) AS copies_as_of_0
 FROM feed GROUP BY transaction_id""",
    "schema_evolution_append": _with()
    + f""" SELECT {_COLUMNS},
   CASE WHEN first_delivery THEN 'transactions.csv' END AS _source_hint,
   cast(CASE WHEN first_delivery THEN 0 ELSE 1 END AS bigint) AS ingest_version FROM feed""",
    "compact_files": _with(_SILVER) + " SELECT * FROM silver",
    "cluster_by_customer": _with(_SILVER) + " SELECT * FROM silver",
    "vacuum_candidates": _with(_CLEAN, _DELIVERIES)
    + """ SELECT DISTINCT cast(0 AS bigint) AS data_version, event_date FROM first
 WHERE event_date IN (SELECT event_date FROM second)
   OR event_date IN (SELECT event_date FROM first
     WHERE transaction_id IN (SELECT transaction_id FROM second))""",
    "batch_csv_ingest": _with()
    + f" {_RAW_FEED_ROWS}, 'sample_raw' AS _source_hint, true AS from_csv FROM feed",
    "changing_headers_ingest": _with()
    + """ SELECT transaction_id, nullif(customer_id, '') AS customer_id, product_id, quantity, unit_price,
   CASE WHEN first_delivery THEN currency END AS currency, event_ts, country,
   CASE WHEN NOT first_delivery THEN 'shop, ' || right(product_id, 1) END AS "Shop",
   CASE WHEN NOT first_delivery THEN split_part(transaction_id, '-', 3) END AS line FROM feed""",
    "stream_ingest_available_now": _with() + f" {_RAW_FEED_ROWS} FROM feed",
    "stream_rerun_no_duplicates": _with() + f" {_RAW_FEED_ROWS} FROM feed",
    "jobs_daily_revenue": _with(_SILVER, _DAILY) + " SELECT * FROM daily",
    "jobs_rejects": _with()
    + f""" SELECT transaction_id, {_REASONS} AS reasons, raw_event_ts
 FROM typed WHERE NOT ({_IS_CLEAN})""",
    "upsert_blank_partitions": """
 SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
   CASE WHEN o_orderstatus = 'F' THEN 'F' END AS part FROM orders""",
    "secured_view": _with(_SILVER)
    + """ SELECT transaction_id, sha256(customer_id) AS customer_id, country, revenue, event_date FROM silver
 WHERE country IN (SELECT trim(lower(n_name)) FROM nation WHERE n_regionkey = 2)""",
    "cluster_by_customer_and_product": _with(_SILVER) + f" SELECT {_SILVER_COLUMNS} FROM silver",
    "ingest_counts": _with(_SILVER, _DAILY, _LTV)
    + f""" SELECT 'bronze' AS layer, count(*) AS rows FROM feed
 UNION ALL SELECT 'stream', count(*) FROM feed
 UNION ALL SELECT 'silver', count(*) FROM silver
 UNION ALL SELECT 'rejects', count(*) FROM typed WHERE NOT coalesce({_IS_CLEAN}, false)
 UNION ALL SELECT 'daily_revenue', count(*) FROM daily
 UNION ALL SELECT 'customer_ltv', count(*) FROM ltv""",
    "replaced_batch_silver": _with(
        _CLEAN,
        ", present AS (SELECT * FROM clean WHERE first_delivery OR cast(substr(transaction_id, 3, 9) AS int) % 3 = 0)",
        f", silver AS ({_derived(_ranked_by_delivery('present'))})",
    )
    + f" SELECT {_SILVER_COLUMNS} FROM silver",
    "gold_after_deliveries": _with(_SILVER, _DAILY, _LTV)
    + """ SELECT event_date, country, gross_revenue AS revenue, order_count AS orders, unique_customers,
   NULL AS customer_id, NULL::TIMESTAMP AS first_seen, NULL::TIMESTAMP AS last_seen FROM daily
 UNION ALL SELECT NULL, NULL, lifetime_revenue, orders, NULL, customer_id, first_seen, last_seen FROM ltv""",
    "jobs_incremental_silver": _with(_CLEAN) + _derived(_ranked_by_delivery("clean")),
    "jobs_declarative_daily": _with(_UNGATED)
    + f""" SELECT event_date, country, {_money('revenue')} AS gross_revenue
 FROM ungated WHERE {_CAUGHT} IS NULL GROUP BY event_date, country""",
    "forecast_error_metrics": _with(_SILVER, _DAILY, _LAGS) + " " + _ERRORS,
    "forecast_split_by_date": _with(_SILVER, _DAILY, _LAGS)
    + """ SELECT country, event_date, lag_1, lag_7, rolling_3,
   cast(day_of_week AS double) AS day_of_week, cast(order_count AS double) AS order_count,
   cast(unique_customers AS double) AS unique_customers, gross_revenue,
   CASE WHEN event_date < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS part FROM lags""",
    "register_best_run": _with(_SILVER, _DAILY, _LAGS)
    + f""", best AS (SELECT forecast FROM ({_ERRORS}) e ORDER BY mae, forecast LIMIT 1)
 SELECT 'daily_revenue_forecaster' AS name, cast(v AS bigint) AS model_version,
   CASE WHEN v = 2 THEN 'champion' END AS alias, forecast AS run_id
 FROM best, (VALUES (1), (2)) t(v)""",
    "text_embed_search": _with(_SILVER, _LTV, _HITS) + " SELECT id, text, round(distance, 9) AS distance FROM hits WHERE question_id = 0",
    "text_ask": _with(_SILVER, _LTV, _HITS)
    + """, lines AS (
  SELECT question_id, string_agg(printf('  - %s  (distance=%.3f)', text, distance), chr(10) ORDER BY rank) AS context
  FROM hits GROUP BY question_id)
 SELECT q.question_id, q.question, coalesce('Question: ' || q.question || chr(10) || chr(10) || 'Grounding context:'
   || chr(10) || context || chr(10) || chr(10)
   || printf('Answer (grounded): customer %s is the closest match with %d orders and %.2f lifetime revenue.',
     h.id, h.orders, h.lifetime_revenue), 'I couldn''t find any matching customers in Gold.') AS answer
 FROM questions q LEFT JOIN lines USING (question_id) LEFT JOIN hits h ON h.question_id = q.question_id AND h.rank = 1""",
    "knn_batch": """WITH p AS (
  SELECT q.vec_id AS question_id, d.vec_id AS id, list_reduce(list_transform(list_zip(d.embedding, q.embedding),
     lambda p: (cast(p[1] AS double) - cast(p[2] AS double))
       * (cast(p[1] AS double) - cast(p[2] AS double))), lambda a, b: a + b) AS distance
  FROM embeddings d JOIN embeddings q ON q.vec_id < 50)
 SELECT question_id, cast(row_number() OVER w AS int) AS rank, id, distance FROM p
 WINDOW w AS (PARTITION BY question_id ORDER BY distance, id) QUALIFY row_number() OVER w <= 3""",
    "knn_exact": """WITH q AS (SELECT embedding AS qv FROM embeddings WHERE vec_id = 0)
 SELECT vec_id AS id, label,
   list_reduce(list_transform(list_zip(embedding, qv),
     lambda p: (cast(p[1] AS double) - cast(p[2] AS double))
       * (cast(p[1] AS double) - cast(p[2] AS double))), lambda a, b: a + b) AS distance
 FROM embeddings, q ORDER BY distance, id LIMIT 3""",
    "customer_documents": _with(_SILVER, _LTV)
    + f" SELECT customer_id AS id, {_SENTENCE} AS text, orders, lifetime_revenue FROM ltv",
    "grounded_answer": _with(_SILVER, _LTV)
    + f""", best AS (SELECT cast(max(orders) AS double) AS o, max(lifetime_revenue) AS r FROM ltv),
 hits AS (
  SELECT *, {_SENTENCE} AS text, (orders / o - 1.0) * (orders / o - 1.0)
    + (lifetime_revenue / r - 1.0) * (lifetime_revenue / r - 1.0) AS distance
  FROM ltv, best ORDER BY distance, customer_id LIMIT 3),
 lines AS (
  SELECT string_agg(printf('  - %s  (distance=%.3f)', text, distance), chr(10)
    ORDER BY distance, customer_id) AS context FROM hits),
 top AS (SELECT * FROM hits ORDER BY distance, customer_id LIMIT 1)
 SELECT 'Who is our most valuable customer?' AS question,
   'Question: Who is our most valuable customer?' || chr(10) || chr(10) || 'Grounding context:'
   || chr(10) || context || chr(10) || chr(10)
   || printf('Answer (grounded): customer %s is the closest match with %d orders and %.2f lifetime revenue.',
     customer_id, orders, lifetime_revenue) AS answer
 FROM lines, top""",
}
