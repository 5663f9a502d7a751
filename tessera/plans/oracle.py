"""Reference SQL (DuckDB dialect) for the registered queries.

Each text recomputes its result from the raw tables, independently of the
Spark code: the fixture mapping, the silver "first" rule (earliest change by
time, then sequence), the gold aggregates and the query itself.  DuckDB's
``arg_min_null`` keeps a null value of the earliest row, like Spark's
``min_by``.  Sums are cast to BIGINT (DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

# --------------------------------------------------------------- models ---
# Event model: events -> changes -> bronze (REMOVE dropped) -> silver -> gold.
EVENT_GOLD = """
ev AS (
  SELECT event_id, ts, user_id, event_type,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ep
  FROM events
), bronze AS (
  SELECT *, CASE WHEN event_type IN ('signup', 'view') THEN 'INSERT' ELSE 'MODIFY' END AS event_name,
         ((k % 20) + 20) % 20 AS slot
  FROM ev WHERE event_type IN ('signup', 'view', 'click', 'purchase')
), silver_users AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         arg_min_null('user' || user_id || '@example.com', (ts, event_id)) AS email,
         arg_min_null('User ' || user_id, (ts, event_id)) AS name,
         MIN(ep) AS created_at, MAX(ep) AS updated_at,
         COUNT(*) AS event_count, COUNT(DISTINCT event_name) AS event_types
  FROM bronze WHERE event_type = 'signup' GROUP BY user_id
), silver_tasks AS (
  SELECT CAST(user_id * 100 + slot AS VARCHAR) AS task_id,
         arg_min_null(CAST(user_id AS VARCHAR), (ts, event_id)) AS user_id,
         arg_min_null('Task ' || slot, (ts, event_id)) AS title,
         arg_min_null('Task ' || slot || ' of user ' || user_id, (ts, event_id)) AS description,
         arg_min_null(CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress'
                      ELSE 'completed' END, (ts, event_id)) AS status,
         arg_min_null(['low', 'medium', 'high', 'urgent'][((k % 4) + 4) % 4 + 1], (ts, event_id)) AS priority,
         arg_min_null(CASE WHEN ((k % 5) + 5) % 5 = 4 THEN NULL ELSE 'cat' || (((k % 5) + 5) % 5) END,
                      (ts, event_id)) AS category,
         MIN(ep) AS created_at, MAX(ep) AS updated_at,
         COUNT(*) AS event_count, COUNT(DISTINCT event_name) AS event_types
  FROM bronze WHERE event_type IN ('view', 'click', 'purchase') GROUP BY user_id * 100 + slot
),"""

# State model: customer -> users, orders (+ customer segment) -> tasks.
STATE_GOLD = """
silver_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, 'customer' || c_custkey || '@example.com' AS email,
         c_name AS name, CAST(788918400 + c_custkey AS BIGINT) AS created_at,
         CAST(788918400 + c_custkey AS BIGINT) AS updated_at,
         CAST(1 AS BIGINT) AS event_count, CAST(1 AS BIGINT) AS event_types
  FROM customer
), silver_tasks AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS task_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'in_progress' END AS status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
              WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' END AS priority,
         c.c_mktsegment AS category,
         CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS created_at,
         CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS updated_at
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),"""

GOLD_FROM_SILVER = """
user_analytics AS (
  SELECT user_id,
         arg_min_null(email, (created_at, updated_at, email, name)) AS email,
         arg_min_null(name, (created_at, updated_at, email, name)) AS name,
         MIN(created_at) AS first_seen, MAX(updated_at) AS last_updated,
         CAST(SUM(event_count) AS BIGINT) AS total_events, MAX(event_types) AS max_event_types
  FROM silver_users GROUP BY user_id
), user_metrics AS (
  SELECT user_id, COUNT(*) AS total_tasks,
         COUNT(*) FILTER (WHERE status = 'completed') AS completed_tasks,
         COUNT(*) FILTER (WHERE status = 'pending') AS pending_tasks,
         COUNT(*) FILTER (WHERE status = 'in_progress') AS in_progress_tasks,
         MIN(created_at) AS first_task_date, MAX(updated_at) AS last_task_date
  FROM silver_tasks GROUP BY user_id
), category_trends AS (
  SELECT category, COUNT(*) AS total_tasks,
         COUNT(*) FILTER (WHERE status = 'completed') AS completed_tasks
  FROM silver_tasks GROUP BY category
), kpis AS (
  SELECT 'total_users' AS metric,
         CAST(COUNT(DISTINCT user_id) + COALESCE(MAX(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS value
  FROM silver_users
  UNION ALL SELECT 'total_tasks', CAST(COUNT(*) AS BIGINT) FROM silver_tasks
  UNION ALL SELECT 'completed_tasks', CAST(COUNT(*) FILTER (WHERE status = 'completed') AS BIGINT) FROM silver_tasks
)"""

# ------------------------------------------------------------ queries ---
# Formulated over the rows below the gold tables wherever that gives another
# way to the result than the Spark plans take: counts of tasks instead of sums
# of counts, ranks instead of limits, NOT EXISTS instead of an anti join.
# Output column names are fixed values.
def _ranked(columns: str, source: str, order: str, most: int) -> str:
    return f"SELECT {columns} FROM {source} QUALIFY row_number() OVER (ORDER BY {order}) <= {most}"


def _share(places: int) -> str:
    return f"round(100 * avg((status = 'completed')::INT), {places})"


_BY_USER = "(SELECT user_id, count(*) AS n, count(*) FILTER (status = 'completed') AS done FROM silver_tasks GROUP BY user_id)"
_BY_CATEGORY = "category, count(*) AS total_tasks, count(*) FILTER (status = 'completed') AS completed_tasks"

QUERY_SQL = {
    "q01_all_user_analytics": "FROM user_analytics",
    "q02_user_summary": """SELECT len(l) AS total_users, list_avg(l) AS avg_events_per_user, list_max(l) AS max_events_per_user,
        list_min(l) AS min_events_per_user FROM (SELECT list(total_events) AS l FROM user_analytics)""",
    "q03_top_active_users": _ranked("user_id, email, name, total_events, max_event_types", "user_analytics", "total_events DESC, user_id", 10),
    "q04_all_user_metrics": "FROM user_metrics",
    "q05_completion_summary": f"""SELECT count(*) AS total_users_with_tasks, sum(n)::BIGINT AS total_tasks_across_all_users,
        sum(done)::BIGINT AS total_completed_tasks, sum(done) / count(*) AS avg_completed_tasks_per_user,
        sum(n) / count(*) AS avg_total_tasks_per_user FROM {_BY_USER}""",
    "q06_best_completion_rates": _ranked(
        "user_id, total_tasks, completed_tasks, completion_rate_percent",
        f"(SELECT user_id, count(*) AS total_tasks, count(*) FILTER (status = 'completed') AS completed_tasks, {_share(2)} AS completion_rate_percent"
        " FROM silver_tasks GROUP BY user_id)", "completion_rate_percent DESC, user_id", 10),
    "q07_status_distribution": """SELECT metric, value::BIGINT AS value FROM (UNPIVOT (SELECT count(*) AS total_tasks,
        count(*) FILTER (status = 'completed') AS completed_tasks, count(*) FILTER (status = 'pending') AS pending_tasks,
        count(*) FILTER (status = 'in_progress') AS in_progress_tasks FROM silver_tasks) ON COLUMNS(*) INTO NAME metric VALUE value)""",
    "q08_all_category_trends": "FROM category_trends",
    "q09_popular_categories": f"SELECT {_BY_CATEGORY}, {_share(2)} AS completion_rate_percent FROM silver_tasks GROUP BY category",
    "q10_all_kpis": "FROM kpis",
    "q11_business_overview": "SELECT DISTINCT metric, value FROM kpis",
    "q12_user_productivity": """SELECT u.user_id, u.email, u.name, count(t.task_id) AS total_tasks,
        count(*) FILTER (t.status = 'completed') AS completed_tasks, count(*) FILTER (t.status = 'pending') AS pending_tasks,
        count(*) FILTER (t.status = 'in_progress') AS in_progress_tasks
        FROM user_analytics u LEFT JOIN silver_tasks t USING (user_id) GROUP BY ALL""",
    "q13_users_without_tasks": """SELECT user_id, email, name, total_events FROM user_analytics u
        WHERE NOT EXISTS (FROM silver_tasks t WHERE t.user_id = u.user_id)""",
    "q14_top_productive_users": _ranked("name, done AS completed_tasks, n AS total_tasks",
                                        f"user_analytics JOIN {_BY_USER} USING (user_id)", "done DESC, user_id", 5),
    "q15_category_completion_rate": f"SELECT {_BY_CATEGORY}, {_share(1)} AS completion_rate FROM silver_tasks GROUP BY category",
    "q16_system_health": "SELECT metric, value::INTEGER AS value FROM kpis",
    "q17_sample_user_analytics": "FROM user_analytics ORDER BY user_id LIMIT 10",
    "q17_completion_rates": """SELECT user_id, n AS total_tasks, done AS completed_tasks,
        round(100.0 * done / n, 6)::DOUBLE AS completion_rate FROM """ + _BY_USER,
    "q17_kpis": "SELECT metric, value FROM kpis",
    "q18_user_count": "SELECT count(DISTINCT user_id) AS total_users FROM silver_users",
}

# queries also registered over the customer/orders state model
STATE_QUERIES = ["q02_user_summary", "q03_top_active_users", "q05_completion_summary", "q06_best_completion_rates",
                 "q07_status_distribution", "q08_all_category_trends", "q09_popular_categories",
                 "q10_all_kpis", "q12_user_productivity", "q13_users_without_tasks",
                 "q14_top_productive_users", "q15_category_completion_rate", "q16_system_health"]


def event_query_sql(name: str) -> str:
    return f"WITH {EVENT_GOLD}{GOLD_FROM_SILVER}\n{QUERY_SQL[name]}"


def state_query_sql(name: str) -> str:
    return f"WITH {STATE_GOLD}{GOLD_FROM_SILVER}\n{QUERY_SQL[name]}"
