"""Queries for the operators beyond Q01..Q18: state folding, metrics,
lookups, quality, monitoring, transitions, idempotency and the declared
gold extensions.  Each reads the given tables (or what Spark derives from
them) and is registered with an independent DuckDB formulation.

Fixed parameters: "now" is 2024-01-31 00:00:00 UTC (the day after the last
event); the due-date range is 2024-01-10 .. 2024-01-20; the search text is
"task 1"; a keyset page holds 25 rows after key (TASK#1, TASK#105).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.decode import raw_numbers
from ..operators import cdc, gold, lookup, metrics, monitor, mutate, quality, silver
from ..schemas import ITEM
from ..sources import fixtures
from . import model
from .catalog import register

NOW = "2024-01-31 00:00:00"
NOW_EPOCH = 1706659200
TODAY = "2024-01-31"


def _metrics_now():
    # 30 days before it lies within the events' month: some users are active, some are not
    return F.lit("2024-02-27 00:00:00").cast("timestamp")


def _now():
    return F.lit(NOW).cast("timestamp")


def event_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state of the single table after replaying the event changes."""
    return mutate.current_state(mutate.changes_with_removes(fixtures.event_changes(spark, sf_dir), F.col("eventTime")))


STATE_COLS = ["PK", "SK", "status", "priority", "category", "due_date", "created_at", "updated_at",
              "completed_at", "email", "name", "last_login", "verification_status"]

# ------------------------------------------------------------ SQL parts ---
EV = """ev AS (
  SELECT event_id, ts, user_id, event_type,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ep,
         (((TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) % 20) + 20) % 20 AS slot
  FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase', 'error')
)"""

STATE = EV + """, keyed AS (
  SELECT *, CASE WHEN event_type = 'signup' THEN 'USER#' || user_id ELSE 'TASK#' || user_id END AS pk,
            CASE WHEN event_type = 'signup' THEN 'METADATA' ELSE 'TASK#' || (user_id * 100 + slot) END AS sk
  FROM ev
), last AS (
  SELECT pk, sk, arg_max(event_id, (ts, event_id)) AS last_id FROM keyed GROUP BY pk, sk
), state AS (
  SELECT kd.pk AS "PK", kd.sk AS "SK",
         CASE kd.event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress'
                            WHEN 'purchase' THEN 'completed' END AS status,
         CASE WHEN kd.event_type <> 'signup' THEN ['low', 'medium', 'high', 'urgent'][((kd.k % 4) + 4) % 4 + 1] END AS priority,
         CASE WHEN kd.event_type <> 'signup' AND ((kd.k % 5) + 5) % 5 <> 4 THEN 'cat' || (((kd.k % 5) + 5) % 5) END AS category,
         CASE WHEN kd.event_type <> 'signup' THEN strftime(DATE '2024-01-01' + INTERVAL (kd.slot * 3) DAY, '%Y-%m-%d') END AS due_date,
         kd.ep AS created_at, kd.ep AS updated_at,
         CASE WHEN kd.event_type = 'purchase' THEN kd.ep END AS completed_at,
         CASE WHEN kd.event_type = 'signup' THEN 'user' || kd.user_id || '@example.com' END AS email,
         CASE WHEN kd.event_type = 'signup' THEN 'User ' || kd.user_id END AS name,
         CASE WHEN kd.event_type = 'signup' THEN strftime(kd.ts, '%Y-%m-%dT%H:%M:%S.%f') END AS last_login,
         CASE WHEN kd.event_type = 'signup' THEN ['verified', 'pending', 'rejected'][((kd.k % 3) + 3) % 3 + 1] END AS verification_status,
         CASE WHEN kd.event_type <> 'signup' THEN 'Task ' || kd.slot END AS title,
         CASE WHEN kd.event_type <> 'signup' THEN 'Task ' || kd.slot || ' of user ' || kd.user_id END AS description,
         kd.user_id AS uid
  FROM keyed kd JOIN last l ON kd.event_id = l.last_id
  WHERE kd.event_type <> 'error'
)"""

TASK_VIEW = STATE + """, tv AS (
  SELECT split_part("SK", '#', 2) AS id, CAST(uid AS VARCHAR) AS user_id, title, description, status, priority, category,
         CAST(due_date AS DATE) AS due_date, created_at, updated_at, completed_at
  FROM state WHERE "PK" LIKE 'TASK#%'
)"""


# ------------------------------------------------------------ state ---

@register("state_from_changes", f"WITH {STATE} SELECT {', '.join(chr(34) + c + chr(34) if c in ('PK', 'SK') else c for c in STATE_COLS)} FROM state")
def state_from_changes(spark, sf_dir):
    """WIN-02 / MUT-08: last image per key after replaying every change."""
    return event_state(spark, sf_dir).select(*STATE_COLS)


@register("entity_census", f"WITH {STATE} SELECT CASE WHEN \"PK\" LIKE 'USER#%' THEN 'USER' WHEN \"PK\" LIKE 'TASK#%' THEN 'TASK' "
          "WHEN \"PK\" LIKE 'IDEMPOTENCY#%' THEN 'IDEMPOTENCY' ELSE 'UNKNOWN' END AS entity_type, COUNT(*) AS items FROM state GROUP BY 1")
def entity_census(spark, sf_dir):
    """AGG-23: items per entity type in the current state."""
    return gold.entity_census(event_state(spark, sf_dir))


# ------------------------------------------------------------ metrics ---

def _metrics_sql(state_cte: str, state_name: str) -> str:
    cutoff = "strftime(TIMESTAMP '2024-01-28 00:00:00', '%Y-%m-%dT%H:%M:%S.%f')"
    return f"""WITH {state_cte}, c AS (
  SELECT COUNT(*) FILTER (WHERE "PK" LIKE 'USER#%') AS users,
         COUNT(*) FILTER (WHERE "PK" LIKE 'USER#%' AND last_login > {cutoff}) AS active_users,
         COUNT(*) FILTER (WHERE "PK" LIKE 'USER#%' AND verification_status = 'verified') AS verified_users,
         COUNT(*) FILTER (WHERE "PK" LIKE 'TASK#%') AS tasks,
         COUNT(*) FILTER (WHERE "PK" LIKE 'TASK#%' AND status = 'completed') AS completed,
         COUNT(*) FILTER (WHERE "PK" LIKE 'TASK#%' AND status = 'pending') AS pending,
         COUNT(*) FILTER (WHERE "PK" LIKE 'TASK#%' AND status = 'in_progress') AS in_progress,
         COUNT(*) FILTER (WHERE "PK" LIKE 'TASK#%' AND priority = 'high') AS high_priority,
         COUNT(*) AS items
  FROM {state_name}
), m(metric, value, unit) AS (
  SELECT 'TotalUsers', users, 'Count' FROM c UNION ALL
  SELECT 'ActiveUsers', active_users, 'Count' FROM c UNION ALL
  SELECT 'VerifiedUsers', verified_users, 'Count' FROM c UNION ALL
  SELECT 'UserVerificationRate', CASE WHEN users > 0 THEN CAST(verified_users AS DOUBLE) / users * 100 ELSE 0 END, 'Percent' FROM c UNION ALL
  SELECT 'TotalTasks', tasks, 'Count' FROM c UNION ALL
  SELECT 'CompletedTasks', completed, 'Count' FROM c UNION ALL
  SELECT 'PendingTasks', pending, 'Count' FROM c UNION ALL
  SELECT 'InProgressTasks', in_progress, 'Count' FROM c UNION ALL
  SELECT 'HighPriorityTasks', high_priority, 'Count' FROM c UNION ALL
  SELECT 'TaskCompletionRate', CASE WHEN tasks > 0 THEN CAST(completed AS DOUBLE) / tasks * 100 ELSE 0 END, 'Percent' FROM c UNION ALL
  SELECT 'TotalItems', items, 'Count' FROM c UNION ALL
  SELECT 'AverageTasksPerUser', CASE WHEN users > 0 THEN CAST(tasks AS DOUBLE) / users ELSE 0 END, 'Count' FROM c
)
SELECT 'App/CustomMetrics' AS namespace, metric, ROUND(CAST(value AS DOUBLE), 6) AS value, unit,
       TIMESTAMP '2024-02-27 00:00:00' AS ts FROM m"""


ORDERS_STATE = """state AS (
  SELECT 'USER#' || c_custkey AS "PK", NULL AS last_login,
         CASE WHEN c_acctbal >= 0 THEN 'verified' ELSE 'pending' END AS verification_status,
         NULL AS status, NULL AS priority FROM customer
  UNION ALL
  SELECT 'TASK#' || o_custkey, NULL, NULL,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'in_progress' END,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
              WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' END
  FROM orders
)"""


@register("metrics_event_state", _metrics_sql(STATE, "state"))
def metrics_event_state(spark, sf_dir):
    """AGG-10..12 + JOIN-08 + SET-02 over the state replayed from events."""
    return metrics.collect_metrics(event_state(spark, sf_dir), _metrics_now())


@register("metrics_orders_state", _metrics_sql(ORDERS_STATE, "state"))
def metrics_orders_state(spark, sf_dir):
    """The same metric scan over the customer/orders state (at-scale model)."""
    customer, orders = (fixtures.read_table(spark, sf_dir, t) for t in ("customer", "orders"))
    # no metric reads the category: the orders aren't joined to their customers
    both = fixtures.customer_users(customer).unionByName(fixtures.order_tasks(orders, None), allowMissingColumns=True)
    return metrics.collect_metrics(both.withColumn("last_login", F.lit(None).cast("string")), _metrics_now())


# ------------------------------------------------------------ lookups ---

def _task_view(spark, sf_dir):
    return lookup.task_view(event_state(spark, sf_dir))


TV_COLS = "id, user_id, status, priority, category, due_date"


@register("overdue_tasks", f"WITH {TASK_VIEW} SELECT {TV_COLS} FROM tv WHERE due_date < DATE '{TODAY}' AND status <> 'completed'")
def overdue_tasks(spark, sf_dir):
    """FIL-12 intent over the task view (PRJ-11)."""
    return lookup.overdue_tasks(_task_view(spark, sf_dir), TODAY).select(*TV_COLS.split(", "))


@register("due_date_range", f"WITH {TASK_VIEW} SELECT {TV_COLS} FROM tv WHERE due_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'")
def due_date_range(spark, sf_dir):
    """FIL-13: due date in an inclusive range."""
    return lookup.due_between(_task_view(spark, sf_dir), "2024-01-10", "2024-01-20").select(*TV_COLS.split(", "))


@register("search_tasks", f"WITH {TASK_VIEW} SELECT id, user_id, title FROM tv WHERE lower(coalesce(title, '')) LIKE '%task 1%'"
          " OR lower(coalesce(description, '')) LIKE '%task 1%'")
def search_tasks(spark, sf_dir):
    """FIL-16: case-insensitive text search over title and description."""
    return lookup.search_tasks(_task_view(spark, sf_dir), "task 1").select("id", "user_id", "title")


@register("keyset_page", f"WITH {STATE} SELECT \"PK\", \"SK\", status FROM state WHERE \"PK\" > 'TASK#1' OR "
          "(\"PK\" = 'TASK#1' AND \"SK\" > 'TASK#105') ORDER BY \"PK\", \"SK\" LIMIT 25")
def keyset_page(spark, sf_dir):
    """PAG-01 / SRT-04: one keyset page (the limit is the feature)."""
    return lookup.page(event_state(spark, sf_dir).select("PK", "SK", "status"), ["PK", "SK"], 25,
                       after=("TASK#1", "TASK#105"))


@register("completed_with_due_date", f"WITH {TASK_VIEW} SELECT user_id, COUNT(*) AS completed_with_due FROM tv "
          "WHERE status = 'completed' AND due_date IS NOT NULL GROUP BY user_id")
def completed_with_due_date(spark, sf_dir):
    """FIL-14: completed tasks that carry a due date, counted per user."""
    tv = lookup.with_due_date(_task_view(spark, sf_dir)).filter(F.col("status") == "completed")
    return tv.groupBy("user_id").agg(F.count(F.lit(1)).alias("completed_with_due"))


# ------------------------------------------------------------ quality ---
ETL_TASK_RULES = quality.Rules(
    required_fields=["task_id", "user_id", "title", "status"],
    data_types={"title": "string", "created_at": "int"},
    constraints={"title": {"min_len": 1, "max_len": 200}, "description": {"max_len": 1000},
                 "category": {"max_len": 50}, "status": {"in": quality.TASK_STATUS},
                 # the ETL schema's priority enum has no "urgent"
                 "priority": {"in": ["low", "medium", "high"]}},
)

SILVER_TASKS_SQL = """st AS (
  SELECT CAST(user_id * 100 + slot AS VARCHAR) AS task_id,
         arg_min_null(['low', 'medium', 'high', 'urgent'][((k % 4) + 4) % 4 + 1], (ts, event_id)) AS priority,
         arg_min_null(CASE WHEN ((k % 5) + 5) % 5 = 4 THEN NULL ELSE 'cat' || (((k % 5) + 5) % 5) END, (ts, event_id)) AS category
  FROM ev WHERE event_type IN ('view', 'click', 'purchase') GROUP BY user_id * 100 + slot
)"""


@register("dq_task_rule_summary", f"""WITH {EV}, {SILVER_TASKS_SQL}, bad AS (
  SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE priority NOT IN ('low', 'medium', 'high')) AS urgent FROM st)
  SELECT r.rule, CASE WHEN r.rule = 'rows' THEN n WHEN r.rule IN ('rejected_rows', 'domain:priority') THEN urgent ELSE 0 END AS failures
  FROM bad, (VALUES ('rows'), ('rejected_rows'), ('required:task_id'), ('required:user_id'), ('required:title'), ('required:status'),
    ('type:title'), ('type:created_at'), ('min_len:title'), ('max_len:title'), ('max_len:description'), ('max_len:category'),
    ('domain:status'), ('domain:priority')) r(rule)""")
def dq_task_rule_summary(spark, sf_dir):
    """DQ-01..09: failures per rule over silver tasks (ETL rule set)."""
    st = model.event_model(spark, sf_dir).silver_tasks
    return quality.rule_summary(st, ETL_TASK_RULES)


@register("dq_task_verdicts", f"WITH {EV}, {SILVER_TASKS_SQL} SELECT COUNT(*) FILTER (WHERE priority IN ('low', 'medium', 'high') "
          "OR priority IS NULL) AS valid_rows, COUNT(*) FILTER (WHERE priority = 'urgent') AS rejected_rows FROM st")
def dq_task_verdicts(spark, sf_dir):
    """DQ-08: valid / rejected split counted in one pass."""
    st = model.event_model(spark, sf_dir).silver_tasks
    v = st.select(F.size(quality.violations(st, ETL_TASK_RULES)).alias("n"))
    return v.agg(F.count_if(F.col("n") == 0).alias("valid_rows"), F.count_if(F.col("n") > 0).alias("rejected_rows"))


@register("dq_completeness", f"WITH {EV}, {SILVER_TASKS_SQL} SELECT column_name AS \"column\", completeness FROM ("
          "SELECT 'priority' AS column_name, ROUND(COUNT(priority) / COUNT(*), 6) AS completeness FROM st UNION ALL "
          "SELECT 'category', ROUND(COUNT(category) / COUNT(*), 6) FROM st)")
def dq_completeness(spark, sf_dir):
    """DQ-09: non-null share per column."""
    st = model.event_model(spark, sf_dir).silver_tasks
    return quality.completeness(st, ["priority", "category"])


# --------------------------------------------------------- monitoring ---
LOG = """lg AS (
  SELECT ts, event_type, CAST(ROUND(value * 100) AS BIGINT) AS duration_ms,
         CASE WHEN event_type = 'error' THEN 500 WHEN event_type IN ('signup', 'purchase') THEN 201 ELSE 200 END AS http,
         CAST(floor(epoch(ts) / 300) * 300 AS BIGINT) AS p5, CAST(floor(epoch(ts) / 60) * 60 AS BIGINT) AS p1
  FROM events
)"""


def _log(spark, sf_dir):
    return monitor.app_log_from_events(fixtures.read_table(spark, sf_dir, "events"))


def _epoch_start(df: DataFrame) -> DataFrame:
    return df.withColumn("period_start", F.unix_seconds("period_start"))


@register("mon_rollup_5min", f"WITH {LOG} SELECT p5 AS period_start, COUNT(*) AS samples, CAST(SUM(duration_ms) AS BIGINT) AS sum, "
          "AVG(duration_ms) AS average, MAX(duration_ms) AS maximum FROM lg GROUP BY p5")
def mon_rollup_5min(spark, sf_dir):
    """MON-01: 5-minute Sum / Average / Maximum of request duration."""
    r = monitor.rollup(_log(spark, sf_dir), "duration_ms", "5 minutes")
    return _epoch_start(r).withColumn("sum", F.col("sum").cast("bigint"))


@register("mon_latency_percentiles", f"WITH {LOG} SELECT quantile_cont(CAST(duration_ms AS DOUBLE), 0.5) AS p50, "
          "quantile_cont(CAST(duration_ms AS DOUBLE), 0.95) AS p95, quantile_cont(CAST(duration_ms AS DOUBLE), 0.99) AS p99 FROM lg")
def mon_latency_percentiles(spark, sf_dir):
    """MON-03: exact P50 / P95 / P99."""
    return monitor.latency_percentiles(_log(spark, sf_dir))


@register("mon_error_rate", f"WITH {LOG} SELECT p5 AS period_start, COUNT(*) AS requests, COUNT(*) FILTER (WHERE http >= 400) AS errors, "
          "ROUND(CAST(COUNT(*) FILTER (WHERE http >= 400) AS DOUBLE) * 100.0 / COUNT(*), 4) AS error_rate_pct, "
          "ROUND(CAST(COUNT(*) FILTER (WHERE http >= 400) AS DOUBLE) * 100.0 / COUNT(*), 4) > 5.0 AS alarm FROM lg GROUP BY p5")
def mon_error_rate(spark, sf_dir):
    """MON-04: error share per 5 minutes, flagged above 5 %."""
    return _epoch_start(monitor.error_rate(_log(spark, sf_dir)))


@register("mon_request_volume", f"WITH {LOG} SELECT p1 AS period_start, COUNT(*) AS requests FROM lg GROUP BY p1")
def mon_request_volume(spark, sf_dir):
    """MON-05: requests per minute."""
    return _epoch_start(monitor.request_volume(_log(spark, sf_dir)))


@register("mon_error_alarm", f"""WITH {LOG}, per AS (
  SELECT p5, COUNT(*) FILTER (WHERE http >= 400) AS errors FROM lg GROUP BY p5
), calm AS (
  SELECT g.p5 FROM (SELECT UNNEST(generate_series(MIN(p5) - 300, MAX(p5), 300)) AS p5 FROM per) g
  WHERE g.p5 NOT IN (SELECT p5 FROM per WHERE errors > 0)
) SELECT per.p5 AS period_start, CAST(errors > 0 AS INTEGER) AS breach, CAST((per.p5 - calm.p5) // 300 AS BIGINT) AS run,
    (per.p5 - calm.p5) // 300 >= 2 AS alarm
  FROM per ASOF JOIN calm ON per.p5 >= calm.p5""")
def mon_error_alarm(spark, sf_dir):
    """MON-02 + WIN-04: errors in 2 consecutive 5-minute periods, a row a period with requests;
    a period without any is no breach and ends a run."""
    log = _log(spark, sf_dir)
    per = log.groupBy(F.window("timestamp", "5 minutes").start.alias("period_start")).agg(
        F.count_if(F.col("status") == "error").alias("errors"))
    a = monitor.threshold_alarm(per, "errors", 0, 2, 300)
    return _epoch_start(a).select("period_start", F.col("breach").cast("int"), F.col("run").cast("bigint"), "alarm")


@register("mon_latency_percentiles_5min", f"WITH {LOG} SELECT p5 AS period_start, quantile_cont(CAST(duration_ms AS DOUBLE), 0.5) AS p50, "
          "quantile_cont(CAST(duration_ms AS DOUBLE), 0.95) AS p95, quantile_cont(CAST(duration_ms AS DOUBLE), 0.99) AS p99 FROM lg GROUP BY p5")
def mon_latency_percentiles_5min(spark, sf_dir):
    """MON-03: exact P50 / P95 / P99 of each 5-minute period."""
    return _epoch_start(monitor.latency_percentiles(_log(spark, sf_dir), "5 minutes"))


@register("mon_slow_periods", f"""WITH {LOG}, per AS (
  SELECT event_type AS operation, ts_day, AVG(CAST(duration_ms AS DOUBLE)) AS duration FROM (
    SELECT *, p5 // 86400 AS ts_day FROM lg) GROUP BY ALL
), prior AS (
  SELECT a.operation, a.ts_day, a.duration, (SELECT AVG(b.duration) FROM per b WHERE b.operation = a.operation AND b.ts_day < a.ts_day) AS prior_avg
  FROM per a
) SELECT operation, CAST(ts_day AS BIGINT) AS day, ROUND(duration, 6) AS duration, ROUND(prior_avg, 6) AS prior_avg,
    COALESCE(duration > prior_avg * 1.02, false) AS slow FROM prior""")
def mon_slow_periods(spark, sf_dir):
    """WIN-05: an operation's daily mean duration against the mean of its earlier days, flagged above it by 2 %."""
    daily = _log(spark, sf_dir).groupBy("operation", F.floor(F.unix_seconds("timestamp") / 86400).alias("started_at")).agg(
        F.avg(F.col("duration_ms").cast("double")).alias("duration"))
    out = monitor.slow_runs(daily, 1.02, ["operation"])
    return out.select("operation", F.col("started_at").alias("day"), F.round("duration", 6).alias("duration"),
                      F.round("prior_avg", 6).alias("prior_avg"), "slow")


@register("mon_layer_growth", """WITH daily AS (
  SELECT epoch_us(ts) // 86400000000 AS day, event_type AS layer, SUM(strlen(props)) AS added FROM events GROUP BY ALL
) SELECT layer, CAST(day AS BIGINT) AS snapshot_ts, CAST(SUM(added) OVER (PARTITION BY layer ORDER BY day) AS BIGINT) AS bytes,
    CAST(CASE WHEN LAG(day) OVER (PARTITION BY layer ORDER BY day) IS NOT NULL THEN added END AS BIGINT) AS growth_bytes FROM daily""")
def mon_layer_growth(spark, sf_dir):
    """MON-07: bytes of each kind of event payload at the end of each day, and the growth since the day before it."""
    ev = fixtures.read_table(spark, sf_dir, "events")
    daily = ev.groupBy(F.col("event_type").alias("layer"), F.floor(F.unix_seconds("ts") / 86400).alias("snapshot_ts")).agg(
        F.sum(F.octet_length("props")).cast("bigint").alias("added"))
    # one row a layer and day
    total = daily.withColumn("bytes", F.sum("added").over(Window.partitionBy("layer").orderBy("snapshot_ts"))).drop("added")
    return monitor.layer_growth(total)


@register("mon_top_error_operations", f"WITH {LOG} SELECT event_type AS operation, COUNT(*) AS errors FROM lg "
          "WHERE http >= 500 GROUP BY event_type ORDER BY errors DESC, operation LIMIT 5")
def mon_top_error_operations(spark, sf_dir):
    """MON-05: top error operations (top-k report)."""
    return monitor.top_errors(_log(spark, sf_dir))


# ------------------------------------------------------ transitions ---

@register("illegal_transitions", f"""WITH {EV}, tc AS (
  SELECT CAST(user_id * 100 + slot AS VARCHAR) AS task_id, event_id, ts,
         CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'completed' END AS status
  FROM ev WHERE event_type IN ('view', 'click', 'purchase', 'error')
), l AS (
  SELECT *, LAG(status) OVER (PARTITION BY task_id ORDER BY ts, event_id) AS prev_status FROM tc
) SELECT task_id, CAST(event_id AS VARCHAR) AS sequence_number, prev_status, status FROM l
  WHERE prev_status = 'completed' AND status IS NOT NULL AND status <> 'completed'""")
def illegal_transitions(spark, sf_dir):
    """WIN-03: a change that moves a task away from completed."""
    allc = mutate.changes_with_removes(fixtures.event_changes(spark, sf_dir), F.col("eventTime"))
    tasks = allc.filter(F.col("data.PK").startswith("TASK#")).select(
        F.regexp_replace("data.SK", "^TASK#", "").alias("task_id"), F.col("data.status").alias("status"),
        "processed_at", "sequence_number")
    # the changes are decoded once, into the four columns that the lag reads twice
    tasks = model.materialize(tasks, "task-statuses")
    return mutate.lag_transitions(tasks).select("task_id", "sequence_number", "prev_status", "status")


# ------------------------------------------------------ idempotency ---
CHAIN = EV + """, req AS (
  SELECT user_id || ':' || k AS request_id, ep AS ts_epoch, event_id FROM ev
), w(request_id, start) AS (
  SELECT request_id, MIN(ts_epoch) FROM req GROUP BY request_id
  UNION ALL
  SELECT w.request_id, (SELECT MIN(r.ts_epoch) FROM req r WHERE r.request_id = w.request_id AND r.ts_epoch > w.start + 86400)
  FROM w WHERE w.start IS NOT NULL
), starts AS (
  SELECT DISTINCT request_id, start FROM w WHERE start IS NOT NULL
), ranked AS (
  SELECT request_id, ts_epoch, event_id, ROW_NUMBER() OVER (PARTITION BY request_id, ts_epoch ORDER BY event_id) AS rn FROM req
), replays AS (
  SELECT request_id, ts_epoch, event_id,
    NOT (rn = 1 AND EXISTS (SELECT 1 FROM starts s WHERE s.request_id = ranked.request_id AND s.start = ranked.ts_epoch)) AS replay
  FROM ranked
)"""


@register("idempotent_replays", f"WITH RECURSIVE {CHAIN} SELECT request_id, ts_epoch, event_id FROM replays WHERE replay")
def idempotent_replays(spark, sf_dir):
    """JOIN-04 / FIL-19 / STR-04 batch form: requests that replay a live key.
    Request id = "<user>:<k>" (user-scoped, PRJ-16 shape); keys chain, each
    living 24 h from the request that made it, as in the stream."""
    ev = fixtures.read_table(spark, sf_dir, "events")
    req = ev.filter(F.col("event_type").isin(*fixtures.EVENT_KIND)).select(
        F.concat(F.col("user_id").cast("string"), F.lit(":"),
                 F.get_json_object("props", "$.k").try_cast("bigint").cast("string")).alias("request_id"),
        F.unix_seconds("ts").alias("ts_epoch"), "event_id").filter("request_id is not null")
    return mutate.request_replays(req, "event_id").filter("replay").drop("replay")


# -------------------------------------------------- gold extensions ---

@register("gold_extended_user_metrics", """WITH t AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus, o_orderpriority, c.c_mktsegment AS category
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
), a AS (
  SELECT user_id, COUNT(*) AS total_tasks,
    COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS completed_tasks,
    COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS pending_tasks,
    COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS in_progress_tasks,
    COUNT(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS high_priority_tasks,
    COUNT(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS medium_priority_tasks,
    COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS low_priority_tasks,
    COUNT(DISTINCT category) AS categories_used
  FROM t GROUP BY user_id
) SELECT *, ROUND(CAST(completed_tasks AS DOUBLE) * 100.0 / total_tasks, 4) AS completion_rate,
  ROUND(ROUND(CAST(completed_tasks AS DOUBLE) * 100.0 / total_tasks, 4) * ln(1 + total_tasks), 4) AS productivity_score
FROM a""")
def gold_extended_user_metrics(spark, sf_dir):
    """AGG-16 over the at-scale task table (customer/orders)."""
    return gold.extended_user_metrics(model.state_model(spark, sf_dir).tasks_with_category())


@register("gold_extended_category_trends", """SELECT c.c_mktsegment AS category, COUNT(*) AS total_tasks,
  COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS completed_tasks,
  COUNT(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS high_priority_tasks,
  ROUND(AVG(CASE WHEN o_orderstatus = 'F' THEN ((o_orderkey % 14) + 1) * 86400 / 86400.0 END), 4) AS avg_completion_days,
  ROUND(CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) * 100.0 / COUNT(*), 4) AS completion_rate
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment""")
def gold_extended_category_trends(spark, sf_dir):
    """AGG-17 over the order tasks (completed_at known)."""
    orders, customer = (fixtures.read_table(spark, sf_dir, t) for t in ("orders", "customer"))
    tasks = fixtures.order_tasks(orders, None).withColumn("user_id", F.col("user_key").cast("string"))
    return gold.extended_category_trends(tasks, customer.select(
        F.col("c_custkey").cast("string").alias("user_id"), F.col("c_mktsegment").alias("category")))


@register("gold_daily_active_users", "SELECT CAST(ts AS DATE) AS date, COUNT(DISTINCT user_id) AS active_users FROM events "
          "WHERE user_id IS NOT NULL GROUP BY 1")
def gold_daily_active_users(spark, sf_dir):
    """AGG-19: distinct users per day (exact)."""
    return gold.daily_active_users(fixtures.read_table(spark, sf_dir, "events"))


@register("gold_completion_trend", f"WITH {STATE} SELECT DATE '1970-01-01' + CAST(floor(completed_at / 86400) AS INTEGER) AS date, COUNT(*) AS completed_tasks "
          "FROM state WHERE completed_at IS NOT NULL GROUP BY 1")
def gold_completion_trend(spark, sf_dir):
    """AGG-20: completed tasks per completion date."""
    return gold.completion_trend(event_state(spark, sf_dir))


@register("gold_tasks_per_user_day", """SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderdate AS DATE) AS date,
  COUNT(*) AS tasks FROM orders GROUP BY 1, 2""")
def gold_tasks_per_user_day(spark, sf_dir):
    """AGG-21: tasks created per user and day (order tasks)."""
    return gold.tasks_per_user_day(model.state_model(spark, sf_dir).silver_tasks)


@register("gold_count_by_priority", """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
  WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' END AS priority, COUNT(*) AS tasks FROM orders GROUP BY 1""")
def gold_count_by_priority(spark, sf_dir):
    """AGG-22: per-value counts (priority)."""
    return gold.count_by(model.state_model(spark, sf_dir).silver_tasks, "priority")


@register("gold_user_growth", f"""WITH {EV}, u AS (
  SELECT user_id, MIN(ep) AS created_at FROM ev WHERE event_type = 'signup' GROUP BY user_id
), d AS (SELECT DATE '1970-01-01' + CAST(floor(created_at / 86400) AS INTEGER) AS date, COUNT(*) AS new_users FROM u GROUP BY 1)
SELECT date, new_users, CAST(SUM(new_users) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_users FROM d""")
def gold_user_growth(spark, sf_dir):
    """WIN-01: new users per day and the running total."""
    g = gold.user_growth(model.event_model(spark, sf_dir).silver_users)
    return g.withColumn("total_users", F.col("total_users").cast("bigint"))


@register("gold_kpi_overview", """WITH um AS (
  SELECT o_custkey, COUNT(*) AS total_tasks, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS completed_tasks
  FROM orders GROUP BY o_custkey
) SELECT AVG(total_tasks) AS avg_tasks_per_user, AVG(completed_tasks) AS avg_completed_per_user,
  ROUND(CAST(SUM(completed_tasks) AS DOUBLE) * 100.0 / SUM(total_tasks), 2) AS completion_percent FROM um""")
def gold_kpi_overview(spark, sf_dir):
    """AGG-15: KPI overview over the per-user metrics."""
    return gold.kpi_overview(model.state_model(spark, sf_dir).user_metrics)


@register("silver_cdc_rows", f"""WITH {EV} SELECT CASE WHEN event_type IN ('signup', 'view') THEN 'INSERT' ELSE 'MODIFY' END AS event_name,
  CAST(event_id AS VARCHAR) AS sequence_number,
  CASE WHEN event_type = 'signup' THEN 'USER' ELSE 'TASK' END AS entity_type,
  CAST(user_id AS VARCHAR) AS user_id,
  CASE WHEN event_type <> 'signup' THEN CAST(user_id * 100 + slot AS VARCHAR) END AS task_id,
  CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'completed' END AS status,
  CASE WHEN event_type <> 'signup' THEN 'STATUS#' || (CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress'
       ELSE 'completed' END) || '#' || (user_id * 100 + slot) END AS gsi1_sk,
  ep AS created_at, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
  FROM ev WHERE event_type <> 'error'""")
def silver_cdc_rows(spark, sf_dir):
    """PRJ-04..09 / FIL-03: flat silver change rows (decoded from tagged images)."""
    s = silver.silver_cdc(model.event_bronze(spark, sf_dir))
    return s.select("event_name", "sequence_number", "entity_type", "user_id", "task_id", "status", "gsi1_sk",
                    "created_at", "year", "month", "day")


@register("cdc_batch_counters", """SELECT CAST(ts AS DATE) AS batch, COUNT(*) FILTER (WHERE event_type <> 'error') AS processed,
  CAST(0 AS BIGINT) AS failed, COUNT(*) FILTER (WHERE event_type = 'error') AS skipped, COUNT(*) AS records FROM events GROUP BY 1""")
def cdc_batch_counters(spark, sf_dir):
    """AGG-13: processed / failed / skipped per daily batch."""
    ch = fixtures.event_changes(spark, sf_dir).withColumn("batch", F.to_date("eventTime"))
    return cdc.batch_counters(ch, "batch")


#: Changes broken by a rule on the event id: of 40, one without image, one a bad number, one a bad set, one no record at all.
def _broken(changes: DataFrame) -> DataFrame:
    n = F.col("dynamodb.SequenceNumber").cast("bigint") % 40
    kept, image = F.col("dynamodb.Keys"), F.col("dynamodb.NewImage")
    bad_number = F.parse_json(F.regexp_replace(F.to_json(image), '"created_at":[{]"N":"[0-9]+"', '"created_at":{"N":"abc"'))
    bad_set = F.parse_json(F.regexp_replace(F.to_json(image), "^[{]", '{"marks":{"NS":["1","x"]},'))
    told = F.when(image.isNull() | (n == 1), F.when(n == 1, F.parse_json(F.lit("{}")))) \
        .when(n == 2, bad_number).when(n == 3, bad_set).otherwise(image)
    lost = n == 4
    return changes.select(
        F.when(~lost, F.col("eventName")).alias("eventName"), "eventTime",
        F.struct(F.col("dynamodb.SequenceNumber").alias("SequenceNumber"), kept.alias("Keys"),
                 F.when(~lost, told).alias("NewImage"), F.when(~lost, F.col("dynamodb.OldImage")).alias("OldImage")).alias("dynamodb"),
        F.when(lost, F.lit("{cut of")).alias("_corrupt_record"))


@register("cdc_broken_records", """WITH c AS (SELECT CAST(ts AS DATE) AS batch, event_id % 40 AS n, event_type = 'error' AS gone
  FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase', 'error'))
  SELECT batch, COUNT(*) FILTER (WHERE n = 4 OR (n = 3 AND NOT gone)) AS failed,
    COUNT(*) FILTER (WHERE n <> 4 AND (gone OR n = 1)) AS skipped,
    COUNT(*) FILTER (WHERE n NOT IN (1, 3, 4) AND NOT gone) AS processed,
    COUNT(*) FILTER (WHERE n = 2 AND NOT gone) AS raw_kept, COUNT(*) AS records FROM c GROUP BY 1""")
def cdc_broken_records(spark, sf_dir):
    """SNK-04 / AGG-13: processed / failed / skipped / raw-kept of changes of which some are broken."""
    ch = _broken(fixtures.event_changes(spark, sf_dir)).withColumn("batch", F.to_date("eventTime"))
    c = cdc.classify(ch)
    raw = F.when(F.col("_outcome") == "processed", raw_numbers(F.col("_image"), ITEM))
    return c.select("batch", "_outcome", raw.alias("_raw")).groupBy("batch").agg(
        *[F.count_if(F.col("_outcome") == x).alias(x) for x in ("failed", "skipped", "processed")],
        F.count("_raw").alias("raw_kept"), F.count(F.lit(1)).alias("records"))


@register("cdc_failures_by_error", """SELECT CASE WHEN event_id % 40 = 4 THEN 'malformed record' ELSE 'unparseable number in a set' END AS error,
  COUNT(*) AS failed FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase', 'error')
  AND (event_id % 40 = 4 OR (event_id % 40 = 3 AND event_type <> 'error')) GROUP BY 1""")
def cdc_failures_by_error(spark, sf_dir):
    """AGG-14: quarantined records per error."""
    _, bad = cdc.split_quarantine(_broken(fixtures.event_changes(spark, sf_dir)))
    return cdc.delivery_failures(bad)


# ------------------------------------------------------------ streaming ---

@register("stream_rollup_5min", f"WITH {LOG} SELECT p5 AS period_start, COUNT(*) AS samples, CAST(SUM(duration_ms) AS BIGINT) AS sum, "
          "AVG(duration_ms) AS average, MAX(duration_ms) AS maximum FROM lg GROUP BY p5")
def stream_rollup_5min(spark, sf_dir):
    """STR-05: the 5-minute roll-up as a streaming aggregate over the events
    file stream, run to completion; must equal its batch twin (MON-01)."""
    from ..streaming import streams
    log = monitor.app_log_from_events(streams.table_stream(spark, sf_dir, "events"))
    out = streams.replay_to_table(spark, streams.tumbling_rollup(log), "rollup", output_mode="update", key="period_start")
    return _epoch_start(out).withColumn("sum", F.col("sum").cast("bigint"))


@register("stream_task_state_machine", f"""WITH {EV}, tc AS (
  SELECT CAST(user_id * 100 + slot AS VARCHAR) AS task_id, event_id, CAST(event_id AS VARCHAR) AS sequence_number,
         CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'completed' END AS status
  FROM ev WHERE event_type IN ('view', 'click', 'purchase', 'error')
), marks AS (
  SELECT *, last_value(CASE WHEN status = 'completed' THEN 'C' WHEN status IS NULL THEN 'R' END IGNORE NULLS)
              OVER (PARTITION BY task_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_mark
  FROM tc
), acc AS (
  SELECT *, NOT COALESCE(last_mark = 'C' AND status IS NOT NULL AND status <> 'completed', false) AS accepted FROM marks
) SELECT task_id, sequence_number,
    (last_value(CASE WHEN accepted THEN {{'s': status}} END IGNORE NULLS)
       OVER (PARTITION BY task_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)).s AS prev_status,
    status, accepted, false AS late
  FROM acc""")
def stream_task_state_machine(spark, sf_dir):
    """STR-07: per-task status machine over the change stream, which comes in several deliveries out of order; rows
    flagged accepted = false are the updates the service would reject.  Late by the delay is none."""
    from ..streaming import streams
    from .increment_queries import delivered_stream
    tc = fixtures.event_items(fixtures.read_table(spark, sf_dir, "events")).filter(F.col("entity") == "TASK").select(
        F.regexp_replace("SK", "^TASK#", "").alias("task_id"), "status", F.col("SequenceNumber").alias("sequence_number"),
        F.col("eventTime").cast("timestamp").alias("event_time"))
    seconds = F.unix_seconds("event_time") + _delay(F.col("sequence_number").cast("bigint"))
    stream = delivered_stream(spark, tc, seconds, "event_time")
    out = streams.replay_to_table(spark, streams.task_state_machine(stream, "3 days", groups=streams.GROUPS), "task_machine", rocksdb=True)
    return out.filter("task_id is not null")


@register("gold_extended_user_analytics", f"""WITH {EV}, su AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, COUNT(*) AS total_events, MAX(ts) AS last_login
  FROM ev WHERE event_type = 'signup' GROUP BY user_id
), pv AS (
  SELECT total_events, COUNT(*) AS n FROM su GROUP BY total_events
), rk AS (
  SELECT total_events,
         COALESCE(SUM(n) OVER (ORDER BY total_events ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         SUM(n) OVER () AS users
  FROM pv
) SELECT su.user_id, su.total_events, su.total_events AS total_logins,
    CAST(DATE '2024-01-31' - CAST(su.last_login AS DATE) AS INTEGER) AS days_since_last_login,
    CASE WHEN DATE '2024-01-31' - CAST(su.last_login AS DATE) <= 7 THEN 'high'
         WHEN DATE '2024-01-31' - CAST(su.last_login AS DATE) <= 30 THEN 'medium' ELSE 'low' END AS engagement_level,
    CASE WHEN rk.below * 3 < rk.users THEN 'low' WHEN rk.below * 3 < rk.users * 2 THEN 'medium' ELSE 'high' END AS user_segment
  FROM su JOIN rk ON su.total_events = rk.total_events""")
def gold_extended_user_analytics(spark, sf_dir):
    """AGG-18: logins (signups), days since last login, engagement level and
    event-count tercile segment per user."""
    g = model.event_model(spark, sf_dir)
    logins = fixtures.read_table(spark, sf_dir, "events").filter(F.col("event_type") == "signup") \
        .select(F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("login_ts"))
    out = gold.extended_user_analytics(g.user_analytics, logins, TODAY)
    return out.withColumn("total_logins", F.col("total_logins").cast("bigint"))


#: Arrival of a change after its event, by a rule on the event id: 0 to 6 hours in steps, every 50th two days late.
ARRIVAL_SQL = "ts + INTERVAL (event_id % 7) HOUR + INTERVAL (CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END) DAY"


def _delay(n):
    return n % 7 * 3600 + F.when(n % 50 == 0, 2 * 86400).otherwise(0)


def _arrival():
    return F.timestamp_seconds(F.unix_seconds("eventTime") + _delay(F.col("dynamodb.SequenceNumber").cast("bigint")))


@register("delivery_lag", f"""WITH {EV} SELECT CAST({ARRIVAL_SQL} AS DATE) AS date, COUNT(*) AS records,
  CAST(MAX(epoch(date_trunc('second', {ARRIVAL_SQL})) - epoch(date_trunc('second', ts))) AS BIGINT) AS max_lag_seconds,
  COUNT(*) FILTER (WHERE epoch(date_trunc('second', {ARRIVAL_SQL})) - epoch(date_trunc('second', ts)) > 300) AS late
  FROM ev WHERE event_type <> 'error' GROUP BY 1""")
def delivery_lag(spark, sf_dir):
    """MON-06: per arrival date the largest delivery lag and the records over the alarm limit of 300 s."""
    b = cdc.changes_to_bronze(fixtures.event_changes(spark, sf_dir), now=_arrival())
    return monitor.delivery_lag_by_date(b)


@register("stream_bronze_by_date", f"""WITH {EV} SELECT CAST({ARRIVAL_SQL} AS DATE) AS date,
  COUNT(*) FILTER (WHERE event_type IN ('signup', 'view')) AS inserts,
  COUNT(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS modifies
  FROM ev WHERE event_type <> 'error' GROUP BY 1""")
def stream_bronze_by_date(spark, sf_dir):
    """STR-01 / SNK-01: the change stream (built from the events file
    stream) landed as bronze by the streaming handler, read back and
    counted per arrival date; removes are dropped, as in the batch path."""
    import uuid
    from ..session import work_path
    from ..sources.lake import read_bronze
    from ..streaming import streams
    base = work_path(spark, f"stream-bronze-{uuid.uuid4().hex[:8]}")
    changes = fixtures.items_to_changes(fixtures.event_items(streams.table_stream(spark, sf_dir, "events")))
    q = streams.changes_to_bronze_stream(changes, f"{base}/bronze", f"{base}/quarantine", f"{base}/ck", now=_arrival())
    q.awaitTermination()
    b = read_bronze(spark, f"{base}/bronze")
    return b.groupBy(F.to_date("processed_at").alias("date")).agg(
        F.count_if(F.col("event_name") == "INSERT").alias("inserts"),
        F.count_if(F.col("event_name") == "MODIFY").alias("modifies"))


@register("stream_idempotency_replays", f"WITH RECURSIVE {CHAIN} SELECT request_id, ts_epoch, replay FROM replays")
def stream_idempotency_replays(spark, sf_dir):
    """STR-04 exact: each request (id "<user>:<k>") replays a live key or
    creates one valid 24 h; windows chain per id, state is one row per id."""
    from ..streaming import streams
    from .increment_queries import delivered_stream
    ev = fixtures.read_table(spark, sf_dir, "events")
    req = ev.select(F.concat_ws(":", F.col("user_id").cast("string"),
                                F.get_json_object("props", "$.k").try_cast("bigint").cast("string")).alias("request_id"),
                    F.unix_seconds("ts").alias("ts_epoch"))
    stream = delivered_stream(spark, req, F.col("ts_epoch"), None)
    out = streams.replay_to_table(spark, streams.idempotency_stream(stream), "idempotency", rocksdb=True)
    return out.select("request_id", "ts_epoch", "replay")


@register("idempotency_targets", f"""WITH {STATE}, req AS (
  SELECT user_id || ':' || k AS request_id, user_id, user_id * 100 + slot AS task_id, ep, event_id
  FROM ev WHERE event_type = 'purchase'
), keys AS (
  SELECT request_id, arg_min('TASK#' || user_id, (ep, event_id)) AS target_task_pk,
         arg_min('TASK#' || task_id, (ep, event_id)) AS target_task_sk
  FROM req GROUP BY request_id
) SELECT COUNT(*) FILTER (WHERE s."PK" IS NOT NULL) AS keys_with_target,
         COUNT(*) FILTER (WHERE s."PK" IS NULL) AS dangling_keys
  FROM keys LEFT JOIN state s ON keys.target_task_pk = s."PK" AND keys.target_task_sk = s."SK\"""")
def idempotency_targets(spark, sf_dir):
    """JOIN-06: idempotency keys of purchase requests joined to their target
    task in the current state; dangling keys point at deleted tasks."""
    ev = fixtures.read_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    req = ev.select(F.concat_ws(":", F.col("user_id").cast("string"), k.cast("string")).alias("request_id"),
                    F.col("user_id").cast("string").alias("user_id"),
                    (F.col("user_id") * 100 + F.pmod(k, F.lit(fixtures.TASKS_PER_USER))).cast("string").alias("task_id"),
                    F.unix_seconds("ts").alias("ts_epoch"), "event_id")
    keys = req.groupBy("request_id").agg(
        F.min_by(F.struct("user_id", "task_id"), F.struct("ts_epoch", "event_id")).alias("_t")).select(
        "request_id", F.concat(F.lit("TASK#"), F.col("_t.user_id")).alias("target_task_pk"),
        F.concat(F.lit("TASK#"), F.col("_t.task_id")).alias("target_task_sk"))
    hit, dangling = mutate.keys_with_targets(keys, event_state(spark, sf_dir))
    flags = hit.select(F.lit(1).alias("h"), F.lit(0).alias("d")).unionByName(
        dangling.select(F.lit(0).alias("h"), F.lit(1).alias("d")))
    return flags.agg(F.coalesce(F.sum("h"), F.lit(0)).cast("bigint").alias("keys_with_target"),
                     F.coalesce(F.sum("d"), F.lit(0)).cast("bigint").alias("dangling_keys"))


# ------------------------------------------------------ mutations, lookups ---
#: Requests on the order tasks, by a rule on the event id: each event addresses one order key (some beyond the
#: last order, so missing ones occur) and sets a status by its type.
UPDATES_SQL = """upd AS (
  SELECT CASE WHEN event_id % 9 = 0 THEN -event_id ELSE (event_id * 7) % (SELECT MAX(o_orderkey) FROM orders) + 1 END AS task_id, event_id AS seq,
         CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'click' THEN 'in_progress' WHEN 'signup' THEN 'pending' END AS status,
         CASE WHEN event_type = 'view' THEN 'Renamed ' || event_id END AS title
  FROM events), tasks AS (
  SELECT o_orderkey AS task_id, 'Order ' || o_orderkey AS title,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'in_progress' END AS status FROM orders)"""
FOLD_SQL = UPDATES_SQL + """, done AS (
  SELECT task_id, MIN(seq) AS done_seq FROM upd WHERE status = 'completed' GROUP BY task_id
), judged AS (
  SELECT u.*, t.task_id IS NOT NULL AS found,
         COALESCE(t.status = 'completed', false) OR COALESCE(u.seq > d.done_seq, false) AS closed
  FROM upd u LEFT JOIN tasks t ON u.task_id = t.task_id LEFT JOIN done d ON u.task_id = d.task_id
), verdicts AS (
  SELECT *, found AND closed AND COALESCE(status <> 'completed', false) AS rejected FROM judged
), folded AS (
  SELECT task_id, arg_max(status, seq) FILTER (status IS NOT NULL) AS status, arg_max(title, seq) FILTER (title IS NOT NULL) AS title
  FROM verdicts WHERE found AND NOT rejected GROUP BY task_id
)"""


def _order_requests(spark, sf_dir):
    """(tasks, updates) of the order model: typed tasks and requests derived from the events."""
    orders, events = (fixtures.read_table(spark, sf_dir, t) for t in ("orders", "events"))
    tasks = orders.select(
        F.col("o_orderkey").alias("task_id"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        fixtures._case(F.col("o_orderstatus"), fixtures.ORDER_STATUS).alias("status"), F.lit(0).cast("bigint").alias("updated_at"))
    last = orders.agg(F.max("o_orderkey")).first()[0]
    updates = events.select(
        F.when(F.col("event_id") % 9 == 0, -F.col("event_id")).otherwise((F.col("event_id") * 7) % last + 1).alias("task_id"),
        F.col("event_id").alias("seq"),
        fixtures._case(F.col("event_type"), {"purchase": "completed", "click": "in_progress", "signup": "pending"}).alias("status"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("Renamed "), F.col("event_id").cast("string"))).alias("title"))
    return tasks, updates


@register("mut_task_updates", f"""WITH {FOLD_SQL} SELECT t.task_id, COALESCE(f.title, t.title) AS title, COALESCE(f.status, t.status) AS status,
  CAST(CASE WHEN f.task_id IS NOT NULL THEN {NOW_EPOCH} ELSE 0 END AS BIGINT) AS updated_at FROM tasks t LEFT JOIN folded f ON t.task_id = f.task_id""")
def mut_task_updates(spark, sf_dir):
    """MUT-03 / MUT-05: the task table after a batch of partial updates."""
    tasks, updates = _order_requests(spark, sf_dir)
    return mutate.update_tasks(tasks, updates, F.lit(NOW_EPOCH).cast("bigint"), key=("task_id",))[0]


@register("mut_update_verdicts", f"""WITH {FOLD_SQL} SELECT seq, task_id, CASE WHEN NOT found THEN 'not found' ELSE 'rejected' END AS verdict
  FROM verdicts WHERE NOT found OR rejected""")
def mut_update_verdicts(spark, sf_dir):
    """MUT-05: the updates that were not applied, and why."""
    tasks, updates = _order_requests(spark, sf_dir)
    _, missing, rejected = mutate.update_tasks(tasks, updates, F.lit(NOW_EPOCH).cast("bigint"), key=("task_id",))
    return missing.select("seq", "task_id", F.lit("not found").alias("verdict")).unionByName(
        rejected.select("seq", "task_id", F.lit("rejected").alias("verdict")))


@register("mut_delete_tasks", f"""WITH {UPDATES_SQL}, gone AS (SELECT DISTINCT task_id FROM upd WHERE status = 'pending')
  SELECT 'kept' AS outcome, status, COUNT(*) AS tasks FROM tasks WHERE task_id NOT IN (SELECT task_id FROM gone) GROUP BY status
  UNION ALL SELECT 'missing', NULL, COUNT(*) FROM gone WHERE task_id NOT IN (SELECT task_id FROM tasks)""")
def mut_delete_tasks(spark, sf_dir):
    """MUT-06: tasks left per status after a batch of deletes, and deletes of missing tasks."""
    tasks, updates = _order_requests(spark, sf_dir)
    gone = updates.filter(F.col("status") == "pending").select("task_id").distinct()
    kept, missing = mutate.delete_tasks(tasks, gone, key=("task_id",))
    return kept.groupBy("status").agg(F.count(F.lit(1)).alias("tasks")).select(F.lit("kept").alias("outcome"), "status", "tasks").unionByName(
        missing.agg(F.count(F.lit(1)).alias("tasks")).select(F.lit("missing").alias("outcome"), F.lit(None).cast("string").alias("status"), "tasks"))


@register("mut_bulk_status", """SELECT status, COUNT(*) AS tasks, COUNT(*) FILTER (WHERE hit) AS changed FROM (
  SELECT o_custkey % 3 = 0 AND o_orderstatus <> 'F' AS hit,
         CASE WHEN o_custkey % 3 = 0 AND o_orderstatus <> 'F' THEN 'cancelled'
              WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'in_progress' END AS status FROM orders) GROUP BY status""")
def mut_bulk_status(spark, sf_dir):
    """MUT-07: cancel the open tasks of every third customer; completed ones stay."""
    orders = fixtures.read_table(spark, sf_dir, "orders")
    tasks = orders.select("o_custkey", fixtures._case(F.col("o_orderstatus"), fixtures.ORDER_STATUS).alias("status"), F.lit(0).cast("bigint").alias("updated_at"))
    out = mutate.bulk_set_status(tasks, F.col("o_custkey") % 3 == 0, "cancelled", F.lit(NOW_EPOCH).cast("bigint"))
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("tasks"), F.count_if(F.col("updated_at") == NOW_EPOCH).alias("changed"))


@register("mut_delete_completed", """SELECT CAST(o_custkey AS VARCHAR) AS user_id, COUNT(*) AS tasks FROM orders
  WHERE NOT (o_orderstatus = 'F' AND o_custkey % 2 = 0) GROUP BY 1""")
def mut_delete_completed(spark, sf_dir):
    """MUT-07: tasks left per user after even users' completed tasks are deleted."""
    orders = fixtures.read_table(spark, sf_dir, "orders")
    tasks = orders.select("o_custkey", fixtures._case(F.col("o_orderstatus"), fixtures.ORDER_STATUS).alias("status"))
    left = mutate.delete_completed(tasks, F.col("o_custkey") % 2 == 0)
    return left.groupBy(F.col("o_custkey").cast("string").alias("user_id")).agg(F.count(F.lit(1)).alias("tasks"))


SEEN_SQL = """seen AS (SELECT CAST(user_id * 40 AS VARCHAR) AS user_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ep, event_id FROM events),
known AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer)"""


@register("mut_create_users", f"""WITH {SEEN_SQL} SELECT user_id, 'seen' || MIN(ep) || '@example.com' AS email, MIN(ep) AS created_at, MIN(ep) AS updated_at
  FROM seen WHERE user_id NOT IN (SELECT user_id FROM known) GROUP BY user_id""")
def mut_create_users(spark, sf_dir):
    """MUT-02 / JOIN-05: users created at their first request; known customers are left."""
    users = fixtures.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    ep = F.unix_seconds("ts")
    seen = fixtures.read_table(spark, sf_dir, "events").select(
        (F.col("user_id") * 40).cast("string").alias("user_id"),
        F.concat(F.lit("seen"), ep.cast("string"), F.lit("@example.com")).alias("email"), F.lit("n").alias("name"), ep.alias("ts_epoch"))
    return mutate.create_users_if_absent(users, seen)[1].select("user_id", "email", "created_at", "updated_at")


@register("mut_user_updates", f"""WITH u AS (SELECT CAST(user_id * 3 AS VARCHAR) AS user_id, arg_max('new' || event_id, event_id) AS name
  FROM events WHERE event_type = 'signup' GROUP BY 1), c AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name FROM customer)
  SELECT c.user_id, COALESCE(u.name, c.name) AS name FROM c LEFT JOIN u ON c.user_id = u.user_id""")
def mut_user_updates(spark, sf_dir):
    """MUT-04: users after a batch of name updates, the last one of a user counts."""
    users = fixtures.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user_id"), F.col("c_name").alias("name"))
    ups = fixtures.read_table(spark, sf_dir, "events").filter(F.col("event_type") == "signup").select(
        (F.col("user_id") * 3).cast("string").alias("user_id"), F.concat(F.lit("new"), F.col("event_id").cast("string")).alias("name"),
        F.col("event_id").alias("seq"))
    return mutate.update_users(users, ups)[0]


@register("isolation_violations", """SELECT CAST(e.user_id AS VARCHAR) AS user_id, CAST(o.o_orderkey AS VARCHAR) AS task_id, e.event_id
  FROM events e JOIN orders o ON o.o_orderkey = e.event_id WHERE o.o_custkey <> e.user_id""")
def isolation_violations(spark, sf_dir):
    """JOIN-07: accesses to tasks that another user owns."""
    tasks = fixtures.read_table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").cast("string").alias("task_id"))
    accesses = fixtures.read_table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_id").cast("string").alias("task_id"), "event_id").filter("user_id is not null")
    return mutate.isolation_violations(accesses, tasks)


def _index_sql(column: str, value: str) -> str:
    return f"""WITH {TASK_VIEW} SELECT id, status, priority, category FROM tv
  WHERE user_id = '1' AND {column} = {value}"""


def _by_index(spark, sf_dir, find):
    return lookup.task_view(find(event_state(spark, sf_dir))).select("id", "status", "priority", "category")


@register("lookup_by_status", _index_sql("status", "'completed'"))
def lookup_by_status(spark, sf_dir):
    """FIL-08: a user's tasks of one status through the index keys."""
    return _by_index(spark, sf_dir, lambda st: lookup.tasks_by_status(st, "1", "completed"))


@register("lookup_by_due_date", _index_sql("due_date", "DATE '2024-01-13'"))
def lookup_by_due_date(spark, sf_dir):
    """FIL-09: a user's tasks due on one date."""
    return _by_index(spark, sf_dir, lambda st: lookup.tasks_by_due_date(st, "1", "2024-01-13"))


@register("lookup_by_priority", _index_sql("priority", "'high'"))
def lookup_by_priority(spark, sf_dir):
    """FIL-10: a user's tasks of one priority."""
    return _by_index(spark, sf_dir, lambda st: lookup.tasks_by_priority(st, "1", "high"))


@register("lookup_by_category", _index_sql("category", "'cat1'"))
def lookup_by_category(spark, sf_dir):
    """FIL-11: a user's tasks of one category."""
    return _by_index(spark, sf_dir, lambda st: lookup.tasks_by_category(st, "1", "cat1"))


@register("lookup_all_users", f"WITH {STATE} SELECT split_part(\"PK\", '#', 2) AS id, email, name, to_timestamp(created_at) AT TIME ZONE 'UTC' AS created_at "
          "FROM state WHERE \"PK\" LIKE 'USER#%'")
def lookup_all_users(spark, sf_dir):
    """FIL-15 / PRJ-12: every user item as a response row."""
    return lookup.user_view(lookup.all_users(event_state(spark, sf_dir))).select("id", "email", "name", "created_at")


def clicked_keys(spark, sf_dir):
    """(PK, SK) of the tasks that were clicked on, as often as they were."""
    events = fixtures.read_table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    slot = F.pmod(F.get_json_object("props", "$.k").try_cast("bigint"), F.lit(fixtures.TASKS_PER_USER))
    return events.select(F.concat(F.lit("TASK#"), F.col("user_id").cast("string")).alias("PK"),
                         F.concat(F.lit("TASK#"), (F.col("user_id") * 100 + slot).cast("string")).alias("SK"))


@register("lookup_items", f"""WITH {STATE}, wanted AS (SELECT DISTINCT 'TASK#' || user_id AS pk, 'TASK#' || (user_id * 100 + slot) AS sk FROM ev WHERE event_type = 'click')
  SELECT s."PK", s."SK", s.status FROM state s JOIN wanted w ON s."PK" = w.pk AND s."SK" = w.sk""")
def lookup_items(spark, sf_dir):
    """SRC-06: the items of a batch of keys."""
    return lookup.get_items(event_state(spark, sf_dir), clicked_keys(spark, sf_dir)).select("PK", "SK", "status")


@register("users_without_recent_orders", """SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')""")
def users_without_recent_orders(spark, sf_dir):
    """JOIN-02 / FIL-18 two-sided: only tasks from 2001 on count, so some users have none."""
    g = _recent_gold(spark, sf_dir)
    return g.user_analytics.join(g.user_metrics.select("user_id"), "user_id", "left_anti").select("user_id", "name")


@register("recent_user_productivity", """WITH t AS (SELECT o_custkey, COUNT(*) AS total_tasks, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS completed_tasks
  FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey)
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, COALESCE(total_tasks, 0) AS total_tasks, COALESCE(completed_tasks, 0) AS completed_tasks
  FROM customer LEFT JOIN t ON c_custkey = o_custkey""")
def recent_user_productivity(spark, sf_dir):
    """JOIN-01 two-sided: users without a task since 2001 count zero."""
    from .queries import q12_user_productivity
    return q12_user_productivity(_recent_gold(spark, sf_dir)).select("user_id", "total_tasks", "completed_tasks")


def _recent_gold(spark, sf_dir):
    customer, orders = (fixtures.read_table(spark, sf_dir, t) for t in ("customer", "orders"))
    users, _ = silver.silver_from_state(model._as_state(fixtures.customer_users(customer)))
    recent = orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp"))
    _, tasks = silver.silver_from_state(model._as_state(fixtures.order_tasks(recent, None)))
    return model.gold_from_silver(None, users, tasks)


@register("dq_order_rules", """WITH o AS (SELECT o_orderkey, o_orderpriority AS priority, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'T' || o_orderkey END AS title,
    o_totalprice AS amount, CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE 'u' || o_custkey || '@x.io' END AS email FROM orders)
  SELECT r.rule, CASE r.rule WHEN 'rows' THEN (SELECT COUNT(*) FROM o) WHEN 'required:title' THEN (SELECT COUNT(*) FROM o WHERE title IS NULL)
    WHEN 'type:title' THEN (SELECT COUNT(*) FROM o WHERE title IS NULL) WHEN 'max:amount' THEN (SELECT COUNT(*) FROM o WHERE NOT amount <= 200000)
    WHEN 'type:email' THEN (SELECT COUNT(*) FROM o) WHEN 'pattern:email' THEN (SELECT COUNT(*) FROM o WHERE email = 'n/a')
    WHEN 'max_len:title' THEN (SELECT COUNT(*) FROM o WHERE length(title) > 5) WHEN 'min:email' THEN (SELECT COUNT(*) FROM o)
    WHEN 'domain:priority' THEN (SELECT COUNT(*) FROM o WHERE priority NOT IN ('1-URGENT', '2-HIGH')) WHEN 'rejected_rows' THEN (SELECT COUNT(*) FROM o) END AS failures
  FROM (VALUES ('rows'), ('rejected_rows'), ('required:title'), ('type:title'), ('type:email'), ('max:amount'), ('min:email'), ('pattern:email'),
    ('max_len:title'), ('domain:priority')) r(rule)""")
def dq_order_rules(spark, sf_dir):
    """DQ-01..07, 09 with rules that fire: nulls, text where a number is due, a pattern, a length, a domain and bounds."""
    o = fixtures.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderkey") % 11 != 0, F.concat(F.lit("T"), F.col("o_orderkey").cast("string"))).alias("title"),
        F.when(F.col("o_orderkey") % 13 == 0, "n/a").otherwise(F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("@x.io"))).alias("email"))
    rules = quality.Rules(required_fields=["title"], data_types={"title": "string", "email": "int"},
                          constraints={"amount": {"max": 200000}, "email": {"min": 0, "pattern": quality.EMAIL_PATTERN[1:-1]},
                                       "title": {"max_len": 5}, "priority": {"in": ["1-URGENT", "2-HIGH"]}})
    return quality.rule_summary(o, rules)


@register("dq_freshness", """SELECT CAST(MAX(ts) AS TIMESTAMP) AS newest,
  CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(MAX(ts))) AS BIGINT) AS age_seconds FROM events""")
def dq_freshness(spark, sf_dir):
    """DQ-09: the newest event and its age."""
    return quality.freshness(fixtures.read_table(spark, sf_dir, "events"), "ts", _now())
