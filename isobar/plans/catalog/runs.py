"""Reports over query runs."""

from __future__ import annotations

from isobar.operators import assess
from isobar.plans.adapter import r, with_views
from isobar.plans.catalog.base import query
from isobar.plans.catalog.joins import RULES_SQL

OK = "status = 'success'"


@query(
    "run_counts",
    with_views(
        "runs",
        f"SELECT count(*) AS total_runs, count(*) FILTER ({OK}) AS successful_runs, "
        f"count(*) FILTER (status = 'failed') AS failed_runs, {r(f'avg(seconds) FILTER ({OK})', 6)} AS avg_seconds FROM runs",
    ),
)
def run_counts(t):
    return assess.run_counts(t.runs)


@query("status_counts", with_views("runs", "SELECT status, count(*) AS n FROM runs GROUP BY status"))
def status_counts(t):
    return assess.status_counts(t.runs)


@query(
    "avg_by_type",
    with_views("runs", f"SELECT scenario_type, {r('avg(seconds)', 3)} AS avg_seconds FROM runs WHERE {OK} GROUP BY scenario_type"),
)
def avg_by_type(t):
    return assess.avg_by_type(t.runs)


@query(
    "latest_success",
    with_views(
        "runs",
        f"SELECT scenario_type, run_id, seconds, executed_at FROM runs WHERE {OK} "
        "QUALIFY row_number() OVER (PARTITION BY scenario_type ORDER BY executed_at DESC, run_id DESC) = 1",
    ),
)
def latest_success(t):
    return assess.latest_success(t.runs)


@query(
    "run_history",
    with_views(
        "runs",
        f"SELECT scenario, count(*) AS runs, {r(f'coalesce(avg(seconds) FILTER ({OK}), 0)', 6)} AS avg_seconds "
        "FROM (SELECT * FROM runs ORDER BY executed_at DESC, run_id DESC LIMIT 50) GROUP BY scenario",
    ),
)
def run_history(t):
    return assess.run_history(t.runs)


GRADE_SQL = """CASE WHEN direction = 'lower' THEN
         CASE WHEN value <= target THEN 'excellent' WHEN value <= target * 1.5 THEN 'good'
              WHEN value <= target * 2 THEN 'fair' ELSE 'poor' END
       ELSE CASE WHEN value >= target THEN 'excellent' WHEN value >= target * 0.75 THEN 'good'
              WHEN value >= target * 0.5 THEN 'fair' ELSE 'poor' END END AS grade"""


@query(
    "grade_metrics",
    with_views("metrics", f"SELECT run_id, name, value, target, direction, {GRADE_SQL} FROM metrics"),
)
def grade_metrics(t):
    return assess.grade_metrics(t.metrics).drop("unit")


@query(
    "metric_grades",
    with_views("metrics", f"SELECT grade, count(*) AS n FROM (SELECT {GRADE_SQL} FROM metrics) GROUP BY grade"),
)
def metric_grades(t):
    return assess.grade_counts(t.metrics)


@query(
    "recent_runs",
    with_views("runs", "SELECT * FROM runs ORDER BY executed_at DESC, run_id DESC LIMIT 10"),
)
def recent_runs(t):
    return assess.recent_runs(t.runs, 10)


HEALTH_SQL = """health AS (
    SELECT scenario_type, CASE WHEN s <= f * 2 THEN 'excellent' WHEN s <= f * 4 THEN 'good'
                               WHEN s <= g THEN 'fair' ELSE 'poor' END AS status, s
    FROM (SELECT scenario_type, avg(seconds) AS s, CASE WHEN scenario_type = 'partitioning' THEN 0.25 ELSE 1 END AS f,
                 CASE WHEN scenario_type = 'partitioning' THEN 2 ELSE 6 END AS g
          FROM runs WHERE status = 'success' GROUP BY scenario_type)),
  scored AS (SELECT *, CASE status WHEN 'excellent' THEN 100 WHEN 'good' THEN 75 WHEN 'fair' THEN 50 ELSE 25 END AS score FROM health)"""


@query(
    "health_by_type",
    with_views("runs", f"WITH {HEALTH_SQL} SELECT scenario_type, {r('s', 3)} AS seconds, status, CAST(score AS INT) AS score FROM scored"),
)
def health_by_type(t):
    return assess.health(t.runs)


@query(
    "health_score",
    with_views("runs", f"WITH {HEALTH_SQL} SELECT CAST(round(avg(score)) AS INT) AS health_score, count(*) AS scenario_types FROM scored"),
)
def health_score(t):
    return assess.health_score(t.runs)


@query(
    "recent_recs",
    with_views(
        "runs",
        f"WITH {RULES_SQL} SELECT run_id, scenario, scenario_type, executed_at, setting, value, reason, priority "
        "FROM runs JOIN rules USING (scenario_type) ORDER BY executed_at DESC, run_id DESC, setting LIMIT 20",
    ),
)
def recent_recs(t):
    return assess.recent_recommendations(t.runs, assess.rules(t.spark))


@query(
    "run_detail",
    with_views(
        "metrics",
        f"""WITH {RULES_SQL}
  SELECT run_id, scenario, scenario_type, seconds, status, 'metric' AS kind, name AS item, value, target, grade AS note
  FROM runs JOIN (SELECT *, {GRADE_SQL} FROM metrics) USING (run_id)
  UNION ALL
  SELECT run_id, scenario, scenario_type, seconds, status, 'recommendation', setting, NULL, NULL, value
  FROM runs JOIN rules USING (scenario_type)""",
    ),
)
def run_detail(t):
    return assess.run_detail(t.runs, t.metrics, assess.rules(t.spark))
