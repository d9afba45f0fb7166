"""Reports over measured query runs: counts, grades, health, tuning rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.columns import stable_round
from isobar.operators.windows import latest_per_key

# Grade factors, grade scores, health limits in seconds.
LOWER_FACTORS = (1.0, 1.5, 2.0)
HIGHER_FACTORS = (1.0, 0.75, 0.5)
GRADE_SCORES = {"excellent": 100, "good": 75, "fair": 50, "poor": 25}
HEALTH_LIMITS = (2.0, 4.0, 6.0)
HEALTH_LIMITS_BY_TYPE = {"partitioning": (0.5, 1.0, 2.0)}

# Tuning rules by kind of query, for Spark: (type, setting, value, reason).
RULES = [
    ("joins", "spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB", "Turns joins with a small measured side into map-side joins"),
    ("joins", "spark.sql.sources.bucketing.enabled", "true", "Joins of tables bucketed alike need no shuffle"),
    ("joins", "spark.sql.adaptive.skewJoin.enabled", "true", "Splits join partitions that hold a hot key"),
    ("aggregation", "spark.sql.execution.useObjectHashAggregateExec", "true", "Aggregates by hashing before rows are shuffled"),
    ("aggregation", "spark.sql.adaptive.coalescePartitions.enabled", "true", "Merges small shuffle partitions after partial aggregation"),
    ("aggregation", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB", "Sets the size shuffle partitions are merged or split to"),
    ("complex_types", "spark.sql.optimizer.enableJsonExpressionOptimization", "true", "Parses only the JSON fields a query reads"),
    ("complex_types", "spark.sql.optimizer.nestedSchemaPruning.enabled", "true", "Reads only the nested fields a query needs"),
    ("complex_types", "spark.sql.cbo.enabled", "true", "Uses table statistics to cost operations on complex columns"),
    ("io", "spark.sql.files.maxPartitionBytes", "256MB", "Larger splits read sequentially with less overhead per task"),
    ("io", "spark.local.dir", "fast local disks", "Puts shuffle and spill files on fast storage"),
    ("io", "spark.shuffle.compress", "true", "Compresses intermediate data between stages"),
    ("partitioning", "spark.sql.optimizer.dynamicPartitionPruning.enabled", "true", "Skips partitions found irrelevant at run time"),
    ("partitioning", "spark.sql.parquet.filterPushdown", "true", "Filters rows while files are read"),
    ("partitioning", "spark.sql.sources.partitionOverwriteMode", "dynamic", "Rewrites only the partitions a load touches"),
]
RULE_PRIORITY = "high"


def rules(spark: SparkSession) -> DataFrame:
    """The fixed rules; fifteen rows, so a join may broadcast them."""
    rows = spark.createDataFrame(
        RULES, "scenario_type string, setting string, value string, reason string"
    )
    return F.broadcast(rows.withColumn("priority", F.lit(RULE_PRIORITY)))


def _ok() -> Column:
    return F.col("status") == "success"


def run_counts(runs: DataFrame) -> DataFrame:
    return runs.agg(
        F.count("*").alias("total_runs"),
        F.count_if(_ok()).alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        stable_round(F.coalesce(F.avg(F.when(_ok(), F.col("seconds"))), F.lit(0.0)), 6).alias(
            "avg_seconds"
        ),
    )


def status_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n")).orderBy("status")


def avg_by_type(runs: DataFrame) -> DataFrame:
    return (
        runs.where(_ok())
        .groupBy("scenario_type")
        .agg(stable_round(F.avg("seconds"), 3).alias("avg_seconds"))
    )


def latest_success(runs: DataFrame) -> DataFrame:
    rows = latest_per_key(
        runs.where(_ok()), ["scenario_type"], [F.desc("executed_at"), F.desc("run_id")]
    )
    return rows.select("scenario_type", "run_id", "seconds", "executed_at")


def recent_runs(runs: DataFrame, last: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("executed_at"), F.desc("run_id")).limit(last)


def run_history(runs: DataFrame, last: int = 50) -> DataFrame:
    """The last runs by scenario: how many, and the mean time of the successes."""
    recent = recent_runs(runs, last)
    mean = F.coalesce(F.avg(F.when(_ok(), F.col("seconds"))), F.lit(0.0))
    return recent.groupBy("scenario").agg(
        F.count("*").alias("runs"), stable_round(mean, 6).alias("avg_seconds")
    )


def grade(value: Column, target: Column, direction: Column) -> Column:
    """excellent / good / fair / poor by the ratio to the target."""
    names = list(GRADE_SCORES)

    def chain(factors, passes) -> Column:
        out = F.lit(names[-1])
        for name, f in reversed(list(zip(names, factors))):
            out = F.when(passes(target * F.lit(f)), F.lit(name)).otherwise(out)
        return out

    lower = chain(LOWER_FACTORS, lambda limit: value <= limit)
    higher = chain(HIGHER_FACTORS, lambda limit: value >= limit)
    return F.when(direction == "lower", lower).otherwise(higher)


def grade_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("grade", grade(F.col("value"), F.col("target"), F.col("direction")))


def grade_counts(metrics: DataFrame) -> DataFrame:
    return grade_metrics(metrics).groupBy("grade").agg(F.count("*").alias("n"))


def health(
    runs: DataFrame, limits: Mapping[str, tuple[float, float, float]] = HEALTH_LIMITS_BY_TYPE
) -> DataFrame:
    """Mean measured time per type, its grade and score."""
    times = runs.where(_ok()).groupBy("scenario_type").agg(F.avg("seconds").alias("s"))

    def limit(i: int) -> Column:
        out = F.lit(HEALTH_LIMITS[i])
        for kind, values in limits.items():
            out = F.when(F.col("scenario_type") == kind, F.lit(values[i])).otherwise(out)
        return out

    status, score = F.lit("poor"), F.lit(GRADE_SCORES["poor"])
    for i, name in reversed(list(enumerate(["excellent", "good", "fair"]))):
        status = F.when(F.col("s") <= limit(i), F.lit(name)).otherwise(status)
        score = F.when(F.col("s") <= limit(i), F.lit(GRADE_SCORES[name])).otherwise(score)
    return times.select(
        "scenario_type",
        stable_round("s", 3).alias("seconds"),
        status.alias("status"),
        score.alias("score"),
    )


def health_score(runs: DataFrame) -> DataFrame:
    graded = health(runs)
    return graded.agg(
        F.round(F.avg("score"), 0).cast("int").alias("health_score"),
        F.count("*").alias("scenario_types"),
    )


def recommend(runs: DataFrame, rule_rows: DataFrame) -> DataFrame:
    """Tuning rules for every run, by the kind of its query."""
    return runs.join(rule_rows, "scenario_type").select(
        "run_id", "scenario", "scenario_type", "executed_at", "setting", "value", "reason", "priority"
    )


def recent_recommendations(runs: DataFrame, rule_rows: DataFrame, last: int = 20) -> DataFrame:
    """The newest recommendations. Every run has a rule, so `last` runs suffice for them."""
    order = [F.desc("executed_at"), F.desc("run_id")]
    known = runs.join(rule_rows.select("scenario_type"), "scenario_type", "left_semi")
    newest = known.orderBy(*order).limit(last)
    return recommend(newest, rule_rows).orderBy(*order, "setting").limit(last)


def run_detail(runs: DataFrame, metrics: DataFrame, rule_rows: DataFrame) -> DataFrame:
    """Every run with its graded metrics and its recommendations, one row each.

    Two joins stacked: metrics and rules of a run are never multiplied with
    each other, nor gathered into one row.
    """
    run = ["run_id", "scenario", "scenario_type", "seconds", "status"]
    measured_rows = runs.select(*run).join(grade_metrics(metrics), "run_id").select(
        *run,
        F.lit("metric").alias("kind"),
        F.col("name").alias("item"),
        "value",
        "target",
        F.col("grade").alias("note"),
    )
    advice = runs.select(*run).join(rule_rows, "scenario_type").select(
        *run,
        F.lit("recommendation").alias("kind"),
        F.col("setting").alias("item"),
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("double").alias("target"),
        F.col("value").alias("note"),
    )
    return measured_rows.unionByName(advice)
