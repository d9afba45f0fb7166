"""The temperature model against NumPy, and the reports over runs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import assess, model
from isobar.sources import generate


@pytest.fixture(scope="module")
def obs(spark):
    return generate.gen_obs(generate.gen_stations(generate.ids(spark, 40)), 50).cache()


def arrays(obs):
    data = model.features(obs).toPandas()
    return data[model.FEATURES].to_numpy(), data["temp_mean"].to_numpy()


def test_fit_is_least_squares(obs):
    x, y = arrays(obs)
    beta, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)
    got = model.fit(model.features(obs))
    assert [got.intercept, *got.coefficients] == pytest.approx(list(beta), rel=1e-9, abs=1e-10)


def test_metrics(obs):
    x, y = arrays(obs)
    fitted = model.fit(model.features(obs))
    p = fitted.intercept + x @ np.array(fitted.coefficients)
    got = model.metrics(model.features(obs), fitted).first()
    assert got.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)), abs=6e-4)
    assert got.mae == pytest.approx(np.mean(np.abs(y - p)), abs=6e-4)
    assert got.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2), abs=6e-4)


def small(spark, rows):
    return spark.createDataFrame(
        rows, "month int, humidity double, precipitation double, temp_mean double"
    )


def test_exact_line(spark):
    rows = [(1 + i % 12, float(i % 7), float(i % 5), 3.0 + 2.0 * (i % 7) - 0.5 * (i % 5)) for i in range(120)]
    data = model.features(small(spark, rows))
    fitted = model.fit(data)
    assert fitted.coefficients == pytest.approx([0, 0, 2.0, -0.5], abs=1e-9)
    assert tuple(model.metrics(data, fitted).first()) == (0.0, 0.0, 1.0)


def test_constant_input_falls_back_to_the_mean(spark):
    data = model.features(small(spark, [(1 + i % 12, 50.0, float(i % 5), float(i)) for i in range(30)]))
    fitted = model.fit(data)
    assert fitted.coefficients == [0.0] * 4 and fitted.intercept == pytest.approx(14.5)
    assert model.importance(spark, fitted).count() == 0


def test_constant_label(spark):
    data = model.features(small(spark, [(1 + i % 12, float(i % 7), float(i % 5), 8.0) for i in range(60)]))
    assert tuple(model.metrics(data, model.fit(data)).first()) == (0.0, 0.0, 0.0)


def test_unfitted_model(spark):
    none = model.fit(model.features(small(spark, [])))
    data = model.features(small(spark, [(1, 1.0, 1.0, 5.0)]))
    assert model.predict(data, none).first().prediction == 0.0
    assert tuple(model.metrics(data, none).first()) == (0.0, 0.0, 0.0)
    assert model.coefficients(spark, none).count() == 0


def test_importance_sums_to_a_hundred(spark, obs):
    got = model.importance(spark, model.fit(model.features(obs))).collect()
    assert sum(r.importance for r in got) == pytest.approx(100, abs=0.3)
    assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)


def test_train_and_evaluate(obs):
    done = model.train_and_evaluate(obs, ["station_id"])
    s = done.summary.first()
    assert (s.status, s.train_size, s.test_size) == ("trained", 1600, 400)
    assert done.sample.count() == 50
    data = model.features(obs, ["observation_date", "station_id"]).toPandas()
    data = data.sort_values(["observation_date", "station_id"], ascending=[False, True])
    train = data.head(1600)
    x = np.column_stack([np.ones(1600), train[model.FEATURES].to_numpy()])
    beta, *_ = np.linalg.lstsq(x, train["temp_mean"].to_numpy(), rcond=None)
    assert done.model.coefficients == pytest.approx(list(beta[1:]), rel=1e-8, abs=1e-9)


def test_too_few_rows(obs):
    done = model.train_and_evaluate(obs.limit(9), ["station_id"])
    s = done.summary.first()
    assert s.status == "no_data" and (s.rmse, s.mae, s.r2) == (0.0, 0.0, 0.0)
    assert model.monthly_predictions(obs.limit(9)).count() == 0


def test_monthly_predictions_fill_missing_months(obs):
    got = model.monthly_predictions(obs.where("month <> 3")).collect()
    assert [r.month for r in got] == list(range(1, 13))
    assert got[2].actual == got[2].predicted


@pytest.mark.parametrize(
    "value,direction,want",
    [
        (100.0, "lower", "excellent"), (100.1, "lower", "good"), (150.0, "lower", "good"),
        (150.1, "lower", "fair"), (200.0, "lower", "fair"), (200.1, "lower", "poor"),
        (100.0, "higher", "excellent"), (99.9, "higher", "good"), (75.0, "higher", "good"),
        (74.9, "higher", "fair"), (50.0, "higher", "fair"), (49.9, "higher", "poor"),
    ],
)
def test_grades(spark, value, direction, want):
    df = spark.createDataFrame([(value, 100.0, direction)], "value double, target double, direction string")
    assert assess.grade_metrics(df).first().grade == want


def runs(spark):
    at = dt.datetime(2024, 1, 1)
    data = [
        (1, "s1", "joins", 1.0, "success", at),
        (2, "s1", "joins", 2.0, "failed", at + dt.timedelta(hours=1)),
        (3, "s2", "partitioning", 1.5, "success", at + dt.timedelta(hours=2)),
        (4, "s2", "partitioning", 9.0, "timeout", at + dt.timedelta(hours=3)),
        (5, "s3", "other", 5.0, "success", at + dt.timedelta(hours=4)),
    ]
    return spark.createDataFrame(
        data, "run_id long, scenario string, scenario_type string, seconds double, status string, executed_at timestamp"
    )


def test_run_counts(spark):
    assert tuple(assess.run_counts(runs(spark)).first()) == (5, 3, 1, 2.5)
    assert tuple(assess.run_counts(runs(spark).where("false")).first()) == (0, 0, 0, 0.0)


def test_health(spark):
    got = {r.scenario_type: r.status for r in assess.health(runs(spark)).collect()}
    assert got == {"joins": "excellent", "partitioning": "fair", "other": "fair"}
    assert assess.health_score(runs(spark)).first().health_score == 67


def test_latest_success_and_history(spark):
    got = {r.scenario_type: r.run_id for r in assess.latest_success(runs(spark)).collect()}
    assert got == {"joins": 1, "partitioning": 3, "other": 5}
    history = {r.scenario: (r.runs, r.avg_seconds) for r in assess.run_history(runs(spark), 4).collect()}
    assert history == {"s1": (1, 0.0), "s2": (2, 1.5), "s3": (1, 5.0)}


def test_recommendations(spark):
    rules = assess.rules(spark)
    assert assess.recommend(runs(spark), rules).count() == 4 * 3
    recent = assess.recent_recommendations(runs(spark), rules, 4).collect()
    # Runs without a rule do not use up the list.
    assert [r.run_id for r in recent] == [4, 4, 4, 3]


def test_run_detail_does_not_multiply(spark):
    metrics = runs(spark).select(
        "run_id", F.lit("m").alias("name"), "seconds", F.lit("s").alias("unit")
    ).selectExpr("run_id", "name", "seconds AS value", "unit", "2D AS target", "'lower' AS direction")
    got = assess.run_detail(runs(spark), metrics, assess.rules(spark))
    assert got.where("run_id = 1").count() == 4
    assert got.where("run_id = 5").count() == 1
