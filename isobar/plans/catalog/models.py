"""The temperature model."""

from __future__ import annotations

from isobar.operators import model
from isobar.plans.adapter import DAY_ORDER, r, with_views
from isobar.plans.catalog.base import query, rounded

FEATURE_SQL = """
  SELECT k1, k2, k3, station_id, observation_date, month,
         sin(2 * pi() * month / 12) AS x1, cos(2 * pi() * month / 12) AS x2,
         humidity AS x3, precipitation AS x4, temp_mean AS y
  FROM fact WHERE temp_mean IS NOT NULL AND humidity IS NOT NULL AND precipitation IS NOT NULL"""


def least_squares(source: str) -> str:
    """CTEs that fit y on x1..x4 of `source` by successive orthogonalization."""
    xs = [f"x{i}" for i in range(1, 5)]
    centred = ", ".join(f"{c} - (SELECT avg({c}) FROM {source}) AS {c}" for c in [*xs, "y"])
    ctes = [f"z0 AS (SELECT {centred} FROM {source})"]
    for i, x in enumerate(xs):
        less = "".join(
            f" - z{j} * (SELECT sum(z{j} * {x}) / sum(z{j} * z{j}) FROM z{i})" for j in range(1, i + 1)
        )
        ctes.append(f"z{i + 1} AS (SELECT *, {x}{less} AS z{i + 1} FROM z{i})")
    dots = []
    for i in range(1, 5):
        dots += [f"sum(z{i} * z{i}) AS d{i}", f"sum(z{i} * y) AS y{i}"]
        dots += [f"sum(z{i} * x{j}) AS p{i}{j}" for j in range(i + 1, 5)]
    ctes.append(f"dots AS (SELECT {', '.join(dots)} FROM z4)")
    ctes.append("b_4 AS (SELECT *, y4 / d4 AS b4 FROM dots)")
    ctes.append("b_3 AS (SELECT *, (y3 - b4 * p34) / d3 AS b3 FROM b_4)")
    ctes.append("b_2 AS (SELECT *, (y2 - b3 * p23 - b4 * p24) / d2 AS b2 FROM b_3)")
    ctes.append("b_1 AS (SELECT *, (y1 - b2 * p12 - b3 * p13 - b4 * p14) / d1 AS b1 FROM b_2)")
    means = ", ".join(f"avg({c}) AS m_{c}" for c in [*xs, "y"])
    ctes.append(
        "beta AS (SELECT b1, b2, b3, b4, m_y - b1 * m_x1 - b2 * m_x2 - b3 * m_x3 - b4 * m_x4 AS b0, "
        f"m_x3, m_x4 FROM b_1, (SELECT {means} FROM {source}))"
    )
    return ", ".join(ctes)


ALL_ROWS = f"WITH d AS ({FEATURE_SQL}), {least_squares('d')}"
TERMS = "[('intercept', b0), ('month_sin', b1), ('month_cos', b2), ('humidity', b3), ('precipitation', b4)]"
PREDICTION = "b0 + b1 * x1 + b2 * x2 + b3 * x3 + b4 * x4"


@query(
    "ml_features",
    with_views(
        "fact",
        f"SELECT k1, k2, k3, station_id, {r('x1', 9)} AS month_sin, {r('x2', 9)} AS month_cos, x3 AS humidity, "
        f"x4 AS precipitation, y AS temp_mean FROM ({FEATURE_SQL})",
    ),
)
def ml_features(t):
    rows = model.features(t.fact, ["k1", "k2", "k3", "station_id"])
    return rounded(rows, 9, "month_sin", "month_cos")


MOMENT_COLUMNS = ["month_sin", "month_cos", "humidity", "precipitation", "temp_mean"]
_X = dict(zip(MOMENT_COLUMNS, ["x1", "x2", "x3", "x4", "y"]))
_MOMENTS = [f"{r(f'avg({_X[c]})', 6)} AS mean_{c}" for c in MOMENT_COLUMNS] + [
    f"{r(f'covar_pop({_X[a]}, {_X[b]})', 6)} AS cov_{a}__{b}"
    for i, a in enumerate(MOMENT_COLUMNS)
    for b in MOMENT_COLUMNS[i:]
]


@query("ml_sums", with_views("fact", f"SELECT count(*) AS n, {', '.join(_MOMENTS)} FROM ({FEATURE_SQL})"))
def ml_sums(t):
    """The one-row summary the fit needs."""
    out = model.moments(model.features(t.fact))
    return rounded(out, 6, *[c for c in out.columns if c != "n"])


@query(
    "ml_fit",
    with_views(
        "fact",
        f"{ALL_ROWS} SELECT unnest.term AS term, {r('unnest.value', 6)} AS value FROM "
        "(SELECT unnest([" + ", ".join(
            f"{{'term': '{n}', 'value': {b}}}"
            for n, b in zip(["intercept", *model.FEATURES], ["b0", "b1", "b2", "b3", "b4"])
        ) + "]) AS unnest FROM beta)",
    ),
)
def ml_fit(t):
    fitted = model.fit(model.features(t.fact))
    return rounded(model.coefficients(t.spark, fitted), 6, "value")


@query(
    "ml_predict",
    with_views("fact", f"{ALL_ROWS} SELECT k1, k2, k3, station_id, {r(PREDICTION, 6)} AS prediction FROM d, beta"),
)
def ml_predict(t):
    data = model.features(t.fact, ["k1", "k2", "k3", "station_id"])
    rows = model.predict(data, model.fit(data)).select("k1", "k2", "k3", "station_id", "prediction")
    return rounded(rows, 6, "prediction")


METRICS_SQL = (
    f"{r('sqrt(avg(e * e))', 3)} AS rmse, {r('avg(abs(e))', 3)} AS mae, "
    f"{r('1 - avg(e * e) / var_pop(y)', 3)} AS r2"
)


@query(
    "ml_metrics",
    with_views("fact", f"{ALL_ROWS} SELECT {METRICS_SQL} FROM (SELECT y, y - ({PREDICTION}) AS e FROM d, beta)"),
)
def ml_metrics(t):
    data = model.features(t.fact)
    return model.metrics(data, model.fit(data))


@query(
    "ml_importance",
    with_views(
        "fact",
        f"{ALL_ROWS}, parts AS ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS feature, b{i} AS b, abs(b1) + abs(b2) + abs(b3) + abs(b4) AS s FROM beta"
            for i, n in enumerate(model.FEATURES, 1)
        )
        + f") SELECT feature, {r('b', 4)} AS coefficient, {r('abs(b) / s * 100', 1)} AS importance FROM parts",
    ),
)
def ml_importance(t):
    return model.importance(t.spark, model.fit(model.features(t.fact)))


NUMBERED = (
    f"WITH d AS ({FEATURE_SQL}), numbered AS (SELECT *, row_number() OVER (ORDER BY observation_date DESC, station_id, k1, k2, k3) "
    "<= (SELECT floor(count(*) * CAST(0.8 AS DOUBLE)) FROM d) AS is_train FROM d), "
    "train AS (SELECT * FROM numbered WHERE is_train), test AS (SELECT * FROM numbered WHERE NOT is_train)"
)
EVALUATED = f"{NUMBERED}, {least_squares('train')}"


@query(
    "ml_train_eval",
    with_views(
        "fact",
        f"""{EVALUATED} SELECT 'trained' AS status, (SELECT count(*) FROM train) AS train_size,
         (SELECT count(*) FROM test) AS test_size, {METRICS_SQL}
  FROM (SELECT y, y - ({PREDICTION}) AS e FROM test, beta)""",
    ),
)
def ml_train_eval(t):
    return model.train_and_evaluate(t.fact, DAY_ORDER).summary


@query(
    "ml_sample",
    with_views(
        "fact",
        f"""{EVALUATED} SELECT observation_date, station_id, k1, k2, k3, {r('y', 2)} AS actual, {r(PREDICTION, 2)} AS predicted
  FROM test, beta ORDER BY observation_date DESC, station_id, k1, k2, k3 LIMIT 50""",
    ),
)
def ml_sample(t):
    """Fifty pairs of the test side, for plotting."""
    return model.train_and_evaluate(t.fact, DAY_ORDER).sample


MONTHS_SQL = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][month] AS month_name"


@query(
    "ml_monthly",
    with_views(
        "fact",
        f"""{ALL_ROWS}, p AS (SELECT CAST(m AS INT) AS month, b0 + b1 * sin(2 * pi() * m / 12) + b2 * cos(2 * pi() * m / 12)
                                     + b3 * m_x3 + b4 * m_x4 AS predicted FROM beta, range(1, 13) t(m)),
       a AS (SELECT month, avg(temp_mean) AS actual FROM fact WHERE temp_mean IS NOT NULL GROUP BY month)
  SELECT p.month, {MONTHS_SQL.replace('[month]', '[p.month]')}, {r('predicted', 1)} AS predicted, {r('coalesce(actual, predicted)', 1)} AS actual
  FROM p LEFT JOIN a ON p.month = a.month""",
    ),
)
def ml_monthly(t):
    return model.monthly_predictions(t.fact)
