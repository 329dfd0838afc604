"""Registered queries: regression (prepare, split, scale, fit, evaluate, persist) and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import config
from hearth.operators import regression as R
from hearth.operators import scoring as SC
from hearth.operators.features import all_features
from hearth.plans import sqltext as S
from hearth.plans.registry import register
from hearth.plans.views import district_inputs, housing
from hearth.session import materialise, scratch_path
from hearth.sources.fixtures import districts

T = config.TARGET
FEATS = list(config.FEATURE_COLUMNS)
SPLIT = "substr(md5(CAST(district_id AS VARCHAR) || ':42'), 1, 8) < '33333333'"

PREPARED_CTES = f"""bed AS (SELECT {S.midpoint('xs')} AS m FROM (SELECT {S.sorted_list('total_bedrooms')} AS xs FROM housing)),
prepared AS (SELECT district_id, {', '.join('COALESCE(total_bedrooms, bed.m) AS total_bedrooms' if c == 'total_bedrooms' else c for c in FEATS)}, {T},
                    {SPLIT} AS is_test
             FROM housing, bed WHERE {T} IS NOT NULL),
train AS (SELECT * FROM prepared WHERE NOT is_test),
test AS (SELECT * FROM prepared WHERE is_test),
fit1 AS (SELECT ROUND(REGR_SLOPE({T}, median_income), 4) AS b, ROUND(REGR_INTERCEPT({T}, median_income), 4) AS a FROM train),
pred1 AS (SELECT district_id, {T}, a + b * median_income AS prediction FROM test, fit1)"""


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.prepare_features(housing(spark, sf_dir))[0]


def simple_model(train: DataFrame) -> tuple[float, float]:
    """(slope, intercept) of the one-feature (median_income) OLS, reported at 4 decimals:
    the fixed coefficients every scoring query below uses (so any engine
    computes identical predictions from them)."""
    fit = R.simple_fit(train, "median_income").first()
    return round(fit["slope"], 4), round(fit["intercept"], 4)


def simple_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-row predictions of the one-feature model fitted on the train rows."""
    train, test = R.train_test_split(prepared(spark, sf_dir))
    return simple_predicted(test, *simple_model(train))


def simple_predicted(test: DataFrame, slope: float, intercept: float) -> DataFrame:
    pred = R.linear_prediction_column({"median_income": slope}, intercept)
    return test.select("district_id", T, pred.alias("prediction"))


def _round(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("prepare_features", S.on_housing(f"SELECT district_id, {', '.join(FEATS)}, {T} FROM prepared", PREPARED_CTES))
def q_prepare_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir)


@register("train_test_split", S.on_housing("SELECT district_id, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split FROM prepared", PREPARED_CTES))
def q_train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = prepared(spark, sf_dir)
    return p.select("district_id", F.when(R.split_flag(), F.lit("test")).otherwise(F.lit("train")).alias("split"))


@register(
    "train_test_split_exact",
    S.on_housing(
        "SELECT district_id, CASE WHEN r <= (n + 4) // 5 THEN 'test' ELSE 'train' END AS split FROM (SELECT district_id, COUNT(*) OVER () AS n, "
        "row_number() OVER (ORDER BY md5(CAST(district_id AS VARCHAR) || ':42'), district_id) AS r FROM prepared)",
        PREPARED_CTES,
    ),
)
def q_train_test_split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split whose test part has exactly a fifth of the rows, rounded up."""
    train, test = R.exact_split(materialise(spark, prepared(spark, sf_dir).select("district_id"), "split-keys"))
    return test.select("district_id", F.lit("test").alias("split")).unionByName(train.select("district_id", F.lit("train").alias("split")))


_ST = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in FEATS)


@register(
    "standardize",
    S.on_housing(
        "SELECT district_id, "
        + ", ".join(f"ROUND(({c} - m_{c}) / COALESCE(NULLIF(s_{c}, 0), 1), 6) AS {c}" for c in FEATS)
        + f", {T} FROM test, st",
        PREPARED_CTES + f",\nst AS (SELECT {_ST} FROM train)",
    ),
)
def q_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = R.train_test_split(prepared(spark, sf_dir))
    return _round(R.standardize(train, test, FEATS), FEATS)


@register(
    "ols_simple",
    S.on_housing(
        f"SELECT ROUND(REGR_SLOPE({T}, median_income), 6) AS slope, ROUND(REGR_INTERCEPT({T}, median_income), 6) AS intercept, "
        f"ROUND(REGR_R2({T}, median_income), 6) AS r2, CAST(REGR_COUNT({T}, median_income) AS BIGINT) AS n FROM train",
        PREPARED_CTES,
    ),
)
def q_ols_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = R.train_test_split(prepared(spark, sf_dir))
    return _round(R.simple_fit(train, "median_income"), ["slope", "intercept", "r2"])


@register(
    "evaluate_metrics",
    S.on_housing(
        f"""SELECT ROUND(SQRT(AVG(e * e)), 6) AS rmse, ROUND(AVG(ABS(e)), 6) AS mae,
       ROUND(1 - AVG(e * e) / NULLIF(VAR_POP(y), 0), 6) AS r2, COUNT(*) AS n
FROM (SELECT {T} - prediction AS e, {T} AS y FROM pred1)""",
        PREPARED_CTES,
    ),
)
def q_evaluate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(R.evaluate_metrics(simple_predictions(spark, sf_dir)), ["rmse", "mae", "r2"])


@register(
    "prediction_pairs",
    S.on_housing(
        f"SELECT district_id, ROUND({T}, 4) AS actual, ROUND(prediction, 4) AS predicted, ROUND({T} - prediction, 4) AS residual FROM pred1",
        PREPARED_CTES,
    ),
)
def q_prediction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(R.residuals(simple_predictions(spark, sf_dir)), ["actual", "predicted", "residual"], 4)


def _resid_hist_sql() -> str:
    from hearth.plans.q_stats import histogram_sql

    ctes, select = histogram_sql("res", "residual", 50, 4)
    return S.on_housing(select, PREPARED_CTES + f",\nres AS (SELECT {T} - prediction AS residual FROM pred1),\n" + ctes)


@register("residual_histogram", _resid_hist_sql())
def q_residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(R.residual_histogram(simple_predictions(spark, sf_dir), 50), ["bin_lo", "bin_hi"], 4)


@register(
    "prediction_bounds",
    S.on_housing(f"SELECT LEAST(MIN({T}), MIN(prediction)) AS lo, GREATEST(MAX({T}), MAX(prediction)) AS hi FROM pred1", PREPARED_CTES),
)
def q_prediction_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The common range of actual and predicted values (the diagonal of the pairs view)."""
    return R.prediction_bounds(simple_predictions(spark, sf_dir))


def _resid_grid_sql(bins: int = 50) -> str:
    from hearth.plans.q_stats import bin_sql

    r = (
        "r AS (SELECT CASE WHEN MIN(predicted) = MAX(predicted) THEN MIN(predicted) - 0.5 ELSE MIN(predicted) END AS xlo, "
        "CASE WHEN MIN(predicted) = MAX(predicted) THEN MAX(predicted) + 0.5 ELSE MAX(predicted) END AS xhi, "
        "CASE WHEN MIN(residual) = MAX(residual) THEN MIN(residual) - 0.5 ELSE MIN(residual) END AS ylo, "
        "CASE WHEN MIN(residual) = MAX(residual) THEN MAX(residual) + 0.5 ELSE MAX(residual) END AS yhi FROM res)"
    )
    return S.on_housing(
        f"SELECT {bin_sql('predicted', 'r.xlo', 'r.xhi', bins)} AS x_bin, {bin_sql('residual', 'r.ylo', 'r.yhi', bins)} AS y_bin, "
        "COUNT(*) AS \"count\" FROM res, r GROUP BY 1, 2",
        PREPARED_CTES + f",\nres AS (SELECT prediction AS predicted, {T} - prediction AS residual FROM pred1),\n" + r,
    )


@register("residual_grid", _resid_grid_sql(50))
def q_residual_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(predicted, residual) pairs of the test rows as a 50 × 50 grid."""
    return R.residual_grid(simple_predictions(spark, sf_dir), 50)


# --- Spark ML pipeline: SQL solves the same normal equations by Gauss-Jordan steps ---


def normal_equations_ctes(source: str = "train") -> str:
    """CTEs that solve for the standardised coefficients: ``beta`` holds the list b, ``lin`` also means, deviations and sizes."""
    p = len(FEATS)
    z = ", ".join(f"(t.{c} - m_{c}) / COALESCE(NULLIF(s_{c}, 0), 1)" for c in FEATS)
    gram = ", ".join("[" + ", ".join([f"AVG(x[{i}] * x[{j}])" for j in range(1, p + 1)] + [f"AVG(x[{i}] * y)"]) + "]" for i in range(1, p + 1))
    ctes = [
        f"mst AS (SELECT {_ST}, AVG({T}) AS my, COUNT(*) AS n FROM {source})",
        f"mz AS (SELECT [{z}] AS x, {T} - my AS y FROM {source} t, mst)",
        f"g0 AS (SELECT [{gram}] AS g FROM mz)",
    ]
    for k in range(1, p + 1):
        ctes.append(
            f"g{k} AS (SELECT list_transform(range(1, {p + 1}), lambda i: list_transform(range(1, {p + 2}), lambda j: "
            f"CASE WHEN i = {k} THEN g[{k}][j] / g[{k}][{k}] ELSE g[i][j] - g[i][{k}] * g[{k}][j] / g[{k}][{k}] END)) AS g FROM g{k - 1})"
        )
    ctes.append(f"beta AS (SELECT list_transform(g, lambda r: r[{p + 1}]) AS b FROM g{p})")
    return ",\n".join(ctes)


def linear_sql(alias: str = "t") -> str:
    return "my + " + " + ".join(f"b[{i}] * ({alias}.{c} - m_{c}) / COALESCE(NULLIF(s_{c}, 0), 1)" for i, c in enumerate(FEATS, 1))


MODEL_CTES = PREPARED_CTES + ",\n" + normal_equations_ctes()


def _fitted(spark: SparkSession, sf_dir: str):
    train, test = R.train_test_split(prepared(spark, sf_dir))
    model = R.fit_ols(train, FEATS)
    return model, train, test


def _score_all(spark: SparkSession, sf_dir: str, features: list[str]) -> DataFrame:
    """All districts scored by the pipeline fitted on the train rows, from one copy of the districts."""
    rows, fill = district_inputs(spark, sf_dir)
    train, _ = R.train_test_split(R.prepare_features(all_features(rows, fill=fill))[0])
    return SC.score_batch(R.fit_ols(train, features), rows, fill).select("district_id", "prediction", "violation")


@register(
    "ols_fit",
    S.on_housing(
        f"""SELECT CAST(ANY_VALUE(n) AS BIGINT) AS n_train, ROUND(ANY_VALUE(r2), 6) AS r2_train, ROUND(ANY_VALUE(a), 1) AS intercept,
       ROUND(SQRT(AVG(e * e)), 3) AS rmse_test, ROUND(AVG(ABS(e)), 3) AS mae_test, ROUND(1 - AVG(e * e) / VAR_POP(y), 6) AS r2_test
FROM (SELECT t.{T} AS y, t.{T} - ({linear_sql()}) AS e FROM test t, mst, beta),
     (SELECT 1 - AVG(e * e) / VAR_POP(y) AS r2 FROM (SELECT t.{T} AS y, t.{T} - ({linear_sql()}) AS e FROM train t, mst, beta)),
     (SELECT n, my AS a FROM mst)""",
        MODEL_CTES,
    ),
)
def q_ols_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: training size and R², intercept, and test metrics of the 11-feature fit."""
    model, train, test = _fitted(spark, sf_dir)
    lr = model.stages[-1]
    metrics = R.evaluate_metrics(R.predictions(model, test))
    return metrics.select(
        F.lit(int(lr.summary.numInstances)).cast("bigint").alias("n_train"),
        F.round(F.lit(float(lr.summary.r2)), 6).alias("r2_train"),
        F.round(F.lit(float(lr.intercept)), 1).alias("intercept"),
        F.round("rmse", 3).alias("rmse_test"),
        F.round("mae", 3).alias("mae_test"),
        F.round("r2", 6).alias("r2_test"),
    )


@register(
    "feature_importance",
    S.on_housing(
        f"SELECT feature, ROUND(c, 2) AS coefficient, ROUND(ABS(c), 2) AS abs_coefficient FROM (SELECT unnest({FEATS}) AS feature, unnest(b) AS c FROM beta)",
        MODEL_CTES,
    ),
)
def q_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, train, _ = _fitted(spark, sf_dir)
    return _round(R.feature_importance(model, FEATS, int(model.stages[-1].summary.numInstances)), ["coefficient", "abs_coefficient"], 2)


@register("model_roundtrip", S.on_housing(f"SELECT t.district_id, t.{T}, ROUND({linear_sql()}, 1) AS prediction FROM test t, mst, beta", MODEL_CTES))
def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save (Spark ML format + metrics JSON), load, and score the test rows."""
    model, _, test = _fitted(spark, sf_dir)
    m = R.evaluate_metrics(R.predictions(model, test)).first().asDict()
    path = R.save_model(model, FEATS, {k: m[k] for k in ("rmse", "r2", "mae")}, scratch_path(spark, "models"))
    loaded, feats, _ = R.load_model(path)
    return _round(R.predictions(loaded, test.select("district_id", T, *feats)), ["prediction"], 1)


_M = config.INPUT_RULE_MESSAGES


def violation_sql() -> str:
    missing = "concat_ws(', ', " + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in config.BASE_FEATURES) + ")"
    any_null = " OR ".join(f"{c} IS NULL" for c in config.BASE_FEATURES)
    rules = [f"CASE WHEN {any_null} THEN 'Missing required features: ' || {missing} END"]
    rules.append(f"CASE WHEN longitude > 0 THEN '{_M[0]}' END")
    rules.append(f"CASE WHEN NOT (latitude BETWEEN 32 AND 42) THEN '{_M[1]}' END")
    for c, msg in zip(("total_rooms", "total_bedrooms", "population", "households"), _M[2:6]):
        rules.append(f"CASE WHEN {c} <= 0 THEN '{msg}' END")
    rules.append(f"CASE WHEN NOT (housing_median_age BETWEEN 0 AND 100) THEN '{_M[6]}' END")
    rules.append(f"CASE WHEN median_income <= 0 THEN '{_M[7]}' END")
    return "COALESCE(" + ", ".join(rules) + ")"


def scored_sql() -> str:
    """Every district scored by the 11-feature fit, with the input rule it breaks."""
    complete = " AND ".join(f"t.{c} IS NOT NULL" for c in config.BASE_FEATURES)
    return S.on_housing(f"SELECT t.district_id, CASE WHEN {complete} THEN ROUND({linear_sql()}, 1) END AS prediction, {violation_sql()} AS violation FROM housing t, mst, beta", MODEL_CTES)


@register("score_batch_all_features", scored_sql())
def q_score_batch_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 11-feature pipeline applied to every district's base inputs, with the broken input rules."""
    return _round(_score_all(spark, sf_dir, FEATS), ["prediction"], 1)


# --- the same pipeline with one feature, whose fit SQL can state ------------------------


def _fitted_income(spark: SparkSession, sf_dir: str):
    train, test = R.train_test_split(prepared(spark, sf_dir))
    return R.fit_ols(train, ["median_income"]), train, test


_FIT = f"fit AS (SELECT REGR_SLOPE({T}, median_income) AS b, REGR_INTERCEPT({T}, median_income) AS a, REGR_R2({T}, median_income) AS r2, COUNT(*) AS n, STDDEV_POP(median_income) AS sd, AVG(median_income) AS mi FROM train)"
INCOME_CTES = PREPARED_CTES + ",\n" + _FIT


@register(
    "ols_fit_income",
    S.on_housing(
        f"""SELECT CAST(ANY_VALUE(n) AS BIGINT) AS n_train, ROUND(ANY_VALUE(fit.r2), 6) AS r2_train, ROUND(ANY_VALUE(a + b * mi), 2) AS intercept,
       ROUND(SQRT(AVG(e * e)), 3) AS rmse_test, ROUND(AVG(ABS(e)), 3) AS mae_test, ROUND(1 - AVG(e * e) / VAR_POP(y), 6) AS r2_test
FROM (SELECT {T} - (a + b * median_income) AS e, {T} AS y FROM test, fit), fit""",
        INCOME_CTES,
    ),
)
def q_ols_fit_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, test = _fitted_income(spark, sf_dir)
    lr = model.stages[-1]
    m = R.evaluate_metrics(R.predictions(model, test))
    return m.select(
        F.lit(int(lr.summary.numInstances)).cast("bigint").alias("n_train"), F.round(F.lit(float(lr.summary.r2)), 6).alias("r2_train"), F.round(F.lit(float(lr.intercept)), 2).alias("intercept"),
        F.round("rmse", 3).alias("rmse_test"), F.round("mae", 3).alias("mae_test"), F.round("r2", 6).alias("r2_test"),
    )


@register("feature_importance_income", S.on_housing("SELECT 'median_income' AS feature, ROUND(b * sd, 3) AS coefficient, ROUND(ABS(b * sd), 3) AS abs_coefficient FROM fit", INCOME_CTES))
def q_feature_importance_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, _ = _fitted_income(spark, sf_dir)
    return _round(R.feature_importance(model, ["median_income"], int(model.stages[-1].summary.numInstances)), ["coefficient", "abs_coefficient"], 3)


@register("model_roundtrip_income", S.on_housing(f"SELECT district_id, {T}, ROUND(a + b * median_income, 3) AS prediction FROM test, fit", INCOME_CTES))
def q_model_roundtrip_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, test = _fitted_income(spark, sf_dir)
    m = R.evaluate_metrics(R.predictions(model, test)).first().asDict()
    path = R.save_model(model, ["median_income"], {k: m[k] for k in ("rmse", "r2", "mae")}, scratch_path(spark, "models"))
    loaded, feats, _ = R.load_model(path)
    return _round(R.predictions(loaded, test.select("district_id", T, *feats)), ["prediction"], 3)


@register(
    "drop_null_target",
    S.on_housing(f"SELECT district_id, median_income, {T} FROM housing WHERE district_id % 13 <> 0 AND {T} IS NOT NULL"),
)
def q_drop_null_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a target (here every 13th district's is taken away) are not prepared."""
    gone = F.when(F.col("district_id") % 13 != 0, F.col(T))
    return R.prepare_features(housing(spark, sf_dir).withColumn(T, gone), ["median_income"])[0].select("district_id", "median_income", T)


# --- scoring with SQL forms ------------------------------------------------------------

@register("input_violations", S.on_districts(f"SELECT district_id, {violation_sql()} AS violation FROM districts"))
def q_input_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.input_violations(districts(spark, sf_dir)).select("district_id", "violation")


@register(
    "score_batch",
    S.on_housing(f"SELECT district_id, ROUND(a + b * median_income, 3) AS prediction, {violation_sql()} AS violation FROM districts, fit", INCOME_CTES),
)
def q_score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every district scored by the fitted one-feature pipeline, with the input rule it breaks, if any."""
    return _round(_score_all(spark, sf_dir, ["median_income"]), ["prediction"], 3)


SCORED_COLS = ["district_id", *config.BASE_FEATURES, "rooms_per_household", "bedrooms_per_room", "population_per_household", "income_category"]


def _scored(rows: DataFrame, fill: dict, train: DataFrame) -> tuple[DataFrame, tuple[float, float]]:
    """All districts scored by the one-feature model fitted on the train rows, and that model."""
    slope, intercept = simple_model(train)
    return SC.score_linear(rows, {"median_income": slope}, intercept, fill), (slope, intercept)


@register(
    "score_linear",
    S.on_housing(
        f"SELECT {', '.join(SCORED_COLS)}, ROUND(a + b * median_income, 6) AS prediction FROM housing, fit1",
        PREPARED_CTES,
    ),
)
def q_score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, fill = district_inputs(spark, sf_dir)
    train, _ = R.train_test_split(R.prepare_features(all_features(rows, fill=fill))[0])
    return _round(_scored(rows, fill, train)[0].select(*SCORED_COLS, "prediction"), ["prediction"])


@register(
    "score_details",
    S.on_housing(
        "SELECT district_id, "
        + ", ".join(f"{c} AS input_{c}" for c in FEATS)
        + """, ROUND(p, 6) AS prediction, '$' || format('{:,.2f}', p) AS prediction_formatted,
       rooms_per_household, bedrooms_per_room, population_per_household, income_category,
       ROUND(p - mp, 6) AS diff, ROUND((p - mp) / mp * 100, 6) AS diff_pct,
       CASE WHEN p - mp > 0 THEN 'above' ELSE 'below' END AS position, ROUND(rmse, 6) AS model_rmse, ROUND(r2, 6) AS model_r2, ROUND(mae, 6) AS model_mae
FROM (SELECT *, a + b * median_income AS p FROM housing, fit1) s, (SELECT ROUND(AVG(median_house_value), 2) AS mp FROM housing) m,
     (SELECT SQRT(AVG(e * e)) AS rmse, AVG(ABS(e)) AS mae, 1 - AVG(e * e) / NULLIF(VAR_POP(y), 0) AS r2
      FROM (SELECT """ + f"{T} - prediction AS e, {T} AS y FROM pred1))",
        PREPARED_CTES,
    ),
)
def q_score_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The comparison price is the mean price in cents (as shown next to a prediction).
    rows, fill = district_inputs(spark, sf_dir)
    table = all_features(rows, fill=fill)
    mean_price = table.agg(F.round(F.avg(T), 2)).first()[0]
    train, test = R.train_test_split(R.prepare_features(table)[0])
    scored, model = _scored(rows, fill, train)
    test_metrics = R.evaluate_metrics(simple_predicted(test, *model)).first()
    out = SC.score_details(scored, mean_price, metrics={k: test_metrics[k] for k in ("rmse", "r2", "mae")})
    return _round(out, ["prediction", "diff", "diff_pct", "model_rmse", "model_r2", "model_mae"])
