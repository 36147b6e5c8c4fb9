"""Training rows, inputs, a linear fit, scoring and dimensions on the given tables."""

from pyspark.sql import functions as F

from tidewright.catalog.registry import query
from tidewright.models.metrics import evaluate
from tidewright.models.risk import ModelParams, build, model_inputs, score, train, training_frame
from tidewright.plans.dims import dim_points, dim_zones
from tidewright.plans.serving import importance_view, prediction_view

FIXED = "2024-02-01 00:00:00"
CUT = "1996-01-01 00:00:00"
LINEAR = ["quantity"]

#: Line items as feature rows: the price is the target, the quantity the only feature.
PRICED = """
priced AS (
    SELECT l_returnflag AS zona_id, l_shipdate AS timestamp_forecast, l_orderkey, l_linenumber,
           CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS quantity,
           floor(l_extendedprice / 8) / 64 AS risk_score
    FROM lineitem
), known AS (
    SELECT coalesce(quantity, 0) AS x, risk_score AS y, timestamp_forecast FROM priced
    WHERE risk_score BETWEEN 0 AND 200
), fit AS (
    SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS base FROM known WHERE timestamp_forecast < TIMESTAMP '1996-01-01'
)
"""


def priced(t):
    quantity = F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity"))
    return t.lineitem.select(
        F.col("l_returnflag").alias("zona_id"), F.col("l_shipdate").alias("timestamp_forecast"), "l_orderkey", "l_linenumber",
        quantity.alias("quantity"), (F.floor(F.col("l_extendedprice") / 8) / F.lit(64.0)).alias("risk_score"),
    )


def fitted(t):
    """A straight line through the rows before the cut."""
    rows = training_frame(priced(t)).where(F.col("timestamp_forecast") < F.lit(CUT).cast("timestamp_ntz"))
    return build(ModelParams(kind="LR"), LINEAR, zone=False, regularisation=0.0).fit(model_inputs(rows, LINEAR))


@query(
    "training_rows",
    f"WITH {PRICED} SELECT * FROM priced WHERE risk_score BETWEEN 0 AND 200 AND CAST(timestamp_forecast AS DATE) <= DATE '1996-01-01'",
)
def training_rows(t):
    return training_frame(priced(t), until=CUT)


@query("zone_codes", f"WITH {PRICED} SELECT zona_id, (dense_rank() OVER (ORDER BY zona_id) - 1)::DOUBLE AS code FROM priced GROUP BY zona_id")
def zone_codes(t):
    model = build(ModelParams(kind="LR"), LINEAR).fit(model_inputs(priced(t), LINEAR))
    coded = model.transform(model_inputs(priced(t), LINEAR))
    return coded.select("zona_id", F.col("zona_id_encoded").alias("code")).distinct()


@query(
    "model_inputs",
    f"WITH {PRICED} SELECT zona_id, l_orderkey, l_linenumber, coalesce(quantity, 0)::DOUBLE AS quantity FROM priced",
)
def model_inputs_query(t):
    return model_inputs(priced(t), LINEAR).select("zona_id", "l_orderkey", "l_linenumber", "quantity")


@query("linear_fit", f"WITH {PRICED} SELECT round(slope, 6) AS slope, round(base, 6) AS base FROM fit")
def linear_fit(t):
    line = fitted(t).stages[-1]
    row = [(round(float(line.coefficients[0]), 6), round(float(line.intercept), 6))]
    return t.spark.createDataFrame(row, "slope double, base double")


@query(
    "score_linear",
    f"""
    WITH {PRICED}, p AS (
        SELECT zona_id, timestamp_forecast, round(least(greatest(slope * coalesce(quantity, 0) + base, 0), 100), 2) AS s
        FROM priced, fit
    )
    SELECT zona_id, timestamp_forecast, s AS risk_score_pred,
           CASE WHEN s >= 40 THEN 'PELIGRO' WHEN s >= 20 THEN 'PRECAUCION' ELSE 'SEGURO' END AS safety_level_pred,
           '1' AS model_version, 'line' AS model_run_id,
           TIMESTAMP '{FIXED}' AS prediction_ts, TIMESTAMP '{FIXED}' AS created_at
    FROM p
    """,
)
def score_linear(t):
    return score(fitted(t), priced(t), FIXED, model_run_id="line", inputs=LINEAR)


@query(
    "prediction_view",
    f"""
    WITH {PRICED}, p AS (
        SELECT zona_id, timestamp_forecast, round(least(greatest(slope * coalesce(quantity, 0) + base, 0), 100), 2) AS s
        FROM priced, fit
    )
    SELECT zona_id, timestamp_forecast, s AS risk_score_pred,
           CASE WHEN s >= 40 THEN 'PELIGRO' WHEN s >= 20 THEN 'PRECAUCION' ELSE 'SEGURO' END AS safety_level_pred,
           '1' AS model_version
    FROM p WHERE timestamp_forecast >= TIMESTAMP '{CUT}' AND timestamp_forecast < TIMESTAMP '{CUT}' + INTERVAL 720 HOUR
    """,
)
def prediction_view_query(t):
    return prediction_view(score(fitted(t), priced(t), FIXED, inputs=LINEAR), CUT, 720)


@query(
    "linear_record",
    f"""
    WITH {PRICED}, e AS (
        SELECT timestamp_forecast < TIMESTAMP '1996-01-01' AS early, y, slope * x + base - y AS d FROM known, fit
    )
    SELECT early, count(*) AS n, round(sqrt(avg(d * d)), 5) AS rmse, round(avg(abs(d)), 5) AS mae,
           round(1 - sum(d * d) / (var_pop(y) * count(*)), 6) AS r2
    FROM e GROUP BY early
    """,
)
def linear_record(t):
    rows = fitted(t).transform(model_inputs(training_frame(priced(t)), LINEAR))
    rows = rows.withColumn("early", F.col("timestamp_forecast") < F.lit(CUT).cast("timestamp_ntz"))
    figures = evaluate(rows, "risk_score", "prediction", ["early"])
    return figures.withColumns({"rmse": F.round("rmse", 5), "mae": F.round("mae", 5), "r2": F.round("r2", 6)})


@query(
    "dim_zones",
    f"""
    SELECT CAST(n_nationkey AS VARCHAR) AS zona_id, n_name AS zona_nombre, CAST(n_regionkey AS VARCHAR) AS provincias,
           n_nationkey / 2 AS lat_centro, n_regionkey / 2 AS lon_centro,
           n_nationkey / 2 - 0.25::DOUBLE AS lat_min, n_nationkey / 2 + 0.25::DOUBLE AS lat_max,
           n_regionkey / 2 - 0.25::DOUBLE AS lon_min, n_regionkey / 2 + 0.25::DOUBLE AS lon_max,
           'copernicus_bbox' AS fuente_geometria, true AS activo, TIMESTAMP '{FIXED}' AS updated_at
    FROM nation
    """,
)
def dim_zones_query(t):
    zones = t.nation.select(
        F.col("n_nationkey").cast("string").alias("zona_id"), F.col("n_name").alias("zona_nombre"),
        F.col("n_regionkey").cast("string").alias("provincias"),
        (F.col("n_nationkey") / 2).alias("lat_centro"), (F.col("n_regionkey") / 2).alias("lon_centro"),
    )
    return dim_zones(zones, FIXED)


@query(
    "dim_points",
    f"SELECT s_suppkey AS punto_id, s_nationkey AS zona_id, s_name AS nombre, TIMESTAMP '{FIXED}' AS updated_at FROM supplier",
)
def dim_points_query(t):
    points = t.supplier.select(F.col("s_suppkey").alias("punto_id"), F.col("s_nationkey").alias("zona_id"), F.col("s_name").alias("nombre"))
    return dim_points(points, FIXED, t.nation.select(F.col("n_nationkey").alias("zona_id")))


#: A whole run on two features: the split, the normal equations in closed form, and the figures of both sides.
RUN = """
rows_ AS (
    SELECT l_shipdate AS ts, floor(l_extendedprice / 8) / 64 AS y, l_linenumber::DOUBLE AS x2,
           coalesce(CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END, 0)::DOUBLE AS x1
    FROM lineitem WHERE floor(l_extendedprice / 8) / 64 BETWEEN 0 AND 200
), ordered AS (
    SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS i, count(*) OVER () AS n FROM rows_
), cut AS (
    SELECT min(ts) AS cut_ts FROM ordered WHERE i = CAST(floor(n * 0.8::DOUBLE) AS BIGINT)
), m AS (
    SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS v1, var_pop(x2) AS v2, covar_pop(x1, x2) AS c12,
           covar_pop(y, x1) AS c1, covar_pop(y, x2) AS c2
    FROM rows_, cut WHERE ts < cut_ts
), fit AS (
    SELECT (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS w1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS w2, m1, m2, my FROM m
), errors AS (
    SELECT ts < cut_ts AS early, y, my + w1 * (x1 - m1) + w2 * (x2 - m2) - y AS d FROM rows_, cut, fit
), figures AS (
    SELECT early, count(*) AS n, sqrt(avg(d * d)) AS rmse, avg(abs(d)) AS mae, 1 - sum(d * d) / (var_pop(y) * count(*)) AS r2
    FROM errors GROUP BY early
)
"""
PAIR = ["quantity", "line"]


def _run(t):
    rows = priced(t).withColumn("line", F.col("l_linenumber").cast("double"))
    return train(rows, FIXED, ModelParams(kind="LR"), run_id="baseline", inputs=PAIR, zone=False, regularisation=0.0)


@query(
    "risk_model_record",
    f"""
    WITH {RUN}
    SELECT 'baseline' AS run_id, 'LR' AS model_type,
           '{{"depth": 10, "kind": "LR", "rate": 0.1, "seed": 42, "subsample": 0.8, "trees": 100}}' AS params,
           1.0::DOUBLE - 0.8::DOUBLE AS test_split, tr.n AS train_records, te.n AS test_records, 2 AS num_features,
           round(te.rmse, 5) AS rmse, round(te.mae, 5) AS mae, round(te.r2, 6) AS r2,
           round(tr.rmse, 5) AS rmse_train, round(tr.mae, 5) AS mae_train, round(tr.r2, 6) AS r2_train,
           CASE WHEN tr.r2 - te.r2 > 0.15 THEN 'OVERFIT' WHEN te.rmse > 20 THEN 'HIGH_RMSE' ELSE 'OK' END AS verdict,
           TIMESTAMP '{FIXED}' AS created_at
    FROM (SELECT * FROM figures WHERE early) tr, (SELECT * FROM figures WHERE NOT early) te
    """,
)
def risk_model_record(t):
    """Split, fit, evaluation and record of a run with two features."""
    digits = {"rmse": 5, "mae": 5, "r2": 6, "rmse_train": 5, "mae_train": 5, "r2_train": 6}
    return _run(t).record.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(
    "importance_view",
    f"""
    WITH {RUN}, w AS (SELECT 'quantity' AS feature, w1 AS w FROM fit UNION ALL SELECT 'line', w2 FROM fit)
    SELECT feature, round(w, 6) AS importance, row_number() OVER (ORDER BY abs(w) DESC, feature)::INTEGER AS rank, 'LR' AS model_type,
           'baseline' AS run_id, TIMESTAMP '{FIXED}' AS created_at
    FROM w
    """,
)
def importance_view_query(t):
    return importance_view(_run(t).importances).withColumn("importance", F.round("importance", 6))
