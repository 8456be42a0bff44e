"""Encoders, splits, models, metrics and explanations."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelweave import models, sources
from panelweave.models import gram
from panelweave.lineage import durable, scratch_folder
from panelweave.operators import encode, explain, metrics, windows
from queries import roles, series
from queries.registry import query

TRAIN_DAYS = 20
ORDER = ["day", "user_id"]
SEED = 11


def fitted_days(rows):
    return rows.filter(F.col("day") <= TRAIN_DAYS), rows.filter(F.col("day") > TRAIN_DAYS)


# -- encoders -----------------------------------------------------------------


@query(
    "label_encode",
    f"""WITH {roles.UD_KIND},
    users AS (SELECT user_id, dense_rank() OVER (ORDER BY user_id) - 1 AS user_code
      FROM (SELECT DISTINCT user_id FROM ud WHERE active AND day <= 5)),
    kinds AS (SELECT kind, dense_rank() OVER (ORDER BY kind) - 1 AS kind_code
      FROM (SELECT DISTINCT kind FROM udk WHERE active AND day <= 5))
    SELECT u.user_id, u.day, u.kind, coalesce(s.user_code, -1) AS user_code,
      coalesce(k.kind_code, -1) AS kind_code
    FROM udk u LEFT JOIN users s ON s.user_id = u.user_id LEFT JOIN kinds k ON k.kind = u.kind
    WHERE u.day > 5""",
)
def label_encode(spark, folder):
    rows = roles.ud_kind(spark, folder)
    train = rows.filter(F.col("active") & (F.col("day") <= 5))
    score = rows.filter(F.col("day") > 5)
    users = encode.fit_labels(train, "user_id", "user_code")
    kinds = encode.fit_labels(train, "kind", "kind_code")
    coded = encode.apply_labels(score, users, "user_id", "user_code", unseen=-1)
    coded = encode.apply_labels(coded, kinds, "kind", "kind_code", unseen=-1)
    return coded.select("user_id", "day", "kind", "user_code", "kind_code")


@query(
    "standard_scale",
    f"""WITH {roles.UD},
    fit AS (SELECT avg(x) AS m, stddev_pop(x) AS s, avg(n_events) AS mn, stddev_pop(n_events) AS sn
      FROM ud WHERE day <= {TRAIN_DAYS})
    SELECT user_id, day, round((x - m) / s, 6) AS x_scaled,
           round((n_events - mn) / sn, 6) AS n_scaled
    FROM ud, fit WHERE day > {TRAIN_DAYS}""",
)
def standard_scale(spark, folder):
    train, score = fitted_days(roles.ud(spark, folder))
    stats = encode.fit_scale(train, ["x", "n_events"])
    scaled = encode.apply_scale(score, stats, "_scaled")
    return scaled.select(
        "user_id",
        "day",
        F.round("x_scaled", 6).alias("x_scaled"),
        F.round("n_events_scaled", 6).alias("n_scaled"),
    )


@query(
    "median_impute",
    f"""WITH {roles.UD},
    fit AS (SELECT median(x) AS m, median(n_events) AS mn FROM ud WHERE day <= {TRAIN_DAYS})
    SELECT user_id, day, round(coalesce(x, m), 6) AS x, cast(coalesce(n_events, mn) AS DOUBLE) AS n_events
    FROM ud, fit WHERE day > {TRAIN_DAYS}""",
)
def median_impute(spark, folder):
    train, score = fitted_days(roles.ud(spark, folder))
    filled = encode.apply_medians(score, encode.fit_medians(train, ["x", "n_events"]))
    return filled.select("user_id", "day", F.round("x", 6).alias("x"), "n_events")




@query(
    "one_hot",
    f"""WITH {roles.UD_KIND},
    kinds AS (SELECT kind, dense_rank() OVER (ORDER BY kind) AS place
      FROM (SELECT DISTINCT kind FROM udk WHERE kind IS NOT NULL AND day <= {TRAIN_DAYS}))
    SELECT u.user_id, u.day, 'kind_' || k.kind AS indicator,
           coalesce(cast(u.kind = k.kind AS DOUBLE), 0) AS hot
    FROM udk u JOIN kinds k ON k.place > 1 WHERE u.day > {TRAIN_DAYS}""",
)
def one_hot(spark, folder):
    train, score = fitted_days(roles.ud_kind(spark, folder))
    categories = encode.fit_categories(train, ["kind"])
    hot = encode.apply_one_hot(score, categories)
    indicators = list(encode.one_hot_columns(categories))
    return hot.unpivot(["user_id", "day"], indicators, "indicator", "hot")


@query(
    "assemble_features",
    f"""WITH {roles.UD_KIND},
    fit AS (SELECT median(x) AS mx, median(n_events) AS mn FROM udk WHERE day <= {TRAIN_DAYS}),
    kinds AS (SELECT kind, dense_rank() OVER (ORDER BY kind) AS place
      FROM (SELECT DISTINCT kind FROM udk WHERE kind IS NOT NULL AND day <= {TRAIN_DAYS})),
    cells AS (
      SELECT user_id, day, 0 AS place, 'x' AS feature, coalesce(x, mx) AS v FROM udk, fit
      UNION ALL SELECT user_id, day, 1, 'n_events', coalesce(n_events, mn) FROM udk, fit
      UNION ALL SELECT u.user_id, u.day, k.place, 'kind=' || k.kind,
        coalesce(cast(u.kind = k.kind AS DOUBLE), 0) FROM udk u JOIN kinds k ON k.place > 1),
    scale AS (SELECT feature, avg(v) AS m, stddev_pop(v) AS s FROM cells
      WHERE day <= {TRAIN_DAYS} GROUP BY 1)
    SELECT user_id, day, feature, round((v - m) / CASE WHEN s = 0 THEN 1 ELSE s END, 6) AS scaled
    FROM cells JOIN scale USING (feature) WHERE day > {TRAIN_DAYS}""",
)
def assemble_features(spark, folder):
    train, score = fitted_days(roles.ud_kind(spark, folder))
    stage = models.PanelFeatures(numericCols=["x", "n_events"], textCols=["kind"]).fit(train)
    names = F.array(*[F.lit(n) for n in stage.feature_names()])
    cells = F.explode(F.arrays_zip(names.alias("name"), vector_to_array("features").alias("v")))
    return (
        stage.transform(score)
        .select("user_id", "day", cells.alias("_c"))
        .select(
            "user_id",
            "day",
            F.col("_c.name").alias("feature"),
            F.round(F.col("_c.v"), 6).alias("scaled"),
        )
    )


# -- splits -------------------------------------------------------------------


@query(
    "time_split",
    f"""WITH {roles.UD}
    SELECT user_id, day, x, 'train' AS part FROM ud WHERE day < 21
    UNION ALL SELECT user_id, day, x, 'test' FROM ud WHERE day > 20""",
)
def time_split(spark, folder):
    train, test = encode.time_split(roles.ud(spark, folder), "day", 21, 20)
    parts = [
        df.select("user_id", "day", "x", F.lit(name).alias("part"))
        for df, name in ((train, "train"), (test, "test"))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "ordered_split",
    f"""WITH {roles.UD}, placed AS (SELECT user_id, day,
      row_number() OVER (ORDER BY day, user_id) - 1 AS idx, count(*) OVER () AS n FROM ud)
    SELECT user_id, day, idx < floor(0.8::DOUBLE * n) AS in_train FROM placed""",
)
def ordered_split(spark, folder):
    return encode.ordered_split(roles.ud(spark, folder).select("user_id", "day"), ORDER)


@query(
    "time_folds",
    f"""WITH {roles.UD}, placed AS (SELECT user_id, day,
      row_number() OVER (ORDER BY day, user_id) - 1 AS idx, count(*) OVER () // 4 AS size,
      count(*) OVER () AS n FROM ud)
    SELECT user_id, day, cast(CASE WHEN idx < n - 3 * size THEN 0
      ELSE (idx - (n - 3 * size)) // size + 1 END AS INTEGER) AS fold FROM placed""",
)
def time_folds(spark, folder):
    return encode.time_folds(roles.ud(spark, folder).select("user_id", "day"), ORDER)


# -- metrics ------------------------------------------------------------------


@query(
    "metrics_error",
    f"""WITH {roles.PRED} SELECT round(avg(abs(y - p)), 6) AS mae,
    round(avg((y - p) * (y - p)), 5) AS mse, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse
    FROM pred""",
)
def metrics_error(spark, folder):
    row = metrics.metrics_error(roles.pred(spark, folder), "y", "p")
    return row.select(
        F.round("mae", 6).alias("mae"), F.round("mse", 5).alias("mse"), F.round("rmse", 6).alias("rmse")
    )


@query(
    "metrics_r2",
    f"""WITH {roles.PRED}, m AS (SELECT avg(y) AS mean FROM pred)
    SELECT round(1 - sum((y - p) * (y - p)) / sum((y - mean) * (y - mean)), 6) AS r2
    FROM pred, m""",
)
def metrics_r2(spark, folder):
    row = metrics.metrics_r2(roles.pred(spark, folder), "y", "p")
    return row.select(F.round("r2", 6).alias("r2"))


RANKED = """
ranked AS (
  SELECT rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS ry,
         rank() OVER (ORDER BY pr) + (count(*) OVER (PARTITION BY pr) - 1) / 2.0::DOUBLE AS rp
  FROM (SELECT y, round(p, 6) AS pr FROM pred))"""


@query(
    "metrics_spearman",
    f"WITH {roles.PRED}, {RANKED} SELECT round(corr(ry, rp), 6) AS spearman FROM ranked",
)
def metrics_spearman(spark, folder):
    rows = roles.pred(spark, folder).withColumn("p", F.round("p", 6))
    row = metrics.metrics_spearman(rows, "y", "p")
    return row.select(F.round("spearman", 6).alias("spearman"))


@query(
    "evaluate",
    f"""WITH {roles.PRED}, {RANKED}, m AS (SELECT avg(y) AS mean FROM pred)
    SELECT round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 5) AS mse,
      round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
      round(1 - sum((y - p) * (y - p)) / sum((y - mean) * (y - mean)), 6) AS r2,
      (SELECT round(corr(ry, rp), 6) FROM ranked) AS spearman
    FROM pred, m""",
)
def evaluate(spark, folder):
    rows = roles.pred(spark, folder).withColumn("p", F.round("p", 6))
    row = metrics.evaluate(rows, "y", "p")
    digits = {"mae": 6, "mse": 5, "rmse": 6, "r2": 6, "spearman": 6}
    return row.select(*[F.round(c, d).alias(c) for c, d in digits.items()])


@query(
    "calibration_bins",
    f"""WITH {roles.PRED}
    SELECT cast(floor(y / 10) AS BIGINT) AS actual_bin, cast(floor(p / 10) AS BIGINT) AS predicted_bin,
      count(*) AS n, min(y) AS min_actual, max(y) AS max_actual
    FROM (SELECT y, round(p, 6) AS p FROM pred) GROUP BY 1, 2""",
)
def calibration_bins(spark, folder):
    rows = roles.pred(spark, folder).withColumn("p", F.round("p", 6))
    return metrics.calibration_bins(rows, "y", "p", 10)


@query(
    "top_k",
    f"""WITH {roles.PRED} SELECT user_id, day, round(abs(y - p), 6) AS miss FROM pred
    ORDER BY abs(y - p) DESC, user_id, day LIMIT 20""",
)
def top_k(spark, folder):
    rows = roles.pred(spark, folder).withColumn("miss", F.abs(F.col("y") - F.col("p")))
    best = explain.top_k(rows, "miss", 20, ["user_id", "day"])
    return best.select("user_id", "day", F.round("miss", 6).alias("miss"))


# -- linear model and its explanation -----------------------------------------

# least squares of y on (p, l1) in closed form
LEAST_SQUARES = """
fit AS (
  SELECT (covar_pop(p, y) * var_pop(l1) - covar_pop(l1, y) * covar_pop(p, l1))
           / (var_pop(p) * var_pop(l1) - covar_pop(p, l1) * covar_pop(p, l1)) AS bp,
         (covar_pop(l1, y) * var_pop(p) - covar_pop(p, y) * covar_pop(p, l1))
           / (var_pop(p) * var_pop(l1) - covar_pop(p, l1) * covar_pop(p, l1)) AS bl,
         avg(y) AS my, avg(p) AS mp, avg(l1) AS ml
  FROM pred)"""
CELLS = """
cells AS (
  SELECT user_id, day, 'p' AS feature, bp * (p - mp) AS attribution FROM pred, fit
  UNION ALL SELECT user_id, day, 'l1', bl * (l1 - ml) FROM pred, fit)"""


def fit_linear(rows, columns, label="y"):
    """Least squares on raw columns: (coefficients by name, intercept)."""
    from pyspark.ml.feature import VectorAssembler

    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows)
    model = models.linear_model(label).fit(vectors)
    return dict(zip(columns, [float(c) for c in model.coefficients])), float(model.intercept)


@query(
    "linear_fit",
    f"""WITH {roles.PRED}, {LEAST_SQUARES},
    one AS (SELECT regr_slope(y, p) AS slope, regr_intercept(y, p) AS intercept FROM pred)
    SELECT 'p' AS model, round(slope, 5) AS b_p, cast(NULL AS DOUBLE) AS b_l1,
           round(intercept, 4) AS intercept FROM one
    UNION ALL SELECT 'p+l1', round(bp, 5), round(bl, 5), round(my - bp * mp - bl * ml, 4) FROM fit""",
)
def linear_fit(spark, folder):
    rows = roles.pred(spark, folder)
    out = []
    for columns in (["p"], ["p", "l1"]):
        b, intercept = fit_linear(rows, columns)
        out.append(("+".join(columns), b["p"], b.get("l1"), intercept))
    fits = spark.createDataFrame(out, "model string, b_p double, b_l1 double, intercept double")
    return fits.select(
        "model",
        F.round("b_p", 5).alias("b_p"),
        F.round("b_l1", 5).alias("b_l1"),
        F.round("intercept", 4).alias("intercept"),
    )


@query(
    "linear_attribution",
    f"""WITH {roles.PRED}, {LEAST_SQUARES}, {CELLS}
    SELECT user_id, day, feature, round(attribution, 4) AS attribution FROM cells""",
)
def linear_attribution(spark, folder):
    rows = roles.pred(spark, folder)
    b, _ = fit_linear(rows, ["p", "l1"])
    cells = explain.linear_attribution(rows, b, ["user_id", "day"])
    return cells.withColumn("attribution", F.round("attribution", 4))


@query(
    "attribution_ranking",
    f"""WITH {roles.PRED}, {LEAST_SQUARES}, {CELLS}
    SELECT feature, round(avg(abs(attribution)), 5) AS importance FROM cells GROUP BY 1""",
)
def attribution_ranking(spark, folder):
    rows = roles.pred(spark, folder)
    b, _ = fit_linear(rows, ["p", "l1"])
    ranking = explain.attribution_ranking(explain.linear_attribution(rows, b, ["user_id", "day"]))
    return ranking.withColumn("importance", F.round("importance", 5))


@query(
    "permutation_importance",
    f"""WITH {roles.PRED}, {LEAST_SQUARES},
    hashed AS (SELECT *, md5(user_id || '|' || day || '|{SEED}') AS h FROM pred),
    shuffled AS (SELECT y, p, l1,
        coalesce(lead(p) OVER w, first_value(p) OVER w) AS pp,
        coalesce(lead(l1) OVER w, first_value(l1) OVER w) AS pl
      FROM hashed WINDOW w AS (ORDER BY h, user_id, day)),
    errors AS (SELECT y - (my + bp * (p - mp) + bl * (l1 - ml)) AS e, bp, bl, p, l1, pp, pl
      FROM shuffled, fit)
    SELECT 'p' AS feature, round(avg(pow(e - bp * (pp - p), 2)) - avg(e * e), 4) AS importance FROM errors
    UNION ALL SELECT 'l1', round(avg(pow(e - bl * (pl - l1), 2)) - avg(e * e), 4) FROM errors""",
)
def permutation_importance(spark, folder):
    rows = roles.pred(spark, folder)
    b, intercept = fit_linear(rows, ["p", "l1"])
    predicted = F.lit(intercept) + F.lit(b["p"]) * F.col("p") + F.lit(b["l1"]) * F.col("l1")
    ranked = explain.permutation_importance_linear(
        rows.withColumn("prediction", predicted), b, "y", "prediction", ["user_id", "day"], SEED
    )
    return ranked.withColumn("importance", F.round("importance", 4))


# -- fitted models --------------------------------------------------------------
# A linear fit is the same on any affine form of its features, so the pipelines of
# scaling and least squares have a closed form in SQL. Tree models are checked by
# properties that must hold for every row.

PAST = f"past AS (SELECT * FROM pred WHERE day <= {TRAIN_DAYS})"
PAST_FIT = f"{PAST}, {LEAST_SQUARES.replace('FROM pred', 'FROM past')}"
FITTED = "my + bp * (p - mp) + bl * (l1 - ml)"


def linear_pipeline(spark, folder):
    """Fitted preprocessing and least squares on the first days, and the later rows."""
    rows = durable(roles.pred(spark, folder))
    train, score = fitted_days(rows)
    stages = [models.PanelFeatures(numericCols=["p", "l1"], textCols=[]), models.linear_model("y")]
    return Pipeline(stages=stages).fit(train), score


def training_rows(spark, folder):
    """Lagged features, streak and first event type with the value of the day."""
    kinds = roles.first_kind(spark, folder)
    ud = roles.ud(spark, folder)
    rows = windows.add_streak(series.battery(ud), *roles.USER_DAY, active="active")
    # every fit reads these rows several times: computed and written once
    return durable(
        rows.filter("active")
        .join(kinds, ["user_id", "day"])
        .select(
            "user_id",
            "day",
            F.col("x").alias("y"),
            "kind",
            "streak",
            *[c for c in rows.columns if c.endswith("_l3")],
        )
    )


def panel_features(rows):
    numeric = [c for c in rows.columns if c.endswith("_l3")] + ["streak"]
    return models.PanelFeatures(numericCols=numeric, textCols=["kind"])


def small_trees(label="y", **settings):
    return models.tree_model(label, **{"n_estimators": 5, "max_depth": 3, **settings})


@query(
    "preprocess_fit_score",
    f"""WITH {roles.PRED}, {PAST_FIT}
    SELECT user_id, day, y, round({FITTED}, 3) AS prediction FROM pred, fit WHERE day > {TRAIN_DAYS}""",
)
def preprocess_fit_score(spark, folder):
    model, score = linear_pipeline(spark, folder)
    out = models.batch_score(model, score, ["user_id", "day", "y"])
    return out.withColumn("prediction", F.round("prediction", 3))


@query(
    "gbt_fit_score",
    f"""WITH {roles.UD}
    SELECT user_id, day, x AS y, true AS is_scored, true AS fits_better_than_mean
    FROM ud WHERE active AND day > {TRAIN_DAYS}""",
)
def gbt_fit_score(spark, folder):
    """Every later row gets a prediction, and the trees fit their own rows better than the mean does."""
    rows = training_rows(spark, folder)
    train, score = fitted_days(rows)
    model = Pipeline(stages=[panel_features(rows), small_trees()]).fit(train)
    own = models.batch_score(model, train, ["y"])
    error = own.agg((F.avg(F.pow(F.col("y") - F.col("prediction"), F.lit(2))) < F.var_pop("y")).alias("fits_better_than_mean"))
    out = models.batch_score(model, score, ["user_id", "day", "y"])
    known = (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("is_scored")
    # one row
    return out.join(F.broadcast(error)).select("user_id", "day", "y", known, "fits_better_than_mean")


@query("tree_node_importance")
def tree_node_importance(spark, folder):
    """Split importance per source column, read from the saved node rows of boosted trees."""
    rows = training_rows(spark, folder)
    train, _ = fitted_days(rows)
    model = Pipeline(stages=[panel_features(rows), small_trees()]).fit(train)
    path = f"{scratch_folder(spark)}/trees-{uuid.uuid4().hex}"
    model.stages[-1].write().save(path)
    return explain.node_importance(spark, path, model.stages[0].feature_names())


@query("grid_search")
def grid_search(spark, folder):
    rows = training_rows(spark, folder)
    train, _ = fitted_days(rows)
    grid = models.expand_grid({"fit_intercept": [True, False]})
    found = models.search(train, panel_features(rows), models.linear_model, grid, "y", ORDER)
    out = [
        (json.dumps(params), float(mean), *[float(v) for v in folds], params == found.params)
        for params, mean, folds in found.scores
    ]
    return spark.createDataFrame(
        out, "params string, mean_r2 double, r2_1 double, r2_2 double, r2_3 double, best boolean"
    )


def iteration_losses(spark, folder):
    """Training and validation loss of every boosting iteration up to the stop, and the trees kept."""
    rows = training_rows(spark, folder)
    train, _ = fitted_days(rows)
    model, history = models.fit_with_patience(
        train, panel_features(rows), "y", ORDER, patience=3, n_estimators=8, max_depth=3
    )
    return history.withColumn("kept_trees", F.lit(model.stages[-1].getNumTrees))


query("iteration_losses")(iteration_losses)


@query(
    "loss_by_iteration",
    "SELECT true AS starts_at_one, true AS train_loss_falls, true AS stops_in_time, true AS keeps_the_best",
)
def loss_by_iteration(spark, folder):
    """Properties of the loss table: numbered from 1, falling on the fitted rows, stopped in time, best kept."""
    rows = training_rows(spark, folder)
    train, _ = fitted_days(rows)
    model, history = models.fit_with_patience(
        train, panel_features(rows), "y", ORDER, patience=3, n_estimators=8, max_depth=3
    )
    kept = model.stages[-1].getNumTrees
    best = F.min_by("iteration", F.struct("validation_loss", "iteration"))
    before = F.lag("train_loss").over(Window.orderBy("iteration"))  # one row for each iteration
    return history.withColumn("_before", before).agg(
        (F.min("iteration") == 1).alias("starts_at_one"),
        F.bool_and(F.col("_before").isNull() | (F.col("train_loss") <= F.col("_before"))).alias("train_loss_falls"),
        (F.max("iteration") - best <= 3).alias("stops_in_time"),
        (best == kept).alias("keeps_the_best"),
    )


@query(
    "batch_score",
    f"""WITH {roles.PRED}, {PAST_FIT}
    SELECT user_id, day, l1, round({FITTED}, 3) AS predicted FROM pred, fit WHERE day > {TRAIN_DAYS}""",
)
def batch_score(spark, folder):
    model, score = linear_pipeline(spark, folder)
    out = models.batch_score(model, score, ["user_id", "day", "l1"], "predicted")
    return out.withColumn("predicted", F.round("predicted", 3))


@query(
    "model_roundtrip",
    f"""WITH {roles.PRED}, {PAST_FIT}
    SELECT user_id, day, round({FITTED}, 3) AS prediction, true AS is_same FROM pred, fit WHERE day > {TRAIN_DAYS}""",
)
def model_roundtrip(spark, folder):
    """Predictions of a saved and loaded model, and whether they are those of the model before."""
    model, score = linear_pipeline(spark, folder)
    base = f"{models_folder(spark)}/roundtrip"
    sources.save_model(model, base, "individual_lr")
    before = models.batch_score(model, score, ["user_id", "day"], "before")
    after = models.batch_score(sources.load_model(base, "individual_lr"), score, ["user_id", "day"])
    both = after.join(before, ["user_id", "day"], "left")
    same = F.col("prediction").eqNullSafe(F.col("before")).alias("is_same")
    return both.select("user_id", "day", F.round("prediction", 3).alias("prediction"), same)


def models_folder(spark) -> str:
    """Folder for models, next to the written tables that all executors share."""
    return f"{scratch_folder(spark)}/models"


@query(
    "sequence_score",
    f"""WITH {roles.PRED.replace('pred AS (', 'known AS (')},
    pred AS (SELECT * FROM (
      SELECT user_id, day, y, l1, lag(l1) OVER (PARTITION BY user_id ORDER BY day) AS p FROM known)
      WHERE p IS NOT NULL), {PAST_FIT}
    SELECT user_id, day, y, round({FITTED}, 3) AS prediction FROM pred, fit WHERE day > {TRAIN_DAYS}""",
)
def sequence_score(spark, folder):
    """Sequences of two rows, scaled; a linear model of their cells, oldest row first."""
    rows = durable(roles.pred(spark, folder))
    train, _ = fitted_days(rows)
    scaled = encode.apply_scale(rows, encode.fit_scale(train, ["l1"]), "_scaled")
    sequences = windows.sequence_windows(scaled, *roles.USER_DAY, ["l1_scaled"], 2, "current")
    past = models.flatten_sequences(sequences.filter(F.col("day") <= TRAIN_DAYS))
    model = models.linear_model("y").fit(past)
    out = models.score_sequences(
        model, scaled, *roles.USER_DAY, ["l1_scaled"], 2, ["user_id", "day", "y"], only=F.col("day") > TRAIN_DAYS
    )
    return out.withColumn("prediction", F.round("prediction", 3))


GRAM_GRID = ", ".join(
    f"({s}, {str(g['fit_intercept']).lower()}, {g['reg']!r}::DOUBLE)" for s, g in enumerate(gram.RIDGE_GRID)
)
GRAM_COLUMNS = (
    "setting int, fit_intercept boolean, reg double, fold int, n_train long, n_test long, r2 double, mean_r2 double, best boolean"
)


def gram_rows(spark, rows, features):
    found = gram.gram_search(rows, features, "y", "day", "user_id", 3)
    names = [c.split()[0] for c in GRAM_COLUMNS.split(", ")]
    out = spark.createDataFrame([tuple(r[c] for c in names) for r in found], GRAM_COLUMNS)
    return out.withColumns({"r2": F.round("r2", 6), "mean_r2": F.round("mean_r2", 6)})


@query(
    "gram_search",
    f"""WITH {roles.PRED},
    placed AS (SELECT *, row_number() OVER (ORDER BY day, user_id) - 1 AS i, count(*) OVER () AS n FROM pred),
    blocks AS (SELECT *, CAST(i >= n - 3 * (n // 4) AS INT) + CAST(i >= n - 2 * (n // 4) AS INT)
                         + CAST(i >= n - (n // 4) AS INT) AS block FROM placed),
    grid AS (SELECT * FROM (VALUES {GRAM_GRID}) g(setting, fit_intercept, reg)),
    folds AS (SELECT unnest([1, 2, 3]) AS fold),
    train AS (
      SELECT fold, count(*) AS n_train, avg(y) AS my, avg(p) AS mp, avg(l1) AS ml,
             var_pop(p) AS cpp, var_pop(l1) AS cll, covar_pop(p, l1) AS cpl, covar_pop(p, y) AS cpy,
             covar_pop(l1, y) AS cly, avg(p * p) AS rpp, avg(l1 * l1) AS rll, avg(p * l1) AS rpl,
             avg(p * y) AS rpy, avg(l1 * y) AS rly
      FROM blocks JOIN folds ON block < fold GROUP BY fold),
    systems AS (
      SELECT t.fold, g.setting, g.fit_intercept, g.reg, t.n_train, t.my, t.mp, t.ml,
             CASE WHEN g.fit_intercept THEN cpp ELSE rpp END + g.reg AS a11,
             CASE WHEN g.fit_intercept THEN cpl ELSE rpl END AS a12,
             CASE WHEN g.fit_intercept THEN cll ELSE rll END + g.reg AS a22,
             CASE WHEN g.fit_intercept THEN cpy ELSE rpy END AS b1,
             CASE WHEN g.fit_intercept THEN cly ELSE rly END AS b2
      FROM train t, grid g),
    coef AS (SELECT *, (b1 * a22 - b2 * a12) / (a11 * a22 - a12 * a12) AS bp,
                       (b2 * a11 - b1 * a12) / (a11 * a22 - a12 * a12) AS bl FROM systems),
    fitted AS (SELECT *, CASE WHEN fit_intercept THEN my - bp * mp - bl * ml ELSE 0 END AS b0 FROM coef),
    tests AS (SELECT *, avg(y) OVER (PARTITION BY block) AS ty, count(*) OVER (PARTITION BY block) AS n_test
              FROM blocks WHERE block >= 1),
    scored AS (
      SELECT f.setting, f.fit_intercept, f.reg, f.fold, f.n_train, t.n_test,
             1 - sum(pow(t.y - f.b0 - f.bp * t.p - f.bl * t.l1, 2)) / sum(pow(t.y - t.ty, 2)) AS r2
      FROM fitted f JOIN tests t ON t.block = f.fold
      GROUP BY f.setting, f.fit_intercept, f.reg, f.fold, f.n_train, t.n_test),
    means AS (SELECT *, avg(r2) OVER (PARTITION BY setting) AS mean_r2 FROM scored)
    SELECT setting, fit_intercept, reg, fold, n_train, n_test, round(r2, 6) AS r2, round(mean_r2, 6) AS mean_r2,
           setting = first_value(setting) OVER (ORDER BY mean_r2 DESC, setting) AS best
    FROM means""",
)
def gram_search(spark, folder):
    """Linear and ridge settings on expanding time folds, from one aggregate of Gram matrices."""
    return gram_rows(spark, durable(roles.pred(spark, folder)), ["p", "l1"])


@query("gram_search_full")
def gram_search_full(spark, folder):
    """The same search on all lagged features and the streak of the training rows."""
    rows = training_rows(spark, folder)
    numeric = [c for c in rows.columns if c.endswith("_l3")] + ["streak"]
    return gram_rows(spark, rows, numeric)
