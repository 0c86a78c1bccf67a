"""Fits under an oracle: solutions that have a closed form, and conditions that a solution meets."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.stopwords import sql_list
from tessera.functions.strings import WORD_PATTERN
from tessera.operators import certificates, models, splits
from tessera.plans import models as plans
from tessera.plans.registry import register
from tessera.sources.tables import load

_SIDE = "CAST('0x' || substr(md5(concat_ws('|', '42', {keys})), 1, 8) AS BIGINT) % 10"

# ---- recommendation -----------------------------------------------------------------------

_RANK, _REG = 10, 0.01


@register(
    "als_solves",
    sql=f"""
    WITH {plans._RATINGS_SQL}
    SELECT 'user' AS kind, count(DISTINCT "user") AS n, CAST(0 AS BIGINT) AS unsolved FROM r
    UNION ALL SELECT 'item', count(DISTINCT item), 0 FROM r
    UNION ALL SELECT 'user again', count(DISTINCT "user"), 0 FROM r""",
)
def als_solves(spark, sf_dir):
    """After ALS's last half-step every user's factors solve the user's normal equations given the item
    factors; a further half-step for the items solves theirs given the users'; and a half-step for the
    users gives the fit's own factors again. Counted are keys that miss by more than a thousandth."""
    table = plans.numbered_ratings(spark, sf_dir)[0]
    model = models.als(table, "u", "i", "rating", rank=_RANK, reg=_REG)
    uf, vf = model.userFactors, model.itemFactors
    item_step = certificates.half_step(table, "i", "u", "rating", uf, _RANK, _REG).withColumnRenamed("i", "id")
    user_step = certificates.half_step(table, "u", "i", "rating", vf, _RANK, _REG)
    own = uf.select(F.col("id").alias("u"), F.col("features").alias("own"))
    gap = F.array_max(F.zip_with("features", "own", lambda a, b: F.abs(a - b)))
    size = F.array_max(F.transform("features", lambda a: F.abs(a)))
    sides = {
        "user": certificates.residuals(table, "u", "i", "rating", uf, vf, _RANK, _REG),
        "item": certificates.residuals(table, "i", "u", "rating", item_step, uf, _RANK, _REG),
        "user again": user_step.join(own, "u").select((gap / size).alias("residual")),
    }
    missed = F.count_if(~F.coalesce(F.col("residual") <= 1e-3, F.lit(False)))
    out = [s.agg(F.count(F.lit(1)).alias("n"), missed.alias("unsolved")).select(F.lit(k).alias("kind"), "n", "unsolved") for k, s in sides.items()]
    return reduce(DataFrame.unionByName, out)


# ---- classification -----------------------------------------------------------------------

_TOKENS = f"regexp_extract_all(lower(d.text), '{WORD_PATTERN}')"
_PAGES_SQL = f"""
    pages_ AS (
      SELECT d.doc_id, d.source, CAST(l.quality AS DOUBLE) AS label, CAST(d.n_chars AS DOUBLE) AS n_chars,
             CAST(len({_TOKENS}) AS DOUBLE) AS n_tokens,
             CAST(len(list_filter({_TOKENS}, lambda t: NOT list_contains([{sql_list()}], t))) AS DOUBLE) AS n_kept,
             {_SIDE.format(keys='d.doc_id')} AS side
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    train AS (SELECT * FROM pages_ WHERE side < 8), test AS (SELECT * FROM pages_ WHERE side >= 8)"""

_BAYES_SQL = f"""
    WITH {_PAGES_SQL},
    kinds AS (SELECT DISTINCT source FROM train),
    classes AS (SELECT label, count(*) AS n, sum(n_chars + n_tokens + n_kept + 1) AS total, sum(n_chars) AS c,
                       sum(n_tokens) AS t, sum(n_kept) AS k FROM train GROUP BY label),
    size AS (SELECT (SELECT count(*) FROM kinds) + 3 AS d, (SELECT count(*) FROM train) AS n, (SELECT count(*) FROM classes) AS m),
    sources AS (SELECT c.label, k.source, (SELECT count(*) FROM train r WHERE r.label = c.label AND r.source = k.source) AS s
                FROM classes c, kinds k),
    scores AS (
      SELECT x.doc_id, x.label AS truth, c.label,
             ln(c.n + 1) - ln(z.n + z.m) + x.n_chars * (ln(c.c + 1) - ln(c.total + z.d)) + x.n_tokens * (ln(c.t + 1) - ln(c.total + z.d))
             + x.n_kept * (ln(c.k + 1) - ln(c.total + z.d)) + coalesce(ln(s.s + 1) - ln(c.total + z.d), 0) AS score
      FROM test x CROSS JOIN classes c CROSS JOIN size z LEFT JOIN sources s ON s.label = c.label AND s.source = x.source)
    SELECT doc_id, truth AS label, arg_max(label, score) AS prediction FROM scores GROUP BY doc_id, truth"""


@register("naive_bayes_rows", sql=_BAYES_SQL)
def naive_bayes_rows(spark, sf_dir):
    """What Spark ML's multinomial naive Bayes predicts for every test row; the twin has the model as
    class-conditional sums."""
    train, test = plans._sides(plans.page_table(spark, sf_dir))
    held = train.persist()
    try:
        _, pred = models.fit_and_score(plans._page_stages() + [models.naive_bayes("features_raw")], held, test)
    finally:
        held.unpersist()
    return pred.select("doc_id", "label", "prediction")


@register("naive_bayes_sums", sql=_BAYES_SQL)
def naive_bayes_sums(spark, sf_dir):
    """L09 as sums: the same model from one aggregate, every test row scored against its logs."""
    train, test = plans._sides(plans.page_table(spark, sf_dir))
    return certificates.bayes_predictions(train, test, "label", ["n_chars", "n_tokens", "n_kept"], "source", ["doc_id", "label"])


@register(
    "logistic_optimum",
    sql=f"""
    WITH {_PAGES_SQL}
    SELECT count(*) AS n_train, CAST((SELECT count(DISTINCT source) FROM train) + 4 AS BIGINT) AS n_weights, CAST(0 AS BIGINT) AS violations
    FROM train""",
)
def logistic_optimum(spark, sf_dir):
    """A logistic regression with the source's penalty, run to convergence: the loss's gradient over the
    train side meets the conditions of the optimum in the intercept and in every weight."""
    train, _ = plans._sides(plans.page_table(spark, sf_dir))
    held = train.persist()
    try:
        est = models.logistic_regression().setMaxIter(1000).setTol(1e-12)
        fitted = Pipeline(stages=[*plans._page_stages(), est]).fit(held)
        rows = fitted.transform(held).select(vector_to_array("features").alias("xs"), "label")
        model = fitted.stages[-1]
        checked = certificates.logistic_gradient(rows, "xs", "label", model.coefficients.toArray().tolist(), model.intercept, 0.3, 0.2)
        n = held.agg(F.count(F.lit(1))).first()[0]
        bad, weights = checked.agg(F.count_if(F.col("off") > 1e-4), F.count(F.lit(1))).first()
    finally:
        held.unpersist()
    return spark.createDataFrame([(n, weights, bad)], "n_train long, n_weights long, violations long")


@register(
    "svm_optimum",
    sql=f"""
    WITH {_PAGES_SQL}
    SELECT count(*) AS n_train, CAST((SELECT count(DISTINCT source) FROM train) + 4 AS BIGINT) AS n_weights, CAST(0 AS BIGINT) AS lowered
    FROM train""",
)
def svm_optimum(spark, sf_dir):
    """A linear SVM with the source's penalty, run to convergence: no step along the intercept or a
    weight lowers its loss over the train side."""
    train, _ = plans._sides(plans.page_table(spark, sf_dir))
    held = train.persist()
    try:
        fitted = Pipeline(stages=[*plans._page_stages(), models.linear_svc().setMaxIter(100).setTol(1e-6)]).fit(held)
        rows = fitted.transform(held).select(vector_to_array("features").alias("xs"), "label")
        model = fitted.stages[-1]
        steps = certificates.hinge_steps(rows, "xs", "label", model.coefficients.toArray().tolist(), model.intercept, 0.1)
        n = held.agg(F.count(F.lit(1))).first()[0]
        bad, weights = steps.agg(F.count_if(F.col("lowered") > 1e-4), F.count(F.lit(1))).first()
    finally:
        held.unpersist()
    return spark.createDataFrame([(n, weights, bad)], "n_train long, n_weights long, lowered long")


# ---- trees --------------------------------------------------------------------------------

_CUT = ["l_quantity", "l_discount", "l_tax"]
_GAINS_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, l_extendedprice AS y FROM lineitem" for f in _CUT
)
_STUMP_SQL = f"""
    v AS (SELECT feature, x, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM ({_GAINS_SQL}) GROUP BY feature, x),
    w AS (SELECT feature, x, lead(x) OVER (PARTITION BY feature ORDER BY x) AS nxt,
                 sum(n) OVER (PARTITION BY feature ORDER BY x) AS ln, sum(s) OVER (PARTITION BY feature ORDER BY x) AS ls,
                 sum(q) OVER (PARTITION BY feature ORDER BY x) AS lq, sum(n) OVER (PARTITION BY feature) AS n,
                 sum(s) OVER (PARTITION BY feature) AS s, sum(q) OVER (PARTITION BY feature) AS q FROM v),
    g AS (SELECT feature, (x + nxt) / 2 AS cut, ls / ln AS left_mean, (s - ls) / (n - ln) AS right_mean,
                 ((q - s * s / n) - (lq - ls * ls / ln) - ((q - lq) - (s - ls) * (s - ls) / (n - ln))) / n AS gain
          FROM w WHERE nxt IS NOT NULL)"""


@register(
    "cut_gains",
    sql=f"WITH {_STUMP_SQL} SELECT feature, round(cut, 6) AS cut, round(gain, 0) AS gain, round(left_mean, 3) AS left_mean, "
    "round(right_mean, 3) AS right_mean FROM g",
)
def cut_gains(spark, sf_dir):
    """For every cut of every feature, how much it lowers the variance of the price, and both means."""
    g = certificates.cut_gains(load(spark, sf_dir, "lineitem").select(*_CUT, "l_extendedprice"), _CUT, "l_extendedprice")
    return g.select(
        "feature", F.round("cut", 6).alias("cut"), F.round("gain", 0).alias("gain"), F.round("left_mean", 3).alias("left_mean"),
        F.round("right_mean", 3).alias("right_mean"),
    )


@register(
    "tree_stumps",
    sql=f"""
    WITH {_STUMP_SQL}, b AS (SELECT * FROM g ORDER BY gain DESC LIMIT 1)
    SELECT m.model, feature, round(cut, 6) AS cut, round(left_mean, 3) AS left_mean, round(right_mean, 3) AS right_mean
    FROM b, (SELECT unnest(['cut_gains', 'decision_tree', 'gbt', 'random_forest']) AS model) m""",
)
def tree_stumps(spark, sf_dir):
    """A decision tree of depth 1, a forest of one such tree over all rows and features, and the
    first step of boosting have the cut of greatest gain, with the means on both sides as leaves."""
    li = load(spark, sf_dir, "lineitem").select(*_CUT, F.col("l_extendedprice").alias("label"))
    data = VectorAssembler(inputCols=_CUT, outputCol="features").transform(li).select("features", "label").persist()
    common = {"maxDepth": 1, "maxBins": 64, "featuresCol": "features", "labelCol": "label", "seed": 42}
    try:
        trees = {
            "decision_tree": DecisionTreeRegressor(**common).fit(data),
            "random_forest": RandomForestRegressor(numTrees=1, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="all", **common).fit(data).trees[0],
            "gbt": GBTRegressor(maxIter=1, **common).fit(data).trees[0],
        }
    finally:
        data.unpersist()
    number = r"(-?[0-9.eE+-]+)"
    form = re.compile(rf"feature (\d+) <= {number}\)\s+Predict: {number}\s+Else.*\s+Predict: {number}")
    rows = []
    for name, tree in trees.items():
        feature, *values = form.search(tree.toDebugString).groups()
        rows.append((name, _CUT[int(feature)], *map(float, values)))
    fitted = spark.createDataFrame(rows, "model string, feature string, cut double, left_mean double, right_mean double")
    best = certificates.best_cut(certificates.cut_gains(li, _CUT, "label"))
    every = fitted.unionByName(best.select(F.lit("cut_gains").alias("model"), "feature", "cut", "left_mean", "right_mean"))
    r3 = lambda c: F.round(c, 3).alias(c)
    return every.select("model", "feature", F.round("cut", 6).alias("cut"), r3("left_mean"), r3("right_mean"))


#: A label that all three features have a part in.
_HEAVY = "l_quantity + 100 * l_discount + 100 * l_tax > 35"
_FLAG_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, CASE WHEN {_HEAVY} THEN 1.0 ELSE 0.0 END AS y FROM lineitem" for f in _CUT
)


@register(
    "forest_stump",
    sql=f"""
    WITH {_STUMP_SQL.replace(_GAINS_SQL, _FLAG_SQL)}, b AS (SELECT * FROM g ORDER BY gain DESC, feature, cut LIMIT 1)
    SELECT m.model, feature, round(cut, 6) AS cut FROM b, (SELECT unnest(['gini_gains', 'random_forest']) AS model) m""",
)
def forest_stump(spark, sf_dir):
    """A random forest classifier of one tree of depth 1 over all rows and features cuts where the Gini
    impurity falls most."""
    flag = F.when(F.expr(_HEAVY), 1.0).otherwise(0.0).alias("label")
    li = load(spark, sf_dir, "lineitem").select(*_CUT, flag)
    data = VectorAssembler(inputCols=_CUT, outputCol="features").transform(li).select("features", "label").persist()
    try:
        forest = RandomForestClassifier(numTrees=1, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="all", maxDepth=1, maxBins=64, seed=42)
        text = forest.fit(data).trees[0].toDebugString
    finally:
        data.unpersist()
    found = re.search(r"feature (\d+) <= (-?[0-9.eE+-]+)\)", text)
    fitted = spark.createDataFrame([("random_forest", _CUT[int(found[1])], float(found[2]))], "model string, feature string, cut double")
    best = certificates.best_cut(certificates.gini_gains(li, _CUT, "label"))
    both = fitted.unionByName(best.select(F.lit("gini_gains").alias("model"), "feature", "cut"))
    return both.select("model", "feature", F.round("cut", 6).alias("cut"))


# ---- comparison of regressors -------------------------------------------------------------

_LINES_SQL = f"""
    rows_ AS (SELECT CAST(l_quantity AS DOUBLE) AS x, l_extendedprice AS y,
                     {_SIDE.format(keys='l_orderkey, l_linenumber, l_partkey, l_suppkey')} AS side FROM lineitem),
    f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_slope(ln(y), x) AS lb, regr_intercept(ln(y), x) AS la
          FROM rows_ WHERE side < 8 AND y > 0),
    p AS (SELECT 'linear' AS model, y, a + b * x AS p FROM rows_, f WHERE side >= 8
          UNION ALL SELECT 'log_target', y, exp(la + lb * x) FROM rows_, f WHERE side >= 8),
    m AS (SELECT model, sqrt(avg(power(p - y, 2))) AS rmse, sqrt(avg(power(ln(greatest(p, 0) + 1) - ln(y + 1), 2))) AS rmsle
          FROM p GROUP BY model)"""


@register(
    "line_compare",
    sql=f"""
    WITH {_LINES_SQL}
    SELECT model, 'rmse' AS metric, round(rmse, 3) AS value FROM m
    UNION ALL SELECT model, 'rmsle', round(rmsle, 5) FROM m""",
)
def line_compare(spark, sf_dir):
    """The comparison loop over least squares on the label and on its logarithm (predictions
    taken back through exp), one feature each, fitted on the train side and scored on the test side."""
    li = load(spark, sf_dir, "lineitem")
    rows = li.select(
        F.col("l_quantity").cast("double").alias("l_quantity"), F.col("l_extendedprice").alias("label"), splits.hash_split(li, plans._ROW_KEYS).alias("part")
    )
    line = lambda label: models.linear_regression(label=label, reg=0.0, elastic_net=0.0).setSolver("normal")
    feature = VectorAssembler(inputCols=["l_quantity"], outputCol="features")
    log_of = lambda df: models.log_target(df.where(F.col("label") > 0))
    fits = [("linear", [feature, line("label")], plans._as_is, plans._as_is), ("log_target", [feature, line("log_label")], log_of, models.exp_back)]
    both = reduce(DataFrame.unionByName, plans._scores(rows, fits))
    places = F.when(F.col("metric") == "rmse", F.round("value", 3)).otherwise(F.round("value", 5))
    return both.select("model", "metric", places.alias("value"))
