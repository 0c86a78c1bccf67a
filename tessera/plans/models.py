"""Model, clustering and metric queries.

Stand-ins for the source's inputs, all derived from the driver tables:
ratings = (customer, part, 1 + floor(avg quantity / 10.01)) from orders x lineitem;
hourly-demand regression = lineitem (categories: return flag, line status, ship month,
ISO weekday, line number; numbers: quantity, discount, tax; label: extended price);
page classification = documents x labels (category: source; numbers: length and token
counts; label: quality). Splits are hash splits, so they do not depend on partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import dates
from tessera.functions.strings import tokens
from tessera.operators import clusters, models, profile, splits, text
from tessera.plans.registry import r6, register
from tessera.session import written
from tessera.sources.tables import load

# ---- recommendation -----------------------------------------------------------------------


def ratings(spark, sf_dir) -> DataFrame:
    """(user, item, rating 1-5) from orders x lineitem, one row per (customer, part)."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    pairs = li.join(o, li.l_orderkey == o.o_orderkey)
    return pairs.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg(
        (F.floor(F.avg("l_quantity") / 10.01) + 1).cast("float").alias("rating")
    )


_RATINGS_SQL = """
    r AS (SELECT o.o_custkey AS "user", l.l_partkey AS item,
                 CAST(floor(avg(l.l_quantity) / 10.01) + 1 AS FLOAT) AS rating
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
          GROUP BY o.o_custkey, l.l_partkey)"""


@register("ratings_table", sql=f'WITH {_RATINGS_SQL} SELECT "user", item, rating FROM r')
def ratings_table(spark, sf_dir):
    """The ALS input: one rating per (customer, part) pair, from the mean quantity."""
    return ratings(spark, sf_dir)


@register(
    "rating_distribution",
    sql=f"WITH {_RATINGS_SQL} SELECT rating, count(*) AS n FROM r GROUP BY rating ORDER BY rating",
)
def rating_distribution(spark, sf_dir):
    """A05 on the ratings: how many ratings of each value."""
    return ratings(spark, sf_dir).groupBy("rating").agg(F.count(F.lit(1)).alias("n")).orderBy("rating")


@register(
    "ratings_per_user",
    sql=f"""
    WITH {_RATINGS_SQL}, u AS (SELECT "user", count(*) AS n FROM r GROUP BY "user")
    SELECT count(*) AS n_users, min(n) AS min_n, max(n) AS max_n, round(median(n), 6) AS median_n,
           round(avg(n), 6) AS mean_n
    FROM u""",
)
def ratings_per_user(spark, sf_dir):
    """Ratings per user (no group kept), then their min, max, exact median, mean."""
    per_user = written(ratings(spark, sf_dir).groupBy("user").agg(F.count(F.lit(1)).alias("n")), "users")  # read by every step below
    median_n = profile.median(per_user, "n", "median_n").select(r6("median_n")).scalar()
    stats = per_user.agg(
        F.count(F.lit(1)).alias("n_users"), F.min("n").alias("min_n"), F.max("n").alias("max_n"), r6(F.avg("n")).alias("mean_n")
    )
    return stats.select("n_users", "min_n", "max_n", median_n.alias("median_n"), "mean_n")


@register("als_factors")
def als_factors(spark, sf_dir):
    """ALS (rank 10, 5 iterations, reg 0.01) and the mean of every user's
    and item's factor vector."""
    means, users, items = _als(spark, sf_dir)
    named = means.where("kind = 'user'").join(users.withColumnRenamed("user", "key"), F.col("id") == F.col("u"))
    other = means.where("kind = 'item'").join(items.withColumnRenamed("item", "key"), F.col("id") == F.col("i"))
    both = named.select("kind", "key", "f_mean").unionByName(other.select("kind", "key", "f_mean"))
    return both.select("kind", F.col("key").alias("id"), r6("f_mean").alias("f_mean"))


def _als(spark, sf_dir):
    """Factor means of densely numbered users and items, and the two numberings."""
    held, users, items = numbered_ratings(spark, sf_dir)
    return models.factor_means(models.als(held, "u", "i", "rating")), users, items


def numbered_ratings(spark, sf_dir):
    """The ratings by dense numbers ``(u, i, rating)`` and the numberings ``(user, u)``, ``(item, i)``. The ratings
    are written, and so are they with their numbers: what reads them does not join the tables again."""
    rated = written(ratings(spark, sf_dir), "ratings")
    users, items = models.dense_ids(rated, "user", "u"), models.dense_ids(rated, "item", "i")
    return written(rated.join(users, "user").join(items, "item").select("u", "i", "rating"), "numbered"), users, items


@register(
    "als_factor_ids",
    sql=f"""
    WITH {_RATINGS_SQL}
    SELECT 'user' AS kind, "user" AS id, 1 AS has_mean FROM (SELECT DISTINCT "user" FROM r)
    UNION ALL SELECT 'item', item, 1 FROM (SELECT DISTINCT item FROM r)""",
)
def als_factor_ids(spark, sf_dir):
    """Every rated user and item, and no other, gets a factor vector with a finite mean."""
    found = als_factors(spark, sf_dir)
    known = F.col("f_mean").isNotNull() & ~F.isnan("f_mean")
    return found.select("kind", "id", known.cast("int").alias("has_mean"))


# ---- clustering ---------------------------------------------------------------------------


def _embeddings(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("arr")).withColumn(
        "features", array_to_vector("arr")
    )


def _fitted(e, fit):
    held = e.persist()  # P14: read by every iteration of the fit, released after it
    try:
        return fit(held, k=5, seed=1, features="features", prediction="cluster")
    finally:
        held.unpersist()


def _assign(spark, sf_dir, fit):
    e = _embeddings(spark, sf_dir)
    model = _fitted(e, fit)
    assigned = model.transform(e).select("vec_id", F.col("cluster").alias("prediction"), "arr")
    centres = models.centre_table(model, spark)
    dist = models.distance_to_centre(assigned, centres, "arr")
    return dist.select("vec_id", "prediction", r6("dist").alias("dist"))


@register("kmeans_assign")
def kmeans_assign(spark, sf_dir):
    """K-means (k 5, seed 1) on the embeddings; cluster and squared distance."""
    return _assign(spark, sf_dir, models.kmeans)


@register("bisecting_assign")
def bisecting_assign(spark, sf_dir):
    """Bisecting k-means (k 5, seed 1) on the same vectors."""
    return _assign(spark, sf_dir, models.bisecting_kmeans)


@register("cluster_cost")
def cluster_cost(spark, sf_dir):
    """Within-set sum of squared distances of both clusterings."""
    km = models.within_set_sse(kmeans_assign(spark, sf_dir)).select(F.lit("kmeans").alias("model"), "wssse")
    bk = models.within_set_sse(bisecting_assign(spark, sf_dir)).select(F.lit("bisecting_kmeans").alias("model"), "wssse")
    return km.unionByName(bk).select("model", r6("wssse").alias("wssse"))


_CENTRE_SQL = """
    e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT label, i, avg(x) AS cx FROM e GROUP BY label, i),
    d AS (SELECT e.vec_id, e.label, sum((CAST(e.x AS DOUBLE) - c.cx) * (CAST(e.x AS DOUBLE) - c.cx)) AS dist
          FROM e JOIN c ON e.label = c.label AND e.i = c.i GROUP BY e.vec_id, e.label)"""


@register("centre_distance", sql=f"WITH {_CENTRE_SQL} SELECT vec_id, label, round(dist, 6) AS dist FROM d")
def centre_distance(spark, sf_dir):
    """The label as a fixed clustering; squared distance to the label's mean."""
    e = _embeddings(spark, sf_dir)
    centres = clusters.group_centres(e, "label", "arr")
    d = clusters.with_centre_distance(e.select("vec_id", "label", "arr"), centres, "label", "arr")
    return d.select("vec_id", "label", r6("dist").alias("dist"))


@register(
    "cluster_explain",
    sql=f"""
    WITH {_CENTRE_SQL},
    r AS (SELECT label, vec_id, dist,
                 CAST(rank() OVER (PARTITION BY label ORDER BY dist, vec_id) AS BIGINT) AS rnk FROM d),
    s AS (SELECT label, count(*) AS cluster_size FROM embeddings GROUP BY label)
    SELECT r.label, r.vec_id, round(r.dist, 6) AS dist, r.rnk, s.cluster_size
    FROM r JOIN s ON r.label = s.label WHERE r.rnk <= 5""",
)
def cluster_explain(spark, sf_dir):
    """Per cluster, its size and the five members closest to its centre."""
    e = _embeddings(spark, sf_dir)
    out = clusters.explain_clusters(e, "label", "vec_id", "arr", 5)
    return out.select("label", "vec_id", r6("dist").alias("dist"), "rnk", "cluster_size")


# ---- regression -----------------------------------------------------------------------------

_CATS = ["l_returnflag", "l_linestatus", "ship_month", "ship_dow", "l_linenumber"]
_NUMS = ["l_quantity", "l_discount", "l_tax"]
_ROW_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def demand_table(spark, sf_dir) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        *_ROW_KEYS,
        "l_returnflag",
        "l_linestatus",
        F.month("l_shipdate").cast("string").alias("ship_month"),
        dates.iso_weekday("l_shipdate").cast("string").alias("ship_dow"),
        *_NUMS,
        F.col("l_extendedprice").alias("label"),
        splits.hash_split(li, _ROW_KEYS).alias("part"),
    ).withColumn("l_linenumber", F.col("l_linenumber").cast("string"))


def _index_stage():
    return StringIndexer(inputCols=_CATS, outputCols=[c + "_idx" for c in _CATS], stringOrderType="frequencyDesc")


def _onehot_stages(out="features"):
    return [
        _index_stage(),
        OneHotEncoder(inputCols=[c + "_idx" for c in _CATS], outputCols=[c + "_vec" for c in _CATS]),
        VectorAssembler(inputCols=[c + "_vec" for c in _CATS] + _NUMS, outputCol=out),
    ]


def _plain_stages(out="features"):
    return [_index_stage(), VectorAssembler(inputCols=[c + "_idx" for c in _CATS] + _NUMS, outputCol=out)]


def _score(name, pred, label="label") -> DataFrame:
    return models.value_metrics(name, pred, label).select("model", "metric", r6("value").alias("value"))


def _sides(df):
    return df.where(F.col("part") == "train"), df.where(F.col("part") == "test")


def _scores(df, candidates) -> list[DataFrame]:
    """Fits each ``(name, stages, adjust)`` on the train side and scores it on the test side. The
    train side is held (P14) for the fits only."""
    train, test = _sides(df)
    held = train.persist()
    try:
        fitted = [(name, adjust, models.fit_and_score(stages, prepare(held), test)[1]) for name, stages, prepare, adjust in candidates]
    finally:
        held.unpersist()
    return [_score(name, adjust(pred)) for name, adjust, pred in fitted]


def _as_is(df):
    return df


@register("linreg_elasticnet")
def linreg_elasticnet(spark, sf_dir):
    """Elastic-net linear regression with and without one-hot categories."""
    fits = [
        (name, stages + [models.linear_regression()], _as_is, _as_is)
        for name, stages in (("linreg_onehot", _onehot_stages()), ("linreg_plain", _plain_stages()))
    ]
    return reduce(DataFrame.unionByName, _scores(demand_table(spark, sf_dir), fits))


@register(
    "linreg_elasticnet_1d",
    sql="""
    WITH s AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my, stddev_samp(l_quantity) AS sx,
                      stddev_samp(l_extendedprice) AS sy, covar_pop(l_quantity, l_extendedprice) AS cxy,
                      var_pop(l_quantity) AS vx
               FROM lineitem),
    b AS (SELECT *, cxy / (sx * sy) AS corr, vx / (sx * sx) AS one, 0.3 / sy * 0.8 AS l1, 0.3 / sy * 0.2 AS l2 FROM s),
    w AS (SELECT *, sign(corr) * greatest(abs(corr) - l1, 0) / (one + l2) * sy / sx AS slope FROM b)
    SELECT round(slope, 4) AS slope, round(my - slope * mx, 4) AS intercept FROM w""",
)
def linreg_elasticnet_1d(spark, sf_dir):
    """Elastic net (reg 0.3, l1 share 0.8) with one feature; the twin is its closed form, a soft
    threshold on the standardised covariance."""
    li = load(spark, sf_dir, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    model = models.linear_regression(max_iter=200).setTol(1e-12).fit(data)
    fitted = spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double")
    return fitted.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


def _demand_sides(spark, sf_dir):
    """Train and test side of the demand table, written once (P14) with what the fits read: no pass draws the
    split again, and no rows are held in memory beside those that a learner holds."""
    return _sides(written(demand_table(spark, sf_dir).select(*_CATS, *_NUMS, "label", "part"), "demand"))


def _predictions(stages, makers, train, test) -> dict:
    """``{name: predictions on test}`` of every ``{name: estimator}`` on the same features, made once."""
    made = models.prepared(stages, train, test)
    return {name: models.fit_and_score([est], *made)[1] for name, est in makers.items()}


def _tree(spark, sf_dir, kind):
    train, test = _demand_sides(spark, sf_dir)
    preds = {}
    for suffix, stages in (("plain", _plain_stages()), ("onehot", _onehot_stages())):
        preds |= _predictions(stages, {f"{kind}_{suffix}": models.tree_regressors()[kind]}, train, test)
    return reduce(DataFrame.unionByName, [_score(name, pred) for name, pred in preds.items()])


@register("dtree")
def dtree(spark, sf_dir):
    """Decision tree regressor (defaults), category indices vs one-hot."""
    return _tree(spark, sf_dir, "decision_tree")


@register("rforest")
def rforest(spark, sf_dir):
    """Random forest regressor (defaults)."""
    return _tree(spark, sf_dir, "random_forest")


@register("gbt")
def gbt(spark, sf_dir):
    """Gradient-boosted trees regressor (defaults)."""
    return _tree(spark, sf_dir, "gbt")


@register("regression_compare")
def regression_compare(spark, sf_dir):
    """Every regressor on the same split, plus linear regression on log(label)
    with predictions taken back through exp."""
    train, test = _demand_sides(spark, sf_dir)
    _, linear = models.fit_and_score(_onehot_stages() + [models.linear_regression()], train, test)
    on_log = _onehot_stages() + [models.linear_regression(label="log_label")]
    _, log_pred = models.fit_and_score(on_log, models.log_target(train.where(F.col("label") > 0)), test)
    preds = {"linear_regression": linear, **_predictions(_plain_stages(), models.tree_regressors(), train, test)}
    preds["linear_regression_log_target"] = models.exp_back(log_pred)
    return reduce(DataFrame.unionByName, [_score(name, pred) for name, pred in preds.items()])


@register(
    "linreg_simple",
    sql="""
    WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope,
                      regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)
    SELECT round(f.slope, 3) AS slope, round(f.intercept, 3) AS intercept,
           round(sqrt(avg(power(l.l_extendedprice - (f.intercept + f.slope * l.l_quantity), 2))), 3) AS rmse
    FROM lineitem l, f GROUP BY f.slope, f.intercept""",
)
def linreg_simple(spark, sf_dir):
    """One-feature least squares (no regularisation) and its in-sample RMSE."""
    li = load(spark, sf_dir, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    model = models.linear_regression(reg=0.0, elastic_net=0.0, max_iter=100).setSolver("normal").fit(data)
    err = models.rmse(model.transform(data))
    return err.select(
        F.round(F.lit(float(model.coefficients[0])), 3).alias("slope"),
        F.round(F.lit(float(model.intercept)), 3).alias("intercept"),
        F.round("rmse", 3).alias("rmse"),
    )


# ---- classification -----------------------------------------------------------------------

def page_table(spark, sf_dir) -> DataFrame:
    d = load(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    lab = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    words = text.remove_stop_words(d.join(lab, "doc_id").withColumn("words", tokens("text")), "words", "kept")
    return words.select(
        "doc_id",
        "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size("words").cast("double").alias("n_tokens"),
        F.size("kept").cast("double").alias("n_kept"),
        "label",
        splits.hash_split(d, ["doc_id"]).alias("part"),
    )


def _page_stages():
    return [
        StringIndexer(inputCol="source", outputCol="source_idx", handleInvalid="keep"),
        OneHotEncoder(inputCols=["source_idx"], outputCols=["source_vec"]),
        VectorAssembler(inputCols=["source_vec", "n_chars", "n_tokens", "n_kept"], outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def _classify(spark, sf_dir, name, est):
    train, test = _sides(page_table(spark, sf_dir))
    held = train.persist()  # P14: read by several fits and every optimizer iteration
    try:
        _, pred = models.fit_and_score(_page_stages() + [est], held, test)
    finally:
        held.unpersist()
    return models.class_metrics(name, pred).select("model", "metric", r6("value").alias("value"))


@register("logreg")
def logreg(spark, sf_dir):
    """Logistic regression (10 iterations, reg 0.3, elastic net 0.2)."""
    return _classify(spark, sf_dir, "logistic_regression", models.logistic_regression())


@register("linsvc")
def linsvc(spark, sf_dir):
    """Linear SVM (10 iterations, reg 0.1)."""
    return _classify(spark, sf_dir, "linear_svc", models.linear_svc())


@register("naive_bayes")
def naive_bayes(spark, sf_dir):
    """Multinomial naive Bayes on the unscaled (non-negative) features."""
    return _classify(spark, sf_dir, "naive_bayes", models.naive_bayes("features_raw"))


@register("rf_classifier")
def rf_classifier(spark, sf_dir):
    """Random forest (150 trees, subsampling 0.8, depth 10)."""
    return _classify(spark, sf_dir, "random_forest", models.random_forest_classifier())


# ---- metrics in closed form -----------------------------------------------------------------

_RULE_LABEL = "CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END"
_RULE_PRED = "CASE WHEN l_discount >= 0.05 THEN 1.0 ELSE 0.0 END"


def _rule_classes(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("l_discount") >= 0.05, 1.0).otherwise(0.0).alias("prediction"),
    )


def _rule_values(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1000.0).alias("prediction"))


@register(
    "accuracy",
    sql=f"SELECT round(avg(CASE WHEN ({_RULE_LABEL}) = ({_RULE_PRED}) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM lineitem",
)
def accuracy(spark, sf_dir):
    """L17 against a fixed rule: share of lines whose rule prediction equals the label."""
    return models.accuracy(_rule_classes(spark, sf_dir)).select(r6("accuracy").alias("accuracy"))


@register(
    "weighted_recall",
    sql=f"""
    WITH c AS (SELECT {_RULE_LABEL} AS label, {_RULE_PRED} AS prediction FROM lineitem),
    k AS (SELECT label, count(*) AS n_c, sum(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS tp
          FROM c GROUP BY label)
    SELECT round(sum(tp) / sum(n_c), 6) AS weighted_recall FROM k""",
)
def weighted_recall(spark, sf_dir):
    """L18."""
    return models.weighted_recall(_rule_classes(spark, sf_dir)).select(r6("weighted_recall").alias("weighted_recall"))


@register(
    "rmse",
    sql="SELECT round(sqrt(avg(power(l_quantity * 1000.0 - l_extendedprice, 2))), 6) AS rmse FROM lineitem",
)
def rmse(spark, sf_dir):
    """L19 against a fixed rule prediction."""
    return models.rmse(_rule_values(spark, sf_dir)).select(r6("rmse").alias("rmse"))


@register(
    "rmsle",
    sql="""
    SELECT round(sqrt(avg(power(ln(l_quantity * 1000.0 + 1) - ln(l_extendedprice + 1), 2))), 6) AS rmsle
    FROM lineitem""",
)
def rmsle(spark, sf_dir):
    """F13."""
    return models.rmsle(_rule_values(spark, sf_dir)).select(r6("rmsle").alias("rmsle"))
