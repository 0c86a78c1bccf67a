"""Operator edge cases, invariants and plan shape."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import features, joins, ordering, positions, profile, splits


def test_impute_zero_is_missing(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 2.0), (3, 4.0)], "id int, x double")
    out = features.impute_mean(df, ["x"], 0.0).orderBy("id")
    assert [r.x for r in out.collect()] == [3.0, 2.0, 4.0]


def test_fill_sentinel_with_mean(spark):
    df = spark.createDataFrame([(1, 1900), (2, 1990), (3, 2000)], "id int, y int")
    out = features.fill_sentinel_with_mean(df, "y", 1900).orderBy("id")
    assert [r.y for r in out.collect()] == [1995.0, 1990.0, 2000.0]


def test_frequency_index_ties_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    m = {r.v: r.v_index for r in features.frequency_index_table(df, "v").collect()}
    assert m == {"c": 0, "a": 1, "b": 2}


def test_frequency_index_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(x,) for x in "zzyyyxxwvvvv"], "v string")
    ours = {r.v: r.v_index for r in features.frequency_index_table(df, "v").collect()}
    ml = StringIndexer(inputCol="v", outputCol="i", stringOrderType="frequencyDesc").fit(df)
    assert ours == {label: i for i, label in enumerate(ml.labels)}


def test_one_hot_drops_last(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "i double")
    out = features.one_hot(df, ["i"]).orderBy("i").collect()
    assert [r.i_vec.size for r in out] == [2, 2, 2]
    assert [list(r.i_vec.toArray()) for r in out] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in range(5)], "x double")
    h = profile.histogram(df, "x", 2).orderBy("bin").collect()
    assert [r.n for r in h] == [2, 3]
    d = profile.histogram(df, "x", 2, density=True).orderBy("bin").collect()
    assert [round(r.density, 6) for r in d] == [0.2, 0.3]


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r.n for r in profile.histogram(df, "x", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_rank_with_ties(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 1.0), ("g", 2.0)], "g string, d double")
    out = ordering.rank_within(df, ["g"], ["d"]).orderBy("d", "rank")
    assert [r["rank"] for r in out.collect()] == [1, 1, 3]


def test_top_k_per_group_plans_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = ordering.top_k_per_group(df, ["g"], [F.desc("v")], 2)
    assert sorted(r.v for r in top.collect()) == [994, 995, 996, 997, 998, 999]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_summary_is_population_stdev(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = profile.summary(df, "x").first()
    assert r.n == 5 and r.max == 10.0 and r.min == 1.0 and r.total == 20.0
    assert abs(r.stdev - np.std(vals)) < 1e-12 and abs(r.mean - 4.0) < 1e-12
    d = profile.describe_column(df, "x").first()
    assert abs(d.stddev - np.std(vals, ddof=1)) < 1e-12


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_exact_median_matches_numpy(spark, n):
    rng = np.random.default_rng(n)
    vals = rng.integers(0, 50, n).astype(float)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(5)
    got = profile.median(df, "x").first()[0]
    assert got == pytest.approx(float(np.median(vals)))


def test_exact_quantile_other_q(spark):
    vals = [float(v) for v in range(11)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert positions.exact_quantile(df, "x", 0.25).first()[0] == pytest.approx(np.quantile(vals, 0.25))


def test_global_index_dense_and_ordered_with_hot_key(spark):
    # a third of the rows share one key: positions still dense and in order
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    idx = positions.global_index(df.repartition(11), ["k", "id"], "pos")
    rows = idx.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(3000))
    keys = [(r.k, r.id) for r in rows]
    assert keys == sorted(keys)


def test_running_total(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(200)], "i int, w long").repartition(7)
    out = positions.running_total(df, ["i"], "w", "cum").orderBy("i").collect()
    assert [r.cum for r in out] == list(np.cumsum([i % 4 for i in range(200)]))


def test_same_answer_at_one_and_many_partitions(spark):
    df = spark.range(500).select((F.col("id") * 7 % 101).cast("double").alias("x"))
    one = profile.median(df.coalesce(1), "x").first()[0]
    many = profile.median(df.repartition(13), "x").first()[0]
    assert one == many


def test_positional_folds(spark):
    df = spark.range(10).withColumnRenamed("id", "row")
    out = splits.positional_folds(df, ["row"], 5).orderBy("row").collect()
    assert [r.fold for r in out] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_fold_split_partitions_rows(spark):
    folded = splits.positional_folds(spark.range(10).withColumnRenamed("id", "row"), ["row"], 5)
    train, test = splits.fold_split(folded, 2)
    assert sorted(r.row for r in test.collect()) == [4, 5]
    assert train.count() == 8 and train.join(test, "row", "left_semi").count() == 0


def test_holdout_per_key_with_cap(spark):
    rows = [(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "b")]
    df = spark.createDataFrame(rows, "pos long, user string")
    out = splits.holdout_per_key(df, "user", ["pos"], start=1, stop=2, max_test=3, id_col="pos").orderBy("pos")
    assert [r.part for r in out.collect()] == ["test", "test", "base", "test", "base"]
    uncapped = splits.holdout_per_key(df, "user", ["pos"], start=1, stop=2, max_test=0, id_col="pos").orderBy("pos")
    assert [r.part for r in uncapped.collect()] == ["test", "test", "base", "test", "test"]


def test_ordinal_within_hot_key(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, F.lit(1)).otherwise(F.col("id")).alias("u"), "id")
    out = splits.ordinal_within(df.repartition(9), "u", ["id"]).where(F.col("u") == 1).orderBy("id")
    assert [r.ordinal for r in out.collect()] == list(range(1, 1501))


def test_hash_split_is_partition_independent(spark):
    df = spark.range(2000)
    a = df.select("id", splits.hash_split(df, ["id"]).alias("p")).coalesce(1)
    b = df.repartition(17).select("id", splits.hash_split(df, ["id"]).alias("p"))
    assert a.exceptAll(b).count() == 0
    share = a.where(F.col("p") == "train").count() / 2000
    assert 0.75 < share < 0.85


@pytest.mark.parametrize("last_rows", [1, 7, 100_000])
def test_exact_quantile_narrows_to_the_same_answer(spark, last_rows):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(0, 100, 4001), 2).tolist() + [5.5] * 900
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double").repartition(4)
    for q in (0.0, 0.31, 0.5, 0.9999, 1.0):
        got = positions.exact_quantile(df, "x", q, accuracy=100, last_rows=last_rows).first()[0]
        assert got == pytest.approx(float(np.quantile(vals, q)))
    assert positions.exact_quantile(df.where("x > 1e9"), "x").first()[0] is None


def test_lookup_join_keeps_facts_without_entry(spark):
    facts, dim = spark.range(3), spark.createDataFrame([(1, "a")], "id long, name string")
    assert sorted((r.id, r.name or "") for r in joins.lookup_join(facts, dim, ["id"]).collect()) == [(0, ""), (1, "a"), (2, "")]


def test_vocabulary_and_binary_bag(spark):
    df = spark.createDataFrame([(1, "red ring"), (2, "red red bolt")], "k int, t string")
    vocab = features.term_vocabulary(df, "t")
    assert {r.term: r.term_id for r in vocab.collect()} == {"bolt": 0, "red": 1, "ring": 2}
    bag = features.binary_bag(df, "k", "t", vocab)
    assert sorted((r.k, r.term_id, r.value) for r in bag.collect()) == [(1, 1, 1.0), (1, 2, 1.0), (2, 0, 1.0), (2, 1, 1.0)]


def _skewed(spark, n=3000):
    # one key holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        ((F.col("id") * 7919) % 1009).cast("double").alias("v"),
        F.col("id"),
    ).repartition(9)


def test_top_k_per_group_hot_key_matches_brute_force(spark):
    df = _skewed(spark)
    got = sorted((r.k, r.id) for r in ordering.top_k_per_group(df, ["k"], [F.desc("v"), "id"], 3).collect())
    pdf = df.toPandas().sort_values(["k", "v", "id"], ascending=[True, False, True])
    want = sorted((int(k), int(i)) for k, g in pdf.groupby("k") for i in g["id"].head(3))
    assert got == want


def test_frequency_index_hot_category(spark):
    df = _skewed(spark)
    idx = {r.k: r.k_index for r in features.frequency_index_table(df, "k").collect()}
    assert idx[0] == 0 and sorted(idx.values()) == list(range(len(idx)))


def test_exact_median_hot_value(spark):
    df = _skewed(spark)
    vals = sorted(r.k for r in df.collect())
    want = (vals[len(vals) // 2 - 1] + vals[len(vals) // 2]) / 2
    assert profile.median(df, "k").first()[0] == pytest.approx(want)


def test_local_session_enables_skew_join(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
