"""Analyses over movie-rating files: users, items, ratings, genres (the source's data
exploration and recommendation-clustering scripts), composed from the operators.

Inputs are DataFrames as read by :func:`read_users` and friends (schemas in FIXTURES.md):
users ``(id, age, gender, occupation, postcode)``, items ``(itemid, title, release_date,
video_date, url, g0..g18)``, ratings ``(userid, itemid, rating, ts)``, genres
``(name, genre_id)``.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dates, numeric, strings
from tessera.operators import clusters, features, joins, models, ordering, profile
from tessera.sources.readers import delimited

N_GENRES = 19
USER_SCHEMA = "id INT, age INT, gender STRING, occupation STRING, postcode STRING"
RATING_SCHEMA = "userid INT, itemid INT, rating INT, ts BIGINT"
ITEM_SCHEMA = (
    "itemid INT, title STRING, release_date STRING, video_date STRING, url STRING, "
    + ", ".join(f"g{i} INT" for i in range(N_GENRES))
)
GENRE_SCHEMA = "name STRING, genre_id INT"


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, USER_SCHEMA, "|")


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, RATING_SCHEMA, "\t")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, ITEM_SCHEMA, "|", encoding="ISO-8859-1")


def read_genres(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, GENRE_SCHEMA, "|").where(F.col("name").isNotNull())


# ---- users ------------------------------------------------------------------------------------


def user_overview(users: DataFrame) -> DataFrame:
    """A01/A03 (D01): users, genders, occupations and postcodes, plus the age range."""
    return users.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.countDistinct("gender").alias("n_genders"),
        F.countDistinct("occupation").alias("n_occupations"),
        F.countDistinct("postcode").alias("n_postcodes"),
        F.min("age").alias("min_age"),
        F.max("age").alias("max_age"),
    )


def occupation_counts(users: DataFrame) -> DataFrame:
    """A04/O05 (D02): users per occupation, ascending by count."""
    return profile.ascending_counts(users, "occupation")


def age_histogram(users: DataFrame, bins: int = 20) -> DataFrame:
    """The age distribution (density, as the source's ``normed=True`` plot)."""
    return profile.histogram(users, "age", bins, density=True)


def occupation_one_hot(users: DataFrame) -> DataFrame:
    """Occupation index by frequency and its one-hot vector (last dropped)."""
    indexed = features.frequency_index(users, "occupation", "occupation_index")
    return features.one_hot(indexed.withColumn("occ_idx", F.col("occupation_index").cast("double")), ["occ_idx"])


def postcode_halves(users: DataFrame) -> DataFrame:
    """P04 (D09): postcode / 2, null for alphanumeric codes."""
    return users.select("id", "postcode", numeric.safe_half("postcode").alias("half"))


# ---- items --------------------------------------------------------------------------------------


def release_years(items: DataFrame, missing: int = 1900, base_year: int = 1998) -> DataFrame:
    """F02/F14/M19 (D05): release year (``missing`` when unknown), movie age at the base
    year, and the year with every missing one filled with the mean of the known ones."""
    y = items.select("itemid", strings.year_from_text("release_date", missing).alias("year"))
    y = y.withColumn("age", numeric.age_from_year("year", base_year))
    return features.fill_sentinel_with_mean(y, "year", missing, "year_filled")


def title_terms(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Titles without the year parenthesis, their term vocabulary and each
    title's 0/1 term vector as ``(itemid, term_id, value)``."""
    titles = items.select("itemid", strings.title_without_parenthesis("title").alias("clean_title"))
    vocab = features.term_vocabulary(titles, "clean_title", " ")
    return vocab, features.binary_bag(titles, "itemid", "clean_title", vocab)


def genre_names(items: DataFrame, genres: DataFrame, sep: str = ", ") -> DataFrame:
    """The names of each item's set genre flags, in genre-id order, from the genre
    table (unpivot the flags, join the names, regroup)."""
    flags = F.array(*[F.struct(F.lit(i).alias("genre_id"), F.col(f"g{i}").alias("flag")) for i in range(N_GENRES)])
    set_flags = items.select("itemid", F.inline(flags)).where(F.col("flag") == 1)
    named = set_flags.join(genres, "genre_id")
    ordered = F.array_sort(F.collect_list(F.struct("genre_id", "name")))
    out = named.groupBy("itemid").agg(F.array_join(F.transform(ordered, lambda s: s["name"]), sep).alias("genres"))
    return items.select("itemid").join(out, "itemid", "left").fillna({"genres": ""})


# ---- ratings ------------------------------------------------------------------------------------


def rating_overview(ratings: DataFrame) -> DataFrame:
    """Ratings, users, items, ratings per user and per item, and the
    rating's count / mean / population stdev / max / min and exact median."""
    base = ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct("userid").alias("n_users"),
        F.countDistinct("itemid").alias("n_items"),
        F.avg("rating").alias("mean"),
        F.stddev_pop("rating").alias("stdev"),
        F.max("rating").alias("max"),
        F.min("rating").alias("min"),
    )
    med = profile.median(ratings, "rating", "median").scalar()
    return base.select(
        "*",
        F.try_divide(F.col("n_ratings"), F.col("n_users")).alias("ratings_per_user"),
        F.try_divide(F.col("n_ratings"), F.col("n_items")).alias("ratings_per_item"),
        med.alias("median"),
    )


def rating_counts(ratings: DataFrame) -> DataFrame:
    """Ratings per value."""
    return profile.count_by(ratings, ["rating"]).orderBy("rating")


def ratings_per_user(ratings: DataFrame) -> DataFrame:
    """Ratings per user, by user (the group is counted, never materialised)."""
    return profile.count_by(ratings, ["userid"], "n_ratings").orderBy("userid")


def top_rated_for_user(ratings: DataFrame, items: DataFrame, user: int, k: int = 10) -> DataFrame:
    """E1 (P09/J02/O01/O06): a user's best rated items with titles, best first."""
    mine = ratings.where(F.col("userid") == user).join(items.select("itemid", "title"), ["itemid"], "left")
    return ordering.top_k(mine, [F.desc("rating"), "itemid"], k).select("itemid", "title", "rating")


def rating_hours(ratings: DataFrame) -> DataFrame:
    """UTC hour of each rating and its time-of-day band."""
    h = ratings.select("userid", "itemid", dates.hour_of_epoch("ts").alias("hour"))
    return h.withColumn("period", dates.time_of_day("hour"))


# ---- recommendation and clusters (the clustering script) --------------------------------------


def movie_clusters(
    ratings: DataFrame, items: DataFrame, genres: DataFrame, k: int = 5, seed: int = 1, top: int = 5
) -> dict[str, DataFrame]:
    """ALS factors, the mean of each factor vector, k-means and bisecting k-means on
    the item factors with their within-set costs, cluster sizes, and the ``top`` items
    nearest to each k-means centre with title and genre names.

    The returned DataFrames are plans; only model parameters (k centres) were collected.
    """
    spark = ratings.sparkSession
    rated = ratings.select("userid", "itemid", F.col("rating").cast("float")).persist()  # read by every iteration
    try:
        model = models.als(rated, "userid", "itemid", "rating")
    finally:
        rated.unpersist()
    means = models.factor_means(model)
    item_f = model.itemFactors.select(
        F.col("id").alias("itemid"), F.col("features").cast("array<double>").alias("arr")
    ).withColumn("features", array_to_vector("arr"))
    held = item_f.persist()
    try:
        km = models.kmeans(held, k=k, seed=seed, features="features", prediction="cluster")
        bk = models.bisecting_kmeans(held, k=k, seed=seed, features="features", prediction="bisect_cluster")
    finally:
        held.unpersist()
    assigned = km.transform(item_f).select("itemid", "arr", F.col("cluster").alias("prediction"))
    dist = models.distance_to_centre(assigned, models.centre_table(km, spark), "arr")
    b_assigned = bk.transform(item_f).select("itemid", "arr", F.col("bisect_cluster").alias("prediction"))
    b_dist = models.distance_to_centre(b_assigned, models.centre_table(bk, spark), "arr")
    costs = models.within_set_sse(dist).select(F.lit("kmeans").alias("model"), "wssse").unionByName(
        models.within_set_sse(b_dist).select(F.lit("bisecting_kmeans").alias("model"), "wssse")
    )
    sizes = profile.count_by(dist, ["prediction"], "size").orderBy("prediction")
    nearest = ordering.top_k_per_group(dist.select("prediction", "itemid", "dist"), ["prediction"], ["dist", "itemid"], top, "rnk")
    described = nearest.join(items.select("itemid", "title"), "itemid", "left").join(genre_names(items, genres), "itemid", "left")
    factor_stats = means.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.avg("f_mean").alias("mean"), F.stddev_samp("f_mean").alias("stddev"),
        F.min("f_mean").alias("min"), F.max("f_mean").alias("max"),
    )
    return {
        "factor_means": means,
        "factor_stats": factor_stats,
        "costs": costs,
        "sizes": sizes,
        "nearest": described.orderBy("prediction", "rnk"),
        "clusters": dist,
        "centres": clusters.group_centres(dist, "prediction", "arr"),
    }
