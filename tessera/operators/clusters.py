"""Cluster explanation (L05, L06): centres, distances, sizes and closest members.

Works for any assignment column: a fitted model's ``prediction`` or a given label. Centres
are per-cluster means (``Summarizer.mean``, a partial aggregate), joined back by cluster.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import squared_distance
from tessera.operators.ordering import top_k_per_group


def group_centres(df: DataFrame, cluster: str, features_arr: str) -> DataFrame:
    """L05 for a fixed assignment: ``(cluster, centre array, cluster_size)``, the mean of each
    dimension and the number of members, in one aggregate."""
    vec = array_to_vector(F.col(features_arr))
    return df.groupBy(cluster).agg(
        vector_to_array(Summarizer.mean(vec)).alias("centre"), F.count(F.lit(1)).alias("cluster_size")
    )


def with_centre_distance(df: DataFrame, centres: DataFrame, cluster: str, features_arr: str, out: str = "dist") -> DataFrame:
    """Squared distance of each row to the centre of its cluster."""
    return df.join(centres, cluster).withColumn(out, squared_distance(features_arr, "centre")).drop("centre")


def explain_clusters(df: DataFrame, cluster: str, key: str, features_arr: str, k: int = 5) -> DataFrame:
    """For every cluster, its size and its ``k`` members closest to the centre (ties
    kept): ``(cluster, key, dist, rnk, cluster_size)``. All clusters, not the first four (D14).
    """
    centres = group_centres(df, cluster, features_arr)
    dist = with_centre_distance(df.select(cluster, key, features_arr), centres, cluster, features_arr)
    members = dist.select(cluster, key, "dist", "cluster_size")
    closest = top_k_per_group(members, [cluster], [F.col("dist").asc(), F.col(key).asc()], k, "rnk")
    return closest.select(cluster, key, "dist", F.col("rnk").cast("long").alias("rnk"), "cluster_size")
