"""Connected components of an undirected match graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from caseloom.operators.skew import HEAVY_ROWS, attach_group
from caseloom.session import cut_lineage, remove_folder, run_path

MAX_ROUNDS = 60


def _written(edges: DataFrame) -> tuple[DataFrame, str, tuple]:
    """The round's edges, their folder, and a fingerprint taken while they were written."""
    seen = Observation()
    counted = edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")
    )
    path = run_path(edges.sparkSession, "edges")
    counted.write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path), path, (seen.get["n"], seen.get["h"])


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of the edge list; component = least node.

    Alternating star contraction: neighbours above a node, then below it, are
    linked to the least neighbour until nothing changes. The number of rounds
    grows with the logarithm of the graph, not with its longest chain. Each round
    is two group steps that split hub nodes, and its result is written out, so a
    lost executor costs one round at most. A node that is the least neighbour of none
    takes no part in the rounds: it gets the component of its own least neighbour in the end.
    """
    ordered = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter(F.col("hi") != F.col("lo"))
    given, given_folder, (size, _) = _written(ordered)
    starred = cut_lineage(attach_group(given, ["hi"], {"m": F.min("lo")}, ["lo"], at_most=size), "starred")
    remove_folder(edges.sparkSession, given_folder)
    inner = starred.select(F.col("lo").alias("hi")).distinct().withColumn("inner", F.lit(True))
    parents = cut_lineage(starred.select("hi", "m").distinct().join(inner, "hi", "left"), "parents")
    linked = starred.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    core = linked.unionByName(parents.filter("inner").select("hi", F.col("m").alias("lo"))).distinct()
    current, folder, before = _written(core)
    for _ in range(MAX_ROUNDS):
        size = 2 * before[0]
        stars = _large_star(current, size)
        if size > HEAVY_ROWS:  # read more than once below
            stars = cut_lineage(stars, "stars")
        last = folder
        current, folder, after = _written(_small_star(stars, size))
        remove_folder(edges.sparkSession, last)
        if after == before:
            labels = current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            of_parent = labels.toDF("m", "component")
            leaves = parents.filter("inner is null").join(of_parent, "m", "left")
            # read more than once by whoever joins it
            found = labels.unionByName(leaves.select(F.col("hi").alias("node"), F.coalesce("component", "m").alias("component")))
            found = cut_lineage(found, "components")
            return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
        before = after
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _large_star(edges: DataFrame, size: int) -> DataFrame:
    """Link every larger neighbour of a node to the least of node and neighbours."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    with_least = attach_group(both, ["u"], {"m": F.min("v")}, ["v"], at_most=size)
    # repeated links are dropped by the step after this one
    return with_least.filter(F.col("v") > F.col("u")).select(F.col("v").alias("hi"), F.least("m", "u").alias("lo"))


def _small_star(edges: DataFrame, size: int) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    with_least = attach_group(edges, ["hi"], {"m": F.min("lo")}, ["lo"], at_most=size)
    linked = with_least.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(
        with_least.select("hi", F.col("m").alias("lo"))
    )
    return linked.filter(F.col("hi") != F.col("lo")).distinct()


def label_rows(df: DataFrame, id_col: str, components: DataFrame) -> DataFrame:
    """Rows with ``cluster_id`` (own id when unmatched), ``cluster_size``, ``is_duplicate``."""
    labels = components.select(F.col("node").alias(id_col), "component")
    joined = df.join(labels, id_col, "left")  # ids are unique on both sides
    clustered = joined.withColumn("cluster_id", F.coalesce("component", F.col(id_col))).drop("component")
    # the sketch needs the components alone, not the rows joined to them
    known = components.select(F.col("component").alias("cluster_id"))
    sized = attach_group(clustered, ["cluster_id"], {"cluster_size": F.count(F.lit(1))}, [id_col], count_on=known)
    return sized.withColumn("is_duplicate", F.col("cluster_id") != F.col(id_col))
