"""Matches that are kept between loads: new rows join stored components by their own edges alone.

A store has three tables. ``keys`` holds one row that has a rule's key, for each key seen so
far; ``nodes`` the component a row came into with its load; ``roots`` the component that
has taken in another one since. A load looks up its own keys and nodes only, contracts its edges to the
present components of their ends and searches components among those. What has no part in
it is neither read nor written, but for ``roots``, which has a row per component that was taken in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators.graph import connected_components, label_rows
from caseloom.operators.matching import KeyRule, rule_keys
from caseloom.operators.skew import attach_group, key_hash
from caseloom.operators.stored import BUCKETS, merge_buckets, read_store, rows_with_keys
from caseloom.session import cut_lineage


def _pair(a: str, b: str, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(a, kind), T.StructField(b, kind)])


def components_so_far(spark: SparkSession, path: str, kind: T.DataType) -> DataFrame:
    """``(node, component)`` of a store; component = least node, as ``connected_components`` has it."""
    nodes = read_store(spark, f"{path}/nodes", _pair("node", "component", kind))
    roots = read_store(spark, f"{path}/roots", _pair("component", "root", kind))
    return nodes.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))


def add_edges(edges: DataFrame, a: str, b: str, path: str, buckets: int = BUCKETS) -> None:
    """Bring stored components up to new edges; NULL ends link nothing.

    The nodes of the edges are looked up, components are searched among their present
    components, and these alone get new roots. Running it again, also after it broke off,
    leaves the same components.
    """
    spark = edges.sparkSession
    edges = cut_lineage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna().filter("a <> b").distinct(), "new-edges")
    kind = edges.schema["a"].dataType
    ends = cut_lineage(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    known = rows_with_keys(ends, f"{path}/nodes", ["node"], _pair("node", "component", kind), buckets)
    roots = read_store(spark, f"{path}/roots", _pair("component", "root", kind))
    present = known.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    # a node that was not seen yet is a component of its own
    present = cut_lineage(ends.join(present, "node", "left").withColumn("is_new", F.col("component").isNull()), "present")
    now = present.select("node", F.coalesce("component", "node").alias("c"))
    first, second = now.toDF("a", "ca"), now.toDF("b", "cb")
    contracted = edges.join(first, "a").join(second, "b").select("ca", "cb").filter("ca <> cb")
    merged = cut_lineage(connected_components(contracted, "ca", "cb").filter("node <> component").toDF("c", "root"), "merged-roots")
    # components that were taken in, and those they had taken in before
    earlier = roots.join(merged.toDF("root", "_to"), "root").select("component", F.col("_to").alias("root"))
    merge_buckets(earlier.unionByName(merged.select(F.col("c").alias("component"), "root")), f"{path}/roots", ["component"], buckets)
    added = present.filter("is_new").select("node").join(merged.toDF("node", "root"), "node", "left")
    merge_buckets(added.select("node", F.coalesce("root", "node").alias("component")), f"{path}/nodes", ["node"], buckets)


def add_rows(df: DataFrame, id_col: str, rules: Sequence[KeyRule], path: str, within: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    """Match new rows by exact rules against each other and all rows of earlier loads.

    Each key's row is looked up among the stored keys; a row with a key that is known is linked to the
    row that has it, any other to the least new row with that key. Rows that were loaded
    before may come again.
    """
    key = [*within, "rule", "key"]
    long = cut_lineage(rule_keys(df, id_col, rules, within), "keys")
    schema = T.StructType([f for f in long.schema.fields if f.name != "id"] + [T.StructField("holder", long.schema["id"].dataType)])
    known = cut_lineage(rows_with_keys(long, f"{path}/keys", key, schema, buckets), "known-keys")
    # the hash first: rows are sorted by a number, texts are compared where it is equal
    hashed = long.withColumn("_hash", key_hash(*key))
    least = attach_group(hashed, ["_hash", *key], {"least_id": F.min("id")}, ["id", "rule"]).drop("_hash")
    linked = least.join(known, key, "left").withColumn("to", F.coalesce("holder", "least_id"))
    linked = cut_lineage(linked.select(*key, "id", "to", F.col("holder").isNull().alias("is_new")), "linked")
    add_edges(linked, "id", "to", path, buckets)
    # last, so that a load that broke off is linked again in full
    fresh = linked.filter("is_new").select(*key, F.col("to").alias("holder")).distinct()
    merge_buckets(fresh, f"{path}/keys", key, buckets)


def stored_clusters(df: DataFrame, id_col: str, path: str) -> DataFrame:
    """Rows with the cluster columns of ``label_rows``, from the stored components."""
    return label_rows(df, id_col, components_so_far(df.sparkSession, path, df.schema[id_col].dataType))
