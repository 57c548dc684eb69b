"""Person matching: similar names within a block, and exact key rules.

Similar names are found by equality of signatures instead of comparing all names
of a block. Two names that the rule accepts always share a signature:

* edit distance at most k: cut the shorter name into k + 1 pieces; one piece
  occurs unchanged in the longer name, moved by at most k places;
* token containment at least c: of any ``m - ceil(c * m) + 1`` words of the name
  with fewer words (m), one also occurs in the other name. The rarest words are
  taken, so a word that half the names carry is hardly ever used.

Shared signatures only nominate pairs; the rule itself decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.graph import connected_components, label_rows
from caseloom.operators.skew import attach_group, block_join, key_hash, skew_join
from caseloom.session import cut_lineage


def containment(a: Column, b: Column) -> Column:
    """Share of the shorter token list found in the other."""
    x, y = F.split(a, " "), F.split(b, " ")
    return F.size(F.array_intersect(x, y)) / F.least(F.size(x), F.size(y))


def similar(a: Column, b: Column, edit_max: int, cont_min: float) -> Column:
    return (F.levenshtein(a, b, edit_max) >= 0) | (containment(a, b) >= cont_min)


def _piece(size: str, number: str, pieces: int) -> tuple[str, str]:
    """SQL for the 0-based start and the width of a piece of a text of this size."""
    start = f"int({number} * {size} div {pieces})"
    return start, f"(int(({number} + 1) * {size} div {pieces}) - {start})"


def _index_signatures(values: DataFrame, edit_max: int) -> DataFrame:
    """Pieces of every name as the shorter side: length, piece number, text."""
    pieces = edit_max + 1
    start, width = _piece("length(v)", "i", pieces)
    cut = values.filter(F.length("v") > edit_max).select("b", "v", F.explode(F.lit(list(range(pieces)))).alias("i"))
    short = values.filter(F.length("v") <= edit_max)
    return cut.select(
        "b", "v", F.length("v").alias("n"), "i", F.expr(f"substring(v, {start} + 1, {width})").alias("s")
    ).unionByName(short.select("b", "v", F.lit(0).alias("n"), F.lit(-1).alias("i"), F.lit("").alias("s")))


def _probe_signatures(values: DataFrame, edit_max: int) -> DataFrame:
    """Substrings of every name as the longer side that may equal a piece.

    For a name longer by ``gap`` a piece can have moved by at most half of what
    the remaining edits allow in either direction.
    """
    pieces = edit_max + 1
    places = [
        F.struct(F.lit(gap).alias("gap"), F.lit(i).alias("i"), F.lit(move).alias("move"))
        for gap in range(edit_max + 1)
        for i in range(pieces)
        for move in range(-((edit_max - gap) // 2), (edit_max + gap) // 2 + 1)
    ]
    at = values.select("b", "v", F.explode(F.array(*places)).alias("p")).select("b", "v", "p.*")
    start, width = _piece("n", "i", pieces)
    sized = at.withColumn("n", F.length("v") - F.col("gap")).filter(F.col("n") > edit_max)
    placed = sized.withColumn("at", F.expr(f"{start} + move")).withColumn("width", F.expr(width))
    inside = placed.filter("at >= 0 and at + width <= length(v)")
    short = values.filter(F.length("v") <= 2 * edit_max)
    return inside.select("b", "v", "n", "i", F.expr("substring(v, at + 1, width)").alias("s")).unionByName(
        short.select("b", "v", F.lit(0).alias("n"), F.lit(-1).alias("i"), F.lit("").alias("s"))
    )


def similar_values(
    df: DataFrame, block: str, value: str, edit_max: int = 2, cont_min: float = 0.8
) -> DataFrame:
    """Distinct similar values per block: ``(block, value_a, value_b)`` with a < b."""
    values = df.select(F.col(block).alias("b"), F.col(value).alias("v")).filter("v <> ''").distinct()
    values = cut_lineage(values, "values")
    tokens = values.select("b", "v", F.explode(F.array_distinct(F.split("v", " "))).alias("t"))
    ranked = attach_group(tokens, ["b", "t"], {"df": F.count(F.lit(1))}, ["v"])
    # the words of one value: bounded by its length
    by_rarity = ranked.groupBy("b", "v").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("ts"))
    m = F.size("ts")
    prefix = F.slice("ts", F.lit(1), m - F.ceil(F.lit(cont_min) * m - F.lit(1e-9)).cast("int") + 1)
    word = [F.lit(-1).alias("n"), F.lit(-2).alias("i")]
    rare = by_rarity.select("b", "v", *word, F.explode(F.transform(prefix, lambda p: p["t"])).alias("s"))
    index = _index_signatures(values, edit_max).unionByName(rare).withColumnRenamed("v", "x")
    probe = _probe_signatures(values, edit_max).unionByName(tokens.select("b", "v", *word, F.col("t").alias("s")))
    # a word of very many names, or the empty piece of short ones, is met block by block
    nominated = (
        block_join(index, probe.withColumnRenamed("v", "y"), ["b", "n", "i", "s"], "x", "y")
        .filter(F.col("x") != F.col("y"))
        .select("b", F.least("x", "y").alias("value_a"), F.greatest("x", "y").alias("value_b"))
        .distinct()
    )
    accepted = nominated.filter(similar(F.col("value_a"), F.col("value_b"), edit_max, cont_min))
    return accepted.withColumnRenamed("b", block)


@dataclass(frozen=True)
class FuzzyRule:
    edit_max: int = 2
    cont_min: float = 0.8


def _name_links(
    people: DataFrame, id_col: str, name_a: str, name_b: str, rule: FuzzyRule, block: Column | None
) -> tuple[DataFrame, DataFrame]:
    """Named rows, and links between distinct name pairs whose both names are similar.

    The two similarity relations are found separately on distinct values and then
    combined by equality joins. A pair of names is represented by its least id and
    linked to itself as well.
    """
    block = F.soundex(name_a) if block is None else block
    named = people.select(
        F.col(id_col).alias("id"), F.col(name_a).alias("a"), F.col(name_b).alias("b"), block.alias("k")
    ).filter("a <> '' and b <> ''")
    named = cut_lineage(named, "names")
    nodes = cut_lineage(named.groupBy("k", "a", "b").agg(F.min("id").alias("id")), "nodes")
    sim_a = _both_ways(similar_values(nodes, "k", "a", rule.edit_max, rule.cont_min), nodes, "k", "a")
    sim_b = _both_ways(similar_values(nodes, "k", "b", rule.edit_max, rule.cont_min), nodes, "k", "b")
    step_a = nodes.join(sim_a.withColumnsRenamed({"value": "a", "other": "a2"}), ["k", "a"])
    step_b = step_a.join(sim_b.withColumnsRenamed({"value": "b", "other": "b2"}), ["k", "b"])
    targets = nodes.select("k", F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("id").alias("id2"))
    links = step_b.join(targets, ["k", "a2", "b2"]).select("k", "a", "b", "id", "id2")
    return named, cut_lineage(links, "links")


def _both_ways(pairs: DataFrame, df: DataFrame, block: str, value: str) -> DataFrame:
    """Similar values in both directions, each value also similar to itself."""
    forward = pairs.select(block, F.col("value_a").alias("value"), F.col("value_b").alias("other"))
    backward = pairs.select(block, F.col("value_b").alias("value"), F.col("value_a").alias("other"))
    same = df.select(block, F.col(value).alias("value")).distinct().withColumn("other", F.col("value"))
    return forward.unionByName(backward).unionByName(same)


def fuzzy_dedup(
    people: DataFrame,
    id_col: str,
    name_a: str,
    name_b: str,
    rule: FuzzyRule = FuzzyRule(),
    mode: str = "components",
    block: Column | None = None,
) -> DataFrame:
    """Rows with cluster columns, matched on two similar names within a block.

    ``components`` follows matches to the end; ``one_hop`` labels a row with the
    least id among itself and its direct matches.
    """
    named, links = _name_links(people, id_col, name_a, name_b, rule, block)
    if mode == "one_hop":
        roots = links.groupBy("k", "a", "b").agg(F.min("id2").alias("component"))
    elif mode == "components":
        components = connected_components(links.filter("id < id2"), "id", "id2")
        names = links.filter("id = id2").select("k", "a", "b", "id")
        labelled = names.join(components, names["id"] == components["node"], "left")
        roots = labelled.select("k", "a", "b", F.coalesce("component", "id").alias("component"))
    else:
        raise ValueError("mode is 'components' or 'one_hop'")
    labels = skew_join(named, roots, ["k", "a", "b"], ["id"], how="inner")
    return label_rows(people, id_col, labels.select(F.col("id").alias("node"), "component"))


@dataclass(frozen=True)
class KeyRule:
    """Columns that must agree, and a test of these columns that a row must pass to take part."""

    columns: Sequence[str]
    valid: Column


# Document numbers that stand for "unknown".
SENTINEL_DOCS = ("99999999999", "00000000000", "11111111111")


def person_rules(doc: str, name: str, mother: str, father: str, birth: str) -> list[KeyRule]:
    """The six exact combinations that make two registrations one person."""
    has_doc = F.length(doc) == 11
    known_doc = has_doc & ~F.col(doc).isin(*SENTINEL_DOCS)
    has_name, has_mother, has_father = F.col(name) != "", F.col(mother) != "", F.col(father) != ""
    has_birth = F.col(birth).isNotNull()
    return [
        KeyRule([doc], known_doc),
        KeyRule([name, mother], has_name & has_mother),
        KeyRule([name, doc, birth], has_name & has_doc & has_birth),
        KeyRule([mother, doc, birth], has_mother & has_doc & has_birth),
        KeyRule([mother, father, birth], has_mother & has_father & has_birth),
        KeyRule([mother, father, doc], has_mother & has_father & has_doc),
    ]


def rule_keys(df: DataFrame, id_col: str, rules: Sequence[KeyRule], within: Sequence[str] = ()) -> DataFrame:
    """``(id, *within, rule, key)``: the keys that link a row, all rules in one pass.

    Rows that agree in all columns of a rule agree in those of a rule with fewer of them, too.
    Where a row passes the test of that one, its key there links the same rows and more, and the
    longer key is left out.
    """

    def needed(n: int, rule: KeyRule) -> Column:
        test = rule.valid
        for i, other in enumerate(rules):
            if set(other.columns) < set(rule.columns) or (i < n and set(other.columns) == set(rule.columns)):
                test = test & ~F.coalesce(other.valid, F.lit(False))
        return test

    keyed = [
        F.when(
            needed(n, rule),
            F.struct(F.lit(n).alias("rule"), F.array(*[F.col(c).cast("string") for c in rule.columns]).alias("key")),
        )
        for n, rule in enumerate(rules)
    ]
    return df.select(
        F.col(id_col).alias("id"), *within, F.explode(F.filter(F.array(*keyed), lambda k: k.isNotNull())).alias("_k")
    ).select("id", *within, "_k.rule", "_k.key")


def exact_rule_edges(df: DataFrame, id_col: str, rules: Sequence[KeyRule], within: Sequence[str] = ()) -> DataFrame:
    """Edge from every row to the least id that shares a rule's key, all rules in one pass; an edge may come more than once."""
    # read three times below: to count, to reduce and to join
    key = [*within, "rule", "key"]
    long = cut_lineage(rule_keys(df, id_col, rules, within).withColumn("_hash", key_hash(*key)), "keys")
    # the hash first: rows are sorted by a number, texts are compared where it is equal
    least = attach_group(long, ["_hash", *key], {"least_id": F.min("id")}, ["id", "rule"])
    edges = least.filter(F.col("id") != F.col("least_id"))
    return edges.select(F.col("id").alias("id_a"), F.col("least_id").alias("id_b"))


def exact_rule_dedup(df: DataFrame, id_col: str, rules: Sequence[KeyRule], within: Sequence[str] = ()) -> DataFrame:
    """Rows with the connected component of their exact matches."""
    edges = exact_rule_edges(df, id_col, rules, within)
    return label_rows(df, id_col, connected_components(edges, "id_a", "id_b"))


def similar_name_counts(df: DataFrame, block: str, value: str, rule: FuzzyRule = FuzzyRule()) -> DataFrame:
    """Similar names per block with their distance, containment and row counts."""
    # read by both joins below and by their key counts
    pairs = cut_lineage(similar_values(df, block, value, rule.edit_max, rule.cont_min), "pairs")
    sizes = df.groupBy(block, value).agg(F.count(F.lit(1)).alias("n"))
    a = sizes.select(block, F.col(value).alias("value_a"), F.col("n").alias("n_a"))
    b = sizes.select(block, F.col(value).alias("value_b"), F.col("n").alias("n_b"))
    scored = pairs.withColumn("distance", F.levenshtein("value_a", "value_b")).withColumn(
        "containment", F.round(containment(F.col("value_a"), F.col("value_b")), 4)
    )
    with_a = skew_join(scored, a, [block, "value_a"], ["value_b"])
    return skew_join(with_a, b, [block, "value_b"], ["value_a"])
