"""Data-quality rules that run as aggregates and report one row per rule."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named check.

    A row rule gives ``row_test``, true for an offending row; any other rule gives
    ``failures``, which returns the offending rows of the table.
    """

    name: str
    failures: Callable[[DataFrame], DataFrame] | None = None
    row_test: Column | None = None
    severity: str = "error"
    where: str | None = None

    def run(self, df: DataFrame) -> DataFrame:
        scoped = df if self.where is None else df.filter(self.where)
        return scoped.filter(self.row_test) if self.failures is None else self.failures(scoped)

    def offends(self) -> Column:
        scope = F.lit(True) if self.where is None else F.expr(self.where)
        return scope & self.row_test


def not_null(col: str, **options) -> Rule:
    return Rule(f"not_null_{col}", row_test=F.col(col).isNull(), **options)


def unique(*cols: str, **options) -> Rule:
    """Each value (or combination) occurs once; NULL combinations are not compared."""

    def repeated(df: DataFrame) -> DataFrame:
        present = df.dropna(subset=list(cols)) if len(cols) == 1 else df
        return present.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")

    return Rule(f"unique_{'_'.join(cols)}", repeated, **options)


def accepted(col: str, values: Sequence, **options) -> Rule:
    return Rule(f"accepted_{col}", row_test=~F.col(col).isin(*values), **options)


def references(col: str, parent: DataFrame, parent_col: str, **options) -> Rule:
    """Every non-NULL value exists in the parent table."""

    def orphans(df: DataFrame) -> DataFrame:
        values = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
        return values.join(parent.select(F.col(parent_col).alias(col)).distinct(), col, "left_anti")

    return Rule(f"references_{col}", orphans, **options)


def disjoint(col: str, other: DataFrame, other_col: str, **options) -> Rule:
    """No value occurs in the other table."""

    def shared(df: DataFrame) -> DataFrame:
        values = df.select(col).distinct()
        return values.join(other.select(F.col(other_col).alias(col)).distinct(), col, "left_semi")

    return Rule(f"disjoint_{col}", shared, **options)


def covered_by(col: str, next_layer: DataFrame, next_col: str, **options) -> Rule:
    """Every staged key reaches the next layer."""

    def lost(df: DataFrame) -> DataFrame:
        return df.select(col).distinct().join(next_layer.select(F.col(next_col).alias(col)).distinct(), col, "left_anti")

    return Rule(f"covered_{col}", lost, **options)


def holds(name: str, test: Column, **options) -> Rule:
    """Business rule: rows for which the test is false fail; unknown passes."""
    return Rule(name, row_test=~test, **options)


def consistent(name: str, flag: Column, listed: Column, **options) -> Rule:
    """A yes/no flag agrees with whether the text it speaks of is filled; a missing flag means no."""
    empty = F.trim(F.coalesce(listed, F.lit(""))) == ""
    return Rule(name, row_test=F.coalesce(flag == "Sim", F.lit(False)) == empty, **options)


def labelled(name: str, label: Column, **options) -> Rule:
    """Business rule whose failures carry the label of what went wrong."""

    def failing(df: DataFrame) -> DataFrame:
        return df.withColumn("failure", label).filter(F.col("failure").isNotNull())

    return Rule(name, failing, **options)


def check_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """A rule on a column the table lacks is a mistake in the rule."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in table: {missing}")


def run_rules(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``table_name, rule, severity, status, n_failed``: one row per rule.

    All row rules share one scan; rules on groups or other tables run on their own.
    """
    severity = {rule.name: rule.severity for rule in rules}
    row_rules = [rule for rule in rules if rule.row_test is not None]
    counted = [
        rule.run(df).agg(F.count(F.lit(1)).alias("n_failed")).select(F.lit(rule.name).alias("rule"), "n_failed")
        for rule in rules
        if rule.row_test is None
    ]
    if row_rules:
        one_row = df.agg(*[F.count_if(rule.offends()).alias(f"r{n}") for n, rule in enumerate(row_rules)])
        pairs = [F.struct(F.lit(rule.name).alias("rule"), F.col(f"r{n}").alias("n_failed")) for n, rule in enumerate(row_rules)]
        counted.append(one_row.select(F.inline(F.array(*pairs))))
    results = reduce(DataFrame.unionByName, counted)
    level = F.lit(None).cast("string")
    for name, value in severity.items():
        level = F.when(F.col("rule") == name, value).otherwise(level)
    leveled = results.withColumn("table_name", F.lit(table)).withColumn("severity", level)
    return leveled.select("table_name", "rule", "severity", _status().alias("status"), "n_failed")


def _status() -> Column:
    return F.when(F.col("n_failed") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")


def summary(results: DataFrame) -> DataFrame:
    """Rules and offending rows per status, with the names of the rules."""
    names = F.array_join(F.array_sort(F.collect_list("rule")), ", ")
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n_rules"), F.sum("n_failed").alias("n_failed"), names.alias("rules"))


def raise_on_failure(results: DataFrame) -> None:
    """Stop a run when a rule of severity ``error`` failed; one row per rule is read."""
    failed = [f"{r['table_name']}.{r['rule']} ({r['n_failed']})" for r in results.filter("status = 'fail'").collect()]
    if failed:
        raise RuntimeError("data-quality rules failed: " + ", ".join(failed))


def store_failures(table: str, df: DataFrame, rules: Sequence[Rule], path: str) -> DataFrame:
    """Store the offending rows of all row rules below ``path``, a folder per rule, and return ``run_rules`` of them.

    One scan: each row is tagged with the rules it breaks and written once per rule, and the
    counts are taken while they are written. Rules on groups or other tables have rows of
    another shape and are not taken.
    """
    if other := [rule.name for rule in rules if rule.row_test is None]:
        raise ValueError(f"no rules on single rows: {other}")
    seen = Observation()
    counted = df.observe(seen, *[F.count_if(rule.offends()).alias(rule.name) for rule in rules])
    broken = F.array_compact(F.array(*[F.when(rule.offends(), F.lit(rule.name)) for rule in rules]))
    tagged = counted.withColumn("_broken", broken).filter(F.size("_broken") > 0)
    tagged = tagged.select("*", F.explode("_broken").alias("rule")).drop("_broken")
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rule").parquet(path)
    counts = [(rule.name, rule.severity, seen.get[rule.name]) for rule in rules]
    results = df.sparkSession.createDataFrame(counts, "rule string, severity string, n_failed long").withColumn("table_name", F.lit(table))
    return results.select("table_name", "rule", "severity", _status().alias("status"), "n_failed")


def reconcile(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Totals of two one-row frames with the same columns, side by side with differences."""
    cols = left.columns
    side = lambda df, tag: df.select(F.lit(tag).alias("_side"), *cols)
    both = side(left, "l").unionByName(side(right, "r"))
    picked = []
    for c in cols:
        lval = F.max(F.when(F.col("_side") == "l", F.col(c)))
        rval = F.max(F.when(F.col("_side") == "r", F.col(c)))
        picked += [lval.alias(f"left_{c}"), rval.alias(f"right_{c}"), (lval - rval).alias(f"diff_{c}")]
    return both.agg(*picked).select(F.lit(name).alias("check_name"), "*")
