"""Comparing tables, releases, schemas and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions import labels as L
from panelloom.functions import text as T
from panelloom.runtime import bounded


def multiset_difference(a: DataFrame, b: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with the signed surplus of ``a`` over ``b``: both directions of EXCEPT ALL in one grouped pass.

    Rows are counted per side before the shuffle; nulls are equal to each other. Columns default to the common ones.
    """
    names = columns or [c for c in a.columns if c in b.columns]
    both = a.select(*names, F.lit(1).alias("_s")).unionByName(b.select(*names, F.lit(-1).alias("_s")))
    return both.groupBy(*names).agg(F.sum("_s").alias("surplus")).where("surplus <> 0")


def multiset_report(a: DataFrame, b: DataFrame, by: str, columns: list[str] | None = None) -> DataFrame:
    """Per value of ``by``: rows only on the left and only on the right, repeats counted."""
    d = multiset_difference(a, b, columns)
    side = lambda s: F.sum(F.greatest(F.col("surplus") * s, F.lit(0))).cast("bigint")
    return d.groupBy(by).agg(side(1).alias("only_left"), side(-1).alias("only_right"))


def same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same columns and the same multiset of rows, whatever the order."""
    return set(a.columns) == set(b.columns) and multiset_difference(a, b).isEmpty()


def schema_difference(a: DataFrame, b: DataFrame) -> list[tuple[str, str, str, str]]:
    """(change, column, left type, right type) of added, removed and retyped columns; metadata only."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    out = [("removed", c, t, "") for c, t in x.items() if c not in y]
    out += [("added", c, "", t) for c, t in y.items() if c not in x]
    return out + [("retyped", c, x[c], y[c]) for c in x if c in y and x[c] != y[c]]


def digest(rows: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Per key: each column's distinct values in order, joined by ``|``; nulls and blanks are left out."""
    value = lambda c: T.strip(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return rows.groupBy(*key).agg(*[F.array_join(F.array_sort(F.collect_set(F.when(value(c) != "", value(c)))), "|").alias(c) for c in columns])


def keyed_changes(baseline: DataFrame, current: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """(key, change, column, old, new): keys added or removed, and columns whose digest changed."""
    a = digest(baseline, key, columns).select(*key, F.struct(*columns).alias("_a"))
    b = digest(current, key, columns).select(*key, F.struct(*columns).alias("_b"))
    both = a.join(b, key, "full_outer")
    cells = [F.struct(F.lit("changed").alias("change"), F.lit(c).alias("column"), F.col(f"_a.{c}").alias("old"), F.col(f"_b.{c}").alias("new")) for c in columns]
    whole = lambda change: F.array(F.struct(F.lit(change).alias("change"), F.lit("").alias("column"), F.lit("").alias("old"), F.lit("").alias("new")))
    ops = F.when(F.col("_b").isNull(), whole("removed")).when(F.col("_a").isNull(), whole("added")).otherwise(F.filter(F.array(*cells), lambda x: x["old"] != x["new"]))
    return both.select(*key, F.explode(ops).alias("c")).select(*key, "c.*")


def apply_waivers(issues: DataFrame, waivers: DataFrame) -> DataFrame:
    """Issues with their severity lowered to ``pass`` where a waiver matches; empty parts of a waiver match anything.

    ``issues``: (category, artifact, detail, severity); ``waivers``: (category, artifact, detail).
    """
    w = bounded(waivers.select(*[F.coalesce(T.strip(F.col(c)), F.lit("")).alias(f"w_{c}") for c in ("category", "artifact", "detail")]).where("w_category <> ''"))
    fits = (F.col("category") == F.col("w_category")) & F.col("w_artifact").isin("", F.col("artifact")) & F.col("w_detail").isin("", F.col("detail"))
    waived = issues.join(w, fits, "left_semi").withColumn("severity", F.lit("pass"))
    return issues.join(w, fits, "left_anti").unionByName(waived)


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issues per category and severity."""
    return issues.groupBy("category", "severity").agg(F.count(F.lit(1)).alias("n_issues"))


def verify_manifest(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Artifacts of a manifest with the reasons for which they fail, in a fixed order; empty expectations aren't checked.

    Both sides: (artifact_id, present, size_bytes, sha256, rows, columns), all as text.
    """
    e, a = expected.alias("e"), actual.alias("a")
    there, found = L.boolish(F.col("e.present")), L.boolish(F.coalesce(F.col("a.present").cast("string"), F.lit("")))
    both = there & found
    differ = lambda c: both & (F.coalesce(F.col(f"e.{c}"), F.lit("")) != F.coalesce(F.col(f"a.{c}"), F.lit("")))
    wanted = lambda c: F.coalesce(F.col(f"e.{c}"), F.lit("")) != ""
    reasons = F.concat_ws(
        ",", F.when(there & ~found, "missing_file"), F.when(differ("size_bytes"), "size_mismatch"), F.when(differ("sha256"), "sha256_mismatch"),
        F.when(wanted("rows") & differ("rows"), "parquet_rows_mismatch"), F.when(wanted("columns") & differ("columns"), "parquet_columns_mismatch"),
    )
    return e.join(a, F.col("e.artifact_id") == F.col("a.artifact_id"), "left").select(F.col("e.artifact_id").alias("artifact_id"), reasons.alias("failure_reasons"), (reasons == "").alias("passed"))
