"""From wide source tables to long attribute-value rows: melt, dictionary join, deduplication and key gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions import text as T
from panelloom.runtime import bounded

PANEL_COLUMNS = [
    "year", "UNITID", "varname", "varnumber", "value", "varTitle", "longDescription", "DataType", "format", "Fieldwidth", "imputationvar",
    "imputation_value", "source_file", "access_table_name",
]
PANEL_KEY = ["UNITID", "year", "varnumber", "source_file"]


class GateError(ValueError):
    """A quality gate that failed; raised after its evidence has been computed."""


def melt(table: DataFrame, ids: list[str], columns: list[str] | None = None, imputation: dict[str, str] | None = None) -> DataFrame:
    """One row per id and column: (ids, varname, value, imputation_value). Null values are kept.

    ``imputation`` names the flag column of a variable; its value is picked from a map built once per row, so flags need
    no second melt and no join. Columns are cast to text; a missing flag column gives null.
    """
    names = columns or [c for c in table.columns if c not in ids]
    flags = {v: f for v, f in (imputation or {}).items() if f in table.columns}
    picked = [
        F.struct(F.lit(c.upper()).alias("varname"), F.col(f"`{c}`").cast("string").alias("value"), (F.col(f"`{flags[c]}`").cast("string") if c in flags else F.lit(None).cast("string")).alias("imputation_value"))
        for c in names
    ]
    return table.select(*ids, F.explode(F.array(*picked)).alias("_m")).select(*ids, "_m.*")


def nonblank(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows in which some column is neither null nor blank."""
    cols = columns or [c for c in PANEL_COLUMNS if c in df.columns]
    return df.where(~reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) == "" for c in cols]))


def join_dictionary(rows: DataFrame, dictionary: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Left join to a dictionary that must be unique on its key (GateError otherwise, with the first offending keys)."""
    side = dictionary.select(*on, *columns)
    double = side.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(5).collect()
    if double:
        raise GateError(f"dictionary key {on} is not unique: {[tuple(r)[:-1] for r in double]}")
    return rows.join(bounded(side), on, "left")


def dedupe(panel: DataFrame, priority: dict[str, int] | None = None) -> DataFrame:
    """One row per (UNITID, year, varnumber, source_file), blank rows dropped.

    The first by source priority, access table and varname is kept; equal ones are told apart by value, imputation value
    and all other columns, nulls last, so that the result never depends on partitioning. Only the minimum of one struct is
    kept per key, so repeats are combined before the shuffle and a hot key never gathers in one task.
    """
    rank = F.lit(999)
    for name, r in (priority or {}).items():
        rank = F.when(F.upper("source_file") == name, r).otherwise(rank)
    lead = ["access_table_name", "varname", "value", "imputation_value"]
    rest = [c for c in panel.columns if c not in (*lead, *PANEL_KEY)]
    order = [rank.alias("_r")]
    for c in (*lead, *rest):
        order += [F.col(c).isNull().alias(f"_n_{c}"), F.col(c)]
    kept = nonblank(panel).groupBy(*PANEL_KEY).agg(F.min(F.struct(*order)).alias("_m"))
    return kept.select(*[F.col(c) if c in PANEL_KEY else F.col(f"_m.{c}").alias(c) for c in panel.columns])


def key_nulls(panel: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(key, n_missing): null or blank keys, in one pass."""
    names = keys or ["year", "UNITID", "varnumber", "source_file"]
    counts = [F.count_if(F.coalesce(F.trim(F.col(k).cast("string")), F.lit("")) == "").alias(k) for k in names]
    return panel.agg(*counts).select(F.explode(F.create_map(*[x for k in names for x in (F.lit(k), F.col(k))])).alias("key", "n_missing"))


def check_stitched(panel: DataFrame, years: list[int]) -> None:
    """Gate: exactly the expected years and no missing key."""
    bad = [r.key for r in key_nulls(panel).where("n_missing > 0").collect()]
    lost, odd = year_difference(panel, years)
    if bad or lost or odd:
        raise GateError(f"missing keys in {bad}; years missing {lost}, unexpected {odd}")


def year_difference(panel: DataFrame, years: list[int]) -> tuple[list[int], list[int]]:
    """Years that are wanted and missing, and those that are there unasked; null years aside."""
    seen = {r.year for r in panel.select("year").where("year is not null").distinct().collect()}  # one number per year
    return sorted(set(years) - seen), sorted(seen - set(years))


def release_gate(inventory: DataFrame, years: list[int], wanted: str = "final", strict: bool = True) -> DataFrame:
    """(year, release_type) of wanted years whose release is of another type or unknown; GateError if strict and there are any."""
    kinds = inventory.where(F.col("year").isin(years)).groupBy("year").agg(F.max(F.lower(T.strip(F.col("release_type")))).alias("release_type"))
    asked = inventory.sparkSession.createDataFrame([(y,) for y in years], "year int")
    odd = asked.join(kinds, "year", "left").where(F.coalesce(F.col("release_type"), F.lit("")) != wanted.lower())
    if strict and (rows := odd.orderBy("year").collect()):
        raise GateError(f"no {wanted} release: {[(r.year, r.release_type) for r in rows]}")
    return odd


def unit_gate(panel: DataFrame, strict: bool = False) -> DataFrame:
    """Tables with rows without UNITID, as :func:`missing_units` counts them; GateError if strict and there are any."""
    bad = missing_units(panel).where("n_missing > 0")
    if strict and (rows := bad.orderBy("year", "access_table_name").limit(10).collect()):
        raise GateError(f"rows without UNITID: {[(r.year, r.access_table_name, r.n_missing) for r in rows]}")
    return bad


def missing_units(panel: DataFrame) -> DataFrame:
    """Rows without UNITID per year and table."""
    return panel.groupBy("year", "access_table_name").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("UNITID").isNull()).alias("n_missing"))


def exclusion_reason(rows: Column, selected: Column, by_table: Column, by_source: Column) -> Column:
    """Why a source table adds nothing, from its row count and the dictionary rows that match it in several ways."""
    return (
        F.when(rows == 0, "source_table_has_zero_rows").when(selected > 0, "dictionary_rows_found_no_column_overlap")
        .when(by_table > 0, "dictionary_rows_found_for_access_table_but_source_selection_failed")
        .when(by_source > 0, "dictionary_rows_found_for_source_file_but_access_table_missing").otherwise("missing_dictionary_rows_for_source_file")
    )


def stitch(parts: list[DataFrame]) -> DataFrame:
    """Yearly frames on top of each other; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def first_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row per key by explicit order columns, nulls last."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def source_key(df: DataFrame) -> DataFrame:
    """Long rows with normalised names, numbers and sources."""
    return df.withColumns({"varname": T.varname(F.col("varname")), "varnumber": F.coalesce(T.varnumber(F.col("varnumber")), F.lit("")), "source_file": T.source_file(F.col("source_file"))})
