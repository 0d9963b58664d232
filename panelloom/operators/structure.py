"""Who is in an unbalanced panel, when, and under which identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions import labels as L
from panelloom.functions import text as T

CLASSES = ["CONTROL", "SECTOR", "ICLEVEL", "LEVEL", "CARNEGIE", "C18BASIC", "C21BASIC"]
ID_NULLS = ("", "nan", "none", "<na>", "nat")


def unit_patterns(panel: DataFrame, identifier: str = "OPEID", name: str = "INSTNM") -> DataFrame:
    """One row per unit: its years, how they sit in the panel's window, its identifiers and most frequent name.

    Rows without unit or year are ignored. Repeats of a unit and year count once for the years. Names are counted per
    value before they are ranked (most frequent, then first in order), so no list of rows is kept per unit.
    """
    rows = panel.where("UNITID is not null and year is not null").select(
        F.col("UNITID").cast("bigint").alias("UNITID"), F.col("year").cast("int").alias("year"), T.null_if_token(F.col(identifier), ID_NULLS).alias("ident"),
        T.null_if_token(F.col(name), ID_NULLS).alias("name"),
    )
    window = rows.agg(F.min("year").alias("start"), F.max("year").alias("end")).first()
    start, end = F.lit(window.start).cast("int"), F.lit(window.end).cast("int")
    years = rows.groupBy("UNITID").agg(
        F.array_sort(F.collect_set("year")).alias("years"), F.count_distinct("ident").alias("opeid_count"), F.max("ident").alias("_id")
    )
    names = rows.where("name is not null").groupBy("UNITID", "name").agg(F.count(F.lit(1)).alias("n"))
    best = names.groupBy("UNITID").agg(F.min(F.struct(-F.col("n"), F.col("name"))).alias("b")).select("UNITID", F.col("b.name").alias("instnm_example"))
    out = years.join(best, "UNITID", "left")
    first, last, n = F.col("years")[0], F.element_at("years", -1), F.size("years")
    gap = n < last - first + 1
    return out.select(
        "UNITID", F.array_join(F.col("years").cast("array<string>"), "|").alias("years_present_list"), first.alias("first_year"), last.alias("last_year"),
        n.alias("observed_years"), (last - first + 1 - n).alias("missing_internal_years"), (first > start).alias("entered_after_start"),
        (last < end).alias("exited_before_end"), gap.alias("intermittent_gap"), ((last < end) | gap).alias("possible_selection_risk"),
        L.presence_pattern(first, last, n, start, end).alias("pattern"), "opeid_count",
        F.when(F.col("opeid_count") == 1, F.col("_id")).otherwise("").alias("stable_opeid"), (F.col("opeid_count") > 1).alias("possible_identifier_linkage_case"),
        F.coalesce("instnm_example", F.lit("")).alias("instnm_example"),
    )


def structure_summary(panel: DataFrame, patterns: DataFrame) -> DataFrame:
    """Twelve numbers of the panel, one row each."""
    a = panel.agg(
        F.min("year").cast("bigint").alias("year_start"), F.max("year").cast("bigint").alias("year_end"), F.count_distinct("year").alias("years_total"),
        F.count(F.lit(1)).alias("institution_year_rows"), F.count_distinct("UNITID").alias("distinct_unitids"),
    )
    b = patterns.agg(
        F.count_if(F.col("pattern") == "always_present").alias("always_present_unitids"), F.count_if("entered_after_start").alias("entered_after_start_unitids"),
        F.count_if("exited_before_end").alias("exited_before_end_unitids"), F.count_if(F.col("pattern") == "entered_and_exited").alias("entered_and_exited_unitids"),
        F.count_if("intermittent_gap").alias("intermittent_gap_unitids"), F.count_if("possible_selection_risk").alias("possible_selection_risk_unitids"),
        F.count_if("possible_identifier_linkage_case").alias("possible_identifier_linkage_cases"),
    )
    cells = lambda one: one.select(F.explode(F.create_map(*[x for c in one.columns for x in (F.lit(c), F.col(c))])).alias("metric", "value"))
    return cells(a).unionByName(cells(b))


def entry_exit(panel: DataFrame, patterns: DataFrame) -> DataFrame:
    """Per year: units present, entering, leaving after it, with gaps, and kept until the next year."""
    units = panel.where("UNITID is not null and year is not null").select(F.col("UNITID").cast("bigint").alias("UNITID"), F.col("year").cast("int").alias("year")).distinct()
    span = patterns.select("UNITID", "first_year", "last_year", "intermittent_gap")
    kept = units.select("UNITID", (F.col("year") - 1).alias("year"), F.lit(1).alias("next"))
    rows = units.join(span, "UNITID").join(kept, ["UNITID", "year"], "left")
    out = rows.groupBy("year").agg(
        F.count(F.lit(1)).alias("unitids_present"), F.count_if(F.col("first_year") == F.col("year")).alias("entrants"),
        F.count_if(F.col("last_year") == F.col("year")).alias("_last"), F.count_if("intermittent_gap").alias("intermittent_unitids_present"), F.count("next").alias("retained_to_next_year"),
    )
    final = F.col("year") == F.lit(units.agg(F.max("year")).first()[0]).cast("int")
    return out.select(
        "year", "unitids_present", "entrants", F.when(final, F.lit(0)).otherwise(F.col("_last")).cast("bigint").alias("exits_after_year"), "intermittent_unitids_present",
        F.when(~final, F.col("retained_to_next_year")).alias("retained_to_next_year"),
        F.when(~final, F.round(F.col("retained_to_next_year") / F.col("unitids_present"), 9)).alias("retention_rate"),
    )


def pattern_counts(patterns: DataFrame) -> DataFrame:
    """Units per presence pattern."""
    return patterns.groupBy("pattern").agg(F.count(F.lit(1)).alias("institution_count"))


def linkage(panel: DataFrame, identifier: str = "OPEID") -> DataFrame:
    """Per year, and overall under a null year: units, identifiers, rows without one, identifiers that units share."""
    rows = panel.where("UNITID is not null and year is not null").select("year", "UNITID", F.coalesce(T.strip(F.col(identifier)), F.lit("")).alias("ident"))
    by_year = rows.groupBy("year").agg(F.count_distinct("UNITID").alias("distinct_unitids"), F.count_if(F.col("ident") == "").alias("rows_missing_opeid"))
    groups = rows.where("ident <> ''").groupBy("year", "ident").agg(F.count_distinct("UNITID").alias("n")).groupBy("year").agg(
        F.count(F.lit(1)).alias("distinct_opeid"), F.count_if(F.col("n") > 1).alias("shared_opeid_groups"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("unitids_in_shared_opeids")
    )
    counts = ["distinct_opeid", "shared_opeid_groups", "unitids_in_shared_opeids"]
    yearly = by_year.join(groups, "year", "left").fillna(0, counts).withColumns({"unitids_with_multiple_opeid": F.lit(None).cast("bigint"), "opeids_with_multiple_unitids": F.lit(None).cast("bigint")})
    whole = rows.agg(F.count_distinct("UNITID").alias("distinct_unitids"), F.count_if(F.col("ident") == "").alias("rows_missing_opeid"), F.count_distinct(F.when(F.col("ident") != "", F.col("ident"))).alias("distinct_opeid"))
    several = rows.where("ident <> ''").groupBy("UNITID").agg(F.count_distinct("ident").alias("n")).agg(F.count_if(F.col("n") > 1).alias("unitids_with_multiple_opeid"))
    shared = rows.where("ident <> ''").groupBy("ident").agg(F.count_distinct("UNITID").alias("n")).agg(F.count_if(F.col("n") > 1).alias("opeids_with_multiple_unitids"))
    overall = one_row([whole, several, shared]).withColumns(
        {"year": F.lit(None).cast("int"), "shared_opeid_groups": F.lit(None).cast("bigint"), "unitids_in_shared_opeids": F.lit(None).cast("bigint")}
    )
    return yearly.unionByName(overall)


def class_cells(panel: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(UNITID, year, variable, value) of the classification columns that the panel has; blank values are left out."""
    have = [c for c in (columns or CLASSES) if c in panel.columns]
    if not have:
        raise KeyError("the panel has no classification column")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), T.strip(F.col(c).cast("string")).alias("value")) for c in have]))
    return panel.where("UNITID is not null and year is not null").select("UNITID", "year", cells.alias("c")).select("UNITID", "year", "c.*").where("value <> ''")


def class_frequency(panel: DataFrame) -> DataFrame:
    """Units per variable, year and value: one pass for all variables."""
    return class_cells(panel).groupBy("variable", "year", "value").agg(F.count_distinct("UNITID").alias("institution_count"))


def class_stability(panel: DataFrame) -> DataFrame:
    """Per variable: units observed, units whose value changed, and their share."""
    units = class_cells(panel).groupBy("variable", "UNITID").agg((F.min("value") != F.max("value")).alias("changed"))
    return units.groupBy("variable").agg(
        F.count(F.lit(1)).alias("units_observed"), F.count_if("changed").alias("units_changed"), F.round(F.count_if("changed") / F.count(F.lit(1)), 9).alias("change_rate")
    )


def continuity(panel: DataFrame, flags: list[str], identifier: str = "OPEID") -> DataFrame:
    """One row per unit: years, gaps, identifiers, flag values other than 0 and 1, and what makes joining it risky."""
    value = lambda c: T.null_if_token(F.col(c).cast("string"), ID_NULLS)
    odd = [F.array_join(F.array_sort(F.collect_set(F.when(~value(f).isin("0", "1"), value(f)))), "|").alias(f"_{f}") for f in flags]
    one = panel.where("UNITID is not null").groupBy("UNITID").agg(
        F.array_sort(F.collect_set("year")).alias("years"), F.array_join(F.array_sort(F.collect_set(value(identifier))), "|").alias("opeid_values"),
        F.count_distinct(value(identifier)).alias("opeid_count"), *odd,
    )
    n = F.size("years")
    gap = (n > 0) & (F.element_at("years", -1) - F.col("years")[0] + 1 > n)
    review = F.concat_ws(";", *[F.when(F.col(f"_{f}") != "", F.concat(F.lit(f"{f}:"), F.col(f"_{f}"))) for f in flags])
    risks = F.concat_ws(
        "|", F.when(F.col("opeid_count") > 1, "multi_opeid"), F.when(F.col("prch_review_values") != "", "parent_child_flag_observed"),
        F.when(F.col("has_internal_gap"), "internal_year_gap"), F.when(F.col("years_observed_count") == 1, "single_year_observation"),
    )
    out = one.select(
        "UNITID", F.col("years")[0].alias("first_year"), F.element_at("years", -1).alias("last_year"), n.alias("years_observed_count"),
        F.array_join(F.col("years").cast("array<string>"), "|").alias("years_observed"), gap.alias("has_internal_gap"), "opeid_values", "opeid_count", review.alias("prch_review_values"),
    )
    return out.withColumn("join_risk_flags", risks).withColumn("join_risk_level", F.when(F.col("join_risk_flags") != "", "review").otherwise("standard"))


def benchmark_metrics(panel: DataFrame, columns: list[str]) -> DataFrame:
    """(year, metric, column, actual): rows, units, and per column filled cells, sum and mean; all in one pass."""
    number = lambda c: T.read_plain_double(F.col(c).cast("string"))
    aggs = [F.count(F.lit(1)).cast("double").alias("r"), F.count_distinct("UNITID").cast("double").alias("u")]
    for i, c in enumerate(columns):
        aggs += [F.count(F.col(c)).cast("double").alias(f"n{i}"), F.sum(number(c)).alias(f"s{i}"), F.avg(number(c)).alias(f"m{i}")]
    one = panel.groupBy("year").agg(*aggs)
    slots = [("panel_rows", "", "r"), ("distinct_unitid", "", "u")]
    for i, c in enumerate(columns):
        slots += [("nonnull_count", c, f"n{i}"), ("sum", c, f"s{i}"), ("mean", c, f"m{i}")]
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(c).alias("column"), F.col(x).alias("actual")) for m, c, x in slots]))
    return one.select("year", cells.alias("c")).select("year", "c.*")


def reconcile(metrics: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Benchmarks with their actual value; PASS if it is within the larger of both tolerances, FAIL otherwise or without a value."""
    rows = benchmarks.select(
        "benchmark_id", F.col("year").try_cast("int").alias("year"), F.lower(T.strip(F.col("metric"))).alias("metric"), F.coalesce(T.strip(F.col("column")), F.lit("")).alias("column"),
        *[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in ("expected_value", "tolerance_abs", "tolerance_rel")],
    )
    near = F.abs(F.col("actual") - F.col("expected_value")) <= F.greatest(F.col("tolerance_abs"), F.abs("expected_value") * F.col("tolerance_rel"))
    return rows.join(metrics, ["year", "metric", "column"], "left").withColumn("status", F.when(F.coalesce(near, F.lit(False)), "PASS").otherwise("FAIL"))


def one_row(parts: list[DataFrame]) -> DataFrame:
    """Aggregates of one row each side by side, without a join."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
