"""The long-to-wide build: staging, lanes, conflict gates, indicator collapse, pivot, typing and lineage.

Every key holds the year, so the build is one plan over all years instead of a loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions import labels as L
from panelloom.functions import text as T
from panelloom.runtime import bounded

CONFLICT_KEY = ["UNITID", "year", "varnumber", "source_file"]
STAGE = ["UNITID", "year", "varname", "value", "value_norm", "source_file", "varnumber"]
NUMERIC_FORMATS = T.NUMERIC_MARKERS
STRING_FORMATS = ("disc", "discrete", "char", "string", "text", "categorical", "category")


def stage(panel: DataFrame, years: list[int] | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Typed keys, trimmed upper-case names, trimmed values and their null-normalised form.

    Rows without a unit, year or varname, of other years and of excluded variables are dropped before anything shuffles.
    """
    rows = panel.where(F.col("year").isin(years)) if years else panel
    value = T.strip(F.col("value"))
    rows = rows.select(
        F.col("UNITID").try_cast("bigint").alias("UNITID"), F.col("year").try_cast("int").alias("year"), T.varname(F.col("varname")).alias("varname"),
        value.alias("value"), T.null_if_token(F.col("value")).alias("value_norm"),
        F.coalesce(F.upper(T.strip(F.col("source_file"))), F.lit("")).alias("source_file"), F.coalesce(T.strip(F.col("varnumber")), F.lit("")).alias("varnumber"),
    )
    rows = rows.where("UNITID is not null and year is not null and varname <> ''")
    return rows.where(~F.col("varname").isin(*[e.upper() for e in exclude])) if exclude else rows


def in_dimension(source: Column, sources: tuple[str, ...], prefixes: tuple[str, ...]) -> Column:
    """Whether a source belongs to the dimension lane: listed, or by prefix; false when nothing is configured."""
    tests = ([source.isin(*sources)] if sources else []) + [source.startswith(p) for p in prefixes]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def lanes(staged: DataFrame, sources: tuple[str, ...], prefixes: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(scalar, dimension) rows, each distinct."""
    dim = in_dimension(F.col("source_file"), sources, prefixes)
    return staged.where(~dim).distinct(), staged.where(dim).distinct()


def base_rows(staged: DataFrame) -> DataFrame:
    """Rows that differ in unit, year, variable, normalised value, source or number; of equal ones the smallest value text."""
    key = [c for c in STAGE if c != "value"]
    return staged.groupBy(*key).agg(F.min("value").alias("value")).select(*STAGE)


def conflict_keys(base: DataFrame) -> DataFrame:
    """Keys with more than one value, nulls aside; minimum and maximum tell, so no distinct set is kept."""
    return (
        base.where("value_norm is not null").groupBy(*CONFLICT_KEY).agg(F.min("value_norm").alias("lo"), F.max("value_norm").alias("hi"), F.count_distinct("value_norm").alias("distinct_values"))
        .where("lo <> hi").drop("lo", "hi")
    )


def conflict_rows(base: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of conflicting keys."""
    return base.join(keys, CONFLICT_KEY)


def without_conflicts(base: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of keys without a conflict; all rows of a conflicting key go."""
    return base.join(keys.select(*CONFLICT_KEY), CONFLICT_KEY, "left_anti")


def spine(staged: DataFrame) -> DataFrame:
    """All unit-years, whatever lane or variable they come from."""
    return staged.select("year", "UNITID").distinct()


def discover(staged: DataFrame) -> DataFrame:
    """(varname, source_file, varnumber) with rows and non-empty rows: one pass from which the other counts roll up."""
    return staged.groupBy("varname", "source_file", "varnumber").agg(F.count(F.lit(1)).alias("n_rows"), F.count("value_norm").alias("n_non_empty"))


def variable_counts(found: DataFrame) -> DataFrame:
    """Rows and non-empty rows per variable."""
    return found.groupBy("varname").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_non_empty").alias("n_non_empty"))


def numeric_variables(dictionary: DataFrame) -> DataFrame:
    """Variables with a numeric marker and no text marker among all their types and formats."""
    kinds = F.array(*[F.lower(T.strip(F.coalesce(F.col(c), F.lit("")))) for c in ("DataType", "format")])
    rows = dictionary.select(T.varname(F.col("varname")).alias("varname"), F.explode(kinds).alias("kind")).where("varname <> ''")
    return rows.groupBy("varname").agg(F.bool_or(F.col("kind").isin(*NUMERIC_FORMATS)).alias("num"), F.bool_or(F.col("kind").isin(*STRING_FORMATS)).alias("txt")).where("num and not txt").select("varname")


def indicator_map(dictionary: DataFrame) -> DataFrame:
    """(varname, base, suffix) of discrete variables that end in digits and share their base with at least one other."""
    low = lambda c: F.lower(T.strip(F.coalesce(F.col(c), F.lit(""))))
    base, suffix = L.split_indicator(F.col("varname"))
    names = dictionary.where((low("DataType") == "disc") | (low("format") == "disc")).select(T.varname(F.col("varname")).alias("varname")).distinct()
    names = names.select("varname", base.alias("base"), suffix.alias("suffix")).where("base <> ''")
    shared = names.groupBy("base").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("base")
    return names.join(shared, "base").select("varname", "base", "suffix")


def collapsed_names(bases: list[str], existing: set[str], suffix: str = "_CAT") -> dict[str, str]:
    """A free output name for each base, in order of the bases: the base, then base_CAT, then base_CAT1 and so on."""
    out, taken = {}, set(existing)
    for base in sorted(bases):
        tries = (f"{base}{suffix}{i}" for i in range(1, len(taken) + 2))
        name = next(n for n in (base, base + suffix, *tries) if n not in taken)
        out[base] = name
        taken.add(name)
    return out


def active_indicators(base: DataFrame, indicators: DataFrame) -> DataFrame:
    """The first row of each (unit, year, family, member), if it is on. First is by source, number and value; an inactive
    first row hides a later active one."""
    rows = base.where("value_norm is not null").join(bounded(indicators), "varname")
    w = Window.partitionBy("UNITID", "year", "base", "suffix").orderBy("source_file", "varnumber", "value_norm", "value", "varname")
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn").where(L.is_active(F.col("value_norm")))


def indicator_choice(active: DataFrame) -> DataFrame:
    """How many members of a family are on, and the least of them."""
    return active.groupBy("UNITID", "year", "base").agg(F.count_distinct("suffix").alias("n_active"), F.min("suffix").alias("chosen_suffix"))


def indicator_conflicts(active: DataFrame, choice: DataFrame, high_from: int = 25) -> DataFrame:
    """Families with several members on, per year and source, with the signal that the evidence amounts to."""
    rows = active.join(choice.where("n_active > 1"), ["UNITID", "year", "base"])
    expected = F.concat_ws("|", "source_file", "base").isin(*["|".join(p) for p in L.EXPECTED_CONFLICTS])
    return rows.groupBy("year", "source_file", "base").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("UNITID").alias("unit_years"), F.min("n_active").alias("min_n_active"),
        F.max("n_active").alias("max_n_active"), F.count_distinct("suffix").alias("distinct_suffixes"),
    ).withColumn("signal_level", F.when(expected, "expected").when(F.col("row_count") >= high_from, "high").otherwise("low"))


def collapse(base: DataFrame, indicators: DataFrame, choice: DataFrame, suffix: str = "_CAT", drop_members: bool = True) -> DataFrame:
    """Rows without the family members (with them unless ``drop_members``), plus one row per unit, year and family with exactly one member on.

    Output names are planned over all families: the family's own, with the suffix if that is a variable already, then numbered.
    Collapsed rows have ``origin`` 1, others 0, so that :func:`final_rows` puts them last.
    """
    bases = [r.base for r in choice.select("base").distinct().collect()]  # families: metadata
    taken = {r.varname for r in base.select("varname").distinct().collect()}  # variables: metadata
    spark = base.sparkSession
    names = spark.createDataFrame(list(collapsed_names(bases, taken, suffix).items()), "base string, _name string")
    made = choice.where("n_active = 1").join(bounded(names), "base").select(
        "UNITID", "year", F.col("_name").alias("varname"), F.col("chosen_suffix").alias("value"),
        F.col("chosen_suffix").alias("value_norm"), F.lit("").alias("source_file"), F.lit("").alias("varnumber"), F.lit(1).alias("origin"),
    )
    rest = base.join(bounded(indicators.select("varname")), "varname", "left_anti") if drop_members else base
    return rest.select(*STAGE, F.lit(0).alias("origin")).unionByName(made)


def duplicate_groups(base: DataFrame) -> DataFrame:
    """(year, UNITID, varname) that still have several rows, with how many."""
    return base.groupBy("year", "UNITID", "varname").agg(F.count(F.lit(1)).alias("dup_rows")).where("dup_rows > 1")


def final_rows(base: DataFrame, prefer_non_null: bool = False) -> DataFrame:
    """One row per unit, year and variable: the first by source, number and value, where a null value sorts as ''.

    So a null beats a value of the same source unless ``prefer_non_null`` is set. Rows that :func:`collapse` made come last. A
    minimum of one struct does it, which combines rows before the shuffle.
    """
    blank = F.col("value_norm").isNull().cast("int") if prefer_non_null else F.lit(0)
    origin = F.col("origin") if "origin" in base.columns else F.lit(0)
    order = F.struct(blank.alias("b"), origin.alias("o"), "source_file", "varnumber", F.coalesce("value_norm", F.lit("")).alias("vn"), F.coalesce("value", F.lit("")).alias("v"), "value_norm", "value")
    kept = base.groupBy("year", "UNITID", "varname").agg(F.min(order).alias("m"))
    return kept.select("UNITID", "year", "varname", "m.value", "m.value_norm", "m.source_file", "m.varnumber")


def pivot(final: DataFrame, keys: DataFrame, targets: list[str], numeric: set[str] = frozenset()) -> DataFrame:
    """The wide panel: the spine with one column per target, in the order given; numeric targets are doubles.

    Rows are unique per cell, so casting before the pivot is the same as after. Meant for targets that a plan can name one
    by one; :func:`panelloom.operators.eav.wide_table` builds panels of thousands of columns.
    """
    num = [t for t in targets if t in numeric]
    txt = [t for t in targets if t not in numeric]
    rows = final.where(F.col("varname").isin(targets))
    aggs = [F.max(F.when(F.col("varname") == t, T.read_plain_double(F.col("value_norm")))).alias(t) for t in num]
    aggs += [F.max(F.when(F.col("varname") == t, F.col("value_norm"))).alias(t) for t in txt]
    wide = rows.groupBy("year", "UNITID").agg(*aggs)
    return keys.join(wide, ["year", "UNITID"], "left").select("year", "UNITID", *targets)


def pivot_blocks(final: DataFrame, keys: DataFrame, targets: list[str], numeric: set[str] = frozenset(), block: int = 48) -> DataFrame:
    """:func:`pivot` of any number of targets: some columns at a time, outer-joined to the spine without a further shuffle."""
    out = keys.select("year", "UNITID").distinct()
    for k in range(0, len(targets), block):
        some = targets[k : k + block]
        rows = final.where(F.col("varname").isin(some))
        aggs = [F.max(F.when(F.col("varname") == t, T.read_plain_double(F.col("value_norm")) if t in numeric else F.col("value_norm"))).alias(t) for t in some]
        out = out.join(rows.groupBy("year", "UNITID").agg(*aggs).hint("merge"), ["year", "UNITID"], "left")
    return out.select("year", "UNITID", *targets)


def order_targets(targets) -> list[str]:
    """Names in order, each followed by its X-flag, then flags without a variable."""
    have, out = set(targets), []
    for name in sorted(t for t in have if not t.startswith("X")):
        out += [name] + ([f"X{name}"] if f"X{name}" in have else [])
    return out + sorted(have - set(out))


def cast_report(final: DataFrame, targets: DataFrame) -> DataFrame:
    """(year, column, counts) of numeric targets: every year and target has a row, so zero rows show."""
    number = T.read_plain_double(F.col("value_norm"))
    years = [r.year for r in final.select("year").distinct().collect()]  # one number per year
    grid = targets.select(F.col("varname").alias("column")).distinct().select(F.explode(F.lit(years).cast("array<int>")).alias("year"), "column")
    counts = final.groupBy("year", F.col("varname").alias("column")).agg(F.count("value_norm").alias("non_empty_tokens"), F.count(number).alias("parsed_numeric_tokens"))
    out = grid.join(counts, ["year", "column"], "left").fillna(0, ["non_empty_tokens", "parsed_numeric_tokens"])
    return out.withColumn("failed_parse_tokens", F.col("non_empty_tokens") - F.col("parsed_numeric_tokens"))


def year_summary(final: DataFrame, keys: DataFrame, n_targets: int, duplicates: DataFrame) -> DataFrame:
    """Per year: spine rows, variables, non-empty values, fill rate and rows in duplicate groups."""
    units = keys.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"))
    cells = final.groupBy("year").agg(F.count_distinct("varname").alias("n_vars"), F.count("value_norm").alias("non_empty_values"))
    dups = duplicates.groupBy("year").agg(F.sum("dup_rows").alias("dup_rows"))
    out = units.join(cells, "year", "left").join(dups, "year", "left").fillna(0, ["n_vars", "non_empty_values", "dup_rows"])
    return out.withColumn("fill_rate", F.round(F.col("non_empty_values") / (F.col("n_rows") * n_targets), 9))


def empty_columns(wide: DataFrame) -> DataFrame:
    """(column, non_null) of every column, in one pass over the panel."""
    names = [c for c in wide.columns if c not in ("year", "UNITID")]
    one = wide.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in names])
    return one.select(F.explode(F.create_map(*[x for c in names for x in (F.lit(c), F.col(f"`{c}`"))])).alias("column", "non_null"))


def column_lineage(found: DataFrame, indicators: DataFrame) -> DataFrame:
    """Where each output column comes from: source files, numbers and rows, joined in order by ``|``."""
    families = indicators.select("varname", F.col("base").alias("output_column"))
    rows = found.join(bounded(families), "varname", "left").withColumn("kind", F.when(F.col("output_column").isNotNull(), "disc_collapsed").otherwise("direct_scalar"))
    rows = rows.withColumn("output_column", F.coalesce("output_column", "varname"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c)))), "|")
    return rows.groupBy("output_column").agg(
        F.max("kind").alias("lineage_kind"), joined("varname").alias("source_varnames"), joined("source_file").alias("source_files"),
        F.count_distinct(F.when(F.col("source_file") != "", F.col("source_file"))).alias("source_file_count"), joined("varnumber").alias("source_varnumbers"),
        F.sum("n_rows").alias("source_rows"), F.sum("n_non_empty").alias("source_non_empty_rows"),
    ).withColumns(
        {"primary_source_file": F.when(F.col("source_file_count") == 1, F.col("source_files")).otherwise(""), "lineage_ambiguous": F.col("source_file_count") > 1}
    )


def target_lineage(staged: DataFrame, scalar: DataFrame, indicators: DataFrame, exclude: tuple[str, ...], blocked: tuple[str, ...]) -> DataFrame:
    """One row per variable ever seen: its counts on both sides of the lane split and why it is a column or not."""
    a = variable_counts(discover(staged)).select("varname", F.col("n_rows").alias("stage_rows"), F.col("n_non_empty").alias("stage_non_empty_rows"))
    b = variable_counts(discover(scalar)).select("varname", F.col("n_rows").alias("scalar_rows"), F.col("n_non_empty").alias("scalar_non_empty_rows"))
    rows = a.join(b, "varname", "full_outer").join(indicators, "varname", "left").fillna(0, ["stage_rows", "stage_non_empty_rows", "scalar_rows", "scalar_non_empty_rows"])
    excluded = F.col("varname").isin(*exclude) if exclude else F.lit(False)
    anti = L.identifier_like(F.col("varname"), blocked) if blocked else F.lit(False)
    empty = (F.col("scalar_rows") > 0) & (F.col("scalar_non_empty_rows") == 0)
    return rows.select(
        "varname", "stage_rows", "stage_non_empty_rows", "scalar_rows", "scalar_non_empty_rows", F.coalesce("base", F.lit("")).alias("disc_group_base"),
        F.coalesce("suffix", F.lit("")).alias("disc_group_suffix"), excluded.alias("excluded_by_user"), empty.alias("dropped_as_globally_empty"), anti.alias("anti_garbage_hit"),
        ((F.col("scalar_non_empty_rows") > 0) & ~excluded & ~anti & F.col("base").isNull()).alias("final_in_all_targets"),
    )
