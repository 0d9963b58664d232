"""Column profiles from maintained value-count tables.

The persistent state is a table (load, column, value, n): how often a value stands in a column of a load. A load, a
correction or a withdrawal is a table of the same shape with signed counts; adding it is one grouped union. All metrics
(null share, distinct values, range, pattern violations, entropy, change between loads) come from the counts alone and
are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions import text as T
from panelloom.operators.ranking import median_of_others
from panelloom.runtime import materialise, pick, scratch
from panelloom.sources.versions import Versions

COLUMN_NAME_RE = "^[A-Z][A-Z0-9_]*$"
COUNTS = ["non_empty_tokens", "parsed_numeric_tokens", "failed_parse_tokens"]


def value_counts(df: DataFrame, load: Column, columns: list[str], sign: int = 1) -> DataFrame:
    """The signed value-count delta of one or more loads: (load, column, value, n). Null values are counted as null."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    return df.select(load.cast("string").alias("load"), cells.alias("c")).groupBy("load", "c.column", "c.value").agg((F.count(F.lit(1)) * sign).alias("n"))


def apply_delta(counts: DataFrame, delta: DataFrame) -> DataFrame:
    """The counts after a signed delta; entries that cancel are dropped. Negative entries stay: they show a wrong delta."""
    return counts.unionByName(delta).groupBy("load", "column", "value").agg(F.sum("n").alias("n")).where("n <> 0")


def metrics(counts: DataFrame, patterns: dict[str, str] | None = None, by_load: bool = True) -> DataFrame:
    """Exact profile per column (and load): rows, nulls, empty values, distinct values, range, violations, entropy in bits.

    ``patterns`` gives a regular expression per column; a value that is not null and doesn't match is a violation.
    """
    keys = ["load", "column"] if by_load else ["column"]
    merged = counts if by_load else counts.groupBy("column", "value").agg(F.sum("n").alias("n"))
    bad = F.lit(False)
    for c, p in (patterns or {}).items():
        bad = bad | ((F.col("column") == c) & F.col("value").isNotNull() & ~F.col("value").rlike(p))
    n, real = F.col("n"), F.col("value").isNotNull()
    number = F.col("value").try_cast("double")
    got = merged.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(real, 0).otherwise(n)).alias("n_null"),
        F.sum(F.when(real & T.is_empty(F.col("value")), n).otherwise(0)).alias("n_empty"),
        F.count_if(real).alias("n_distinct"),
        F.sum(F.when(bad, n).otherwise(0)).alias("n_violations"),
        F.min("value").alias("min_text"), F.max("value").alias("max_text"), F.min(number).alias("min_number"), F.max(number).alias("max_number"),
        F.sum(F.when(real, n)).alias("_m"), F.sum(F.when(real, n * F.log2(n))).alias("_l"),
    )
    entropy = F.when(F.col("_m") > 0, F.round(F.log2("_m") - F.col("_l") / F.col("_m"), 9) + 0.0)
    share = F.round(F.col("n_null") / F.col("n_rows"), 9)
    return got.select(*keys, "n_rows", "n_null", share.alias("null_share"), "n_empty", "n_distinct", "n_violations", "min_text", "max_text", "min_number", "max_number", entropy.alias("entropy"))


def drift(counts: DataFrame, order: str = "bigint") -> DataFrame:
    """Per column and load: the total variation distance to the next earlier load, from +share and -share entries that
    are grouped by value, so values that keep their share cancel. Columns of a first load have no row."""
    from pyspark.sql import Window

    totals = counts.groupBy("load", "column").agg(F.sum("n").alias("all"))
    step = Window.partitionBy("column").orderBy(F.col("load").cast(order))
    pairs = totals.select("load", "column", "all", F.lead("load").over(step).alias("later"), F.lag("load").over(step).alias("earlier"))
    shares = counts.join(pairs, ["load", "column"])
    share = F.col("n") / F.col("all")
    up = shares.where("earlier is not null").select(F.col("load").alias("at"), "column", "value", share.alias("d"))
    down = shares.where("later is not null").select(F.col("later").alias("at"), "column", "value", (-share).alias("d"))
    cells = up.unionByName(down).groupBy("at", "column", "value").agg(F.sum("d").alias("d"))
    return cells.groupBy(F.col("at").alias("load"), "column").agg(F.round(F.sum(F.abs("d")) / 2, 9).alias("distance"))


ENTRY = ["run_id", "column", "year", *COUNTS]
ENTRIES = "run_id long, column string, year int, non_empty_tokens long, parsed_numeric_tokens long, failed_parse_tokens long, n long"
#: Groups of more entries than this have their medians placed by distributed ranks instead of sorted arrays; both are exact.
SMALL_GROUP = 5_000


def report_counts(report: DataFrame, sign: int = 1) -> DataFrame:
    """The signed delta of cast-report rows: how often a (run, column, year, counts) entry stands there, nulls included."""
    return pick(report, *ENTRY).groupBy(*ENTRY).agg((F.count(F.lit(1)) * sign).alias("n"))


def apply_report_delta(counts: DataFrame, delta: DataFrame) -> DataFrame:
    """The maintained entries after a signed delta; entries that cancel are dropped."""
    return counts.unionByName(delta).groupBy(*ENTRY).agg(F.sum("n").cast("bigint").alias("n")).where("n <> 0")


def _median(values: Column) -> Column:
    """Of a sorted array; null for an empty one."""
    n = F.size(values)
    return F.when(n > 0, (F.try_element_at(values, F.floor((n + 1) / 2).cast("int")) + F.try_element_at(values, F.floor(n / 2).cast("int") + 1)) / 2)


def _small_shifts(entries: DataFrame, failure_step: float) -> DataFrame:
    """Entries of groups of bounded size with their shifts: one sorted array per group, filtered by year."""
    cells = F.collect_list(F.struct("year", *COUNTS, "share"))
    groups = entries.groupBy("run_id", "column").agg(cells.alias("e"))
    by = lambda c: F.array_sort(F.transform(F.filter("e", lambda x: x[c].isNotNull()), lambda x: F.struct(x[c].alias("v"), x["year"].alias("y"))))
    groups = groups.select("run_id", "column", "e", by(COUNTS[0]).alias("a"), by("share").alias("b"), F.array_distinct(F.transform("e", lambda x: x["year"])).alias("years"))
    others = lambda c, y: F.transform(F.filter(c, lambda x: x["y"] != y), lambda x: x["v"])
    usual = F.map_from_arrays("years", F.transform("years", lambda y: F.struct(_median(others("a", y)).alias("n"), _median(others("b", y)).alias("s"))))
    groups = groups.where("size(years) > 1").select("run_id", "column", "e", usual.alias("usual"))
    rows = groups.select("run_id", "column", F.explode("e").alias("x"), "usual").select("run_id", "column", "x.*", F.col("usual")[F.col("x.year")].alias("u"))
    return _shifts(rows.select("run_id", "column", "year", *COUNTS, "share", F.col("u.n").alias("usual_n"), F.col("u.s").alias("usual_share")), failure_step)


def _large_shifts(entries: DataFrame, failure_step: float) -> DataFrame:
    """The same for groups of any size, by ranks over range-sorted partitions."""
    group = ["run_id", "column"]
    volume = median_of_others(entries, group, "year", COUNTS[0], COUNTS[1:]).withColumnRenamed("median", "usual_n")
    failure = median_of_others(entries, group, "year", "share", COUNTS).withColumnRenamed("median", "usual_share")
    usual = volume.join(failure, [*group, "year"], "full_outer")
    return _shifts(entries.join(usual, [*group, "year"]).select(*group, "year", *COUNTS, "share", "usual_n", "usual_share"), failure_step)


def _shifts(rows: DataFrame, failure_step: float) -> DataFrame:
    n = F.col(COUNTS[0])
    volume = (n < F.col("usual_n") / 2) | (n > F.col("usual_n") * 2)
    failure = F.round(F.col("share") - F.col("usual_share"), 9) >= failure_step
    issues = F.array_compact(F.array(F.when(volume, F.lit("volume_shift")), F.when(failure, F.lit("failure_shift"))))
    return rows.select(*ENTRY, issues.alias("issues")).where("size(issues) > 0")


def entry_issues(counts: DataFrame, failure_step: float = 0.10, small: int = SMALL_GROUP) -> DataFrame:
    """(run, column, year, counts, issues) of the maintained entries that have an issue.

    Entry issues: ``count_missing``, ``counts_disagree``, ``bad_column_name``. Sound entries (no count issue, a column) are
    compared with the exact medians over the entries of other years of their run and column: ``volume_shift``,
    ``failure_shift``. As entries hold repeats as a number, repeats weigh once. Null run ids or years never have a shift.
    """
    n, ok, bad = (F.col(c) for c in COUNTS)
    missing = n.isNull() | ok.isNull() | bad.isNull()
    wrong = ~missing & ((F.least(*COUNTS) < 0) | (ok + bad != n))
    name = F.col("column").isNull() | ~F.col("column").rlike(COLUMN_NAME_RE) | F.col("column").contains("\n")
    flags = F.array(F.when(missing, F.lit("count_missing")), F.when(wrong, F.lit("counts_disagree")), F.when(name, F.lit("bad_column_name")))
    here = counts.where("n > 0")
    own = here.select(*ENTRY, F.array_compact(flags).alias("issues")).where("size(issues) > 0")
    sound = here.where(~missing & ~F.coalesce(wrong, F.lit(False)) & F.col("column").isNotNull() & F.col("run_id").isNotNull() & F.col("year").isNotNull())
    sound = sound.select(*ENTRY, F.when(n > 0, bad / n).alias("share"))
    hot = materialise(sound.groupBy("run_id", "column").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > small).drop("m"), "hot")
    if hot.isEmpty():
        return own.unionByName(_small_shifts(sound, failure_step))
    few = sound.join(hot, ["run_id", "column"], "left_anti")
    many = sound.join(hot, ["run_id", "column"], "left_semi")
    return own.unionByName(_small_shifts(few, failure_step)).unionByName(_large_shifts(many, failure_step))


def report_issues(report: DataFrame, store: Versions | None = None, failure_step: float = 0.10, small: int = SMALL_GROUP) -> DataFrame:
    """(report_id, issue) of a cast report; a row can have several issues and every repeated row is reported.

    The report is a load: its signed delta is applied to the persistent entries of ``store`` (a fresh one by default), and
    the issues come from what the store then holds, earlier loads included. Rows get the issues of their entry, joined
    null-safe. An empty report gives no issue.
    """
    report = pick(report, "report_id", *ENTRY)
    store = store or Versions(report.sparkSession, scratch(report.sparkSession, "cast-counts"), ENTRIES)
    counts = store.advance(lambda c: apply_report_delta(c, report_counts(report)))
    found = entry_issues(counts, failure_step, small).select(*[F.col(c).alias(f"_{c}") for c in ENTRY], "issues")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ENTRY]
    return report.join(found, same).select("report_id", F.explode("issues").alias("issue"))
