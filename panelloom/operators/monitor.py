"""Summaries over builds: metrics of a release, parity of two panels, and telemetry of runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.compare import multiset_difference, schema_difference
from panelloom.operators.gates import Check
from panelloom.operators.longform import GateError

SEVERITIES = ("pass", "review", "fail")


def release_metrics(long: DataFrame, wide: DataFrame, clean: DataFrame, dictionary: DataFrame, patterns: DataFrame) -> DataFrame:
    """(section, metric, value): sizes of the parts of a release, one aggregate each."""

    def cells(section: str, df: DataFrame, **aggs) -> DataFrame:
        one = df.agg(*[a.cast("bigint").alias(n) for n, a in aggs.items()])
        return one.select(F.lit(section).alias("section"), F.explode(F.create_map(*[x for n in aggs for x in (F.lit(n), F.col(n))])).alias("metric", "value"))

    n = F.count(F.lit(1))
    panel = {"rows": n, "units": F.count_distinct("UNITID"), "years": F.count_distinct("year")}
    parts = [
        cells("long_panel", long, **panel, variables=F.count_distinct("varname"), sources=F.count_distinct("source_file")),
        cells("wide_panel", wide, **panel, columns=F.max(F.lit(len(wide.columns)))), cells("clean_panel", clean, **panel, columns=F.max(F.lit(len(clean.columns)))),
        cells("dictionary", dictionary, rows=n, variables=F.count_distinct("varname"), sources=F.count_distinct("source_file")),
        cells("structure", patterns, units=n, always_present=F.count_if(F.col("pattern") == "always_present"), selection_risk=F.count_if("possible_selection_risk"), several_identifiers=F.count_if("possible_identifier_linkage_case")),
    ]
    return reduce(DataFrame.unionByName, parts)


def parity(a: DataFrame, b: DataFrame, key: list[str]) -> list[Check]:
    """Whether two panels agree: rows and units per year, keys, columns, and the multiset of rows over common columns."""
    per_year = lambda df: df.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("UNITID").alias("u"))
    schema = schema_difference(a, b)
    return [
        Check("rows_and_units_by_year", multiset_difference(per_year(a), per_year(b)).isEmpty()), Check("keys", multiset_difference(a, b, key).isEmpty()),
        Check("columns", not schema, "; ".join(f"{c} {n}" for c, n, *_ in schema)), Check("rows", multiset_difference(a, b).isEmpty()),
    ]


def fail_on(issues: DataFrame, least: str = "fail") -> None:
    """Raise if an issue is at least as severe as ``least`` (pass, review, fail)."""
    bad = SEVERITIES[SEVERITIES.index(least) :]
    n = issues.where(F.col("severity").isin(*bad)).count()
    if n:
        raise GateError(f"{n} issues of severity {' or '.join(bad)}")


def telemetry(runs: DataFrame) -> DataFrame:
    """Recorded runs, newest first, with the time since the run before and their configuration's main settings."""
    from pyspark.sql import Window

    before = F.lag("started_at").over(Window.partitionBy("stage").orderBy("started_at"))
    setting = lambda k: F.get_json_object("config_json", f"$.{k}").alias(k)
    rows = runs.select("run_id", "stage", "started_at", "years_spec", "n_rows", (F.col("started_at").cast("double") - before.cast("double")).alias("seconds_since"), setting("lane_split"), setting("memory_limit"))
    return rows.orderBy(F.desc("started_at"), F.desc("run_id"))


def plan_seeds(seeds: list[dict[str, str]], found: set[str]) -> list[dict[str, object]]:
    """Placeholder columns of an older schema: which are present anyway and which are seeded as empty columns.

    Names are trimmed and upper-cased; the first row of a name holds, blank names are left out.
    """
    out: dict[str, dict[str, object]] = {}
    for row in seeds:
        name = str(row.get("column_name") or "").strip().upper()
        if name and name not in out:
            out[name] = {**row, "column_name": name, "present": name in found, "seeded": name not in found}
    return list(out.values())


def add_seeds(wide: DataFrame, plan: list[dict[str, object]]) -> DataFrame:
    """The panel with the seeded columns, all null."""
    kinds = {str(p["column_name"]): "double" if str(p.get("dtype", "")).lower() in ("double", "float", "numeric") else "string" for p in plan if p["seeded"]}
    return wide.select("*", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])


def payload(profile: DataFrame) -> DataFrame:
    """Variable profiles as JSON lines, for a browser page."""
    return profile.select("varname", F.to_json(F.struct(*profile.columns)).alias("json"))
