"""Row-preserving cleaning of a wide panel by parent/child flags, column and year selection."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.policy import policy_of
from panelloom.operators.longform import GateError

KEYS = ("year", "UNITID")


def flag_targets(flags: Iterable[str], sources_of: dict[str, str]) -> dict[str, list[str]]:
    """The columns that each flag governs; flags and keys are never governed.

    ``sources_of``: column -> its source files joined by ``|``. A column is governed if any of its sources is.
    """
    flags = list(flags)
    fixed = {*flags, *KEYS}
    return {f: [c for c, s in sources_of.items() if c not in fixed and any(policy_of(f).targets(x) for x in s.split("|"))] for f in flags}


def check_lineage(columns: Iterable[str], sources_of: dict[str, str]) -> None:
    """Gate: every column but the keys has lineage."""
    lost = [c for c in columns if c not in KEYS and c not in sources_of]
    if lost:
        raise GateError(f"columns without lineage: {lost[:10]}")


def check_several_years(panel: DataFrame) -> None:
    """Gate: refuse a panel of exactly one year."""
    if panel.select("year").where("year is not null").distinct().limit(2).count() == 1:
        raise GateError("the panel holds a single year")


def blank_children(panel: DataFrame, targets: dict[str, list[str]]) -> DataFrame:
    """The same rows and columns, with governed cells nulled in rows whose flag has a blanking code.

    Flags are never governed, so their order doesn't matter and one projection does it all.
    """
    governed: dict[str, list[str]] = {}
    for flag, columns in targets.items():
        for c in columns:
            governed.setdefault(c, []).append(flag)
    child = {f: F.coalesce(policy_of(f).code(F.col(f"`{f}`")).isin(*policy_of(f).blanked), F.lit(False)) for f in targets}
    cells = [
        F.when(~reduce(lambda a, b: a | b, [child[f] for f in governed[c]]), F.col(f"`{c}`")).alias(c) if c in governed else F.col(f"`{c}`") for c in panel.columns
    ]
    return panel.select(*cells)


def code_counts(panel: DataFrame, flags: list[str]) -> DataFrame:
    """(year, flag, bucket, n_rows): every year, flag and bucket has a row, zeros included."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), policy_of(f).bucket(F.col(f"`{f}`")).alias("bucket")) for f in flags]))
    counts = panel.select("year", pairs.alias("p")).groupBy("year", "p.flag", "p.bucket").agg(F.count(F.lit(1)).alias("n_rows"))
    buckets = F.explode(F.array(*[F.lit(b) for b in ("child_apply", "review_only", "other", "missing")])).alias("bucket")
    grid = panel.select("year").distinct().select("year", F.explode(F.array(*[F.lit(f) for f in flags])).alias("flag")).select("year", "flag", buckets)
    return grid.join(counts, ["year", "flag", "bucket"], "left").fillna(0, ["n_rows"])


def code_stats(panel: DataFrame, flag: str, columns: list[str]) -> DataFrame:
    """(flag, code, n_rows, target_nonnull): rows per code and how many governed cells are filled in them."""
    filled = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNotNull().cast("bigint") for c in columns], F.lit(0).cast("bigint"))
    code = policy_of(flag).code(F.col(f"`{flag}`")).alias("code")
    return panel.select(code, filled.alias("_f")).where("code is not null").groupBy("code").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_f").alias("target_nonnull")).select(F.lit(flag).alias("flag"), "code", "n_rows", "target_nonnull")


def flag_coverage(raw: DataFrame, clean: DataFrame, targets: dict[str, list[str]]) -> DataFrame:
    """Per flag: child and review rows before and after, governed cells left in child rows, and the verdict."""
    rows = []
    for flag, columns in targets.items():
        p = policy_of(flag)
        a = code_stats(raw, flag, columns).withColumn("side", F.lit("raw"))
        both = a.unionByName(code_stats(clean, flag, columns).withColumn("side", F.lit("clean")))
        child = F.col("code").isin(*p.blanked)
        review = F.col("code").isin(*p.reviewed) if p.reviewed else F.lit(False)
        pick = lambda side, test, c: F.coalesce(F.sum(F.when((F.col("side") == side) & test, F.col(c))), F.lit(0)).cast("bigint")  # noqa: E731, B023
        one = both.agg(
            pick("raw", child, "n_rows").alias("child_rows_raw"), pick("clean", child, "n_rows").alias("child_rows_clean"), pick("raw", review, "n_rows").alias("review_rows_raw"),
            pick("raw", child, "target_nonnull").alias("raw_target_nonnull"), pick("clean", child, "target_nonnull").alias("clean_target_nonnull"),
        )
        none = F.lit(not columns)
        status = (
            F.when((F.col("child_rows_raw") > 0) & none, "no_targets").when((F.col("child_rows_raw") > 0) & (F.col("clean_target_nonnull") > 0), "suspicious")
            .when(F.col("child_rows_raw") > 0, "cleaned").when(F.col("review_rows_raw") > 0, "review_only").when(none, "no_targets").otherwise("cleaned")
        )
        rows.append(one.select(F.lit(flag).alias("flag"), F.lit(len(columns)).cast("bigint").alias("target_columns"), *one.columns, status.alias("status")))
    return reduce(DataFrame.unionByName, rows)


def custom_extract(panel: DataFrame, columns: list[str], years: list[int] | tuple[int, int] | int | None = None) -> DataFrame:
    """Keys and the wanted columns, found in any case, in the order given and without repeats; unknown names raise KeyError.

    ``years`` is one year, a (first, last) pair or a list.
    """
    have = {c.lower(): c for c in panel.columns}
    lost = [c for c in columns if c.strip().lower() not in have]
    if lost:
        raise KeyError(f"no such columns: {lost}")
    picked = list(dict.fromkeys([*[have[k.lower()] for k in KEYS], *[have[c.strip().lower()] for c in columns]]))
    if isinstance(years, tuple):
        panel = panel.where(F.col("year").between(*years))
    elif isinstance(years, int):
        panel = panel.where(F.col("year") == years)
    elif years is not None:
        panel = panel.where(F.col("year").isin(*years))
    return panel.select(*[F.col(f"`{c}`") for c in picked])


def parse_columns(text: str) -> list[str]:
    """Names from a list with commas, lines and ``#`` comments, without keys and repeats."""
    names = [n.strip() for line in text.splitlines() for n in line.split("#")[0].split(",")]
    return list(dict.fromkeys(n for n in names if n and n.lower() not in {k.lower() for k in KEYS}))


def without_flags(panel: DataFrame, prefix: str = "X") -> DataFrame:
    """The panel without imputation flags."""
    return panel.drop(*[c for c in panel.columns if c.startswith(prefix)])


def align(panel: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` in its order and types; missing ones are null, others are dropped."""
    have = {c.lower() for c in panel.columns}
    return panel.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
