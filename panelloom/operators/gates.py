"""Acceptance, contract and certification: lists of checks with a verdict each."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.compare import multiset_difference, schema_difference
from panelloom.operators.longform import GateError, key_nulls, year_difference


@dataclass(frozen=True)
class Check:
    """One named check: passed, failed or (None) not applicable."""

    name: str
    passed: bool | None
    detail: str = ""

    @property
    def status(self) -> str:
        return {True: "PASS", False: "FAIL", None: "SKIP"}[self.passed]


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """(n_rows, n_keys, n_beyond_first): rows beyond the first of their key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_beyond_first")
    )


def acceptance(long: DataFrame, wide: DataFrame, clean: DataFrame, years: list[int], counters: dict[str, DataFrame] | None = None) -> list[Check]:
    """The acceptance list of a build: years, keys, row preservation, and QC tables that must be empty.

    Only small aggregates reach the driver.
    """
    checks = []
    for name, df in (("long", long), ("wide", wide), ("clean", clean)):
        lost, odd = year_difference(df, years)
        checks.append(Check(f"{name}_years", not lost and not odd, f"missing {lost}, unexpected {odd}"))
    lost = {r.key: r.n_missing for r in key_nulls(long).collect()}
    checks.append(Check("long_key_nulls", not any(lost.values()), str(lost)))
    for name, df in (("wide", wide), ("clean", clean)):
        beyond = duplicate_keys(df, ["UNITID", "year"]).first().n_beyond_first
        checks.append(Check(f"{name}_duplicate_keys", beyond == 0, f"{beyond} rows"))
    key = ["year", "UNITID"]
    checks.append(Check("rows_preserved", multiset_difference(wide, clean, key).isEmpty()))
    checks.append(Check("columns_preserved", not schema_difference(wide, clean)))
    for name, df in (counters or {}).items():
        checks.append(Check(name, df.isEmpty()))
    return checks


def certify(checks: list[Check]) -> str:
    """The verdict on a build: every check must pass, skipped ones make it conditional."""
    if any(c.passed is False for c in checks):
        return "Not certified"
    return "Conditionally certified" if any(c.passed is None for c in checks) else "Certified parity"


def require(checks: list[Check]) -> None:
    """Raise after all checks have run, naming those that failed."""
    bad = [c for c in checks if c.passed is False]
    if bad:
        raise GateError("; ".join(f"{c.name}: {c.detail}" for c in bad))


def validate_contract(path: str | Path, actual: dict[str, object]) -> list[Check]:
    """A TOML contract against actual settings: dotted names to values; lists are compared as sets."""
    with open(path, "rb") as f:
        wanted = tomllib.load(f)

    def walk(node: dict, at: str):
        for k, v in node.items():
            name = f"{at}.{k}" if at else k
            if isinstance(v, dict):
                yield from walk(v, name)
            else:
                yield name, v

    out = []
    for name, value in walk(wanted, ""):
        have = actual.get(name)
        alike = set(map(str, have)) == set(map(str, value)) if isinstance(value, list) and isinstance(have, (list, tuple, set)) else have == value
        out.append(Check(name, alike if name in actual else None, f"wanted {value}, have {have}"))
    return out


def markdown(checks: list[Check]) -> str:
    """The checks as a table."""
    return "\n".join(["| Check | Status | Detail |", "| --- | --- | --- |", *[f"| {c.name} | {c.status} | {c.detail} |" for c in checks]])
