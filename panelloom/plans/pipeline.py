"""The stages from a long panel to a clean wide panel, as one declarative plan with written evidence."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions import labels as L
from panelloom.operators import clean as C
from panelloom.operators import dictionary as D
from panelloom.operators import longform as G
from panelloom.operators import wide as W
from panelloom.plans.options import HarmonizeOptions, WideOptions, parse_years
from panelloom.runtime import materialise


@dataclass
class Build:
    """The outputs of a wide build: the final long rows, the wide panel, the dimension lane and the QC tables."""

    staged: DataFrame
    final: DataFrame
    dimension: DataFrame
    targets: list[str] = field(default_factory=list)
    wide: DataFrame | None = None
    qc: dict[str, DataFrame] = field(default_factory=dict)


def harmonise(parts: list[DataFrame], dictionary: DataFrame, overrides: DataFrame, inventory: DataFrame, o: HarmonizeOptions = HarmonizeOptions()) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Yearly long frames to one panel of unique keys, with the gates of the stage and their evidence.

    Releases of another type, rows without UNITID and ambiguous dictionary keys raise GateError where the options ask for it;
    ``source_priority`` names sources from most to least trusted.
    """
    panel = G.stitch(parts)
    years = parse_years(o.years) if o.years else sorted(r.year for r in panel.select("year").where("year is not null").distinct().collect())
    panel = panel.where(F.col("year").isin(years))
    qc = {"releases": G.release_gate(inventory, years, o.release_type, o.strict_release), "missing_units": G.unit_gate(panel, o.strict_units)}
    lake = D.normalised(dictionary)
    qc["ambiguities"] = D.ambiguity_gate(lake, overrides) if o.strict_release else D.settle(lake, overrides).where("not settled")
    return G.dedupe(panel.where("UNITID is not null"), {s.upper(): k for k, s in enumerate(o.source_priority)}), qc


def build(panel: DataFrame, dictionary: DataFrame, o: WideOptions = WideOptions()) -> Build:
    """Stage, split lanes, find conflicts, collapse indicators, keep one row per cell, pivot all variables and report.

    What several branches read is written once. With the conflict gate on, conflicts raise GateError after their rows have
    been written (``evidence`` of the error); with it off, all rows of a conflicting key are removed. Identifiers that
    ``anti_garbage_ids`` names raise too unless their columns are to be dropped.
    """
    staged = W.stage(panel, parse_years(o.years) if o.years else None)
    kept = staged.where(~staged.varname.isin(*[e.upper() for e in o.exclude_vars])) if o.exclude_vars else staged
    scalar, dimension = W.lanes(kept, o.dim_sources, o.dim_prefixes) if o.lane_split else (kept.distinct(), kept.limit(0))
    base = materialise(W.base_rows(scalar), "base")
    keys = W.conflict_keys(base)
    conflicts = W.conflict_rows(base, keys)
    if o.conflict_max_rows:  # the report's budget, earliest years first
        conflicts = conflicts.orderBy("year", "UNITID", "varnumber", "source_file", "varname", "value_norm").limit(o.conflict_max_rows)
    qc = {"scalar_conflicts": materialise(conflicts, "scalar-conflicts")}
    if o.scalar_conflict_gate and not qc["scalar_conflicts"].isEmpty():
        raise _failed(f"{keys.count()} keys hold several values", qc["scalar_conflicts"])
    rows = W.without_conflicts(base, keys)
    if o.collapse_disc:
        indicators = materialise(W.indicator_map(dictionary), "indicators")
        active = W.active_indicators(rows, indicators)
        choice = materialise(W.indicator_choice(active), "choice")
        qc["indicator_conflicts"] = W.indicator_conflicts(active, choice, o.disc_high_signal_min_rows)
        rows = W.collapse(rows, indicators, choice, o.disc_suffix, o.drop_disc_components)
    qc["duplicate_groups"] = W.duplicate_groups(rows)
    final = materialise(W.final_rows(rows, o.prefer_non_null), "final")
    found = W.variable_counts(W.discover(final))
    if o.drop_empty_cols:
        found = found.where("n_non_empty > 0")
    if o.anti_garbage_ids:
        hits = found.where(L.identifier_like(F.col("varname"), o.anti_garbage_ids))
        if not o.drop_anti_garbage_cols and not hits.isEmpty():
            raise _failed("identifiers among the variables", hits)
        found = found.join(hits.select("varname"), "varname", "left_anti")
    targets = W.order_targets([r.varname for r in found.select("varname").collect()])  # columns of a table
    numeric = W.numeric_variables(dictionary)
    typed = {r.varname for r in numeric.collect()} if o.typed_output else set()
    spine = W.spine(staged)
    qc["cast_report"] = W.cast_report(final, numeric.where(F.col("varname").isin(targets)) if targets else numeric.limit(0))
    qc["year_summary"] = W.year_summary(final.where(F.col("varname").isin(targets)) if targets else final.limit(0), spine, max(1, len(targets)), qc["duplicate_groups"])
    qc["lineage"] = W.column_lineage(W.discover(staged), indicators if o.collapse_disc else W.indicator_map(dictionary).limit(0))
    return Build(staged, final, dimension, targets, W.pivot_blocks(final, spine, targets, typed, o.block), qc)


def _failed(message: str, evidence: DataFrame) -> G.GateError:
    error = G.GateError(message)
    error.evidence = evidence
    return error


def clean_panel(wide: DataFrame, sources_of: dict[str, str], flags: list[str] | None = None) -> DataFrame:
    """The cleaned panel: same rows and columns; gates on lineage and on single-year panels come first."""
    C.check_lineage(wide.columns, sources_of)
    C.check_several_years(wide)
    found = flags or [c for c in wide.columns if c.upper().startswith("PRCH")]
    return C.blank_children(wide, C.flag_targets(found, sources_of))


def run(stages: list[tuple[str, Callable[[], object]]], skip: tuple[str, ...] = (), dry_run: bool = False) -> list[str]:
    """Run named stages in order and return what was (or would be) run; the first failure ends it."""
    done = []
    for name, act in stages:
        if name in skip:
            continue
        if not dry_run:
            act()
        done.append(name)
    return done
