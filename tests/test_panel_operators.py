import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelloom.functions.policy import policy_of
from panelloom.operators import clean, compare, dictionary, gates, longform, monitor, structure, wide
from panelloom.operators.longform import GateError
from panelloom.plans.catalog import SAVED, Catalog
from panelloom.plans.options import HarmonizeOptions, WideOptions, parse_years
from panelloom.plans.pipeline import build, clean_panel, harmonise, run
from tests.test_data_operators import rows_of

LONG = "year int, UNITID long, varname string, value string, source_file string, varnumber string"


def long(spark, rows):
    return spark.createDataFrame(rows, LONG)


LAKE = "year int, varnumber string, varname string, varTitle string, longDescription string, DataType string, format string, imputationvar string, source_file string, access_table_name string, metadata_table_name string, metadata_source string"


def lake(spark, rows):
    names = [c.split()[0] for c in LAKE.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], LAKE)


def test_conflict_gate(spark):
    rows = long(spark, [(2010, 1, "A", "1", "S", "1"), (2010, 1, "A", "2", "S", "1"), (2010, 1, "B", "1", "S", "2"), (2010, 2, "A", ".", "S", "1"), (2010, 2, "A", "3", "S", "1")])
    d = lake(spark, [])
    with pytest.raises(GateError) as failed:
        build(rows, d)
    assert rows_of(failed.value.evidence, "value_norm") == [("1",), ("2",)]  # written before the gate fails
    with pytest.raises(GateError) as failed:
        build(rows, d, WideOptions(conflict_max_rows=1))
    assert failed.value.evidence.count() == 1
    b = build(rows, d, WideOptions(scalar_conflict_gate=False))
    assert b.qc["scalar_conflicts"].count() == 2
    assert rows_of(b.final, "UNITID", "varname", "value_norm") == [(1, "B", "1"), (2, "A", None)]  # a null beats a value of the same source
    kept = build(rows, d, WideOptions(scalar_conflict_gate=False, prefer_non_null=True)).final
    assert rows_of(kept, "UNITID", "varname", "value_norm") == [(1, "B", "1"), (2, "A", "3")]
    assert b.staged.count() == 5 and wide.spine(b.staged).count() == 2


def test_final_rows_ignore_input_order(spark):
    rng = random.Random(1)
    rows = [(2010, rng.randint(1, 4), rng.choice("AB"), rng.choice(["1", "2", None, " 2"]), rng.choice("ST"), rng.choice("12")) for _ in range(60)]
    one = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = rows_of(wide.final_rows(wide.base_rows(wide.stage(long(spark, rows).repartition(seed + 1)))), *wide.STAGE)
        one = one or got
        assert got == one


def test_pivot_keeps_every_unit_and_melts_back(spark):
    rows = long(spark, [(2010, 1, "A", "1", "S", "1"), (2010, 1, "B", "x", "S", "2"), (2011, 1, "A", "bad", "S", "1"), (2011, 2, "Z", "5", "S", "9")])
    staged = wide.stage(rows)
    final = wide.final_rows(wide.base_rows(staged))
    w = wide.pivot(final, wide.spine(staged), ["B", "A"], {"A"})
    assert w.columns == ["year", "UNITID", "B", "A"]
    assert rows_of(w, "year", "UNITID", "B", "A") == [(2010, 1, "x", 1.0), (2011, 1, None, None), (2011, 2, None, None)]
    back = longform.melt(wide.pivot(final, wide.spine(staged), ["A", "B"]), ["year", "UNITID"]).where("value is not null")
    assert rows_of(back, "year", "UNITID", "varname", "value") == rows_of(final.where("varname in ('A', 'B')"), "year", "UNITID", "varname", "value_norm")
    report = {(r.year, r.column): r.failed_parse_tokens for r in wide.cast_report(final, spark.createDataFrame([("A",), ("Q",)], "varname string")).collect()}
    assert report == {(2010, "A"): 0, (2011, "A"): 1, (2010, "Q"): 0, (2011, "Q"): 0}


def test_indicators(spark):
    d = lake(spark, [{"varname": f"LEVEL{i}", "format": "Disc"} for i in (1, 2, 3)] + [{"varname": "SOLO1", "format": "Disc"}])
    groups = wide.indicator_map(d)
    assert rows_of(groups, "varname", "base", "suffix") == [("LEVEL1", "LEVEL", "1"), ("LEVEL2", "LEVEL", "2"), ("LEVEL3", "LEVEL", "3")]
    base = wide.base_rows(wide.stage(long(spark, [
        (2010, 1, "LEVEL1", "1", "IC", ""), (2010, 1, "LEVEL2", "1", "IC", ""), (2010, 2, "LEVEL2", "yes", "IC", ""), (2010, 2, "LEVEL1", "0", "IC", ""), (2010, 3, "LEVEL3", "0", "A", ""),
        (2010, 3, "LEVEL3", "1", "B", ""), (2010, 2, "INSTNM", "n", "IC", ""), (2010, 4, "LEVEL", "5", "IC", ""),
    ])))
    active = wide.active_indicators(base, groups)
    choice = wide.indicator_choice(active)
    assert rows_of(choice, "UNITID", "base", "n_active", "chosen_suffix") == [(1, "LEVEL", 2, "1"), (2, "LEVEL", 1, "2")]  # an inactive first row hides unit 3's
    out = wide.collapse(base, groups, choice)
    assert rows_of(out, "UNITID", "varname", "value") == [(2, "INSTNM", "n"), (2, "LEVEL_CAT", "2"), (4, "LEVEL", "5")]
    assert [(r.row_count, r.signal_level) for r in wide.indicator_conflicts(active, choice).collect()] == [(2, "expected")]
    assert wide.collapsed_names(["B", "A"], {"A", "A_CAT"}) == {"A": "A_CAT1", "B": "B"}


def test_names():
    assert wide.order_targets(["XB", "B", "A", "XZ"]) == ["A", "B", "XB", "XZ"]
    assert parse_years("2010:2012") == [2010, 2011, 2012] and parse_years("2010, 2012") == [2010, 2012]
    assert clean.parse_columns("a, b # c\nyear,A\nb") == ["a", "b", "A"]


def test_long_dedupe_and_gates(spark):
    cols = ", ".join(f"{c} {'int' if c == 'year' else 'long' if c == 'UNITID' else 'string'}" for c in longform.PANEL_COLUMNS)
    make = lambda **k: tuple(k.get(c) for c in longform.PANEL_COLUMNS)
    df = spark.createDataFrame([make(), make(year=2010, UNITID=1, varnumber="1", source_file="S", varname="B", value="1"), make(year=2010, UNITID=1, varnumber="1", source_file="S", varname="A", value=None), make(year=2010, UNITID=1, varnumber="1", source_file="S", varname="A", value="0")], cols)
    got = longform.dedupe(df).collect()
    assert len(got) == 1 and (got[0].varname, got[0].value) == ("A", "0")
    with pytest.raises(GateError):
        longform.check_stitched(df, [2010])
    longform.check_stitched(longform.dedupe(df), [2010])
    with pytest.raises(GateError):
        longform.check_stitched(longform.dedupe(df), [2010, 2011])
    with pytest.raises(GateError):
        longform.join_dictionary(df, spark.createDataFrame([("A", "t"), ("A", "u")], "varname string, t string"), ["varname"], ["t"])


def test_cleaning(spark):
    df = spark.createDataFrame([(2010, 1, "4", 9.0, 1.0, "k"), (2011, 1, "6", 8.0, 2.0, "k"), (2011, 2, None, 7.0, 3.0, None)], "year int, UNITID long, PRCH_F string, FINVAL double, COMPDRV double, OTHER string")
    sources = {"PRCH_F": "FLAGS", "FINVAL": "F_FA", "COMPDRV": "DRVC", "OTHER": "HD"}
    got = clean_panel(df, sources)
    assert rows_of(got, "year", "UNITID", "FINVAL", "COMPDRV", "OTHER") == [(2010, 1, None, 1.0, "k"), (2011, 1, 8.0, 2.0, "k"), (2011, 2, 7.0, 3.0, None)]
    assert got.schema == df.schema and got.count() == df.count()
    with pytest.raises(GateError):
        clean_panel(df, {"FINVAL": "F_FA"})
    with pytest.raises(GateError):
        clean_panel(df.where("year = 2010"), sources)
    cover = clean.flag_coverage(df, got, clean.flag_targets(["PRCH_F"], sources)).first()
    assert (cover.status, cover.child_rows_raw, cover.review_rows_raw) == ("cleaned", 1, 1)
    assert clean.flag_coverage(df, df, clean.flag_targets(["PRCH_F"], sources)).first().status == "suspicious"
    assert policy_of("PRCHTP_F").targets("F_F") is False and policy_of("prch_s").targets("S_NEW") and policy_of("x").blanked == (2,)
    assert clean.custom_extract(df, ["other", "FINVAL"], 2011).columns == ["year", "UNITID", "OTHER", "FINVAL"]
    with pytest.raises(KeyError):
        clean.custom_extract(df, ["nope"])
    assert clean.align(df, spark.createDataFrame([], "UNITID int, NEW double").schema).dtypes == [("UNITID", "int"), ("NEW", "double")]


def test_structure(spark):
    df = spark.createDataFrame([(y, u, o, f"n{u}", c) for y, u, o, c in [(2010, 1, "a", "1"), (2012, 1, "b", "2"), (2010, 2, "c", "1"), (2011, 2, "c", "1"), (2012, 2, "c", "1"), (2012, 3, "c", None), (2010, 4, None, "1")]], "year int, UNITID long, OPEID string, INSTNM string, CONTROL string")
    p = {r.UNITID: r for r in structure.unit_patterns(df).collect()}
    assert [p[u].pattern for u in (1, 2, 3, 4)] == ["intermittent_gap", "always_present", "entered_after_start", "exited_before_end"]
    assert p[1].possible_identifier_linkage_case and p[2].stable_opeid == "c" and p[4].stable_opeid == ""
    s = {r.variable: r for r in structure.class_stability(df).collect()}["CONTROL"]
    assert (s.units_observed, s.units_changed) == (3, 1)
    link = {r.year: r for r in structure.linkage(df).collect()}
    assert link[2012].shared_opeid_groups == 1 and link[None].unitids_with_multiple_opeid == 1 and link[None].opeids_with_multiple_unitids == 1
    bench = spark.createDataFrame([("a", "2012", "panel_rows", "", "3", "", ""), ("b", "2012", "mean", "CONTROL", "9", "1", ""), ("c", "1999", "panel_rows", "", "1", "", "")], "benchmark_id string, year string, metric string, column string, expected_value string, tolerance_abs string, tolerance_rel string")
    got = structure.reconcile(structure.benchmark_metrics(df, ["CONTROL"]), bench)
    assert rows_of(got, "benchmark_id", "status") == [("a", "PASS"), ("b", "FAIL"), ("c", "FAIL")]


def test_dictionary(spark):
    d = dictionary.normalised(lake(spark, [
        {"year": 2010, "source_file": "S2010", "varnumber": "1", "varname": " a", "imputationvar": "XA", "varTitle": "long title"}, {"year": 2010, "source_file": "S", "varnumber": "00000001", "varname": "A", "imputationvar": "XA"},
        {"year": 2014, "source_file": "S", "varnumber": "5", "varname": "B", "imputationvar": "B"},
    ]))
    assert d.count() == 2
    assert rows_of(dictionary.nearest_donors(d, [2009, 2012, 2013, 2014, 2020]), "year", "donor_year") == [(2009, 2010), (2012, 2010), (2013, 2014), (2020, 2014)]
    filled = dictionary.backfill(d, dictionary.nearest_donors(d, [2012]))
    assert rows_of(filled, "year", "varname", "metadata_source") == [(2012, "A", "year_backfill")]
    starts = dictionary.surrogate_starts(d).collect()
    assert [(r.imputationvar, r.start) for r in starts] == [("XA", dictionary.surrogate_start(2010, "S", "XA", "00000001"))]
    taken = spark.createDataFrame([(f"{starts[0].start:08d}",)], "varnumber string")
    assert dictionary.surrogate_rows(spark, dictionary.surrogate_starts(d), taken).first().varnumber == f"{starts[0].start + 1:08d}"
    assert dictionary.surrogate_start(2010, "S", "X", "") >= 85_000_000


def test_overrides_settle_ambiguity(spark):
    d = dictionary.normalised(lake(spark, [{"year": 2010, "source_file": "S", "varnumber": n, "varname": "A", "access_table_name": "T"} for n in ("1", "2")]))
    over = lambda rows: spark.createDataFrame(rows, "override_id long, year string, source_file string, access_table_name string, varname string, selected_varnumber string, selected_metadata_source string, selected_metadata_table_name string")
    one = dictionary.settle(d, over([(1, "", "", "", "a", "2", "", "")])).first()
    assert (one.n_candidates, one.n_overrides, one.n_selected, one.settled) == (2, 1, 1, True)
    assert not dictionary.settle(d, over([(1, "", "", "", "a", "2", "", ""), (2, "2010", "s", "", "A", "1", "", "")])).first().settled
    assert not dictionary.settle(d, over([(1, "2011", "", "", "a", "2", "", "")])).first().settled
    assert not dictionary.settle(d, over([(1, "", "", "", "a", "", "", "")])).first().settled


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["x", "y", None])), max_size=12), b=st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["x", "y", None])), max_size=12))
def test_multiset_difference_is_symmetric(spark, a, b):
    x, y = spark.createDataFrame(a, "k int, v string"), spark.createDataFrame(b, "k int, v string")
    left = {(r.k, r.v): r.surplus for r in compare.multiset_difference(x, y).collect()}
    assert left == {k: a.count(k) - b.count(k) for k in {*a, *b} if a.count(k) != b.count(k)}
    assert compare.same(x, y) == (not left)


def test_compare(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (1, "x"), (3, "z")], "k int, v string")
    assert rows_of(compare.keyed_changes(a, b, ["k"], ["v"]), "k", "change") == [(2, "removed"), (3, "added")]
    assert compare.schema_difference(a, b.withColumn("n", F.lit(1)).withColumn("k", F.col("k").cast("long"))) == [("added", "n", "", "int"), ("retyped", "k", "int", "bigint")]
    issues = spark.createDataFrame([("c", "a", "d", "fail"), ("c", "b", "d", "fail")], "category string, artifact string, detail string, severity string")
    waived = compare.apply_waivers(issues, spark.createDataFrame([("c", "a", "")], "category string, artifact string, detail string"))
    assert rows_of(waived, "artifact", "severity") == [("a", "pass"), ("b", "fail")]


def test_options_of_the_build(spark):
    rows = long(spark, [(2010, 1, "A", "1", "S", "1"), (2010, 1, "PRG", "9", "S", "2"), (2010, 1, "E", ".", "S", "3"), (2011, 2, "A", "x", "S", "1"), (2011, 2, "F1", "1", "S", "4"), (2011, 2, "F2", "0", "S", "5"), (2011, 2, "F", "q", "S", "6"), (2011, 2, "F_CAT", "q", "S", "7")])
    d = lake(spark, [{"varname": v, "DataType": t} for v, t in (("A", "num"), ("F1", "disc"), ("F2", "disc"))])
    b = build(rows, d, WideOptions(anti_garbage_ids=("PRG",)))
    assert b.targets == ["A", "F", "F_CAT", "F_CAT1"] and dict(b.wide.dtypes)["A"] == "double"
    assert rows_of(b.wide, "UNITID", "A", "F", "F_CAT1") == [(1, 1.0, None, None), (2, None, "q", "1")]
    assert rows_of(b.qc["cast_report"].where("year = 2011"), "column", "failed_parse_tokens") == [("A", 1)]
    with pytest.raises(GateError):
        build(rows, d, WideOptions(anti_garbage_ids=("PRG",), drop_anti_garbage_cols=False))
    wide_open = build(rows, d, WideOptions(drop_empty_cols=False, drop_disc_components=False, typed_output=False))
    assert set(wide_open.targets) == {"A", "PRG", "E", "F", "F_CAT", "F_CAT1", "F1", "F2"} and dict(wide_open.wide.dtypes)["A"] == "string"


def test_harmonise_gates(spark):
    cols = "year int, UNITID long, varname string, varnumber string, value string, imputation_value string, source_file string, access_table_name string"
    one = spark.createDataFrame([(2010, 1, "A", "1", "b", None, "S", "T"), (2010, 1, "A", "1", "a", None, "S", "T"), (2010, None, "A", "1", "z", None, "S", "T")], cols)
    two = spark.createDataFrame([(2011, 1, "A", "1", "c", None, "S", "T")], cols)
    final = spark.createDataFrame([(2010, "Final"), (2011, "final ")], "year int, release_type string")
    over = spark.createDataFrame([], "override_id long, year string, source_file string, access_table_name string, varname string, selected_varnumber string, selected_metadata_source string, selected_metadata_table_name string")
    clear = lake(spark, [{"year": 2010, "varname": "A", "varnumber": "1", "source_file": "S", "access_table_name": "T"}])
    panel, qc = harmonise([one, two], clear, over, final)
    assert rows_of(panel, "year", "UNITID", "value") == [(2010, 1, "a"), (2011, 1, "c")] and qc["missing_units"].count() == 1
    for args, options in (
        ((clear, over, final.where("year = 2010")), HarmonizeOptions()),
        ((clear, over, final), HarmonizeOptions(strict_units=True)),
        ((lake(spark, [{"year": 2010, "varname": "A", "varnumber": n, "source_file": "S", "access_table_name": "T"} for n in "12"]), over, final), HarmonizeOptions()),
    ):
        with pytest.raises(GateError):
            harmonise([one, two], *args, options)


def test_many_years_and_targets_are_not_cut(spark):
    years = spark.range(10_001).selectExpr("CAST(id AS INT) AS year", "1L AS UNITID")
    assert longform.year_difference(years, list(range(10_001))) == ([], [])
    final = long(spark, [(2010, 1, "V20000", "5", "S", "1")]).withColumn("value_norm", F.col("value"))
    got = wide.cast_report(final, spark.range(20_001).selectExpr("concat('V', id) AS varname"))
    assert got.count() == 20_001 and rows_of(got.where("non_empty_tokens > 0"), "column") == [("V20000",)]


def test_acceptance_and_contract(spark, tmp_path):
    key = "year int, UNITID long, varnumber string, source_file string"
    long_rows = spark.createDataFrame([(2010, 1, "1", "S")], key)
    w = spark.createDataFrame([(2010, 1, "n")], "year int, UNITID long, INSTNM string")
    good = gates.acceptance(long_rows, w, w, [2010])
    assert gates.certify(good) == "Certified parity" and "PASS" in gates.markdown(good)
    bad = gates.acceptance(long_rows, w, w.union(w), [2010])
    assert gates.certify(bad) == "Not certified"
    with pytest.raises(GateError):
        gates.require(bad)
    spec = tmp_path / "c.toml"
    spec.write_text('[wide]\nblock = 48\nsources = ["A", "B"]\n[x]\ny = 1\n')
    assert [c.passed for c in gates.validate_contract(spec, {"wide.block": 48, "wide.sources": ["B", "A"]})] == [True, True, None]


def test_catalog(spark, tmp_path):
    c = Catalog(spark, {"panel_clean": spark.createDataFrame([(2010, 1), (2010, 2)], "year int, UNITID long")})
    for name in SAVED:
        c.run(name).collect()
    assert [tuple(r) for r in c.run("clean_panel_rows_by_year").collect()] == [(2010, 2, 2)]
    m = c.export("clean_panel_rows_by_year", str(tmp_path / "out"))
    assert m["rows"] == 1 and m["preview"][0]["distinct_unitids"] == 2 and "Scan" in c.explain("clean_panel_rows_by_year")
    f = tmp_path / "q.sql"
    f.write_text("SELECT count(*) AS n FROM inspect.panel_clean;;\n")
    assert c.run(str(f)).first().n == 2
    with pytest.raises(KeyError):
        Catalog(spark, {"nope": spark.range(1)})


def test_stages():
    seen = []
    stages = [("a", lambda: seen.append("a")), ("b", lambda: seen.append("b"))]
    assert run(stages, skip=("a",)) == ["b"] and seen == ["b"]
    assert run(stages, dry_run=True) == ["a", "b"] and seen == ["b"]


def test_seeds_and_severities(spark):
    plan = monitor.plan_seeds([{"column_name": " old ", "dtype": "double"}, {"column_name": "OLD"}, {"column_name": "A"}, {"column_name": ""}], {"A"})
    assert [(p["column_name"], p["seeded"]) for p in plan] == [("OLD", True), ("A", False)]
    assert monitor.add_seeds(spark.createDataFrame([(1,)], "A int"), plan).dtypes == [("A", "int"), ("OLD", "double")]
    issues = spark.createDataFrame([("review",)], "severity string")
    monitor.fail_on(issues)
    with pytest.raises(GateError):
        monitor.fail_on(issues, "review")


def test_parity(spark):
    a = spark.createDataFrame([(2010, 1, "x"), (2010, 2, None)], "year int, UNITID long, v string")
    assert all(c.passed for c in monitor.parity(a, a, ["UNITID", "year"]))
    assert [c.passed for c in monitor.parity(a, a.withColumn("v", F.lit("y")), ["UNITID", "year"])] == [True, True, True, False]


def test_telemetry(spark):
    runs = spark.sql("SELECT 1L AS run_id, 'wide' AS stage, TIMESTAMP '2020-01-01 00:00:00' AS started_at, '' AS years_spec, 5L AS n_rows, '{\"lane_split\": true}' AS config_json UNION ALL SELECT 2L, 'wide', TIMESTAMP '2020-01-01 00:01:00', '', 6L, '{}'")
    assert [(r.run_id, r.seconds_since, r.lane_split) for r in monitor.telemetry(runs).collect()] == [(2, 60.0, None), (1, None, "true")]
