"""The general data-processing operators: nulls, repeats, ties, empty tables, clashing columns, skew, brute force."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from panelloom.sources.versions import Versions
from panelloom.operators import copies, drifting, eav, orphans, quality_profile, ranking
from panelloom.runtime import bounded, fits_broadcast, pick

PANEL = "row_id long, year int, UNITID long, varname string, varnumber string, value string, DataType string, source_file string, loaded_at timestamp_ntz"
T0 = datetime.datetime(2020, 1, 1)


def panel(spark, rows):
    """rows: (row_id, year, unit, varname, varnumber, value, type, source, seconds or None)"""
    return spark.createDataFrame([(*r[:8], None if r[8] is None else T0 + datetime.timedelta(seconds=r[8])) for r in rows], PANEL)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# --- p1


def test_wide_table(spark):
    df = panel(spark, [
        (1, 2020, 1, " a ", "1", "5", "num", "S", 1), (2, 2020, 1, "A", "1", "(7)", "num", "S", 2), (3, 2020, 1, "A", "1", "bad", "num", "S", 3), (4, 2020, 1, "B", "2", "x", "char", "S", 1),
        (5, 2020, 2, "A", "1", "bad", "num", "S", 1), (6, 2020, 2, "A", "1", "", "num", "S", 9), (7, 2020, None, "A", "1", "1", None, "S", 1), (8, 2020, 3, None, "1", "1", "num", "S", 1),
        (9, 2021, 1, "A", "1", None, "num", "S", 1), (10, 2021, 4, "YEAR", "1", "3", "num", "S", None),
    ])
    wide = eav.wide_table(df)
    got = {(r.UNITID, r.year): r for r in wide.collect()}
    assert set(got) == {(1, 2020), (2, 2020), (1, 2021), (4, 2021)}
    assert got[1, 2020].A == -7.0 and got[1, 2020].B == "x" and got[1, 2020].unparsed == []
    assert got[2, 2020].A is None and got[2, 2020].unparsed == ["A"]
    assert got[1, 2021].A is None and got[1, 2021].unparsed == []
    assert got[4, 2021]["YEAR_"] == 3.0
    assert rows_of(eav.unparsed_cells(wide), "UNITID", "year", "varname") == [(2, 2020, "A")]


def test_wide_table_ties_blocks_and_clashes(spark):
    df = panel(spark, [(i, 2020, 1, f"V{i % 7}", "1", str(i), "num" if i % 2 else "char", "S", 1) for i in range(70)])
    extra = df.withColumn("Value", F.lit("clash")).withColumn("bit", F.lit(3)).withColumn("at", F.lit(1)) if False else df.select("*", F.lit("x").alias("VALUE"), F.lit(3).alias("bit"))
    small = {r.UNITID: r.asDict() for r in eav.wide_table(extra, block=2).collect()}
    large = {r.UNITID: r.asDict() for r in eav.wide_table(df, block=48).collect()}
    assert small == large
    kept = {k: v for k, v in large[1].items() if k.startswith("V") and v is not None}
    assert len(kept) == 7 and all(float(v) == 63 + int(k[1:2]) for k, v in kept.items())  # equal times: the larger row id


def test_mixed_attributes_keep_numbers_and_texts(spark):
    """Numeric in 2020 only: a second column holds what is no number, so no value is lost without a trace."""
    df = panel(spark, [(1, 2020, 1, "M", "1", "5", "num", "S", 1), (2, 2021, 1, "M", "1", "B", "char", "S", 1), (3, 2021, 2, "M", "1", "6", "char", "S", 1), (4, 2020, 2, "M", "1", "C", "num", "S", 1), (5, 2022, 1, "M", "1", "Z", None, "S", 1)])
    got = {(r.UNITID, r.year): (r.M, r.M_TEXT, r.unparsed) for r in eav.wide_table(df).collect()}
    assert got == {(1, 2020): (5.0, None, []), (1, 2021): (None, "B", []), (2, 2021): (6.0, None, []), (2, 2020): (None, "C", ["M"]), (1, 2022): (None, "Z", [])}


def test_levels_of_the_join_tree_change_nothing(spark, folder, monkeypatch):
    df = spark.read.parquet(f"{folder}/panel_long.parquet")
    one = rows_of(eav.melted(eav.wide_table(df)), "UNITID", "year", "varname", "num", "text")
    monkeypatch.setattr(eav, "FAN", 3)
    assert rows_of(eav.melted(eav.wide_table(df, block=16)), "UNITID", "year", "varname", "num", "text") == one and len(one) > 1000


def test_wide_table_empty(spark):
    assert eav.wide_table(panel(spark, [])).collect() == []


def test_wide_plan_shuffles_once(spark):
    df = panel(spark, [(i, 2020, i % 3, f"V{i}", "1", str(i), "num", "S", 1) for i in range(9)])
    plan = eav.wide_table(df, block=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 5 and "Cartesian" not in plan and "NestedLoop" not in plan
    # One exchange below each aggregate, none between the joins.
    for line, below in zip(plan.splitlines(), plan.splitlines()[1:]):
        assert not ("Sort [" in line and "Exchange" in below)


# --- p2


def sides(spark, left, right):
    b = spark.createDataFrame(left, "relative_path string, year int, UNITID long, field string, baseline string")
    c = spark.createDataFrame(right, "relative_path string, year int, UNITID long, field string, current string")
    return b, c


def test_differences(spark):
    b, c = sides(
        spark,
        [("./p//a", 1, 1, "sector ", "1.0"), ("p/a", 1, 1, "INSTNM", "Ab"), ("p/a", 1, 1, "OPEID", "0012"), ("p/a", 1, 2, "SECTOR", None), ("p/a", 1, 3, "FINVAL", "5"), ("p/a", None, 4, "X", "1"), ("p/a", 1, 5, "FINVAL", "-0")],
        [("p\\a", 1, 1, "SECTOR", "1"), ("p/a", 1, 1, "SECTOR", "1"), ("p/a", 1, 1, "INSTNM", "AB"), ("p/a", 1, 1, "OPEID", "12"), ("p/a", 1, 3, "FINVAL", "."), ("p/a", 1, 6, "SECTOR", ""), ("p/a", 1, 5, "FINVAL", "0.0")],
    )
    got = rows_of(copies.differences(b, c), "UNITID", "year", "field", "kind")
    assert got == sorted([
        (1, 1, "INSTNM", "value_differs"), (1, 1, "OPEID", "value_differs"), (2, 1, "", "missing_in_current"), (3, 1, "FINVAL", "value_differs"),
        (4, None, "", "missing_in_current"), (6, 1, "", "missing_in_baseline"),
    ], key=repr)


def test_differences_empty_and_repeats(spark):
    rows = [("p", 1, 1, "SECTOR", "1")] * 50 + [(None, None, None, None, None)] * 3
    b, c = sides(spark, rows, [])
    assert copies.differences(c.withColumnRenamed("current", "baseline"), b.withColumnRenamed("baseline", "current")).count() == 2
    assert copies.differences(b, c).count() == 2
    assert copies.differences(b, b.withColumnRenamed("baseline", "current")).count() == 0
    clash = b.select("*", F.lit("z").alias("FIELD"), F.lit(1).alias("sign"))
    assert copies.differences(clash, b.withColumnRenamed("baseline", "current")).count() == 0


# --- p4


def test_running_totals_in_a_hot_group(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else rng.choice("abc"), i, rng.randint(0, 9)) for i in range(500)] + [(None, 999, None)]
    df = spark.createDataFrame(rows, "g string, i int, w int")
    got = {r.i: (r.position, r.before) for r in ranking.running_totals(df, ["g"], ["i"], F.col("w"), 7).collect()}
    for g in {r[0] for r in rows}:
        seen = total = 0
        for _, i, w in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            seen += 1
            assert got[i] == (seen, total)
            total += w or 0


def test_running_totals_refuses_clashes(spark):
    with pytest.raises(ValueError):
        ranking.running_totals(spark.createDataFrame([(1, 2)], "g int, position int"), ["g"], ["position"])


def test_median_of_others(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randint(1, 5), rng.randint(0, 6), i) for i in range(120)] + [("solo", 1, 3, 999), ("c", 1, None, 1000), ("c", 2, 5, 1001)]
    df = spark.createDataFrame(rows, "g string, p int, v int, i int")
    got = {(r.g, r.p): r.median for r in ranking.median_of_others(df, ["g"], "p", "v", ["i"]).collect()}
    in_blocks = {(r.g, r.p): r.median for r in ranking.median_of_others(df, ["g"], "p", "v", ["i"], block=4).collect()}
    assert got == in_blocks
    want = {}
    for g, p in {(r[0], r[1]) for r in rows if r[2] is not None}:
        rest = [r[2] for r in rows if r[0] == g and r[1] != p and r[2] is not None]
        if rest:
            want[g, p] = statistics.median(rest)
    assert got == want


REPORT = "report_id long, run_id long, year int, column string, non_empty_tokens long, parsed_numeric_tokens long, failed_parse_tokens long"


def test_report_issues(spark):
    rows = [(i, 1, 2010 + i, "A", 100, 99, 1) for i in range(5)] + [
        (10, 1, 2020, "A", 201, 199, 2), (11, 1, 2021, "A", 49, 49, 0), (12, 1, 2022, "A", 100, 88, 12), (13, 1, 2023, "A", None, 1, 1), (14, 1, 2023, "b c", 5, 5, 0),
        (15, 1, 2023, None, 5, 4, 2), (16, 1, 2009, "A", -1, -1, 0), (17, 1, 2010, "A", 100, 99, 1), (18, 1, 2008, "A", 0, 0, 0), (19, None, 2008, "A", 7, 7, 0), (20, 2, 2008, "A", 7, 7, 0),
    ]
    df = spark.createDataFrame(rows, REPORT).select("*", F.lit(1).alias("volume"), F.lit("x").alias("COLUMN"))
    assert rows_of(quality_profile.report_issues(df, small=2), "report_id", "issue") == rows_of(quality_profile.report_issues(df), "report_id", "issue") == sorted([
        (10, "volume_shift"), (11, "volume_shift"), (12, "failure_shift"), (13, "count_missing"), (14, "bad_column_name"), (15, "bad_column_name"), (15, "counts_disagree"),
        (16, "counts_disagree"), (18, "volume_shift"),
    ], key=repr)
    assert quality_profile.report_issues(df.limit(0)).count() == 0


def test_report_counts_persist_between_loads(spark, tmp_path):
    """Issues of a later load see what earlier loads left; a withdrawal takes its entries out of the medians again."""
    store = Versions(spark, f"file://{tmp_path}/counts", quality_profile.ENTRIES)
    first = spark.createDataFrame([(i, 1, 2010 + i, "A", 100, 99, 1) for i in range(4)], REPORT)
    later = spark.createDataFrame([(9, 1, 2020, "A", 300, 297, 3)], REPORT)
    assert quality_profile.report_issues(first, store).count() == 0
    assert rows_of(quality_profile.report_issues(later, store), "report_id", "issue") == [(9, "volume_shift")]
    left = store.advance(lambda c: quality_profile.apply_report_delta(c, quality_profile.report_counts(first, -1)))
    assert [(r.year, r.n) for r in left.collect()] == [(2020, 1)] and quality_profile.entry_issues(left).count() == 0
    # A version that is there is not written again.
    assert store.advance(lambda c: c.limit(0), number=3).count() == 1


def test_counts_take_deltas_back(spark):
    df = spark.createDataFrame([("x", None), ("x", "1"), (None, "1"), ("y", "2")], "a string, b string")
    counts = quality_profile.value_counts(df, F.lit("l"), ["a", "b"])
    more = quality_profile.apply_delta(counts, quality_profile.value_counts(df, F.lit("l"), ["a", "b"]))
    back = quality_profile.apply_delta(more, quality_profile.value_counts(df, F.lit("l"), ["a", "b"], -1))
    key = ("load", "column", "value", "n")
    assert rows_of(back, *key) == rows_of(counts, *key)
    m = {r.column: r for r in quality_profile.metrics(back, {"b": "^1$"}).collect()}
    assert (m["a"].n_rows, m["a"].n_null, m["a"].n_distinct, m["b"].n_violations) == (4, 1, 2, 1)
    assert m["a"].entropy == pytest.approx(0.918295834, abs=1e-8)
    assert quality_profile.metrics(counts.limit(0)).count() == 0


# --- p5


def test_orphans(spark):
    lake = spark.createDataFrame([(2010, "S", "1"), (2012, "s.csv", "00000001"), (2012, "T", "2"), (2012, None, None)], "year int, source_file string, varnumber string")
    refs = panel(spark, [
        (1, 2010, 1, "A", "1", "x", "num", "S", 1), (2, 2011, 1, "A", "1", "x", "num", "S2011", 1), (3, 2013, 1, "A", " 2", "x", "num", "t", 1), (4, 2009, None, "A", "2", None, None, "T", None),
        (5, 2010, 1, "A", "nan", "x", "num", "S", 1), (6, 2010, 1, "A", "3", "x", "num", None, 1), (7, 2009, 1, "A", "2", "x", "num", "S", 1),
        (8, None, 1, "A", "1", "x", "num", "S", 1), (9, 2010, 1, "A", "1", "x", "num", " ", 1),
    ])
    over = spark.createDataFrame([(1, "", "", "2"), (2, "2010", "", "1"), (3, "2013", "T", "2"), (4, None, "S", "9"), (5, "x", "S", ""), (6, "2011", "", "2"), (7, "", "S", "1")], "override_id long, year string, source_file string, selected_varnumber string")
    got = rows_of(orphans.orphans(refs, lake, over), "table_name", "year", "record_id", "kind")
    o, p = "dictionary_ambiguity_overrides", "panel_long"
    assert got == sorted([(p, 2011, 2, "missing"), (p, 2013, 3, "deleted"), (p, 2009, 4, "late"), (p, 2010, 6, "missing"), (p, 2009, 7, "missing"), (p, 0, 8, "missing"), (p, 2010, 9, "missing"), (o, 2013, 3, "deleted"), (o, 0, 4, "missing"), (o, 2011, 6, "late")], key=repr)
    assert orphans.orphans(refs.limit(0), lake.limit(0), over.limit(0)).count() == 0
    assert {r.kind for r in orphans.orphans(refs, lake.limit(0), over.limit(0)).collect()} == {"missing"}


def test_a_deletion_before_its_arrival_cancels(spark):
    none = orphans.start(spark)
    refs = spark.createDataFrame([("t", "S", "1", 2010, 1)], none.counts.schema)
    parent = lambda n: spark.createDataFrame([("S", "1", 2010, n)], none.index.schema)
    state = orphans.persist(orphans.advance(orphans.advance(none, refs, parent(-1)), none.counts, parent(1)))
    assert state.index.count() == 0 and state.pending.count() == 1
    assert orphans.advance(state, none.counts, parent(1)).pending.count() == 0


def test_pending_state_follows_arrivals_and_deletions(spark):
    rng = random.Random(11)
    state = orphans.start(spark)
    live: dict = {}
    refs: dict = {}
    for step in range(4):
        new = {("S" if rng.random() < 0.7 else "", v): rng.randint(1, 3) for v in rng.sample("1234", 2)}
        move = {v: rng.choice([1, 1, -live.get(v, 0)]) for v in rng.sample("1234", 2)}
        move = {v: n for v, n in move.items() if n}
        for k, n in new.items():
            refs[k] = refs.get(k, 0) + n
        for v, n in move.items():
            live[v] = live.get(v, 0) + n
        batch = spark.createDataFrame([(orphans.OPEN_TABLE, s, v, 2010, n) for (s, v), n in new.items()], state.counts.schema)
        parents = spark.createDataFrame([("S", v, 2010 if v != "4" else 2012, n) for v, n in move.items()], state.index.schema)
        state = orphans.persist(orphans.advance(state, batch, parents))
        met = lambda v: live.get(v, 0) > 0 and v != "4"  # noqa: E731, B023
        kind = lambda v: "late" if v == "4" and live.get(v, 0) > 0 else "missing"  # noqa: E731, B023
        assert {(r.source_file, r.varnumber): (r.n, r.kind) for r in state.pending.collect()} == {k: (n, kind(k[1])) for k, n in refs.items() if not met(k[1])}
        assert sum(r.n_references for r in orphans.snapshot(state.pending).collect()) == sum(n for k, n in refs.items() if not met(k[1]))


# --- p6


def node(*fields):
    import pandas as pd

    return drifting._tree(pd.DataFrame([(v, n, {"numeric": True, "text": False}.get(k)) for v, n, k in fields], columns=["varname", "varnumber", "is_numeric"], dtype=object), "f")


def test_classify():
    a = node(("A", "1", "numeric"), ("B", "2", "text"), ("C", "3", "numeric"), ("D", "4", "text"))
    b = node(("A", "1", "text"), ("B2", "2", "text"), ("C", "9", "numeric"), ("E", "5", "numeric"))
    assert drifting.classify(a, b) == [("added", "E"), ("removed", "D"), ("renamed", "B2"), ("renumbered", "C"), ("type_changed", "A")]
    assert drifting.classify(a, a) == []


def test_operations_equal_the_definition():
    """The changes that the scripts' operations give against the definition by names and numbers, on random files."""
    rng = random.Random(12)
    for _ in range(400):
        files = []
        for _ in range(2):
            pairs = {(rng.choice("ABCDEF"), rng.choice("123456")) for _ in range(rng.randint(0, 6))}
            kind = {v: rng.choice(["numeric", "text", ""]) for v, _ in pairs}
            files.append([(v, n, kind[v]) for v, n in pairs])
        a, b = files
        names_a, nums_a, both_a = {x[0] for x in a}, {x[1] for x in a}, {x[:2] for x in a}
        names_b, nums_b = {x[0] for x in b}, {x[1] for x in b}
        want = {("renamed", v) for v, n, _ in b if n in nums_a and (v, n) not in both_a} | {("renumbered", v) for v, n, _ in b if v in names_a and (v, n) not in both_a}
        want |= {("added", v) for v, n, _ in b if v not in names_a and n not in nums_a} | {("removed", v) for v, n, _ in a if v not in names_b and n not in nums_b}
        was = {x[0]: x[2] for x in a}
        want |= {("type_changed", v) for v, _, k in b if k and was.get(v) and was[v] != k}
        assert drifting.classify(node(*a), node(*b)) == sorted(want), (a, b)


def test_costs_decide_what_a_name_became():
    """A name that goes can have become either of two; the one that shares more of its numbers costs less."""
    a = node(("OLD", "1", "text"), ("OLD", "2", "text"), ("OLD", "3", "text"))
    b = node(("FEW", "1", "text"), ("MANY", "2", "text"), ("MANY", "3", "text"))
    pairs = {(x.label, y.label) for x, y in drifting._match(a.children[0], b.children[0])[1] if x is not None and y is not None and x.keyed}
    assert pairs == {("OLD", "MANY")}
    cheap = drifting.RELABEL
    try:  # where a new label costs more than a delete and an add, nothing is carried over
        drifting.RELABEL = 9.0
        assert not [1 for x, y in drifting._match(a.children[0], b.children[0])[1] if x is not None and y is not None and x.keyed]
    finally:
        drifting.RELABEL = cheap


def test_drifting_tables_become_one(spark):
    old = spark.sql("SELECT 1 AS a, '7' AS b, named_struct('x', 1, 'y', 'u') AS s, 'gone' AS g")
    ident = lambda df, name, i: df.withMetadata(name, {"id": i})
    new = spark.sql("SELECT 2L AS a, 9 AS b2, named_struct('y', 'w', 'z', 3.5D) AS s, 'n' AS extra")
    one, report = drifting.unify([ident(old, "b", 4), ident(new, "b2", 4)])
    assert one.columns == ["a", "b2", "s", "extra", "g"] and one.schema["a"].dataType.simpleString() == "bigint"
    rows = [r.asDict(recursive=True) for r in one.collect()]
    assert rows[0] == {"a": 1, "b2": 7, "s": {"y": "u", "z": None, "x": 1}, "extra": None, "g": "gone"}
    assert rows[1] == {"a": 2, "b2": 9, "s": {"y": "w", "z": 3.5, "x": None}, "extra": "n", "g": None}
    assert {("rename", "b2"), ("retype", "a"), ("add", "extra"), ("delete", "g"), ("delete", "s.x"), ("add", "s.z")} <= {(o, p) for _, o, p in report}


def test_scripts_are_of_least_cost():
    import itertools

    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 4)
        cost = [[rng.randint(0, 9) for _ in range(n + rng.randint(0, 1))] for _ in range(n)]
        width = len(cost[0])
        cost = [r[:width] + [9] * (width - len(r)) for r in cost]
        got = drifting.assignment(cost)
        best = min(sum(cost[i][p[i]] for i in range(n)) for p in itertools.permutations(range(width), n))
        assert len(set(got)) == n and sum(cost[i][got[i]] for i in range(n)) == best


def test_nested_schemas_move_and_retype():
    s = lambda *f: StructType([StructField(n, t) for n, t in f])
    a = s(("x", IntegerType()), ("in", s(("y", StringType()), ("z", StringType()))), ("l", ArrayType(IntegerType())))
    b = s(("x", DoubleType()), ("in", s(("z", StringType()))), ("out", s(("y", StringType()))), ("l", ArrayType(DoubleType())))
    ops = [(o, x and x.label, y and y.label) for o, x, y in drifting.edit_script(drifting.schema_tree(a), drifting.schema_tree(b))]
    assert ("retype", "x", "x") in ops and ("retype", "element", "element") in ops
    assert any(o == "add" and y == "out" for o, _, y in ops)


def test_changes_and_one_table(spark):
    lake = spark.createDataFrame([(y, "S", n) for y in (2010, 2011, 2013) for n in ("1", "2", "3")], "year int, source_file string, varnumber string")
    df = panel(spark, [
        (1, 2010, 1, "A", "1", "5", "num", "S", 1), (2, 2010, 1, "B", "2", "x", "char", "S", 1), (3, 2011, 1, "A2", "1", "6", "num", "S", 1), (4, 2011, 1, "B", "2", "7", "num", "S", 1),
        (5, 2013, 1, "A2", "1", "8", None, "S", 1), (6, 2013, 1, "C", "3", "9", "num", "S", 1), (7, 2013, 1, "Z", "99", "9", "num", "S", 1), (8, 2012, 1, "A", "1", "5", "num", "S", 1),
    ]).select("*", F.lit("q").alias("YEAR"))
    schemas = drifting.file_schemas(df, lake)
    got = rows_of(drifting.changes(schemas), "source_file", "year", "change", "varname")
    assert got == sorted([("S", 2011, "renamed", "A2"), ("S", 2011, "type_changed", "B"), ("S", 2013, "added", "C"), ("S", 2013, "removed", "B")], key=repr)
    one = {r.row_id: r for r in drifting.consistent(df, lake).collect()}
    assert one[1].field == one[3].field == one[5].field == "A2" and set(one) == {1, 2, 3, 4, 5, 6, 7, 8}
    assert (one[7].field, one[7].text, one[7].resolved, one[8].resolved, one[1].resolved) == ("Z", "9", False, False, True)
    assert one[2].text == "x" and one[4].number == 7.0
    assert drifting.changes(drifting.file_schemas(df.limit(0), lake)).count() == 0
    assert drifting.changes(drifting.file_schemas(df, lake.limit(0))).count() == 0


# --- runtime


def test_broadcast_needs_a_proven_size(spark):
    df = spark.range(100)
    assert fits_broadcast(df, 100) and not fits_broadcast(df, 99) and not fits_broadcast(df, 100, 50)
    assert "broadcast" not in bounded(df, 10)._jdf.queryExecution().analyzed().toString()


def test_pick(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, A int, b int") if False else spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("A"), F.lit(3).alias("b"))
    assert tuple(pick(df, "A", "B").first()) == (2, 3)
    with pytest.raises(KeyError):
        pick(df, "c")
