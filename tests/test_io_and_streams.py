import hashlib

import pytest
from pyspark.sql import functions as F

from panelloom.operators import orphans, quality_profile
from panelloom.operators.longform import GateError, check_stitched
from panelloom.sources import readers, writers
from panelloom.streaming import incremental
from tests.test_data_operators import rows_of


def test_csv_reading(spark, tmp_path):
    good = tmp_path / "a.csv"
    good.write_text('UNITID,NAME,V\n1,"a ""b"", c",NA\n2,x,N/A\n3,NULL,5\n')
    df = readers.read_csv(spark, str(good))
    assert rows_of(df, "UNITID", "NAME", "V") == [("1", 'a "b", c', None), ("2", "x", None), ("3", None, "5")]
    assert readers.header_and_rows(spark, str(good)) == (["UNITID", "NAME", "V"], 3)
    latin = tmp_path / "b.csv"
    latin.write_bytes("UNITID,N\n1,Université\n".encode("latin-1"))
    assert readers.read_csv(spark, str(latin)).first().N == "Université"
    bad = tmp_path / "c.csv"
    bad.write_text("UNITID,N\nx,1\ny,2\n")
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(bad))
    inv = readers.inventory(spark, 2010, {"A": str(good)}).first()
    assert (inv.table_role, inv.has_unitid, inv.row_count_csv) == ("data", True, 3)


def test_roles_and_releases():
    assert readers.table_role("vartable20", ["varnumber", "varname", "varTitle"]) == "metadata_varlist"
    assert readers.table_role("valuesets20", ["varnumber", "codevalue", "valuelabel"]) == "metadata_codes"
    assert readers.table_role("Imputation20", ["codevalue", "valuelabel"]) == "metadata_imputation"
    assert readers.table_role("desc", ["varnumber", "longDescription"]) == "metadata_description"
    assert readers.table_role("layout20", ["z"]) == "metadata_varlist" and readers.table_role("q", ["z"]) == "unknown"
    row = "<tr><td>{y}</td><td>Final</td><td>May</td><td><a href='d{y}'>D</a> <a href='e{y}'>E</a></td></tr>"
    html = "<table><tr><th>x</th></tr>" + row.format(y="2012-13") + row.format(y="2010-11") + "<tr><td>2009-10</td><td>a</td></tr></table>"
    got = readers.release_table(html)
    assert [r["year"] for r in got] == [2010, 2012] and got[0]["data_url"] == "d2010-11" and got[0]["release_type"] == "Final"


def test_files_parquet_and_publish(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.bin").write_bytes(b"abc")
    f = readers.files(spark, str(tmp_path / "in")).first()
    assert (f.size_bytes, f.sha256) == (3, hashlib.sha256(b"abc").hexdigest())
    df = spark.createDataFrame([(2010, 1, "1", "S"), (2011, 1, "1", "S")], "year int, UNITID long, varnumber string, source_file string")
    out = str(tmp_path / "p")
    writers.publish(df, out, lambda d: check_stitched(d, [2010, 2011]), by_year=True)
    back = readers.read_panel(spark, out, years=[2011])
    assert back.columns[:2] == ["year", "UNITID"] and back.count() == 1
    flat = str(tmp_path / "flat")
    writers.write_parquet(df, flat)
    plan = readers.read_panel(spark, flat, ["UNITID"], [2011])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(year,2011)" in plan or "In(year, [2011])" in plan
    assert "source_file" not in plan.split("ReadSchema")[1]
    with pytest.raises(GateError):
        writers.publish(df, str(tmp_path / "q"), lambda d: check_stitched(d, [2010]))
    assert not (tmp_path / "q").exists()
    writers.write_csv(df, str(tmp_path / "c"), gzip=True, single=True)
    assert any(p.name.endswith(".csv.gz") for p in (tmp_path / "c").iterdir())
    run = writers.record_run(spark, str(tmp_path / "runs"), "wide", {"lane_split": True, "b": 1}, "2010:2011", 2)
    got = spark.read.parquet(str(tmp_path / "runs")).first()
    assert got.run_id == run and got.lane_split and got.config_json == '{"b": 1, "lane_split": true}'
    assert '"UNITID"' in writers.data_package("d", {"t": df})
    assert readers.empty(spark, "a int").count() == 0


def test_streams_keep_state_once(spark, tmp_path):
    src, state, ck = (str(tmp_path / n) for n in ("src", "state", "ck"))
    schema = "load string, a string"
    for k, rows in enumerate([[("1", "x"), ("1", None)], [("2", "x")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = incremental.stream_files(spark, src, spark.createDataFrame([], schema).schema)
        incremental.maintain_profile(stream, F.col("load"), ["a"], state, ck).awaitTermination()
        store = incremental.Versions(spark, state, "load string, column string, value string, n long")
        want = quality_profile.value_counts(spark.read.parquet(src), F.col("load"), ["a"])
        assert rows_of(store.latest(), "load", "value", "n") == rows_of(want, "load", "value", "n") and store.has(k)


def test_stream_of_references(spark, tmp_path):
    """References wait, parents resolve them, deletions reopen them; a deletion before its arrival cancels out."""
    src, state, ck = (str(tmp_path / n) for n in ("src", "state", "ck"))
    steps = [
        ([("reference", "p", "S", "1", 2010, 2), ("reference", "p", "S", "2", 2010, 1)], [("p", 2010, 3)]),
        ([("parent", None, "S", "1", 2010, 1)], [("p", 2010, 1)]),
        ([("parent", None, "S", "2", 2010, -1)], [("p", 2010, 1)]),
        ([("parent", None, "S", "2", 2010, 1), ("parent", None, "S", "1", 2010, -1)], [("p", 2010, 3)]),
        ([("parent", None, "S", "2", 2010, 1), ("reference", "p", "S", "1", 2010, -1)], [("p", 2010, 1)]),
    ]
    for rows, want in steps:
        spark.createDataFrame(rows, incremental.EVENTS).coalesce(1).write.mode("append").parquet(src)
        incremental.maintain_orphans(incremental.stream_files(spark, src, spark.createDataFrame([], incremental.EVENTS).schema), state, ck).awaitTermination()
        assert rows_of(incremental.open_references(spark, state), "table_name", "year", "n_references") == want


def test_latin1_after_many_plain_lines(spark, tmp_path):
    path = tmp_path / "late.csv"
    path.write_bytes(b"UNITID,NAME\n" + b"1,plain\n" * 500 + "2,Universit\u00e9\n".encode("latin-1"))
    assert readers.read_csv(spark, str(path)).where("UNITID = '2'").first().NAME == "Universit\u00e9"


def test_bad_lines_are_listed(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("UNITID,N\n1,a\n2,b,c\n3,d\n")
    assert [r.UNITID for r in readers.read_csv(spark, str(path)).collect()] == ["1", "3"] and readers.read_csv(spark, str(path)).count() == 2
    assert [r.line for r in readers.bad_lines(spark, str(path)).collect()] == ["2,b,c"]
    assert dict(readers.read_typed_csv(spark, str(path)).dtypes)["UNITID"] == "int"


def test_published_table_is_replaced_whole(spark, tmp_path):
    out = str(tmp_path / "t")
    for n in (3, 5):
        writers.publish(spark.range(n).selectExpr("id AS UNITID", "2010 AS year"), out, lambda d: None)
        assert spark.read.parquet(out).count() == n
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
