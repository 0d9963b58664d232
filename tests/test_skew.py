"""With a third of the rows on one key the queries still give the rows of their SQL."""

import pathlib
from collections import Counter

import duckdb
import pytest

from panelloom.plans import data_queries
from tests.conftest import plain

HOT = {
    "panel_long": "row_id % 3 = 0|UNITID=200001|year=2015|varname='GRRATE'|varnumber='00090040'|source_file='GRADS'",
    "release_baseline": "UNITID % 3 = 0|UNITID=200001|year=2015|relative_path='p'",
    "release_current": "UNITID % 3 = 0|UNITID=200001|year=2015|relative_path='p'",
    "cast_report": "report_id % 3 = 0|run_id=1|\"column\"='GRRATE'",
}


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("skew")
    con = duckdb.connect()
    for p in pathlib.Path(folder).glob("*.parquet"):
        if p.stem not in HOT:
            (out / p.name).symlink_to(p)
            continue
        test, *changes = HOT[p.stem].split("|")
        parts = [c.split("=") for c in changes]
        replaced = ", ".join(f"CASE WHEN {test} THEN {v} ELSE {c} END AS {c}" for c, v in parts)
        con.execute(f"COPY (SELECT * REPLACE ({replaced}) FROM '{p}') TO '{out / p.name}' (FORMAT PARQUET)")
    for p in out.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return str(out), con


@pytest.mark.parametrize("name", ["p1_found", "p1_long", "p2_found", "p4_found", "p5_found", "p6_found"])
def test_hot_key(spark, skewed, name):
    where, con = skewed
    df = data_queries.QUERIES[name](spark, where)
    names = sorted(df.columns)
    rel = con.execute(data_queries.ORACLES[name])
    at = [[c[0] for c in rel.description].index(c) for c in names]
    assert Counter(tuple(plain(r[c]) for c in names) for r in df.collect()) == Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
