import pytest
from pyspark.sql import functions as F

from panelloom.functions import labels as L
from panelloom.functions import text as T


def column(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("12", 12.0), (" 7 ", 7.0), ("\t8.5", 8.5), ("+3", 3.0), ("-3", -3.0), ("3-", -3.0), ("(1,234.5)", -1234.5), ("1,234,567", 1234567.0), ("12,34", None), ("1,2345", None),
        (".5", 0.5), ("5.", 5.0), (".", None), ("007", 7.0), ("1e3", 1000.0), ("-1.5E-2", -0.015), ("e5", None), ("$5", 5.0), ("USD 6,696", 6696.0), ("$-5", -5.0), ("-$5", -5.0),
        ("45.6%", 45.6), ("(5%)", -5.0), ("--", None), ("+-5", None), ("-5-", None), ("(-5)", None), ("1.2.3", None), ("1e400", None), ("nan", None), ("Infinity", None), ("0x1F", None),
        ("12d", None), ("1_000", None), ("1O7", None), ("", None), (None, None), ("4 5", None), ("40-636", None), (" 9 ", 9.0), ("$", None), ("%", None),
    ],
)
def test_read_number(spark, text, number):
    assert column(spark, T.read_number, [text]) == [number]


def test_very_long_number_and_text(spark):
    assert column(spark, T.read_number, ["1" * 400, "9" * 300, "x" * 200_000]) == [None, float("9" * 300), None]


def test_varnumber(spark):
    assert column(spark, T.varnumber, ["10010", " 0001 0010 ", "123456789", "V12", "NaN", "<NA>", "", None, "."]) == ["00010010", "00010010", "123456789", "V12", None, None, None, None, "."]


def test_source_file(spark):
    raw = ["ENRL_A", " enrl-a ", "ENRL2019_A", "insthd2010.csv", "ic_ay", "GR200_19", "2019", "", None, "a/b/FIN_P2011.tar", "EF_A", "__", ".hidden", "HD"]
    assert column(spark, T.source_file, raw) == ["ENRL_A", "ENRL_A", "ENRL_A", "INSTHD", "IC_AY", "GR200", "2019", "", "", "FIN_P", "EFA", "", "HIDDEN", "HD"]


def test_tokens_and_paths(spark):
    assert column(spark, T.null_if_token, [" x ", "NaN", " . ", "NaT", None, " "]) == ["x", None, None, None, None, None]
    assert column(spark, T.path_key, ["./a//b", " a\\b ", "././a", "/a", None]) == ["a/b", "a/b", "a", "/a", ""]
    assert column(spark, T.token, ["a b--c", "__x__", None]) == ["A_B_C", "X", ""]


def test_declared_numeric(spark):
    assert column(spark, T.declared_numeric, [" Cont ", "char", "", None, "NUM", "nan"]) == [True, False, None, None, True, None]


def test_labels(spark):
    assert column(spark, L.academic_start, ["2019-20", " 2019/2020 ", "x", None]) == [2019, 2019, None, None]
    assert column(spark, lambda c: L.academic_label(c), ["2019", "1999"]) == ["2019-20", "1999-00"]
    assert column(spark, L.is_active, ["1", "0", "yes", "No", "x", None, "0.0"]) == [True, False, True, False, True, False, False]
    assert column(spark, L.source_category, ["hd", "EF", "CUSTOMX", "zz", ""]) == ["canonical", "auxiliary_expected", "derived_or_custom", "needs_review", "needs_review"]
    assert column(spark, L.clean_label, ["File documentation for the Staff 2019-20 ,", None]) == ["Staff", ""]
    assert column(spark, lambda c: L.completeness(c.cast("double")), ["95", "75", "40", "1", None]) == ["full", "strong", "partial", "sparse", "unknown"]


def test_recency_orders_by_time_then_row(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2020-01-01 00:00:00', 5L), (TIMESTAMP_NTZ '2020-01-01 00:00:00', 6L), (TIMESTAMP_NTZ '2020-01-01 00:00:00.000001', 1L), (NULL, 9L) AS t(at, row_id)")
    got = df.select("row_id", T.recency(F.col("at"), F.col("row_id")).alias("r")).orderBy(F.desc_nulls_last("r")).collect()
    assert [r.row_id for r in got] == [1, 6, 5, 9]
