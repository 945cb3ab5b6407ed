import datetime as dt

import pytest
from pyspark.sql import functions as F

from carrel.functions import dates, scalars


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (scalars.site, "C50.4", "C504"), (scalars.site3, " c50.4", "C50"), (scalars.site3, "504", "504"), (scalars.histology4, "85003", "8500"), (scalars.behavior_digit, "85003", "3"),
        (scalars.stage_group_main, "Stage IVA", "4"), (scalars.stage_group_main, "IS", "1"), (scalars.stage_group_main, "99", "unknown"), (scalars.stage_group_main, None, "unknown"),
        (scalars.summary_stage_extent, "7", "distant"), (scalars.stage_group_extent, "IIB", "regional"), (scalars.biomarker, "1: ER positive", "positive"), (scalars.biomarker, "0", "negative"), (scalars.biomarker, "", "unknown"),
        (scalars.topography, "c509", "C50.9"), (scalars.topography, "C5", ""), (scalars.morphology, "8500/3", "8500"), (scalars.laterality, "LEFT", "left"), (scalars.laterality, "x", "unknown"),
        (scalars.rule_site, "61.9", "C619"), (scalars.rule_histology, "0000", None), (scalars.rule_histology, "8140/3", 8140), (scalars.integer, "x", None), (scalars.integer, " 7 ", 7),
        (scalars.summary_text, "Summary: Patient has colon cancer.", "Patient has colon cancer."), (scalars.summary_text, "```\nClinical content.\n```", "Clinical content."), (scalars.unfenced, "x ```json\n{}\n``` y", "x ```json\n{}\n``` y"), (scalars.unfenced, " ```json\n{}\n``` ", "{}"), (scalars.unfenced, "```\n{}", "```\n{}"), (scalars.summary_text, "```text\nOpen", "Open"), (scalars.summary_text, "Clinical summary:\nx", "x"), (scalars.summary_text, "```\nx\n ``` ", "x"),
        (scalars.stage_display, "cT1", "T1"), (scalars.stage_display, "pIIA", "IIA"),
        (scalars.model_size, "Model-7B", "small"), (scalars.model_size, "x-32b", "medium"), (scalars.model_size, "big", "medium"), (scalars.model_size, "m-120B", "large"), (scalars.model_size, "gpt-oss", "medium"), (scalars.one_line, " * a \n b* ", "a b"), (scalars.manual_text, "a  b\n\n\n\nc", "a b\n\nc"),
        (scalars.site_code, "site C50.9 left", "C50.9"), (scalars.estimated_tokens, "abc", 1),
    ],
)
def test_scalars(spark, f, value, want):
    assert one(spark, value, f) == want


@pytest.mark.parametrize(("hint", "side", "want"), [("outer quadrant of left breast", "left", "left outer quadrant of left breast"), ("Left breast", "LEFT", "Left breast"), ("", "left", "left unknown"), (None, "unknown", "unknown"), ("colon", "not_applicable", "colon")])
def test_sided_site(spark, hint, side, want):
    row = spark.createDataFrame([(hint, side)], "h string, s string").select(scalars.sided_site(F.col("h"), F.col("s")).alias("y")).first()
    assert row["y"] == want


@pytest.mark.parametrize(("value", "axis", "want"), [("CT1MI", "T", "1MI"), ("C2", "T", "2"), ("CX", "T", "X"), ("pN1a", "N", "1A"), ("", "T", "")])
def test_tnm(spark, value, axis, want):
    assert one(spark, value, lambda x: scalars.tnm(x, axis)) == want


D = dt.date


@pytest.mark.parametrize(
    ("value", "lo", "hi"),
    [
        ("2024", D(2024, 1, 1), D(2024, 12, 31)), ("2024-02", D(2024, 2, 1), D(2024, 2, 29)), ("202402", D(2024, 2, 1), D(2024, 2, 29)), ("20240215", D(2024, 2, 15), D(2024, 2, 15)), ("2024/2/5", D(2024, 2, 5), D(2024, 2, 5)),
        ("2024115", D(2024, 11, 5), D(2024, 11, 5)), ("202313", None, None), ("20230199", None, None), ("unknown", None, None), ("", None, None), (None, None, None), ("03/04/2021", D(2021, 3, 4), D(2021, 3, 4)), ("5-JAN-2020", None, None), ("05-Jan-2020", D(2020, 1, 5), D(2020, 1, 5)),
    ],
)
def test_intervals(spark, value, lo, hi):
    got = one(spark, value, dates.interval)
    assert (got and (got["lo"], got["hi"])) == ((lo, hi) if lo else None)


def test_window_clamps_at_month_ends(spark):
    got = one(spark, "2024-08-31", dates.window)
    assert (got["lo"], got["hi"]) == (D(2024, 2, 29), D(2025, 2, 28))


@pytest.mark.parametrize(("value", "want"), [("20240115", D(2024, 1, 15)), ("20230199", D(2023, 1, 1)), ("2023", D(2023, 1, 1)), ("x", None), ("20231301", D(2023, 1, 1))])
def test_predicted_dates(spark, value, want):
    assert one(spark, value, dates.predicted_date) == want


def test_coded_difference(spark):
    row = spark.createDataFrame([("2023", "20230101", "99999999")], "a string, b string, c string")
    got = row.select(dates.coded_difference(F.col("a"), F.col("b")).alias("x"), dates.coded_difference(F.col("a"), F.col("c")).alias("y")).first()
    assert (got["x"], got["y"]) == (20230000 - 20230101, None)
