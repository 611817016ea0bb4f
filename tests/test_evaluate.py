"""Result diff, scoring, run summary, feedback and alerts."""

import datetime as dt

from conftest import rows

from quartermaster.operators import evaluate as E


def test_score_levels(spark):
    t = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    same = spark.createDataFrame([("b", 2.0), ("a", 1.0)], "k string, v double")
    vals = spark.createDataFrame([("a", 1.0), ("b", 2.5)], "k string, v double")
    grain = spark.createDataFrame([("a", 1.0)], "k string, v double")
    cols = spark.createDataFrame([("a", 1.0)], "k string, w double")
    got = [E.score("q", "c", t, c, ["k"]).first().score for c in (same, vals, grain, cols)]
    assert got == ["Correct", "Partial", "Incorrect", "Incorrect"]


def test_diff_results_multiset(spark):
    t = spark.createDataFrame([("a", 1.0), ("a", 1.0)], "k string, v double")
    c = spark.createDataFrame([("a", 1.0), ("z", 9.0)], "k string, v double")
    assert rows(E.diff_results(t, c), "side", "k") == [("extra", "z"), ("missing", "a")]


def test_run_summary_and_compare(spark):
    r1 = spark.createDataFrame([(1, "q1", "A", "Correct"), (1, "q2", "A", "Partial"),
                                (1, "q3", "B", "Incorrect")], "run_id int, question string, category string, score string")
    r2 = spark.createDataFrame([(2, "q1", "A", "Correct"), (2, "q2", "A", "Correct"),
                                (2, "q3", "B", "Correct")], "run_id int, question string, category string, score string")
    s = {(r.run_id, r.category): (r.accuracy_pct, r.meets_target)
         for r in E.run_summary(r1.unionByName(r2)).collect()}
    assert s[(1, "ALL")] == (33.3, False) and s[(2, "ALL")] == (100.0, True)
    ch = {r.question: r.change for r in E.compare_runs(r1, r2).collect()}
    assert ch == {"q1": "same", "q2": "fixed", "q3": "fixed"}


def test_feedback_summary(spark):
    fb = spark.createDataFrame(
        [(dt.date(2025, 3, 5), "down", "wrong values", False), (dt.date(2025, 3, 6), "down", "wrong values", True),
         (dt.date(2025, 3, 6), "up", "none", False)],
        "asked_at date, verdict string, pattern string, reviewed boolean")
    got = rows(E.feedback_summary(fb), "pattern", "thumbs_down", "unreviewed_down")
    assert got == [("none", 0, 0), ("wrong values", 2, 1)]
    assert E.review_queue(fb).count() == 1


def test_alerts(spark):
    v = spark.createDataFrame([("low_stock_count", 12.0), ("low_stock_count", 10.0)], "measure string, value double")
    r = spark.createDataFrame([("low_stock_count", ">", 10.0)], "measure string, op string, threshold double")
    assert sorted(x.fired for x in E.alerts(v, r).collect()) == [False, True]
