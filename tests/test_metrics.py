import pytest

from kotomori.operators import metrics as M


def confusion(spark, pairs):
    return M.confusion_counts(spark.createDataFrame(pairs, "y_true int, y_pred int"))


def test_confusion_is_dense(spark):
    cells = {(r.y_true, r.y_pred): r.n for r in confusion(spark, [(0, 0), (0, 1), (0, 1)]).collect()}
    assert len(cells) == 9 and cells[0, 1] == 2 and cells[2, 2] == 0


def test_class_never_predicted_and_never_true(spark):
    report = {r.name: r for r in M.class_report(confusion(spark, [(0, 0), (1, 0), (1, 1)])).collect()}
    assert report["quality_risk"].f1 == 0 and report["quality_risk"].support == 0
    assert report["abusive_content"].precision == 0.5 and report["abusive_content"].recall == 1.0
    assert report["accuracy"].f1 == pytest.approx(2 / 3)
    assert report["macro avg"].f1 == pytest.approx((2 / 3 + 2 / 3 + 0) / 3)
    assert report["weighted avg"].recall == pytest.approx((1 * 1 + 2 * 0.5) / 3)
    assert sum(report[n].support for n in M.LABELS) == report["accuracy"].support == 3


def test_shares_add_up(spark):
    rows = M.confusion_normalised(confusion(spark, [(0, 0), (0, 1), (1, 2)])).collect()
    for t in (0, 1):
        assert sum(r.share for r in rows if r.y_true == t) == pytest.approx(1.0)
    assert all(r.share is None for r in rows if r.y_true == 2)


def test_severity_weights(spark):
    c = confusion(spark, [(0, 0), (1, 1), (2, 1)])
    assert M.severity_weighted_accuracy(c).first()[0] == pytest.approx(5 / 6)
    assert M.severity_weighted_accuracy(c, (1.0, 1.0, 1.0)).first()[0] == pytest.approx(2 / 3)
    assert M.evaluation_summary(c).first().severity_weighted_accuracy == pytest.approx(5 / 6)


def test_empty_input_raises_nothing(spark):
    c = M.confusion_counts(spark.range(0).selectExpr("1 y_true", "1 y_pred"))
    assert M.f1_scores(c).first().f1_weighted == 0
    assert M.error_rate(c).first().error_pct is None
    assert M.severity_weighted_accuracy(c).first()[0] is None


def test_errors(spark):
    df = spark.createDataFrame([(i, "x" * 100, i % 3, 0) for i in range(30)], "id int, text string, y_true int, y_pred int")
    errors = M.error_rows(df, "id")
    assert errors.count() == 20
    assert {r.predicted_label for r in errors.collect()} == {"abusive_content"}
    sample = M.error_sample(errors, "id", 5).collect()
    assert sample == M.error_sample(errors.repartition(5), "id", 5).collect()
    assert len(sample) == 5 and all(len(r.text_preview) == 83 for r in sample)
    assert M.error_sample(errors, "id", 100).count() == 20
    rate = M.error_rate(M.confusion_counts(df)).first()
    assert (rate.n_errors, rate.n_total, rate.error_pct) == (20, 30, 66.7)
