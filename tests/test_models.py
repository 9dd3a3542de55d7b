import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries


def test_gbt_metrics_are_valid(spark, sf_dir):
    r = queries()["gbt_metrics"](spark, sf_dir).first()
    for k in ("precision", "recall", "accuracy", "f1", "roc_auc"):
        assert r[k] is None or 0.0 <= r[k] <= 1.0
    assert r["log_loss"] >= 0.0
    if r["precision"] and r["recall"]:
        assert r["f1"] == pytest.approx(2 * r["precision"] * r["recall"] / (r["precision"] + r["recall"]))


def test_importance_is_ranked_by_gain(spark, sf_dir):
    imp = queries()["gbt_importance"](spark, sf_dir).collect()
    gains = [r["gain"] for r in imp]
    assert gains == sorted(gains, reverse=True) and all(r["weight"] >= 1 for r in imp)


def test_search_draws_are_seeded():
    from kredo.operators.models import draw_params
    a, b = draw_params(10, 42), draw_params(10, 42)
    assert a == b and len(a) == 10
    assert all(3 <= p.max_depth <= 8 and 0.01 <= p.step_size <= 0.2 and 0.6 <= p.subsample <= 1.0 for p in a)


def test_kmeans_cluster_sizes(spark, sf_dir):
    c = queries()["kmeans_segments"](spark, sf_dir)
    assert c.agg(F.sum("n")).first()[0] > 0
