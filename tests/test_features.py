from pyspark.sql import functions as F

from helpers import empty_dims, filing, filings_df, healthy
from kredo.operators import features, label, staging


def _years(spark, ent, years, holding_year=None):
    rows = []
    for y in years:
        r = healthy(total=100000.0 + y)
        if y == holding_year:
            r = [("20/58", "N", "600000"), ("70", "N", "5000"), ("9087", "N", "0")]
        rows.append(filing(f"{ent}-{y}", ent, f"{y}-12-31", rubrics=r))
    return rows


def _training(spark, rows):
    e, a, act = empty_dims(spark)
    return features.training_dataset(staging.staging_master(filings_df(spark, rows), e, a, act))


def test_three_consecutive_years_only(spark):
    rows = _years(spark, "1", [2020, 2021, 2022, 2023]) + _years(spark, "2", [2020, 2021, 2023, 2024]) \
        + _years(spark, "3", [2020, 2021, 2022, 2023], holding_year=2021)
    t = _training(spark, rows)
    got = sorted((r["enterprise_number"], r["target_year_y3"]) for r in t.collect())
    # enterprise 2 has a gap; enterprise 3 has a Holding year that breaks the chain (filter before lag).
    assert got == [("1", 2022), ("1", 2023)]
    r = t.where(F.col("target_year_y3") == 2023).first()
    assert r["year_y2"] == 2022 and r["year_y1"] == 2021
    assert r["trend_growth_assets"] == (100000.0 + 2022 - 100000.0 - 2021) / (100000.0 + 2021)
    assert len(t.columns) == 62


def test_label_rules_are_strict(spark):
    rows = [
        (0.0, None, None, 0),      # solvency exactly 0: not negative
        (-0.1, None, None, 1),     # negative equity
        (0.05, -1.0, None, 0),     # solvency exactly 0.05: no alarm
        (0.04, -1.0, None, 1),     # alarm
        (None, -1.0, 1.0, 0),      # liquidity exactly 1: no squeeze
        (None, -1.0, 0.9, 1),      # liquidity squeeze with a loss
        (None, None, 0.5, 0),      # NULL roa defaults to 0: no loss
    ]
    df = spark.createDataFrame([(s, r, q) for s, r, q, _ in rows],
                               "target_solvency_y3 double, target_roa_y3 double, target_liquidity_y3 double")
    got = [r[0] for r in df.select(label.is_high_risk()).collect()]
    assert got == [x[3] for x in rows]


def test_split_is_disjoint_and_labels_not_null(spark, sf_dir):
    from kredo.plans.catalog import Inputs
    lab = label.labelled(Inputs(spark, sf_dir).training())
    assert lab.where(F.col("is_high_risk").isNull()).count() == 0
    assert set(r[0] for r in lab.select("is_high_risk").distinct().collect()) <= {0, 1}
    tr = label.training_set(Inputs(spark, sf_dir).training())
    assert "target_net_profit_y3" not in tr.columns and "enterprise_number" not in tr.columns
    n_train = lab.where("split = 'train'").count()
    assert n_train == tr.count() and n_train + lab.where("split = 'eval'").count() == lab.count()
    assert lab.where("split = 'train' AND target_year_y3 > 2023").count() == 0


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "is_high_risk long")
    w = {r["is_high_risk"]: r["class_weight"] for r in label.class_weights(df).collect()}
    assert w[0] * 6 == 4.0 and w[1] * 2 == 4.0          # n / (k * n_c): both classes weigh 4 in total
