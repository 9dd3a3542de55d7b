"""Models on the training table with pyspark.ml.

Fits and transforms are distributed Spark jobs.  The driver only loops over
a bounded list (10 hyper-parameter draws, the three largest segments or
clusters) and receives metric rows.

Boosted trees exist twice.  ``boosting`` grows them as the reference's trainer does: L2, a learnt side for
missing values, columns drawn per tree, categories of any cardinality.  MLlib's GBTClassifier, used by
the ``gbt_*`` queries, has none of these (medians are imputed, missing indicators added, columns drawn
per node).
"""

from __future__ import annotations

import random
import uuid
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kredo.operators import features as feat, tuning
from kredo.operators import label as lab
from kredo.operators import boosting, metrics
from kredo.session import shared_path

LABEL = "is_high_risk"
WEIGHT = "class_weight"
VALID = "is_validation"

NUMERIC = ["year_y2", "year_y1"] + [f"{stem}_{t}" for t in ("y2", "y1") for _, stem in feat.LAGGED] \
    + [f"trend_delta_{s}" for s in feat.DELTAS] + [f"trend_growth_{s}" for s in feat.GROWTHS] \
    + ["interest_rate_y2", "inflation_y2"]
# Model-type prefix of year 2 and sector appear among the reference's model features.
CATEGORICAL = ["company_segment", "nace_division", "model_prefix_y2", "sector"]
EXTRA_LAGS = ["raw_model_type"]
KMEANS_FEATURES = ["roa_y2", "solvency_y2", "liquidity_custom_y2", "debt_to_equity_y2", "ccf_revenue_y2",
                   "trend_delta_ccf_revenue"]


def model_input(training: DataFrame, drop_leak: bool = True, macro: DataFrame | None = None) -> DataFrame:
    """Labelled windows with a target, plus the split, a validation flag and model columns.

    The validation flag (for early stopping) is a hash of the window's key:
    deterministic under retries and repartitioning, unlike ``rand()``.
    Macro indicators of year 2 come from a one-row-per-year table (broadcast).
    Missing optional inputs (no lagged model type, no sector, no macro) give
    NULL features, which the feature stages treat as missing.
    """
    df = lab.labelled(training)
    df = df.withColumn("nace_division", F.substring(F.replace("nace_primary_code", F.lit("."), F.lit("")), 1, 2))
    df = df.withColumn("model_prefix_y2", F.substring_index(F.col("raw_model_type_y2"), "-", 1)
                       if "raw_model_type_y2" in df.columns else F.lit(None).cast("string"))
    if "sector" not in df.columns:
        df = df.withColumn("sector", F.lit(None).cast("string"))
    if macro is not None:
        m = macro.select(F.col("year").alias("_my"), F.col("interest_rate").alias("interest_rate_y2"),
                         F.col("inflation").alias("inflation_y2"))
        df = df.join(F.broadcast(m), df["year_y2"] == F.col("_my"), "left").drop("_my")
    else:
        df = (df.withColumn("interest_rate_y2", F.lit(None).cast("double"))
                .withColumn("inflation_y2", F.lit(None).cast("double")))
    df = df.withColumn(VALID, (F.pmod(F.xxhash64("enterprise_number", "target_year_y3"), F.lit(5)) == 0))
    if drop_leak:
        df = df.drop(*lab.LEAKY)
    return df


def _missing_flags(cols: list[str]) -> list:
    return [F.col(c).isNull().cast("double").alias(f"{c}_missing") for c in cols]


def prepare(df: DataFrame) -> DataFrame:
    """Double-typed numeric features plus missing indicators."""
    df = df.select("*", *_missing_flags(NUMERIC))
    return df.select(*[F.col(c).cast("double").alias(c) if c in NUMERIC else F.col(c) for c in df.columns])


def feature_stages(numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL, scale: bool = False):
    """Index categories (unknown values kept), impute medians, assemble (optionally scale)."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    imputed = [f"{c}_imp" for c in numeric]
    imp = Imputer(inputCols=numeric, outputCols=imputed, strategy="median")
    cols = imputed + [f"{c}_missing" for c in numeric] + [f"{c}_idx" for c in categorical]
    asm = VectorAssembler(inputCols=cols, outputCol="raw_features" if scale else "features", handleInvalid="keep")
    stages = [*idx, imp, asm]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    return stages, cols


@dataclass(frozen=True)
class GbtParams:
    """One point of the search space (reference ranges; L2 has no MLlib counterpart)."""
    max_depth: int = 5
    step_size: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    max_iter: int = 100


def draw_params(n: int = 10, seed: int = 42) -> list[GbtParams]:
    """Seeded random draws: depth 3-8, rate 0.01-0.2, subsample and column sample 0.6-1.0."""
    rng = random.Random(seed)
    return [GbtParams(rng.randint(3, 8), round(rng.uniform(0.01, 0.2), 4), round(rng.uniform(0.6, 1.0), 3),
                      round(rng.uniform(0.6, 1.0), 3)) for _ in range(n)]


def gbt(p: GbtParams, seed: int = 7) -> GBTClassifier:
    return GBTClassifier(
        labelCol=LABEL, featuresCol="features", weightCol=WEIGHT, maxIter=p.max_iter, maxDepth=p.max_depth,
        stepSize=p.step_size, subsamplingRate=p.subsample, featureSubsetStrategy=str(p.colsample),
        validationIndicatorCol=VALID, validationTol=0.01, maxBins=MAX_BINS, seed=seed)


MAX_BINS = 128


def usable_categorical(train: DataFrame, categorical: list[str] = CATEGORICAL, most: int | None = MAX_BINS) -> dict[str, int]:
    """Categorical features with a value, and with fewer values than a tree can bin: their numbers of values.

    Trees bin a category per value and never have more bins than rows, so a small segment or cluster
    leaves out a feature with as many values as rows (one more index stands for unknown values).
    ``most``: leave out features with as many values; None: only rows limit them.
    """
    grown = ~F.col(VALID) if VALID in train.columns else F.lit(True)      # trees grow on the other rows
    row = train.agg(F.count_if(grown).alias("_n"), *[F.count_distinct(c).alias(c) for c in categorical]).first()
    limit = row["_n"] if most is None else min(row["_n"], most)
    return {c: row[c] for c in categorical if 0 < row[c] < limit}


def usable_numeric(train: DataFrame, numeric: list[str] = NUMERIC) -> list[str]:
    """Numeric features with at least one value in these rows (one aggregate, one result row).

    A median cannot be imputed for an all-NULL column (possible inside a small
    segment or cluster); its missing indicator still enters the model.
    """
    counts = train.agg(*[F.count(c).alias(c) for c in numeric]).first()
    return [c for c in numeric if counts[c] > 0]


def usable_stages(train: DataFrame, most: int | None = MAX_BINS) -> tuple[list, list[str], int]:
    """Feature stages over the columns that have values, the feature names, and the bins that a tree needs for them."""
    numeric, categories = usable_numeric(train), usable_categorical(train, most=most)
    stages, names = feature_stages(numeric, list(categories))
    # Missing indicators of dropped columns are kept as features too.
    names = names + [f"{c}_missing" for c in NUMERIC if c not in numeric]
    stages[-1].setInputCols(names)
    return stages, names, max(MAX_BINS, 1 + max(categories.values(), default=0))


def fit(train: DataFrame, classifier, most: int | None = MAX_BINS) -> PipelineModel:
    """Fit features + classifier; the model remembers its feature names (``kredo_features``).

    ``most`` as in ``usable_categorical``; trees get as many bins as the features need."""
    stages, names, bins = usable_stages(train, most)
    if classifier.hasParam("maxBins"):
        classifier = classifier.copy({classifier.getParam("maxBins"): bins})
    model = Pipeline(stages=[*stages, classifier]).fit(train)
    without_summary(model.stages[-1])
    model.kredo_features = names
    return model


def without_summary(model):
    """The fitted model without its training summary: scoring closures hold the model, and a summary holds the
    frames and plans of the fit, which need not serialize."""
    if getattr(model, "hasSummary", False):
        jvm = model._java_obj
        jvm.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def vectors(train: DataFrame, *others: DataFrame, most: int | None = MAX_BINS) -> tuple[list[DataFrame], list[str]]:
    """The feature vectors (with label, and weight where there is one) of the frames, written once; feature names.
    Imputing and indexing are fitted on the first frame."""
    stages, names, _ = usable_stages(train, most)
    fitted = Pipeline(stages=stages).fit(train)
    keep = lambda df: [c for c in ("features", LABEL, WEIGHT, VALID) if c == "features" or c in df.columns]
    return [fitted.transform(df).select(*keep(df)).checkpoint() for df in (train, *others)], names


def logreg_scored(train: DataFrame, test: DataFrame, most: int | None = MAX_BINS) -> DataFrame:
    """Label and score of the test rows, from the coefficients of a logistic fit as a column expression."""
    (fitted_on, rows), _ = vectors(train, test, most=most)
    m = logreg().fit(fitted_on)
    weights, shift = [float(x) for x in m.coefficients], float(m.intercept)
    margin = F.aggregate(F.zip_with(vector_to_array("features"), F.lit(weights), lambda x, w: x * w), F.lit(shift), lambda s, x: s + x)
    return rows.select(LABEL, (1 / (1 + F.exp(-margin))).alias("score"))


def report(rows: DataFrame, name: str) -> DataFrame:
    """Six metrics of scored rows, tagged with the model name.  Without rows: n = 0 and NULL metrics."""
    found = metrics.classification_report(rows, [], label=LABEL, score="score")
    return found.select(F.lit(name).alias("model"), *found.columns)


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    out = model.transform(df)
    return out.withColumn("score", vector_to_array("probability").getItem(1))


def evaluate(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """Six metrics of one model on one data set, as a one-row frame tagged with the model name.

    Without evaluation rows the row has n = 0 and NULL metrics.
    """
    return report(scored(model, df), name)


def splits(training: DataFrame, macro: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Out-of-time split (train: target year <= 2023) with class weights from the training rows.

    The prepared rows are checkpointed (shared checkpoint folder) once, so
    every fit reads the same rows and not the whole upstream lineage.
    """
    df = prepare(model_input(training, macro=macro)).checkpoint()
    train = lab.with_weights(df.where(F.col("split") == "train"), LABEL)
    return train, df.where(F.col("split") == "eval")


def search(train: DataFrame, draws: list[GbtParams], parallelism: int = 4) -> tuple[GbtParams, DataFrame]:
    """Fit one model per draw; pick the best ROC AUC on the validation rows.

    Trials run as concurrent Spark jobs (``parallelism`` at a time), as
    TrainValidationSplit does, so small fits share the cluster instead of
    queueing.  Returns the best draw and a (trial, params, roc_auc) frame.
    """
    from concurrent.futures import ThreadPoolExecutor

    # the feature stages do not depend on the draw: fitted once, and the vectors are written once
    (rows,), _ = vectors(train)
    val_rows = rows.where(F.col(VALID))

    def trial(i_p):
        i, p = i_p
        m = gbt(p).fit(rows)            # early stopping uses the validation flag inside
        s = m.transform(val_rows).select(LABEL, vector_to_array("probability").getItem(1).alias("score"))
        auc = metrics.roc_auc(s.withColumn("_g", F.lit(1)), ["_g"], LABEL, "score").first()
        return (i, p.max_depth, p.step_size, p.subsample, p.colsample, None if auc is None else auc["roc_auc"])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = sorted(pool.map(trial, enumerate(draws)))
    spark = train.sparkSession
    table = spark.createDataFrame(results, "trial int, max_depth int, step_size double, subsample double, "
                                           "colsample double, roc_auc double")
    best = max(range(len(draws)), key=lambda i: (-1.0 if results[i][5] is None else results[i][5], -i))
    return draws[best], table


#: FIXED VALUES: the reference's ranges.
SPACE = {"max_depth": tuning.Range(3, 8, digits=0), "step_size": tuning.Range(0.01, 0.2, log=True),
         "subsample": tuning.Range(0.6, 1.0, digits=3), "colsample": tuning.Range(0.6, 1.0, digits=3)}


def search_tpe(train: DataFrame, trials: int = 10, seed: int = 42, parallelism: int = 4, max_iter: int = 100) -> tuple[int, DataFrame]:
    """Model-based search by validation ROC AUC: (number of the best trial, one row a trial).

    A trial that is ended early has the AUC of its first quarter of trees, and that number of trees in ``max_iter``.
    """
    (rows,), _ = vectors(train)
    val_rows = rows.where(F.col(VALID))

    def auc(values: dict, share: float) -> float | None:
        m = gbt(GbtParams(**values, max_iter=max(1, round(max_iter * share)))).fit(rows)
        s = m.transform(val_rows).select(LABEL, vector_to_array("probability").getItem(1).alias("score"))
        found = metrics.roc_auc(s.withColumn("_g", F.lit(1)), ["_g"], LABEL, "score").first()
        return None if found is None else found["roc_auc"]

    done = tuning.search(auc, SPACE, trials, seed, start=min(6, (trials + 1) // 2), width=parallelism)
    table = train.sparkSession.createDataFrame(
        [(t.number, *(t.values[p] for p in SPACE), max(1, round(max_iter * t.share)), t.score) for t in done],
        "trial int, max_depth int, step_size double, subsample double, colsample double, max_iter int, roc_auc double")
    return tuning.best(done).number, table


def importance(model: PipelineModel, names: list[str]) -> DataFrame:
    """Split count ("weight") and mean gain per feature, read from the saved model's node data.

    The saved tree ensemble is a parquet table of nodes; grouping it by the
    split feature is an ordinary distributed aggregate.
    """
    from pyspark.sql import SparkSession
    sess = SparkSession.getActiveSession()
    path = shared_path(sess, "kredo-models", uuid.uuid4().hex)
    model.stages[-1].write().save(path)
    nodes = sess.read.parquet(f"{path}/data")
    used = nodes.where(F.col("nodeData.split.featureIndex") >= 0).select(
        F.col("nodeData.split.featureIndex").alias("feature_index"), F.col("nodeData.gain").alias("gain"))
    g = used.groupBy("feature_index").agg(F.count(F.lit(1)).alias("weight"), F.avg("gain").alias("gain"))
    # The feature list is the assembler's input list: bounded by the schema, broadcast.
    lookup = sess.createDataFrame(list(enumerate(names)), "feature_index int, feature string")
    return g.join(F.broadcast(lookup), "feature_index").select("feature", "weight", "gain")


def top_groups(df: DataFrame, keys: list[str], k: int | None = 3) -> list[tuple]:
    """The k largest groups (bounded list of keys for a per-group model loop); None: all groups, the largest first."""
    rows = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), *[F.col(c).asc_nulls_first() for c in keys]))
    rows = (rows if k is None else rows.limit(k)).collect()
    return [tuple(r[c] for c in keys) for r in rows]


def per_group_metrics(train: DataFrame, test: DataFrame, keys: list[str], groups: list[tuple],
                      p: GbtParams, prefix: str) -> DataFrame:
    """One boosted-tree model per group (stratified modelling), evaluated on the group's later rows."""
    out = None
    for g in groups:
        cond = F.lit(True)
        for c, v in zip(keys, g):
            cond = cond & (F.col(c).eqNullSafe(F.lit(v)))
        name = prefix + "/".join("null" if v is None else str(v) for v in g)
        tr, te = lab.with_weights(train.where(cond).drop(WEIGHT), LABEL), test.where(cond)
        m = fit(tr, gbt(p))
        r = evaluate(m, te, name)
        out = r if out is None else out.unionByName(r)
    return out


def every_group_metrics(train: DataFrame, test: DataFrame, keys: list[str], p: GbtParams, prefix: str,
                        parallelism: int = 8) -> DataFrame:
    """``per_group_metrics`` for all groups of the training rows (sectors x sizes or clusters: a bounded list).

    The rows are written once in a folder a group, so a fit reads its own group alone; several fits run at a time.
    A group without validation rows, or with nothing else, grows all its trees on all its rows.
    """
    from concurrent.futures import ThreadPoolExecutor
    groups, spark = top_groups(train, keys, None), train.sparkSession
    same = lambda g: [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(keys, g)]         # noqa: E731
    number = F.lit(None).cast("int")
    for n, g in enumerate(groups):
        found = F.lit(True)
        for c in same(g):
            found = found & c
        number = F.when(found, F.lit(n)).otherwise(number)
    root = shared_path(spark, "kredo-groups", uuid.uuid4().hex)

    def laid(rows: DataFrame, name: str) -> DataFrame:
        # whole partitions of a group, a large group in several
        numbered = rows.drop(WEIGHT).withColumn("_group", number).where(F.col("_group").isNotNull())
        numbered.hint("rebalance", "_group").write.partitionBy("_group").parquet(f"{root}/{name}")
        return spark.read.schema(numbered.schema).parquet(f"{root}/{name}")

    train, test = laid(train, "train"), laid(test, "test")

    def one(n_g):
        n, g = n_g
        own, te = (df.where(F.col("_group") == n).drop("_group") for df in (train, test))
        tr, grower = lab.with_weights(own, LABEL), gbt(p)
        if len(own.select(VALID).distinct().head(2)) < 2:
            tr = tr.drop(VALID)
            grower.clear(grower.validationIndicatorCol)
        name = prefix + "/".join("null" if v is None else str(v) for v in g)
        return evaluate(fit(tr, grower, most=None), te, name)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = [(f.schema, f.first()) for f in pool.map(one, enumerate(groups))]
    return spark.createDataFrame([row for _, row in parts], parts[0][0])


def kmeans_fit(train: DataFrame, k: int = 32, seed: int = 1, q: float = 0.99) -> tuple[PipelineModel, dict]:
    """k-means on winsorised, imputed, standardised key ratios of the training rows: the model and the caps."""
    from kredo.operators.segments import capped, exact_percentiles
    caps = {c: v for c, (_, v) in exact_percentiles(train, KMEANS_FEATURES, q).items()}
    imputed = [f"{c}_imp" for c in KMEANS_FEATURES]
    pipe = Pipeline(stages=[
        Imputer(inputCols=KMEANS_FEATURES, outputCols=imputed, strategy="median"),
        VectorAssembler(inputCols=imputed, outputCol="km_raw"),
        StandardScaler(inputCol="km_raw", outputCol="km_features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="km_features", predictionCol="cluster"),
    ])
    model = pipe.fit(capped(train, caps))
    without_summary(model.stages[-1])
    return model, caps


def kmeans_clusters(train: DataFrame, test: DataFrame | None = None, k: int = 32, seed: int = 1,
                    q: float = 0.99, keep_features: bool = False) -> DataFrame:
    """Adds ``cluster`` to the rows of both splits; everything is fitted on the training rows only."""
    from kredo.operators.segments import capped
    model, caps = kmeans_fit(train, k, seed, q)
    rows = train if test is None else train.unionByName(test, allowMissingColumns=True)
    out = model.transform(capped(rows, caps)).drop("km_raw", *[f"{c}_imp" for c in KMEANS_FEATURES])
    return out.withColumn("km_centres", F.lit([[float(x) for x in c] for c in model.stages[-1].clusterCenters()])) \
        if keep_features else out.drop("km_features")


def not_nearest(slack: float = 1e-9):
    """Whether a row's centre is further than another (from ``kmeans_clusters(keep_features=True)``)."""
    x = vector_to_array("km_features")
    distance = lambda c: F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)
    each = F.transform("km_centres", distance)
    return F.element_at(each, F.col("cluster") + 1) > F.array_min(each) + slack


def boost_rows(train: DataFrame, test: DataFrame, group: Column | None = None, p: boosting.Params = boosting.Params()):
    """(binned rows, feature names) of both splits: validation rows stop growth, test rows are only scored."""
    role = F.when(F.col(VALID), "valid").otherwise("train")
    rows = train.withColumn("role", role).unionByName(test.withColumns({WEIGHT: F.lit(1.0), "role": F.lit("eval")}),
                                                      allowMissingColumns=True)
    rows = rows.withColumn("grp", group if group is not None else F.lit("all"))
    return boosting.binned(rows, NUMERIC, CATEGORICAL, LABEL, WEIGHT, "role", ["enterprise_number", "target_year_y3"], "grp", p)


def boost_metrics(state: DataFrame) -> DataFrame:
    """Six metrics of the evaluation rows of each group's trees."""
    rows = boosting.scored(state.where("role = 'eval'"))
    return metrics.classification_report(rows, ["grp"], label="y", score="score").withColumnRenamed("grp", "model")


def logreg() -> LogisticRegression:
    return LogisticRegression(labelCol=LABEL, featuresCol="features", weightCol=WEIGHT, maxIter=100, regParam=0.01)


def forest(seed: int = 7) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=LABEL, featuresCol="features", weightCol=WEIGHT, numTrees=100,
                                  maxDepth=8, maxBins=MAX_BINS, seed=seed)

