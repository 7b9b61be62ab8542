"""Models (ML-*): feature frames, splits and folds, pyspark.ml fits,
clustering sweeps, regression tables, bootstrap and permutation importance.

Fits run on Spark (``pyspark.ml`` estimators are distributed); the driver
only loops over a handful of model configurations and receives model
summaries (coefficients, costs), never data rows.  Splits and folds are
exact per-stratum hash ranks computed with the range-partitioned prefix
sums, not a window partitioned by the label (which would put the whole
table into two tasks).
"""

from __future__ import annotations

import functools
import math
import operator
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.feature import (OneHotEncoder, PCA, StandardScaler, StringIndexer,
                                StringIndexerModel, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campanula.functions import clean as C
from campanula.operators import boosting as BO
from campanula.operators import evaluate as EV
from campanula.operators import forest as FO
from campanula.operators import gram as GR
from campanula.operators import kmeans as KM
from campanula.operators import ranks as RK
from campanula.operators.abt import scalar
from campanula.session import checkpoint_dir, materialize, small

# --- fixed values: model settings of the reference --------------------------
SEED = 42
LEAD_NUM = ("discount_pct", "lead_score", "age", "avg_pages_viewed", "avg_time_on_site",
            "total_add_to_cart", "total_checkout_started", "total_sessions")
LEAD_CAT = ("lead_source", "landing_page", "observed_region", "gender", "income_band", "loyalty_tier", "preferred_device")
RETENTION_NUM = ("age", "total_acquisition_cost", "total_revenue", "total_sessions", "total_add_to_cart", "avg_pages_viewed")
RETENTION_CAT = ("gender", "income_band", "loyalty_tier", "region", "product_category", "payment_type")
RETENTION_MODELS = ("Logistic Regression", "Random Forest", "Gradient Boosting")
CAUSAL_NUM, CAUSAL_CAT = ("lead_score",), ("observed_region", "lead_source")
SEGMENT_FEATURES = ("age", "total_revenue", "total_orders", "total_sessions", "total_leads",
                    "total_add_to_cart", "total_checkout_started")
SEGMENT_NAMES = ("Champions", "Core Buyers", "Engaged Browsers", "Dormant / At Risk")
CAMPAIGN_FEATURES = ("spend_usd", "total_leads", "LCR", "ROAS")
LTV_FEATURES = ("age", "total_orders", "total_sessions", "avg_engagement_score", "total_acquisition_cost",
                "AOV", "avg_lead_score", "avg_pages_viewed", "total_add_to_cart")
TREES, GBT_ITER, GBT_STEP, GBT_DEPTH = 150, 150, 0.05, 3
# -----------------------------------------------------------------------------


def lead_frame(leads: DataFrame, abt: DataFrame) -> DataFrame:
    """ML-20: leads joined to their customer's profile; numeric 0-fill,
    categorical 'Unknown'-fill; label = converted."""
    prof = abt.select("customer_id", "age", "gender", "income_band", "loyalty_tier", "avg_pages_viewed",
                      "avg_time_on_site", "total_add_to_cart", "total_checkout_started", "total_sessions",
                      "total_revenue", "preferred_device")
    df = (leads.withColumnRenamed("discount_offered_pct", "discount_pct")
          .join(prof, "customer_id", "left")
          .withColumn("label", F.col("converted_30d").cast("double")))
    df = df.select("lead_id", "customer_id", "label",
                   *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in LEAD_NUM],
                   *[F.coalesce(F.col(c), F.lit("Unknown")).alias(c) for c in LEAD_CAT])
    return df


def causal_frame(leads: DataFrame) -> DataFrame:
    """Frame of the discount effect (ML-15, CAU-01): missing discount 0, missing score
    the median score, missing region and source a level of their own."""
    df = leads.select("lead_id", F.col("converted_30d").cast("double").alias("label"),
                      F.coalesce("discount_offered_pct", F.lit(0.0)).alias("discount_pct"), "lead_score",
                      *[F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in CAUSAL_CAT])
    return C.fill_median(df, ["lead_score"]).withColumn("treated", (F.col("discount_pct") > 0).cast("double"))


def retention_frame(repeat_target: DataFrame, abt: DataFrame) -> DataFrame:
    """ML-21: customers with an order, their profile and first order; numbers 0-filled,
    categories 'Unknown'-filled; label = a second order within 90 days."""
    first = repeat_target.select("customer_id", F.col("repeat_90d").cast("double").alias("label"), "product_category", "payment_type")
    return abt.join(first, "customer_id").select(
        "customer_id", "total_orders", "label", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in RETENTION_NUM],
        *[F.coalesce(F.col(c), F.lit("Unknown")).alias(c) for c in RETENTION_CAT])


def stratified_rank(df: DataFrame, label: str, key: str, seed: int = SEED) -> DataFrame:
    """Per-stratum position of each row in a seeded hash order, and the
    stratum size: ``_pos`` in 1..``_n_s``.  Used for splits and folds."""
    h = F.xxhash64(F.col(key).cast("string"), F.lit(seed))
    ranked = RK.prefix_sum(df.withColumn("_h", h), [F.col(label), F.col("_h"), F.col(key)])
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_s"))
    ranked = ranked.join(F.broadcast(small(sizes)), label)  # one row per class
    first = ranked.groupBy(label).agg(F.min("_cum").alias("_first"))
    return (ranked.join(F.broadcast(small(first)), label)
            .withColumn("_pos", F.col("_cum") - F.col("_first") + 1)
            .drop("_cum", "_cum_before", "_w", "_first", "_h"))


def stratum_cuts(df: DataFrame, label: str, key: str, train_frac: float, seed: int = SEED) -> dict:
    """Per stratum (hash, rows): the hash of the last training row in the seeded hash
    order, and how many rows with this hash belong to the training part.

    Multi-pass selection, ten bits of the hash a pass: a pass counts the rows that
    share the bits found so far by their next ones, until a single hash is left.
    The driver sees at most 1,024 counts a stratum and pass; no row is moved."""
    h = F.xxhash64(F.col(key).cast("string"), F.lit(seed))
    rows = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), h.alias("h"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a stratum
    open_ = {v: (None, math.floor(n * train_frac)) for v, n in sizes.items()}
    cuts = {v: (None, 0) for v, (_, rank) in open_.items() if not rank}
    shift = 64
    while open_ := {v: state for v, state in open_.items() if v not in cuts}:
        before, shift = shift, max(shift - 10, 0)
        inside = F.lit(False)
        for v, (prefix, _) in open_.items():
            same = F.col("label").eqNullSafe(F.lit(v))
            inside = inside | (same if prefix is None else same & (F.shiftright("h", before) == prefix))
        counts = (rows.filter(inside).groupBy("label", F.shiftright("h", shift).alias("prefix"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).collect())
        counts.sort(key=lambda r: r["prefix"])
        for v, (_, rank) in open_.items():
            for r in counts:
                if r["label"] == v or (v != v and r["label"] != r["label"]):
                    if rank <= r["n"]:
                        open_[v] = (r["prefix"], rank)
                        if r["lo"] == r["hi"]:
                            cuts[v] = (r["lo"], rank)
                        break
                    rank -= r["n"]
    return cuts


def stratified_split(df: DataFrame, label: str, key: str, train_frac: float = 0.75, seed: int = SEED):
    """ML-07: exact per-class train/test split by seeded hash rank.

    Rows are compared with the last training row's hash where they are: no order and
    no copy of the rows.  Only rows that share this hash (a repeated key) are ranked.
    ``df`` is read by both parts: give a written table."""
    h = F.xxhash64(F.col(key).cast("string"), F.lit(seed))
    below, at, quota = F.lit(False), F.lit(False), F.lit(0)
    for v, (cut, rank) in stratum_cuts(df, label, key, train_frac, seed).items():
        if cut is not None:
            same = F.col(label).eqNullSafe(F.lit(v))
            below, at, quota = below | (same & (h < cut)), at | (same & (h == cut)), F.when(same, F.lit(rank)).otherwise(quota)
    known = df.filter(F.col(label).isNotNull())
    tied = materialize(stratified_rank(known.filter(at), label, key, seed).withColumn("_train", F.col("_pos") <= quota)).select(*df.columns, "_train")
    return (known.filter(below).unionByName(tied.filter("_train").drop("_train")),
            known.filter(~below & ~at).unionByName(tied.filter("not _train").drop("_train")))


def ranked_parts(ranked: DataFrame, train_frac: float):
    """The parts of ``stratified_split`` from a written ``stratified_rank``, in hash order: a
    forest draws its rows by their place, so its fit depends on how its training part is laid out."""
    is_train = F.col("_pos") <= F.floor(F.col("_n_s") * train_frac)
    return ranked.filter(is_train), ranked.filter(~is_train)


def with_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """ML-08: stratified fold id 0..k-1 (round robin over the hash order)."""
    return stratified_rank(df, label, key, seed).withColumn("fold", _fold(k)).drop("_pos", "_n_s")


def _fold(k: int) -> Column:
    return ((F.col("_pos") - 1) % k).cast("int")


def balanced_weight(df: DataFrame, label: str = "label") -> Column:
    """Class-balanced weight n / (2 n_y)."""
    n = scalar(df, F.count(F.lit(1)))
    n1 = scalar(df, F.sum(F.col(label)))
    return F.when(F.col(label) == 1.0, n / (2.0 * n1)).otherwise(n / (2.0 * (n - n1)))


def feature_stages(num: Sequence[str], cat: Sequence[str], scale: bool = False):
    """ML-03: index + one-hot (drop the alphabetically first level) + assemble.

    Levels are indexed in descending order, so the slot that the encoder drops
    is the first level's: k levels give k - 1 columns.  Nulls must have been
    filled; a level that the fit has not seen is an error, not a column."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetDesc",
                         handleInvalid="error") for c in cat]
    ohe = [OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_oh", dropLast=True, handleInvalid="error")
           for c in cat]
    asm = VectorAssembler(inputCols=list(num) + [f"{c}_oh" for c in cat], outputCol="raw_features",
                          handleInvalid="keep")
    stages = idx + ohe + [asm]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    else:
        stages[-1] = VectorAssembler(inputCols=list(num) + [f"{c}_oh" for c in cat], outputCol="features",
                                     handleInvalid="keep")
    return stages


def split_levels(df: DataFrame, cat: Sequence[str]) -> list[str]:
    """Categories with two levels at least; one level has no dummy column (ML-03)."""
    if not cat:
        return []
    r = df.agg(*[F.coalesce(F.min(c) != F.max(c), F.lit(False)).alias(c) for c in cat]).first()
    return [c for c in cat if r[c]]


def classifiers(weight_col: str | None = "weight") -> dict:
    """ML-09..ML-12 with the reference's settings."""
    return {
        "Logistic Regression": LogisticRegression(maxIter=1000, weightCol=weight_col, featuresCol="features"),
        "Random Forest": RandomForestClassifier(numTrees=TREES, seed=SEED, weightCol=weight_col),
        "Gradient Boosting": GBTClassifier(maxIter=GBT_ITER, stepSize=GBT_STEP, maxDepth=GBT_DEPTH, seed=SEED),
        "Naive Bayes": NaiveBayes(modelType="gaussian"),
    }


def _prob(df: DataFrame) -> DataFrame:
    return df.withColumn("score", vector_to_array("probability")[1])


@dataclass
class Selection:
    """The comparison (ML-22) and the model with the best cross-validated AUC, fitted on
    the training part and stored.  ``model`` is None where only one class occurs, and every
    row's probability is then that class; a class of a single row leaves it null."""
    table: DataFrame
    model: PipelineModel | None
    only_class: float | None
    holdout: DataFrame  # keys of the rows no stored model was fitted on
    key: str


def select_model(frame: DataFrame, num: Sequence[str], cat: Sequence[str], key: str,
                 models: dict | None = None, folds: int = 5, seed: int = SEED) -> Selection:
    """ML-22 (+EVA-01/02, ML-08): per model test metrics and k-fold CV AUC, and the
    selected model, stored under the checkpoint folder and read back.

    Models are fitted on Spark; the driver loops over <= 4 configurations x (1 + folds)
    fits and collects only metric rows.  All held-out predictions, of every fold and of
    the test part, are one table; their exact AUCs are one ordered pass.
    """
    spark = frame.sparkSession
    models = models or classifiers()
    schema = ("model string, accuracy double, auc_test double, cv_auc double, f1 double, precision double, "
              "recall double")
    def nothing(only_class):  # every model without figures, none selected
        none = spark.createDataFrame([(m, *[None] * 6) for m in models], schema).withColumn("selected", F.lit(False))
        return Selection(none, None, only_class, frame.select(key).limit(0), key)

    classes = _classes(frame)
    if len(classes) < 2:
        return nothing(classes[0] if classes else None)
    cat = split_levels(frame, cat)
    feats = Pipeline(stages=feature_stages(num, cat, scale=False)).fit(frame)
    data = feats.transform(frame).withColumn("weight", balanced_weight(frame))
    data = data.select(key, "label", "features", "weight")
    # one written hash order for the 75/25 holdout and the k-fold CV over all rows
    data = materialize(stratified_rank(data, "label", key, seed).withColumn("fold", _fold(folds)))
    train, test = ranked_parts(data, 0.75)
    if len(_classes(train)) < 2:  # a class of a single row
        return nothing(None)
    parts = {-1: (train, test), **{f: (data.filter(F.col("fold") != f), data.filter(F.col("fold") == f)) for f in range(folds)}}
    slots = [1] * len(num) + [len(s.labels) - 1 for s in feats.stages if isinstance(s, StringIndexerModel)]
    trained = _fit_all(models, {f: fit for f, (fit, _) in parts.items()}, slots)
    fitted, predicted = {name: trained[name, -1] for name in models}, None
    for (name, fold), m in trained.items():
        p = _prob(m.transform(parts[fold][1])).select(F.lit(name).alias("model"), F.lit(fold).alias("fold"), "label", "score")
        predicted = p if predicted is None else predicted.unionByName(p)
    predicted = materialize(predicted)
    aucs = {(r["model"], r["fold"]): r["auc"] for r in EV.auc(predicted, by=["model", "fold"]).collect()}
    out = []
    for name in models:
        met = EV.binary_metrics(predicted.filter((F.col("model") == name) & (F.col("fold") == -1))).first()
        cv = [a for f in range(folds) if (a := aucs.get((name, f))) is not None]  # a fold without both classes has none
        out.append((name, float(met["accuracy"]), aucs.get((name, -1)), sum(cv) / len(cv) if cv else None, float(met["f1"]),
                    float(met["precision"]), float(met["recall"])))
    best = max(out, key=lambda r: (-1.0 if r[3] is None else r[3], r[0]))[0]
    table = spark.createDataFrame(out, schema).withColumn("selected", F.col("model") == best)
    return Selection(table, _stored(spark, PipelineModel([*feats.stages, fitted[best]])), None, materialize(test.select(key).distinct()), key)


def _stored(spark: SparkSession, model: PipelineModel) -> PipelineModel:
    """Write a fitted model below the shared checkpoint folder and read it back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/campanula_models/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def compare_models(frame: DataFrame, num: Sequence[str], cat: Sequence[str], key: str,
                   models: dict | None = None, folds: int = 5, seed: int = SEED) -> DataFrame:
    """The comparison of ``select_model`` alone."""
    return select_model(frame, num, cat, key, models, folds, seed).table


def score_selected(chosen: Selection, frame: DataFrame) -> DataFrame:
    """EVA-07: probability and priority tier of every row by the selected model, and
    whether the row was held out from its fit."""
    if chosen.model is None:
        scored = frame.withColumn("predicted_prob", F.lit(chosen.only_class).cast("double"))
    else:
        scored = _prob(chosen.model.transform(frame)).select(*frame.columns, F.col("score").alias("predicted_prob"))
    held = chosen.holdout.withColumn("holdout", F.lit(True))
    return scored.withColumn("priority_tier", EV.priority_tier(F.col("predicted_prob"))).join(held, chosen.key, "left") \
                 .withColumn("holdout", F.coalesce("holdout", F.lit(False)))


def _classes(frame: DataFrame) -> list[float]:
    """Up to two of the labels that occur."""
    return [r[0] for r in frame.select(F.col("label").cast("double")).distinct().limit(2).collect()]


def _dealt(rows: DataFrame, per_task: int = 250_000) -> DataFrame:
    """Rows for a forest, at most about ``per_task`` a task: a forest holds several
    hundred bytes a row (one number a tree), so a task's share of a compact file can
    be some GB.  Rows that are few enough stay where they are."""
    n = -(-rows.count() // per_task)
    return rows if rows.rdd.getNumPartitions() >= n else rows.repartition(n)


def _fit_all(models: dict, parts: dict, slots: Sequence[int] | None = None, few: int = 1_000_000) -> dict:
    """Fit every model on every part.  A fit is a long chain of short jobs, so fits run
    together: over at most ``few`` rows a part all of them, the longest chains first, with
    the parts held in memory; over more rows one model's at a time, on three parts.
    Boosting, and over more rows forests, take all parts in the same passes (``slots``:
    see ``boosting.fit_parts``)."""
    from concurrent.futures import ThreadPoolExecutor

    short = all(rows.count() <= few for rows in parts.values())
    held = {p: rows.select("label", "features", "weight") for p, rows in parts.items()}
    shared = {m: BO.fit_parts for m in models if BO.takes(models[m])}
    if not short:  # over fewer rows a Spark forest is quicker, and its draws are kept
        shared |= {m: FO.fit_parts for m in models if FO.takes(models[m])}
    order = [*shared, *[m for m in models if m not in shared]]
    done = {}

    def fit(task):
        name, p = task
        if p is None:
            return {(name, q): m for q, m in shared[name](held, models[name], slots).items()}
        return {task: models[name].copy().fit(held[p])}
    if short:
        for rows in held.values():
            rows.persist()
    try:
        for batch in [order] if short else [[name] for name in order]:
            tasks = [(name, p) for name in batch for p in ([None] if name in shared else parts)]
            with ThreadPoolExecutor(max_workers=len(tasks) if short else 3) as ex:
                for fitted in ex.map(fit, tasks):
                    done.update(fitted)
    finally:
        if short:
            for rows in held.values():
                rows.unpersist()
    return {(name, p): done[name, p] for name in models for p in parts}


def score_with(frame: DataFrame, num: Sequence[str], cat: Sequence[str], estimator) -> DataFrame:
    """EVA-07 with a fitted model: probability and priority tier per row.  If
    only one class occurs there is nothing to fit: each row's probability is
    that class."""
    classes = _classes(frame)
    if len(classes) < 2:
        p = F.lit(classes[0] if classes else None).cast("double")
        return frame.withColumns({"predicted_prob": p, "priority_tier": EV.priority_tier(p)})
    cat = split_levels(frame, cat)
    pipe = Pipeline(stages=feature_stages(num, cat) + [estimator]).fit(
        frame.withColumn("weight", balanced_weight(frame)))
    pred = _prob(pipe.transform(frame))
    return pred.select(*[c for c in frame.columns], F.col("score").alias("predicted_prob"),
                       EV.priority_tier(F.col("score")).alias("priority_tier"))


def importance_table(frame: DataFrame, num: Sequence[str], cat: Sequence[str], top: int = 15) -> DataFrame:
    """ML-16: random-forest feature importances with assembled feature names."""
    cat = split_levels(frame, cat)
    pipe = Pipeline(stages=feature_stages(num, cat) + [
        RandomForestClassifier(numTrees=TREES, seed=SEED, weightCol="weight")]).fit(
        _dealt(frame.select("label", *num, *cat)).withColumn("weight", balanced_weight(frame)))
    model = pipe.stages[-1]
    names = _feature_names(pipe.transform(frame.limit(1)).schema["features"].metadata, model.numFeatures)
    imp = model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, imp)]
    df = frame.sparkSession.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(top)


def _feature_names(meta: dict, n: int) -> list[str]:
    names = [f"f{i}" for i in range(n)]
    for group in meta.get("ml_attr", {}).get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a["name"]
    return names


def linear_terms(enc: PipelineModel, model, num: Sequence[str], cat: Sequence[str], x: Column) -> dict[str, Column]:
    """What each column adds to the margin of a logistic regression fitted on
    ``feature_stages``: the sum over its slots of the feature array ``x``."""
    slots = {s.getInputCol(): len(s.labels) - 1 for s in enc.stages if isinstance(s, StringIndexerModel)}
    weights, at, terms = model.coefficients.toArray().tolist(), 0, {}
    for c in (*num, *cat):
        n = slots.get(c, 1)
        terms[c] = functools.reduce(operator.add, [x[i] * weights[i] for i in range(at, at + n)])
        at += n
    return terms


def permutation_importance(frame: DataFrame, num: Sequence[str], cat: Sequence[str], key: str,
                           columns: Sequence[str], seed: int = SEED) -> DataFrame:
    """ML-17 (re-aimed tree SHAP): AUC drop on holdout rows when one column is
    permuted.

    The permutation pairs row ranks in key order with ranks in a seeded hash
    order (two prefix-sum rankings and one equi-join on the rank), so it is
    a 1:1 distributed shuffle of the column, not a driver-side reorder.
    """
    cat = split_levels(frame, cat)
    columns = [c for c in columns if c in (*num, *cat)]  # a constant category cannot matter
    enc = Pipeline(stages=feature_stages(num, cat)).fit(frame)
    train, fw = stratified_split(frame, "label", key)
    fit = enc.transform(train.withColumn("weight", balanced_weight(train)))
    model = LogisticRegression(maxIter=200, weightCol="weight", featuresCol="features").fit(fit)

    used = [*num, *cat]
    # the fitted stages see every holdout row once; a copy with another row's value differs by one term
    terms = linear_terms(enc, model, num, cat, F.col("_x"))
    held = materialize(enc.transform(fw).select(key, "label", vector_to_array("features").alias("_x"))
                       .select(key, "label", *[terms[c].alias(f"_t_{c}") for c in used]))
    by_key = materialize(RK.prefix_sum(held, [F.col(key)]).withColumnRenamed("_cum", "_r")
                         .drop("_cum_before", "_w", key))
    by_hash = materialize(RK.prefix_sum(held.select(key, *[F.col(f"_t_{c}").alias(f"_p_{c}") for c in columns]).withColumn(
        "_h", F.xxhash64(F.col(key).cast("string"), F.lit(seed))), [F.col("_h"), F.col(key)])
        .withColumnRenamed("_cum", "_r").drop("_cum_before", "_w", "_h", key))
    # every row once as it is (-1) and once per column with that column's term from its partner row
    every = by_key.join(by_hash, "_r").withColumn("_v", F.explode(F.array(*[F.lit(i) for i in range(-1, len(columns))])))
    swapped = [F.when(F.col("_v") == columns.index(c), F.col(f"_p_{c}")).otherwise(F.col(f"_t_{c}")) if c in columns else F.col(f"_t_{c}")
               for c in used]
    margin = functools.reduce(operator.add, swapped, F.lit(0.0)) + float(model.intercept)
    aucs = small(EV.auc(every.select("_v", "label", (1.0 / (1.0 + F.exp(-margin))).alias("score")), by=["_v"]))
    base = scalar(aucs.filter("_v = -1"), F.first("auc"))
    names = F.array(*[F.lit(c) for c in columns]) if columns else F.array().cast("array<string>")
    return aucs.filter("_v >= 0").select(F.get(names, F.col("_v")).alias("feature"), base.alias("base_auc"),
                                         F.col("auc").alias("permuted_auc"), (base - F.col("auc")).alias("auc_drop"))


def segment_matrix(abt: DataFrame, feats: Sequence[str] = SEGMENT_FEATURES) -> DataFrame:
    """ML-01 + ML-02: median imputation, standardisation (population std)."""
    cast = abt.select("customer_id", "total_revenue", "email_opt_in",
                      *[F.col(c).cast("double").alias(f"_{c}") for c in feats])
    known = cast.select(*[F.nanvl(F.col(f"_{c}"), F.lit(None).cast("double")).alias(c) for c in feats])
    medians = small(RK.exact_quantiles(known.unpivot([], list(feats), "f", "x"), "x", {"m": 0.5}, ["f"]))  # one row per feature
    filled = cast.select("customer_id", "total_revenue", "email_opt_in", *[
        F.coalesce(F.nanvl(F.col(f"_{c}"), F.lit(None).cast("double")), scalar(medians.filter(F.col("f") == c), F.first("m"))).alias(f"i_{c}")
        for c in feats])
    x = VectorAssembler(inputCols=[f"i_{c}" for c in feats], outputCol="raw").transform(filled)
    sc = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(x)
    return sc.transform(x).select("customer_id", "total_revenue", "email_opt_in", "features")


def kmeans_sweep(x: DataFrame, ks: Sequence[int], key: str = "customer_id", restarts: int = 10, seed: int = SEED) -> DataFrame:
    """ML-04 / ML-06: inertia and silhouette per k, all fits in shared scans."""
    return KM.sweep(x, list(ks), key, restarts, seed)[1]


def best_kmeans(x: DataFrame, k: int, key: str = "customer_id", restarts: int = 10, seed: int = SEED) -> KM.Model:
    """ML-04: k-means with restarts, keep the lowest cost."""
    return KM.fit(x, [k], key, restarts, seed)[k]


def segment_customers(abt: DataFrame, k: int = 4) -> DataFrame:
    """ML-04 + WIN-07: segments named by their mean revenue rank."""
    x = materialize(segment_matrix(abt))
    seg = best_kmeans(x, k).transform(x).withColumnRenamed("prediction", "Segment")
    seg = materialize(seg.drop("features"))
    means = seg.groupBy("Segment").agg(F.avg("total_revenue").alias("_m"))
    from pyspark.sql import Window
    w = Window.orderBy(F.col("_m").desc(), F.col("Segment"))  # k rows
    names = F.element_at(F.array(*[F.lit(n) for n in SEGMENT_NAMES]), F.row_number().over(w).cast("int"))
    lab = small(means.select("Segment", names.alias("Segment_Name")))  # k rows
    return seg.join(F.broadcast(lab), "Segment")


def group_campaigns(features: DataFrame, ks: Sequence[int] = (2, 3, 4, 5), restarts: int = 10, seed: int = SEED) -> DataFrame:
    """ML-05: standardised campaign features, ten restarts for each k, k chosen by best silhouette."""
    x0 = features.select("campaign_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                          for c in CAMPAIGN_FEATURES])
    raw = VectorAssembler(inputCols=list(CAMPAIGN_FEATURES), outputCol="raw").transform(x0)
    x = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(raw).transform(raw)
    x = materialize(x)
    n = x.count()  # model selection control flow: one number to the driver
    models, table = KM.sweep(x, [k for k in ks if k < n], "campaign_id", restarts, seed)
    scores = {r.k: r.silhouette for r in table.collect() if r.silhouette is not None}  # one row per k
    if not scores:  # too few or equal campaigns: one group
        return x.select("campaign_id", F.lit(0).alias("Group"))
    best = max(scores, key=lambda k: (scores[k], -k))
    return models[best].transform(x, "Group").select("campaign_id", "Group")


def pca_2d(x: DataFrame, key: str = "customer_id") -> DataFrame:
    """ML-18 (re-aimed t-SNE): two principal components of the scaled features."""
    p = PCA(k=2, inputCol="features", outputCol="pc").fit(x).transform(x)
    arr = vector_to_array("pc")
    return p.select(key, arr[0].alias("pc1"), arr[1].alias("pc2"))


def mlr_rows(df: DataFrame, y: str, num: Sequence[str], key: str, cat: Sequence[str] = (), seed: int = SEED) -> DataFrame:
    """Rows of a regression with their part: 0 train (75 %), 1 holdout, by the key's hash."""
    return materialize(GR.frame(df, y, num, cat, F.when(GR.md5_unit(F.col(key), seed) < 0.75, 0).otherwise(1)))


def mlr(df: DataFrame, y: str, num: Sequence[str], name: str, key: str, cat: Sequence[str] = (), seed: int = SEED) -> DataFrame:
    """ML-14: linear regression, 75/25 hash split, holdout R2, adjusted R2 on the
    test n, strongest standardised coefficient; train and holdout sums come from
    one pass.  Null where there are no rows, or y is constant."""
    rows = mlr_rows(df, y, num, key, cat, seed)
    d = GR.design(rows, num, cat)
    sums = GR.gram(rows, d)
    n_train, n_test = (int(round(sums[p][0, 0])) if p in sums else 0 for p in (0, 1))
    r2 = adj = top = None
    if n_train:
        coefs, standard = GR.least_squares(sums[0])
        k = len(d.names)
        if k and np.max(np.abs(standard)) > 0:
            top = d.names[int(np.argmax(np.abs(standard)))]
        if n_test:
            spread = sums[1][-1, -1] - sums[1][0, -1] ** 2 / n_test
            if spread > 1e-12 * max(n_test * d.shift[-1] ** 2, 1e-300):
                r2 = 1.0 - GR.squared_error(sums[1], coefs) / spread
                adj = 1.0 - (1.0 - r2) * (n_test - 1) / (n_test - k - 1) if n_test > k + 1 else None
    number = lambda v: None if v is None else float(v)
    return df.sparkSession.createDataFrame([(name, number(r2), number(adj), n_train, n_test, top)],
                                           "model string, R2 double, Adj_R2 double, n_train bigint, n_test bigint, top_predictor string")


def gram_table(df: DataFrame, y: str, num: Sequence[str], name: str, key: str, cat: Sequence[str] = (), seed: int = SEED) -> DataFrame:
    """The sums behind ``mlr``: per part and pair of columns (all levels) the sums of products that are not zero (beyond rounding)."""
    rows = mlr_rows(df, y, num, key, cat, seed)
    d = GR.design(rows, num, cat, drop_first=False)
    names = ["1", *d.names, "y"]
    out = [(name, "holdout" if part else "train", *sorted((names[i], names[j])), float(v))
           for part, g in GR.gram(rows, d).items() for (i, j), v in np.ndenumerate(GR.raw_sums(g, d)) if i <= j and abs(v) > 1e-6]
    return df.sparkSession.createDataFrame(out, "model string, part string, a string, b string, total double")


def logit_table(df: DataFrame, y: str, num: Sequence[str], cat: Sequence[str] = ()) -> DataFrame:
    """ML-15: logistic regression on standardised features with the reference's ridge
    and all levels; one row per number and level, with the p-value of coefficient
    over standard error.  Nulls where only one class occurs."""
    fit = GR.fit_logit(materialize(GR.frame(df, y, num, cat)), num, cat)
    rows = [(f, None, None, None) for f in fit.design.names] if fit.scaled is None else [
        (f, float(b), float(s), math.erfc(abs(b) / s / math.sqrt(2.0)) if s > 0 else None)
        for f, b, s in zip(fit.design.names, fit.scaled, fit.std_error)]
    return df.sparkSession.createDataFrame(rows, "feature string, scaled_coef double, std_error double, p_value double")


def propensity_scores(df: DataFrame, treat: str, num: Sequence[str], cat: Sequence[str] = ()) -> DataFrame:
    """CAU-01: logistic propensity of treatment given the covariates as they are
    (the reference's ridge, all levels); scored by a row expression.  Null where
    nobody or everybody is treated."""
    fit = GR.fit_logit(materialize(GR.frame(df, treat, num, cat)), num, cat, standardise=False)
    return df.dropna(subset=list(num)).withColumn("ps", fit.score())


def blocked_bootstrap_ci(df: DataFrame, value: str, key: str, n_boot: int = 2000, seed: int = SEED,
                         ci: float = 0.95, blocks: int = 1024) -> DataFrame:
    """STA-11: percentile CI of the mean by a bootstrap over hash blocks.

    One pass reduces the rows to (sum, count) of ``blocks`` blocks, by the hash of
    the key.  A replicate draws as many blocks with replacement (multinomial
    weights) and divides the drawn sum by the drawn count.  The work after the pass
    is ``n_boot * blocks`` draws whatever the number of rows.  Hashes are MD5 of
    (seed, replicate, draw), eight draws a digest, so any engine can repeat them;
    ``blocks`` is a power of two from 8 to 65,536.
    """
    if blocks & (blocks - 1) or not 8 <= blocks <= 1 << 16:
        raise ValueError("blocks must be a power of two from 8 to 65536")

    def chunk(digest: Column, at: int) -> Column:
        return F.conv(F.substring(digest, 1 + 4 * at, 4), 16, 10).cast("int") % blocks

    def md5(*parts: Column) -> Column:
        return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))
    x = F.col(value).cast("double")
    sums = small(df.filter(x.isNotNull() & ~F.isnan(x)).groupBy(chunk(md5(F.col(key), F.lit(seed)), 0).alias("block"))
                 .agg(F.sum(x).alias("s"), F.count(F.lit(1)).alias("n")))
    draws = df.sparkSession.range(n_boot).withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(blocks // 8 - 1))))
    draws = draws.withColumn("digest", md5(F.lit(seed), F.col("id"), F.col("draw")))
    draws = draws.select("id", F.explode(F.array(*[chunk(F.col("digest"), k) for k in range(8)])).alias("block"))
    means = (draws.join(F.broadcast(sums), "block").groupBy("id")  # at most ``blocks`` rows
             .agg(F.try_divide(F.sum("s"), F.sum("n")).alias("m")))
    lo, hi = (1 - ci) / 2, (1 + ci) / 2
    return means.agg(scalar(sums, F.try_divide(F.sum("s"), F.sum("n"))).alias("mean"), F.percentile("m", lo).alias("ci_low"),
                     F.percentile("m", hi).alias("ci_high"), F.lit(n_boot).cast("bigint").alias("n_boot"))
