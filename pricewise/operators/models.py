"""Price models (linear ones from sums of products, boosted trees on histograms, shallow
forests on MLlib, deep ones by operators.forest): fits, holdout comparison, cross-validation, out-of-fold prediction, stacking and
the weighted blend.

Every prediction lands in one long table (row_id, fold, model, target_mode,
y, yhat), so all metrics for all fits are one grouped aggregate. Boosted fits of
all folds and targets advance together (see boosting); independent MLlib fits are
submitted from a small driver thread pool.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.functions.clean import TARGET_MODES, clip_min, inverse_log_target, log_target
from pricewise.operators.boosting import Boost, Run, fit_many, score
from pricewise.operators.features import BRAND_PREFIX, feature_columns
from pricewise.operators.folds import N_FOLDS, fold_of
from pricewise.operators.forest import Forest, fit_forest
from pricewise.operators.gram import LinearModel, collect_grams, fold_predictor, total_of
from pricewise.operators.metrics import regression_metrics
from pricewise.session import cut_lineage
from pricewise.sources.tables import TARGET_COL, quote

SEED = 42
# concurrent fits submitted from the driver on a small local heap; each tree
# fit may use MLlib's aggregation budget (maxMemoryInMB) at once
POOL = 2
#: MLlib sums every node in every partition; forests that may have more nodes than this finish
#: their small nodes within tasks (see forest).
MLLIB_NODES = 1 << 17
#: Key of models fitted on all rows, beside those of the training part.
WHOLE = "all rows"


@dataclass
class ModelSpec:
    """One model family and its parameters (the reference's values by default)."""

    name: str
    kind: str  # linear | ridge | rf | leafwise | symmetric
    params: dict = field(default_factory=dict)


# Model parameters used by the reference's pipeline.
LINEAR = ModelSpec("Linear Regression", "linear")
RIDGE = ModelSpec("Ridge", "ridge", {"alpha": 1.0})
RANDOM_FOREST = ModelSpec("Random Forest", "rf", {"numTrees": 220, "maxDepth": 18, "minInstancesPerNode": 2})
RF_IMPORTANCE = ModelSpec("Random Forest", "rf", {"numTrees": 260, "maxDepth": 18, "minInstancesPerNode": 2})
RF_ENSEMBLE = ModelSpec("random_forest", "rf", {"numTrees": 300, "maxDepth": 20, "minInstancesPerNode": 2})
RF_MARKET = ModelSpec("market_random_forest", "rf", {"numTrees": 140, "maxDepth": 14, "minInstancesPerNode": 2})
BOOSTED = ModelSpec("Gradient Boosting", "leafwise", {"rounds": 450, "rate": 0.045, "leaves": 31, "rows": 0.9, "columns": 0.9})
BOOSTED_DEEP = ModelSpec("gradient_boosting_deep", "leafwise", {"rounds": 600, "rate": 0.04, "leaves": 48, "rows": 0.85, "columns": 0.85})
BOOSTED_SYMMETRIC = ModelSpec("symmetric_boosting", "symmetric", {"rounds": 600, "rate": 0.04, "depth": 8, "l2": 3.0})
BOOSTED_BASE = ModelSpec("gradient_boosting", "leafwise", BOOSTED.params)
RIDGE_BASE = ModelSpec("ridge", "ridge", {"alpha": 1.0})
#: The five bases of the ensembles.
ENSEMBLE_BASES = [RIDGE_BASE, RF_ENSEMBLE, BOOSTED_BASE, BOOSTED_DEEP, BOOSTED_SYMMETRIC]
BOOSTED_KINDS = ("leafwise", "symmetric")
DEFAULT_MODELS = [LINEAR, RIDGE, RANDOM_FOREST, BOOSTED]


def scaled(spec: ModelSpec, **overrides) -> ModelSpec:
    """Same family with some parameters replaced (e.g. fewer trees for a smoke run)."""
    return ModelSpec(spec.name, spec.kind, {**spec.params, **overrides})


def _estimator(spec: ModelSpec, train: DataFrame, label: str):
    p = spec.params
    if spec.kind == "rf":
        return RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol="pred_t", seed=SEED,
                                     numTrees=p["numTrees"], maxDepth=min(p["maxDepth"], 30),
                                     minInstancesPerNode=p.get("minInstancesPerNode", 1),
                                     subsamplingRate=p.get("subsamplingRate", 1.0), maxBins=p.get("maxBins", 32))
    raise ValueError(spec.kind)


def fit(spec: ModelSpec, train: DataFrame, features, target_mode: str = "price_eur",
        target: str = TARGET_COL) -> PipelineModel:
    """Fit one model on the (log-)target: linear ones from one scan's sums of products (see
    gram), shallow forests with MLlib, deep ones by forest.fit_forest. For MLlib, rows are dealt by a
    hash of their id to a fixed number of sorted partitions (the session's shuffle partitions),
    so the result does not depend on the input's partitioning."""
    if spec.kind in ("linear", "ridge"):
        return fit_linear_models(train, [(spec, target_mode)], features, target)[(target_mode, spec.name)]
    if spec.kind in BOOSTED_KINDS:
        return fit_boosted_models(train, [(spec, target_mode, None)], features, target)[(target_mode, spec.name, None)]
    p = spec.params
    if spec.kind == "rf" and p["numTrees"] * 2 ** p["maxDepth"] > MLLIB_NODES:
        return fit_forest(train, features, log_target(target, target_mode),
                          Forest(p["numTrees"], min(p["maxDepth"], 30), p.get("minInstancesPerNode", 1), p.get("subsamplingRate", 1.0), p.get("maxBins", 32), SEED))
    t = train.withColumn("label_t", log_target(target, target_mode))
    if "row_id" in t.columns:
        parts = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        t = t.repartition(parts, "row_id").sortWithinPartitions("row_id")
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    est = _estimator(spec, asm.transform(t), "label_t")
    return Pipeline(stages=[asm, est]).fit(t)


def _alpha(spec: ModelSpec) -> float:
    return float(spec.params.get("alpha", 1.0)) if spec.kind == "ridge" else 0.0


def fit_linear_models(train: DataFrame, pairs, features, target: str = TARGET_COL) -> dict:
    """{(target mode, name): model} for linear and ridge ``pairs`` of (spec, mode), in one scan."""
    features = list(features)
    sums = collect_grams(train, features, {m: log_target(target, m) for m in dict.fromkeys(m for _, m in pairs)})
    if not sums:
        raise ValueError("no complete row to fit on")
    return {(mode, spec.name): LinearModel(features, *total_of(sums).solve(mode, _alpha(spec))) for spec, mode in pairs}


def _boost(spec: ModelSpec) -> Boost:
    return Boost(shape=spec.kind, **spec.params)


def fit_boosted_models(train: DataFrame, fits, features, target: str = TARGET_COL) -> dict:
    """{(target mode, name, left-out fold): model} for ``fits`` of (spec, mode, fold or None),
    which advance together over one binned table."""
    modes = {m: log_target(target, m) for m in dict.fromkeys(m for _, m, _ in fits)}
    fold = F.col("fold") if "fold" in train.columns else None
    found = fit_many(train, features, modes, [Run(_boost(s), m, j) for s, m, j in fits], fold)
    return {(m, s.name, j): model for (s, m, j), model in zip(fits, found)}


def boosted_oof_predict(enc: DataFrame, pairs, k: int = N_FOLDS, features=None, target: str = TARGET_COL, fitted: dict | None = None) -> DataFrame:
    """Out-of-fold predictions of all boosted ``pairs`` of (spec, mode), fitted together
    (unless ``fitted`` has them) and scored in one pass, every row by the models of its fold."""
    enc = enc.withColumn("fold", fold_of("row_id", k)) if "fold" not in enc.columns else enc
    feats = list(features or feature_columns(enc))
    if fitted is None:
        fitted = fit_boosted_models(enc, [(s, m, j) for s, m in pairs for j in range(k)], feats, target)
    columns = {f"__p{i}": {j: fitted[(m, s.name, j)] for j in range(k)} for i, (s, m) in enumerate(pairs)}
    rows = score(enc.select("row_id", "fold", quote(target), *(quote(f) for f in feats if f != target)), columns, "fold")
    every = [F.struct(F.lit(s.name).alias("model"), F.lit(m).alias("target_mode"), F.col(quote(target)).alias("y"),
                      inverse_log_target(f"__p{i}", m).alias("yhat")) for i, (s, m) in enumerate(pairs)]
    return rows.select("row_id", "fold", F.inline(F.array(*every)))


def linear_oof_predict(enc: DataFrame, pairs, k: int = N_FOLDS, features=None, target: str = TARGET_COL) -> DataFrame:
    """Out-of-fold predictions of all linear and ridge ``pairs`` of (spec, mode): one scan for
    the sums of every fold, the training sums of a fold being the total minus its own, and
    one scan that predicts with all models at once."""
    enc = enc.withColumn("fold", fold_of("row_id", k)) if "fold" not in enc.columns else enc
    feats = list(features or feature_columns(enc))
    sums = collect_grams(enc, feats, {m: log_target(target, m) for m in dict.fromkeys(m for _, m in pairs)}, F.col("fold"))
    every = []
    for spec, mode in pairs:
        fits = {}
        if sums:
            whole = total_of(sums)
            fits = {j: (whole - sums[j] if j in sums else whole).solve(mode, _alpha(spec)) for j in range(k)}
        p = fold_predictor(feats, fits, k)
        every.append(F.struct(F.lit(spec.name).alias("model"), F.lit(mode).alias("target_mode"), F.col(quote(target)).alias("y"),
                              inverse_log_target(p, mode).alias("yhat")))
    return enc.select("row_id", "fold", F.inline(F.array(*every)))


def predict(model: PipelineModel, df: DataFrame, target_mode: str, keep=("row_id",)) -> DataFrame:
    out = model.transform(df.drop("features"))
    return out.select(*[c for c in keep if c in out.columns],
                      inverse_log_target("pred_t", target_mode).alias("yhat"))


def _pool_size() -> int:
    """4 concurrent fits, or 2 when a local driver JVM (which then does all the
    tree aggregation itself) has less than 4 GiB of heap."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if spark is None:
        return POOL
    conf = spark.sparkContext.getConf()
    if not conf.get("spark.master", "").startswith("local"):
        return 4
    mem = conf.get("spark.driver.memory", "1g").strip().lower()
    units = {"k": 1 / 1024 / 1024, "m": 1 / 1024, "g": 1, "t": 1024}
    gib = float(mem[:-1]) * units.get(mem[-1], 1) if mem[-1] in units else float(mem) / 2 ** 30
    return 4 if gib >= 4 else POOL


def _run(jobs):
    with ThreadPoolExecutor(max_workers=_pool_size()) as pool:
        return list(pool.map(lambda j: j(), jobs))


def compare_models(enc: DataFrame, specs=DEFAULT_MODELS, modes=TARGET_MODES, test_fold: int = 0,
                   k: int = N_FOLDS, refit: bool = False) -> tuple[DataFrame, DataFrame, dict]:
    """Holdout comparison: fold ``test_fold`` is the test set. Returns the
    long prediction table, the metric table (with fit seconds) and the fitted
    models keyed by (mode, name). A fresh estimator is built for every fit. With ``refit``
    the boosted models of all rows grow along, under (mode, name, WHOLE)."""
    enc = enc.withColumn("fold", fold_of("row_id", k)) if "fold" not in enc.columns else enc
    feats = feature_columns(enc)
    train, test = enc.filter(F.col("fold") != test_fold), enc.filter(F.col("fold") == test_fold)
    from pricewise.operators.quantiles import exact_median
    base = exact_median(train, TARGET_COL, (), "baseline")

    def job(mode, spec):
        def run():
            t0 = time.time()
            m = fit(spec, train, feats, mode)
            return mode, spec.name, m, time.time() - t0
        return run

    linear = [(s, m) for m in modes for s in specs if s.kind in ("linear", "ridge")]
    fitted = []
    if linear:
        t0 = time.time()
        found = fit_linear_models(train, linear, feats)
        each = (time.time() - t0) / len(found)  # they share one scan
        fitted = [(m, s.name, found[(m, s.name)], each) for s, m in linear]
    boosted = [(s, m) for m in modes for s in specs if s.kind in BOOSTED_KINDS]
    whole = {}
    if boosted:
        t0 = time.time()
        found = fit_boosted_models(enc, [(s, m, j) for s, m in boosted for j in ((test_fold, None) if refit else (test_fold,))], feats)
        each = (time.time() - t0) / len(found)  # they share their passes
        fitted += [(m, s.name, found[(m, s.name, test_fold)], each) for s, m in boosted]
        whole = {(m, s.name, WHOLE): found[(m, s.name, None)] for s, m in boosted if refit}
    fitted += _run([job(m, s) for m in modes for s in specs if s.kind == "rf"])
    preds, times, models = [], [], {}
    for mode, name, m, secs in fitted:
        models[(mode, name)] = m
        times.append((mode, name, float(secs)))
        preds.append(predict(m, test, mode, keep=("row_id", "fold", TARGET_COL))
                     .select("row_id", "fold", F.lit(name).alias("model"), F.lit(mode).alias("target_mode"),
                             F.col(TARGET_COL).alias("y"), "yhat"))
    long = preds[0]
    for p in preds[1:]:
        long = long.unionByName(p)
    long = long.crossJoin(F.broadcast(base))
    spark = enc.sparkSession
    secs = spark.createDataFrame(times, "target_mode string, model string, fit_seconds double")
    mets = regression_metrics(long, group=["target_mode", "model"]).join(secs, ["target_mode", "model"], "left")
    return long, mets, {**models, **whole}


def winner(mets: DataFrame, models: dict, enc: DataFrame, specs=DEFAULT_MODELS):
    """(target mode, model fitted on all rows) of the leaderboard's first row."""
    from pricewise.operators.metrics import best_model
    best = best_model(mets).first()
    model = models.get((best.target_mode, best.model, WHOLE))
    if model is None:
        spec = next(s for s in specs if s.name == best.model)
        model = fit(spec, enc, feature_columns(enc), best.target_mode)
    return best.target_mode, model


def oof_predict(enc: DataFrame, spec: ModelSpec, target_mode: str = "price_eur", k: int = N_FOLDS,
                features=None, target: str = TARGET_COL) -> DataFrame:
    """Out-of-fold predictions: fold j is predicted by a model fitted on the
    other folds. Every row is predicted exactly once."""
    enc = enc.withColumn("fold", fold_of("row_id", k)) if "fold" not in enc.columns else enc
    feats = list(features or feature_columns(enc))
    if spec.kind in ("linear", "ridge"):
        return linear_oof_predict(enc, [(spec, target_mode)], k, feats, target)
    if spec.kind in BOOSTED_KINDS:
        return boosted_oof_predict(enc, [(spec, target_mode)], k, feats, target)

    def job(j):
        return lambda: (j, fit(spec, enc.filter(F.col("fold") != j), feats, target_mode, target))

    parts = []
    for j, m in _run([job(j) for j in range(k)]):
        parts.append(predict(m, enc.filter(F.col("fold") == j), target_mode, keep=("row_id", "fold", target))
                     .select("row_id", "fold", F.lit(spec.name).alias("model"), F.lit(target_mode).alias("target_mode"),
                             F.col(target).alias("y"), "yhat"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_baselines(enc: DataFrame, k: int = N_FOLDS, target: str = TARGET_COL) -> DataFrame:
    from pricewise.operators.folds import baseline_median
    return baseline_median(enc, target, k).withColumnRenamed("k", "fold")


def cross_validate(enc: DataFrame, specs=DEFAULT_MODELS, modes=TARGET_MODES, k: int = N_FOLDS):
    """k-fold CV of every (mode, model): the OOF prediction table, per-fold
    metrics (baseline = training-fold median) and their means."""
    from pricewise.operators.metrics import cv_mean_metrics
    enc = enc.withColumn("fold", fold_of("row_id", k)) if "fold" not in enc.columns else enc
    linear = [(s, m) for m in modes for s in specs if s.kind in ("linear", "ridge")]
    boosted = [(s, m) for m in modes for s in specs if s.kind in BOOSTED_KINDS]
    found = [linear_oof_predict(enc, linear, k)] if linear else []
    found += [boosted_oof_predict(enc, boosted, k)] if boosted else []
    found += [oof_predict(enc, s, m, k) for m in modes for s in specs if s.kind == "rf"]
    long = reduce(DataFrame.unionByName, found)
    long = long.join(F.broadcast(fold_baselines(enc, k)), "fold", "left")
    folds = regression_metrics(long)
    return long, folds, cv_mean_metrics(folds)


# --- ensembles ---------------------------------------------------------------

def blend_weights(oof: DataFrame) -> DataFrame:
    """w = 1 / max(CV MAE in EUR, 1e-6), normalised to sum to 1 (MAE unclipped)."""
    mae = oof.groupBy("model").agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("cv_mae"))
    raw = mae.withColumn("_w", F.lit(1.0) / F.greatest(F.col("cv_mae"), F.lit(1e-6)))
    tot = raw.agg(F.sum("_w").alias("_t"))
    return raw.crossJoin(F.broadcast(tot)).select("model", "cv_mae", (F.col("_w") / F.col("_t")).alias("weight"))


def blend_predict(preds: DataFrame, weights: DataFrame) -> DataFrame:
    """EUR-space weighted mean of each row's model predictions."""
    return (preds.join(F.broadcast(weights.select("model", "weight")), "model", "inner")
            .groupBy("row_id").agg(F.sum(F.col("weight") * F.col("yhat")).alias("yhat")))


@dataclass
class Bases:
    """The base models of both ensembles, fitted once: out-of-fold predictions on the
    training part and predictions of the holdout by models of the whole training part,
    both long (row_id, model, y, yhat)."""
    names: list[str]
    target_mode: str
    train: DataFrame
    oof: DataFrame
    holdout: DataFrame


def fit_bases(enc: DataFrame, specs, target_mode: str = "log_price_eur", test_fold: int = 0, k: int = N_FOLDS) -> Bases:
    enc = enc.withColumn("fold", fold_of("row_id", k)) if "fold" not in enc.columns else enc
    feats = feature_columns(enc)
    train, test = enc.filter(F.col("fold") != test_fold), enc.filter(F.col("fold") == test_fold)
    inner = train.withColumn("fold", (fold_of("row_id", k * k) % F.lit(k)).cast("int"))
    boosted = [s for s in specs if s.kind in BOOSTED_KINDS]
    models = {}
    oof, held = [], []
    if boosted:
        models = fit_boosted_models(inner, [(s, target_mode, j) for s in boosted for j in (*range(k), None)], feats)
        oof.append(boosted_oof_predict(inner, [(s, target_mode) for s in boosted], k, feats, fitted=models))
    for s in specs:
        if s not in boosted:
            oof.append(oof_predict(inner, s, target_mode, k, feats))
        m = models.get((target_mode, s.name, None)) or fit(s, train, feats, target_mode)
        held.append(predict(m, test, target_mode, keep=("row_id", TARGET_COL)).select("row_id", F.lit(s.name).alias("model"), F.col(TARGET_COL).alias("y"), "yhat"))
    # both ensembles read them several times, and all models sit in these plans
    wide = ["row_id", "model", "y", "yhat"]
    return Bases([s.name for s in specs], target_mode, train.select("row_id", TARGET_COL),
                 cut_lineage(reduce(DataFrame.unionByName, [o.select(*wide) for o in oof]), "bases_oof"),
                 cut_lineage(reduce(DataFrame.unionByName, held), "bases_holdout"))


def blend_of(bases: Bases) -> tuple[DataFrame, DataFrame]:
    """(weights from out-of-fold errors, blended predictions of the holdout)."""
    w = blend_weights(bases.oof)
    return w, blend_predict(bases.holdout, w)


def stack_of(bases: Bases, alpha: float = 1.0):
    """(ridge meta model on out-of-fold predictions in target space, its holdout predictions)."""
    def by_model(long):
        t = long.select("row_id", "model", log_target("yhat", bases.target_mode).alias("p_t"))
        return t.groupBy("row_id").pivot("model", bases.names).agg(F.first("p_t"))

    meta_train = by_model(bases.oof).join(bases.train, "row_id")
    meta = fit(ModelSpec("stacking_ridge_meta", "ridge", {"alpha": alpha}), meta_train, bases.names, bases.target_mode)
    return meta, predict(meta, by_model(bases.holdout), bases.target_mode)


def weighted_blend(enc: DataFrame, specs, target_mode: str = "log_price_eur", test_fold: int = 0, k: int = N_FOLDS):
    """Weights from inner k-fold OOF MAE on the training part, bases refitted
    on the whole training part, blended on the holdout."""
    return blend_of(fit_bases(enc, specs, target_mode, test_fold, k))


def stacking_ensemble(enc: DataFrame, specs, target_mode: str = "log_price_eur", test_fold: int = 0,
                      k: int = N_FOLDS, alpha: float = 1.0):
    """Base models' k-fold OOF predictions (target space) feed a ridge meta
    model; bases are refitted on the whole training part; no passthrough."""
    return stack_of(fit_bases(enc, specs, target_mode, test_fold, k), alpha)


def holdout_predictions(enc: DataFrame, stack_pred: DataFrame, blend_pred: DataFrame, test_fold: int = 0,
                        k: int = N_FOLDS) -> DataFrame:
    test = enc.filter(fold_of("row_id", k) == test_fold).select("row_id", F.col(TARGET_COL).alias("y_true_eur"))
    return (test.join(stack_pred.select("row_id", F.col("yhat").alias("stacking_pred_eur")), "row_id", "left")
                .join(blend_pred.select("row_id", F.col("yhat").alias("weighted_blend_pred_eur")), "row_id", "left"))


# --- explanation ---------------------------------------------------------------

def feature_importance(enc: DataFrame, specs=(RF_IMPORTANCE, BOOSTED), target_mode: str = "price_eur", models: dict | None = None) -> DataFrame:
    """Tree importances on all rows as a long table (model, target_mode,
    feature, importance), sorted by model then importance; a boosted model's importance is
    a feature's share in the gain of its splits. ``models`` may hold some fitted already."""
    feats = feature_columns(enc)
    spark = enc.sparkSession
    rows = []
    for s in specs:
        m = (models or {}).get((target_mode, s.name, WHOLE)) or fit(s, enc, feats, target_mode)
        imp = m.stages[-1].featureImportances.toArray()
        rows += [(f"{s.name} ({target_mode})", target_mode, f, float(v)) for f, v in zip(feats, imp)]
    return (spark.createDataFrame(rows, "model string, target_mode string, feature string, importance double")
            .orderBy("model", F.col("importance").desc()))


def adjusted_brand_premium(enc: DataFrame, brands: DataFrame, spec: ModelSpec = BOOSTED, k: int = N_FOLDS) -> DataFrame:
    """Spec-only model (no brand columns, no premium flag); out-of-fold
    prediction per row, so each residual comes from a model that never saw
    the row. ``brands`` maps row_id -> brand_group."""
    spec_feats = [c for c in feature_columns(enc) if not c.startswith(BRAND_PREFIX) and c != "num__is_premium_brand"]
    oof = oof_predict(enc, spec, "price_eur", k, features=spec_feats)
    return (oof.select("row_id", F.col("y").alias("actual_price_eur"),
                       clip_min("yhat", 1.0).alias("spec_only_pred_price_eur"))
            .join(brands, "row_id", "left"))
