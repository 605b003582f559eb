"""Choosing a model among candidates (M9, M12) and calibrating the winner by a refit (C4).

A chain of candidates is tried in stages: the reference settings, the ratio
weight, oversampled training rows, and the best of a random search.  Every
candidate is fitted once, on training rows only, and judged on the validation
rows.  The incumbent is replaced only by a strictly better one, so ties stay
with the earlier stage; a candidate that fails is a row with its error and
never becomes the incumbent.  What the driver holds is one row a candidate.

The winner's recipe, not its model, goes on to calibration: the training rows
are cut into a fit part and a stratified holdout, the recipe is fitted anew on
the fit part alone (oversampled there, if the recipe says so), and the
calibrator learns from the holdout, which the model has never seen.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import q
from riskloom.operators import models as M
from riskloom.operators.calibration import apply_calibrator, calibration_report, fit_calibrator
from riskloom.operators.imbalance import class_weight_summary, smote, with_weight_column
from riskloom.operators.metrics import binary_metrics
from riskloom.operators.split import SplitConfig, assign_splits
from riskloom.session import ensure_checkpoint_dir

# FIXED VALUES: names of the stages' winners, of the holdout, and messages.
REFERENCE, WEIGHTED, OVERSAMPLED, TUNED = "reference", "scale_pos_weight_variant", "smote_variant", "tuned_search"
HOLDOUT = "calibration_holdout"
MSG_NO_CANDIDATE = "No candidate was trained successfully."
# END FIXED VALUES

#: Candidates that are made at a time, and the most training rows for that: each fit holds its rows a second time.
SIDE_BY_SIDE, SIDE_BY_SIDE_ROWS = 4, 5_000_000

LEDGER = ("stage int, source string, params string, train_variant string, row_count long, positive_rate double, eval_row_count long, "
          "classifier_class string, best_iteration int, best_score double, metric double, error string")


@dataclass(frozen=True)
class Recipe:
    """How a candidate is made: its parameters, and whether the training rows are oversampled first."""

    stage: int
    source: str
    params: dict = field(default_factory=dict)
    oversample: bool = False


@dataclass(frozen=True)
class Learner:
    """A kind of model: ``estimator(params, features column, target, weight column, training rows)``.

    With a ``patience`` the fitted rounds are cut at the best one on the validation rows.
    """

    estimator: Callable
    preprocessing: Pipeline
    patience: int | None = None


@dataclass
class Trained:
    recipe: Recipe
    model: PipelineModel
    summary: dict


def boosting_learner(preprocessing: Pipeline, base: M.BoostingParams | None = None) -> Learner:
    """Boosted trees whose settings the params replace, name by name; ``scale_pos_weight`` is the weight of a positive row."""
    base = base or M.BoostingParams()

    def estimator(params: dict, features: str, target: str, weight: str, rows: int):
        own = {k: v for k, v in params.items() if k != "scale_pos_weight"}
        return M.BoostingParams(**{**vars(base), **own}).estimator(features, target, weight_col=weight)

    return Learner(estimator, preprocessing, base.early_stopping_rounds)


def logistic_learner(preprocessing: Pipeline, max_iter: int = 1000) -> Learner:
    """Logistic regression with params ``C`` and ``scale_pos_weight``."""
    def estimator(params: dict, features: str, target: str, weight: str, rows: int):
        return M.logistic(features, target, n_weight=float(rows), C=params.get("C", 1.0), max_iter=max_iter, weight_col=weight)

    return Learner(estimator, preprocessing)


def training_frame(train: DataFrame, key: str, target: str, features: Sequence[str], recipe: Recipe, seed: int) -> DataFrame:
    """The rows that a recipe is fitted on; only these are ever oversampled, once, to the shared checkpoint folder."""
    if not recipe.oversample:
        return train
    return smote(train, key, target, features, seed=seed)[0].checkpoint()


@dataclass
class Prepared:
    """Training and validation rows as (target, features), held for all candidates that are fitted on them."""

    stages: list
    rows: DataFrame
    validation: DataFrame
    row_count: int
    positive_rate: float
    eval_row_count: int

    def release(self) -> None:
        self.rows.unpersist()
        self.validation.unpersist()


def prepare(learner: Learner, rows: DataFrame, validation: DataFrame, target: str) -> Prepared:
    """The preprocessing fitted on the training rows, once for all candidates that share them."""
    fitted = learner.preprocessing.fit(rows)
    made, judged = (fitted.transform(df).select(target, "features") for df in (rows, validation))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.avg((q(target) == 1).cast("double")).alias("rate")).first()
    made, judged = M.held_for_iterations(M.sized_for_iterations(made, counts["n"])), judged.persist()
    return Prepared(fitted.stages, made, judged, counts["n"], counts["rate"], judged.count())


def train_candidate(recipe: Recipe, learner: Learner, data: Prepared, target: str, weight_col: str = "_weight") -> Trained:
    """M9: one fit, with its summary: rows, positive rate, rows of the evaluation, class, best round and score."""
    weighted = with_weight_column(data.rows, target, recipe.params.get("scale_pos_weight", 1.0), weight_col)
    model = PipelineModel([learner.estimator(recipe.params, "features", target, weight_col, data.row_count).fit(weighted)])
    best_iteration = best_score = None
    if learner.patience is not None:
        errors = M.learning_curve(model, data.validation.withColumn(weight_col, F.lit(1.0)))
        best_iteration = M.best_round(errors, learner.patience) - 1
        best_score = errors[best_iteration]
        model = M.shortened(model, best_iteration + 1)
    summary = {"row_count": data.row_count, "positive_rate": data.positive_rate, "eval_row_count": data.eval_row_count,
               "classifier_class": type(model.stages[-1]).__name__, "best_iteration": best_iteration, "best_score": best_score}
    return Trained(recipe, PipelineModel([*data.stages, *model.stages]), summary)


def validation_metric(trained: Trained, data: Prepared, target: str, metric: str, threshold: float = 0.5) -> float:
    scored = M.predict_proba(PipelineModel(trained.model.stages[-1:]), data.validation, keep=[target], out="_score")
    return float(binary_metrics(scored, target, "_score", threshold).first()[metric])


def with_incumbents(ledger: DataFrame, metric: str = "metric", maximize: bool = True) -> DataFrame:
    """The fold over the stages: ``incumbent`` after each, and whether the stage ``replaced`` the one before.

    A null or NaN metric (a failed candidate) never wins; equal metrics leave the earlier stage in place.
    ``ledger`` has one row a stage, so one window over all of it is small.
    """
    value = F.when(~F.isnan(metric), F.col(metric) if maximize else -F.col(metric))
    known = F.when(value.isNotNull(), F.struct(value.alias("v"), (-F.col("stage")).alias("s"), F.col("source").alias("source")))
    upto = Window.partitionBy().orderBy("stage").rowsBetween(Window.unboundedPreceding, 0)
    best = ledger.withColumn("_best", F.max(known).over(upto))
    return best.withColumn("incumbent", F.col("_best.source")) \
        .withColumn("replaced", F.coalesce(F.col("_best.s") == -F.col("stage"), F.lit(False))).drop("_best")


@dataclass
class Chain:
    """The candidates in stage order: all rows of the ledger, every search result, and the winner."""

    ledger: DataFrame
    search: DataFrame
    winner: Trained


def candidate_chain(spark: SparkSession, train: DataFrame, validation: DataFrame, learner: Learner, key: str, target: str,
                    features: Sequence[str], space: dict[str, list] | None = None, n_iter: int = 0, metric: str = "average_precision",
                    maximize: bool = True, seed: int = 42, side_by_side: int | None = None) -> Chain:
    """M12 over ``train`` and ``validation``: reference, ratio weight, oversampled rows and the best of ``n_iter`` tuned ones.

    Fits on few rows wait for their many short jobs rather than for cores: ``side_by_side`` candidates are made at a time
    (by default ``SIDE_BY_SIDE``, and one where ``train`` has more than ``SIDE_BY_SIDE_ROWS`` rows).  The fold is in stage order."""
    rows, held = [], {}

    def tried(recipe: Recipe, original: Future) -> tuple:
        try:
            data = original.result() if not recipe.oversample else prepare(
                learner, training_frame(train, key, target, features, recipe, seed), validation, target)
            trained = train_candidate(recipe, learner, data, target)
            score = validation_metric(trained, data, target, metric)
            if recipe.oversample:
                data.release()
            return trained, trained.summary, score, None
        except Exception as exc:  # noqa: BLE001 - a failed candidate is a row of the ledger
            return None, {}, None, str(exc)[:500]

    def row(recipe: Recipe, summary: dict, score, error) -> tuple:
        return (recipe.stage, recipe.source, json.dumps(recipe.params, sort_keys=True), "smote" if recipe.oversample else "original",
                *(summary.get(k) for k in ("row_count", "positive_rate", "eval_row_count", "classifier_class", "best_iteration", "best_score")),
                score, error)

    better = (lambda a, b: a > b) if maximize else (lambda a, b: a < b)
    summary = class_weight_summary(train, target).first()
    if side_by_side is None:
        side_by_side = SIDE_BY_SIDE if summary["positive_count"] + summary["negative_count"] <= SIDE_BY_SIDE_ROWS else 1
    recipes = [Recipe(0, REFERENCE), Recipe(1, WEIGHTED, {"scale_pos_weight": summary["scale_pos_weight"]}),
               Recipe(2, OVERSAMPLED, oversample=True)]
    drawn = [Recipe(3, TUNED, params) for params in M.sample_parameter_sets(space or {}, n_iter, seed)]
    with ThreadPoolExecutor(max_workers=side_by_side) as pool:
        # submitted before all candidates, so none of them waits for a preparation that has not begun
        original = pool.submit(prepare, learner, train, validation, target)
        # the oversampled rows take longest to make: they begin first
        order = sorted(range(len(recipes) + len(drawn)), key=lambda i: not [*recipes, *drawn][i].oversample)
        begun = {i: pool.submit(tried, [*recipes, *drawn][i], original) for i in order}
        results = [begun[i].result() for i in range(len(begun))]
    for recipe, (trained, summary, score, error) in zip(recipes, results):
        held[recipe.source] = trained
        rows.append(row(recipe, summary, score, error))
    tuned, best = [], None
    for i, (recipe, (trained, summary, score, error)) in enumerate(zip(drawn, results[len(recipes):])):
        made = row(recipe, summary, score, error)
        tuned.append((i, *made[2:]))
        if score is not None and (best is None or better(score, best[1][-2])):
            best = (trained, made)
    if best is not None:
        held[TUNED] = best[0]
        rows.append(best[1])
    if original.exception() is None:
        original.result().release()
    ledger = with_incumbents(spark.createDataFrame(rows, LEDGER), "metric", maximize)
    search = spark.createDataFrame(tuned, "candidate int, " + LEDGER.split("source string, ")[1])
    last = ledger.orderBy(F.desc("stage")).first()["incumbent"]
    if last is None:
        raise ValueError(MSG_NO_CANDIDATE)
    return Chain(ledger, search, held[last])


@dataclass
class Calibrated:
    """The refitted model, its calibrator, the scores of holdout, validation and test, and how many rows each part had."""

    model: Trained
    calibrator: tuple
    scores: DataFrame
    fit_rows: DataFrame


def calibrate_by_refit(train: DataFrame, evaluated: DataFrame, validation: DataFrame, recipe: Recipe, learner: Learner, key: str,
                       target: str, features: Sequence[str], method: str = "isotonic", holdout: float = 0.2, seed: int = 42,
                       split_col: str = "split") -> Calibrated:
    """C4: the recipe fitted on ``train`` minus a stratified holdout, calibrated on that holdout.

    ``evaluated`` holds the rows to be scored besides the holdout, with their part in ``split_col``.
    The scores carry ``raw`` and ``calibrated``.
    """
    parts = assign_splits(train.drop(split_col), key, target, SplitConfig(seed=seed), split_col="_part", holdout_only=holdout,
                          labels=("holdout", "unused", "fit"))
    ensure_checkpoint_dir(train.sparkSession)
    parts = parts.checkpoint()
    held = parts.where(F.col("_part") == "holdout").drop("_part").withColumn(split_col, F.lit(HOLDOUT))
    fit_rows = training_frame(parts.where(F.col("_part") == "fit").drop("_part"), key, target, features, recipe, seed)
    data = prepare(learner, fit_rows, validation, target)
    trained = train_candidate(recipe, learner, data, target)
    data.release()
    rows = evaluated.unionByName(held.select(*evaluated.columns))
    raw = M.predict_proba(trained.model, rows, keep=[key, target, split_col], out="raw").persist()
    calibrator = fit_calibrator(raw.where(F.col(split_col) == HOLDOUT), target, "raw", method)
    return Calibrated(trained, calibrator, apply_calibrator(calibrator, raw, "raw", "calibrated"), fit_rows)


def refit_report(calibrated: Calibrated, target: str, threshold: float = 0.5, split_col: str = "split") -> DataFrame:
    """C4: the full metric bundle, raw and calibrated, of holdout, validation and test in one grouped job."""
    return calibration_report(calibrated.scores, target, "raw", "calibrated", (split_col,), threshold)


def calibrated_thresholds(calibrator: tuple, thresholds: DataFrame, threshold_col: str = "threshold") -> DataFrame:
    """Raw-score thresholds with their place on the calibrated scale: a raw score at the threshold calibrates to it."""
    return apply_calibrator(calibrator, thresholds.withColumn("_raw", F.col(threshold_col)), "_raw", "calibrated_threshold").drop("_raw")
