"""K-fold evaluation of boosted trees as Spark jobs.

Folds are an arithmetic hash of the row key, so a row's fold depends on neither
partitioning nor row order. Metrics are exact and computed from score counts.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import quoted
from tallyloom.functions.scalars import name as col_name
from tallyloom.functions.scalars import ratio
from tallyloom.operators.boosting import BoostSettings, Task, Trained, binned, gains, predicted, trained
from tallyloom.operators.ordered import with_prefix_sum
from tallyloom.operators.schema import feature_columns, scrambled
from tallyloom.operators.staging import release, stage
from tallyloom.plans.names import ID_AND_LABEL


def fold_of(key: Column, folds: int, seed: int) -> Column:
    """Fold 0..folds-1 of an integer key."""
    return F.pmod(scrambled(key, seed), F.lit(folds)).cast("int")


def assign_folds(df: DataFrame, key: str, folds: int = 5, seed: int = 1001, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_of(quoted(key), folds, seed))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half.

    Rows collapse to counts per distinct score first. A group without both labels
    gets NULL.
    """
    by = list(by)
    known = df.filter(quoted(label).isNotNull() & quoted(score).isNotNull())
    points = stage(
        known.groupBy(*by, quoted(score).cast("double").alias("__score")).agg(
            F.count_if(quoted(label) == 1).alias("__pos"),
            F.count_if(quoted(label) == 0).alias("__neg"),
        )
    )
    ranked = with_prefix_sum(points, "__score", "__neg", "__below", by)
    won = "sum(double(__pos) * (double(__below) + double(__neg) / 2))"
    return ranked.groupBy(*by).agg(
        F.expr(ratio(won, "(sum(double(__pos)) * sum(double(__neg)))")).alias("auc"),
        F.sum("__pos").alias("positives"),
        F.sum("__neg").alias("negatives"),
    )


def mean_by_key(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(quoted(value).cast("double")).alias(name))


@dataclass
class Evaluation:
    out_of_fold: DataFrame  # key, label, fold, prediction
    scored: DataFrame  # key, fold, prediction for unlabelled rows
    importances: DataFrame  # feature, importance (total gain), fold
    valid_auc: DataFrame  # fold, auc, ...
    train_auc: DataFrame
    overall_auc: DataFrame
    features: list[str] = field(default_factory=list)
    models: list[Trained] = field(default_factory=list)

    def predictions(self, key: str) -> DataFrame:
        """Fold-averaged prediction per unlabelled row."""
        return mean_by_key(self.scored, key, "prediction", "TARGET")


_IMPORTANCE = "feature string, importance double, fold int"


def evaluate_choices(
    df: DataFrame,
    choices: Mapping[str, Sequence[str]],
    key: str = "SK_ID_CURR",
    label: str = "TARGET",
    folds: int = 5,
    seed: int = 1001,
    settings: BoostSettings | None = None,
) -> dict[str, Evaluation]:
    """K-fold evaluation for each choice of feature columns, over one table of binned rows.

    Every fold of every choice is a model; all train together and each stops by the AUC of its held-out fold. Rows with
    a label are trained on and judged, rows without one are scored by all models of the choice, all in one scan.
    """
    s = settings or BoostSettings()
    features = list(dict.fromkeys(c for chosen in choices.values() for c in chosen))
    place = {c: i for i, c in enumerate(features)}
    table = stage(binned(assign_folds(df, key, folds, seed), key, label, "fold", features, s.bins))
    tasks = [Task(name, fold, tuple(place[c] for c in chosen)) for name, chosen in choices.items() for fold in range(folds)]
    models = trained(table, tasks, len(features), s, auc)
    judged = stage(predicted(table, models, len(features), s))
    release(table)
    known = judged.where("label IS NOT NULL")
    by_fold = stage(auc(known, "label", "prediction", ["model", "held_out"]))
    by_choice = stage(auc(known.where("held_out").withColumn("choice", F.expr(f"model div {folds}")), "label", "prediction", ["choice"]))
    out = {}
    for number, (name, chosen) in enumerate(choices.items()):
        first = number * folds
        mine = judged.where(f"model BETWEEN {first} AND {first + folds - 1}").withColumn("fold", F.expr(f"model - {first - 1}"))
        valid = mine.where("held_out").selectExpr(f"__key AS {col_name(key)}", f"label AS {col_name(label)}", "fold", "prediction")
        areas = by_fold.where(f"model BETWEEN {first} AND {first + folds - 1}").selectExpr(f"model - {first - 1} AS fold", "held_out", "auc", "positives", "negatives")
        rows = [(feature, gain, fold + 1) for fold in range(folds) for feature, gain in gains(models[first + fold], features)]
        out[name] = Evaluation(
            out_of_fold=valid,
            scored=mine.where("label IS NULL").selectExpr(f"__key AS {col_name(key)}", "fold", "prediction"),
            importances=df.sparkSession.createDataFrame(rows, _IMPORTANCE),
            valid_auc=areas.where("held_out").drop("held_out"),
            train_auc=areas.where("NOT held_out").drop("held_out"),
            # one row, also without any labelled rows
            overall_auc=by_choice.where(f"choice = {number}").agg(*[F.first(c).alias(c) for c in ("auc", "positives", "negatives")]),
            features=list(chosen),
            models=models[first : first + folds],
        )
    return out


def kfold_boosted_trees(
    df: DataFrame,
    key: str = "SK_ID_CURR",
    label: str = "TARGET",
    folds: int = 5,
    seed: int = 1001,
    settings: BoostSettings | None = None,
    features: Sequence[str] | None = None,
) -> Evaluation:
    """One model per fold, trained on the other folds; see ``evaluate_choices``."""
    chosen = list(features or feature_columns(df, {*ID_AND_LABEL, key, label}))
    return evaluate_choices(df, {"all": chosen}, key, label, folds, seed, settings)["all"]


def leading_features(importances: DataFrame, n: int = 40) -> DataFrame:
    """All fold rows of the ``n`` features with the largest mean importance."""
    ranked = importances.groupBy("feature").agg(F.avg("importance").alias("__mean"))
    top = ranked.orderBy(F.desc("__mean"), "feature").limit(n).select("feature")
    return importances.join(F.broadcast(top), "feature", "left_semi")  # n rows


def choice_features(
    base: DataFrame, families: Mapping[str, DataFrame], choices: Iterable[tuple[str, Sequence[str]]], combine, excluded: Collection[str] = ID_AND_LABEL
) -> dict[str, list[str]]:
    """The feature columns that each family choice has by itself; only schemas are looked at."""
    return {name: feature_columns(combine(base, {f: families[f] for f in chosen}), excluded) for name, chosen in choices}


def ablation(
    base: DataFrame,
    families: Mapping[str, DataFrame],
    choices: Iterable[tuple[str, Sequence[str]]],
    combine,
    **kfold_options,
) -> dict[str, Evaluation]:
    """An evaluation per family choice, all over one table with the columns of every choice."""
    choices = [(name, tuple(chosen)) for name, chosen in choices]
    needed = {f for _, chosen in choices for f in chosen}
    table = stage(combine(base, {f: t for f, t in families.items() if f in needed}))  # read for the cut points, then for the bins
    results = evaluate_choices(table, choice_features(base, families, choices, combine), **kfold_options)
    release(table)
    return results


def ablation_report(results: Mapping[str, Evaluation]) -> DataFrame:
    """families, fold, features, valid_auc, train_auc, overall_auc for each choice and fold."""
    parts = []
    for name, result in results.items():
        valid = result.valid_auc.selectExpr("fold", "auc AS valid_auc")
        train = result.train_auc.selectExpr("fold", "auc AS train_auc")
        whole = result.overall_auc.selectExpr("auc AS overall_auc")  # one row
        named = F.lit(name).alias("families"), "fold", F.lit(len(result.features)).alias("features"), "valid_auc", "train_auc", "overall_auc"
        parts.append(valid.join(train, "fold").join(F.broadcast(whole)).select(*named))
    return reduce(DataFrame.unionByName, parts)
