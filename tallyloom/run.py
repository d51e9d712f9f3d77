"""End-to-end runs: read tables, build features, evaluate, write predictions and importances.

``python -m tallyloom.run --input FOLDER --output FOLDER [--families bureau,cc] [--rows N]``
``python -m tallyloom.run --input FOLDER --output FOLDER --ablation | --first-version``
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators.evaluate import BoostSettings, Evaluation, ablation, kfold_boosted_trees, leading_features
from tallyloom.operators.schema import append_unlabelled
from tallyloom.operators.staging import remove_written, stage
from tallyloom.plans import assembly
from tallyloom.plans.first_version import first_version_tables
from tallyloom.sources.tables import read_tables, write_importances, write_predictions

KEY = "SK_ID_CURR"


def _fold_scores(table: DataFrame) -> list[float]:
    # one row per fold
    return [r.auc for r in table.orderBy("fold").collect()]


def report(result: Evaluation, folder: str, name: str) -> dict:
    """Write one run's files under ``folder/name`` and return its AUC figures."""
    base = f"{folder.rstrip('/')}/{name}"
    write_predictions(result.predictions(KEY), f"{base}/predictions")
    write_importances(
        result.importances,
        leading_features(result.importances),
        f"{base}/feature_importance",
        f"{base}/best_features",
    )
    return {
        "run": name,
        "features": len(result.features),
        "valid_auc": _fold_scores(result.valid_auc),
        "train_auc": _fold_scores(result.train_auc),
        "overall_auc": result.overall_auc.first().auc,
    }


def run_family_choices(
    spark: SparkSession,
    source: str,
    target: str,
    choices: Iterable[tuple[str, Collection[str]]],
    rows: int | None = None,
    format: str = "csv",
    settings: BoostSettings | None = None,
    folds: int = 5,
) -> list[dict]:
    """One evaluation per family choice, all over one feature table."""
    choices = [(name, tuple(families)) for name, families in choices]
    tables = read_tables(spark, source, rows, format)
    base = stage(assembly.base_table(tables))
    needed = {f for _, families in choices for f in families}
    built = {f: stage(t) for f, t in assembly.family_tables(tables, needed).items()}
    results = ablation(base, built, choices, assembly.assemble, folds=folds, settings=settings)
    return [report(result, target, name) for name, result in results.items()]


def run_first_version(
    spark: SparkSession,
    source: str,
    target: str,
    format: str = "csv",
    settings: BoostSettings | None = None,
    folds: int = 5,
) -> dict:
    train, test = first_version_tables(read_tables(spark, source, None, format))
    result = kfold_boosted_trees(
        append_unlabelled(train, test), KEY, folds=folds, seed=50, settings=settings
    )
    return report(result, target, "first_version")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--families", default=",".join(assembly.FAMILIES))
    parser.add_argument("--rows", type=int, default=None, help="first rows per table, for a trial run")
    parser.add_argument("--rounds", type=int, default=BoostSettings.rounds)
    parser.add_argument("--patience", type=int, default=BoostSettings.patience, help="rounds without a better held-out AUC that end a model")
    parser.add_argument("--ablation", action="store_true")
    parser.add_argument("--first-version", action="store_true")
    args = parser.parse_args()
    chosen_families = args.families != ",".join(assembly.FAMILIES)
    if args.first_version and (args.rows is not None or chosen_families or args.ablation):
        parser.error("--first-version uses whole tables and families of its own: no --rows, --families or --ablation")
    if args.ablation and chosen_families:
        parser.error("--ablation chooses the families itself: no --families")
    spark = SparkSession.builder.appName("tallyloom").getOrCreate()
    settings = BoostSettings(rounds=args.rounds, patience=args.patience)
    if args.first_version:
        reports = [run_first_version(spark, args.input, args.output, args.format, settings)]
    else:
        chosen = tuple(f for f in args.families.split(",") if f)
        choices = assembly.ablation_choices() if args.ablation else [("run", chosen)]
        reports = run_family_choices(
            spark, args.input, args.output, choices, args.rows, args.format, settings
        )
    remove_written(spark)
    for line in reports:
        print(json.dumps(line))


if __name__ == "__main__":
    main()
