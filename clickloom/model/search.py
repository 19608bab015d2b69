"""Hyperparameter search: seeded draws, a few trials side by side, best by AUC."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, functions as F

from clickloom.model.training import Settings, evaluate, train_deepfm


def draw_trials(
    trials: int, lr_range: tuple[float, float], dropouts: Sequence[float], seed: int
) -> list[dict]:
    """Learning rate log-uniform in its range, dropout rate from a list."""
    rng = np.random.default_rng(seed)
    low, high = np.log(lr_range[0]), np.log(lr_range[1])
    return [
        {
            "trial_id": i + 1,
            "lr": float(np.exp(rng.uniform(low, high))),
            "dropout_rate": float(rng.choice(list(dropouts))),
        }
        for i in range(trials)
    ]


def search(
    train: DataFrame,
    valid: DataFrame,
    vocab: DataFrame,
    slots: Sequence[str],
    dense: Sequence[str],
    key: str,
    settings: Settings,
    lr_range: tuple[float, float] = (0.001, 0.01),
    dropouts: Sequence[float] = (0.4, 0.5, 0.6),
    trials: int = 4,
    parallel: int = 2,
    seed: int = 0,
) -> DataFrame:
    """Trial table `(trial_id, lr, dropout_rate, auc)`; trials share the cluster as jobs."""

    def run(trial: dict) -> tuple:
        chosen = replace(settings, lr=trial["lr"], dropout=trial["dropout_rate"])
        model, _ = train_deepfm(train, vocab, slots, dense, key, chosen)
        return (*trial.values(), evaluate(valid, model, key, chosen))

    with ThreadPoolExecutor(parallel) as pool:
        rows = list(pool.map(run, draw_trials(trials, lr_range, dropouts, seed)))
    return train.sparkSession.createDataFrame(
        rows, "trial_id int, lr double, dropout_rate double, auc double"
    )


def best_trial(trials: DataFrame) -> DataFrame:
    return trials.orderBy(F.desc("auc"), "trial_id").limit(1)
