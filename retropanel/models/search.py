"""Search over parameter grids: independent fits side by side, settings that fall behind dropped early."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retropanel.models.metrics import compute_metrics
from retropanel.models.prepare import expanding_folds
from retropanel.session import materialize

Setting = Mapping[str, float]
#: Fits a setting with so many rounds (trees) on training rows.
Fit = Callable[[DataFrame, Setting, int], Model]


@dataclass(frozen=True)
class Outcome:
    """Where a setting got to: the rounds of its last rung, its mean fold error there, its place among all."""

    setting: Setting
    rounds: int
    rmse: float | None
    place: int


def fold_parts(rows: DataFrame, columns: Sequence[str], n_folds: int = 3) -> list[tuple[DataFrame, DataFrame]]:
    """(training, validation) rows of each expanding fold, over folds stored once.

    The blocks are a directory each, so a fold's reads touch the files of its own blocks only, and any number
    of fits may read them at the same time without holding executor memory.
    """
    folded = materialize(expanding_folds(rows, n_folds).select("block", *columns), partition_by="block")
    return [(folded.filter(F.col("block") < k), folded.filter(F.col("block") == k)) for k in range(1, n_folds + 1)]


def side_by_side(spark: SparkSession, tasks: Sequence[Callable[[], float | None]], parallelism: int, pool: str) -> list[float | None]:
    """Results of independent driver-side tasks, so many running at a time.

    Every thread submits its jobs to a scheduler pool of its own; a session with fair scheduling then shares
    the cluster evenly between them, and a failed fit stops the search.
    """

    def run(numbered: tuple[int, Callable[[], float | None]]) -> float | None:
        number, task = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{pool}-{number % parallelism}")
        try:
            return task()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    if not tasks:
        return []
    with ThreadPool(min(parallelism, len(tasks))) as threads:
        return threads.map(inheritable_thread_target(spark)(run), list(enumerate(tasks)), chunksize=1)


def fold_error(fit: Fit, setting: Setting, rounds: int, train: DataFrame, validation: DataFrame) -> float | None:
    scored = fit(train, setting, rounds).transform(validation)
    return compute_metrics(scored, "label", "prediction").first()["rmse"]


def rungs(rounds: int, n: int, keep: int, least: int) -> list[tuple[int, int]]:
    """(settings, rounds) of successive halving: the last rung has all the rounds, each one before it a
    ``keep``-th of them (``least`` at the least) for ``keep`` times as many settings."""
    steps = [rounds]
    while n > keep ** len(steps) and steps[0] // keep >= least:
        steps.insert(0, steps[0] // keep)
    return [(max(1, n // keep**i), r) for i, r in enumerate(steps)]


def successive_halving(
    folds: Sequence[tuple[DataFrame, DataFrame]],
    grid: Sequence[Setting],
    fit: Fit,
    rounds: int = 200,
    keep: int = 4,
    least: int = 10,
    parallelism: int = 8,
) -> list[Outcome]:
    """Every setting of the grid, best first.

    A rung fits the settings still in the race on all folds, fit by fit in parallel, and the best ``keep``-th
    go on with more rounds. Settings of a later rung rank before those dropped earlier; equal errors rank by
    the order of the grid. A setting without any error (no validation rows) ranks last in its rung.
    """
    spark = folds[0][0].sparkSession
    racing, dropped = list(range(len(grid))), []
    plan = rungs(rounds, len(grid), keep, least)
    outcome: dict[int, tuple[int, float | None]] = {}
    for step, (_, now) in enumerate(plan):
        tasks = [lambda s=s, t=t, v=v: fold_error(fit, grid[s], now, t, v) for s in racing for t, v in folds]
        errors = side_by_side(spark, tasks, parallelism, "grid")
        for i, s in enumerate(racing):
            known = [e for e in errors[i * len(folds) : (i + 1) * len(folds)] if e is not None]
            outcome[s] = (now, sum(known) / len(known) if known else None)
        racing.sort(key=lambda s: (outcome[s][1] is None, outcome[s][1] or 0.0, s))
        if step + 1 < len(plan):
            going = plan[step + 1][0]
            dropped, racing = racing[going:] + dropped, racing[:going]
    return [Outcome(grid[s], *outcome[s], place) for place, s in enumerate(racing + dropped, 1)]


def outcome_frame(spark: SparkSession, outcomes: Sequence[Outcome], names: Mapping[str, str]) -> DataFrame:
    """One row for each setting: its parameters under new names, rounds, rmse, place and ``best``."""
    rows = [(*(float(o.setting[n]) for n in names), o.rounds, o.rmse, o.place, o.place == 1) for o in outcomes]
    schema = ", ".join(f"{new} double" for new in names.values())
    return spark.createDataFrame(rows, f"{schema}, rounds int, rmse double, place int, best boolean")
