"""Forecasts for all departments at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retropanel import settings as S
from retropanel.functions import expr as E
from retropanel.models.prepare import Prepared, impute
from retropanel.models.trees import flat_trees
from retropanel.session import materialize

BAND = 1.96
HISTORY = 24
TARGET = "nb_installations_pac"
SECOND = "nb_dpe_classe_ab"


def with_band(df: DataFrame, rmse: float, digits: int) -> DataFrame:
    """95% band around the prediction from the test error, never below 0."""
    p, margin = F.col("prediction"), F.lit(BAND * rmse)
    return df.withColumns(
        {
            "lower": E.half_even(F.greatest(p - margin, F.lit(0.0)), digits),
            "upper": E.half_even(p + margin, digits),
            "prediction": E.half_even(p, digits),
        }
    )


def advance_calendar(df: DataFrame, first_year: Column | None = None) -> DataFrame:
    """Calendar features of the row's own month, as in training."""
    plan = E.calendar_columns()
    if first_year is not None:
        plan["year_trend"] = E.year_of("date_id") - first_year
    return df.withColumns(plan)


def seasonal_profile(df: DataFrame, column: str) -> DataFrame:
    """Month means of each department, and the scale of its last twelve months against all."""
    w = Window.partitionBy("dept").orderBy(F.col("date_id").desc())
    recent = df.withColumn("_r", F.row_number().over(w))
    scale = recent.groupBy("dept").agg(
        F.avg(column).alias("overall"), F.avg(F.when(F.col("_r") <= 12, F.col(column))).alias("recent")
    )
    months = df.groupBy("dept", "month").agg(F.avg(column).alias("month_mean"))
    factor = F.when(F.col("overall") > 0, F.col("recent") / F.col("overall")).otherwise(1.0)
    return months.join(scale, "dept").withColumn("scale", factor)


def future_rows(df: DataFrame, horizon: int) -> DataFrame:
    """``horizon`` months after each department's last one, carrying its last row's values."""
    last = df.groupBy("dept").agg(F.max_by(F.struct(*df.columns), "date_id").alias("r")).select("r.*")
    steps = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn("date_id", E.shift_month("date_id", F.col("step")))


def seasonal_features(features: DataFrame, names: Sequence[str], horizon: int) -> DataFrame:
    """Input rows of the seasonal-proxy forecast for every department and future month.

    Future counts in the lag windows are proxies (month mean times recent scale), not predictions, so
    no recursion is needed: history and proxies form one series, windows end one month before the row.
    """
    first_year = features.agg(F.min("year")).scalar()
    rows = advance_calendar(future_rows(features, horizon), first_year if "year_trend" in names else None)
    weather = [n for n in names if any(k in n.lower() for k in S.SEASONAL_WORDS)]
    if weather:
        usual = features.groupBy("dept", "month").agg(*[F.avg(n).alias(f"_u_{n}") for n in weather])
        rows = rows.join(usual, ["dept", "month"], "left").withColumns(
            {n: F.coalesce(f"_u_{n}", n) for n in weather}
        ).drop(*[f"_u_{n}" for n in weather])
    for target in (TARGET, SECOND):
        if target in features.columns:
            rows = _proxy_windows(features, rows, target, names)
    return rows


def _proxy_windows(features: DataFrame, rows: DataFrame, target: str, names: Sequence[str]) -> DataFrame:
    profile = seasonal_profile(features, target)
    value = F.coalesce("month_mean", "overall") * F.col("scale")
    scale = profile.select("dept", "overall", "scale").distinct()
    proxy = (
        rows.select("dept", "date_id", "month", "step")
        .join(profile.select("dept", "month", "month_mean"), ["dept", "month"], "left")
        .join(scale, "dept")
        .select("dept", "date_id", "step", value.alias("v"))
    )
    back = Window.partitionBy("dept").orderBy(F.col("date_id").desc())
    past = (
        features.withColumn("_r", F.row_number().over(back))
        .filter(F.col("_r") <= HISTORY)
        .select("dept", "date_id", F.lit(0).alias("step"), F.col(target).cast("double").alias("v"))
    )
    w = Window.partitionBy("dept").orderBy("date_id")
    prev, prev2 = F.lag("v", 1).over(w), F.lag("v", 2).over(w)
    plan: dict[str, Column] = {f"{target}_lag_{k}m": F.lag("v", k).over(w) for k in (1, 3, 6, 12)}
    for k in (3, 6):
        frame = w.rowsBetween(-k, -1)
        plan[f"{target}_rmean_{k}m"] = F.avg("v").over(frame)
        plan[f"{target}_rstd_{k}m"] = F.when(
            F.count("v").over(frame) >= 2, F.stddev_pop("v").over(frame)
        ).otherwise(0.0)
    if target == TARGET:
        plan[f"{target}_diff_1m"] = prev - prev2
        pct = F.when(prev2 > 0, (prev - prev2) / prev2 * 100.0).otherwise(0.0)
        plan[f"{target}_pct_1m"] = E.clip(pct, -200.0, 500.0)
    wanted = {n: c for n, c in plan.items() if n in names}
    if not wanted:
        return rows
    derived = (
        past.unionByName(proxy)
        .withColumns({f"_d_{n}": c for n, c in wanted.items()})
        .filter("step > 0")
        .select("dept", "date_id", *[f"_d_{n}" for n in wanted])
    )
    joined = rows.join(derived, ["dept", "date_id"])
    return joined.withColumns({n: F.coalesce(f"_d_{n}", n) for n in wanted}).drop(*[f"_d_{n}" for n in wanted])


def forecast_seasonal(features: DataFrame, prep: Prepared, model, horizon: int, rmse: float) -> DataFrame:
    """Seasonal-proxy forecast: departments x horizon rows, scored in one transform."""
    rows = prep.transform(seasonal_features(features, prep.features, horizon))
    scored = model.transform(rows).select(
        "dept", "date_id", "step", E.non_negative("prediction").alias("prediction")
    )
    return with_band(scored, rmse, 1)


def forecast_recursive(
    features: DataFrame,
    prep: Prepared,
    model,
    horizon: int,
    rmse: float,
    overrides: Mapping[str, float] | None = None,
) -> DataFrame:
    """Forecast that feeds each prediction back as the one-month lag.

    A linear model or an ensemble of trees walks each department's horizon inside one task, all departments in
    one job; any other model scores all departments of a step at once, step after step.
    """
    names = list(prep.features)
    if hasattr(model, "coefficients"):
        coef = np.array(model.coefficients, dtype=float)
        intercept = float(model.intercept)
        center = np.array(prep.scaler.median, dtype=float)
        spread = np.array(prep.scaler.range, dtype=float)
        weight = np.divide(coef, spread, out=np.zeros_like(coef), where=spread != 0)
        score = lambda row: float((row - center) @ weight + intercept)
    elif hasattr(model, "trees"):
        trees = features.sparkSession.sparkContext.broadcast(flat_trees(model))  # at most 2^depth nodes a tree
        score = lambda row: float(trees.value.predict(row[None, :])[0])
    else:
        return _recursive_steps(features, prep, model, horizon, rmse, overrides)
    fixed = {k: float(v) for k, v in (overrides or {}).items() if k in names}
    lag = f"{TARGET}_lag_1m"

    first_year = features.agg(F.min("year")).scalar()
    steps = advance_calendar(
        future_rows(features, horizon), first_year if "year_trend" in names else None
    )
    ready = impute(steps, prep.medians)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("step")
        x = pdf[names].to_numpy(dtype=float)
        for name, value in fixed.items():
            x[:, names.index(name)] = value
        out = np.empty(len(x))
        for i in range(len(x)):
            if i and lag in names and lag not in fixed:
                x[i, names.index(lag)] = out[i - 1]
            out[i] = max(score(x[i]), 0.0)
        return pd.DataFrame(
            {
                "dept": pdf["dept"],
                "date_id": pdf["date_id"],
                "step": pdf["step"],
                "prediction": out,
            }
        )

    walked = ready.select("dept", "date_id", "step", *names).groupBy("dept").applyInPandas(
        walk, "dept string, date_id int, step int, prediction double"
    )
    return with_band(walked, rmse, 2)



def _recursive_steps(
    features: DataFrame, prep: Prepared, model, horizon: int, rmse: float, overrides: Mapping[str, float] | None
) -> DataFrame:
    """One transform per future month; a month's predictions are stored, as the next one joins them."""
    lag = f"{TARGET}_lag_1m"
    fixed = {k: F.lit(float(v)) for k, v in (overrides or {}).items() if k in prep.features}
    first_year = features.agg(F.min("year")).scalar() if "year_trend" in prep.features else None
    steps = materialize(advance_calendar(future_rows(features, horizon), first_year).withColumns(fixed))
    out = before = None
    for step in range(1, horizon + 1):
        rows = steps.filter(F.col("step") == step)
        if before is not None and lag in prep.features and lag not in fixed:
            rows = rows.drop(lag).join(before.select("dept", F.col("prediction").alias(lag)), "dept", "left")
        scored = model.transform(prep.transform(rows)).select("dept", "date_id", "step", E.non_negative("prediction").alias("prediction"))
        before = materialize(scored)
        out = before if out is None else out.unionByName(before)
    return with_band(out, rmse, 2)
