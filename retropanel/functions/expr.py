"""Column expressions. All stay inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retropanel import settings as S

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- schema helpers (plan time only) -------------------------------------------------------


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def first_present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    return next((n for n in candidates if n in df.columns), None)


def missing(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric fields, without the excluded ones and without ``_`` flag columns."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip and f.name[0] != "_"
    ]


def rename_absent(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename source headers whose target name is not taken yet."""
    todo = {old: new for old, new in aliases.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(todo)


# --- numbers -------------------------------------------------------------------------------


def half_even(c: ColumnLike, digits: int = 0) -> Column:
    """Round half to even by scaling, as array libraries do; cheaper than decimal rounding."""
    scale = float(10**digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def clip(c: ColumnLike, low: float | Column | None, high: float | Column | None) -> Column:
    """Limit to bounds; NULL stays NULL (``greatest`` would replace it)."""
    c = col(c)
    out = F
    if low is not None:
        out = out.when(c < low, F.lit(low) if not isinstance(low, Column) else low)
    if high is not None:
        out = out.when(c > high, F.lit(high) if not isinstance(high, Column) else high)
    return out.otherwise(c) if out is not F else c


def outside(c: ColumnLike, low: float, high: float) -> Column:
    """True where a present value breaks the bounds."""
    return F.coalesce((col(c) < low) | (col(c) > high), F.lit(False))


def non_negative(c: ColumnLike) -> Column:
    return F.greatest(col(c), F.lit(0.0))


def at_least_one(c: ColumnLike) -> Column:
    return F.greatest(col(c), F.lit(1))


def percentage(part: ColumnLike, total: ColumnLike, digits: int = 2) -> Column:
    return half_even(F.lit(100.0) * col(part) / at_least_one(total), digits)


def per_thousand(part: ColumnLike, stock: ColumnLike) -> Column:
    return half_even(col(part) / at_least_one(stock) * F.lit(1000.0), 4)


def to_number(c: ColumnLike) -> Column:
    return col(c).try_cast("double")


def round_doubles(df: DataFrame, digits: int = 2) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({n: half_even(n, digits) for n in names})


def trim_strings(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: F.trim(n) for n in names})


# --- periods -------------------------------------------------------------------------------


def parse_date(c: ColumnLike) -> Column:
    """Date, or NULL where the text is none (a plain cast raises under ANSI mode)."""
    return col(c).try_cast("date")


def date_id(c: ColumnLike) -> Column:
    return (F.year(col(c)) * 100 + F.month(col(c))).cast("int")


def is_monthly(c: ColumnLike) -> Column:
    return F.coalesce(col(c).rlike(S.MONTHLY_PERIOD), F.lit(False))


def period_to_id(c: ColumnLike) -> Column:
    """``YYYY-MM`` or ``YYYY-MM-DD`` to ``YYYYMM``."""
    return F.replace(F.substring(col(c).cast("string"), 1, 7), F.lit("-"), F.lit("")).try_cast("int")


def year_of(c: ColumnLike) -> Column:
    return F.floor(col(c) / 100).cast("int")


def month_of(c: ColumnLike) -> Column:
    return (col(c) % 100).cast("int")


def quarter_of(month: ColumnLike) -> Column:
    return (F.floor((col(month) - 1) / 3) + 1).cast("int")


def id_to_date(c: ColumnLike) -> Column:
    return F.make_date(year_of(c), month_of(c), F.lit(1))


def shift_month(c: ColumnLike, offset: ColumnLike | int) -> Column:
    """Move a ``YYYYMM`` key by whole months."""
    step = F.lit(offset) if isinstance(offset, int) else col(offset)
    total = year_of(c) * 12 + month_of(c) - 1 + step
    return (F.floor(total / 12) * 100 + total % 12 + 1).cast("int")


def id_label(c: ColumnLike) -> Column:
    return F.format_string("%04d-%02d", year_of(c), month_of(c))


def is_heating(month: ColumnLike) -> Column:
    return col(month).isin(*S.HEATING_MONTHS).cast("int")


def is_cooling(month: ColumnLike) -> Column:
    return col(month).isin(*S.COOLING_MONTHS).cast("int")


def month_sin(month: ColumnLike) -> Column:
    return half_even(F.sin(F.lit(2 * math.pi) * col(month) / 12.0), 4)


def month_cos(month: ColumnLike) -> Column:
    return half_even(F.cos(F.lit(2 * math.pi) * col(month) / 12.0), 4)


def season(month: ColumnLike) -> Column:
    m = col(month)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )


def calendar_columns(date_key: str = "date_id") -> dict[str, Column]:
    month = month_of(date_key)
    return {
        "year": year_of(date_key),
        "month": month,
        "quarter": quarter_of(month),
        "is_heating": is_heating(month),
        "is_cooling": is_cooling(month),
        "month_sin": month_sin(month),
        "month_cos": month_cos(month),
    }


# --- codes, texts and classes --------------------------------------------------------------


def pad_code(c: ColumnLike, width: int = 2) -> Column:
    """Trim and left-pad with zeros; longer codes are kept whole (``lpad`` would cut them)."""
    text = F.trim(col(c).cast("string"))
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def known_code(name: str, codes: Sequence[str], width: int = 2) -> Column:
    """True where the padded code is in a fixed list (one hashed ``IN`` set)."""
    text = f"trim(cast({name} as string))"
    padded = f"if(length({text}) < {width}, lpad({text}, {width}, '0'), {text})"
    listed = ", ".join("'" + c.replace("'", "''") + "'" for c in codes)
    return F.expr(f"coalesce({padded} in ({listed}), false)")


def is_heat_pump(*texts: ColumnLike, pattern: str = S.HEAT_PUMP_PATTERN) -> Column:
    hit = F.lit(False)
    for text in texts:
        hit = hit | F.coalesce(col(text), F.lit("")).rlike(pattern)
    return hit.cast("int")


def has_text(c: ColumnLike) -> Column:
    return (F.length(F.coalesce(col(c), F.lit(""))) > 0).cast("int")


def in_set(c: ColumnLike, values: Sequence[str]) -> Column:
    return F.coalesce(col(c).isin(*values), F.lit(False)).cast("int")


def heating_degrees(t: ColumnLike, base: float = S.DEGREE_DAY_BASE) -> Column:
    return F.when(col(t).isNotNull(), F.greatest(F.lit(0.0), F.lit(base) - col(t)))


def cooling_degrees(t: ColumnLike, base: float = S.DEGREE_DAY_BASE) -> Column:
    return F.when(col(t).isNotNull(), F.greatest(F.lit(0.0), col(t) - F.lit(base)))


def above(c: ColumnLike, threshold: float) -> Column:
    return F.coalesce((col(c) > threshold).cast("int"), F.lit(0))


def below(c: ColumnLike, threshold: float) -> Column:
    return F.coalesce((col(c) < threshold).cast("int"), F.lit(0))


def terrain(altitude: ColumnLike, mountain_pct: ColumnLike, density: ColumnLike) -> Column:
    alt, mountain, dens = col(altitude), col(mountain_pct), col(density)
    return (
        F.when((alt > 800) | (mountain > 50), "MOUNTAIN")
        .when((mountain > 15) | (alt > 400), "SEMI-MOUNTAIN")
        .when(dens > 500, "URBAN")
        .otherwise("LOWLAND")
    )


def viability_band(cop: ColumnLike) -> Column:
    return F.when(col(cop) < 3.0, "LOW").when(col(cop) < 4.0, "MODERATE").otherwise("HIGH")


def severity_band(null_pct: ColumnLike) -> Column:
    p = col(null_pct)
    return (
        F.when(p > 50, "CRITICAL").when(p > 5, "WARNING").when(p > 0, "OK").otherwise("CLEAN")
    )


def freshness_band(age_days: ColumnLike) -> Column:
    a = col(age_days)
    return F.when(a <= 30, "UP TO DATE").when(a <= 90, "AGING").otherwise("STALE")


def gap_band(gap_pct: ColumnLike) -> Column:
    g = col(gap_pct)
    return F.when(g < 5, "HEALTHY").when(g < 15, "MODERATE").otherwise("OVERFITTING RISK")


def pattern_class(c: ColumnLike, patterns: Mapping[str, Sequence[str]], default: str) -> Column:
    """First class one of whose substrings occurs in the lower-cased text."""
    text = F.lower(col(c))
    out = F
    for label, words in patterns.items():
        hit = text.contains(words[0])
        for w in words[1:]:
            hit = hit | text.contains(w)
        out = out.when(hit, label)
    return out.otherwise(default)


def code_label(code: ColumnLike, name: ColumnLike) -> Column:
    return F.concat_ws(" — ", col(code), F.coalesce(col(name), col(code)))


# --- changes -------------------------------------------------------------------------------


def percent_change(current: ColumnLike, previous: ColumnLike) -> Column:
    """Change in percent; unlimited growth from zero is +infinity, zero from zero is NULL."""
    cur, prev = col(current).cast("double"), col(previous).cast("double")
    return (
        F.when((prev == 0) & (cur > 0), F.lit(float("inf")))
        .when((prev == 0) & (cur < 0), F.lit(float("-inf")))
        .when(prev != 0, (cur / prev - F.lit(1.0)) * F.lit(100.0))
    )


def fingerprint(columns: Sequence[str]) -> Column:
    """Order-free content hash to aggregate over: equal row sets give equal values."""
    return F.bit_xor(F.xxhash64(*columns))
