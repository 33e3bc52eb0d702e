"""Scalar column helpers (all built-in Spark expressions, codegen friendly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (used where results are compared across engines)."""
    return df.withColumns({f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
                           if isinstance(f.dataType, (DoubleType, FloatType))})


def lower_each(arr: Column) -> Column:
    """Lower-case each element of an array column."""
    return F.transform(arr, lambda x: F.lower(x))


def exists_like(arr: Column, patterns: tuple[str, ...]) -> Column:
    """True when any element matches any LIKE pattern (e.g. '%organic%')."""
    return F.exists(arr, lambda x: reduce(lambda a, b: a | b, [x.like(p) for p in patterns]))


def case_flag(cond: Column) -> Column:
    """0/1 integer flag from a boolean condition (null → 0)."""
    return F.when(cond, 1).otherwise(0).cast("int")


def ratio(num: Column, den: Column, percent: bool = False) -> Column:
    """num / den (null when den is 0), optionally × 100."""
    r = F.try_divide(num.cast("double"), den.cast("double"))
    return r * 100 if percent else r


def regex_ci(col: Column, pattern: str) -> Column:
    """Case-insensitive regular-expression containment."""
    return col.rlike("(?i)" + pattern)


def replace_first(col: Column, old: str = " ", new: str = "<br>") -> Column:
    """Replace the first occurrence of a literal single character / word."""
    import re
    return F.regexp_replace(col, "^(.*?)" + re.escape(old), "$1" + new.replace("$", "\\$"))


def bool_label(col: Column, true_label: str, false_label: str) -> Column:
    return F.when(col, F.lit(true_label)).when(~col, F.lit(false_label))


def fill_null_zero(df: DataFrame) -> DataFrame:
    """null → 0 over all numeric columns."""
    return df.na.fill(0)
