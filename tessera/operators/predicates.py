"""Row filters: equality, SQL text, bound parameters, AND/OR, membership
and its null-keeping complement, null tests, containment (literal or
regex) and LIKE.

All of them are Catalyst expressions: on a Parquet scan the simple ones
(equality, IN, IS NULL, startsWith) show up as ``PushedFilters``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast

# Lists longer than this become a semi/anti join against a value table.
INLINE_LIST_MAX = 1000


def quote_ident(name: str) -> str:
    """Back-quote a column name so names with spaces work in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def where_equal(df: DataFrame, col: str, value) -> DataFrame:
    """Boolean-mask equality; case-sensitive, nulls never match."""
    return df.filter(F.col(quote_ident(col)) == F.lit(value))


def where_sql(df: DataFrame, predicate: str) -> DataFrame:
    """Filter by a SQL predicate string (``"country = 'X'"``)."""
    return df.filter(predicate)


def where_bound(df: DataFrame, predicate: str, **params) -> DataFrame:
    """Filter by a SQL predicate with named parameters (``:name``); values are
    bound, never spliced into the text."""
    spark = df.sparkSession
    return spark.sql(f"SELECT * FROM {{src}} WHERE {predicate}", args=params, src=df)


def all_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a & b, conds)


def any_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds)


def _values_frame(df: DataFrame, values, col: str) -> DataFrame:
    spark = df.sparkSession
    dtype = df.schema[col].dataType
    if isinstance(values, DataFrame):
        v = values.select(quote_ident(values.columns[0])).distinct()
        return v.toDF("_v")
    return spark.createDataFrame([(x,) for x in dict.fromkeys(values)], f"_v {dtype.simpleString()}")


def _split_null(df: DataFrame, values) -> tuple:
    """(values without null, whether a null was among them)."""
    if isinstance(values, DataFrame):
        c = F.col(quote_ident(values.columns[0]))
        return values.filter(c.isNotNull()), not values.filter(c.isNull()).isEmpty()
    some = [x for x in values if x is not None]
    return some, len(some) < len(values)


def where_in(df: DataFrame, col: str, values) -> DataFrame:
    """Membership; a null is never a member.  A short Python list is an ``IN``
    expression (pushed to the scan); a long list or a DataFrame of values
    becomes a left-semi join (broadcast only behind a size check).  Length and
    container never change the answer."""
    values, _ = _split_null(df, values)
    c = F.col(quote_ident(col))
    if not isinstance(values, DataFrame) and len(values) <= INLINE_LIST_MAX:
        return df.filter(c.isin(values))
    v = checked_broadcast(_values_frame(df, values, col))
    return df.join(v, c == v["_v"], "left_semi")


def where_not_in(df: DataFrame, col: str, values, keep_nulls: bool = True) -> DataFrame:
    """Non-membership.  ``keep_nulls=True`` keeps rows whose value is null
    (the dataframe-library semantics: exact complement of ``where_in``);
    ``False`` is SQL ``NOT IN``: those rows go, and a null among the values
    leaves no row at all."""
    values, has_null = _split_null(df, values)
    c = F.col(quote_ident(col))
    if has_null and not keep_nulls:
        return df.filter(F.lit(False))
    if not isinstance(values, DataFrame) and len(values) <= INLINE_LIST_MAX:
        out = df.filter(~F.coalesce(c.isin(values), F.lit(False)))
    else:
        v = checked_broadcast(_values_frame(df, values, col))
        out = df.join(v, c == v["_v"], "left_anti")
    return out if keep_nulls else out.filter(c.isNotNull())


def where_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(quote_ident(col)).isNull())


def where_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(quote_ident(col)).isNotNull())


def contains_pattern(col, pattern: str, regex: bool = False) -> Column:
    """Unanchored, case-sensitive containment.  ``regex=True`` is the
    dataframe-library default (the pattern is a regular expression, so
    ``(Zone)`` is a group and ``.`` any character); the default here is
    literal."""
    c = F.col(quote_ident(col)) if isinstance(col, str) else col
    return c.rlike(pattern) if regex else F.contains(c, F.lit(pattern))


def where_contains(df: DataFrame, col: str, pattern: str, regex: bool = False) -> DataFrame:
    return df.filter(contains_pattern(col, pattern, regex))


def where_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """SQL LIKE (``%`` and ``_``); a prefix pattern pushes down as startsWith."""
    return df.filter(F.col(quote_ident(col)).like(pattern))
