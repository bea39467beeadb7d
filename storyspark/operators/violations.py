"""Rules as data: every validation yields (key, rule, field, message) rows; none means clean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "array<struct<rule:string,field:string,message:string>>"


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def rule(cond: Column, name, field, message) -> Column:
    """One possible violation of a row."""
    return F.when(F.coalesce(cond, F.lit(False)), F.struct(
        _col(name).cast("string").alias("rule"), _col(field).cast("string").alias("field"),
        _col(message).cast("string").alias("message")))


def each(array: Column, name: str, field) -> Column:
    """One violation per issue text in an array column, as an array."""
    return F.transform(array, lambda m: F.struct(
        F.lit(name).alias("rule"), _col(field).cast("string").alias("field"),
        m.cast("string").alias("message")))


def violations(df: DataFrame, key, rules=(), arrays=()) -> DataFrame:
    """Apply row rules (and arrays of violations) to a table."""
    parts = [F.array_compact(F.array(*rules)).cast(ROW)] if rules else []
    parts += [a.cast(ROW) for a in arrays]
    found = parts[0] if len(parts) == 1 else F.concat(*parts)
    return df.select(_col(key).cast("string").alias("key"), F.explode(found).alias("v")).select(
        "key", "v.rule", "v.field", "v.message")


def repeated(df: DataFrame, key, value, name: str, field: str, message: str) -> DataFrame:
    """A violation per value that occurs more than once under a key."""
    seen = df.groupBy(_col(key).cast("string").alias("key"), _col(value).cast("string").alias("_v")
                      ).agg(F.count("*").alias("_n"))
    return seen.filter((F.col("_n") > 1) & F.col("_v").isNotNull()).select(
        "key", F.lit(name).alias("rule"), F.lit(field).alias("field"),
        F.concat(F.lit(message), F.col("_v")).alias("message"))


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def error_categories(df: DataFrame, rules, message: str = "message", keys=()) -> DataFrame:
    """Counts per stable category of '; '-joined messages; first matching pattern wins (A10)."""
    part = F.col("_part")
    label = None
    for pattern, name in rules:
        label = (F.when(part.rlike(pattern), F.lit(name)) if label is None
                 else label.when(part.rlike(pattern), F.lit(name)))
    return (df.select(*keys, F.explode(F.split(message, "; ")).alias("_part"))
            .groupBy(*keys, label.otherwise(F.lit("unknown_mix_pool_error")).alias("category"))
            .agg(F.count("*").alias("n")))
