"""Joins that say what must hold: null keys that match, right sides that are unique, rows that all
find a partner, and checks of one table against another. Checks are aggregates of one pass; those
that raise do so in the plan, when the result is used, and nothing is collected for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(df: DataFrame, other: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """other's distinct keys under other names, and the condition that they equal df's, nulls too."""
    side = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    on = F.lit(True)
    for i, k in enumerate(keys):
        on &= df[k].eqNullSafe(side[f"_k{i}"])
    return side, on


def having(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of df whose keys other has; null equals null."""
    return df.join(*_same(df, other, keys), "left_semi")


def lacking(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of df whose keys other lacks; null equals null."""
    return df.join(*_same(df, other, keys), "left_anti")


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """df, whose keys are there once each; a key with several rows raises when the result is used. Rows
    are counted within their key as they lie for a join by it."""
    text = F.concat(F.lit(f"several rows for a key of {', '.join(keys)}: "), F.to_json(F.struct(*keys)))
    counted = df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    return counted.filter(F.when(F.col("_n") > 1, F.raise_error(text).cast("boolean")).otherwise(True)).drop("_n")


def many_to_one(df: DataFrame, other: DataFrame, keys: list[str], required: bool = False) -> DataFrame:
    """df with other's columns; other must have each key once. With `required`, a row of df without
    a partner raises when the result is used. Null keys match null keys."""
    side = unique(other, keys)
    rest = [c for c in other.columns if c not in keys]
    side = side.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *rest, F.lit(True).alias("_met"))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on &= df[k].eqNullSafe(side[f"_k{i}"])
    out = df.join(side, on, "left")
    if required:
        text = F.concat(F.lit("no partner for "), F.to_json(F.struct(*[df[k] for k in keys])))
        out = out.filter(F.when(F.col("_met"), True).otherwise(F.raise_error(text).cast("boolean")))
    return out.drop("_met", *[f"_k{i}" for i in range(len(keys))])


def sample_scope(df: DataFrame, scope: DataFrame, unit: str) -> DataFrame:
    """df with eligibility, status and reason of its unit. scope: (unit, is_eligible, scope_status,
    scope_reason), once for each unit. A missing or unknown unit is to be reviewed."""
    known = scope.filter(F.col(unit).isNotNull()).select(unit, "is_eligible", "scope_status", "scope_reason", F.lit(True).alias("_known"))
    out = many_to_one(df, known, [unit])
    missing, unknown = F.col(unit).isNull(), F.col("_known").isNull()
    # Codes of samples without a unit, or with one that the reference lacks.
    status = F.when(missing, "review_missing_sample_uf").when(unknown, "review_unmapped_uf").otherwise(F.col("scope_status"))
    reason = F.when(missing, "missing_sample_uf").when(unknown, "uf_absent_from_consores_structure").otherwise(F.col("scope_reason"))
    return out.withColumns({"is_eligible": F.coalesce("is_eligible", F.lit(False)), "scope_status": status, "scope_reason": reason}).drop("_known")


def exposure_disagreements(exposure: DataFrame, scope: DataFrame, unit: str, columns: list[str], expected: Column) -> DataFrame:
    """One row: exposures whose unit the scope lacks, whose columns differ from the scope's (a null
    on either side differs), and whose unit's eligibility isn't what `expected` says."""
    side = unique(scope, [unit]).select(F.col(unit).alias("_unit"), *[F.col(c).alias(f"_{c}") for c in columns], "is_eligible")
    joined = exposure.join(side, exposure[unit].eqNullSafe(side["_unit"]), "left")
    absent, differs = F.col("is_eligible").isNull(), F.lit(False)
    for c in columns:
        differs |= ~F.coalesce(exposure[c] == F.col(f"_{c}"), F.lit(False))
    return joined.agg(
        F.count_if(absent).alias("n_absent"),
        F.count_if(~absent & differs).alias("n_mismatched"),
        F.count_if(~absent & (F.col("is_eligible") != F.coalesce(expected, F.lit(False)))).alias("n_wrong_eligibility"),
    )


def annual_exposure(exposure: DataFrame, kept: Column) -> DataFrame:
    """(calendar_year, hospital_nights): summed exposures of a context."""
    return exposure.filter(kept).groupBy("calendar_year").agg(F.sum("exposure_value").cast("int").alias("hospital_nights"))


def inherit_panel(panel: DataFrame, species: DataFrame, key: str, model: str) -> DataFrame:
    """panel with what the model species has for each of the species that it doesn't list: a join by
    the model's name, so neither side must be small. A panel without the model raises when a species
    needs it."""
    others = lacking(species.select(key).distinct(), panel, [key]).withColumn("_model", F.lit(model))
    own = panel.select(F.col(key).alias("_own"), *[c for c in panel.columns if c != key])
    joined = others.join(own, F.col("_model").cast(panel.schema[key].dataType) == F.col("_own"), "left")
    text = F.lit(f"the panel has no {key} {model}")
    joined = joined.filter(F.when(F.col("_own").isNull(), F.raise_error(text).cast("boolean")).otherwise(True))
    return panel.unionByName(joined.drop("_model", "_own"))


def missing_years(df: DataFrame, denominator: DataFrame, year: str = "calendar_year") -> DataFrame:
    """Years of df that the denominator lacks. Both are reduced to their years before they meet: a join
    by year of the rows themselves would have one task for each year."""
    return df.select(year).filter(F.col(year).isNotNull()).distinct().subtract(denominator.select(year).distinct())
