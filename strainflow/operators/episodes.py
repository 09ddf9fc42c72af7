"""Stays as episodes: audits of their units, rollups, perimeter statuses, and nights by grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainflow.functions.text import collapse
from strainflow.functions.time import nights

STAY = ["patient", "stay"]


def _any(c: str) -> Column:
    return F.coalesce(F.bool_or(c), F.lit(False))


def unit_audit(rows: DataFrame) -> DataFrame:
    """A row for each unit of a stay, of rows with (patient, stay, um, uf, entry, exit, source, ta,
    de, domain, um_of_uf) and the columns of stays.unit_scope()."""
    out = rows.groupBy(*STAY, "um", "uf").agg(
        F.count("*").alias("n_rows"),
        F.min("entry").alias("entry_min"),
        F.max("exit").alias("exit_max"),
        collapse(F.col("source")).alias("sources"),
        collapse(F.col("ta")).alias("activities"),
        collapse(F.col("de")).alias("disciplines"),
        collapse(F.col("domain")).alias("domains"),
        _any("is_eligible").alias("is_eligible"),
        collapse(F.col("scope_status")).alias("scope_status"),
        collapse(F.col("scope_reason")).alias("scope_reason"),
        F.count_if(F.col("um_of_uf") != F.col("um")).alias("n_unit_mismatch"),
    )
    n = nights(F.col("entry_min"), F.col("exit_max"))
    missing = F.col("entry_min").isNull() | F.col("exit_max").isNull()
    out = out.withColumns({"nights": n, "missing_bounds": missing, "negative_nights": F.coalesce(n < 0, F.lit(False)), "zero_nights": F.coalesce(n == 0, F.lit(False))})
    crosses = F.coalesce(F.year("entry_min") != F.year("exit_max"), F.lit(False))
    # Statuses of a unit of a stay, first that holds.
    status = (
        F.when(missing, "review_missing_bounds")
        .when(F.col("negative_nights"), "review_negative_nights")
        .when(F.col("is_eligible"), "included")
        .when(F.col("uf").isNull(), "excluded_no_uf")
        .when(F.col("scope_status") == "review_unmapped_uf", "review_unmapped_uf")
        .when(F.col("scope_status") == "review_unmapped_de", "review_unmapped_de")
        .otherwise("excluded_no_ta_de_eligible_uf")
    )
    return out.withColumns({"cross_year": crosses, "unit_stay_status": status, "included": status == "included"})


def rollup(units: DataFrame) -> DataFrame:
    """A row for each stay, of unit_audit()."""
    return units.groupBy(*STAY).agg(
        F.count("*").alias("n_unit_stays"),
        F.count_if("is_eligible").alias("n_eligible"),
        F.count_if("included").alias("n_included"),
        F.count_if(F.col("is_eligible") & ~F.col("included")).alias("n_review"),
        F.coalesce(F.sum(F.when(F.col("included"), F.col("nights"))), F.lit(0)).alias("eligible_nights"),
        F.coalesce(F.bool_or(F.when(F.col("included"), F.col("cross_year"))), F.lit(False)).alias("unit_cross_year"),
    )


def base(rows: DataFrame) -> DataFrame:
    """Bounds and counts of distinct units of each stay, of the rows of unit_audit()."""
    out = rows.groupBy(*STAY).agg(
        F.count("*").alias("n_rows"),
        F.min("entry").alias("entry_min"),
        F.max("exit").alias("exit_max"),
        F.count_distinct("uf").alias("n_uf"),
        F.count_distinct("um").alias("n_um"),
        F.count_distinct(F.when(F.col("scope_status") == "review_unmapped_uf", F.col("uf"))).alias("n_uf_unmapped"),
        F.count_distinct(F.when(F.col("scope_status") == "review_unmapped_de", F.col("uf"))).alias("n_de_unmapped"),
        F.array_sort(F.collect_set("um")).alias("ums"),
        collapse(F.col("source")).alias("sources"),
    )
    n = nights(F.col("entry_min"), F.col("exit_max"))
    missing = F.col("entry_min").isNull() | F.col("exit_max").isNull()
    return out.withColumns({"nights": n, "missing_bounds": missing, "negative_nights": F.coalesce(n < 0, F.lit(False))})


def perimeter(episodes: DataFrame) -> DataFrame:
    """Status, rule level and reason of each stay with the columns of base() and rollup()."""
    col, missing, negative = F.col, F.col("missing_bounds"), F.col("negative_nights")
    # Statuses, levels and reasons of a stay, first that holds.
    status = (
        F.when(missing, "review_missing_bounds")
        .when(negative, "review_negative_nights")
        .when((col("n_included") > 0) & (col("n_review") == 0), "included")
        .when(col("n_included") > 0, "included_with_unit_review")
        .when(col("n_review") > 0, "review_unit_stay_bounds")
        .when(col("n_uf") == 0, "excluded_no_uf")
        .when(col("n_uf_unmapped") > 0, "review_unmapped_uf")
        .when(col("n_de_unmapped") > 0, "review_unmapped_de")
        .otherwise("excluded_no_ta_de_eligible_uf")
    )
    out = episodes.withColumn("perimeter_status", status)
    level = F.when(missing | negative, "stay_bounds").when(col("perimeter_status") == "review_unit_stay_bounds", "unit_stay_bounds").otherwise("TA_DE")
    reason = (
        F.when(missing, "missing_bounds")
        .when(negative, "negative_nights")
        .when(col("perimeter_status") == "included", "eligible_ta_de_unit_stays")
        .when(col("perimeter_status") == "included_with_unit_review", "eligible_ta_de_unit_stays_with_bounds_review")
        .when(col("perimeter_status") == "review_unit_stay_bounds", "eligible_ta_de_unit_stays_without_valid_bounds")
        .when(col("n_uf") == 0, "no_uf")
        .when(col("n_uf_unmapped") > 0, "unmapped_uf")
        .when(col("n_de_unmapped") > 0, "unmapped_de")
        .otherwise("no_ta_de_eligible_uf")
    )
    return out.withColumns({"rule_level": level, "reason": reason, "included": col("perimeter_status").isin("included", "included_with_unit_review")})


def nights_groupings(split: DataFrame) -> DataFrame:
    """Nights of stays.nights_by_year() by year, by year and unit, by year, activity and discipline,
    and by year and profile: one pass of grouping sets; `grouping` names the set."""
    keys = [F.col(c) for c in ("calendar_year", "um", "uf", "ta", "de", "profile")]
    year, um, uf, ta, de, profile = keys
    out = split.groupingSets([[year], [year, um, uf], [year, ta, de], [year, profile]], *keys).agg(
        F.grouping("uf").alias("_u"), F.grouping("ta").alias("_t"), F.grouping("profile").alias("_p"), F.sum("nights").alias("nights"), F.count("*").alias("n_rows")
    )
    name = F.when(F.col("_u") == 0, "unit").when(F.col("_t") == 0, "activity_discipline").when(F.col("_p") == 0, "profile").otherwise("year")
    return out.withColumn("grouping", name).drop("_u", "_t", "_p")


def shared_stays(rows: DataFrame) -> DataFrame:
    """(stay, n_patients, is_shared): how many patients each stay id has."""
    return rows.filter("stay is not null").groupBy("stay").agg(F.count_distinct("patient").alias("n_patients")).withColumn("is_shared", F.col("n_patients") > 1)


def with_stay_status(samples: DataFrame, statuses: DataFrame) -> DataFrame:
    """samples with stay_status of stays.administrative_status(); stays that it lacks have no_pmsi_match."""
    side = statuses.select(*[F.col(k).alias(f"_{k}") for k in STAY], "stay_status")
    on = samples["patient"].eqNullSafe(side["_patient"]) & samples["stay"].eqNullSafe(side["_stay"])
    return samples.join(side, on, "left").withColumn("stay_status", F.coalesce("stay_status", F.lit("no_pmsi_match"))).drop("_patient", "_stay")
