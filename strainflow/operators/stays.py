"""Hospital stays: source preference, nights and days by year, scope of units, reconciliations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainflow.functions.text import collapse
from strainflow.functions.time import nights

# Activity codes and discipline domains whose units count.
ACTIVITIES = ["03", "20"]
DOMAINS = [
    "MÉDECINE",
    "URGENCES",
    "CHIRURGIE",
    "RÉANIMATION",
    "PÉDIATRIE",
    "GYNÉCOLOGIE-OBSTÉTRIQUE",
    "SOINS MÉDICAUX ET DE RÉADAPTATION",
    "SOINS DE LONGUE DURÉE",
    "PSYCHIATRIE",
    "ÉTABLISSEMENT D'HÉBERGEMENT POUR PERSONNES ÂGÉES DÉPENDANTES",
]
EMERGENCY_UNITS = ["URGE", "URGP"]


def prefer_source(df: DataFrame, keys: list[str], source: str, better: str = "C", worse: str = "DW") -> DataFrame:
    """Drops rows of the worse source where a row of the same complete key is of the better."""
    better_rows = df.filter(F.col(source) == better).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    on = df[source] == worse
    for i, k in enumerate(keys):
        on &= df[k] == F.col(f"_k{i}")  # incomplete keys equal none
    return df.join(better_rows, on, "left_anti")


def clip(df: DataFrame, entry: str, exit_: str, start: Column, end: Column) -> DataFrame:
    """Intervals that overlap [start, end), cut to it."""
    inside = df.filter((F.col(exit_) > start) & (F.col(entry) < end))
    return inside.withColumns({entry: F.greatest(F.col(entry), start), exit_: F.least(F.col(exit_), end)})


def nights_by_year(df: DataFrame, entry: str, exit_: str) -> DataFrame:
    """df with a row for each calendar year in which the stay has nights: calendar_year, nights."""
    a, b = F.to_date(entry), F.to_date(exit_)
    years = df.filter(a.isNotNull() & b.isNotNull() & (a < b)).withColumn("calendar_year", F.explode(F.sequence(F.year(a), F.year(b))))
    begin = F.greatest(a, F.make_date("calendar_year", F.lit(1), F.lit(1)))
    stop = F.least(b, F.make_date(F.col("calendar_year") + 1, F.lit(1), F.lit(1)))
    return years.withColumn("nights", F.datediff(stop, begin)).filter("nights > 0")


def days_by_year(df: DataFrame, entry: str, exit_: str) -> DataFrame:
    """df with a row for each calendar year that the stay touches: exact days and their floor,
    ceiling and half-even rounding. Stays of no length keep a row; negative ones go."""
    a, b = F.col(entry).cast("timestamp_ntz"), F.col(exit_).cast("timestamp_ntz")
    years = df.filter(a.isNotNull() & b.isNotNull() & (a <= b)).withColumn("calendar_year", F.explode(F.sequence(F.year(a), F.year(b))))
    edge = lambda year: F.make_timestamp_ntz(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    seconds = F.timestamp_diff("SECOND", F.greatest(a, edge(F.col("calendar_year"))), F.least(b, edge(F.col("calendar_year") + 1)))
    out = years.withColumn("days_exact", seconds / 86400)
    return out.withColumns({"days_floor": F.floor("days_exact"), "days_ceiling": F.ceil("days_exact"), "days_round": F.bround("days_exact").cast("bigint")})


def stay_bounds(df: DataFrame, keys: list[str], entry: str, exit_: str) -> DataFrame:
    """A row for each stay: bounds, units' rows, nights and validation status."""
    out = df.groupBy(*keys).agg(F.min(entry).alias("entry_min"), F.max(exit_).alias("exit_max"), F.count("*").alias("n_rows"))
    n = nights(F.col("entry_min"), F.col("exit_max"))
    state = F.when(F.col("entry_min").isNull() | F.col("exit_max").isNull(), "missing_bounds").when(n < 0, "negative_nights").when(n == 0, "zero_nights").otherwise("validated")
    return out.withColumns({"nights": n, "validation_status": state, "cross_year": F.year("entry_min") != F.year("exit_max")})


def validation_metrics(stays: DataFrame) -> DataFrame:
    """(metric, value) of stay_bounds(), from one aggregate."""
    names = {
        "stays": F.count("*"),
        "rows": F.sum("n_rows"),
        "validated": F.count_if(F.col("validation_status") == "validated"),
        "zero_nights": F.count_if(F.col("validation_status") == "zero_nights"),
        "negative_nights": F.count_if(F.col("validation_status") == "negative_nights"),
        "missing_bounds": F.count_if(F.col("validation_status") == "missing_bounds"),
        "cross_year": F.count_if(F.col("cross_year")),
        "nights": F.sum(F.when(F.col("nights") > 0, F.col("nights"))),
    }
    one = stays.agg(*[F.coalesce(c.cast("bigint"), F.lit(0)).alias(k) for k, c in names.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in names])).alias("x")).select("x.*")


def unit_scope(df: DataFrame, activity: str, domain: str, domains: list[str] = DOMAINS, activities: list[str] = ACTIVITIES) -> DataFrame:
    """df with the unit's eligibility, status and reason."""
    counts, known = F.coalesce(F.col(activity).isin(activities), F.lit(False)), F.col(domain).isNotNull()
    inside = F.coalesce(F.col(domain).isin(domains), F.lit(False))
    status = F.when(counts & inside, "eligible_ta_de").when(F.col(activity).isNull(), "review_unmapped_uf").when(counts & ~known, "review_unmapped_de").when(counts, "excluded_de_domain").otherwise("excluded_ta")
    reason = F.when(counts & inside, "eligible_ta_de").when(F.col(activity).isNull(), "uf_absent_from_consores_structure").when(counts & ~known, "ta_03_20_unmapped_de").when(counts, "ta_03_20_de_domain_not_included").otherwise("ta_not_03_20")
    return df.withColumns({"is_eligible": counts & inside, "scope_status": status, "scope_reason": reason})


def unit_stay_status(df: DataFrame, entry: str, exit_: str, unit: str) -> DataFrame:
    """df of unit_scope() with the status of each stay in a unit."""
    n = nights(F.col(entry), F.col(exit_))
    status = (
        F.when(F.col(entry).isNull() | F.col(exit_).isNull(), "review_missing_bounds")
        .when(n < 0, "review_negative_nights")
        .when(F.col("is_eligible"), "included")
        .when(F.col(unit).isNull(), "excluded_no_uf")
        .when(F.col("scope_status").isin("review_unmapped_uf", "review_unmapped_de"), F.col("scope_status"))
        .otherwise("excluded_no_ta_de_eligible_uf")
    )
    return df.withColumns({"nights": n, "unit_stay_status": status})


def administrative_status(df: DataFrame, keys: list[str], status: str) -> DataFrame:
    """A row for each stay: H alone is eligible, E alone external, none no usable status, else
    mixed."""
    got = df.groupBy(*keys).agg(collapse(F.upper(F.trim(status))).alias("statuses"))
    state = F.when(F.col("statuses").isNull(), "no_usable_status").when(F.col("statuses") == "H", "eligible").when(F.col("statuses") == "E", "external").otherwise("mixed")
    return got.withColumn("stay_status", state)


def only_emergency(units: Column, emergency: list[str] = EMERGENCY_UNITS) -> Column:
    """Whether an array of units is not empty and holds emergency units alone."""
    return (F.size(units) > 0) & F.forall(units, lambda u: u.isin(emergency))


def reconcile(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, a, b, difference): a full join with missing values as 0."""
    x, y = a.select(F.col(key).alias("_a"), F.col(value).alias("_x")), b.select(F.col(key).alias("_b"), F.col(value).alias("_y"))
    out = x.join(y, F.col("_a").eqNullSafe(F.col("_b")), "full_outer")
    p, q = F.coalesce("_x", F.lit(0)), F.coalesce("_y", F.lit(0))
    return out.select(F.coalesce("_a", "_b").alias(key), p.alias("a"), q.alias("b"), (p - q).alias("difference"))


def share_of_total(df: DataFrame, count: str, out: str = "pct") -> DataFrame:
    """df with each row's share of the column's total, in per cent; for small grouped tables."""
    total = df.agg(F.sum(count).alias("_total"))
    return df.join(F.broadcast(total)).withColumn(out, 100 * F.col(count) / F.col("_total")).drop("_total")
