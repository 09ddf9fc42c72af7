"""The denominator and its audits: references of units joined to stays, the tables that follow from one
written audit of unit stays, the perimeter's effect on samples, and the handoff of raw stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strainflow.functions import text as X
from strainflow.operators import episodes, joins, stays
from strainflow.operators.handoff import checked
from strainflow.sources.stage import staged
from strainflow.sources.tables import keep_first

STAY, UNIT_STAY = ["patient", "stay"], ["patient", "stay", "um", "uf"]
# What the perimeter includes, for readers.
POLICY = [
    ("eligible_ta_codes", "|".join(stays.ACTIVITIES)),
    ("eligible_de_domains", "|".join(stays.DOMAINS)),
    ("microbiology_scope_rule", "keep microbiology row when sample SEJUF is eligible by TA and DE"),
    ("incidence_denominator_rule", "count nights from C-over-DW-filtered PMSI intervals for TA/DE-eligible UFs"),
    ("bloc_policy", "TA=08 is not an eligibility trigger"),
    ("unmapped_de_policy", "TA=03/20 with missing or unmapped CODE_DE is review/drop"),
    ("pmsi_status_policy", "PMSISTATUT is audit context only, not an inclusion gate"),
]


def policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLICY, "policy_dimension string, included_values string")


def unit_reference(structure: DataFrame, activities: DataFrame, disciplines: DataFrame) -> DataFrame:
    """(uf, label, ta, ta_label, de, domain, de_label, is_eligible, scope_status, scope_reason), once for each
    unit. structure: (SEJUF, label, CODE_TA, CODE_DE); activities: (CODE_TA, LIBELLE_TA), of which the
    first label counts; disciplines: (DOMAINE, CODE_DE, LIBELLE_DE), whose different domains are
    joined by a bar. A unit of two different pairs of codes raises when the result is used."""
    text = lambda c: X.trim_or_null(F.col(c))
    units = structure.select(text("SEJUF").alias("uf"), text("label").alias("label"), X.activity_code(F.col("CODE_TA")).alias("ta"), X.discipline_code(F.col("CODE_DE")).alias("de")).filter("uf is not null")
    pairs = units.select("uf", "ta", "de").distinct().withColumn("_n", F.count("*").over(Window.partitionBy("uf")))
    pairs = checked(pairs, F.col("_n") > 1, F.concat(F.lit("different codes of unit "), F.col("uf"))).drop("_n")
    labels = units.groupBy("uf").agg(F.min("label").alias("label"))
    codes = activities.select(X.activity_code(F.col("CODE_TA")).alias("_ta"), text("LIBELLE_TA").alias("ta_label")).filter("_ta is not null")
    named = disciplines.groupBy(X.discipline_code(F.col("CODE_DE")).alias("_de")).agg(X.collapse(text("DOMAINE")).alias("domain"), X.collapse(text("LIBELLE_DE")).alias("de_label"))
    out = pairs.join(labels, "uf").join(keep_first(codes, "_ta", ["ta_label"]), F.col("ta") == F.col("_ta"), "left").join(named, F.col("de") == F.col("_de"), "left")
    out = out.withColumn("domain", X.domain_label(F.col("domain"), stays.DOMAINS))
    return stays.unit_scope(out, "ta", "domain").select("uf", "label", "ta", "ta_label", "de", "domain", "de_label", "is_eligible", "scope_status", "scope_reason")


def scope_of(reference: DataFrame) -> DataFrame:
    """The reference as samples read it."""
    named = {"uf": "SEJUF", "label": "sample_consores_uf_label", "ta": "sample_CODE_TA", "de": "sample_CODE_DE", "domain": "sample_de_domain_ref", "is_eligible": "sample_uf_is_eligible_by_ta_de", "scope_status": "sample_uf_ta_de_status", "scope_reason": "sample_uf_ta_de_reason"}
    return reference.select(*[F.col(k).alias(v) for k, v in named.items()])


def with_units(rows: DataFrame, reference: DataFrame, uf_labels: DataFrame, um_labels: DataFrame, uf_um: DataFrame) -> DataFrame:
    """rows of (um, uf, ...) with unit_reference()'s columns, labels of both units and um_of_uf, the unit that
    should hold the other. Each reference has a key once, which the plan asserts; a unit that the
    first lacks is to be reviewed. Labels: (uf, uf_label), (um, um_label); uf_um: (uf, um_of_uf)."""
    out = joins.many_to_one(rows, reference.withColumn("_found", F.lit(True)), ["uf"])
    for side, key in ((uf_labels, "uf"), (um_labels, "um"), (uf_um, "uf")):
        out = joins.many_to_one(out, side.filter(F.col(key).isNotNull()), [key])
    unknown = F.col("_found").isNull()
    filled = {"is_eligible": F.coalesce("is_eligible", F.lit(False)), "scope_status": F.when(unknown, "review_unmapped_uf").otherwise(F.col("scope_status")), "scope_reason": F.when(unknown, "uf_absent_from_consores_structure").otherwise(F.col("scope_reason"))}
    return out.withColumns(filled).drop("_found")


def unit_misses(joined: DataFrame) -> DataFrame:
    """One row: rows of with_units(), and how many found no reference, label, domain or containing unit."""
    miss = {"n_no_uf": F.col("uf").isNull(), "n_no_reference": F.col("uf").isNotNull() & F.col("ta").isNull() & F.col("label").isNull(), "n_no_ta_label": F.col("ta").isNotNull() & F.col("ta_label").isNull(), "n_no_domain": F.col("de").isNotNull() & F.col("domain").isNull(), "n_no_uf_label": F.col("uf").isNotNull() & F.col("uf_label").isNull(), "n_no_um_label": F.col("um").isNotNull() & F.col("um_label").isNull(), "n_um_differs": F.col("um") != F.col("um_of_uf")}
    return joined.agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(k) for k, c in miss.items()])


def _id(*columns: str) -> Column:
    return F.struct(*columns)


def tables(rows: DataFrame) -> dict[str, DataFrame]:
    """All tables of the denominator, of the rows that episodes.unit_audit() takes; the audit is written
    once and read by each: unit_stays, episodes, exclusions, year_split, nights_by_unit,
    nights_by_unit_and_activity, exposure and year_summary."""
    audit = staged(episodes.unit_audit(rows), "unit-audit")
    joined = joins.many_to_one(episodes.base(rows), episodes.rollup(audit), STAY, required=True)
    perimeter = episodes.perimeter(joined).withColumn("only_emergency", stays.only_emergency(F.col("ums")))
    bounded = audit.filter("not missing_bounds and not negative_nights").withColumnsRenamed({"activities": "ta", "disciplines": "de", "domains": "domain"})
    split = stays.nights_by_year(bounded.filter("included").drop("nights"), "entry_min", "exit_max")
    complete = bounded.dropna(subset=["um", "uf", "ta", "de", "domain"]).drop("nights")
    exposed = stays.nights_by_year(complete, "entry_min", "exit_max")
    counts = [F.count_distinct(_id(*STAY)).alias("n_episodes"), F.count_distinct(_id(*UNIT_STAY)).alias("n_unit_stays")]
    total = F.sum("nights").alias("hospital_nights")
    crossing = lambda keys: F.count_distinct(F.when(F.col("cross_year"), _id(*keys)))
    exposure = exposed.groupBy("calendar_year", "um", "uf", "ta", "de", "domain").agg(F.sum("nights").cast("int").alias("exposure_value"))
    summary = perimeter.groupBy("perimeter_status", "included", "rule_level", "reason").agg(F.count("*").alias("n_episodes"), F.count_if(F.col("nights") == 0).alias("n_zero_nights"), F.count_if(F.year("entry_min") != F.year("exit_max")).alias("n_cross_year"), F.count_if("only_emergency").alias("n_only_emergency"), F.sum("eligible_nights").alias("eligible_nights"))
    return {
        "unit_stays": audit,
        "episodes": perimeter,
        "exclusions": stays.share_of_total(summary, "n_episodes", "pct_episodes"),
        "year_split": split.select(*UNIT_STAY, "ta", "de", "calendar_year", "cross_year", "nights"),
        "nights_by_unit": split.groupBy("calendar_year", "um", "uf").agg(*counts, total),
        "nights_by_unit_and_activity": split.groupBy("calendar_year", "um", "uf", "ta", "de").agg(*counts, total),
        "exposure": exposure.withColumns({"denominator_profile_id": F.lit("midnight_presence"), "exposure_unit": F.lit("patient_days")}),
        "year_summary": split.groupBy("calendar_year").agg(*counts, crossing(STAY).alias("n_cross_year_episodes"), crossing(UNIT_STAY).alias("n_cross_year_unit_stays"), total),
    }


def equal_or_raise(a: DataFrame, b: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """stays.reconcile(), in which a difference raises when the result is used."""
    out = stays.reconcile(a, b, key, value)
    return checked(out, F.col("difference") != 0, F.concat(F.lit(f"{name} differ for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("NA"))))


def numerator_impact(samples: DataFrame, stay: list[str] = STAY, document: str = "document") -> DataFrame:
    """What the scope keeps of samples of joins.sample_scope(): rows, documents and stays of each status,
    with shares in per cent."""
    out = samples.groupBy("scope_status", "is_eligible", "scope_reason").agg(F.count("*").alias("n_rows"), F.count_distinct(document).alias("n_documents"), F.count_distinct(F.struct(*stay)).alias("n_stays"))
    return stays.share_of_total(stays.share_of_total(out, "n_rows", "pct_rows"), "n_documents", "pct_documents")


def join_audit(samples: DataFrame, statuses: DataFrame, documents: str = "document", species: str = "species", sample_type: str = "sample_type") -> DataFrame:
    """A row for each stay of the samples: its rows, documents, species and types, its status in
    stays.administrative_status(), and whether it has one. Null ids match null ids."""
    own = samples.groupBy(*STAY).agg(F.count("*").alias("n_rows"), F.count_distinct(documents).alias("n_documents"), F.count_distinct(species).alias("n_species"), F.count_distinct(sample_type).alias("n_types"))
    return episodes.with_stay_status(own, statuses).withColumn("matched", F.col("stay_status") != "no_pmsi_match")


def join_exclusions(audit: DataFrame) -> DataFrame:
    """join_audit() by status, with shares of stays and of rows."""
    out = audit.groupBy("stay_status", "matched").agg(F.count("*").alias("n_stays"), F.sum("n_rows").alias("n_rows"), F.sum("n_documents").alias("n_documents"))
    return stays.share_of_total(stays.share_of_total(out, "n_stays", "pct_stays"), "n_rows", "pct_rows")


def stay_metrics(rows: DataFrame, entry: str, exit_: str, length: str) -> DataFrame:
    """(metric, value, unit): what the validation of stays says of rows with a stay's bounds and its
    stated length, in 14 figures of one written table of stays. A stay is valid with both bounds in order."""
    out = rows.groupBy(*STAY).agg(F.min(entry).alias("a"), F.max(exit_).alias("b"), F.max(length).alias("stated"))
    shared = F.count("*").over(Window.partitionBy("stay")) > 1
    days = F.timestamp_diff("SECOND", F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")) / 86400
    out = staged(out.withColumns({"days": days, "shared": F.col("stay").isNotNull() & shared}), "stays")
    good = F.coalesce(F.col("days") >= 0, F.lit(False))
    valid = lambda c: F.sum(F.when(good, c))
    split = stays.days_by_year(out.filter(good), "a", "b").agg(F.sum("days_exact").alias("split"))
    # The metrics and their units, in order.
    metrics = {
        "n_pmsi_stays_raw": (F.count("*"), "stays"),
        "n_pmsi_stays_validated": (F.count_if(good), "stays"),
        "n_pmsi_stays_excluded": (F.count_if(~good), "stays"),
        "n_invalid_missing_bounds": (F.count_if(F.col("days").isNull()), "stays"),
        "n_invalid_negative_elapsed": (F.count_if(F.col("days") < 0), "stays"),
        "n_zero_elapsed_validated": (F.count_if(F.col("days") == 0), "stays"),
        "n_cross_year_validated": (F.count_if(good & (F.year("a") != F.year("b"))), "stays"),
        "n_evtid_multi_pat_validated": (F.count_if(good & F.col("shared")), "stays"),
        "sum_exact_elapsed_days_validated": (valid(F.col("days")), "days"),
        "sum_floor_elapsed_days_validated": (valid(F.floor("days")), "days"),
        "sum_ceiling_elapsed_days_validated": (valid(F.ceil("days")), "days"),
        "sum_round_elapsed_days_validated": (valid(F.bround("days")), "days"),
        "sum_sejdur_max_validated": (valid(F.col("stated")), "days"),
    }
    one = out.agg(*[F.coalesce(c.cast("double"), F.lit(0.0)).alias(k) for k, (c, _) in metrics.items()]).join(F.broadcast(split), F.lit(True))
    one = one.withColumn("sum_year_split_exact_days", F.coalesce("split", F.lit(0.0)))
    cells = [F.struct(F.lit(k).alias("metric"), F.col(k).alias("value"), F.lit(unit).alias("unit")) for k, unit in [*((k, u) for k, (_, u) in metrics.items()), ("sum_year_split_exact_days", "days")]]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def window_counts(rows: DataFrame, entry: str, exit_: str, start: Column, end: Column) -> DataFrame:
    """One row: intervals without a bound, before the window, after it, and overlapping it."""
    a, b = F.col(entry), F.col(exit_)
    return rows.agg(F.count_if(a.isNull() | b.isNull()).alias("n_missing"), F.count_if(b <= start).alias("n_before"), F.count_if(a >= end).alias("n_after"), F.count_if((b > start) & (a < end)).alias("n_overlapping"))


def stay_handoff(rows: DataFrame, reference: DataFrame, start: Column, end: Column, source_keys: list[str]) -> dict[str, DataFrame]:
    """Raw stays (patient, stay, um, uf, entry, exit, source, um_of_uf) to a bundle's units, nights by year
    and exposure. Rows of the worse source go where the better one has the key, intervals are cut to
    the window, and units are looked up. The nights by year must be those of the units and those of
    the exposures that the perimeter takes: a difference raises when `nights` is used."""
    kept = staged(stays.prefer_source(rows, source_keys, "source"), "stays")
    known = reference.withColumn("_found", F.lit(True))
    inside = joins.many_to_one(stays.clip(kept, "entry", "exit", start, end), known, ["uf"])
    unknown = F.col("_found").isNull()
    inside = inside.withColumns({"is_eligible": F.coalesce("is_eligible", F.lit(False)), "scope_status": F.when(unknown, "review_unmapped_uf").otherwise(F.col("scope_status")), "scope_reason": F.when(unknown, "uf_absent_from_consores_structure").otherwise(F.col("scope_reason"))})
    made = tables(inside)
    nights = made["year_summary"].select("calendar_year", F.col("hospital_nights").cast("int").alias("hospital_nights"))
    by_unit = made["nights_by_unit"].groupBy("calendar_year").agg(F.sum("hospital_nights").alias("hospital_nights"))
    taken = F.col("ta").isin(stays.ACTIVITIES) & F.col("domain").isin(stays.DOMAINS)
    profile = made["exposure"].filter(taken).groupBy("calendar_year").agg(F.sum("exposure_value").alias("hospital_nights"))
    for other, name in ((by_unit, "nights of units and of the year"), (profile, "exposures and nights of the year")):
        same = equal_or_raise(nights, other, "calendar_year", "hospital_nights", name).select("calendar_year")
        nights = nights.join(same, "calendar_year", "left_semi")
    absent = kept.select("uf").filter("uf is not null").distinct().join(reference.select("uf"), "uf", "left_anti")
    mapping = reference.select("uf", "ta", "de", "domain").unionByName(absent, allowMissingColumns=True)
    units = mapping.select(F.col("uf").alias("SEJUF"), F.col("ta").alias("CODE_TA"), F.col("de").alias("CODE_DE"), F.col("domain").alias("de_domain_ref"))
    sizes = rows.agg(F.count("*").alias("n_before")).join(kept.agg(F.count("*").alias("n_after")), F.lit(True))
    return made | {"nights": nights, "units": units, "kept": kept, "source_policy": sizes, "window": window_counts(kept, "entry", "exit", start, end), "absent_units": absent}


def attributed(observations: DataFrame, attribution: DataFrame, key: list[str]) -> DataFrame:
    """observations whose unit is the one that their document was attributed to, or none; there is no
    fallback to the unit that they name. A document with two attributions raises when the result is
    used, and so does an observation without any; null ids match null ids.
    attribution: key, attribution_status, attribution_reason, hospitalization_um, hospitalization_uf."""
    side = attribution.select(*key, "attribution_status", "attribution_reason", "hospitalization_uf")
    out = joins.many_to_one(observations, side, key, required=True)
    assigned = F.col("attribution_status") == "assigned_hebergement"
    return out.withColumn("SEJUF", F.when(assigned, F.col("hospitalization_uf"))).drop("hospitalization_uf")


