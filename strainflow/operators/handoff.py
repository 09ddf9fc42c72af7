"""From a site's long observations and mappings to the canonical bundle: wide isolates with the
35 antibiotic columns of the contract, the scope of units, the denominator, and the manifest.

What the input must fulfil is checked in the plan: a row that breaks a rule raises when the result
is used, and nothing is collected for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strainflow.functions import text as X
from strainflow.functions import time as D
from strainflow.operators import isolates, joins, stays
from strainflow.sources import validation
from strainflow.sources.contracts import ANTIBIOTICS, KEY, WIDE
from strainflow.sources.stage import staged

#: Names that the column of diagnostic rows may have; a fixed order.
DIAGNOSTIC = ["ratb_diagnostic_scope", "diagnostic_scope", "is_diagnostic"]
#: Columns of the observations that may not be null once they are mapped.
REQUIRED = ["PATID", "ELTID", "DATEPRELEV", "souche_id", "bact_norm"]
_RANK = ["no_signal", "unknown", "negative", "positive"]


def checked(df: DataFrame, bad: Column, text: str | Column) -> DataFrame:
    """df; a row for which bad holds raises when the result is used."""
    text = F.lit(text) if isinstance(text, str) else text
    return df.filter(F.when(F.coalesce(bad, F.lit(False)), F.raise_error(text).cast("boolean")).otherwise(True))


def first_of(df: DataFrame, names: list[str]) -> str | None:
    return next((c for c in names if c in df.columns), None)


def mapped(df: DataFrame, column: str, pairs: DataFrame, key: str, value: str, out: str, gaps: bool = False, shaped: Callable[[Column], Column] = lambda v: v) -> DataFrame:
    """df with `out`, what pairs maps the trimmed column to, as `shaped` makes it. A value that pairs lacks raises, and so do
    a key with different values and, unless gaps are allowed, a key without one."""
    side = pairs.select(X.trim_or_null(F.col(key)).alias("_key"), X.trim_or_null(F.col(value)).alias("_value")).filter("_key is not null").distinct()
    side = side.withColumn("_n", F.count("*").over(Window.partitionBy("_key")))
    side = checked(side, F.col("_n") > 1, F.concat(F.lit(f"several values of {value} for "), F.col("_key")))
    if not gaps:
        side = checked(side, F.col("_value").isNull(), F.concat(F.lit(f"no value of {value} for "), F.col("_key")))
    own = df.withColumn("_own", X.trim_or_null(F.col(column)))
    joined = own.join(side.select("_key", shaped(F.col("_value")).alias("_value")), F.col("_own") == F.col("_key"), "left")
    unmapped = F.raise_error(F.concat(F.lit(f"{column} isn't mapped: "), F.col("_own"))).cast("string")
    value_ = F.when(F.col("_own").isNotNull() & F.col("_key").isNull(), unmapped).otherwise(F.col("_value"))
    return joined.withColumn(out, value_).drop("_own", "_key", "_value")


def _status(column: str) -> Column:
    """Aggregate: a number of _RANK, the strongest status of a group, of phenotype_text()."""
    plain = F.col(column)
    rank = F.raise_error(F.concat(F.lit(f"{column}: not a status: "), plain)).cast("int")
    for k, name in enumerate(_RANK):
        rank = F.when(plain == name, k).otherwise(rank)
    return F.max(F.when(plain.isNull(), 0).otherwise(rank))


def wide_isolates(observations: DataFrame, bacteria: DataFrame, sample_types: DataFrame, antibiotics: DataFrame, order: str = "handoff_row_order", names: list[str] = ANTIBIOTICS) -> DataFrame:
    """The contract's wide table, a row for each isolate.

    observations: PATID, ELTID, DATEPRELEV, SEJUF, bacteria_local, sample_type_local, antibiotic_local,
    sir_result, one of DIAGNOSTIC and `order`; EVTID, HEUREPRELEV, souche_id (or isolate_local_id),
    blse_status(_row) and carbapenemase_status(_row) may be missing. A screening row takes its whole
    document away. An isolate without souche_id gets one of its sample type and species. An isolate
    has one unit and one time, of whichever row has them. Cells hold the last result in order. names:
    the antibiotic columns.

    Cleaned texts are written once (stage.staged). Cells and statuses are numbers, and a unit is known by a hash until the rows are added up, so one
    hash aggregate makes the table. If no row is left the table is empty."""
    scope = first_of(observations, DIAGNOSTIC)
    if lacks := [c for c in ("PATID", "ELTID", "DATEPRELEV", "SEJUF", "bacteria_local", "sample_type_local", "antibiotic_local", "sir_result", order) if c not in observations.columns] + ([] if scope else [DIAGNOSTIC[0]]):
        raise ValueError(f"observations lack {', '.join(lacks)}")
    text = lambda c: X.trim_or_null(F.col(c)) if c else F.lit(None).cast("string")
    time, statuses = first_of(observations, ["HEUREPRELEV"]), {c: first_of(observations, [c, c.removesuffix("_row")]) for c in ("blse_status_row", "carbapenemase_status_row")}
    date, day = D.tried_date(F.col("DATEPRELEV")), F.nullif(F.trim(F.col("DATEPRELEV").cast("string")), F.lit(""))
    seconds, hour = (D.seconds(F.col(time).cast("string")), X.trim_or_null(F.col(time).cast("string"))) if time else (F.lit(None).cast("int"), text(None))
    clean = observations.select(
        *[text(c).alias(c) for c in ("PATID", "ELTID", "bacteria_local", "sample_type_local", "antibiotic_local")],
        text(first_of(observations, ["EVTID"])).alias("EVTID"),
        date.alias("DATEPRELEV"),
        F.when(date.isNull(), day).alias("_odd_day"),
        seconds.alias("_time"),
        F.when(seconds.isNull(), hour).alias("_odd_time"),
        X.flag(F.col(scope).cast("string")).alias("_shown"),
        text(first_of(observations, ["souche_id", "isolate_local_id"])).alias("_souche"),
        text("SEJUF").alias("_unit"),
        X.sir(F.col("sir_result")).alias("_sir"),
        *[(X.phenotype_text(F.col(of)) if of else F.lit(None).cast("string")).alias(c) for c, of in statuses.items()],
        F.col(order).alias("_order"),
    )
    # written, since filters would be moved below the projection and take its expressions with them, again and again
    clean = staged(clean, "observations")
    obs = checked(clean, F.col("_shown").isNull(), f"{scope} must say true or false")
    obs = isolates.diagnostic_documents(obs, "PATID", "EVTID", "ELTID", F.col("_shown"))
    obs = checked(obs, F.col("_odd_day").isNotNull(), F.concat(F.lit("not a date: "), F.col("_odd_day")))
    obs = checked(obs, F.col("_odd_time").isNotNull(), F.concat(F.lit("not a time: "), F.col("_odd_time")))
    obs = mapped(obs, "bacteria_local", bacteria, "bacteria_local", "bact_norm", "bact_norm")
    obs = mapped(obs, "sample_type_local", sample_types, "sample_type_local", "naturepvt_norm", "_type", gaps=True, shaped=lambda v: F.lower(X.to_ascii(v)))
    obs = mapped(obs, "antibiotic_local", antibiotics, "antibiotic_local", "atb_norm", "_atb")
    obs = checked(obs, ~F.col("_atb").isin(names), F.concat(F.lit("not an antibiotic column: "), F.col("_atb")))
    obs = obs.withColumnRenamed("_type", "naturepvt_norm")
    derived = F.concat_ws("__", F.lit("derived"), F.coalesce("naturepvt_norm", F.lit("missing_sample_type")), "bact_norm")
    obs = obs.withColumn("souche_id", F.coalesce("_souche", derived))
    for c in REQUIRED:
        obs = checked(obs, F.col(c).isNull(), f"{c} may not be missing")
    obs = obs.withColumn("_code", F.xxhash64("_unit"))
    code = F.when(F.col("_unit").isNotNull(), F.col("_code"))
    spread = {"_code_min": F.min(code), "_code_max": F.max(code), "HEUREPRELEV": F.min("_time"), "_time_max": F.max("_time")}
    out = isolates.widen(obs, KEY, "_atb", "_sir", names, F.col("_order"), spread | {c: _status(c) for c in statuses})
    out = checked(out, F.col("_code_min") != F.col("_code_max"), "different values of SEJUF in an isolate")
    out = checked(out, F.col("HEUREPRELEV") != F.col("_time_max"), "different values of HEUREPRELEV in an isolate")
    units = clean.select(F.col("_unit").alias("SEJUF")).filter("SEJUF is not null").distinct().withColumn("_hash", F.xxhash64("SEJUF"))
    units = checked(units.withColumn("_n", F.count("*").over(Window.partitionBy("_hash"))), F.col("_n") > 1, "two units have one hash").drop("_n")
    out = out.join(units, F.col("_code_min") == F.col("_hash"), "left")
    for c in statuses:
        out = out.withColumn(c, F.get(F.array(*map(F.lit, _RANK)), F.col(c)))
        out = checked(out, ~F.col(c).isin(*WIDE.allowed[c]), F.concat(F.lit(f"{c} can't be "), F.col(c)))
    flags = {c.replace("_status_row", "_flag"): F.col(c) == "positive" for c in statuses}
    columns = ["PATID", "EVTID", "ELTID", "DATEPRELEV", "HEUREPRELEV", "souche_id", "nb_resultats", "naturepvt_norm", "bact_norm", "SEJUF", *names, *statuses, *flags]
    return out.withColumns(flags).select(*columns)


def wide_meta(wide: DataFrame, source: str, required: dict | None = None) -> dict:
    """What the manifest says of a wide table: rows, documents, and which antibiotics have a result; one
    aggregate."""
    found = wide.agg(F.count("*").alias("n"), F.count_distinct("ELTID").alias("documents"), F.count_if(F.col("ELTID").isNull()).alias("gaps"), *[F.count_if(F.col(c).isin(isolates.CODES)).alias(c) for c in ANTIBIOTICS]).first()
    return {
        "artifact_version": 4,
        "sir_wide_n_rows": found["n"],
        "sir_wide_n_eltid": found["documents"] + (found["gaps"] > 0),
        "atb_cols": [c for c in ANTIBIOTICS if found[c]],
        "supported_atb_cols": ANTIBIOTICS,
        "phenotype_status_cols": ["blse_status_row", "carbapenemase_status_row"],
        "phenotype_flag_cols": ["blse_flag", "carbapenemase_flag"],
        "filtre_atb": ANTIBIOTICS,
        "handoff_source": source,
    } | (required or {})


def scope_reference(units: DataFrame) -> DataFrame:
    """A row for each unit of (SEJUF, CODE_TA, CODE_DE, de_domain_ref): codes and domain normalized,
    eligibility, status and reason. A missing or repeated unit raises."""
    rows = units.select(X.trim_or_null(F.col("SEJUF")).alias("SEJUF"), X.activity_code(F.col("CODE_TA")).alias("sample_CODE_TA"), X.discipline_code(F.col("CODE_DE")).alias("sample_CODE_DE"), X.domain_label(F.col("de_domain_ref"), stays.DOMAINS).alias("sample_de_domain_ref"))
    rows = checked(rows, F.col("SEJUF").isNull(), "a unit without SEJUF")
    rows = checked(rows.withColumn("_n", F.count("*").over(Window.partitionBy("SEJUF"))), F.col("_n") > 1, F.concat(F.lit("several rows for unit "), F.col("SEJUF")))
    scoped = stays.unit_scope(rows, "sample_CODE_TA", "sample_de_domain_ref")
    named = {"is_eligible": "sample_uf_is_eligible_by_ta_de", "scope_status": "sample_uf_ta_de_status", "scope_reason": "sample_uf_ta_de_reason"}
    return scoped.withColumnsRenamed(named).select("SEJUF", "sample_CODE_TA", "sample_CODE_DE", "sample_de_domain_ref", *named.values())


def _whole(x: Column, name: str) -> Column:
    """x as a whole number; what is none, or missing, raises."""
    text = X.trim_or_null(x.cast("string"))
    number = text.try_cast("double")
    good = number.isNotNull() & (F.abs(number - F.round(number)) < 1.49e-8) & (F.abs(number) < 2**31)
    return F.when(F.coalesce(good, F.lit(False)), F.round(number).cast("int")).otherwise(F.raise_error(F.concat(F.lit(f"{name}: not a whole number: "), F.coalesce(text, F.lit("missing")))).cast("int"))


#: Dimensions of an exposure, its grain and its order.
EXPOSURE_GRAIN = ["calendar_year", "SEJUM", "SEJUF", "CODE_TA", "CODE_DE", "de_domain_ref", "denominator_profile_id"]
# The profiles of a denominator and the units of their exposures.
PROFILES = {"midnight_presence": "patient_days"}


def exposure_table(rows: DataFrame, profiles: dict[str, str]) -> DataFrame:
    """The fine denominator, typed. Missing dimensions, negative values, pairs of profile and unit that
    `profiles` lacks, and repeated rows of the grain raise. Its order is EXPOSURE_GRAIN."""
    text = lambda c: X.trim_or_null(F.col(c))
    out = rows.select(
        _whole(F.col("calendar_year"), "calendar_year").alias("calendar_year"),
        text("SEJUM").alias("SEJUM"),
        text("SEJUF").alias("SEJUF"),
        X.activity_code(F.col("CODE_TA")).alias("CODE_TA"),
        X.discipline_code(F.col("CODE_DE")).alias("CODE_DE"),
        X.domain_label(F.col("de_domain_ref"), stays.DOMAINS).alias("de_domain_ref"),
        text("denominator_profile_id").alias("denominator_profile_id"),
        _whole(F.col("exposure_value"), "exposure_value").alias("exposure_value"),
        text("exposure_unit").alias("exposure_unit"),
    )
    for c in [*EXPOSURE_GRAIN, "exposure_unit"]:
        out = checked(out, F.col(c).isNull(), f"{c} may not be missing in an exposure")
    out = checked(out, F.col("exposure_value") < 0, "a negative exposure")
    fits = F.lit(False)
    for profile, unit in profiles.items():
        fits |= (F.col("denominator_profile_id") == profile) & (F.col("exposure_unit") == unit)
    out = checked(out, ~fits, F.concat_ws(" ", F.lit("no such profile with this unit:"), "denominator_profile_id", "exposure_unit"))
    repeated = F.count("*").over(Window.partitionBy(*EXPOSURE_GRAIN))
    out = checked(out.withColumn("_n", repeated), F.col("_n") > 1, "an exposure is there twice").drop("_n")
    return out.orderBy(*EXPOSURE_GRAIN)


def nights_table(rows: DataFrame) -> DataFrame:
    """(calendar_year, hospital_nights) by year; values that aren't whole, missing or negative ones raise."""
    out = rows.select(_whole(F.col("calendar_year"), "calendar_year").alias("calendar_year"), _whole(F.col("hospital_nights"), "hospital_nights").cast("bigint").alias("hospital_nights"))
    return checked(out, F.col("hospital_nights") < 0, "negative hospital_nights").orderBy("calendar_year")


def bundle(wide: DataFrame, units: DataFrame, *, nights: DataFrame | None = None, exposure: DataFrame | None = None, profiles: dict[str, str] | None = None, source: str = "external_handoff") -> tuple[dict[str, DataFrame], dict]:
    """(tables, manifest) of a bundle: version 3 with a fine exposure, else version 2 with nights by
    year. For sources.tables.write_bundle()."""
    if (nights is None) == (exposure is None):
        raise ValueError("a bundle has either nights by year or an exposure")
    scope = scope_reference(units)
    if exposure is None:
        scope = scope.select("SEJUF", "sample_uf_is_eligible_by_ta_de", "sample_uf_ta_de_status", "sample_uf_ta_de_reason")
        tables = {"denominator": nights_table(nights)}
    else:
        tables = {"exposure": exposure_table(exposure, profiles or PROFILES)}
    required = {"contract_version": "v2" if exposure is None else "v3", "sejuf_semantics": "hospitalization_unit_at_sampling"}
    return {"sir_wide": wide, "sample_scope_reference": scope} | tables, wide_meta(wide, source, required)


def to_version2(spark: SparkSession, tables: dict[str, DataFrame], meta: dict, profile: str = "midnight_presence") -> tuple[dict[str, DataFrame], dict]:
    """(tables, manifest) of version 2 from those of version 3: the wide table as it is, of the scope what
    version 2 knows, and nights by year of the profile in eligible units. A bundle that its checks find
    fault with raises, with every fault; its report, as long as the list of checks, is read for that."""
    faults = validation.bundle_report(spark, tables, meta).filter("n > 0").collect()
    if faults:
        raise ValueError("not a valid bundle: " + "; ".join(f"{r['table_name']}, {r['check_name']} ({r['n']}): {', '.join(r['examples'])}" for r in faults))
    # checked: codes and domains of an exposure are those of its unit, and its eligibility follows from them
    counts = (F.col("denominator_profile_id") == profile) & (F.col("exposure_unit") == PROFILES[profile])
    counts &= F.col("CODE_TA").isin(stays.ACTIVITIES) & F.col("de_domain_ref").isin(stays.DOMAINS)
    nights = joins.annual_exposure(tables["exposure"], counts).withColumn("hospital_nights", F.col("hospital_nights").cast("bigint"))
    wide = tables["sir_wide"]
    scope = tables["sample_scope_reference"].select("SEJUF", "sample_uf_is_eligible_by_ta_de", "sample_uf_ta_de_status", "sample_uf_ta_de_reason")
    kept = {k: meta[k] for k in ("artifact_version", "created_at")}
    required = kept | {"contract_version": "v2", "sejuf_semantics": meta["sejuf_semantics"]}
    return {"sir_wide": wide, "sample_scope_reference": scope, "denominator": nights}, wide_meta(wide, "external_handoff_v3_projection", required)


#: A scope's columns, from the names that older exports gave them.
LEGACY_SCOPE = {"SEJUF": "SEJUF", "CODE_TA": "sample_CODE_TA", "CODE_DE": "sample_CODE_DE", "de_domain_ref": "sample_de_domain_ref", "uf_is_eligible_by_ta_de": "sample_uf_is_eligible_by_ta_de", "uf_ta_de_status": "sample_uf_ta_de_status", "uf_ta_de_reason": "sample_uf_ta_de_reason"}
LEGACY_NIGHTS = {"calendar_year": "calendar_year", "hospital_nights_provisional": "hospital_nights"}


def modern(table: DataFrame, legacy: dict[str, str]) -> DataFrame:
    """A table of an older export with today's column names, and only those; one that lacks a column of
    the older form stays as it is, for the checks of its contract to judge."""
    if not set(legacy) <= set(table.columns):
        return table
    flag = lambda c: F.col(c).cast("boolean") if "is_eligible" in c else F.col(c)
    return table.select(*[flag(old).alias(new) for old, new in legacy.items()])
