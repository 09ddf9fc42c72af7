"""The catalogue of indicators as a table: typed, validated, audited, and compiled to the expressions
that operators.indicators evaluates. The catalogue is configuration of some hundred rows, and only
its executable rows come to the driver, to become columns of one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strainflow.functions import text as X
from strainflow.operators.handoff import checked
from strainflow.operators.indicators import KINDS, Indicator
from strainflow.sources.tables import read_delimited

# Columns of the catalogue, of which the last two may be missing, and its vocabularies.
COLUMNS = ["indicator_id", "wave", "enabled", "display_order", "organism_section", "organism_label", "organism_filter_type", "organism_filter_values", "report_taxon_label", "indicator_label", "indicator_kind", "molecule_values", "phenotype_flag", "scope_mode", "sample_type_mode", "sample_type_values", "analysis_period", "numerator_kind", "denominator_kind", "notes"]
OPTIONAL = ["publish_proportion", "publish_incidence"]
MODES = {"global_only": ("global",), "by_type_only": ("by_type",), "global_and_by_type": ("global", "by_type")}
NUMERATORS = ["resistant_isolates", "phenotype_positive_isolates"]
DENOMINATORS = ["tested_isolates", "all_isolates", "hospital_days"]
LISTS = {"organism_filter_values": "organisms", "molecule_values": "molecules", "sample_type_values": "sample_types"}
#: Rows that can be compiled into one plan.
MOST = 2000


def _true(x: Column) -> Column:
    return F.coalesce(F.lower(X.trim_or_null(x)).isin("true", "t", "1", "yes", "y"), F.lit(False))


def typed(raw: DataFrame) -> DataFrame:
    """The catalogue of text columns with numbers, truth values and lists; a publication flag that is
    missing says yes. Missing columns raise here."""
    if lacking := [c for c in COLUMNS if c not in raw.columns]:
        raise ValueError(f"the catalogue lacks {', '.join(lacking)}")
    text = lambda c: X.trim_or_null(F.col(c).cast("string")) if c in raw.columns else F.lit(None).cast("string")
    out = {c: text(c) for c in COLUMNS} | {"wave": text("wave").try_cast("int"), "display_order": text("display_order").try_cast("int"), "enabled": _true(text("enabled"))}
    out |= {c: F.when(text(c).isNull(), True).otherwise(_true(text(c))) for c in OPTIONAL}
    lists = {name: X.values(text(c)) for c, name in LISTS.items()}
    return raw.select(*[v.alias(k) for k, v in (out | lists).items()])


def read(spark: SparkSession, path: str) -> DataFrame:
    """typed() of a delimited file, in its display order."""
    return typed(read_delimited(spark, path)).orderBy("display_order", "indicator_id")


def species_orders(rules: DataFrame) -> DataFrame:
    """(bact_norm, bact_order) once each, of rules that name both; a species of two orders raises when
    the result is used."""
    pairs = rules.select(*[X.trim_or_null(F.col(c)).alias(c) for c in ("bact_norm", "bact_order")]).filter("bact_norm is not null and bact_order is not null").distinct()
    pairs = pairs.withColumn("_n", F.count("*").over(Window.partitionBy("bact_norm")))
    return checked(pairs, F.col("_n") > 1, F.concat(F.lit("several orders of "), F.col("bact_norm"))).drop("_n")


def with_orders(isolates: DataFrame, orders: DataFrame) -> DataFrame:
    """isolates with the order of their species; null where it isn't known."""
    side = orders.select(F.col("bact_norm").alias("_species"), "bact_order")
    return isolates.join(side, F.col("bact_norm") == F.col("_species"), "left").drop("_species")


def _array(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def validate(spec: DataFrame, observed: list[str], supported: list[str], phenotypes: list[str], sample_types: list[str]) -> DataFrame:
    """spec with what is wrong and what is missing of each row. observed: antibiotics with a result;
    supported: those that the data may have; phenotypes, sample_types: those of the data."""
    col, n = F.col, F.size
    within = lambda c, some: F.array_intersect(c, _array(some))
    without = lambda c, some: F.array_except(c, _array(some))
    phenotype = col("indicator_kind") == "phenotype_flag"
    listed = lambda c, some: F.coalesce(col(c).isin(*some), F.lit(False))
    requested, available, seen = n("molecules"), n(within(col("molecules"), supported)), n(within(col("molecules"), observed))
    gaps = without(col("sample_types"), sample_types)
    payload = F.when(listed("indicator_kind", KINDS[:3]), requested > 0).when(phenotype, col("phenotype_flag").isNotNull()).otherwise(False)
    out = spec.withColumns({
        "duplicated_indicator_id": F.count("*").over(Window.partitionBy("indicator_id")) > 1,
        "supported_indicator_kind": listed("indicator_kind", KINDS),
        "supported_sample_type_mode": listed("sample_type_mode", list(MODES)),
        "supported_numerator_kind": listed("numerator_kind", NUMERATORS),
        "supported_denominator_kind": listed("denominator_kind", DENOMINATORS),
        "has_scope_mode": col("scope_mode").isNotNull(),
        "has_filter_values": n("organisms") > 0,
        "n_requested_molecules": requested,
        "n_available_molecules": available,
        "any_molecule_available": available > 0,
        "all_required_molecules_available": available == requested,
        "molecules_missing": F.array_join(without(col("molecules"), supported), " | "),
        "n_observed_molecules": seen,
        "all_required_molecules_observed": seen == requested,
        "molecules_supported_but_unobserved": F.array_join(without(within(col("molecules"), supported), observed), " | "),
        "has_valid_indicator_payload": payload,
        "phenotype_col_present": F.when(phenotype, listed("phenotype_flag", phenotypes)),
        "n_requested_sample_types": n("sample_types"),
        "all_requested_sample_types_present": n(gaps) == 0,
        "missing_sample_types": F.array_join(gaps, " | "),
    })
    good = ~col("duplicated_indicator_id")
    for c in ("supported_indicator_kind", "supported_sample_type_mode", "supported_numerator_kind", "supported_denominator_kind", "has_scope_mode", "has_filter_values", "has_valid_indicator_payload"):
        good &= col(c)
    return out.withColumn("hard_validation_ok", good)


def coverage(validated: DataFrame) -> DataFrame:
    """validate()'s rows with the status of each metric, the first that holds, and a note."""
    col = F.col
    phenotype = F.coalesce(col("indicator_kind") == "phenotype_flag", F.lit(False))
    no_flag = phenotype & ~F.coalesce("phenotype_col_present", F.lit(False))
    no_molecule = ~phenotype & ~col("any_molecule_available")

    def status(metric: str) -> Column:
        # Statuses, first that holds.
        out = (
            F.when(~col(f"publish_{metric}"), f"not_requested_{metric}")
            .when(~col("enabled"), "disabled")
            .when(col("wave") != 1, "not_wave1")
            .when(col("analysis_period") != "annual", "deferred_period")
            .when(~col("hard_validation_ok"), "invalid_spec")
            .when(no_flag, "pending_phenotype_flag")
            .when(no_molecule, "missing_molecule_support")
        )
        out = out.when(~col("all_requested_sample_types_present"), "missing_sample_type_mapping") if metric == "proportion" else out
        return out.otherwise(f"published_{metric}")

    both = {f"{m}_execution_status": status(m) for m in ("proportion", "incidence")}
    mode = F.when(col("publish_proportion") & col("publish_incidence"), "proportion_and_incidence").when(col("publish_proportion"), "proportion_only").when(col("publish_incidence"), "incidence_only").otherwise("not_published")
    out = validated.withColumns(both | {"publication_mode": mode})
    proportion, incidence = col("proportion_execution_status"), col("incidence_execution_status")
    # Notes, first that holds.
    note = (
        F.when((proportion == "invalid_spec") | (incidence == "invalid_spec"), "Spec row failed hard validation.")
        .when(no_flag, F.concat(F.lit("Missing phenotype column in artifact: "), col("phenotype_flag")))
        .when(no_molecule, F.concat(F.lit("None of the requested molecules are present in the supported molecule universe: "), col("molecules_missing")))
        .when(proportion == "missing_sample_type_mapping", F.concat(F.lit("Unknown sample_type_values: "), col("missing_sample_types")))
        .when(~phenotype & col("any_molecule_available") & ~col("all_required_molecules_available"), F.concat(F.lit("Partial molecule coverage against the supported molecule universe. Unsupported: "), col("molecules_missing")))
        .when(col("publication_mode") == "incidence_only", "Published in incidence only.")
        .when(col("publication_mode") == "proportion_only", "Published in proportion only.")
        .otherwise(col("notes"))
    )
    return out.withColumns({"proportion_executable": proportion == "published_proportion", "incidence_executable": incidence == "published_incidence", "coverage_note": note})


def executable(covered: DataFrame, metric: str) -> list[Indicator]:
    """The indicators that coverage() finds executable for proportion or incidence, in display order."""
    rows = covered.filter(f"{metric}_executable").orderBy("display_order", "indicator_id").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} indicators for one plan")
    return [Indicator(r["indicator_id"], r["indicator_kind"], tuple(r["molecules"]), r["phenotype_flag"], r["organism_filter_type"], tuple(r["organisms"]), tuple(r["sample_types"]), MODES[r["sample_type_mode"]]) for r in rows]


def yearly_nights(rows: DataFrame) -> DataFrame:
    """A denominator as indicators.incidence() takes it; other columns than the contract's raise here."""
    if lacking := [c for c in ("calendar_year", "hospital_nights") if c not in rows.columns]:
        raise ValueError(f"the denominator lacks {', '.join(lacking)}")
    return rows.select(F.col("calendar_year").cast("int").alias("calendar_year"), F.col("hospital_nights").cast("double").alias("nights"))


def display_summary(spec: DataFrame) -> DataFrame:
    """The catalogue for readers: a row for each taxon, kind and base of calculation, with the indicators
    and organisms that it holds, at the least display order of them."""
    listed = lambda c, sep: X.collapse(F.col(c), sep)
    return spec.groupBy("report_taxon_label", "indicator_kind", "denominator_kind").agg(F.min("display_order").alias("display_order"), listed("organism_label", " | ").alias("organisms"), listed("indicator_label", ", ").alias("indicators"), listed("notes", " | ").alias("notes"))
