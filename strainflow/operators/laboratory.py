"""A laboratory's raw export to the four blocks of a bundle: long observations and three mappings, with
audits. All rules are parameters; labels are classified once each and joined back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainflow.functions import text as X
from strainflow.functions import time as D
from strainflow.operators import joins, numbering, phenotype, rules, runtime
from strainflow.operators.handoff import checked
from strainflow.sources.stage import dealt, staged
from strainflow.sources.validation import signal_breaches

DOCUMENT = ["PATID", "EVTID", "ELTID"]
ISOLATE = [*DOCUMENT, "DATEPRELEV", "souche_id", "naturepvt_norm", "bact_norm"]
STATUSES = ["blse_status_row", "carbapenemase_status_row"]


@dataclass(frozen=True)
class Rules:
    """screening: analysis codes of screening documents; species: as rules.species() takes them; orders:
    (bact_norm, bact_order); sample_types: patterns of rules.decided(), with decisions (key, action,
    target); antibiotics: patterns of rules.antibiotics(); expansion: members of each class; pairs:
    (bact_norm, atb_norm) that are supported. Species of `order` that pairs lacks have the panel of
    `model`."""

    screening: list[str]
    species: list[tuple[str, str | None, str]]
    orders: DataFrame
    sample_types: list[tuple[str, str]]
    decisions: DataFrame
    antibiotics: list[tuple[str, str]]
    pairs: DataFrame
    expansion: dict[str, list[str]] = field(default_factory=dict)
    order: str = "Enterobacterales"
    model: str = "escherichia_coli"


def _label(c: str) -> Column:
    return X.squish(F.col(c).cast("string"))


def _classified(labels: DataFrame, r: Rules) -> DataFrame:
    """(bacteria_local, bact_norm) of each different label."""
    known = rules.species(labels.select("bacteria_local").filter("bacteria_local is not null").distinct(), "bacteria_local", r.species)
    return known.select("bacteria_local", "bact_norm")


def panel(observed: DataFrame, r: Rules) -> DataFrame:
    """(bact_norm, atb_norm): the supported pairs, with those of the model species for each observed species
    of its order that has none. A pair table without the model raises when it is needed."""
    pairs = r.pairs.select("bact_norm", "atb_norm").dropna().distinct()
    orders = r.orders.filter(F.col("bact_order") == r.order).select("bact_norm").distinct()
    return joins.inherit_panel(pairs, joins.having(observed, orders, ["bact_norm"]), "bact_norm", r.model)


def handoff(raw: DataFrame, start: Column, end: Column, r: Rules, source: str = "source_row_order", n_rows: int | None = None) -> dict[str, DataFrame]:
    """The blocks microbiology_observations, bacteria_mapping, sample_type_mapping, antibiotic_mapping, and
    sample_context, sample_type_review, document_scope, signals and audit.

    raw: text columns PATID, EVTID, ELTID, DATEPRELEV, HEUREPRELEV, SEJUM, SEJUF, DLVL, TYPEANA, LBLANA,
    LBLRES, STRRES, IDENTIFICATION, NATUREPVT; TRI and `source`, the row's number in the export
    (operators.numbering gives one). Samples in [start, end) count. A row without patient, document or
    day raises, and so do a stay that can't be told, two contexts of a document, results that are
    none, and phenotype signals of no isolate. n_rows: about how many rows raw has, if that is known.

    Rows are dealt by patient and document and written once, with cleaned labels and what is known of
    their documents, so that no later step joins all rows again."""
    dated = raw.withColumn("DATEPRELEV", D.date(F.col("DATEPRELEV")))
    dated = checked(dated, F.col("DATEPRELEV").isNull(), "DATEPRELEV is missing")
    inside = dated.withColumns({c: _label(c) for c in DOCUMENT}).filter((F.col("DATEPRELEV") >= start) & (F.col("DATEPRELEV") < end))
    for c in ("PATID", "ELTID"):
        inside = checked(inside, F.col(c).isNull(), f"{c} is missing")
    inside = inside.withColumn("_lacked", F.col("EVTID").isNull())
    if n_rows:
        inside = dealt(inside, n_rows, "PATID", "ELTID")
    named = runtime.marked_documents(runtime.resolve_stays(inside, "PATID", "ELTID", "EVTID"), DOCUMENT, F.col("TYPEANA"), r.screening, F.coalesce(F.upper(_label("LBLRES")) == "SIR", F.lit(False)))
    labels = {c: _label(of) for c, of in (("UM", "SEJUM"), ("UF", "SEJUF"), ("souche_id", "DLVL"), ("bacteria_local", "IDENTIFICATION"), ("sample_type_local", "NATUREPVT"), ("antibiotic_local", "LBLANA"))}
    labels |= {"TIME": D.seconds(F.col("HEUREPRELEV").cast("string")), "sir_result": F.when(F.col("is_result"), X.sir(F.col("STRRES")))}
    rows = named.withColumns(labels).select(*DOCUMENT, "DATEPRELEV", "HEUREPRELEV", *labels, "LBLANA", "LBLRES", "STRRES", "TRI", source, "_lacked", "is_result", "is_screening", "has_results")
    rows = staged(rows, "laboratory")
    is_sir, scope = F.col("is_result"), rows.groupBy(*DOCUMENT).agg(F.bool_or("is_screening").alias("is_screening"), F.bool_or("has_results").alias("has_results"))
    diagnostic, sir = rows.filter("not is_screening"), rows.filter("is_result")
    context = sir.select(*DOCUMENT, "DATEPRELEV", F.col("TIME").alias("HEUREPRELEV"), F.col("UM").alias("SEJUM"), F.col("UF").alias("SEJUF")).distinct()

    observations = sir.select(
        *DOCUMENT,
        "DATEPRELEV",
        "HEUREPRELEV",
        F.col("UM").alias("microbiology_SEJUM"),
        F.col("UF").alias("microbiology_SEJUF"),
        F.col("UF").alias("SEJUF"),
        "souche_id",
        "bacteria_local",
        "sample_type_local",
        "antibiotic_local",
        F.col("STRRES").alias("sir_result_source"),
        "sir_result",
        (~F.col("is_screening")).alias("ratb_diagnostic_scope"),
        F.col("TRI").alias("source_tri"),
        F.col(source).alias("source_row_order"),
    )
    observations = checked(observations, ~F.col("sir_result").isin("S", "R", "ZIT"), F.concat(F.lit("not a susceptibility result: "), F.col("sir_result")))
    shown = observations.filter("ratb_diagnostic_scope")
    review = staged(rules.decided(shown, "sample_type_local", r.sample_types, r.decisions), "sample-types")
    types = review.select("sample_type_local", F.lower(X.to_ascii(F.col("target"))).alias("naturepvt_norm"))
    names = staged(_classified(diagnostic, r), "species")
    pairs = panel(names.select("bact_norm").filter("bact_norm is not null").distinct(), r)
    known = shown.select("antibiotic_local").distinct().withColumn("kind", F.lit("SIR"))
    drugs = rules.antibiotics(known, "antibiotic_local", "kind", r.antibiotics).select("antibiotic_local", "atb_norm")
    members = F.lit(None).cast("array<string>")
    for class_, some in r.expansion.items():
        members = F.when(F.col("atb_norm") == class_, F.array(*map(F.lit, some))).otherwise(members)
    expanded = F.transform(members, lambda m: F.struct(m.alias("atb"), F.lit("expanded").alias("origin")))
    drugs = drugs.filter("atb_norm is not null").select("antibiotic_local", F.explode(F.coalesce(expanded, F.array(F.struct(F.col("atb_norm").alias("atb"), F.lit("explicit").alias("origin"))))).alias("x"))
    drugs = drugs.select(F.col("antibiotic_local").alias("_drug"), F.col("x.atb").alias("atb_norm"), F.col("x.origin").alias("atb_match_origin"))
    side = lambda df, c: df.withColumnRenamed(c, "_of")
    mapped = shown.filter("sir_result is not null").join(side(names.filter("bact_norm is not null"), "bacteria_local"), F.col("bacteria_local") == F.col("_of")).drop("_of").join(drugs, F.col("antibiotic_local") == F.col("_drug")).drop("_drug")
    mapped = joins.having(mapped, pairs, ["bact_norm", "atb_norm"]).join(side(types, "sample_type_local"), F.col("sample_type_local") == F.col("_of"), "left").drop("_of")
    ordered = numbering.handoff_order(mapped, [*DOCUMENT, "DATEPRELEV", "HEUREPRELEV", "souche_id", "bact_norm", "atb_norm"], "atb_match_origin", "source_tri", "source_row_order")
    supported = staged(ordered, "supported")

    coarse = [c for c in ISOLATE if c not in ("naturepvt_norm", "bact_norm")]
    # lines that say nothing are left out first: an isolate without a line that does has no signal. Written,
    # since Spark would move the join with isolates below the filter
    told = phenotype.line_statuses(diagnostic, "LBLANA", "LBLRES", "STRRES").filter("blse_line is not null or carbapenemase_line is not null")
    lines = staged(told.select(*coarse, "bacteria_local", "sample_type_local", "blse_line", "carbapenemase_line"), "said")
    lines = joins.having(lines, supported, coarse).join(side(names, "bacteria_local"), F.col("bacteria_local") == F.col("_of"), "left").drop("_of")
    lines = lines.join(side(types, "sample_type_local"), F.col("sample_type_local") == F.col("_of"), "left").drop("_of")
    signals = staged(lines.select(*ISOLATE, "blse_line", "carbapenemase_line"), "phenotypes")
    lost = signal_breaches("signals", signals, supported, ISOLATE)
    statuses = signals.groupBy(*ISOLATE).agg(phenotype.strongest(F.col("blse_line")).alias(STATUSES[0]), phenotype.strongest(F.col("carbapenemase_line")).alias(STATUSES[1]))
    out = joins.many_to_one(supported, statuses, ISOLATE).withColumns({c: F.coalesce(c, F.lit("no_signal")) for c in STATUSES})
    out = checked(out, F.col(STATUSES[0]) == "unknown", "a BLSE status can't be unknown")
    columns = ["microbiology_SEJUM", "microbiology_SEJUF", "SEJUF", "souche_id", "bacteria_local", "sample_type_local", "antibiotic_local_source", "antibiotic_local", "sir_result_source", "sir_result", "ratb_diagnostic_scope", *STATUSES, "atb_match_origin", "source_tri", "source_row_order", "handoff_row_order"]
    shaped = out.withColumn("antibiotic_local_source", F.col("antibiotic_local")).withColumn("antibiotic_local", F.col("atb_norm"))
    none = lambda kind: F.lit(None).cast(kind)
    hidden = observations.filter("not ratb_diagnostic_scope").withColumns({"antibiotic_local_source": F.col("antibiotic_local"), **{c: none("string") for c in (*STATUSES, "atb_match_origin")}, "handoff_row_order": none("bigint")})
    whole = [*DOCUMENT, "DATEPRELEV", "HEUREPRELEV", *columns]
    blocks = {
        "microbiology_observations": hidden.select(*whole).unionByName(shaped.select(*whole)),
        "bacteria_mapping": supported.select("bacteria_local", "bact_norm").distinct(),
        "sample_type_mapping": types,
        "antibiotic_mapping": supported.select(F.col("atb_norm").alias("antibiotic_local"), "atb_norm").distinct(),
    }
    count = lambda df, name, c=None: df.agg((F.count("*") if c is None else F.coalesce(F.count_if(c), F.lit(0))).alias(name))
    figures = [
        dated.agg(F.count("*").alias("raw_rows_received"), F.count_if(F.col("DATEPRELEV") < start).alias("raw_rows_before_target_period"), F.count_if(F.col("DATEPRELEV") >= end).alias("raw_rows_at_or_after_target_end")),
        rows.agg(F.count("*").alias("raw_rows_in_target_period"), F.count_if(is_sir).alias("sir_rows_before_screening"), F.count_if(F.col("_lacked") & F.col("EVTID").isNotNull()).alias("rows_evtid_filled_from_document")),
        scope.agg(F.count_if("is_screening").alias("screening_document_occurrences_all_raw"), F.count_if(F.col("is_screening") & F.col("has_results")).alias("screening_document_occurrences_with_sir"), F.count_if(F.col("EVTID").isNull()).alias("document_occurrences_without_evtid")),
        rows.filter("is_screening").agg(F.count("*").alias("screening_rows_all_raw"), F.count_if(is_sir).alias("screening_sir_rows")),
        count(supported, "diagnostic_rows_with_supported_species_atb"),
        count(types, "sample_type_labels_unresolved", F.col("naturepvt_norm").isNull()),
        count(signals, "phenotype_signal_rows"),
        count(lost, "phenotype_signal_rows_without_isolate"),
    ]
    audit = None
    for one in figures:
        cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in one.columns])
        some = one.select(F.explode(cells).alias("x")).select("x.*")
        audit = some if audit is None else audit.unionByName(some)
    return blocks | {"sample_context": context, "sample_type_review": review, "document_scope": scope, "lost_signals": lost, "audit": audit}


def checked_blocks(made: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """handoff()'s blocks, once it is certain that each document has one context and each signal an
    isolate; two actions on narrow tables."""
    twice = made["sample_context"].groupBy(*DOCUMENT).agg(F.count("*").alias("n")).filter("n > 1").limit(10).collect()
    if twice:
        raise ValueError(f"several contexts of {', '.join('/'.join(str(v) for v in r[:3]) for r in twice)}")
    lost = made["lost_signals"].limit(10).collect()
    if lost:
        raise ValueError(f"phenotype signals of no isolate: {', '.join(r['example'] for r in lost)}")
    return {k: made[k] for k in ("microbiology_observations", "bacteria_mapping", "sample_type_mapping", "antibiotic_mapping")}
