"""A laboratory's raw export: queries against SQL, and one export from its rows to wide isolates."""

from __future__ import annotations

import dataclasses

import pytest
from conftest import DATA, same
from pyspark.sql import functions as F

from strainflow.functions import time as D
from strainflow.operators import handoff, joins, laboratory, runtime
from strainflow.plans import laboratory as plans


@pytest.mark.parametrize("name", plans.QUERIES)
def test_sql(spark, name):
    same(plans.QUERIES[name](spark, str(DATA)), plans.ORACLE_SQL[name], DATA)


COLUMNS = "PATID string, EVTID string, ELTID string, TYPEANA string, LBLANA string, LBLRES string, STRRES string, IDENTIFICATION string, NATUREPVT string, TRI int, source_row_order bigint"


def _row(patient, stay, sample, kind, analysis, result, value, tri, species="Escherichia coli", nature="URINE SONDE URETRALE GAUCHE"):
    return (patient, stay, sample, kind, analysis, result, value, species, nature, tri)


#: An explicit result after one of its class, a screening document whose stay must be filled, a deferred sample type, and a species that isn't certain.
EXPORT = [
    _row("P1", "E1", "D1", "ATB", "C3G", "SIR", "---S", 1),
    _row("P1", "E1", "D1", "ATB", "Cefotaxime", "SIR", "---R", 2),
    _row("P1", "E1", "D1", "ATB", "Fluoroquinolones", "SIR", "I", 3),
    _row("P1", "E1", "D1", "PHENO", "RECHERCHE BLSE", "Résultat", "Positive", 4),
    _row("P2", None, "D2", "SCREENING", "RECHERCHE SAMR", "Résultat", "Positive", 1),
    _row("P2", "E2", "D2", "ATB", "Cefotaxime", "SIR", "S", 2),
    _row("P3", None, "D3", "ATB", "Cefotaxime", "SIR", "S", 1, nature="SONDE"),
    _row("P4", "E4", "D4", "ATB", "Cefotaxime", "SIR", "R", 1, "Escherichia coli ou Klebsiella pneumoniae"),
]
_ATB = ["cefotaxime", "ceftazidime", "ceftriaxone", "ciprofloxacine"]


def _export(spark, rows=EXPORT):
    frame = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], COLUMNS)
    return frame.withColumns({"DATEPRELEV": F.lit("2024-02-15"), "HEUREPRELEV": F.lit("10:30"), "SEJUM": F.lit("UM1"), "SEJUF": F.lit("UF_MICRO"), "DLVL": F.lit("1")})


def _rules(spark):
    pairs = spark.createDataFrame([("escherichia_coli", a) for a in _ATB], "bact_norm string, atb_norm string")
    orders = spark.createDataFrame([("escherichia_coli", "Enterobacterales"), ("klebsiella_pneumoniae", "Enterobacterales")], "bact_norm string, bact_order string")
    decisions = spark.createDataFrame([("sonde", "defer", None)], "key string, action string, target string")
    species = [("(?i)^escherichia coli", "escherichia_coli", "bacterium"), ("(?i)^klebsiella", "klebsiella_pneumoniae", "bacterium")]
    drugs = [("^c3g$", "c3g"), ("^cefotaxime$", "cefotaxime"), ("^fluoroquinolones$", "fluoroquinolones")]
    return laboratory.Rules(["SCREENING"], species, orders, [("URINE", "Urines"), ("SONDE", "Urines")], decisions, drugs, pairs, {"c3g": ["cefotaxime", "ceftazidime", "ceftriaxone"], "fluoroquinolones": ["ciprofloxacine"]})


def _year():
    return F.lit("2024-01-01").cast("date"), F.lit("2025-01-01").cast("date")


def test_an_export_to_isolates(spark):
    made = laboratory.handoff(_export(spark), *_year(), _rules(spark))
    blocks = laboratory.checked_blocks(made)
    got = {r["PATID"]: r for r in handoff.wide_isolates(*blocks.values(), names=_ATB).collect()}
    assert got.keys() == {"P1", "P3"}
    p1, p3 = got["P1"], got["P3"]
    assert (p1["cefotaxime"], p1["ceftriaxone"], p1["ceftazidime"], p1["ciprofloxacine"], p1["naturepvt_norm"], p1["blse_status_row"], p1["blse_flag"]) == ("R", "S", "S", "ZIT", "urines", "positive", True)
    assert p3["naturepvt_norm"] is None and p3["EVTID"] is None
    screened = blocks["microbiology_observations"].filter("PATID = 'P2'").collect()
    assert len(screened) == 1 and not screened[0]["ratb_diagnostic_scope"]
    audit = {r["metric"]: r["value"] for r in made["audit"].collect()}
    assert {k: audit[k] for k in ("screening_document_occurrences_all_raw", "screening_document_occurrences_with_sir", "screening_rows_all_raw", "screening_sir_rows", "rows_evtid_filled_from_document", "phenotype_signal_rows", "phenotype_signal_rows_without_isolate", "raw_rows_in_target_period")} == {"screening_document_occurrences_all_raw": 1, "screening_document_occurrences_with_sir": 1, "screening_rows_all_raw": 2, "screening_sir_rows": 1, "rows_evtid_filled_from_document": 1, "phenotype_signal_rows": 1, "phenotype_signal_rows_without_isolate": 0, "raw_rows_in_target_period": 8}
    review = {r["sample_type_local"]: r["mapping_state"] for r in made["sample_type_review"].collect()}
    assert review == {"SONDE": "review_deferred", "URINE SONDE URETRALE GAUCHE": "multiple_patterns_same_target"}


def test_signals_of_no_isolate_and_two_contexts_raise(spark):
    lost = [*EXPORT, _row("P1", "E1", "D1", "PHENO", "RECHERCHE BLSE", "Résultat", "Positive", 5, species="Klebsiella pneumoniae")]
    with pytest.raises(ValueError, match="phenotype signals of no isolate: P1"):
        laboratory.checked_blocks(laboratory.handoff(_export(spark, lost), *_year(), _rules(spark)))
    twice = _export(spark).withColumn("SEJUF", F.when(F.col("TRI") == 2, "OTHER").otherwise(F.col("SEJUF")))
    with pytest.raises(ValueError, match="several contexts of P1/E1/D1"):
        laboratory.checked_blocks(laboratory.handoff(twice, *_year(), _rules(spark)))


def test_a_species_of_the_order_has_the_models_panel(spark):
    r = _rules(spark)
    observed = spark.createDataFrame([("escherichia_coli",), ("klebsiella_pneumoniae",), ("other",)], "bact_norm string")
    assert {tuple(x) for x in laboratory.panel(observed, r).collect()} == {(s, a) for s in ("escherichia_coli", "klebsiella_pneumoniae") for a in _ATB}
    with pytest.raises(Exception, match="has no bact_norm absent"):
        laboratory.panel(observed, dataclasses.replace(r, model="absent")).collect()


def test_unique_keeps_rows_as_they_are(spark):
    frame = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string")
    assert joins.unique(frame, ["k"]).count() == 2
    assert "SortAggregate" not in joins.unique(frame, ["k"])._jdf.queryExecution().executedPlan().toString()


def test_time_keys_sort(spark):
    frame = spark.createDataFrame([(t,) for t in ("9:05", "at 10:30:15", "N/A", " ", "25:00", "soon", None)], "t string")
    assert [r[0] for r in frame.select(D.sort_key(F.col("t"))).collect()] == ["09:05:00", "10:30:15", None, None, "25:00", "soon", None]


def test_documents_are_marked_where_rows_lie(spark):
    """Stays and screening documents are found by windows over one shuffle, and what a phenotype line says before it meets isolates."""
    rows = _export(spark)
    plan = runtime.marked_documents(runtime.resolve_stays(rows, "PATID", "ELTID", "EVTID"), laboratory.DOCUMENT, F.col("TYPEANA"), ["SCREENING"], F.col("LBLRES") == "SIR")
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
    shown = laboratory.handoff(rows, *_year(), _rules(spark))["sample_context"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in shown and "regexp_replace" not in shown
