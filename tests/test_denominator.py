"""Denominators, references and audits; the catalogue of indicators; label decisions and phenotype lines:
queries against SQL, and operators on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import DATA, same
from pyspark.sql import functions as F

from strainflow.operators import denominator, phenotype, rules, specs, stays
from strainflow.plans import denominator as plans
from strainflow.plans import specs as spec_plans


@pytest.mark.parametrize("name", plans.QUERIES)
def test_sql(spark, name):
    same(plans.QUERIES[name](spark, str(DATA)), plans.ORACLE_SQL[name], DATA)


@pytest.mark.parametrize("name", spec_plans.QUERIES)
def test_specs_sql(spark, name):
    same(spec_plans.QUERIES[name](spark, str(DATA)), spec_plans.ORACLE_SQL[name], DATA)


def _reference(spark):
    structure = spark.createDataFrame([("5130", "UF 5130", "03", "102"), ("5136", "UF 5136", "03", "102"), ("5701", "UF 5701", "10", "211")], "SEJUF string, label string, CODE_TA string, CODE_DE string")
    activities = spark.createDataFrame([("03", "HOSPITALISATION_COMPLETE"), ("10", "URGENCES")], "CODE_TA string, LIBELLE_TA string")
    disciplines = spark.createDataFrame([("MÉDECINE", "102", "MEDECINE"), ("URGENCES", "211", "URGENCES")], "DOMAINE string, CODE_DE string, LIBELLE_DE string")
    return denominator.unit_reference(structure, activities, disciplines)


def _stays(spark):
    day = dt.datetime
    rows = [
        ("P1", "E1", "INTB", "5130", day(2024, 2, 1), day(2024, 3, 1), "C"),
        ("P1", "E1", "INTB", "5130", day(2024, 2, 1), day(2024, 3, 1), "DW"),
        ("P5", "E5", "INTB", "5136", day(2024, 3, 1), day(2024, 3, 2), "DW"),
        ("P6", "E6", "INTB", "5136", day(2023, 12, 31), day(2024, 1, 2), "DW"),
        ("P7", "E7", "INTB", "5136", day(2025, 1, 1), day(2025, 1, 2), "DW"),
        ("P8", "E8", "URGE", "5701", day(2024, 4, 1), day(2024, 4, 2), "C"),
    ]
    return spark.createDataFrame(rows, "patient string, stay string, um string, uf string, entry timestamp_ntz, exit timestamp_ntz, source string").withColumn("um_of_uf", F.col("um"))


def _year():
    return F.to_timestamp_ntz(F.lit("2024-01-01")), F.to_timestamp_ntz(F.lit("2025-01-01"))


def test_a_sites_stays_to_nights_and_exposure(spark):
    made = denominator.stay_handoff(_stays(spark), _reference(spark), *_year(), ["patient", "stay"])
    assert [tuple(r) for r in made["nights"].collect()] == [(2024, 31)]
    assert made["exposure"].agg(F.sum("exposure_value")).first()[0] == 32
    assert [(r["exposure_value"], r["domain"]) for r in made["exposure"].filter("uf = '5701'").collect()] == [(1, "URGENCES")]
    assert tuple(made["source_policy"].first()) == (6, 5) and tuple(made["window"].first()) == (0, 0, 1, 4)
    assert made["nights_by_unit"].count() == 2 and made["absent_units"].count() == 0
    assert {(r["patient"], r["only_emergency"]) for r in made["episodes"].collect()} == {("P1", False), ("P5", False), ("P6", False), ("P8", True)}


def test_units_without_a_reference_are_kept_and_reviewed(spark):
    rows = _stays(spark).withColumn("uf", F.when(F.col("patient") == "P5", "9999").otherwise(F.col("uf")))
    made = denominator.stay_handoff(rows, _reference(spark), *_year(), ["patient", "stay"])
    assert made["nights"].first()["hospital_nights"] == 30
    assert [tuple(r) for r in made["units"].filter("SEJUF = '9999'").collect()] == [("9999", None, None, None)]
    assert made["unit_stays"].filter("uf = '9999'").first()["unit_stay_status"] == "review_unmapped_uf"


def test_identities_raise(spark):
    a = spark.createDataFrame([(2024, 5)], "y int, n int")
    assert denominator.equal_or_raise(a, a, "y", "n", "x").first()["difference"] == 0
    for b in (a.withColumn("n", F.lit(6)), a.withColumn("y", F.lit(2023))):
        with pytest.raises(Exception, match="x differ for y 202"):
            denominator.equal_or_raise(a, b, "y", "n", "x").collect()


def test_conflicting_units_raise(spark):
    structure = spark.createDataFrame([("U", "l", "03", "1"), ("U", "l", "3", "01"), ("V", "l", "3", "1")], "SEJUF string, label string, CODE_TA string, CODE_DE string")
    none = spark.createDataFrame([], "CODE_TA string, LIBELLE_TA string"), spark.createDataFrame([], "DOMAINE string, CODE_DE string, LIBELLE_DE string")
    assert denominator.unit_reference(structure, *none).count() == 2
    with pytest.raises(Exception, match="different codes of unit V"):
        denominator.unit_reference(structure.union(structure.filter("SEJUF = 'V'").withColumn("CODE_TA", F.lit("9"))), *none).collect()


def test_attribution_without_fallback(spark):
    rows = spark.createDataFrame([("p", None, "own"), ("q", "s", "own")], "patient string, stay string, SEJUF string")
    found = spark.createDataFrame([("p", None, "assigned_hebergement", "r", "m", "u"), ("q", "s", "ambiguous_hebergement", "r", "m", "u")], "patient string, stay string, attribution_status string, attribution_reason string, hospitalization_um string, hospitalization_uf string")
    got = denominator.attributed(rows, found, ["patient", "stay"])
    assert {(r["patient"], r["SEJUF"]) for r in got.collect()} == {("p", "u"), ("q", None)}
    with pytest.raises(Exception, match="no partner"):
        denominator.attributed(rows, found.filter("patient = 'p'"), ["patient", "stay"]).collect()
    with pytest.raises(Exception, match="several rows"):
        denominator.attributed(rows, found.union(found), ["patient", "stay"]).collect()


def test_policy_and_scope(spark):
    assert denominator.policy(spark).count() == 7
    assert denominator.scope_of(_reference(spark)).filter("sample_uf_is_eligible_by_ta_de").count() == 2


def test_windows_cut_intervals(spark):
    got = stays.clip(_stays(spark), "entry", "exit", *_year())
    assert got.count() == 5 and got.filter("patient = 'P6'").first()["entry"] == dt.datetime(2024, 1, 1)


def test_decisions_go_before_patterns(spark):
    labels = spark.createDataFrame([("Urine  de sonde",), ("sang",), ("différé",), ("ambigu urine sang",), (None,), (" ",)], "x string")
    patterns = [("URINE", "urines"), ("SONDE", "urines"), ("SANG", "hemoculture")]
    decisions = spark.createDataFrame([("Sang", "map", "other"), ("DIFFERE", "defer", None)], "key string, action string, target string")
    got = {r["x"]: (r["mapping_state"], r["target"]) for r in rules.decided(labels, "x", patterns, decisions).collect()}
    assert got == {"Urine de sonde": ("multiple_patterns_same_target", "urines"), "sang": ("reviewed_override", "other"), "différé": ("review_deferred", None), "ambigu urine sang": ("multiple_canonical_targets", None)}
    for bad, text in ((("sang", "map", "x"), "two decisions for SANG"), (("y", "drop", "x"), "neither map nor defer"), (("y", "map", " "), "a map without target")):
        with pytest.raises(Exception, match=text):
            rules.decided(spark.createDataFrame([("sang",), ("y",)], "x string"), "x", patterns, decisions.union(spark.createDataFrame([bad], decisions.schema))).collect()


def test_phenotype_lines(spark):
    lines = [("k", "Recherche BLSE", "résultat", "Positive"), ("k", "x", "y", "carba-"), ("l", None, None, None), ("l", "x", "y", "BLSE+"), ("m", "x", "y", "kleb blse"), ("m", "x", "y", "oxa-48"), ("m", "x", "y", "oxa-481"), ("n", "x", "y", "rien"), ("o", "x", "y", "E.coli carba+")]
    frame = spark.createDataFrame(lines, "key string, a string, b string, c string")
    got = {r["key"]: tuple(r)[1:] for r in phenotype.lookup(frame, ["key"], "a", "b", "c").collect()}
    assert got == {"k": ("positive", "negative", True, False), "l": ("positive", "no_signal", True, False), "m": ("unknown", "positive", False, True), "n": ("no_signal", "no_signal", False, False), "o": ("no_signal", "unknown", False, False)}


def test_catalogue_from_a_file(spark, tmp_path):
    names = [*specs.COLUMNS, "publish_incidence"]
    row = dict.fromkeys(names, "") | {"indicator_id": "b", "wave": "1", "enabled": "Yes", "display_order": "2", "molecule_values": "x| y |x", "publish_incidence": "no"}
    lines = [";".join(names), ";".join(row[c] for c in names), ";".join((row | {"indicator_id": "a", "wave": "first", "display_order": "1", "publish_incidence": ""})[c] for c in names)]
    (tmp_path / "spec.csv").write_text("﻿" + "\n".join(lines) + "\n")
    got = specs.read(spark, f"file://{tmp_path}/spec.csv").collect()
    assert [(r["indicator_id"], r["wave"], r["enabled"], r["molecules"], r["publish_proportion"], r["publish_incidence"]) for r in got] == [("a", None, True, ["x", "y"], True, True), ("b", 1, True, ["x", "y"], True, False)]
    with pytest.raises(ValueError, match="lacks wave"):
        specs.typed(spark.createDataFrame([("a",)], "indicator_id string"))


def test_one_order_for_a_species(spark):
    pairs = spark.createDataFrame([("a", "X"), ("a", " X"), ("b", None), (None, "Y")], "bact_norm string, bact_order string")
    assert [tuple(r) for r in specs.species_orders(pairs).collect()] == [("a", "X")]
    with pytest.raises(Exception, match="several orders of a"):
        specs.species_orders(pairs.union(spark.createDataFrame([("a", "Z")], pairs.schema))).collect()
    with pytest.raises(ValueError, match="lacks hospital_nights"):
        specs.yearly_nights(spark.createDataFrame([(1,)], "calendar_year int"))
