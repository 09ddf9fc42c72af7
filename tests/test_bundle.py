"""The canonical bundle: its queries against SQL, the builders and validators on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import DATA, same
from pyspark.sql import functions as F

from strainflow.operators import dedup, handoff, isolates, numbering, runtime
from strainflow.plans import bundle
from strainflow.sources import contracts, validation
from strainflow.sources.stage import staged


@pytest.mark.parametrize("name", bundle.QUERIES)
def test_sql(spark, name):
    same(bundle.QUERIES[name](spark, str(DATA)), bundle.ORACLE_SQL[name], DATA)


OBS = "PATID string, EVTID string, ELTID string, DATEPRELEV string, HEUREPRELEV string, SEJUF string, souche_id string, bacteria_local string, sample_type_local string, antibiotic_local string, sir_result string, ratb_diagnostic_scope boolean, blse_status_row string, carbapenemase_status_row string, handoff_row_order bigint"


def _observation(patient, stay, sample, shown, result="S", blse=None, carba=None, **more):
    return {"PATID": patient, "EVTID": stay, "ELTID": sample, "DATEPRELEV": "2024-01-15", "HEUREPRELEV": "09:00", "SEJUF": "UF1", "souche_id": "1", "bacteria_local": "E. coli", "sample_type_local": "Urine", "antibiotic_local": "Cefotaxime", "sir_result": result, "ratb_diagnostic_scope": shown, "blse_status_row": blse, "carbapenemase_status_row": carba} | more


#: Sample ids that patients and stays share, with screening documents among them.
SITE = [
    _observation("P1", "E_SHARED", "REUSED", False),
    _observation("P2", "E_SHARED", "REUSED", True),
    _observation("P3", "E_SCREEN", "SAME_PATIENT", False),
    _observation("P3", "E_KEEP", "SAME_PATIENT", True),
    _observation("P4", "E_MIXED", "MIXED", False),
    _observation("P4", "E_MIXED", "MIXED", True),
    _observation("P5", None, "LEGACY", False),
    _observation("P5", "E_LEGACY", "LEGACY", True),
    _observation("P6", "E_CONTROL", "CONTROL", True),
    _observation("P7", "E_OTHER", "LEGACY", True),
    _observation("P8", "E_MULTI", "MULTI_ROW", True, "S", "negative", "unknown"),
    _observation("P8", "E_MULTI", "MULTI_ROW", True, "R", "positive", "negative"),
]


def _wide(spark, rows=SITE, drop=(), names=contracts.ANTIBIOTICS, types="sample_type_local string, naturepvt_norm string", type_rows=(("Urine", "urines"),)):
    obs = spark.createDataFrame([tuple((r | {"handoff_row_order": k})[c.split()[0]] for c in OBS.split(", ")) for k, r in enumerate(rows)], OBS).drop(*drop)
    maps = spark.createDataFrame([("E. coli", "Escherichia coli")], "bacteria_local string, bact_norm string"), spark.createDataFrame(list(type_rows), types), spark.createDataFrame([("Cefotaxime", "cefotaxime"), ("Other", "unheard_of")], "antibiotic_local string, atb_norm string")
    return handoff.wide_isolates(obs, *maps, names=names)


def test_screening_documents_by_patient_stay_and_sample(spark):
    assert sorted((r["PATID"], r["EVTID"], r["ELTID"]) for r in _wide(spark).collect()) == [("P2", "E_SHARED", "REUSED"), ("P3", "E_KEEP", "SAME_PATIENT"), ("P6", "E_CONTROL", "CONTROL"), ("P7", "E_OTHER", "LEGACY"), ("P8", "E_MULTI", "MULTI_ROW")]
    assert sorted((r["PATID"], r["EVTID"]) for r in _wide(spark, drop=["EVTID"]).collect()) == [("P2", None), ("P6", None), ("P7", None), ("P8", None)]


def test_last_result_and_strongest_status_win(spark):
    wide = _wide(spark)
    row = wide.filter("PATID = 'P8'").collect()
    assert len(row) == 1 and (row[0]["cefotaxime"], row[0]["nb_resultats"], row[0]["blse_status_row"], row[0]["carbapenemase_status_row"], row[0]["blse_flag"], row[0]["carbapenemase_flag"]) == ("R", 1, "positive", "negative", True, False)
    assert row[0]["HEUREPRELEV"] == 9 * 3600 and row[0]["DATEPRELEV"] == dt.date(2024, 1, 15) and row[0]["SEJUF"] == "UF1"
    assert wide.columns[:10] == ["PATID", "EVTID", "ELTID", "DATEPRELEV", "HEUREPRELEV", "souche_id", "nb_resultats", "naturepvt_norm", "bact_norm", "SEJUF"] and wide.columns[10:45] == contracts.ANTIBIOTICS
    assert "SortAggregate" not in wide._jdf.queryExecution().executedPlan().toString()
    meta = handoff.wide_meta(wide, "test")
    assert meta["atb_cols"] == ["cefotaxime"] and meta["sir_wide_n_rows"] == meta["sir_wide_n_eltid"] == 5


def test_derived_isolates_gaps_and_deferred_types(spark):
    rows = [_observation("P1", None, "A", True, souche_id=" ", sample_type_local="Deferred", HEUREPRELEV=None, SEJUF=None), _observation("P1", None, "A", True, result="NC", souche_id=None, sample_type_local="Deferred")]
    got = _wide(spark, rows, type_rows=(("Urine", "Urinés"), ("Deferred", None))).collect()
    assert [(r["souche_id"], r["naturepvt_norm"], r["SEJUF"], r["HEUREPRELEV"], r["cefotaxime"]) for r in got] == [("derived__missing_sample_type__Escherichia coli", None, "UF1", 32400, "S")]


@pytest.mark.parametrize(
    ("change", "text"),
    [
        ({"SEJUF": "UF2"}, "different values of SEJUF"),
        ({"HEUREPRELEV": "10:00"}, "different values of HEUREPRELEV"),
        ({"HEUREPRELEV": "soon"}, "not a time"),
        ({"DATEPRELEV": None}, "DATEPRELEV may not be missing"),
        ({"PATID": " "}, "PATID may not be missing"),
        ({"bacteria_local": "unknown"}, "isn't mapped: unknown"),
        ({"antibiotic_local": "Other"}, "not an antibiotic column"),
        ({"sir_result": "Q"}, "not a susceptibility result"),
        ({"blse_status_row": "maybe"}, "not a status"),
        ({"ratb_diagnostic_scope": None}, "must say true or false"),
    ],
)
def test_what_a_site_may_not_send(spark, change, text):
    with pytest.raises(Exception, match=text):
        _wide(spark, [SITE[8], SITE[8] | change], names=["cefotaxime"]).collect()


def test_ambiguous_mappings_raise(spark):
    frame = spark.createDataFrame([("a",)], "x string")
    pairs = lambda *rows: spark.createDataFrame(list(rows), "k string, v string")
    assert handoff.mapped(frame, "x", pairs((" a", "1"), ("a", "1"), (None, "2")), "k", "v", "y").first()["y"] == "1"
    for rows, text in (((("a", "1"), ("a", "2")), "several values"), ((("a", "1"), ("a", None)), "several values|no value"), ((("a", " "),), "no value"), ((("b", "1"),), "isn't mapped")):
        with pytest.raises(Exception, match=text):
            handoff.mapped(frame, "x", pairs(*rows), "k", "v", "y").collect()


def test_scope_exposure_and_nights(spark):
    units = spark.createDataFrame([("U1", "3", "0101", "médecine"), ("U2", "11", "1", None), ("U3", None, None, "X")], "SEJUF string, CODE_TA string, CODE_DE string, de_domain_ref string")
    got = {r["SEJUF"]: tuple(r)[1:] for r in handoff.scope_reference(units).collect()}
    assert got["U1"] == ("03", "101", "MÉDECINE", True, "eligible_ta_de", "eligible_ta_de") and got["U2"][4] == "excluded_ta" and got["U3"][4] == "review_unmapped_uf"
    with pytest.raises(Exception, match="several rows for unit U1"):
        handoff.scope_reference(units.union(units.limit(1))).collect()
    schema = "calendar_year string, SEJUM string, SEJUF string, CODE_TA string, CODE_DE string, de_domain_ref string, denominator_profile_id string, exposure_value string, exposure_unit string"
    good = [("2024", "M", "U1", "3", "101", "medecine", "midnight_presence", "60", "patient_days"), ("2024", "M", "U2", "20", "101", "CHIRURGIE", "midnight_presence", "40.0", "patient_days"), ("2025", "M", "U1", "03", "101", "MÉDECINE", "midnight_presence", "75", "patient_days")]
    made = handoff.exposure_table(spark.createDataFrame(good, schema), handoff.PROFILES)
    nights = made.groupBy("calendar_year").agg(F.sum("exposure_value").alias("n")).collect()
    assert {r["calendar_year"]: r["n"] for r in nights} == {2024: 100, 2025: 75}
    for bad, text in ((("2024", "M", "U1", "3", "101", "Médecine", "midnight_presence", "1", "patient_days"), "twice"), ((*good[0][:7], "1.5", "patient_days"), "whole"), ((*good[0][:7], "-1", "patient_days"), "negative"), ((*good[0][:8], "beds"), "no such profile"), (("2023", None, *good[0][2:]), "may not be missing")):
        with pytest.raises(Exception, match=text):
            handoff.exposure_table(spark.createDataFrame([*good, bad], schema), handoff.PROFILES).collect()
    with pytest.raises(Exception, match="negative"):
        handoff.nights_table(spark.createDataFrame([(2024, -1)], "calendar_year int, hospital_nights int")).collect()
    tables, meta = handoff.bundle(staged(_wide(spark), "wide"), units, nights=spark.createDataFrame([(2024.0, 5)], "calendar_year double, hospital_nights int"))
    assert validation.bundle_report(spark, tables, meta | {"created_at": "2024-01-01"}, "v2").filter("n > 0").count() == 0


def _found(report):
    return {(r["table_name"], r["check_name"]): (r["n"], r["examples"]) for r in report.filter("n > 0").collect()}


def test_every_check_of_a_bundle_finds_its_row(spark):
    wide = staged(_wide(spark), "wide")
    units = spark.createDataFrame([("UF1", "3", "1", "MÉDECINE"), ("UF2", "3", "1", "MÉDECINE")], "SEJUF string, CODE_TA string, CODE_DE string, de_domain_ref string")
    rows = spark.createDataFrame([("2024", "M", "UF1", "3", "1", "MÉDECINE", "midnight_presence", "5", "patient_days")], "calendar_year string, SEJUM string, SEJUF string, CODE_TA string, CODE_DE string, de_domain_ref string, denominator_profile_id string, exposure_value string, exposure_unit string")
    tables, meta = handoff.bundle(wide, units, exposure=rows)
    meta["created_at"] = "2024-01-01"
    clean = validation.bundle_report(spark, tables, meta)
    assert _found(clean) == {} and clean.count() > 60
    for name, contract in validation.BUNDLES["v3"].items():
        empty = tables[name].withColumns({c: F.lit(None).cast(dict(tables[name].dtypes)[c]) for c in contract.not_null})
        wanted = {(name, f"{c}: is null") for c in contract.not_null}
        assert _found(validation.report(spark, [validation.breaches(name, empty, validation.checks(contract, empty.columns))], sorted(wanted))).keys() == wanted
    odd = tables | {
        "sir_wide": wide.union(wide.limit(1)).withColumns({"cefotaxime": F.lit("X"), "blse_status_row": F.lit("unknown"), "more": F.lit(1), "SEJUF": F.lit(3)}).drop("oxacilline"),
        "sample_scope_reference": tables["sample_scope_reference"].withColumns({"sample_uf_ta_de_status": F.lit("?"), "sample_uf_ta_de_reason": F.lit("?"), "sample_CODE_DE": F.when(F.col("SEJUF") == "UF1", "9"), "sample_uf_is_eligible_by_ta_de": F.lit(False)}),
        "exposure": tables["exposure"].withColumns({"exposure_value": F.lit(-1), "exposure_unit": F.lit("beds")}).union(tables["exposure"].withColumn("SEJUF", F.lit("UF9"))).union(tables["exposure"].withColumn("SEJUF", F.lit("UF9"))),
    }
    found = _found(validation.bundle_report(spark, odd, meta | {"contract_version": "v2", "atb_cols": ["q"], "sir_wide_n_rows": 9, "filtre_atb": [], "created_at": "", "artifact_version": "4"}))
    wanted = {
        ("sir_wide", "column: missing"): 1, ("sir_wide", "column: type"): 1, ("sir_wide", "cefotaxime: not one of the allowed values"): 6, ("sir_wide", "blse_status_row: not one of the allowed values"): 6, ("sir_wide", validation.GRAIN): 1,
        ("sir_wide", "meta: value"): 5, ("sir_wide", "sir_wide_n_rows: not as stated"): 1, ("sample_scope_reference", "sample_uf_ta_de_status: not one of the allowed values"): 2, ("sample_scope_reference", "sample_uf_ta_de_reason: not one of the allowed values"): 2,
        ("exposure", "exposure_value: negative"): 1, ("exposure", "denominator_profile_id, exposure_unit: not an allowed pair"): 1, ("exposure", validation.GRAIN): 1, ("exposure", "SEJUF: not in the scope"): 2,
        ("exposure", "SEJUF: codes differ from the scope"): 1, ("exposure", "SEJUF: eligibility differs from the context"): 1,
    }
    assert {k: v[0] for k, v in found.items()} == wanted
    assert found["exposure", "SEJUF: not in the scope"][1] == ["UF9"]
    lacking = _found(validation.bundle_report(spark, {"sir_wide": wide}, {}))
    assert lacking["exposure", "table: missing"][0] == 1 and lacking["sir_wide", "meta: missing"][0] == len(validation.META_FIELDS)


def test_ten_least_examples(spark):
    rows = spark.range(1000).select((F.col("id") % 50).cast("int").alias("v")).repartition(7)
    got = validation.report(spark, [validation.breaches("t", rows, [validation.Check("c", F.col("v") >= 5, F.lpad(F.col("v").cast("string"), 2, "0"))])], [("t", "c"), ("t", "never")])
    assert {r["check_name"]: (r["n"], r["examples"]) for r in got.collect()} == {"c": (900, [f"{k:02d}" for k in range(5, 15)]), "never": (0, [])}


def test_breaches_are_found_once(spark):
    """A report ranks and sums what one job found and wrote."""
    rows = spark.range(9).select(F.col("id").cast("string").alias("v"))
    some = validation.breaches("t", rows, [validation.Check("c", F.col("v") >= "5", F.col("v"))])
    report = validation.report(spark, [some], [("t", "c")])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(array_compact" not in plan and plan.count("Relation [table_name") == 2, plan
    assert [(r["n"], r["examples"]) for r in report.collect()] == [(4, ["5", "6", "7", "8"])]


def test_written_plans_run_in_methods_that_are_compiled(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    name, seen, write = "spark.sql.codegen.hugeMethodLimit", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(int(spark.conf.get(name))), write(self, *a, **k)))
    before = spark.conf.get(name)
    assert staged(spark.range(3), "few").count() == 3 and seen == [8000] and spark.conf.get(name) == before


def test_runtime_inputs(spark):
    scoped = spark.createDataFrame([("P", "E", "L", "U", True, "s", "r"), ("Q", None, "L", "U", None, "s", "r")], ", ".join(f"{c} {'boolean' if 'eligible' in c else 'string'}" for c in validation.RUNTIME_SCOPE))
    nights = spark.createDataFrame([(2024, 5)], "calendar_year int, hospital_nights bigint")
    good = validation.runtime_report(spark, scoped, scoped, scoped.limit(1), nights)
    assert _found(good) == {}
    bad = spark.createDataFrame([(2024.5, 5), (2024.5, -1), (None, None)], "calendar_year double, hospital_nights bigint")
    exposure = spark.createDataFrame([("U",)], "SEJUF string")
    found = {k: v[0] for k, v in _found(validation.runtime_report(spark, scoped.limit(1), scoped, scoped.union(scoped).drop("SEJUF"), bad, exposure)).items()}
    assert found == {
        ("analytic", "column: missing"): 1, ("analytic", "row: not eligible"): 2, ("scope", "rows: not those of sir_wide"): 1, ("analytic", "rows: more than in scope"): 1, ("denominator", "calendar_year: not a whole number"): 2,
        ("denominator", "calendar_year: is null"): 1, ("denominator", "hospital_nights: is null"): 1, ("denominator", "hospital_nights: negative"): 1, ("denominator", validation.GRAIN): 1, ("exposure", "column: missing"): 8,
    }


def test_signals_without_a_candidate(spark):
    signals = spark.createDataFrame([("P", None), ("Q", "s")], "p string, s string")
    report = validation.report(spark, [validation.signal_breaches("signals", signals, signals.filter("p = 'P'"), ["p", "s"])], [("signals", "signal: no candidate isolate")])
    assert _found(report) == {("signals", "signal: no candidate isolate"): (1, ["Q|s"])}


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_numbers_over_any_ranges(spark, ranges):
    rows = spark.range(500).select((F.col("id") * 7 % 500).alias("v"), F.when(F.col("id") % 3 != 0, F.col("id") % 2).alias("hot"))
    got = numbering.numbered(rows.repartition(5), [F.col("hot").asc_nulls_last(), "v"], "n", ranges).collect()
    assert [r["n"] for r in sorted(got, key=lambda r: (r["hot"] is None, r["hot"] or 0, r["v"]))] == list(range(1, 501))
    assert numbering.numbered(rows.limit(0), ["v"], "n").count() == 0


def test_columns_that_hold_results(spark):
    frame = spark.createDataFrame([("S", None, "x", 1, "R"), ("ZIT", None, "S", 2, None)], "a string, b string, c string, d int, e string")
    assert isolates.result_columns(frame) == ["a", "e"] and isolates.result_columns(frame, known=["e", "z"]) == ["e", "a"]
    assert isolates.result_columns(frame, ["c", "e"]) == ["e"] and isolates.result_columns(frame.select("d")) == []


def test_packed_cells_keep_the_last(spark):
    frame = spark.createDataFrame([(5, "S"), (7, None), (6, "ZIT"), (2**60, "R")], "o bigint, v string")
    cells = frame.select(isolates.packed(F.col("v"), F.col("o")).alias("c"))
    assert [r[0] for r in cells.orderBy(F.desc_nulls_last("c")).select(isolates.unpacked(F.col("c"))).collect()] == ["R", "ZIT", "S", None]
    with pytest.raises(Exception, match="not a susceptibility result: I"):
        frame.select(isolates.packed(F.lit("I"), F.col("o"))).collect()


def test_classes_of_two_species_and_scopes(spark):
    """The same day's isolates of two species never hide each other; within a species the first conflicting one opens a class."""
    rows = [("L1", "coli", "urines", "S", None), ("L2", "coli", "blood", None, "S"), ("L3", "coli", "urines", "R", "R"), ("L4", "aureus", "urines", "S", None)]
    frame = spark.createDataFrame([("P", 2024, k, *r) for k, r in enumerate(rows)], "patient string, year int, o int, id string, species string, sample_type string, a string, b string")
    scopes = {"global": ["patient", "year", "species"], "by_type": ["patient", "year", "species", "sample_type"]}
    found = runtime.scoped_classes(frame, scopes, "id", ["a", "b"], [], [F.col("o")])
    got = {(r["scope"], r["id"]): r["class_id"] for r in found.collect()}
    assert got == {("global", "L1"): 1, ("global", "L2"): 1, ("global", "L3"): 2, ("global", "L4"): 1, ("by_type", "L1"): 1, ("by_type", "L2"): 1, ("by_type", "L3"): 2, ("by_type", "L4"): 1}


def test_statuses_count_and_represent(spark):
    """A positive status conflicts with a negative one; a class's representative is positive if a member is."""
    frame = spark.createDataFrame([("g", "1", 1, "S", "positive"), ("g", "2", 2, None, "negative"), ("g", "3", 3, "S", "positive")], "grp string, id string, o int, a string, s string")
    got = dedup.classes(frame, ["grp"], "id", ["a"], ["s"], [F.col("o")])
    assert {r["id"]: r["class_id"] for r in got.collect()} == {"1": 1, "2": 2, "3": 1}
    named = frame.join(got.drop("grp"), "id")
    kept = {r["class_id"]: (r["id"], r["s"]) for r in dedup.representatives(named, ["grp"], "class_id", [F.col("o")], ["s"]).collect()}
    assert kept == {1: ("1", "positive"), 2: ("2", "negative")}


def test_null_stays_have_no_rank_and_days_are_needed(spark):
    frame = spark.createDataFrame([(1, None, 1), (1, "a", 2), (1, "b", 3)], "g int, stay string, document int")
    got = {r["document"]: (r["evt_order"], r["elt_order"]) for r in runtime.ranks(frame, ["g"], "stay", "document", [F.col("document")]).collect()}
    assert got == {1: (None, 1), 2: (1, 1), 3: (2, 1)}
    with pytest.raises(Exception, match="a row without day"):
        runtime.raw_dataset(spark.createDataFrame([("p", "s", None)], "patient string, stay string, day date"), "patient", "stay", "day").collect()


def test_cleaned_once(spark):
    """The plan of the wide table cleans no text of the observations and parses no date: these are written before."""
    plan = bundle.contract_isolates(spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan.lower() and "HEUREPRELEV#" not in plan.split("Relation", 1)[1]


def test_times_and_blanks(spark):
    from pyspark.sql import functions as F

    from strainflow.functions import text as X
    from strainflow.functions import time as D

    texts = [" 9:05", "10:30:15 ", "\t1:02:03\n", "9:5", "1:2:3", "x", " ", None, "2024-01-31", " 31/01/2024 ", "19753", "1-2"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k")
    assert [r[0] for r in frame.select(D.seconds(F.col("t"))).collect()][:8] == [32700, 37815, 3723, None, None, None, None, None]
    assert [str(r[0]) for r in frame.select(D.tried_date(F.col("t"))).collect()][8:] == ["2024-01-31", "2024-01-31", "2024-01-31", "None"]
    assert [r[0] for r in frame.select(X.trim_or_null(F.col("t"))).collect()][2:7] == ["1:02:03", "9:5", "1:2:3", "x", None]
