"""Report tables, taxonomy, families and the projection of bundles: queries against SQL, rules on small tables."""

from __future__ import annotations

import pytest
from conftest import DATA, same
from pyspark.sql import functions as F

from strainflow.functions import labels
from strainflow.operators import handoff, indicators, report, rules, runtime
from strainflow.plans import report as plan
from strainflow.sources import validation

PANEL = "dataset string, indicator_label string, sample_type string, n_tested int, n_resistant int, pct_resistant double, density double"


@pytest.mark.parametrize("name", plan.QUERIES)
def test_sql(spark, name):
    same(plan.QUERIES[name](spark, str(DATA)), plan.ORACLE_SQL[name], DATA)


def test_proportion_cells(spark):
    rows = [("a", "x", "U", 0, 0, None, 0.0), ("a", "y", "V", 9, 1, 11.1, 1.0), ("b", "x", "U", 400, 49, 12.25, 0.125), ("c", "z", "W", 16, 1, 6.25, None), ("a", "x", None, 1000, 1, 0.1, 12345.678)]
    panel = spark.createDataFrame(rows, PANEL)
    got = report.proportion_cells(panel, 10, ["A", "b"], ["x", "y"], {"a": "A"}, ["U", "V"]).collect()
    # numbers between two go to the even digit, as their binary value says
    assert [r["cell"] for r in got] == ["n=0", "n=9", "12.2%\n(n=400)", "6.2%\n(n=16)", "0.1%\n(n=1000)"]
    assert [r["pct_shown"] for r in got] == [None, None, 12.25, 6.25, 0.1]
    assert [(r["dataset_label"], r["dataset_place"], r["indicator_place"]) for r in got] == [("A", 1, 2), ("A", 1, 1), ("b", 2, 2), (None, None, None), ("A", 1, 2)]
    assert [(r["panel_label"], r["panel_place"]) for r in got] == [("U\nA", 1), ("V\nA", 3), ("U\nb", 2), (None, None), (None, None)]
    cells = [r["cell"] for r in report.incidence_cells(panel, ["A", "b"], ["x", "y"], {"a": "A"}).collect()]
    assert cells == ["0.00\n(R=0)", "1.00\n(R=1)", "0.12\n(R=49)", "NA\n(R=1)", "12345.68\n(R=1)"]
    assert [r["cell"] for r in report.proportion_cells(panel, -3, [], [], {}).collect()][:2] == ["n=0", "11.1%\n(n=9)"]
    assert report.proportion_cells(panel.limit(0), 10, ["A"], ["x"], {}, ["U"]).collect() == []


def test_labels_of_nulls(spark):
    none = F.lit(None).cast("string")
    row = spark.range(1).select(labels.indicator_kind(none, none, none).alias("a"), labels.publication_metric(F.lit(None).cast("boolean"), F.lit(None).cast("boolean")).alias("b"), labels.publication_view(none, none).alias("c"), labels.notes(none, {}).alias("d")).first()
    assert list(row) == [None, "non publié", None, None]


def test_taxonomy_edges(spark):
    rows = spark.createDataFrame([("  Escherichia   coli ",), ("klebsiella sp.",), ("X ou Y",), (None,), ("",), ("antibiogramme",), ("Levure",)], "label string")
    taxa = [("(?i)^escherichia coli", "escherichia_coli", "bacterium", None, "Enterobacteriaceae", "Enterobacterales"), ("(?i)antibiogramme", None, "noise", None, None, None), ("(?i)levure", None, "fungus", "Levure", None, None), ("(?i)^x", "x_x", "bacterium", "X", "Xaceae", "Xales")]
    got = {r["label"]: tuple(r)[1:] for r in rules.taxonomy(rows, "label", taxa).collect()}
    assert got["  Escherichia   coli "] == ("bacterium", "Escherichia", "Enterobacteriaceae", "Enterobacterales", "escherichia_coli", True)
    assert got["klebsiella sp."] == ("bacterium", "klebsiella", None, None, "klebsiella_spp", True)
    assert got["X ou Y"] == ("ambiguous", None, None, None, None, False)
    assert got[None] == ("bacterium", None, None, None, None, False) == got[""]
    assert got["antibiogramme"] == ("noise", None, None, None, None, False)
    assert got["Levure"] == ("fungus", "Levure", None, None, None, True)
    assert rules.taxonomy(rows, "label", []).filter("bact_matched").count() == 4  # two species, a word each of the last two


def test_families_first_entry(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "atb_norm string")
    got = [tuple(r) for r in rules.families(rows, [("a", "F1", None), ("a", "F2", "S"), (None, "F3", "S")]).collect()]
    assert got == [("a", "F1", None), ("b", None, None), (None, None, None)]
    assert [tuple(r) for r in rules.families(rows, []).collect()] == [("a", None, None), ("b", None, None), (None, None, None)]


def test_projection_to_version2(spark):
    tables, meta = plan._exposed(spark, str(DATA))
    out, told = handoff.to_version2(spark, tables, meta)
    assert told["contract_version"] == "v2" and told["handoff_source"] == "external_handoff_v3_projection" and told["created_at"] == meta["created_at"]
    assert out["sample_scope_reference"].columns == ["SEJUF", "sample_uf_is_eligible_by_ta_de", "sample_uf_ta_de_status", "sample_uf_ta_de_reason"]
    assert validation.bundle_report(spark, out, told, "v2").filter("n > 0").collect() == []
    lacking = tables | {"sample_scope_reference": tables["sample_scope_reference"].filter("SEJUF <> 'UF2'")}
    broken = lacking | {"exposure": tables["exposure"].withColumn("exposure_value", -F.col("exposure_value"))}
    with pytest.raises(ValueError, match="exposure_value: negative.*SEJUF: not in the scope"):
        handoff.to_version2(spark, broken, meta)
    with pytest.raises(ValueError, match="table: missing"):
        handoff.to_version2(spark, {k: v for k, v in tables.items() if k != "exposure"}, meta)


def test_modern_names(spark):
    old = spark.createDataFrame([(2024, 7, "x")], "calendar_year int, hospital_nights_provisional int, more string")
    assert handoff.modern(old, handoff.LEGACY_NIGHTS).collect() == [(2024, 7)]
    assert handoff.modern(old.drop("calendar_year"), handoff.LEGACY_NIGHTS).columns == ["hospital_nights_provisional", "more"]


def test_legacy_report(spark):
    wide = spark.createDataFrame([("a", "S"), ("a", "R"), (None, "S")], "ELTID string, cefotaxime string")
    meta = {"artifact_version": 1, "created_at": "x", "sir_wide_n_rows": 3, "sir_wide_n_eltid": 2, "atb_cols": ["cefotaxime"], "filtre_atb": []}
    faults = lambda df, m: {r["check_name"]: r["examples"] for r in validation.legacy_report(spark, df, m).filter("n > 0").collect()}
    assert faults(wide, meta) == {}  # a missing document counts as one
    assert faults(wide, meta | {"sir_wide_n_rows": 4, "supported_atb_cols": ["x"]}) == {"sir_wide_n_rows: not as stated": ["3, not 4"], "supported_atb_cols: no such column": ["x"]}
    assert faults(wide.drop("ELTID"), meta) == {"column: missing": ["ELTID"]}
    assert faults(wide.limit(0), {}) == {"meta: missing": sorted(validation.LEGACY_FIELDS)}


def test_published_incidence(spark):
    panel = spark.createDataFrame([("a", 2021, 10.0, 1.0), ("a", 2022, 10.0, 2.0), ("b", 2023, None, None), ("b", 2024, 0.0, None)], "indicator_id string, calendar_year int, nights double, density double")
    kept = indicators.published_incidence(panel, "calendar_year", [2021, 2023, 2024])
    assert [r["calendar_year"] for r in kept.collect()] == [2022]
    for left_in in ([2021], [2024], []):
        with pytest.raises(Exception, match="an incidence without nights or density"):
            indicators.published_incidence(panel, "calendar_year", left_in).collect()
    assert indicators.published_incidence(panel.limit(0), "calendar_year", [2021]).collect() == []


def test_populations(spark):
    got = runtime.populations({"all": spark.range(5), "none": spark.range(0)}).collect()
    assert [tuple(r) for r in got] == [("all", 1, 5), ("none", 2, 0)]
    with pytest.raises(ValueError, match="no stages"):
        runtime.populations({})
