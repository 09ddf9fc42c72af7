"""Every query of the library against its SQL, and operators on small tables."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from conftest import DATA, same
from pyspark.sql import functions as F

from strainflow.functions import text as X
from strainflow.operators import attribution, dedup, phenotype, stays
from strainflow import plans
from strainflow.plans import catalogue
from strainflow.sources import contracts, tables


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    same(catalogue.QUERIES[name](spark, str(DATA)), catalogue.ORACLE_SQL[name], DATA)


def test_every_query_has_sql():
    assert catalogue.QUERIES.keys() == catalogue.ORACLE_SQL.keys()


def test_entry_without_training_data(monkeypatch):
    import importlib.util

    import __spark_entry__

    found = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in ("strainflow.llm", "corpus_pipeline") else found(name, *a))
    assert __spark_entry__.queries().keys() == plans.QUERIES.keys()


def _one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_text_functions(spark):
    lit = F.lit
    row = _one(
        spark, X.sir(lit(" sfp ")).alias("a"), X.sir(lit("n/a")).alias("b"), X.sir(lit("I")).alias("c"), X.trim_or_null(lit(" \t\n")).alias("d"), X.strip_accents(lit("Éçà")).alias("e"), X.antibiotic_label(lit("Acide  Fusidique—x")).alias("f"),
        X.activity_code(lit("3")).alias("g"), X.activity_code(lit("123")).alias("h"), X.discipline_code(lit("000")).alias("i"), X.discipline_code(lit("0101")).alias("j"), X.flag(lit("Oui")).alias("k"), X.values(lit("a| b ||a")).alias("l"),
        X.genus(lit("Escherichia coli")).alias("m"), X.epithet(lit("Escherichia coli")).alias("n"), X.epithet(lit("Candida sp.")).alias("o"), X.domain_label(lit("medecine"), ["MÉDECINE"]).alias("p"),
    )
    assert list(row) == ["S", None, "ZIT", None, "Eca", "acide fusidique-x", "03", "123", "0", "101", True, ["a", "b"], "Escherichia", "coli", None, "MÉDECINE"]


def test_phenotype_priority(spark):
    lines = spark.createDataFrame([("Recherche BLSE", "résultat", "Positive", "positive"), ("x", "y", "non producteur de BLSE", "negative"), ("x", "y", "kleb blse uniquement", "unknown"), ("x", "y", None, None)], "a string, b string, c string, wanted string")
    got = phenotype.normalized(lines, "a", "b", "c").select(phenotype.blse(F.col("a"), F.col("b"), F.col("c")).alias("s"), "wanted").collect()
    assert [r["s"] for r in got] == [r["wanted"] for r in got]


def test_nights_split_at_new_year(spark):
    rows = spark.createDataFrame([(1, dt.datetime(2021, 12, 30, 23), dt.datetime(2022, 1, 2, 1)), (2, dt.datetime(2022, 5, 1, 1), dt.datetime(2022, 5, 1, 20))], "id int, a timestamp, b timestamp")
    got = stays.nights_by_year(rows, "a", "b").select("id", "calendar_year", "nights").collect()
    assert sorted(map(tuple, got)) == [(1, 2021, 2), (1, 2022, 1)]


def test_attribution_is_half_open_and_breaks_ties(spark):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    intervals = spark.createDataFrame([("p", "s", "m1", "u1", day(1), day(3)), ("p", "s", "m2", "u2", day(3), day(6)), ("p", "s", "m3", "u3", day(5), day(6)), (None, "s", "m", "u", day(1), day(9))], "patient string, stay string, um string, uf string, entry timestamp, exit timestamp")
    samples = spark.createDataFrame([("a", "p", "s", day(3), "m", "u"), ("b", "p", "s", day(5, 3), "m3", "u3"), ("c", "p", "s", day(5, 3), "x", "y"), ("d", "p", "s", day(6), "x", "y"), ("e", None, "s", day(2), "x", "y")], "sample string, patient string, stay string, moment timestamp, um string, uf string")
    got = attribution.attribute_units(samples, intervals, sample_id="sample", patient="patient", stay="stay", moment="moment", unit=("um", "uf"))
    found = {r["sample"]: (r["attribution_status"], r["hospitalization_um"]) for r in got.collect()}
    assert found == {"a": ("assigned_hebergement", "m2"), "b": ("assigned_hebergement", "m3"), "c": ("ambiguous_hebergement", None), "d": ("unassigned_hebergement", None), "e": ("unassigned_hebergement", None)}


def test_first_fit_classes(spark):
    rows = spark.createDataFrame([("g", "1", 1, "S", "R"), ("g", "2", 2, "R", None), ("g", "3", 3, None, "R"), ("g", "4", 4, "R", "S"), ("g", "5", 5, "ZIT", None)], "grp string, id string, o int, x string, y string")
    got = dedup.classes(rows, ["grp"], "id", ["x", "y"], [], [F.col("o")]).collect()
    assert {r["id"]: r["class_id"] for r in got} == {"1": 1, "2": 2, "3": 1, "4": 2, "5": 1}


def test_contract_and_bundle(spark, tmp_path):
    good = spark.createDataFrame([(2022, 10), (2023, 12)], "calendar_year int, hospital_nights bigint")
    assert contracts.DENOMINATOR.validate(good) == ([], [])
    bad = spark.createDataFrame([(2022, -1), (2022, None)], "calendar_year int, hospital_nights bigint")
    errors, _ = contracts.DENOMINATOR.validate(bad)
    assert len(errors) == 3
    folder = f"file://{tmp_path}/bundle"
    tables.write_bundle(spark, folder, {"nights": good}, {"version": 2})
    found, meta = tables.read_bundle(spark, folder)
    assert meta == {"version": 2} and contracts.differences(found["nights"], good).count() == 0
    with pytest.raises(FileExistsError):
        tables.write_bundle(spark, folder, {"nights": good}, {})
    with pytest.raises(FileNotFoundError):
        tables.read_bundle(spark, f"file://{tmp_path}")


def test_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿a;b\n1; x \n2;\n")
    got = tables.read_delimited(spark, f"file://{tmp_path}/a.csv")
    assert [tuple(r) for r in got.select("a", "b").orderBy("a").collect()] == [("1", "x"), ("2", None)]


def test_tables_of_a_task_are_bounded(spark):
    """Partitions of an aggregate with as many groups as rows grow in number with the rows."""
    from strainflow.sources.stage import ROWS, dealt

    frame = spark.range(10)
    assert dealt(frame, 10, "id").rdd.getNumPartitions() == 4
    assert dealt(frame, 9 * ROWS + 1, "id").rdd.getNumPartitions() == 10
    for query in (catalogue.nights_by_year_and_unit, catalogue.wide_isolates):
        assert "REPARTITION_BY_NUM" in query(spark, str(DATA))._jdf.queryExecution().executedPlan().toString()


def test_tasks_hold_no_more_of_larger_tables(spark, monkeypatch):
    """Numbering, the join with orders and the wide table's groups take as many partitions as rows ask for."""
    from strainflow.sources import stage

    monkeypatch.setattr(stage, "ROWS", 500)
    n = -(-catalogue._t(spark, str(DATA), "lineitem").count() // 500)
    assert n > 4 and len(catalogue.numbered_lines(spark, str(DATA)).select("row_order").inputFiles()) == n
    plan = catalogue.wide(spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f", {n}\n") == 2, plan


def test_stays_in_units_are_joined_in_as_many_partitions_as_rows_ask_for(spark, monkeypatch):
    from strainflow.sources import stage

    monkeypatch.setattr(stage, "ROWS", 500)
    n = -(-catalogue._t(spark, str(DATA), "lineitem").count() // 500)
    plan = catalogue._intervals(spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert n > 4 and plan.count(f", {n}\n") == 1, plan


def test_joins_of_large_parts_and_suppliers_take_as_many_partitions_as_rows_ask_for(spark, monkeypatch):
    """of the shared wide table's joins, those with tables that aren't broadcast."""
    from strainflow.plans import catalogue
    from strainflow.sources import stage

    monkeypatch.setattr(stage, "ROWS", 500)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = stage.partitions(spark, catalogue._t(spark, str(DATA), "lineitem").count())
        plan = catalogue.wide(spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert n > 4
    for key in ("l_partkey", "p_partkey", "l_suppkey", "s_suppkey"):
        assert re.findall(rf"hashpartitioning\({key}#\w+, (\d+)\)", plan) == [str(n)], key
