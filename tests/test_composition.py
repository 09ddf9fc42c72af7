"""Queries of the composition operators against their SQL, and what raises."""

from __future__ import annotations

import datetime

import pytest
from conftest import DATA, same
from pyspark.sql import functions as F

from strainflow.functions import text as X
from strainflow.functions import time as D
from strainflow.operators import episodes, indicators, joins, rules, runtime, stays
from strainflow.plans import composition


@pytest.mark.parametrize("name", composition.QUERIES)
def test_sql(spark, name):
    same(composition.QUERIES[name](spark, str(DATA)), composition.ORACLE_SQL[name], DATA)


def test_joins_raise(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (None, "q")], "k int, y string")
    got = {(r["k"], r["x"], r["y"]) for r in joins.many_to_one(left, right, ["k"], required=True).collect()}
    assert got == {(1, "a", "p"), (None, "b", "q")}
    with pytest.raises(Exception, match="several rows"):
        joins.many_to_one(left, right.union(right), ["k"]).collect()
    with pytest.raises(Exception, match="no partner"):
        joins.many_to_one(left, right.filter("k = 1"), ["k"], required=True).collect()


def test_unclear_stays_raise(spark):
    rows = [(1, 1, None), (1, 1, "a"), (1, 2, "a"), (1, 2, "b"), (2, 1, None), (None, 1, None), (None, 1, "c")]
    frame = spark.createDataFrame(rows, "p int, d int, s string")
    assert sorted((r["s"] or "" for r in runtime.resolve_stays(frame, "p", "d", "s").collect())) == ["", "a", "a", "a", "b", "c", "c"]
    with pytest.raises(Exception, match="without a stay"):
        runtime.resolve_stays(frame.union(spark.createDataFrame([(1, 2, None)], frame.schema)), "p", "d", "s").collect()


def test_given_stay_order_wins(spark):
    frame = spark.createDataFrame([(1, "a", 1, 5), (1, "b", 2, None), (1, "b", 3, None)], "g int, stay string, document int, given int")
    got = {(r["stay"], r["document"]): (r["evt_order"], r["elt_order"]) for r in runtime.ranks(frame, ["g"], "stay", "document", [F.col("document")], "given").collect()}
    assert got == {("a", 1): (5, 1), ("b", 2): (2, 1), ("b", 3): (2, 2)}


def test_codes_dates_and_choices(spark):
    one = spark.range(1)
    assert one.select(*[X.activity_code(F.lit(c)) for c in ("003", "3", "123", "0", "A3")]).first()[:] == ("03", "03", "123", "00", "A3")
    day = datetime.date(2024, 2, 1)
    assert one.select(*[D.date(F.lit(c)) for c in ("2024-02-01", "01/02/2024", "19754", "")]).first()[:] == (day, day, day, None)
    with pytest.raises(Exception, match="not a date"):
        one.select(D.date(F.lit("soon"))).collect()
    labels = spark.createDataFrame([("Escherichia coli (ou Klebsiella)",), ("E. coli/ou autre",), ("Bouillon ouvert",)], "label string")
    assert [r["taxon_type"] for r in rules.species(labels, "label", []).collect()] == ["ambiguous", "ambiguous", "bacterium"]


def test_blocked_indicators_raise(spark):
    spec = indicators.Indicator("x", "class_any_r", ("absent",))
    evaluated = indicators.evaluate(spark.createDataFrame([("S", 2024)], "a string, year int"), [spec], "global", "a")
    with pytest.raises(ValueError, match="x: no molecule"):
        indicators.incidence(evaluated, [spec], spark.createDataFrame([(2024, 5)], "calendar_year int, nights int"), "year")


def test_shared_stays_and_emergency_only(spark):
    units = spark.createDataFrame([(["URGE"],), (["URGE", "URGP"],), (["URGE", "INTB"],), ([],)], "u array<string>")
    assert [r[0] for r in units.select(stays.only_emergency(F.col("u"))).collect()] == [True, True, False, False]
    rows = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "patient int, stay int")
    assert {(r["stay"], r["n_patients"], r["is_shared"]) for r in episodes.shared_stays(rows).collect()} == {(1, 2, True), (2, 1, False)}


def test_bundles(spark, tmp_path):
    from strainflow.sources import contracts, tables

    nights = spark.createDataFrame([(2023, 5), (2024, 7)], "calendar_year int, hospital_nights bigint")
    wanted = {"denominator": contracts.DENOMINATOR}
    assert contracts.validate_bundle({"denominator": nights}, wanted, {"denominator.rows": 2, "v": 2}, {"v": 2}) == ([], [])
    bad = nights.union(spark.createDataFrame([(2024, -1), (None, 3)], nights.schema)).withColumn("more", F.lit(1))
    errors, warnings = contracts.validate_bundle({"denominator": bad, "other": nights}, wanted | {"absent": contracts.SCOPE}, {"denominator.rows": 2}, {"v": 3})
    assert len(warnings) == 2 and len(errors) == 6, errors
    with pytest.raises(ValueError, match="6 errors"):
        contracts.validated({"denominator": bad}, wanted | {"absent": contracts.SCOPE}, {"denominator.rows": 2}, {"v": 3})
    folder = f"file://{tmp_path}/bundle"
    tables.write_bundle(spark, folder, {"denominator": nights}, {"v": 1})
    old, _ = tables.read_bundle(spark, folder)
    tables.write_bundle(spark, folder, {"denominator": old["denominator"].filter("calendar_year = 2024")}, {"v": 2}, force=True)
    new, meta = tables.read_bundle(spark, folder)
    assert new["denominator"].count() == 1 and meta["v"] == 2
    with pytest.raises(FileExistsError):
        tables.write_bundle(spark, folder, {"denominator": nights}, {})


def test_years_meet_once_each(spark):
    """Both sides of the join by year hold each year once, and years of nights and of lines are judged."""
    many = spark.createDataFrame([(y,) for y in (1996, 1997, 1997, None)], "calendar_year int")
    plan = joins.missing_years(many, many.filter("calendar_year = 1997"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan[plan.index("LeftAnti") :].count("Aggregate [calendar_year") == 2
    assert composition.exposure_years_missing(spark, str(DATA)).count() > 0


def test_scope_sorts_few_rows(spark):
    """Rows are made different before the least reason of a unit is taken, which sorts its input."""
    plan = composition._scope(spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2
