"""Queries of the canonical bundle on the test tables, and the SQL that checks each. Order lines are a
laboratory's long observations, orders its stays; part types are antibiotics, nations species."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainflow.operators import handoff, numbering
from strainflow.plans.catalogue import ORDER, _t, numbered_lines
from strainflow.plans.composition import _UNITS
from strainflow.sources.contracts import ANTIBIOTICS
from strainflow.sources.stage import staged

#: A contract column for each part type.
_MOLECULES = {"ECONOMY": "cefotaxime", "LARGE": "ceftazidime", "MEDIUM": "oxacilline", "PROMO": "gentamicine", "SMALL": "vancomycine", "STANDARD": "ciprofloxacine"}
_TYPES = {"F": "Urines", "O": None}


def site_observations(spark: SparkSession, d: str) -> DataFrame:
    """Raw text columns as a site exports them, with blanks, gaps and odd codes."""
    line, order = numbered_lines(spark, d), _t(spark, d, "orders")
    part, supplier, nation = _t(spark, d, "part"), _t(spark, d, "supplier"), _t(spark, d, "nation")
    rows = line.join(order, line["l_orderkey"] == order["o_orderkey"]).join(part, line["l_partkey"] == part["p_partkey"]).join(supplier, line["l_suppkey"] == supplier["s_suppkey"])
    rows = rows.join(nation, rows["s_nationkey"] == nation["n_nationkey"])
    text = lambda *x: F.concat(*[F.lit(c) if isinstance(c, str) else c.cast("string") for c in x])
    part_mod = lambda n, k: F.col("l_partkey") % n == k
    return rows.select(
        text(" P", F.col("o_custkey")).alias("PATID"),
        F.when(F.col("l_orderkey") % 9 != 0, text("E", F.col("l_orderkey"))).alias("EVTID"),
        text("L", F.col("l_linenumber"), " ").alias("ELTID"),
        F.when(F.col("l_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("DATEPRELEV"),
        F.when(~part_mod(5, 0), text(F.col("l_linenumber"), ":30")).alias("HEUREPRELEV"),
        F.when(~part_mod(7, 0), text("UF", F.col("o_custkey") % 7)).otherwise(" ").alias("SEJUF"),
        F.when(F.col("s_nationkey") % 4 != 0, "1").alias("souche_id"),
        text(F.col("n_name"), " ").alias("bacteria_local"),
        F.col("l_linestatus").alias("sample_type_local"),
        F.col("p_type").alias("antibiotic_local"),
        F.when(F.col("l_returnflag") == "A", "sfp").when(part_mod(11, 3), "n/a").when(F.col("l_returnflag") == "N", " i ").otherwise(F.col("l_returnflag")).alias("sir_result"),
        F.when(F.col("l_quantity") < 46, "oui").otherwise("0").alias("is_diagnostic"),
        F.when(part_mod(13, 0), "Positive ").when(part_mod(13, 1), "negative").when(part_mod(13, 2), " ").alias("blse_status_row"),
        F.when(part_mod(17, 0), "positive").when(part_mod(17, 1), "UNKNOWN").when(part_mod(17, 2), "négative").alias("carbapenemase_status"),
        F.col("row_order").alias("handoff_row_order"),
    )


def _pairs(spark: SparkSession, pairs: dict, key: str, value: str) -> DataFrame:
    return spark.createDataFrame(list(pairs.items()), f"{key} string, {value} string")


def contract_isolates(spark: SparkSession, d: str) -> DataFrame:
    """wide_contract(), with dates."""
    species = _t(spark, d, "nation").select(F.col("n_name").alias("bacteria_local"), F.concat(F.lower("n_name"), F.lit("_spp")).alias("bact_norm"))
    maps = _pairs(spark, _TYPES, "sample_type_local", "naturepvt_norm"), _pairs(spark, _MOLECULES, "antibiotic_local", "atb_norm")
    return handoff.wide_isolates(site_observations(spark, d), species, *maps)


def wide_contract(spark, d):
    """The 35-column table of a site's observations and mappings."""
    return contract_isolates(spark, d).withColumn("DATEPRELEV", F.col("DATEPRELEV").cast("string"))


_SITE_SQL = f"""site as (
  select 'P' || o_custkey as PATID, case when l_orderkey % 9 <> 0 then 'E' || l_orderkey end as EVTID, 'L' || l_linenumber as ELTID, o_orderdate::date::varchar as DATEPRELEV,
    case when l_partkey % 5 <> 0 then l_linenumber * 3600 + 1800 end::int as HEUREPRELEV, case when l_partkey % 7 <> 0 then 'UF' || o_custkey % 7 end as SEJUF,
    lower(n_name) || '_spp' as bact_norm, case l_linestatus when 'F' then 'urines' end as naturepvt_norm, p_type,
    case when l_returnflag = 'A' then 'S' when l_partkey % 11 = 3 then null when l_returnflag = 'N' then 'ZIT' else l_returnflag end as sir, l_quantity < 46 as shown,
    case l_partkey % 13 when 0 then 3 when 1 then 2 else 0 end as blse, case l_partkey % 17 when 0 then 3 when 1 then 1 when 2 then 2 else 0 end as carba, s_nationkey,
    row_number() over (order by {', '.join(ORDER)}) as o
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
lacking as (select *, bool_or(EVTID is null) over (partition by PATID, ELTID) as lacks from site),
scoped as (select *, bool_or(not shown) over (partition by PATID, ELTID, case when not lacks then EVTID end) as gone from lacking),
named as (select *, case when s_nationkey % 4 <> 0 then '1' else 'derived__' || coalesce(naturepvt_norm, 'missing_sample_type') || '__' || bact_norm end as souche_id from scoped where not gone)"""
_CELL_SQL = ", ".join(f"arg_max(sir, o) filter (sir is not null and p_type = '{k}') as {v}" for k, v in _MOLECULES.items())
_EMPTY_SQL = ", ".join(f"null::varchar as {c}" for c in ANTIBIOTICS if c not in _MOLECULES.values())
_TESTED_SQL = " + ".join(f"coalesce(({c} in ('S', 'R'))::int, 0)" for c in _MOLECULES.values())
WIDE_SQL = f"""{_SITE_SQL}, w0 as (
  select PATID, EVTID, ELTID, DATEPRELEV, max(HEUREPRELEV) as HEUREPRELEV, souche_id, naturepvt_norm, bact_norm, max(SEJUF) as SEJUF, {_CELL_SQL}, max(blse) as b, max(carba) as c
  from named group by PATID, EVTID, ELTID, DATEPRELEV, souche_id, naturepvt_norm, bact_norm),
w as (select * exclude (b, c), {_EMPTY_SQL}, ({_TESTED_SQL})::int as nb_resultats, (['no_signal', 'unknown', 'negative', 'positive'])[b + 1] as blse_status_row, (['no_signal', 'unknown', 'negative', 'positive'])[c + 1] as carbapenemase_status_row,
  b = 3 as blse_flag, c = 3 as carbapenemase_flag from w0)"""


def wide_metadata(spark, d):
    """What the manifest of the wide table says, as a row for each antibiotic that has results, and totals."""
    meta = handoff.wide_meta(contract_isolates(spark, d), "orders")
    rows = [("rows", meta["sir_wide_n_rows"]), ("documents", meta["sir_wide_n_eltid"]), *((c, 1) for c in meta["atb_cols"])]
    return spark.createDataFrame(rows, "entry string, n bigint")


def unit_mapping(spark: SparkSession, d: str) -> DataFrame:
    """A site's units: customers' segments and nations, with raw codes."""
    ta, domain = [k for k, _ in _UNITS.values()], [v for _, v in _UNITS.values()]
    pick = lambda some, at: F.get(F.array(*[F.lit(x) for x in some]), at.cast("int"))
    supplier, k = _t(spark, d, "supplier"), F.col("s_suppkey")
    return supplier.select(
        F.concat(F.lit(" UF"), k.cast("string")).alias("SEJUF"),
        F.when(k % 9 != 4, F.regexp_replace(pick(ta, k % 4), "^0", "")).alias("CODE_TA"),
        F.concat(F.lit("0"), (k % 5).cast("string")).alias("CODE_DE"),
        F.lower(pick(domain, (k / 4).cast("int") % 4)).alias("de_domain_ref"),
    )


def scope_reference(spark, d):
    return handoff.scope_reference(unit_mapping(spark, d))


SCOPE_SQL = """u as (select s_suppkey, 'UF' || s_suppkey as SEJUF, case when s_suppkey % 9 <> 4 then (['03', '03', '20', '11'])[s_suppkey % 4 + 1] end as sample_CODE_TA, (s_suppkey % 5)::varchar as sample_CODE_DE,
  (['CHIRURGIE', null, 'autre', 'CHIRURGIE'])[(s_suppkey // 4) % 4 + 1] as sample_de_domain_ref from supplier),
scope as (select * exclude (s_suppkey), coalesce(sample_CODE_TA in ('03', '20') and sample_de_domain_ref = 'CHIRURGIE', false) as sample_uf_is_eligible_by_ta_de,
  case when sample_CODE_TA is null then 'review_unmapped_uf' when sample_CODE_TA = '11' then 'excluded_ta' when sample_de_domain_ref is null then 'review_unmapped_de' when sample_de_domain_ref = 'autre' then 'excluded_de_domain' else 'eligible_ta_de' end as sample_uf_ta_de_status,
  case when sample_CODE_TA is null then 'uf_absent_from_consores_structure' when sample_CODE_TA = '11' then 'ta_not_03_20' when sample_de_domain_ref is null then 'ta_03_20_unmapped_de' when sample_de_domain_ref = 'autre' then 'ta_03_20_de_domain_not_included' else 'eligible_ta_de' end as sample_uf_ta_de_reason from u)"""


def site_exposure(spark: SparkSession, d: str) -> DataFrame:
    """Nights of orders by year and unit, as text."""
    order, line = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    rows = line.join(order, line["l_orderkey"] == order["o_orderkey"]).groupBy(F.year("o_orderdate").alias("y"), (F.col("l_suppkey")).alias("u")).agg(F.sum("l_quantity").cast("bigint").alias("n"))
    units = unit_mapping(spark, d).filter("CODE_TA is not null and de_domain_ref is not null")
    rows = rows.join(units, F.concat(F.lit(" UF"), F.col("u").cast("string")) == F.col("SEJUF"))
    return rows.select(F.col("y").cast("string").alias("calendar_year"), F.concat(F.lit("UM"), F.col("u") % 3).alias("SEJUM"), "SEJUF", "CODE_TA", "CODE_DE", "de_domain_ref", F.lit("midnight_presence").alias("denominator_profile_id"), F.concat("n", F.lit(" ")).alias("exposure_value"), F.lit("patient_days").alias("exposure_unit"))


def fine_exposure(spark, d):
    return handoff.exposure_table(site_exposure(spark, d), handoff.PROFILES)


EXPOSURE_SQL = f"""{SCOPE_SQL}, x as (select year(o_orderdate)::int as calendar_year, 'UM' || (l_suppkey % 3) as SEJUM, 'UF' || l_suppkey as SEJUF, sum(l_quantity)::int as exposure_value
  from lineitem join orders on l_orderkey = o_orderkey group by 1, 2, 3),
exposure as (select calendar_year, SEJUM, SEJUF, sample_CODE_TA as CODE_TA, sample_CODE_DE as CODE_DE, sample_de_domain_ref as de_domain_ref, 'midnight_presence' as denominator_profile_id, exposure_value, 'patient_days' as exposure_unit
  from x join scope using (SEJUF) where sample_CODE_TA is not null and sample_de_domain_ref is not null)"""


def row_numbers(spark, d):
    """Numbers of all order lines in their natural order."""
    return numbered_lines(spark, d).select(*[c for c in ORDER if c != "l_shipdate"], F.col("l_shipdate").cast("date").cast("string").alias("day"), "row_order")


def handoff_rows(spark, d):
    """Rows that a class was expanded to before explicit ones, then by the laboratory's rank, gaps last."""
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_discount") < 0.05, "expanded").otherwise("explicit").alias("origin"), F.when(F.col("l_tax") > 0.01, F.round(F.col("l_tax") * 100).cast("int")).alias("tri"), F.concat_ws("/", "l_partkey", "l_suppkey", F.to_date("l_shipdate").cast("string")).alias("source"))
    return numbering.handoff_order(rows, ["l_orderkey", "l_linenumber"], "origin", "tri", "source")


QUERIES = {f.__name__: f for f in (wide_contract, wide_metadata, scope_reference, fine_exposure, row_numbers, handoff_rows)}

ORACLE_SQL = {
    "wide_contract": f"with {WIDE_SQL} select * from w",
    "wide_metadata": f"""with {WIDE_SQL} select 'rows' as entry, count(*) as n from w union all select 'documents', count(distinct ELTID) from w
      {' '.join(f"union all select '{c}', 1 from w having count({c}) > 0" for c in _MOLECULES.values())}""",
    "scope_reference": f"with {SCOPE_SQL} select * from scope",
    "fine_exposure": f"with {EXPOSURE_SQL} select * from exposure",
    "row_numbers": f"select {', '.join(c for c in ORDER if c != 'l_shipdate')}, l_shipdate::date::varchar as day, row_number() over (order by {', '.join(ORDER)}) as row_order from lineitem",
    "handoff_rows": """with r as (select l_orderkey, l_linenumber, case when l_discount < 0.05 then 'expanded' else 'explicit' end as origin, case when l_tax > 0.01 then round(l_tax * 100)::int end as tri, l_partkey || '/' || l_suppkey || '/' || l_shipdate::date as source from lineitem)
      select *, row_number() over (order by l_orderkey, l_linenumber, (origin <> 'expanded'), tri nulls last, source) as handoff_row_order from r""",
}


def _odd_bundle(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The bundle of the queries above, with rows that break its contracts."""
    wide, last = staged(contract_isolates(spark, d), "wide"), F.substring("PATID", -1, 1)
    wide = wide.unionByName(wide.filter((F.col("ELTID") == "L5") & (last == "7"))).withColumns({
        "cefotaxime": F.when((F.col("ELTID") == "L3") & F.col("cefotaxime").isNotNull(), F.concat(F.lit("odd"), last)).otherwise(F.col("cefotaxime")),
        "blse_flag": F.when((last != "3") | (F.col("ELTID") != "L1"), F.col("blse_flag")),
    })
    scope = handoff.scope_reference(unit_mapping(spark, d))
    number = F.substring("SEJUF", 3, 20).cast("int")
    scope = scope.filter(number % 6 != 5).withColumn("sample_uf_ta_de_status", F.when(number % 5 != 1, F.col("sample_uf_ta_de_status")).otherwise("unheard_of"))
    scope = scope.unionByName(scope.filter(number % 8 == 3)).withColumn("sample_CODE_DE", F.when(number % 7 != 0, F.col("sample_CODE_DE")))
    exposure = handoff.exposure_table(site_exposure(spark, d), handoff.PROFILES)
    year = F.col("calendar_year")
    exposure = exposure.withColumns({"exposure_value": F.when((year == 1996) & (number % 3 == 0), -number).otherwise(F.col("exposure_value")), "exposure_unit": F.when(year != 1997, F.col("exposure_unit")).otherwise("beds"), "SEJUM": F.when(year != 1998, F.col("SEJUM"))})
    return {"sir_wide": wide, "sample_scope_reference": scope, "exposure": exposure}


def bundle_report(spark, d):
    """Every check of a bundle with breaches, one row each."""
    from strainflow.sources import validation

    out = validation.bundle_report(spark, _odd_bundle(spark, d))
    return out.withColumn("examples", F.array_join("examples", ", "))


def _report_sql() -> str:
    """The same checks in SQL, from the contracts."""
    from strainflow.sources import validation

    parts, names = [], []
    text = lambda keys: "concat_ws('|', " + ", ".join(f"coalesce({c}::varchar, 'NA')" for c in keys) + ")"
    for t, contract in validation.BUNDLES["v3"].items():
        add = lambda name, example, where, t=t: (names.append((t, name)), parts.append(f"select '{t}', '{name}', {example} from {t} where {where}"))
        names += [(t, "table: missing"), (t, "column: missing"), (t, "column: type")]
        for c in contract.not_null:
            add(f"{c}: is null", text(contract.grain), f"{c} is null")
        for c, v in contract.allowed.items():
            add(f"{c}: not one of the allowed values", c, f"{c} not in ({', '.join(map(repr, v))})")
        for (a, b), some in contract.pairs.items():
            add(f"{a}, {b}: not an allowed pair", f"{a} || ' ' || {b}", " and ".join(f"not ({a} = '{x}' and {b} = '{y}')" for x, y in some))
        for c in contract.not_negative:
            add(f"{c}: negative", f"{c}::varchar", f"{c} < 0")
        names.append((t, validation.GRAIN))
        parts.append(f"select '{t}', '{validation.GRAIN}', {text(contract.grain)} from {t} group by {', '.join(contract.grain)} having count(*) > 1")
    own = "(select e.*, s.*, c.n from exposure e left join (select SEJUF as u, count(*) as n from sample_scope_reference group by 1) c on e.SEJUF = c.u left join sample_scope_reference s on c.n = 1 and s.SEJUF = c.u)"
    for name, where in (
        ("not in the scope", "u is null"),
        ("codes differ from the scope", "n = 1 and not coalesce(CODE_TA = sample_CODE_TA and CODE_DE = sample_CODE_DE and de_domain_ref = sample_de_domain_ref, false)"),
        ("eligibility differs from the context", "n = 1 and not coalesce(sample_uf_is_eligible_by_ta_de = coalesce(sample_CODE_TA in ('03', '20') and sample_de_domain_ref = 'CHIRURGIE', false), false)"),
    ):
        names.append(("exposure", f"SEJUF: {name}"))
        parts.append(f"select 'exposure', 'SEJUF: {name}', x.SEJUF from (select e.SEJUF, u, n, CODE_TA, CODE_DE, de_domain_ref, sample_CODE_TA, sample_CODE_DE, sample_de_domain_ref, sample_uf_is_eligible_by_ta_de from {own.replace('select e.*, s.*, c.n', 'select e.*, s.* exclude (SEJUF), c.n, c.u')} e) x where {where}")
    spine = f"select unnest([{', '.join(repr(t) for t, _ in names)}]) as table_name, unnest([{', '.join(repr(c) for _, c in names)}]) as check_name"
    return f"""with {WIDE_SQL}, {EXPOSURE_SQL.replace('scope as', 'scope0 as').replace('join scope', 'join scope0').replace('exposure as (', 'exposure0 as (')},
doubled as (select * from w union all select * from w where ELTID = 'L5' and PATID like '%7'),
sir_wide as (select * replace (case when ELTID = 'L3' and cefotaxime is not null then 'odd' || right(PATID, 1) else cefotaxime end as cefotaxime, case when right(PATID, 1) <> '3' or ELTID <> 'L1' then blse_flag end as blse_flag) from doubled),
s1 as (select *, substr(SEJUF, 3)::int as k from scope0), s2 as (select * replace (case when k % 5 <> 1 then sample_uf_ta_de_status else 'unheard_of' end as sample_uf_ta_de_status) from s1 where k % 6 <> 5),
sample_scope_reference as (select * exclude (k) replace (case when k % 7 <> 0 then sample_CODE_DE end as sample_CODE_DE) from (select * from s2 union all select * from s2 where k % 8 = 3)),
exposure as (select * replace (case when calendar_year = 1996 and substr(SEJUF, 3)::int % 3 = 0 then -substr(SEJUF, 3)::int else exposure_value end as exposure_value, case when calendar_year <> 1997 then exposure_unit else 'beds' end as exposure_unit, case when calendar_year <> 1998 then SEJUM end as SEJUM) from exposure0),
b(table_name, check_name, example) as ({' union all '.join(parts)}),
e as (select table_name, check_name, example, count(*) as n, row_number() over (partition by table_name, check_name order by example) as k from b group by 1, 2, 3),
r as (select table_name, check_name, sum(n)::bigint as n, string_agg(example, ', ' order by example) filter (k <= 10) as examples from e group by 1, 2)
select table_name, check_name, coalesce(n, 0)::bigint as n, coalesce(examples, '') as examples from ({spine}) left join r using (table_name, check_name)"""


QUERIES["bundle_report"] = bundle_report
ORACLE_SQL["bundle_report"] = _report_sql()
