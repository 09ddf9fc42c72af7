"""The library's queries on the test tables, and the SQL that checks each.

The tables are not laboratory data, so each query binds their columns to the operators' roles:
customers are patients, orders stays, order lines observations, suppliers' nations species, part
types antibiotics, return flags results, line states sample types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainflow.functions import text as X
from strainflow.functions import time as D
from strainflow.operators import attribution, dedup, indicators, isolates, quality, rules, stays
from strainflow.operators.numbering import numbered
from strainflow.sources import contracts
from strainflow.sources.stage import broadcastable, dealt, partitions, staged

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
KEYS = ["patient", "stay", "document", "day", "sample_type", "species"]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def observations(spark: SparkSession, d: str, line: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Long observations: a result of an antibiotic for a species in a document, of order lines or of
    those given (with their number as row_order). rows: about how many lines there are; parts and suppliers
    too large for a broadcast are then dealt so that their joins' sorts don't grow with the tables."""
    given, line, order = line, line or _t(spark, d, "lineitem"), _t(spark, d, "orders")
    part, supplier = _t(spark, d, "part"), _t(spark, d, "supplier")
    if rows is not None:
        part, supplier = part.select("p_partkey", "p_type"), supplier.select("s_suppkey", "s_nationkey")
        part, supplier = (df if broadcastable(df) else dealt(df, rows, df.columns[0]) for df in (part, supplier))
    joined = line.join(order, line["l_orderkey"] == order["o_orderkey"]).join(part, line["l_partkey"] == part["p_partkey"]).join(supplier, line["l_suppkey"] == supplier["s_suppkey"])
    raw = F.when(F.col("l_returnflag") == "A", " s ").when(F.col("l_returnflag") == "N", "i").otherwise(F.col("l_returnflag"))
    return joined.select(
        F.col("o_custkey").alias("patient"),
        F.col("o_orderkey").alias("stay"),
        F.col("l_linenumber").alias("document"),
        F.to_date("o_orderdate").alias("day"),
        F.col("l_linestatus").alias("sample_type"),
        F.col("s_nationkey").alias("species"),
        F.col("p_type").alias("antibiotic"),
        X.sir(raw).alias("result"),
        *(["row_order"] if given else []),
        "l_quantity",
    )


def numbered_lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines with their numbers in ORDER: which of two results of a cell is the last."""
    line = _t(spark, d, "lineitem")
    return numbered(line.select(*ORDER, "l_returnflag", "l_linestatus"), ORDER, "row_order", ranges=partitions(spark, line.count()))


def dealt_lines(spark: SparkSession, d: str) -> DataFrame:
    """numbered_lines(), dealt for their join with orders, whose sorts then don't grow with the tables."""
    return dealt(numbered_lines(spark, d), _t(spark, d, "lineitem").count(), "l_orderkey")


def wide(spark: SparkSession, d: str, by: list[str] = KEYS) -> DataFrame:
    """The wide table, dealt by its keys or by some of them."""
    lines, order = dealt_lines(spark, d), F.col("row_order")
    n = _t(spark, d, "lineitem").count()
    rows = dealt(observations(spark, d, lines, n), n, *by)
    return isolates.widen(rows, KEYS, "antibiotic", "result", TYPES, order, {"quantity": isolates.first_value(F.col("l_quantity"), order)})


def isolates_by_group(spark: SparkSession, d: str) -> DataFrame:
    """The wide table with year and id, dealt by patient and species, so that a group is in one partition."""
    return wide(spark, d, ["patient", "species"]).withColumns({"year": F.year("day"), "id": F.concat_ws("/", *KEYS)})


def isolates_with_ids(spark: SparkSession, d: str) -> DataFrame:
    """isolates_by_group(), written once for plans that read it several times."""
    return staged(isolates_by_group(spark, d), "isolates")


_OBS = f"""obs as (
  select o_custkey as patient, o_orderkey as stay, l_linenumber as document, o_orderdate::date as day, l_linestatus as sample_type,
         s_nationkey as species, p_type as antibiotic, case l_returnflag when 'A' then 'S' when 'N' then 'ZIT' else l_returnflag end as result,
         row_number() over (order by {', '.join(ORDER)}) as o, l_quantity
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey)"""
_CELLS = ", ".join(f"""arg_max(result, o) filter (result is not null and antibiotic = '{t}') as "{t}" """ for t in TYPES)
_COUNT = " + ".join(f"""coalesce(("{t}" in ('S', 'R'))::int, 0)""" for t in TYPES)
_WIDE = f"""{_OBS}, wide0 as (select {', '.join(KEYS)}, {_CELLS}, arg_min(l_quantity, o) as quantity from obs group by all),
wide as (select *, {_COUNT} as nb_resultats from wide0)"""


def wide_isolates(spark, d):
    return wide(spark, d).withColumn("day", F.col("day").cast("string"))


def screening_exclusion(spark, d):
    obs = observations(spark, d).withColumn("stay", F.when(F.col("document") % 3 != 0, F.col("stay")))
    kept = isolates.diagnostic_documents(obs, "patient", "stay", "document", F.col("l_quantity") < 45)
    return kept.groupBy("patient", "document").agg(F.count("*").alias("n_rows"), F.sum("l_quantity").alias("quantity"))


#: Isolates are compared within a patient, a year and a species.
GROUP = ["patient", "year", "species"]
ISOLATE_ORDER = ["day", "stay", "document", "sample_type", "species"]


def _classes(spark, d):
    w = isolates_with_ids(spark, d)
    return w, dedup.classes(w, GROUP, "id", TYPES, [], [F.col(c) for c in ISOLATE_ORDER])


def _representatives(spark, d):
    w, found = _classes(spark, d)
    order = [-F.col("nb_resultats"), *map(F.col, ISOLATE_ORDER)]
    return dedup.representatives(w.join(found.drop(*GROUP), "id"), GROUP, "class_id", order)


def first_fit_classes(spark, d):
    found = dedup.classes(isolates_by_group(spark, d), GROUP, "id", TYPES, [], [F.col(c) for c in ISOLATE_ORDER])
    return found.select(*GROUP, "id", "class_id", "n_docs", "n_classes")


def class_representatives(spark, d):
    return _representatives(spark, d).select(*GROUP, "class_id", "id", "nb_resultats", *TYPES)


_BIT = lambda v: " + ".join(f"""(case when "{t}" = '{v}' then {1 << k} else 0 end)""" for k, t in enumerate(TYPES))
_ID = f"concat_ws('/', {', '.join(KEYS)})"


def first_fit_sql(group: str, back: bool = False) -> str:
    """CTEs iso and fold: isolates with their place in the group's order (or in the opposite one), and
    the class that each gets, one place after the other in all groups at once."""
    order = ", ".join(f"{c} desc" if back else c for c in ISOLATE_ORDER)
    return f"""{_WIDE},
iso as (select {group} as grp, year(day) as year, {_ID} as id, ({_BIT('S')})::bigint as s, ({_BIT('R')})::bigint as r,
         row_number() over (partition by {group} order by {order}) as rn, w.* from wide w),
fold as (
  select grp, rn, id, 1 as class_id, [s] as cs, [r] as cr from iso where rn = 1
  union all
  select grp, rn, id, spot, case when spot > len(cs) then list_append(cs, s) else list_transform(cs, lambda x, i: case when i = spot then x | s else x end) end,
         case when spot > len(cr) then list_append(cr, r) else list_transform(cr, lambda x, i: case when i = spot then x | r else x end) end
  from (select i.grp, i.rn, i.id, f.cs, f.cr, i.s, i.r,
               coalesce(nullif(list_position(list_transform(f.cs, lambda x, k: ((x & i.r) | (f.cr[k] & i.s)) = 0), true), 0), len(f.cs) + 1)::int as spot
        from fold f join iso i on i.grp = f.grp and i.rn = f.rn + 1))"""


_GROUP_SQL = "(patient || '/' || year(day) || '/' || species)"
_FIRST_FIT_SQL = f"""with recursive {first_fit_sql(_GROUP_SQL)}
select patient, year, species, id, class_id, count(*) over (partition by grp) as n_docs, max(class_id) over (partition by grp) as n_classes from fold f join iso i using (grp, rn, id)"""
_KEPT_SQL = f"""{first_fit_sql(_GROUP_SQL)}, kept as (
  select i.*, class_id, row_number() over (partition by grp, class_id order by nb_resultats desc, {', '.join(ISOLATE_ORDER)}) as k from fold f join iso i using (grp, rn, id))"""
_REPRESENTATIVES_SQL = f"""with recursive {_KEPT_SQL}
select patient, year, species, class_id, id, nb_resultats, {', '.join(f'"{t}"' for t in TYPES)} from kept where k = 1"""


def unit_attribution(spark, d):
    order, line = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    unit = ("um", "uf")
    intervals = order.select(F.col("o_custkey").alias("patient"), F.lit(1).alias("stay"), F.col("o_orderpriority").alias("um"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("uf"), F.col("o_orderdate").alias("entry"), (F.col("o_orderdate") + F.expr("interval 90 days")).alias("exit"))
    samples = line.join(order, line["l_orderkey"] == order["o_orderkey"]).select(F.concat_ws("/", *ORDER).alias("sample"), F.col("o_custkey").alias("patient"), F.lit(1).alias("stay"), F.col("l_shipdate").alias("moment"), F.col("o_orderpriority").alias("um"), F.col("o_orderstatus").alias("uf"))
    out = attribution.attribute_units(samples, intervals, sample_id="sample", patient="patient", stay="stay", moment="moment", unit=unit)
    return out.groupBy("patient", "attribution_status", "attribution_reason", "hospitalization_um", "hospitalization_uf").agg(F.count("*").alias("n"), F.sum("n_active_interval_records").alias("records"), F.sum("n_active_unit_pairs").alias("pairs"))


_ATTRIBUTION_SQL = f"""
with i as (select o_custkey as p, o_orderpriority as um, case when o_orderkey % 7 <> 0 then o_orderstatus end as uf, o_orderdate as a, o_orderdate + interval 90 days as b from orders),
s as (select row_number() over (order by {', '.join(ORDER)}) as id, o_custkey as p, l_shipdate as t, o_orderpriority as um, o_orderstatus as uf from lineitem join orders on l_orderkey = o_orderkey),
h as (select s.id, i.um, i.uf, s.um as own_um, s.uf as own_uf from s join i on s.p = i.p and s.t >= i.a and s.t < i.b),
c as (select id, count(*) as records, count(distinct um || '|' || uf) filter (uf is not null) as pairs, count(*) filter (uf is null) as part,
             max((um = own_um and uf = own_uf)::int) as own, min(um || '|' || uf) filter (uf is not null) as only_one from h group by id),
x as (select s.p, s.um, s.uf, coalesce(records, 0) as records, coalesce(pairs, 0) as pairs, coalesce(part, 0) as part, coalesce(own, 0) as own, only_one from s left join c using (id)),
y as (select p as patient, records, pairs,
  case when pairs = 1 or (pairs > 1 and own = 1) then 'assigned_hebergement' when pairs > 1 then 'ambiguous_hebergement' else 'unassigned_hebergement' end as attribution_status,
  case when pairs = 1 then 'single_active_unit_pair' when pairs > 1 and own = 1 then 'microbiology_unit_pair_breaks_tie' when pairs > 1 then 'multiple_active_unit_pairs'
       when part > 0 then 'active_interval_missing_complete_unit_pair' else 'no_active_interval' end as attribution_reason,
  case when pairs = 1 then split_part(only_one, '|', 1) when pairs > 1 and own = 1 then um end as hospitalization_um,
  case when pairs = 1 then split_part(only_one, '|', 2) when pairs > 1 and own = 1 then uf end as hospitalization_uf from x)
select patient, attribution_status, attribution_reason, hospitalization_um, hospitalization_uf, count(*) as n, sum(records)::bigint as records, sum(pairs)::bigint as pairs from y group by all
"""


def _intervals(spark, d):
    """Stays in units. Lines are dealt for their join with orders, whose sorts then don't grow with the tables."""
    line, order = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    line = dealt(line.select("l_orderkey", "l_suppkey", "l_shipdate"), line.count(), "l_orderkey")
    return line.join(order, line["l_orderkey"] == order["o_orderkey"]).select(F.col("o_custkey").alias("patient"), F.col("o_orderkey").alias("stay"), F.col("l_suppkey").alias("unit"), F.col("o_orderdate").alias("entry"), F.col("l_shipdate").alias("exit"), F.col("o_orderstatus").alias("state"))


_INTERVALS = "iv as (select o_custkey as patient, o_orderkey as stay, l_suppkey as unit, o_orderdate as entry, l_shipdate as exit, o_orderstatus as state from lineitem join orders on l_orderkey = o_orderkey)"
_NIGHTS = f"""{_INTERVALS}, yn as (
  select *, date_diff('day', greatest(entry::date, make_date(y, 1, 1)), least(exit::date, make_date(y + 1, 1, 1))) as nights
  from (select *, unnest(range(year(entry), year(exit) + 1))::int as y from iv where entry::date < exit::date))"""


def nights_by_year_and_unit(spark, d):
    """Nights, rows and stays. Stays are added up by themselves first, nearly as many as rows."""
    split = stays.nights_by_year(dealt(_intervals(spark, d), _t(spark, d, "lineitem").count(), "patient", "stay"), "entry", "exit")
    each = split.groupBy("calendar_year", "unit", "patient", "stay").agg(F.sum("nights").alias("nights"), F.count("*").alias("n_rows"))
    known = F.col("patient").isNotNull() & F.col("stay").isNotNull()
    return each.groupBy("calendar_year", "unit").agg(F.sum("nights").alias("nights"), F.sum("n_rows").alias("n_rows"), F.count_if(known).alias("n_stays"))


def exact_days_by_year(spark, d):
    split = stays.days_by_year(_intervals(spark, d), "entry", "exit")
    return split.groupBy("calendar_year").agg(F.sum("days_exact").alias("days_exact"), F.sum("days_floor").alias("days_floor"), F.sum("days_ceiling").alias("days_ceiling"), F.sum("days_round").alias("days_round"), F.count("*").alias("n_rows"))


def stay_bounds(spark, d):
    return stays.stay_bounds(_intervals(spark, d), ["patient", "stay"], "entry", "exit")


def stay_validation_metrics(spark, d):
    return stays.validation_metrics(stay_bounds(spark, d))


_BOUNDS = f"""{_INTERVALS}, sb as (
  select *, case when nights < 0 then 'negative_nights' when nights = 0 then 'zero_nights' else 'validated' end as validation_status, year(entry_min) <> year(exit_max) as cross_year
  from (select patient, stay, min(entry) as entry_min, max(exit) as exit_max, count(*) as n_rows, date_diff('day', min(entry)::date, max(exit)::date) as nights from iv group by 1, 2))"""


def source_preference(spark, d):
    rows = _intervals(spark, d).withColumn("source", F.when(F.col("state") == "F", "C").when(F.col("state") == "O", "DW").otherwise("X")).withColumn("unit", F.col("unit") % 5).withColumn("patient", F.col("patient") % 50)
    return stays.prefer_source(rows, ["patient", "unit"], "source").groupBy("patient", "unit", "source").agg(F.count("*").alias("n"))


def unit_scope_summary(spark, d):
    supplier = _t(spark, d, "supplier").select("s_suppkey", X.activity_code((F.col("s_nationkey") % 6).cast("string")).alias("ta"), F.get(F.array(*map(F.lit, ["MÉDECINE", "chirurgie", "Hors champ", None])), (F.col("s_suppkey") % 4).cast("int")).alias("label"))
    scoped = stays.unit_scope(supplier.withColumn("domain", X.domain_label(F.col("label"), stays.DOMAINS)), "ta", "domain")
    rows = _intervals(spark, d).join(scoped, F.col("unit") == F.col("s_suppkey"))
    marked = stays.unit_stay_status(rows, "entry", "exit", "unit")
    return stays.share_of_total(marked.groupBy("ta", "domain", "scope_status", "scope_reason", "unit_stay_status").agg(F.count("*").alias("n"), F.sum("nights").alias("nights")), "n")


_SCOPE_SQL = f"""
with {_INTERVALS},
u as (select s_suppkey, lpad((s_nationkey % 6)::varchar, 2, '0') as ta, case s_suppkey % 4 when 0 then 'MÉDECINE' when 1 then 'CHIRURGIE' when 2 then 'Hors champ' end as domain from supplier),
m as (select *, date_diff('day', entry::date, exit::date) as nights, ta in ('03', '20') as t, coalesce(domain in ('MÉDECINE', 'CHIRURGIE'), false) as k from iv join u on unit = s_suppkey),
z as (select *, case when t and k then 'eligible_ta_de' when t and domain is null then 'review_unmapped_de' when t then 'excluded_de_domain' else 'excluded_ta' end as scope_status,
  case when t and k then 'eligible_ta_de' when t and domain is null then 'ta_03_20_unmapped_de' when t then 'ta_03_20_de_domain_not_included' else 'ta_not_03_20' end as scope_reason,
  case when nights < 0 then 'review_negative_nights' when t and k then 'included' when t and domain is null then 'review_unmapped_de' else 'excluded_no_ta_de_eligible_uf' end as unit_stay_status from m)
select ta, domain, scope_status, scope_reason, unit_stay_status, count(*) as n, sum(nights)::bigint as nights, 100 * count(*) / (sum(count(*)) over ())::double as pct from z group by ta, domain, scope_status, scope_reason, unit_stay_status
"""


def administrative_status(spark, d):
    rows = _intervals(spark, d).withColumn("code", F.when(F.col("unit") % 5 == 0, None).when(F.col("unit") % 2 == 0, " h").otherwise("E"))
    return stays.administrative_status(rows, ["patient", "stay"], "code")


def nights_reconciliation(spark, d):
    """Nights by year from intervals cut at new year, against a count of the nights themselves, one by one."""
    rows = _intervals(spark, d)
    cut = stays.nights_by_year(rows, "entry", "exit").groupBy("calendar_year").agg(F.sum("nights").alias("n"))
    first, last = F.to_date("entry"), F.date_sub(F.to_date("exit"), 1)
    nights = rows.filter(first <= last).select(F.explode(F.sequence(first, last)).alias("night")).select(F.year("night").alias("calendar_year"))
    return stays.reconcile(cut, nights.groupBy("calendar_year").agg(F.count("*").alias("n")), "calendar_year", "n")


def _specs() -> list[indicators.Indicator]:
    I = indicators.Indicator  # noqa: E741, N806
    return [
        I("any_r", "class_any_r", ("ECONOMY", "LARGE", "MEDIUM"), scopes=("global", "by_type")),
        I("first_tested", "molecule_priority", ("PROMO", "SMALL", "ABSENT"), organism_type="bact_norm", organisms=("species_1", "species_2", "species_3"), sample_types=("F",), scopes=("global", "by_type")),
        I("flagged", "phenotype_flag", flag="heavy", organism_type="bact_order", organisms=("Enterobacterales",)),
        I("other", "molecule_direct", ("STANDARD",), organism_type="enterobacterales_other", organisms=("species_0", "species_5")),
        I("never", "class_any_r", ("ABSENT",)),
    ]


def _named(spark, d):
    order = F.when(F.col("species") % 5 == 0, "Enterobacterales").when(F.col("species") % 5 == 1, "Bacillales")
    return wide(spark, d).withColumns({"bact_norm": F.concat(F.lit("species_"), F.col("species")), "bact_order": order, "heavy": F.col("quantity") > 25, "year": F.year("day")})


def proportion_panel(spark, d):
    return indicators.scoped_proportions(_named(spark, d), _specs(), "year", "sample_type")


def incidence_panel(spark, d):
    specs = [s for s in _specs() if s.id in ("any_r", "flagged", "other")]
    nights = stays.nights_by_year(_intervals(spark, d), "entry", "exit").groupBy("calendar_year").agg(F.sum("nights").alias("nights"))
    return indicators.incidence(indicators.evaluate(_named(spark, d), specs, "global", "sample_type"), specs, nights, "year")


_NAMED = f"""{_WIDE}, named as (select *, 'species_' || species as bact_norm, case species % 5 when 0 then 'Enterobacterales' when 1 then 'Bacillales' end as bact_order, quantity > 25 as heavy, year(day) as year from wide)"""
_ANY = """case when coalesce("ECONOMY" = 'R', false) or coalesce("LARGE" = 'R', false) or coalesce("MEDIUM" = 'R', false) then 'R' when coalesce(nullif("ECONOMY", 'ZIT'), nullif("LARGE", 'ZIT'), nullif("MEDIUM", 'ZIT')) is null then 'O' else 'S' end"""
_RESULTS = f"""{_NAMED}, res as (
  select 'any_r' as indicator_id, *, {_ANY} as x from named
  union all select 'first_tested', *, coalesce(nullif("PROMO", 'ZIT'), nullif("SMALL", 'ZIT'), 'O') from named where bact_norm in ('species_1', 'species_2', 'species_3')
  union all select 'flagged', *, case when heavy then 'R' else 'S' end from named where bact_order = 'Enterobacterales'
  union all select 'other', *, coalesce(nullif("STANDARD", 'ZIT'), 'O') from named where bact_order = 'Enterobacterales' and bact_norm not in ('species_0', 'species_5'))"""
_COUNTS = "count(*) as n_isolates, count(*) filter (x = 'R') as n_resistant, count(*) filter (x = 'S') as n_susceptible, count(*) filter (x = 'O') as n_untested"
_PROPORTION_SQL = f"""with {_RESULTS}, p as (
  select indicator_id, year, null::varchar as sample_type, 'global' as scope, {_COUNTS} from res group by 1, 2
  union all select indicator_id, year, sample_type, 'by_type', {_COUNTS} from res where indicator_id = 'any_r' or (indicator_id = 'first_tested' and sample_type = 'F') group by 1, 2, 3)
select *, n_resistant + n_susceptible as n_tested, case when n_resistant + n_susceptible > 0 then 100.0 * n_resistant / (n_resistant + n_susceptible) end::double as pct_resistant from p"""
_INCIDENCE_SQL = f"""with {_RESULTS}, {_NIGHTS}, n as (select y as calendar_year, sum(nights)::bigint as nights from yn where nights > 0 group by 1),
c as (select indicator_id, year, count(*) as a, count(*) filter (x = 'R') as r from res group by 1, 2)
select i as indicator_id, calendar_year, nights, coalesce(a, 0) as n_isolates, coalesce(r, 0) as n_resistant, case when nights > 0 then 1000.0::double * coalesce(r, 0) / nights end as density
from n cross join (select unnest(['any_r', 'flagged', 'other']) as i) left join c on i = indicator_id and calendar_year = year"""


def resistance_panel(spark, d):
    """The flagship: observations to isolates, first-fit classes, representatives, yearly shares."""
    spec = [indicators.Indicator("any_r", "class_any_r", ("ECONOMY", "LARGE", "MEDIUM"))]
    return indicators.proportions(indicators.evaluate(_representatives(spark, d), spec, "global", "sample_type"), ["year"])


_PANEL_SQL = f"""with recursive {_KEPT_SQL}, res as (select year, {_ANY} as x from kept where k = 1)
select 'any_r' as indicator_id, year, {_COUNTS}, n_resistant + n_susceptible as n_tested, case when n_resistant + n_susceptible > 0 then 100.0 * n_resistant / (n_resistant + n_susceptible) end::double as pct_resistant from res group by year"""

_ROLES = {"oxacilline": "ECONOMY", "cefoxitine": "LARGE", "amoxicilline_ampicilline": "MEDIUM", "cefotaxime": "PROMO", "ceftazidime": "SMALL", "ofloxacine": "STANDARD"}


def plausibility_summary(spark, d):
    name = F.when(F.col("species") == 1, "staphylococcus_aureus").when(F.col("species") == 5, "klebsiella_pneumoniae").otherwise(F.col("bact_norm"))
    return quality.summary(quality.flagged(_named(spark, d).withColumn("bact_norm", name), _ROLES))


_QC_SQL = f"""with {_NAMED}, q as (select
  coalesce(species = 1 and "ECONOMY" <> "LARGE", false) as a,
  coalesce(bact_order = 'Enterobacterales' and "MEDIUM" = 'S' and (coalesce("PROMO" = 'R', false) or coalesce("SMALL" = 'R', false)), false) as b,
  coalesce(species = 5 and "MEDIUM" = 'S', false) as c from named)
select count(*) as n_rows, count(*) filter (a or b or c) as n_excluded, 100.0::double * count(*) filter (a or b or c) / count(*) as pct_excluded,
  count(*) filter (a) as qc_saureus_oxa_cefox_discordance, count(*) filter (b) as qc_enterobacterales_amoxampi_s_c3g_r, 0::bigint as qc_enterobacterales_nalidixic_s_fq_r, count(*) filter (c) as qc_klebsiella_enterobacter_amoxampi_s from q"""

def plausible_rows(spark, d):
    name = F.when(F.col("species") == 1, "staphylococcus_aureus").when(F.col("species") == 5, "klebsiella_pneumoniae").otherwise(F.col("bact_norm"))
    return quality.plausible(quality.flagged(_named(spark, d).withColumn("bact_norm", name), _ROLES))


def plausible_isolates(spark, d):
    """Isolates by species and year that no plausibility rule takes away."""
    return plausible_rows(spark, d).groupBy("species", "year").agg(F.count("*").alias("n"))


_SPECIES = [(r"(?i)\bwidget\b", None, "ambiguous"), (r"(?i)^red\s+ring\b", "rubrum_annulus", "bacterium"), (r"(?i)^(large|small)\b", None, "bacterium"), (r"(?i)gear", None, "morphotype")]


def species_names(spark, d):
    part = _t(spark, d, "part").select(F.concat(F.lit("  "), F.initcap("p_name"), F.lit(" ")).alias("label")).distinct()
    return rules.species(part, "label", _SPECIES)


_SPECIES_SQL = r"""
with l as (select distinct '  ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' ' as label from part),
t as (select label, trim(label) as x from l),
u as (select *, case when regexp_matches(x, '(?i)\bwidget\b') then 'ambiguous' when regexp_matches(x, '(?i)^red\s+ring\b') then 'bacterium' when regexp_matches(x, '(?i)^(large|small)\b') then 'bacterium'
  when regexp_matches(x, '(?i)gear') then 'morphotype' else 'bacterium' end as taxon_type, not regexp_matches(x, '(?i)\bwidget\b') and regexp_matches(x, '(?i)^red\s+ring\b') as named from t),
g as (select *, case when taxon_type = 'bacterium' then case when named then 'Rubrum' else nullif(regexp_extract(x, '(?i)^([A-Z][a-z]+)\b', 1), '') end end as bact_genus from u)
select label, taxon_type, bact_genus, case when named then 'rubrum_annulus' when taxon_type = 'bacterium' and bact_genus is not null
  then lower(bact_genus) || '_' || coalesce(nullif(lower(regexp_extract(x, '^[A-Z][a-z]+\s+([A-Za-z][A-Za-z\-.]*)\b', 1)), ''), 'spp') end as bact_norm from g"""

_SAMPLE_TYPES = [("(?i)ring", "hemoculture"), ("(?i)red", "urines"), ("(?i)small", "urines"), ("(?i)blue", "lcr")]


def sample_type_candidates(spark, d):
    return rules.all_matches(_t(spark, d, "part"), "p_name", _SAMPLE_TYPES)


_SAMPLE_TYPE_SQL = """
with l as (select distinct p_name from part),
h as (select p_name, list_filter([case when p_name ilike '%ring%' then 'hemoculture' end, case when p_name ilike '%red%' then 'urines' end, case when p_name ilike '%small%' then 'urines' end, case when p_name ilike '%blue%' then 'lcr' end], lambda x: x is not null) as hits from l),
k as (select *, list_sort(list_distinct(hits)) as t from h)
select p_name, len(hits)::int as n_patterns, len(t)::int as n_targets, nullif(array_to_string(t, '|'), '') as targets, case when len(t) = 1 then t[1] end as target,
  case when len(hits) = 0 then 'unmatched' when len(t) > 1 then 'conflict' when len(hits) > 1 then 'multiple_same_target' else 'one_pattern' end as status from k"""


def first_rules(spark, d):
    """The number of the first rule that each part name meets, and how many names meet it."""
    return _t(spark, d, "part").groupBy(rules.matched_rule(F.col("p_name"), _SAMPLE_TYPES).alias("rule")).agg(F.count("*").alias("n"), F.count_distinct("p_name").alias("n_names"))


def class_expansion(spark, d):
    rows = _t(spark, d, "part").select("p_partkey", F.col("p_type").alias("antibiotic"))
    return rules.expand(rows, "antibiotic", {"PROMO": ["promo_a", "promo_b", "promo_c"], "SMALL": ["small_a", "small_b"]}).groupBy("antibiotic").agg(F.count("*").alias("n"), F.sum("p_partkey").alias("keys"))


def dictionary_lookup(spark, d):
    pairs = _t(spark, d, "nation").filter("n_nationkey % 4 <> 0").select("n_nationkey", "n_name")
    found = rules.lookup(_t(spark, d, "customer").select("c_nationkey"), "c_nationkey", pairs.union(pairs), "n_nationkey", "n_name", "name")
    return found.groupBy("name", "name_unmapped").agg(F.count("*").alias("n"))


def text_functions(spark, d):
    t = _t(spark, d, "documents").select("doc_id", F.col("text").alias("x"), "source")
    return t.select("doc_id", F.sha2(X.strip_accents(F.col("x")), 256).alias("plain"), F.sha2(X.squish(F.col("x")), 256).alias("squished"), F.sha2(X.slug(F.col("x")), 256).alias("slug"), X.discipline_code(F.concat(F.lit("00"), F.regexp_replace("source", "src", ""))).alias("code"), F.size(X.values(F.replace("x", F.lit(" "), F.lit("|")))).alias("n_parts"))


_TEXT_SQL = f"""
with t as (select doc_id, text as x, source from documents),
a as (select *, replace(replace(replace(replace(replace(x, 'œ', 'oe'), 'Œ', 'OE'), 'æ', 'ae'), 'Æ', 'AE'), chr(8217), chr(39)) as y from t)
select doc_id, sha256(translate(x, '{X.ACCENTED}', '{X.FOLDED}')) as plain, sha256(nullif(regexp_replace(regexp_replace(x, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), '')) as squished,
  sha256(regexp_replace(regexp_replace(lower(translate(y, '{X.ACCENTED}', '{X.FOLDED}')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) as slug, (replace(source, 'src', ''))::bigint::varchar as code,
  len(list_distinct(list_filter(list_transform(string_split(replace(x, ' ', '|'), '|'), lambda v: nullif(regexp_replace(v, '^\\s+|\\s+$', '', 'g'), '')), lambda v: v is not null)))::int as n_parts
from a"""


def local_times(spark, d):
    day = F.make_date(F.lit(2024), F.when(F.col("event_id") % 2 == 0, 3).otherwise(10), F.when(F.col("event_id") % 2 == 0, 31).otherwise(27))
    t = _t(spark, d, "events").select(day.alias("day"), D.seconds(F.concat(F.floor((F.col("event_id") / 2) % 5).cast("bigint"), F.lit(":"), F.lpad(F.floor(F.col("event_id") / 10).cast("bigint") % 60, 2, "0"))).alias("second"))
    return t.select("day", "second", D.clock_status(F.col("day"), F.col("second")).alias("status")).groupBy(F.col("day").cast("string").alias("day"), "second", "status").agg(F.count("*").alias("n"))


_TIME_SQL = """
with t as (select case when event_id % 2 = 0 then date '2024-03-31' else date '2024-10-27' end as day, ((event_id // 2) % 5 * 3600 + (event_id // 10) % 60 * 60)::int as second from events)
select day::varchar as day, second, case when month(t.day) = 3 and second >= 7200 and second < 10800 then 'nonexistent_local_time' when month(t.day) = 10 and second >= 7200 and second < 10800 then 'ambiguous_local_time' else 'valid' end as status, count(*) as n from t group by all"""


def density_quantile(spark, d):
    return incidence_panel(spark, d).groupBy("indicator_id").agg(F.percentile("density", F.lit(0.975)).alias("limit_975"), F.max("density").alias("most"))


def regression_gate(spark, d):
    supplier = _t(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    other = supplier.withColumn("s_nationkey", F.when(F.col("s_suppkey") % 10 == 3, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey")))
    return contracts.differences(supplier, other).groupBy("side").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (resistance_panel, wide_isolates, screening_exclusion, first_fit_classes, class_representatives, unit_attribution, nights_by_year_and_unit, exact_days_by_year, stay_bounds, stay_validation_metrics, source_preference, unit_scope_summary, administrative_status, nights_reconciliation, proportion_panel, incidence_panel, density_quantile, plausibility_summary, plausible_isolates, species_names, sample_type_candidates, first_rules, class_expansion, dictionary_lookup, text_functions, local_times, regression_gate)}

ORACLE_SQL: dict[str, str] = {
    "resistance_panel": _PANEL_SQL,
    "wide_isolates": f"with {_WIDE} select * replace (day::varchar as day) from wide",
    "screening_exclusion": f"""with {_OBS}, s as (select patient, document, case when document % 3 <> 0 then stay end as stay, l_quantity from obs),
      m as (select *, bool_or(stay is null) over (partition by patient, document) as lacks from s),
      w as (select *, bool_or(l_quantity >= 45) over (partition by patient, document, case when not lacks then stay end) as gone from m)
      select patient, document, count(*) as n_rows, sum(l_quantity) as quantity from w where not gone group by 1, 2""",
    "first_fit_classes": _FIRST_FIT_SQL,
    "class_representatives": _REPRESENTATIVES_SQL,
    "unit_attribution": _ATTRIBUTION_SQL,
    "nights_by_year_and_unit": f"with {_NIGHTS} select y as calendar_year, unit, sum(nights)::bigint as nights, count(*) as n_rows, count(distinct patient || '/' || stay) as n_stays from yn where nights > 0 group by 1, 2",
    "exact_days_by_year": f"""with {_INTERVALS}, x as (select y, date_diff('second', greatest(entry, make_timestamp(y, 1, 1, 0, 0, 0)), least(exit, make_timestamp(y + 1, 1, 1, 0, 0, 0))) / 86400.0::double as e
      from (select *, unnest(range(year(entry), year(exit) + 1)) as y from iv where entry <= exit))
      select y::int as calendar_year, sum(e) as days_exact, sum(floor(e))::bigint as days_floor, sum(ceil(e))::bigint as days_ceiling, sum(round_even(e, 0))::bigint as days_round, count(*) as n_rows from x group by 1""",
    "stay_bounds": f"with {_BOUNDS} select * from sb",
    "stay_validation_metrics": f"""with {_BOUNDS}, o as (select count(*) as a, sum(n_rows)::bigint as b, count(*) filter (validation_status = 'validated') as c, count(*) filter (validation_status = 'zero_nights') as d,
      count(*) filter (validation_status = 'negative_nights') as e, count(*) filter (cross_year) as f, coalesce(sum(nights) filter (nights > 0), 0)::bigint as g from sb)
      select unnest(['stays', 'rows', 'validated', 'zero_nights', 'negative_nights', 'missing_bounds', 'cross_year', 'nights']) as metric, unnest([a, b, c, d, e, 0, f, g]) as value from o""",
    "source_preference": f"""with {_INTERVALS}, x as (select patient % 50 as patient, unit % 5 as unit, case state when 'F' then 'C' when 'O' then 'DW' else 'X' end as source from iv),
      y as (select *, bool_or(source = 'C') over (partition by patient, unit) as has from x) select patient, unit, source, count(*) as n from y where not (has and source = 'DW') group by all""",
    "unit_scope_summary": _SCOPE_SQL,
    "administrative_status": f"""with {_INTERVALS}, x as (select patient, stay, nullif(array_to_string(list_sort(list(distinct case when unit % 5 = 0 then null when unit % 2 = 0 then 'H' else 'E' end) filter (unit % 5 <> 0)), '|'), '') as statuses from iv group by 1, 2)
      select *, case when statuses is null then 'no_usable_status' when statuses = 'H' then 'eligible' when statuses = 'E' then 'external' else 'mixed' end as stay_status from x""",
    "nights_reconciliation": f"""with {_NIGHTS}, p as (select y, sum(nights)::bigint as n from yn where nights > 0 group by 1),
      q as (select year(night)::int as y, count(*) as n from (select unnest(generate_series(entry::date::timestamp, exit::date - interval 1 day, interval 1 day)) as night from iv where entry::date < exit::date) group by 1)
      select coalesce(p.y, q.y) as calendar_year, coalesce(p.n, 0) as a, coalesce(q.n, 0) as b, coalesce(p.n, 0) - coalesce(q.n, 0) as difference from p full join q on p.y = q.y""",
    "proportion_panel": _PROPORTION_SQL,
    "incidence_panel": _INCIDENCE_SQL,
    "density_quantile": f"select indicator_id, quantile_cont(density, 0.975) as limit_975, max(density) as most from ({_INCIDENCE_SQL}) group by 1",
    "plausibility_summary": _QC_SQL,
    "plausible_isolates": _QC_SQL[: _QC_SQL.index("\nselect count(*) as n_rows")].replace("from named)", ", species, year from named)") + " select species, year::int as year, count(*) as n from q where not (a or b or c) group by 1, 2",
    "first_rules": "select case when p_name ilike '%ring%' then 0 when p_name ilike '%red%' then 1 when p_name ilike '%small%' then 2 when p_name ilike '%blue%' then 3 end::int as rule, count(*) as n, count(distinct p_name) as n_names from part group by 1",
    "species_names": _SPECIES_SQL,
    "sample_type_candidates": _SAMPLE_TYPE_SQL,
    "class_expansion": "select a as antibiotic, count(*) as n, sum(p_partkey)::bigint as keys from (select p_partkey, unnest(case p_type when 'PROMO' then ['promo_a', 'promo_b', 'promo_c'] when 'SMALL' then ['small_a', 'small_b'] else [p_type] end) as a from part) group by 1",
    "dictionary_lookup": "select n_name as name, n_name is null as name_unmapped, count(*) as n from customer left join (select * from nation where n_nationkey % 4 <> 0) on c_nationkey = n_nationkey group by 1, 2",
    "text_functions": _TEXT_SQL,
    "local_times": _TIME_SQL,
    "regression_gate": "select unnest(['a', 'b']) as side, (select count(*) from supplier where s_suppkey % 10 = 3) as n",
}
