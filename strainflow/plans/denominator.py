"""Queries of the denominator's tables, references and audits on the test tables, and the SQL that
checks each. Suppliers are units, nations their codes; orders are rows of stays (composition)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainflow.operators import attribution, denominator, joins, stays
from strainflow.plans.catalogue import _t
from strainflow.plans.composition import _AUDIT_SQL, _PERIMETER_SQL, _UNIT_SQL, _scope, unit_rows

_DOMAINS = ["Médecine ", "CHIRURGIE", "autre", None, "urgences"]


def _references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    supplier, nation = _t(spark, d, "supplier"), _t(spark, d, "nation")
    k, n = F.col("s_suppkey"), F.col("n_nationkey")
    structure = supplier.select(F.concat(F.lit(" UF"), k.cast("string")).alias("SEJUF"), F.col("s_name").alias("label"), F.when(k % 8 != 7, (F.col("s_nationkey") % 23).cast("string")).alias("CODE_TA"), F.concat(F.lit("0"), (k % 11).cast("string")).alias("CODE_DE"))
    activities = nation.select(F.concat(F.lit("0"), (n % 21).cast("string")).alias("CODE_TA"), F.col("n_name").alias("LIBELLE_TA"))
    domain = F.get(F.array(*[F.lit(x) for x in _DOMAINS]), (n % 5).cast("int"))
    disciplines = nation.select(F.when((n > 4) & (n < 10), "CHIRURGIE").otherwise(domain).alias("DOMAINE"), (n % 10).cast("string").alias("CODE_DE"), F.col("n_name").alias("LIBELLE_DE"))
    return structure.union(structure), activities, disciplines


def unit_reference(spark, d):
    return denominator.unit_reference(*_references(spark, d))


_REFERENCE_SQL = """nat as (select n_nationkey as n, n_name, lpad((n_nationkey % 21)::varchar, 2, '0') as ta, (n_nationkey % 10)::varchar as de,
  case when n_nationkey > 4 and n_nationkey < 10 then 'CHIRURGIE' else (['Médecine', 'CHIRURGIE', 'autre', null, 'urgences'])[n_nationkey % 5 + 1] end as dom from nation),
ta as (select ta, min(n_name) as ta_label from nat group by 1),
de as (select de, string_agg(distinct dom, '|' order by dom) as dom, string_agg(distinct n_name, '|' order by n_name) as de_label from nat group by 1),
u as (select 'UF' || s_suppkey as uf, s_name as label, case when s_suppkey % 8 <> 7 then lpad((s_nationkey % 23)::varchar, 2, '0') end as ta, (s_suppkey % 11)::varchar as de from supplier),
ref as (select uf, label, u.ta, ta_label, u.de, case dom when 'Médecine' then 'MÉDECINE' when 'urgences' then 'URGENCES' else dom end as domain, de_label from u left join ta on u.ta = ta.ta left join de on u.de = de.de),
reference as (select *, coalesce(ta in ('03', '20') and domain in ('MÉDECINE', 'CHIRURGIE', 'URGENCES'), false) as is_eligible,
  case when ta in ('03', '20') and domain in ('MÉDECINE', 'CHIRURGIE', 'URGENCES') then 'eligible_ta_de' when ta is null then 'review_unmapped_uf' when ta in ('03', '20') and domain is null then 'review_unmapped_de' when ta in ('03', '20') then 'excluded_de_domain' else 'excluded_ta' end as scope_status,
  case when ta in ('03', '20') and domain in ('MÉDECINE', 'CHIRURGIE', 'URGENCES') then 'eligible_ta_de' when ta is null then 'uf_absent_from_consores_structure' when ta in ('03', '20') and domain is null then 'ta_03_20_unmapped_de' when ta in ('03', '20') then 'ta_03_20_de_domain_not_included' else 'ta_not_03_20' end as scope_reason from ref)"""


def _stay_lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as rows of stays in units; some name a unit that no reference has."""
    line, order = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    rows = line.join(order, line["l_orderkey"] == order["o_orderkey"])
    uf = F.when(F.col("l_partkey") % 10 != 0, F.concat(F.lit("UF"), F.when(F.col("l_partkey") % 10 == 1, F.col("l_suppkey") + 1000000).otherwise(F.col("l_suppkey"))))
    return rows.select(F.col("o_custkey").alias("patient"), (F.col("l_orderkey") % 4).alias("stay"), F.concat(F.lit("UM"), F.col("l_suppkey") % 5).alias("um"), uf.alias("uf"), F.col("o_orderdate").cast("timestamp_ntz").alias("entry"), F.col("l_shipdate").cast("timestamp_ntz").alias("exit"), F.when(F.col("l_linenumber") % 2 == 0, "C").otherwise("DW").alias("source"), F.col("l_partkey"))


_LINES_SQL = """sl as (select o_custkey as patient, l_orderkey % 4 as stay, 'UM' || l_suppkey % 5 as um, case when l_partkey % 10 <> 0 then 'UF' || case when l_partkey % 10 = 1 then l_suppkey + 1000000 else l_suppkey end end as uf,
  o_orderdate as entry, l_shipdate as exit, case when l_linenumber % 2 = 0 then 'C' else 'DW' end as source, l_partkey from lineitem join orders on l_orderkey = o_orderkey)"""


def _labels(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    supplier, k = _t(spark, d, "supplier"), F.col("s_suppkey")
    uf = F.concat(F.lit("UF"), k.cast("string")).alias("uf")
    um = spark.range(3).select(F.concat(F.lit("UM"), "id").alias("um"), F.concat(F.lit("label "), "id").alias("um_label"))
    return supplier.filter(k % 6 != 5).select(uf, F.col("s_name").alias("uf_label")), um, supplier.select(uf, F.concat(F.lit("UM"), k % 4).alias("um_of_uf"))


def unit_star(spark, d):
    """How many rows of stays find each of the four references."""
    joined = denominator.with_units(_stay_lines(spark, d).select("um", "uf"), unit_reference(spark, d), *_labels(spark, d))
    return denominator.unit_misses(joined)


def _tables(spark, d):
    return denominator.tables(unit_rows(spark, d))


_BOUNDED_SQL = f"""{_AUDIT_SQL},
codes as (select distinct uf, ta, de, domain from rows_),
bounded as (select a.*, c.ta, c.de, c.domain from audit a left join codes c on a.uf is not distinct from c.uf where not missing_bounds and nights >= 0),
years as (select *, unnest(range(year(entry_min), year(exit_max) + 1))::int as calendar_year from bounded where entry_min::date < exit_max::date),
split0 as (select *, date_diff('day', greatest(entry_min::date, make_date(calendar_year, 1, 1)), least(exit_max::date, make_date(calendar_year + 1, 1, 1)))::int as k from years),
split as (select * from split0 where k > 0),
taken as (select *, patient || '/' || coalesce(stay, -1) as e, patient || '/' || coalesce(stay, -1) || '/' || um || '/' || coalesce(uf, '-') as u from split where unit_stay_status = 'included')"""


def included_year_split(spark, d):
    return _tables(spark, d)["year_split"]


def nights_by_unit(spark, d):
    return _tables(spark, d)["nights_by_unit_and_activity"]


def unit_exposure(spark, d):
    return _tables(spark, d)["exposure"]


def year_summary(spark, d):
    return _tables(spark, d)["year_summary"]


def episode_exclusions(spark, d):
    return _tables(spark, d)["exclusions"]


def numerator_impact(spark, d):
    rows = unit_rows(spark, d).select("patient", "stay", F.concat_ws("/", "patient", "um").alias("document"), "uf")
    scope = _scope(spark, d).select("uf", "is_eligible", "scope_status", "scope_reason")
    return denominator.numerator_impact(joins.sample_scope(rows, scope, "uf"))


def _samples(spark, d):
    return unit_rows(spark, d).select("patient", "stay", F.concat_ws("/", "patient", "um").alias("document"), F.col("uf").alias("species"), F.col("um").alias("sample_type"))


def _known(spark, d):
    rows = unit_rows(spark, d).filter("patient % 3 <> 0").withColumn("letter", F.when(F.col("uf") == "1-URGENT", "e").otherwise("H"))
    return stays.administrative_status(rows, denominator.STAY, "letter")


def join_audit(spark, d):
    return denominator.join_audit(_samples(spark, d), _known(spark, d)).drop("statuses")


def join_exclusions(spark, d):
    return denominator.join_exclusions(denominator.join_audit(_samples(spark, d), _known(spark, d)))


_JOIN_SQL = f"""{_UNIT_SQL}, l as (select patient, coalesce(stay, -1) as s, string_agg(distinct case when uf = '1-URGENT' then 'E' else 'H' end, '' order by case when uf = '1-URGENT' then 'E' else 'H' end) as l from rows_ where patient % 3 <> 0 group by 1, 2),
own as (select patient, stay, count(*) as n_rows, count(distinct patient || '/' || um) as n_documents, count(distinct uf) as n_species, count(distinct um) as n_types from rows_ group by 1, 2),
aud as (select own.*, coalesce(case l when 'H' then 'eligible' when 'E' then 'external' when 'EH' then 'mixed' end, 'no_pmsi_match') as stay_status, l is not null as matched from own left join l on own.patient = l.patient and coalesce(stay, -1) = s)"""


def stay_metrics(spark, d):
    rows = _stay_lines(spark, d).withColumn("entry", F.when(F.col("patient") % 50 != 0, F.col("entry")))
    return denominator.stay_metrics(rows, "entry", "exit", "l_partkey")


def _window():
    return F.to_timestamp_ntz(F.lit("1997-01-01")), F.to_timestamp_ntz(F.lit("1999-01-01"))


def _handoff(spark, d):
    rows = _stay_lines(spark, d).withColumn("um_of_uf", F.col("um"))
    return denominator.stay_handoff(rows, unit_reference(spark, d), *_window(), ["patient", "stay", "um"])


def handoff_nights(spark, d):
    """Nights by year of raw stays, which units and exposures must confirm."""
    return _handoff(spark, d)["nights"]


def handoff_window(spark, d):
    made = _handoff(spark, d)
    return made["window"].join(made["source_policy"].withColumnsRenamed({"n_before": "rows_before", "n_after": "rows_after"}), F.lit(True))


_HANDOFF_SQL = f"""{_REFERENCE_SQL}, {_LINES_SQL},
better as (select distinct patient, stay, um from sl where source = 'C'),
kept as (select sl.* from sl left join better b using (patient, stay, um) where not (source = 'DW' and b.patient is not null)),
cut as (select k.* replace (greatest(entry, timestamp '1997-01-01') as entry, least(exit, timestamp '1999-01-01') as exit), coalesce(is_eligible, false) as ok from kept k left join reference using (uf) where exit > timestamp '1997-01-01' and entry < timestamp '1999-01-01'),
us as (select patient, stay, um, uf, min(entry) as a, max(exit) as b, bool_or(ok) as ok from cut group by all),
uy as (select *, unnest(range(year(a), year(b) + 1))::int as calendar_year from us where ok and a::date < b::date),
un as (select calendar_year, date_diff('day', greatest(a::date, make_date(calendar_year, 1, 1)), least(b::date, make_date(calendar_year + 1, 1, 1))) as k from uy)"""


def attributed_observations(spark, d):
    """Observations by the unit that each document was attributed to."""
    order, line = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    intervals = order.select(F.col("o_custkey").alias("patient"), F.lit(1).alias("stay"), F.col("o_orderpriority").alias("um"), F.col("o_orderstatus").alias("uf"), F.col("o_orderdate").alias("entry"), (F.col("o_orderdate") + F.expr("interval 200 days")).alias("exit"))
    rows = line.join(order, line["l_orderkey"] == order["o_orderkey"]).select(F.concat_ws("/", "o_custkey", F.to_date("l_shipdate").cast("string")).alias("sample"), F.col("o_custkey").alias("patient"), F.col("l_shipdate").alias("moment"), F.col("l_quantity"))
    samples = rows.select("sample", "patient", "moment").distinct().withColumns({"stay": F.lit(1), "um": F.lit("3-MEDIUM"), "uf": F.lit("F")})
    found = attribution.attribute_units(samples, intervals, sample_id="sample", patient="patient", stay="stay", moment="moment", unit=("um", "uf"))
    out = denominator.attributed(rows, found, ["sample"])
    return out.groupBy("attribution_status", "attribution_reason", "SEJUF").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


QUERIES = {f.__name__: f for f in (
    unit_reference, unit_star, included_year_split, nights_by_unit, unit_exposure, year_summary, episode_exclusions, numerator_impact, join_audit, join_exclusions, stay_metrics, handoff_nights, handoff_window, attributed_observations,
)}

ORACLE_SQL = {
    "unit_reference": f"with {_REFERENCE_SQL} select * from reference",
    "unit_star": f"""with {_REFERENCE_SQL}, {_LINES_SQL}, j as (select sl.um, sl.uf, r.ta, r.label, r.ta_label, r.de, r.domain, s.s_name as uf_label, case when sl.um in ('UM0', 'UM1', 'UM2') then 1 end as um_label, 'UM' || s2.s_suppkey % 4 as um_of_uf
        from sl left join reference r using (uf) left join supplier s on sl.uf = 'UF' || s.s_suppkey and s.s_suppkey % 6 <> 5 left join supplier s2 on sl.uf = 'UF' || s2.s_suppkey)
      select count(*) as n_rows, count(*) filter (uf is null) as n_no_uf, count(*) filter (uf is not null and ta is null and label is null) as n_no_reference, count(*) filter (ta is not null and ta_label is null) as n_no_ta_label, count(*) filter (de is not null and domain is null) as n_no_domain,
        count(*) filter (uf is not null and uf_label is null) as n_no_uf_label, count(*) filter (um is not null and um_label is null) as n_no_um_label, count(*) filter (um <> um_of_uf) as n_um_differs from j""",
    "included_year_split": f"with {_BOUNDED_SQL} select patient, stay, um, uf, ta, de, calendar_year, cross_year, k as nights from taken",
    "nights_by_unit": f"with {_BOUNDED_SQL} select calendar_year, um, uf, ta, de, count(distinct e) as n_episodes, count(distinct u) as n_unit_stays, sum(k)::bigint as hospital_nights from taken group by all",
    "unit_exposure": f"with {_BOUNDED_SQL} select calendar_year, um, uf, ta, de, domain, sum(k)::int as exposure_value, 'midnight_presence' as denominator_profile_id, 'patient_days' as exposure_unit from split where um is not null and uf is not null and ta is not null and de is not null and domain is not null group by all",
    "year_summary": f"with {_BOUNDED_SQL} select calendar_year, count(distinct e) as n_episodes, count(distinct u) as n_unit_stays, count(distinct case when cross_year then e end) as n_cross_year_episodes, count(distinct case when cross_year then u end) as n_cross_year_unit_stays, sum(k)::bigint as hospital_nights from taken group by 1",
    "episode_exclusions": f"""with p as ({_PERIMETER_SQL}), {_UNIT_SQL}, b as (select patient, stay, date_diff('day', min(entry)::date, max(exit)::date) as nights, year(min(entry)) <> year(max(exit)) as crosses from rows_ group by 1, 2)
      select perimeter_status, included, rule_level, reason, count(*) as n_episodes, count(*) filter (nights = 0) as n_zero_nights, count(*) filter (crosses) as n_cross_year, 0::bigint as n_only_emergency, sum(eligible_nights)::bigint as eligible_nights, 100 * count(*) / (sum(count(*)) over ())::double as pct_episodes
      from p join b on p.patient = b.patient and p.stay is not distinct from b.stay group by 1, 2, 3, 4""",
    "numerator_impact": f"""with {_UNIT_SQL}, s as (select *, patient || '/' || um as document, coalesce(is_eligible and uf <> '5-LOW', false) as ok, case when uf is null then 'review_missing_sample_uf' when uf = '5-LOW' then 'review_unmapped_uf' else scope_status end as st from rows_),
      g as (select st as scope_status, ok as is_eligible, case st when 'review_missing_sample_uf' then 'missing_sample_uf' when 'review_unmapped_uf' then 'uf_absent_from_consores_structure' when 'review_unmapped_de' then 'ta_03_20_unmapped_de' when 'excluded_de_domain' then 'ta_03_20_de_domain_not_included' when 'excluded_ta' then 'ta_not_03_20' else st end as scope_reason,
        count(*) as n_rows, count(distinct document) as n_documents, count(distinct patient || '/' || coalesce(stay, -1)) as n_stays from s group by 1, 2, 3)
      select *, 100 * n_rows / (sum(n_rows) over ())::double as pct_rows, 100 * n_documents / (sum(n_documents) over ())::double as pct_documents from g""",
    "join_audit": f"with {_JOIN_SQL} select * from aud",
    "join_exclusions": f"with {_JOIN_SQL}, g as (select stay_status, matched, count(*) as n_stays, sum(n_rows)::bigint as n_rows, sum(n_documents)::bigint as n_documents from aud group by 1, 2) select *, 100 * n_stays / (sum(n_stays) over ())::double as pct_stays, 100 * n_rows / (sum(n_rows) over ())::double as pct_rows from g",
    "stay_metrics": f"""with {_LINES_SQL}, s as (select patient, stay, min(case when patient % 50 <> 0 then entry end) as a, max(exit) as b, max(l_partkey) as stated from sl group by 1, 2),
      t as (select *, date_diff('second', a, b) / 86400.0::double as days, count(*) over (partition by stay) > 1 as shared from s), g as (select * from t where days >= 0),
      y as (select *, unnest(range(year(a), year(b) + 1)) as y from g), x as (select sum(date_diff('second', greatest(a, make_timestamp(y, 1, 1, 0, 0, 0)), least(b, make_timestamp(y + 1, 1, 1, 0, 0, 0))) / 86400.0::double) as v from y)
      select unnest(['n_pmsi_stays_raw', 'n_pmsi_stays_validated', 'n_pmsi_stays_excluded', 'n_invalid_missing_bounds', 'n_invalid_negative_elapsed', 'n_zero_elapsed_validated', 'n_cross_year_validated', 'n_evtid_multi_pat_validated', 'sum_exact_elapsed_days_validated', 'sum_floor_elapsed_days_validated', 'sum_ceiling_elapsed_days_validated', 'sum_round_elapsed_days_validated', 'sum_sejdur_max_validated', 'sum_year_split_exact_days']) as metric,
        unnest([(select count(*) from t), (select count(*) from g), (select count(*) from t) - (select count(*) from g), (select count(*) from t where days is null), (select count(*) from t where days < 0), (select count(*) from g where days = 0), (select count(*) from g where year(a) <> year(b)), (select count(*) from g where shared),
          (select sum(days) from g), (select sum(floor(days)) from g), (select sum(ceil(days)) from g), (select sum(round_even(days, 0)) from g), (select sum(stated) from g), (select v from x)]::double[]) as value,
        unnest(['stays', 'stays', 'stays', 'stays', 'stays', 'stays', 'stays', 'stays', 'days', 'days', 'days', 'days', 'days', 'days']) as unit""",
    "handoff_nights": f"with {_HANDOFF_SQL} select calendar_year, sum(k)::int as hospital_nights from un where k > 0 group by 1",
    "handoff_window": f"with {_HANDOFF_SQL} select count(*) filter (entry is null or exit is null) as n_missing, count(*) filter (exit <= timestamp '1997-01-01') as n_before, count(*) filter (entry >= timestamp '1999-01-01') as n_after, count(*) filter (exit > timestamp '1997-01-01' and entry < timestamp '1999-01-01') as n_overlapping, (select count(*) from sl) as rows_before, count(*) as rows_after from kept",
    "attributed_observations": f"""with i as (select o_custkey as p, o_orderpriority as um, o_orderstatus as uf, o_orderdate as a, o_orderdate + interval 200 days as b from orders),
      r as (select o_custkey as p, l_shipdate as t, l_quantity from lineitem join orders on l_orderkey = o_orderkey), s as (select distinct p, t from r),
      h as (select s.p, s.t, i.um, i.uf from s join i on s.p = i.p and s.t >= i.a and s.t < i.b),
      c as (select p, t, count(distinct um || '|' || uf) as pairs, max((um = '3-MEDIUM' and uf = 'F')::int) as own, min(um || '|' || uf) as one from h group by 1, 2),
      y as (select r.*, coalesce(pairs, 0) as pairs, own, one from r left join c on r.p = c.p and r.t = c.t)
      select case when pairs = 1 or (pairs > 1 and own = 1) then 'assigned_hebergement' when pairs > 1 then 'ambiguous_hebergement' else 'unassigned_hebergement' end as attribution_status,
        case when pairs = 1 then 'single_active_unit_pair' when pairs > 1 and own = 1 then 'microbiology_unit_pair_breaks_tie' when pairs > 1 then 'multiple_active_unit_pairs' else 'no_active_interval' end as attribution_reason,
        case when pairs = 1 then split_part(one, '|', 2) when pairs > 1 and own = 1 then 'F' end as SEJUF, count(*) as n, sum(l_quantity) as quantity from y group by 1, 2, 3""",
}
