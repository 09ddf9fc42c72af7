"""Queries of the laboratory's handoff and of times in mixed forms, and the SQL that checks each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainflow.functions import time as D
from strainflow.operators import handoff, laboratory
from strainflow.plans.catalogue import ORDER, _t, dealt_lines

_MOLECULES = {"cefotaxime": "^promo", "c3g": "^large", "oxacilline": "^medium", "ciprofloxacine": "^standard", "vancomycine": "^small"}
_EXPANSION = {"c3g": ["cefotaxime", "ceftazidime", "ceftriaxone"]}
_SPECIES = [(rf"(?i)^nation_{k}$", f"species_{k}", "bacterium") for k in range(0, 25, 2)]
_TYPES = [("^F", "urines"), ("F.?$", "urines"), ("O", "sang")]


def raw_export(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as a laboratory's export: results of antibiotics, and phenotype lines among them."""
    line, order = dealt_lines(spark, d), _t(spark, d, "orders")
    part, supplier, nation = _t(spark, d, "part"), _t(spark, d, "supplier"), _t(spark, d, "nation")
    rows = line.join(order, line["l_orderkey"] == order["o_orderkey"]).join(part, line["l_partkey"] == part["p_partkey"]).join(supplier, line["l_suppkey"] == supplier["s_suppkey"])
    rows = rows.join(nation, rows["s_nationkey"] == nation["n_nationkey"])
    k, q = F.col("l_partkey"), F.col("l_quantity")
    signal = k % 10 == 0
    return rows.select(
        F.concat(F.lit("P"), F.col("o_custkey")).alias("PATID"),
        F.when(k % 4 != 0, F.concat(F.lit("E"), F.col("o_orderkey"))).alias("EVTID"),
        F.concat(F.lit(" D"), F.col("o_orderkey")).alias("ELTID"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("DATEPRELEV"),
        F.lit("10:30").alias("HEUREPRELEV"),
        F.lit("UM1").alias("SEJUM"),
        F.col("o_orderpriority").alias("SEJUF"),
        F.col("s_nationkey").cast("string").alias("DLVL"),
        F.when(q >= 48, "SCREEN").otherwise("ATB").alias("TYPEANA"),
        F.when(signal, "Recherche BLSE").otherwise(F.initcap("p_type")).alias("LBLANA"),
        F.when(signal, "Résultat").when(k % 10 == 1, "other").otherwise(" sir ").alias("LBLRES"),
        F.when(signal, F.when(k % 20 == 0, "Positive").otherwise("negative")).when(F.col("l_returnflag") == "A", "---S").when(F.col("l_returnflag") == "N", "i").otherwise("R").alias("STRRES"),
        F.col("n_name").alias("IDENTIFICATION"),
        F.concat("l_linestatus", F.when(F.col("s_nationkey") % 3 == 0, " x").otherwise("")).alias("NATUREPVT"),
        F.col("l_linenumber").alias("TRI"),
        F.col("row_order").alias("source_row_order"),
    )


def site_rules(spark: SparkSession, d: str) -> laboratory.Rules:
    nation, k = _t(spark, d, "nation"), F.col("n_nationkey")
    orders = nation.select(F.concat(F.lit("species_"), k).alias("bact_norm"), F.when(k % 4 == 0, "Enterobacterales").otherwise("Bacillales").alias("bact_order"))
    pairs = spark.createDataFrame([(s, a) for s in ("species_0", "species_2", "species_6") for a in ("cefotaxime", "ceftazidime", "ciprofloxacine")] + [("species_10", "vancomycine")], "bact_norm string, atb_norm string")
    decisions = spark.createDataFrame([("O X", "defer", None)], "key string, action string, target string")
    return laboratory.Rules(["SCREEN"], _SPECIES, orders, _TYPES, decisions, [(p, n) for n, p in _MOLECULES.items()], pairs, _EXPANSION, model="species_0")


def _made(spark, d) -> dict[str, DataFrame]:
    return laboratory.handoff(raw_export(spark, d), F.lit("1996-01-01").cast("date"), F.lit("1999-01-01").cast("date"), site_rules(spark, d), n_rows=_t(spark, d, "lineitem").count())


def laboratory_audit(spark, d):
    """What the handoff did with the export's rows."""
    return _made(spark, d)["audit"]


def laboratory_isolates(spark, d):
    """The export as wide isolates, by way of the four blocks."""
    made = _made(spark, d)
    out = handoff.wide_isolates(*[made[k] for k in ("microbiology_observations", "bacteria_mapping", "sample_type_mapping", "antibiotic_mapping")])
    return out.select("PATID", "EVTID", "ELTID", F.col("DATEPRELEV").cast("string").alias("DATEPRELEV"), "souche_id", "nb_resultats", "naturepvt_norm", "bact_norm", "SEJUF", "cefotaxime", "ceftazidime", "ciprofloxacine", "vancomycine", "ceftriaxone", "blse_status_row")


_PAIRS = [(s, a) for s in (0, 2, 6) for a in ("cefotaxime", "ceftazidime", "ciprofloxacine")] + [(10, "vancomycine")] + [(s, a) for s in (4, 8, 12, 16, 20, 24) for a in ("cefotaxime", "ceftazidime", "ciprofloxacine")]
_EXPORT_SQL = f"""ex as (
  select 'P' || o_custkey as PATID, case when l_partkey % 4 <> 0 then 'E' || o_orderkey end as e0, 'D' || o_orderkey as ELTID, o_orderdate::date as day, o_orderpriority as SEJUF, s_nationkey, l_quantity >= 48 as screen,
    l_partkey % 10 = 0 as signal, l_partkey % 20 = 0 as positive, l_partkey % 10 > 1 as is_sir, p_type, case l_returnflag when 'A' then 'S' when 'N' then 'ZIT' else 'R' end as sir, l_linestatus || case when s_nationkey % 3 = 0 then ' x' else '' end as nature, l_linenumber as tri,
    row_number() over (order by {', '.join(ORDER)}) as o
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
ins as (select *, max(e0) over (partition by PATID, ELTID) as EVTID from ex where day >= date '1996-01-01' and day < date '1999-01-01'),
doc as (select PATID, EVTID, ELTID, bool_or(screen) as is_screening, bool_or(is_sir) as has_sir from ins group by 1, 2, 3),
rws as (select ins.*, is_screening, case nature when 'F' then 'urines' when 'F x' then 'urines' when 'O' then 'sang' end as typ, case when s_nationkey % 2 = 0 then s_nationkey end as sp from ins join doc on ins.PATID = doc.PATID and ins.ELTID = doc.ELTID and ins.EVTID is not distinct from doc.EVTID),
drug(p_type, atb, origin) as (values ('PROMO', 'cefotaxime', 1), ('LARGE', 'cefotaxime', 0), ('LARGE', 'ceftazidime', 0), ('LARGE', 'ceftriaxone', 0), ('MEDIUM', 'oxacilline', 1), ('STANDARD', 'ciprofloxacine', 1), ('SMALL', 'vancomycine', 1)),
pairs(sp, atb) as (values {', '.join(f"({s}, '{a}')" for s, a in _PAIRS)}),
sup as (select r.*, drug.atb, drug.origin from rws r join drug using (p_type) join pairs on r.sp = pairs.sp and drug.atb = pairs.atb where is_sir and not is_screening),
iso as (select distinct PATID, EVTID, ELTID, s_nationkey, typ, sp from sup),
sig as (select r.*, i.PATID is not null as found from rws r join (select distinct PATID, EVTID, ELTID, s_nationkey as dl from sup) c on r.PATID = c.PATID and r.ELTID = c.ELTID and r.EVTID is not distinct from c.EVTID and r.s_nationkey = c.dl
  left join iso i on r.PATID = i.PATID and r.ELTID = i.ELTID and r.EVTID is not distinct from i.EVTID and r.s_nationkey = i.s_nationkey and r.typ is not distinct from i.typ and r.sp is not distinct from i.sp where signal and not r.is_screening)"""

_TIMES = ["9:05", " 10:30:15 ", "at 7:45 today", "25:00", "soon", "NA", "", "23:59:61"]


def time_keys(spark, d):
    """Texts that hold times in mixed forms, made of each event's number."""
    k = F.col("event_id")
    text = F.get(F.array(*[F.lit(x) for x in _TIMES]), (k % len(_TIMES)).cast("int"))
    text = F.when(k % 3 == 0, text).otherwise(F.concat(F.lit("x"), k % 24, F.lit(":"), F.lpad((k % 70).cast("string"), 2, "0")))
    return _t(spark, d, "events").select("event_id", text.alias("text")).select("event_id", "text", D.sort_key(F.col("text")).alias("key"))


QUERIES = {f.__name__: f for f in (laboratory_audit, laboratory_isolates, time_keys)}

ORACLE_SQL = {
    "laboratory_audit": f"""with {_EXPORT_SQL}, m(metric, value) as (
      select 'raw_rows_received', count(*) from ex union all select 'raw_rows_before_target_period', count(*) from ex where day < date '1996-01-01' union all select 'raw_rows_at_or_after_target_end', count(*) from ex where day >= date '1999-01-01'
      union all select 'raw_rows_in_target_period', count(*) from ins union all select 'sir_rows_before_screening', count(*) from ins where is_sir union all select 'rows_evtid_filled_from_document', count(*) from ins where e0 is null and EVTID is not null
      union all select 'screening_document_occurrences_all_raw', count(*) from doc where is_screening union all select 'screening_document_occurrences_with_sir', count(*) from doc where is_screening and has_sir union all select 'document_occurrences_without_evtid', count(*) from doc where EVTID is null
      union all select 'screening_rows_all_raw', count(*) from rws where is_screening union all select 'screening_sir_rows', count(*) from rws where is_screening and is_sir
      union all select 'diagnostic_rows_with_supported_species_atb', count(*) from sup union all select 'sample_type_labels_unresolved', count(*) from (select distinct nature from rws where is_sir and not is_screening and typ is null)
      union all select 'phenotype_signal_rows', count(*) from sig union all select 'phenotype_signal_rows_without_isolate', count(*) from sig where not found)
      select * from m""",
    "laboratory_isolates": f"""with {_EXPORT_SQL}, g as (select PATID, EVTID, ELTID, day, s_nationkey, typ, sp, max(SEJUF) as SEJUF, {', '.join(f"arg_max(sir, (origin, tri, o)) filter (atb = '{a}') as {a}" for a in ('cefotaxime', 'ceftazidime', 'ciprofloxacine', 'vancomycine'))} from sup group by all),
      b as (select PATID, EVTID, ELTID, s_nationkey, typ, sp, bool_or(positive) as pos from sig group by all)
      select g.PATID, g.EVTID, g.ELTID, day::varchar as DATEPRELEV, g.s_nationkey::varchar as souche_id, ({' + '.join(f"coalesce(({a} in ('S', 'R'))::int, 0)" for a in ('cefotaxime', 'ceftazidime', 'ciprofloxacine', 'vancomycine'))})::int as nb_resultats, g.typ as naturepvt_norm, 'species_' || g.sp as bact_norm, SEJUF,
        cefotaxime, ceftazidime, ciprofloxacine, vancomycine, null::varchar as ceftriaxone, case when pos then 'positive' when pos is not null then 'negative' else 'no_signal' end as blse_status_row
      from g left join b on g.PATID = b.PATID and g.ELTID = b.ELTID and g.EVTID is not distinct from b.EVTID and g.s_nationkey = b.s_nationkey and g.typ is not distinct from b.typ and g.sp = b.sp""",
    "time_keys": """with t as (select event_id, case when event_id % 3 = 0 then (['9:05', ' 10:30:15 ', 'at 7:45 today', '25:00', 'soon', 'NA', '', '23:59:61'])[event_id % 8 + 1] else 'x' || event_id % 24 || ':' || lpad((event_id % 70)::varchar, 2, '0') end as text from events),
      p as (select *, nullif(nullif(trim(text), ''), 'NA') as plain, regexp_extract(text, '([0-9]{1,2}:[0-9]{2}(:[0-9]{2})?)', 1) as tok from t), q as (select *, string_split(tok, ':') as s from p)
      select event_id, text, case when tok <> '' and s[1]::int < 24 and s[2]::int < 60 and coalesce(s[3], '0')::int < 62 then lpad(s[1], 2, '0') || ':' || s[2] || ':' || coalesce(s[3], '00') when tok <> '' then tok else plain end as key from q""",
}
