"""Queries of report tables, of the taxonomy of labels and of the two versions of a bundle, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strainflow.functions import labels
from strainflow.operators import handoff, indicators, report, rules, runtime
from strainflow.plans import bundle as B
from strainflow.plans.catalogue import _INCIDENCE_SQL, _NAMED, _PROPORTION_SQL, ORACLE_SQL as _CATALOGUE_SQL, _named, _t, incidence_panel, plausible_rows, proportion_panel
from strainflow.sources import validation
from strainflow.sources.stage import staged

_SETS, _NAMES = ["toutes années", "récent"], {"all": "toutes années", "late": "récent"}
_INDICATORS, _TYPES = ["any_r", "first_tested", "flagged"], ["O", "F"]


def _dataset(year: str):
    return F.when(F.col(year) < 1995, "all").when(F.col(year) < 1998, "late").otherwise("last")


def proportion_cells(spark, d):
    """Cells of the global panel: few tested isolates show their number only."""
    panel = proportion_panel(spark, d).filter("scope = 'global'").withColumn("dataset", _dataset("year"))
    return report.proportion_cells(panel, 40, _SETS, _INDICATORS, _NAMES, indicator="indicator_id").drop("sample_type")


def type_cells(spark, d):
    """Cells of panels by sample type and dataset."""
    panel = proportion_panel(spark, d).filter("scope = 'by_type'").withColumn("dataset", _dataset("year"))
    return report.proportion_cells(panel, 40, _SETS, _INDICATORS, _NAMES, _TYPES, indicator="indicator_id")


def incidence_cells(spark, d):
    panel = incidence_panel(spark, d).withColumn("dataset", _dataset("calendar_year"))
    return report.incidence_cells(panel, _SETS, _INDICATORS, _NAMES, indicator="indicator_id")


def _placed_sql(year: str) -> str:
    return f"""d as (select *, case when {year} < 1995 then 'all' when {year} < 1998 then 'late' else 'last' end as dataset from p),
q as (select *, case dataset when 'all' then 'toutes années' when 'late' then 'récent' end as dataset_label, case dataset when 'all' then 1 when 'late' then 2 end::int as dataset_place,
  case indicator_id when 'flagged' then 1 when 'first_tested' then 2 when 'any_r' then 3 end::int as indicator_place from d)"""


_CELL = "case when n_tested >= 40 then pct_resistant end as pct_shown, case when n_tested = 0 then 'n=0' when n_tested < 40 then 'n=' || n_tested else coalesce(printf('%.1f', pct_resistant), 'NA') || '%' || chr(10) || '(n=' || n_tested || ')' end as cell"


def report_labels(spark, d):
    """French names of what the parts stand for: kinds, denominators, what is published and where."""
    part, k = _t(spark, d, "part"), F.col("p_partkey")
    pick = lambda some, at: F.get(F.array(*map(F.lit, some)), at.cast("int"))
    kind = pick(["molecule_direct", "molecule_priority", "class_any_r", "phenotype_flag", "else", None], k % 6)
    mode = pick(["global_and_by_type", "global_only", "by_type_only", "else", None], k % 5)
    types = pick([" hemoculture", "urines|lcr", " ", None], F.floor(k / 5) % 4)
    note = F.when(k % 2 == 0, F.concat(F.lit("Combines IV and trometamol forms"), F.lit(".")))
    return part.select(
        labels.indicator_kind(kind, F.when(k % 7 == 0, "fosfomycine_ecoli"), note).alias("kind"),
        labels.denominator_kind(pick(["tested_isolates", "all_isolates", "hospital_days", "else"], k % 4)).alias("denominator"),
        labels.publication_metric(k % 2 == 0, F.when(k % 5 != 0, k % 3 == 0)).alias("metric"),
        labels.publication_view(mode, types).alias("view"),
        labels.notes(pick(["Published in incidence only.", "  ", "other", None], k % 4), {"Published in incidence only.": "Publié uniquement en incidence."}).alias("note"),
    ).groupBy("kind", "denominator", "metric", "view", "note").agg(F.count("*").alias("n"))


_LABELS_SQL = """with l as (select
  case p_partkey % 6 when 0 then 'résistance lue sur une molécule unique' when 1 then 'résistance lue sur une molécule prioritaire' when 2 then case when p_partkey % 7 = 0 or p_partkey % 2 = 0 then 'résistance lue sur plusieurs formes d''une même molécule' else 'résistance lue sur une classe (au moins une résistance)' end
    when 3 then 'phénotype dérivé' when 4 then 'else' end as kind,
  (['isolats testés', 'tous les isolats', 'nuits d''hospitalisation', 'else'])[p_partkey % 4 + 1] as denominator, p_partkey % 2 = 0 as a, p_partkey % 5 <> 0 and p_partkey % 3 = 0 as b,
  case p_partkey % 5 when 0 then 'globale et par type' when 1 then 'globale' when 2 then 'par type' || (['', ' (`urines`, `lcr`)', '', ''])[(p_partkey // 5) % 4 + 1] || case when (p_partkey // 5) % 4 = 0 then ' (`hemoculture`)' else '' end when 3 then 'else' end as view,
  case p_partkey % 4 when 0 then 'Publié uniquement en incidence.' when 1 then '' when 2 then 'other' end as note from part)
select kind, denominator, case when a and b then 'proportion et densité d''incidence' when a then 'proportion' when b then 'densité d''incidence' else 'non publié' end as metric, view, note, count(*) as n from l group by all"""

# pattern, name, taxon type, genus, family, order
_TAXA = [
    (r"(?i)\bwidget\b", None, "noise", None, None, None),
    (r"(?i)^red\s+ring\b", "rubrum_annulus", "bacterium", None, "Rubraceae", "Rubrales"),
    (r"(?i)^(large|small)\b", None, "bacterium", "Magnus", None, "Magnales"),
    (r"(?i)gear", "gear_group", "morphotype", None, "Gearaceae", None),
]


def species_taxonomy(spark, d):
    """Names, families and orders of part names; every fifth label offers a choice."""
    name = F.when(F.col("p_partkey") % 5 == 0, F.concat("p_name", F.lit(" ou autre"))).otherwise(F.col("p_name"))
    part = _t(spark, d, "part").select(F.concat(F.lit(" "), F.initcap(name)).alias("label")).distinct()
    return rules.taxonomy(part, "label", _TAXA)


_TAXONOMY_SQL = r"""
with l as (select distinct ' ' || array_to_string(list_transform(string_split(p_name || case when p_partkey % 5 = 0 then ' ou autre' else '' end, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as label from part),
r as (select label, trim(label) as x, regexp_matches(label, '(?i)\bou\b') as unsure from l),
m as (select *, case when unsure then null when regexp_matches(x, '(?i)\bwidget\b') then 1 when regexp_matches(x, '(?i)^red\s+ring\b') then 2 when regexp_matches(x, '(?i)^(large|small)\b') then 3 when regexp_matches(x, '(?i)gear') then 4 end as k from r),
t as (select *, case when unsure then 'ambiguous' else coalesce((['noise', 'bacterium', 'bacterium', 'morphotype'])[k], 'bacterium') end as taxon_type, case k when 2 then 'rubrum_annulus' when 4 then 'gear_group' end as named from m),
g as (select *, case when k = 3 then 'Magnus' when k = 2 then 'Rubrum' when taxon_type = 'bacterium' then nullif(regexp_extract(x, '(?i)^([A-Z][a-z]+)\b', 1), '') end as bact_genus from t)
select label, taxon_type, bact_genus, case k when 2 then 'Rubraceae' when 4 then 'Gearaceae' end as bact_family, case k when 2 then 'Rubrales' when 3 then 'Magnales' end as bact_order,
  coalesce(named, case when taxon_type = 'bacterium' and bact_genus is not null then lower(bact_genus) || '_' || coalesce(nullif(lower(regexp_extract(x, '^[A-Z][a-z]+\s+([A-Za-z][A-Za-z\-.]*)\b', 1)), ''), 'spp') end) as bact_norm,
  taxon_type <> 'noise' and bact_genus is not null as bact_matched from g"""

_FAMILIES = [("petit", "Minores", None), ("grand", "Majores", "Maximi"), (None, "Nulli", None), ("petit", "Alii", "Alii")]


def antibiotic_families(spark, d):
    part = _t(spark, d, "part").select(F.col("p_type").alias("label"), F.when(F.col("p_partkey") % 4 != 0, "SIR").alias("kind"))
    named = rules.antibiotics(part, "label", "kind", [("^small", "petit"), ("^(large|medium)", "grand"), ("^eco", "seul")])
    return rules.families(named, _FAMILIES).groupBy("atb_norm", "atb_family", "atb_subfamily").agg(F.count("*").alias("n"))


def _exposed(spark, d):
    """A valid bundle of version 3 and its manifest."""
    exposure = staged(handoff.exposure_table(B.site_exposure(spark, d), handoff.PROFILES), "exposure")
    tables, meta = handoff.bundle(staged(B.contract_isolates(spark, d), "wide"), B.unit_mapping(spark, d), exposure=exposure)
    return tables, meta | {"created_at": "2026-01-01"}


def projected_nights(spark, d):
    """Nights by year of a bundle of version 3 taken to version 2."""
    return handoff.to_version2(spark, *_exposed(spark, d))[0]["denominator"]


def legacy_scope_report(spark, d):
    """The contract's checks of a scope that an older export wrote under other names."""
    scope = handoff.scope_reference(B.unit_mapping(spark, d))
    old = scope.withColumnsRenamed({new: name for name, new in handoff.LEGACY_SCOPE.items()}).withColumn("uf_is_eligible_by_ta_de", F.col("uf_is_eligible_by_ta_de").cast("string"))
    old = old.withColumn("uf_ta_de_reason", F.when(~F.col("SEJUF").like("%7"), F.col("uf_ta_de_reason")))
    new = handoff.modern(old, handoff.LEGACY_SCOPE)
    some = validation.checks(validation.SCOPE_V3, new.columns)
    found = [validation.breaches("scope", new, some), validation.repeated("scope", new, ["SEJUF"])]
    out = validation.report(spark, found, [("scope", c.name) for c in some] + [("scope", validation.GRAIN)])
    return out.filter("n > 0").withColumn("examples", F.array_join("examples", ", "))


def legacy_wide_report(spark, d):
    """What is wrong with a manifest that states one row and two columns that aren't there."""
    meta = {"artifact_version": 3, "sir_wide_n_rows": 1, "sir_wide_n_eltid": 7, "atb_cols": ["cefotaxime", "unheard_of", "another"], "phenotype_flag_cols": ["blse_flag"]}
    out = validation.legacy_report(spark, B.contract_isolates(spark, d), meta)
    return out.withColumn("examples", F.array_join("examples", ", "))


def published_incidence(spark, d):
    """The yearly incidences without the first and the last year."""
    return indicators.published_incidence(incidence_panel(spark, d), "calendar_year", [1992, 1998])


def populations(spark, d):
    """Isolates before and after the plausibility rules, and those of a species."""
    named = _named(spark, d)
    return runtime.populations({"analytic_scope": named, "after_plausibility_qc": plausible_rows(spark, d), "species_5": named.filter("species = 5"), "no_species": named.filter("species < 0")})


QUERIES = {f.__name__: f for f in (proportion_cells, type_cells, incidence_cells, report_labels, species_taxonomy, antibiotic_families, projected_nights, legacy_scope_report, legacy_wide_report, published_incidence, populations)}

ORACLE_SQL = {
    "proportion_cells": f"with p as (select * exclude (sample_type) from ({_PROPORTION_SQL}) where scope = 'global'), {_placed_sql('year')} select *, {_CELL} from q",
    "type_cells": f"""with p as (select * from ({_PROPORTION_SQL}) where scope = 'by_type'), {_placed_sql('year')}, t as (select *, case sample_type when 'O' then 1 when 'F' then 2 end as k from q)
      select * exclude (k), {_CELL}, case when k is not null then sample_type || chr(10) || dataset_label end as panel_label, ((k - 1) * 2 + dataset_place)::int as panel_place from t""",
    "incidence_cells": f"with p as ({_INCIDENCE_SQL}), {_placed_sql('calendar_year')} select *, coalesce(printf('%.2f', density), 'NA') || chr(10) || '(R=' || n_resistant || ')' as cell from q",
    "report_labels": _LABELS_SQL,
    "species_taxonomy": _TAXONOMY_SQL,
    "antibiotic_families": """with m as (select case when p_partkey % 4 = 0 then null when lower(p_type) like 'small%' then 'petit' when lower(p_type) like 'large%' or lower(p_type) like 'medium%' then 'grand' when lower(p_type) like 'eco%' then 'seul' end as atb_norm from part)
      select atb_norm, case atb_norm when 'petit' then 'Minores' when 'grand' then 'Majores' end as atb_family, case atb_norm when 'grand' then 'Maximi' end as atb_subfamily, count(*) as n from m group by all""",
    "projected_nights": f"with {B.EXPOSURE_SQL} select calendar_year, sum(exposure_value)::bigint as hospital_nights from exposure where CODE_TA in ('03', '20') and de_domain_ref = 'CHIRURGIE' group by 1",
    "legacy_scope_report": f"""with {B.SCOPE_SQL}, bad as (select SEJUF, row_number() over (order by SEJUF) as k from scope where SEJUF like '%7')
      select * from (select 'scope' as table_name, 'sample_uf_ta_de_reason: is null' as check_name, count(*) as n, string_agg(SEJUF, ', ' order by SEJUF) filter (k <= 10) as examples from bad) where n > 0""",
    "legacy_wide_report": f"""with {B.WIDE_SQL}, n as (select count(*) as r, count(distinct ELTID) as e from w), b as (
        select 'meta: missing' as check_name, 2 as n, 'created_at, filtre_atb' as examples union all select 'atb_cols: no such column', 2, 'another, unheard_of'
        union all select unnest(['supported_atb_cols: no such column', 'phenotype_status_cols: no such column', 'phenotype_flag_cols: no such column', 'column: missing']), 0, ''
        union all select 'sir_wide_n_rows: not as stated', (r <> 1)::int, case when r <> 1 then r || ', not 1' else '' end from n
        union all select 'sir_wide_n_eltid: not as stated', (e <> 7)::int, case when e <> 7 then e || ', not 7' else '' end from n)
      select 'sir_wide' as table_name, check_name, n::bigint as n, examples from b""",
    "published_incidence": f"select * from ({_INCIDENCE_SQL}) where calendar_year not in (1992, 1998)",
    "populations": f"""with a as (with {_NAMED} select count(*) as n, count(*) filter (species = 5) as f, count(*) filter (species < 0) as z from named), b as (select sum(n)::bigint as n from ({_CATALOGUE_SQL["plausible_isolates"]}))
      select unnest(['analytic_scope', 'after_plausibility_qc', 'species_5', 'no_species']) as stage, unnest([1, 2, 3, 4]) as stage_place, unnest([a.n, b.n, a.f, a.z]) as n_rows from a, b""",
}
