"""Queries of the catalogue of indicators, of label decisions and of phenotype lines on the test tables,
and the SQL that checks each. Parts are the rows of a catalogue, or labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainflow.operators import indicators, phenotype, rules, specs, stays
from strainflow.plans.catalogue import _COUNTS, _INCIDENCE_SQL, _RESULTS, TYPES, _intervals, _named, _t

_PICKS = {
    "wave": ["1", "1", "2", "one", " 1"],
    "enabled": ["yes", "TRUE", "no", "1", "y", None],
    "organism_filter_values": ["a|b", " ", "a| a |", "c"],
    "indicator_kind": ["class_any_r", "molecule_direct", "phenotype_flag", "molecule_priority", "other", "class_any_r", None],
    "molecule_values": ["ECONOMY|LARGE", "PROMO|absent", "absent|gone", "", "SMALL", "MEDIUM| |MEDIUM"],
    "phenotype_flag": ["heavy", None, "light"],
    "scope_mode": ["x", "x", "x", None, "x", "x", "x", "x"],
    "sample_type_mode": ["global_only", "by_type_only", "global_and_by_type", "global_only", "none"],
    "sample_type_values": ["", "F", "F|O", "Z", "O|Y"],
    "analysis_period": ["annual", "annual", "monthly"],
    "numerator_kind": ["resistant_isolates", "phenotype_positive_isolates", "resistant_isolates", "few"],
    "denominator_kind": ["tested_isolates", "all_isolates", "hospital_days", "tested_isolates", "beds"],
    "publish_proportion": [None, "no", "yes", "true", "f"],
    "publish_incidence": ["y", None, "0"],
}


def _pick(values: list, at):
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), at.cast("int"))


def raw_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue with a row for each part, in text; each column repeats with a period of its own, and
    the indices move on with the part's size, so that columns meet in many combinations."""
    part, k = _t(spark, d, "part"), F.col("p_partkey")
    at = lambda c: (k + F.floor(k / 7) * len(c) + F.col("p_size")) % len(_PICKS[c])
    columns = {c: _pick(v, at(c)) for c, v in _PICKS.items()}
    n = F.concat(F.lit("ind_"), F.when(k % 40 == 3, k - 1).otherwise(k).cast("string"))
    columns |= {"indicator_id": n, "display_order": (k % 90).cast("string"), "organism_section": F.lit("s"), "organism_label": F.col("p_brand"), "organism_filter_type": F.lit("bact_norm"), "report_taxon_label": F.col("p_type"), "indicator_label": F.col("p_name"), "notes": F.when(k % 3 == 0, "noted")}
    return part.select(*[v.alias(k) for k, v in columns.items()])


def _covered(spark, d) -> DataFrame:
    return specs.coverage(specs.validate(specs.typed(raw_catalogue(spark, d)), ["ECONOMY", "PROMO"], TYPES, ["heavy"], ["F", "O"]))


_AUDIT = ["duplicated_indicator_id", "n_requested_molecules", "n_available_molecules", "molecules_missing", "n_observed_molecules", "molecules_supported_but_unobserved", "has_valid_indicator_payload", "phenotype_col_present", "missing_sample_types", "hard_validation_ok"]


def catalogue_coverage(spark, d):
    """Every row of the catalogue with its statuses."""
    return _covered(spark, d).select("indicator_id", "display_order", *_AUDIT, "publication_mode", "proportion_execution_status", "incidence_execution_status", "coverage_note")


def catalogue_summary(spark, d):
    return specs.display_summary(specs.typed(raw_catalogue(spark, d)))


def _sql_list(values: list) -> str:
    return "[" + ", ".join("null::varchar" if v is None else f"'{v}'" for v in values) + "]"


_AT = lambda c: f"{_sql_list(_PICKS[c])}[(p_partkey + p_partkey // 7 * {len(c)} + p_size) % {len(_PICKS[c])} + 1]"
_SPLIT = lambda c: f"list_filter(list_transform(string_split(coalesce({c}, ''), '|'), lambda x: trim(x)), lambda x: x <> '')"
_UNIQ = lambda c: f"list_filter({_SPLIT(c)}, lambda x, i: list_position({_SPLIT(c)}, x) = i)"
_YES = lambda c: f"coalesce(lower(trim({c})) in ('true', 't', '1', 'yes', 'y'), false)"
_TYPE_LIST = _sql_list(TYPES)
_SPEC_SQL = f"""raw as (select p_partkey, {', '.join(f'{_AT(c)} as {c}' for c in _PICKS)}, 'ind_' || case when p_partkey % 40 = 3 then p_partkey - 1 else p_partkey end as indicator_id, (p_partkey % 90)::int as display_order,
  p_brand as organism_label, p_type as report_taxon_label, p_name as indicator_label, case when p_partkey % 3 = 0 then 'noted' end as notes from part),
spec as (select * replace (try_cast(trim(wave) as int) as wave, {_YES('enabled')} as enabled, case when publish_proportion is null then true else {_YES('publish_proportion')} end as publish_proportion, case when publish_incidence is null then true else {_YES('publish_incidence')} end as publish_incidence),
  {_UNIQ('molecule_values')} as mol, {_UNIQ('organism_filter_values')} as org, {_UNIQ('sample_type_values')} as typ from raw),
v0 as (select *, count(*) over (partition by indicator_id) > 1 as duplicated_indicator_id, len(mol)::int as n_requested_molecules, list_filter(mol, lambda x: list_contains({_TYPE_LIST}, x)) as ok,
  list_filter(mol, lambda x: x in ('ECONOMY', 'PROMO')) as seen, list_filter(typ, lambda x: x not in ('F', 'O')) as gaps, coalesce(indicator_kind = 'phenotype_flag', false) as ph from spec),
v as (select *, len(ok)::int as n_available_molecules, array_to_string(list_filter(mol, lambda x: not list_contains(ok, x)), ' | ') as molecules_missing, len(seen)::int as n_observed_molecules,
  array_to_string(list_filter(ok, lambda x: not list_contains(seen, x)), ' | ') as molecules_supported_but_unobserved,
  case when indicator_kind in ('class_any_r', 'molecule_direct', 'molecule_priority') then len(mol) > 0 when ph then phenotype_flag is not null else false end as has_valid_indicator_payload,
  case when ph then coalesce(phenotype_flag = 'heavy', false) end as phenotype_col_present, array_to_string(gaps, ' | ') as missing_sample_types from v0),
w as (select *, not duplicated_indicator_id and coalesce(indicator_kind, '') in ('class_any_r', 'molecule_direct', 'molecule_priority', 'phenotype_flag') and sample_type_mode <> 'none' and numerator_kind <> 'few' and denominator_kind <> 'beds'
  and scope_mode is not null and len(org) > 0 and has_valid_indicator_payload as hard_validation_ok, ph and not coalesce(phenotype_col_present, false) as noflag, not ph and n_available_molecules = 0 as nomol from v)"""
_LADDER = lambda m, more: f"case when not publish_{m} then 'not_requested_{m}' when not enabled then 'disabled' when wave <> 1 then 'not_wave1' when analysis_period <> 'annual' then 'deferred_period' when not hard_validation_ok then 'invalid_spec' when noflag then 'pending_phenotype_flag' when nomol then 'missing_molecule_support' {more} else 'published_{m}' end"
_COVERAGE_SQL = f"""with {_SPEC_SQL},
c as (select *, case when publish_proportion and publish_incidence then 'proportion_and_incidence' when publish_proportion then 'proportion_only' when publish_incidence then 'incidence_only' else 'not_published' end as publication_mode,
  {_LADDER('proportion', "when len(gaps) > 0 then 'missing_sample_type_mapping'")} as proportion_execution_status, {_LADDER('incidence', '')} as incidence_execution_status from w)
select indicator_id, display_order, {', '.join(_AUDIT)}, publication_mode, proportion_execution_status, incidence_execution_status,
  case when 'invalid_spec' in (proportion_execution_status, incidence_execution_status) then 'Spec row failed hard validation.' when noflag then 'Missing phenotype column in artifact: ' || phenotype_flag
    when nomol then 'None of the requested molecules are present in the supported molecule universe: ' || molecules_missing when proportion_execution_status = 'missing_sample_type_mapping' then 'Unknown sample_type_values: ' || missing_sample_types
    when not ph and n_available_molecules > 0 and n_available_molecules < n_requested_molecules then 'Partial molecule coverage against the supported molecule universe. Unsupported: ' || molecules_missing
    when publication_mode = 'incidence_only' then 'Published in incidence only.' when publication_mode = 'proportion_only' then 'Published in proportion only.' else notes end as coverage_note from c"""

#: The indicators of catalogue.proportion_panel() and incidence_panel() as a table, and one that can't be computed.
_ROWS = [
    ("any_r", "", "class_any_r", "ECONOMY|LARGE|MEDIUM", "", "global_and_by_type", "", "yes"),
    ("first_tested", "bact_norm:species_1|species_2|species_3", "molecule_priority", "PROMO|SMALL|ABSENT", "", "global_and_by_type", "F", "no"),
    ("flagged", "bact_order:Enterobacterales", "phenotype_flag", "", "heavy", "global_only", "", "yes"),
    ("other", "enterobacterales_other:species_0|species_5", "molecule_direct", "STANDARD", "", "global_only", "", "yes"),
    ("never", "bact_norm:species_1", "class_any_r", "ABSENT", "", "global_only", "", "yes"),
]


def _small(spark: SparkSession) -> DataFrame:
    """A catalogue of few rows. An indicator of all species names no organism, so it needs a filter value
    that its missing type makes of no effect."""
    fill = {"wave": "1", "enabled": "y", "organism_section": "s", "organism_label": "o", "report_taxon_label": "t", "indicator_label": "l", "scope_mode": "m", "analysis_period": "annual", "numerator_kind": "resistant_isolates", "denominator_kind": "tested_isolates", "notes": ""}
    rows = []
    for k, (id_, organism, kind, molecules, flag, mode, types, incidence) in enumerate(_ROWS):
        type_, _, values = organism.partition(":")
        own = {"indicator_id": id_, "display_order": str(k), "organism_filter_type": type_, "organism_filter_values": values or "all", "indicator_kind": kind, "molecule_values": molecules, "phenotype_flag": flag, "sample_type_mode": mode, "sample_type_values": types, "publish_proportion": "yes", "publish_incidence": incidence}
        rows.append(tuple((fill | own)[c] for c in (*specs.COLUMNS, *specs.OPTIONAL)))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (*specs.COLUMNS, *specs.OPTIONAL)))


def catalogue_panels(spark, d):
    """Both panels of isolates by year, driven by a table: shares in per cent, densities by 1000 nights."""
    covered = specs.coverage(specs.validate(specs.typed(_small(spark)), TYPES, TYPES, ["heavy"], ["F", "O"]))
    orders = specs.species_orders(_species(spark, d))
    isolates = specs.with_orders(_named(spark, d).drop("bact_order"), orders)
    shares = indicators.scoped_proportions(isolates, specs.executable(covered, "proportion"), "year", "sample_type")
    wanted = specs.executable(covered, "incidence")
    nights = stays.nights_by_year(_intervals(spark, d), "entry", "exit").groupBy("calendar_year").agg(F.sum("nights").alias("hospital_nights"))
    density = indicators.incidence(indicators.evaluate(isolates, wanted, "global", "sample_type"), wanted, specs.yearly_nights(nights), "year")
    shares = shares.select(F.lit("proportion").alias("panel"), "indicator_id", "scope", "sample_type", "year", "n_isolates", "n_resistant", F.col("pct_resistant").alias("value"))
    return shares.unionByName(density.select(F.lit("incidence").alias("panel"), "indicator_id", F.lit("global").alias("scope"), F.lit(None).cast("string").alias("sample_type"), F.col("calendar_year").alias("year"), "n_isolates", "n_resistant", F.col("density").alias("value")))


def _species(spark: SparkSession, d: str) -> DataFrame:
    """Rules that name species and orders, some of them blank, some twice."""
    nation = _t(spark, d, "nation")
    order = F.when(F.col("n_nationkey") % 5 == 0, " Enterobacterales").when(F.col("n_nationkey") % 5 == 1, "Bacillales ").otherwise(" ")
    rows = nation.select(F.concat(F.lit("species_"), F.col("n_nationkey")).alias("bact_norm"), order.alias("bact_order"))
    return rows.union(rows).union(rows.select(F.lit(None).cast("string"), "bact_order"))


_PANELS_SQL = f"""with {_RESULTS}, p as (
  select indicator_id, 'global' as scope, null::varchar as sample_type, year, {_COUNTS} from res group by 1, 4
  union all select indicator_id, 'by_type', sample_type, year, {_COUNTS} from res where indicator_id = 'any_r' or (indicator_id = 'first_tested' and sample_type = 'F') group by 1, 3, 4),
d as (select * from ({_INCIDENCE_SQL}))
select 'proportion' as panel, indicator_id, scope, sample_type, year::int as year, n_isolates, n_resistant, case when n_resistant + n_susceptible > 0 then 100.0 * n_resistant / (n_resistant + n_susceptible) end::double as value from p
union all select 'incidence', indicator_id, 'global', null, calendar_year::int, n_isolates, n_resistant, density from d"""

_PATTERNS = [("RING", "hemoculture"), ("^RED", "urines"), ("SMALL", "urines"), ("BLUE", "lcr"), ("ÉTÉ", "never")]
_DECISIONS = [("small  ring ", "map", " other "), ("red RING", "defer", None), ("bLUÉ gear", "Defer", "ignored"), ("GREEN GEAR", "MAP", "mapped"), ("no such label", "map", "x")]


def label_decisions(spark, d):
    """Part names by unordered patterns and decisions about some of them."""
    decisions = spark.createDataFrame(_DECISIONS, "key string, action string, target string")
    part = _t(spark, d, "part").select(F.concat(F.lit(" "), F.when(F.col("p_partkey") % 2 == 0, F.initcap("p_name")).otherwise(F.replace("p_name", F.lit("e"), F.lit("é"))), F.lit("  ")).alias("label"))
    return rules.decided(part, "label", _PATTERNS, decisions)


_DECISIONS_SQL = """
with l as (select distinct case when p_partkey % 2 = 0 then array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') else replace(p_name, 'e', 'é') end as label from part),
k as (select label, upper(replace(label, 'é', 'e')) as key from l),
h as (select *, list_filter([case when key like '%RING%' then 'hemoculture' end, case when key like 'RED%' then 'urines' end, case when key like '%SMALL%' then 'urines' end, case when key like '%BLUE%' then 'lcr' end], lambda x: x is not null) as hits from k),
t as (select *, list_sort(list_distinct(hits)) as ts, case key when 'SMALL RING' then 'map' when 'RED RING' then 'defer' when 'BLUE GEAR' then 'defer' when 'GREEN GEAR' then 'map' end as action, case key when 'SMALL RING' then 'other' when 'GREEN GEAR' then 'mapped' end as target from h),
s as (select *, case when len(hits) = 0 then 'unmatched' when len(ts) = 1 and len(hits) = 1 then 'one_pattern_one_target' when len(ts) = 1 then 'multiple_patterns_same_target' else 'multiple_canonical_targets' end as candidate_state from t)
select label, key, len(hits)::int as n_patterns, len(ts)::int as n_targets, nullif(array_to_string(ts, ' | '), '') as candidates, candidate_state,
  case action when 'map' then 'reviewed_override' when 'defer' then 'review_deferred' else candidate_state end as mapping_state, case when action = 'map' then target when action is null and len(ts) = 1 then ts[1] end as target from s"""

_ANALYSES = ["Recherche BLSE", "recherche  carba", "Commentaire BLSE", "x", "Résultat carba par méthode immunologique", None]
_LABELS = ["Résultat", "résultat BLSE", "BLSE", "y", "NEG/POS", "isolat et commentaire germe", "carba"]
_VALUES = ["Positive", "négative", "non effectuée", "R", "présence de BLSE ++", "non producteur de BLSE", "kleb BLSE uniquement", "OXA-48", "rien", " N/A ", "absence de carba", "souche également productrice de BLSE", "BLSE-", "production de carbapénémase", "E.coli carba+", "BLSE+", "producteur de carbapénémase"]


def result_lines(spark: SparkSession, d: str) -> DataFrame:
    """A laboratory's result lines: each order line makes the text of three columns from its own."""
    line, k = _t(spark, d, "lineitem"), F.col("l_partkey")
    tail = F.when(F.col("l_suppkey") % 5 == 0, F.lit(" ")).when(F.col("l_suppkey") % 7 == 0, F.concat(F.lit(" "), F.col("l_suppkey").cast("string"))).otherwise("")
    return line.select("l_orderkey", (F.col("l_linenumber") % 2).alias("isolate"), _pick(_ANALYSES, k % 6).alias("LBLANA"), _pick(_LABELS, (k / 6).cast("int") % 7).alias("LBLRES"), F.concat(_pick(_VALUES, F.col("l_suppkey") % 17), tail).alias("STRRES"))


def phenotype_lookup(spark, d):
    """The phenotype statuses of each order's isolates, from their own lines."""
    return phenotype.lookup(result_lines(spark, d), ["l_orderkey", "isolate"], "LBLANA", "LBLRES", "STRRES")


def phenotype_collapse(spark, d):
    """How many orders have each pair of strongest statuses, and of those that count no signal as negative."""
    lines = phenotype.line_statuses(result_lines(spark, d), "LBLANA", "LBLRES", "STRRES")
    each = lines.groupBy("l_orderkey").agg(phenotype.strongest(F.col("blse_line")).alias("blse"), phenotype.strongest(F.col("carbapenemase_line")).alias("carba"), phenotype.any_positive(F.col("blse_line")).alias("blse_any"))
    return each.groupBy("blse", "carba", "blse_any", phenotype.as_result(F.col("blse")).alias("proxy")).agg(F.count("*").alias("n"))


def _ladder_sql(exact: list, loose: dict) -> str:
    q = lambda x: x.replace("'", "''")
    out = "case "
    for a, labels, v, status in exact:
        out += f"when r in ({', '.join(repr(x) for x in labels)}) and v = '{v}'" + (f" and a = '{a}'" if a else "") + f" then '{status}' "
    for status in ("unknown", "negative", "positive"):
        lines = [" and ".join([*([f"v in ({', '.join(repr(e) for e in x.equals)})"] if x.equals else []), *[f"regexp_matches(v, '{q(p)}')" for p in x.matches], *[f"not regexp_matches(v, '{q(p)}')" for p in x.lacks]]) for x in loose[status]]
        out += "when " + " or ".join(f"({x})" for x in lines) + f" then '{status}' "
    return out + "end"


_FOLD = lambda c: f"(case when {c} is not null then nullif(nullif(nullif(trim(regexp_replace(lower(translate({c}, 'éèÉ', 'eeE')), '\\s+', ' ', 'g')), ''), 'na'), 'n/a') end)"
_LINES_SQL = f"""l as (select l_orderkey, l_linenumber % 2 as isolate, {_sql_list(_ANALYSES)}[l_partkey % 6 + 1] as a0, {_sql_list(_LABELS)}[(l_partkey // 6) % 7 + 1] as r0,
  {_sql_list(_VALUES)}[l_suppkey % 17 + 1] || case when l_suppkey % 5 = 0 then ' ' when l_suppkey % 7 = 0 then ' ' || l_suppkey else '' end as v0 from lineitem),
f as (select l_orderkey, isolate, {_FOLD('a0')} as a, {_FOLD('r0')} as r, {_FOLD('v0')} as v from l),
s as (select l_orderkey, isolate, {_ladder_sql(phenotype.BLSE_EXACT, phenotype.BLSE_LOOSE)} as b, {_ladder_sql(phenotype.CARBA_EXACT, phenotype.CARBA_LOOSE)} as c from f)"""
_LOOKUP_SQL = f"""with {_LINES_SQL},
g as (select l_orderkey, isolate, max(case b when 'positive' then 3 when 'negative' then 2 when 'unknown' then 1 else 0 end) as b, max(case c when 'positive' then 3 when 'negative' then 2 when 'unknown' then 1 else 0 end) as c from s group by 1, 2)
select l_orderkey, isolate, (['no_signal', 'unknown', 'negative', 'positive'])[b + 1] as blse_status_row, (['no_signal', 'unknown', 'negative', 'positive'])[c + 1] as carbapenemase_status_row, b = 3 as blse_flag, c = 3 as carbapenemase_flag from g"""


QUERIES = {f.__name__: f for f in (catalogue_coverage, catalogue_summary, catalogue_panels, label_decisions, phenotype_lookup, phenotype_collapse)}

ORACLE_SQL = {
    "catalogue_coverage": _COVERAGE_SQL,
    "catalogue_summary": f"""with {_SPEC_SQL} select report_taxon_label, indicator_kind, denominator_kind, min(display_order) as display_order, string_agg(distinct organism_label, ' | ' order by organism_label) as organisms,
      string_agg(distinct indicator_label, ', ' order by indicator_label) as indicators, string_agg(distinct notes, ' | ') as notes from spec group by 1, 2, 3""",
    "catalogue_panels": _PANELS_SQL,
    "label_decisions": _DECISIONS_SQL,
    "phenotype_lookup": _LOOKUP_SQL,
    "phenotype_collapse": f"""with {_LINES_SQL}, g as (select l_orderkey, max(case b when 'positive' then 3 when 'negative' then 2 when 'unknown' then 1 else 0 end) as b, max(case c when 'positive' then 3 when 'negative' then 2 when 'unknown' then 1 else 0 end) as c from s group by 1), n as (select ['no_signal', 'unknown', 'negative', 'positive'] as v)
      select v[b + 1] as blse, v[c + 1] as carba, case when b = 3 then 'positive' else 'negative' end as blse_any, case when b = 3 then 'R' else 'S' end as proxy, count(*) as n from g, n group by all""",
}
