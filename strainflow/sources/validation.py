"""Bundles against their contracts: every check of every table in one job, which never stops early.

A check turns rows into breaches (table, check, example), and a report adds them up once and writes how
often each example is there (stage.staged). From that it takes how many there are of a check and its first
ten different examples, found by a ranking that every task prunes to ten before the shuffle. A check without a breach has a row with 0. What the schema or the manifest alone
decides is a breach made on the driver, and row checks whose columns are missing are left out."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strainflow.sources.contracts import ANTIBIOTICS, DENOMINATOR, SCOPE, WIDE, Contract
from strainflow.sources.stage import staged

MOST = 10
GRAIN = "grain: not unique"

EXPOSURE = Contract(
    "exposure by year, units, activity, discipline and profile",
    {"calendar_year": "int", "SEJUM": "string", "SEJUF": "string", "CODE_TA": "string", "CODE_DE": "string", "de_domain_ref": "string", "denominator_profile_id": "string", "exposure_value": "int", "exposure_unit": "string"},
    not_null=("calendar_year", "SEJUM", "SEJUF", "CODE_TA", "CODE_DE", "de_domain_ref", "denominator_profile_id", "exposure_value", "exposure_unit"),
    # The profile of a denominator and its unit.
    pairs={("denominator_profile_id", "exposure_unit"): (("midnight_presence", "patient_days"),)},
    not_negative=("exposure_value",),
    grain=("calendar_year", "SEJUM", "SEJUF", "CODE_TA", "CODE_DE", "de_domain_ref", "denominator_profile_id"),
)
_STATUS, _REASON = SCOPE.allowed["sample_uf_ta_de_status"], SCOPE.allowed["sample_uf_ta_de_reason"]
SCOPE_V2 = replace(SCOPE, not_null=("SEJUF", "sample_uf_is_eligible_by_ta_de", "sample_uf_ta_de_status", "sample_uf_ta_de_reason"))
SCOPE_V3 = replace(
    SCOPE_V2,
    required={"SEJUF": "string", "sample_CODE_TA": "string", "sample_CODE_DE": "string", "sample_de_domain_ref": "string"} | {k: v for k, v in SCOPE.required.items() if k != "SEJUF"},
)
WIDE_ROWS = replace(WIDE, required=WIDE.required | {"nb_resultats": "int"})
BUNDLES = {"v2": {"sir_wide": WIDE_ROWS, "sample_scope_reference": SCOPE_V2, "denominator": DENOMINATOR}, "v3": {"sir_wide": WIDE_ROWS, "sample_scope_reference": SCOPE_V3, "exposure": EXPOSURE}}
#: Lists of the manifest that must name these columns, in any order; of atb_cols, only these.
META_LISTS = {"supported_atb_cols": ANTIBIOTICS, "filtre_atb": ANTIBIOTICS, "phenotype_status_cols": ["blse_status_row", "carbapenemase_status_row"], "phenotype_flag_cols": ["blse_flag", "carbapenemase_flag"]}
META_VALUES = {"sejuf_semantics": "hospitalization_unit_at_sampling"}
META_FIELDS = ["artifact_version", "created_at", "sir_wide_n_rows", "sir_wide_n_eltid", "atb_cols", *META_LISTS, "contract_version", *META_VALUES]


@dataclass(frozen=True)
class Check:
    """bad: whether a row breaks the check (null: no); example: what is shown of it."""

    name: str
    bad: Column
    example: Column


def key_text(columns: Iterable[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns])


def checks(contract: Contract, columns: list[str]) -> list[Check]:
    """The contract's checks of rows, for those whose columns are there."""
    key = key_text([c for c in contract.grain if c in columns]) if contract.grain else F.lit("")
    out = [(Check(f"{c}: is null", F.col(c).isNull(), key), {c}) for c in contract.not_null]
    out += [(Check(f"{c}: not one of the allowed values", ~F.col(c).isin(*v), F.col(c).cast("string")), {c}) for c, v in contract.allowed.items()]
    for (a, b), some in contract.pairs.items():
        fits = F.lit(False)
        for x, y in some:
            fits |= (F.col(a) == x) & (F.col(b) == y)
        out.append((Check(f"{a}, {b}: not an allowed pair", ~fits, F.concat_ws(" ", a, b)), {a, b}))
    for c in contract.whole:
        x = F.col(c).cast("double")
        out.append((Check(f"{c}: not a whole number", F.isnan(x) | (F.abs(x) == float("inf")) | (F.abs(x - F.round(x)) >= 1.49e-8), F.col(c).cast("string")), {c}))
    out += [(Check(f"{c}: negative", F.col(c) < 0, F.col(c).cast("string")), {c}) for c in contract.not_negative]
    return [check for check, needs in out if needs <= set(columns)]


def breaches(table: str, df: DataFrame, some: list[Check]) -> DataFrame:
    """(table_name, check_name, example): a row for each check that a row of df breaks, in one scan, in
    which rows that break none go first."""
    if not some:
        return _found(df.sparkSession, [])
    bad = [F.coalesce(c.bad, F.lit(False)) for c in some]
    items = [F.when(b, F.struct(F.lit(c.name).alias("check_name"), c.example.alias("example"))) for b, c in zip(bad, some, strict=True)]
    return df.filter(functools.reduce(operator.or_, bad)).select(F.explode(F.array_compact(F.array(*items))).alias("x")).select(F.lit(table).alias("table_name"), "x.*")


def repeated(table: str, df: DataFrame, grain: Iterable[str]) -> DataFrame:
    """A breach for each key of the grain that several rows have."""
    keys = df.groupBy(*grain).agg(F.count("*").alias("_n")).filter("_n > 1")
    return keys.select(F.lit(table).alias("table_name"), F.lit(GRAIN).alias("check_name"), key_text(grain).alias("example"))


def _found(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "table_name string, check_name string, example string")


def schema_breaches(table: str, df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    types = dict(df.dtypes)
    out = [(table, "column: missing", c) for c in contract.required if c not in types]
    return out + [(table, "column: type", f"{c}: {types[c]}, not {t}") for c, t in contract.required.items() if c in types and types[c] != t]


def meta_breaches(table: str, meta: dict, version: str) -> list[tuple[str, str, str]]:
    out = [(table, "meta: missing", k) for k in META_FIELDS if k not in meta]
    wanted = META_VALUES | {"contract_version": version}
    out += [(table, "meta: value", f"{k}: {meta[k]}, not {v}") for k, v in wanted.items() if k in meta and meta[k] != v]
    out += [(table, "meta: value", k) for k, v in META_LISTS.items() if k in meta and sorted(meta[k]) != sorted(v)]
    out += [(table, "meta: value", f"atb_cols: {c}") for c in meta.get("atb_cols", []) if c not in ANTIBIOTICS]
    out += [(table, "meta: value", k) for k in ("artifact_version", "sir_wide_n_rows", "sir_wide_n_eltid") if k in meta and not isinstance(meta[k], int)]
    return out + [(table, "meta: value", "created_at") for _ in [0] if "created_at" in meta and not str(meta["created_at"] or "")]


def counts(table: str, df: DataFrame, meta: dict) -> DataFrame:
    """Breaches of the numbers of rows and of documents that a manifest states."""
    gaps = F.max(F.col("ELTID").isNull().cast("int"))
    one = df.agg(F.count("*").alias("sir_wide_n_rows"), (F.count_distinct("ELTID") + F.coalesce(gaps, F.lit(0))).alias("sir_wide_n_eltid"))
    some = [Check(f"{c}: not as stated", F.col(c) != F.lit(meta[c]), F.concat(F.col(c).cast("string"), F.lit(f", not {meta[c]}"))) for c in ("sir_wide_n_rows", "sir_wide_n_eltid") if isinstance(meta.get(c), int)]
    return breaches(table, one, some)


def exposure_breaches(table: str, exposure: DataFrame, scope: DataFrame, eligible: Column) -> DataFrame:
    """Exposures against the scope of their units: a unit that the scope lacks, codes that differ (a
    missing one differs), and an eligibility other than `eligible` says of the scope's columns. Of a
    unit with several rows in the scope, which is a breach of its own, nothing is said."""
    columns = {"sample_CODE_TA": "CODE_TA", "sample_CODE_DE": "CODE_DE", "sample_de_domain_ref": "de_domain_ref"}
    once = scope.withColumn("_n", F.count("*").over(Window.partitionBy("SEJUF"))).select(F.col("SEJUF").alias("_unit"), *columns, "sample_uf_is_eligible_by_ta_de", "_n")
    side = once.filter("_n = 1").unionByName(once.filter("_n > 1").dropDuplicates(["_unit"]))
    joined = exposure.join(side, F.col("SEJUF") == F.col("_unit"), "left")
    absent, known = F.col("_unit").isNull(), F.col("_n") == 1
    differs = F.lit(False)
    for of_scope, own in columns.items():
        differs |= ~F.coalesce(F.col(of_scope) == F.col(own), F.lit(False))
    wrong = ~F.coalesce(F.col("sample_uf_is_eligible_by_ta_de") == F.coalesce(eligible, F.lit(False)), F.lit(False))
    unit = F.col("SEJUF")
    return breaches(table, joined, [Check("SEJUF: not in the scope", absent, unit), Check("SEJUF: codes differ from the scope", known & differs, unit), Check("SEJUF: eligibility differs from the context", known & wrong, unit)])


def signal_breaches(table: str, signals: DataFrame, candidates: DataFrame, key: list[str]) -> DataFrame:
    """Phenotype signals whose isolate key no candidate has; nulls match nulls."""
    side = candidates.select(*[F.col(c).alias(f"_{c}") for c in key]).distinct()
    on = F.lit(True)
    for c in key:
        on &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return breaches(table, signals.join(side, on, "left_anti"), [Check("signal: no candidate isolate", F.lit(True), key_text(key))])


def report(spark: SparkSession, found: list[DataFrame], names: list[tuple[str, str]], most: int = MOST) -> DataFrame:
    """(table_name, check_name, n, examples) of all names; what is found is added up once, in one job."""
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    each = staged(rows.groupBy("table_name", "check_name", "example").agg(F.count("*").alias("n")), "breaches")
    totals = each.groupBy("table_name", "check_name").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("table_name", "check_name").orderBy(F.asc_nulls_last("example")))
    first = each.withColumn("_k", place).filter(F.col("_k") <= most).groupBy("table_name", "check_name").agg(F.array_sort(F.collect_list("example")).alias("examples"))
    spine = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("check_name")) for t, c in names])).alias("x")).select("x.*")
    key = ["table_name", "check_name"]
    out = spine.join(totals, key, "left").join(first, key, "left")
    return out.select(*key, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))


def context_eligible() -> Column:
    """Whether the analysis takes a unit of the scope: activity 03 or 20 and a domain that counts."""
    from strainflow.operators.stays import ACTIVITIES, DOMAINS

    return F.col("sample_CODE_TA").isin(ACTIVITIES) & F.col("sample_de_domain_ref").isin(DOMAINS)


def bundle_report(spark: SparkSession, tables: dict[str, DataFrame], meta: dict | None = None, version: str = "v3", most: int = MOST) -> DataFrame:
    """The report of a whole bundle: schemas, rows and grains of its tables, its manifest, and exposures
    against the scope."""
    stated, found, names = [], [], []
    for name, contract in BUNDLES[version].items():
        names += [(name, "table: missing"), (name, "column: missing"), (name, "column: type")]
        if name not in tables:
            stated.append((name, "table: missing", name))
            continue
        df = tables[name]
        stated += schema_breaches(name, df, contract)
        some = checks(contract, df.columns)
        if some:
            found.append(breaches(name, df, some))
        names += [(name, c.name) for c in some]
        if set(contract.grain) <= set(df.columns):
            found.append(repeated(name, df, contract.grain))
            names.append((name, GRAIN))
    if meta is not None:
        stated += meta_breaches("sir_wide", meta, version)
        names += [("sir_wide", "meta: missing"), ("sir_wide", "meta: value"), ("sir_wide", "sir_wide_n_rows: not as stated"), ("sir_wide", "sir_wide_n_eltid: not as stated")]
        if "ELTID" in tables.get("sir_wide", spark.range(0)).columns:
            found.append(counts("sir_wide", tables["sir_wide"], meta))
    scope, exposure = tables.get("sample_scope_reference"), tables.get("exposure")
    if version == "v3" and scope is not None and exposure is not None and set(SCOPE_V3.required) <= set(scope.columns) and set(EXPOSURE.required) <= set(exposure.columns):
        found.append(exposure_breaches("exposure", exposure, scope, context_eligible()))
        names += [("exposure", f"SEJUF: {x}") for x in ("not in the scope", "codes differ from the scope", "eligibility differs from the context")]
    return report(spark, [_found(spark, stated), *found], names, most)


#: What the manifest of an older wide table must say, and its lists of columns that the table must have.
LEGACY_FIELDS = ["artifact_version", "created_at", "sir_wide_n_rows", "sir_wide_n_eltid", "atb_cols", "filtre_atb"]
LEGACY_LISTS = ["atb_cols", "supported_atb_cols", "phenotype_status_cols", "phenotype_flag_cols"]


def legacy_report(spark: SparkSession, wide: DataFrame, meta: dict, most: int = MOST) -> DataFrame:
    """The report of a wide table that has a manifest but no contract: fields that the manifest lacks, columns
    that it names and the table lacks, and the numbers of rows and documents that it states."""
    table = "sir_wide"
    stated = [(table, "meta: missing", k) for k in LEGACY_FIELDS if k not in meta]
    stated += [(table, f"{k}: no such column", c) for k in LEGACY_LISTS for c in meta.get(k) or [] if c not in wide.columns]
    names = [(table, "meta: missing"), *((table, f"{k}: no such column") for k in LEGACY_LISTS), (table, "sir_wide_n_rows: not as stated"), (table, "sir_wide_n_eltid: not as stated"), (table, "column: missing")]
    known = "ELTID" in wide.columns
    if not known and "sir_wide_n_eltid" in meta:
        stated.append((table, "column: missing", "ELTID"))
    counted = wide if known else wide.withColumn("ELTID", F.lit(None).cast("string"))
    found = counts(table, counted, meta if known else {k: v for k, v in meta.items() if k != "sir_wide_n_eltid"})
    return report(spark, [_found(spark, stated), found], names, most)


RUNTIME_SCOPE = ["PATID", "EVTID", "ELTID", "SEJUF", "sample_uf_is_eligible_by_ta_de", "sample_uf_ta_de_status", "sample_uf_ta_de_reason"]


def runtime_report(spark: SparkSession, wide: DataFrame, scoped: DataFrame, analytic: DataFrame, denominator: DataFrame, exposure: DataFrame | None = None, most: int = MOST) -> DataFrame:
    """The report of what indicators read: scoped isolates (as many as wide), the analytic ones among
    them (all eligible), nights by year, and an exposure if there is one."""
    stated, found, names = [], [], []
    for name, df in (("scope", scoped), ("analytic", analytic)):
        stated += [(name, "column: missing", c) for c in RUNTIME_SCOPE if c not in df.columns]
        names.append((name, "column: missing"))
    if "sample_uf_is_eligible_by_ta_de" in analytic.columns:
        found.append(breaches("analytic", analytic, [Check("row: not eligible", ~F.coalesce("sample_uf_is_eligible_by_ta_de", F.lit(False)), key_text([c for c in ("PATID", "EVTID", "ELTID") if c in analytic.columns]))]))
        names.append(("analytic", "row: not eligible"))
    size = lambda df, c: df.agg(F.count("*").alias(c))
    # three tables of one row each
    one = size(wide, "w").join(size(scoped, "s"), F.lit(True)).join(size(analytic, "a"), F.lit(True))
    pair = lambda a, b: F.concat_ws(" ", F.col(a).cast("string"), F.lit("rows, of the other table"), F.col(b).cast("string"))
    found += [breaches("scope", one, [Check("rows: not those of sir_wide", F.col("s") != F.col("w"), pair("s", "w"))]), breaches("analytic", one, [Check("rows: more than in scope", F.col("a") > F.col("s"), pair("a", "s"))])]
    names += [("scope", "rows: not those of sir_wide"), ("analytic", "rows: more than in scope")]
    for name, df, contract in (("denominator", denominator, replace(DENOMINATOR, whole=("calendar_year", "hospital_nights"))), *([("exposure", exposure, EXPOSURE)] if exposure is not None else [])):
        stated += [(name, "column: missing", c) for c in contract.required if c not in df.columns]
        some = checks(contract, df.columns)
        found += [breaches(name, df, some)] if some else []
        names += [(name, "column: missing"), *((name, c.name) for c in some)]
        if set(contract.grain) <= set(df.columns):
            found.append(repeated(name, df, contract.grain))
            names.append((name, GRAIN))
    return report(spark, [_found(spark, stated), *found], names, most)
