"""Data contracts: columns, types and checks of a table, evaluated in one aggregate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The antibiotic columns of a wide isolate table, in order.
ANTIBIOTICS = [
    "levofloxacine", "rifampicine", "tetracycline", "vancomycine", "acide_fusidique", "erythromycine", "fosfomycine_trometamol", "gentamicine", "kanamycine", "oxacilline", "trimethoprime_sulfamethoxazole", "amikacine",
    "amoxicilline_acide_clavulanique", "amoxicilline_ampicilline", "ceftazidime", "ceftriaxone", "mecillinam", "nitrofurantoine", "ofloxacine", "piperacilline_tazobactam", "ertapeneme", "fosfomycine_iv", "cefepime", "cefotaxime",
    "ciprofloxacine", "imipeneme", "meropeneme", "tobramycine", "pristinamycine", "ticarcilline", "daptomycine", "linezolide", "teicoplanine", "moxifloxacine", "cefoxitine",
]
KEY = ["PATID", "EVTID", "ELTID", "DATEPRELEV", "souche_id", "naturepvt_norm", "bact_norm"]


@dataclass(frozen=True)
class Contract:
    """required: name -> simple type. Other fields are checks of columns."""

    name: str
    required: dict[str, str]
    not_null: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], tuple[tuple[str, str], ...]] = field(default_factory=dict)
    whole: tuple[str, ...] = ()
    not_negative: tuple[str, ...] = ()
    grain: tuple[str, ...] = ()

    def _checks(self) -> dict[str, Column]:
        out = {f"{c}: is null": F.col(c).isNull() for c in self.not_null}
        out |= {f"{c}: not one of the allowed values": ~F.col(c).isin(*v) for c, v in self.allowed.items()}
        for (a, b), some in self.pairs.items():
            out[f"{a}, {b}: not an allowed pair"] = ~F.struct(a, b).isin(*[F.struct(F.lit(x).alias(a), F.lit(y).alias(b)) for x, y in some])
        for c in self.whole:
            x = F.col(c).cast("double")
            out[f"{c}: not a whole number"] = F.isnan(x) | (F.abs(x) == float("inf")) | (F.abs(x - F.round(x)) >= 1.49e-8)
        return out | {f"{c}: negative": F.col(c) < 0 for c in self.not_negative}

    def validate(self, df: DataFrame) -> tuple[list[str], list[str]]:
        """(errors, warnings); all checks of rows are one pass, the grain another."""
        types = dict(df.dtypes)
        errors = [f"{c}: missing" for c in self.required if c not in types]
        errors += [f"{c}: {types[c]}, not {t}" for c, t in self.required.items() if c in types and types[c] != t]
        warnings = [f"{c}: not in the contract" for c in types if c not in self.required]
        if errors:
            return errors, warnings
        checks = self._checks()
        if checks:
            row = df.agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(f"c{k}") for k, v in enumerate(checks.values())]).first()
            errors += [f"{name} in {row[k]} rows" for k, name in enumerate(checks) if row[k]]
        if self.grain and df.groupBy(*self.grain).agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
            errors.append(f"{', '.join(self.grain)}: not unique")
        return errors, warnings

    def select(self, df: DataFrame) -> DataFrame:
        """df with the contract's columns, in its order."""
        return df.select(*self.required)


WIDE = Contract(
    "wide isolates",
    {c: "string" for c in ("PATID", "EVTID", "ELTID")} | {"DATEPRELEV": "date", "HEUREPRELEV": "int"} | {c: "string" for c in ("souche_id", "naturepvt_norm", "bact_norm", "SEJUF", *ANTIBIOTICS, "blse_status_row", "carbapenemase_status_row")} | {"blse_flag": "boolean", "carbapenemase_flag": "boolean"},
    not_null=("PATID", "ELTID", "DATEPRELEV", "souche_id", "bact_norm", "blse_flag", "carbapenemase_flag"),
    allowed={c: ("S", "R", "ZIT") for c in ANTIBIOTICS} | {"blse_status_row": ("negative", "no_signal", "positive"), "carbapenemase_status_row": ("negative", "no_signal", "positive", "unknown")},
    grain=tuple(KEY),
)
DENOMINATOR = Contract("nights by year", {"calendar_year": "int", "hospital_nights": "bigint"}, not_null=("calendar_year", "hospital_nights"), whole=("hospital_nights",), not_negative=("hospital_nights",), grain=("calendar_year",))
# Statuses and reasons of a unit's scope.
_STATUS = ("eligible_ta_de", "excluded_ta", "excluded_de_domain", "review_unmapped_uf", "review_unmapped_de", "review_missing_sample_uf")
_REASON = ("eligible_ta_de", "ta_not_03_20", "ta_03_20_de_domain_not_included", "uf_absent_from_consores_structure", "ta_03_20_unmapped_de", "missing_sample_uf")
SCOPE = Contract(
    "scope of units",
    {"SEJUF": "string", "sample_uf_is_eligible_by_ta_de": "boolean", "sample_uf_ta_de_status": "string", "sample_uf_ta_de_reason": "string"},
    not_null=("SEJUF", "sample_uf_is_eligible_by_ta_de"),
    allowed={"sample_uf_ta_de_status": _STATUS, "sample_uf_ta_de_reason": _REASON},
    grain=("SEJUF",),
)


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(check_name, n): how many rows break each check of values, and how many keys of the grain
    repeat; one aggregate for the values and one for the grain, nothing collected."""
    checks = contract._checks()
    one = df.agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(f"c{k}") for k, v in enumerate(checks.values())])
    out = one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"c{k}").alias("n")) for k, name in enumerate(checks)])).alias("x")).select("x.*")
    if contract.grain:
        repeated = df.groupBy(*contract.grain).agg(F.count("*").alias("_n")).filter("_n > 1")
        out = out.union(repeated.agg(F.lit("grain: not unique").alias("check_name"), F.count("*").alias("n")))
    return out


def validate_bundle(tables: dict[str, DataFrame], contracts: dict[str, Contract], meta: dict | None = None, required_meta: dict | None = None) -> tuple[list[str], list[str]]:
    """(errors, warnings) of a bundle: tables that it lacks, each table against its contract, entries
    of the manifest that differ from what is required, and row counts that it states ("<name>.rows")."""
    errors, warnings = [f"{name}: no such table" for name in contracts if name not in tables], [f"{name}: not in the contract" for name in tables if name not in contracts]
    for name, contract in contracts.items():
        if name in tables:
            wrong, odd = contract.validate(tables[name])
            errors, warnings = errors + [f"{name}: {x}" for x in wrong], warnings + [f"{name}: {x}" for x in odd]
    meta = meta or {}
    errors += [f"meta {k}: {meta.get(k)!r}, not {v!r}" for k, v in (required_meta or {}).items() if meta.get(k) != v]
    for name, df in tables.items():
        stated = meta.get(f"{name}.rows")
        if stated is not None and (found := df.count()) != stated:
            errors.append(f"{name}: {found} rows, not {stated}")
    return errors, warnings


def report(errors: list[str], warnings: list[str], most: int = 10) -> str:
    """A validation's findings as text, the first of each kind."""
    lines = ["valid" if not errors else f"{len(errors)} errors", *[f"- {x}" for x in errors[:most]], f"{len(warnings)} warnings", *[f"- {x}" for x in warnings[:most]]]
    return "\n".join(lines)


def validated(tables: dict[str, DataFrame], contracts: dict[str, Contract], meta: dict | None = None, required_meta: dict | None = None) -> dict[str, DataFrame]:
    """The tables with the columns of their contracts; raises if there are errors."""
    errors, warnings = validate_bundle(tables, contracts, meta, required_meta)
    if errors:
        raise ValueError(report(errors, warnings))
    return {name: contract.select(tables[name]) for name, contract in contracts.items()}


def differences(a: DataFrame, b: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows, with their columns as JSON, that only one side has (side a or b), repeats counted."""
    columns = sorted(set(a.columns) - set(ignore))
    if columns != sorted(set(b.columns) - set(ignore)):
        raise ValueError("the tables have different columns")
    x, y = a.select(*columns), b.select(*columns)
    show = lambda df, side: df.select(F.lit(side).alias("side"), F.to_json(F.struct(*columns)).alias("row"))
    return show(x.exceptAll(y), "a").union(show(y.exceptAll(x), "b"))
