"""Indicators: a catalogue of specifications, evaluated over isolates in one scan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["class_any_r", "molecule_direct", "molecule_priority", "phenotype_flag"]
SCOPES = ["global", "by_type"]


@dataclass(frozen=True)
class Indicator:
    """kind: class_any_r and molecule_direct are R if any molecule is; molecule_priority takes the
    first molecule with S or R; phenotype_flag reads a boolean column."""

    id: str
    kind: str
    molecules: tuple[str, ...] = ()
    flag: str | None = None
    organism_type: str | None = None  # bact_norm, bact_order or enterobacterales_other
    organisms: tuple[str, ...] = ()
    sample_types: tuple[str, ...] = ()
    scopes: tuple[str, ...] = field(default=("global",))


def validate(spec: Indicator, columns: list[str]) -> list[str]:
    """What is wrong with a specification; nothing if it can be evaluated."""
    out = [] if spec.kind in KINDS else [f"unknown kind {spec.kind}"]
    if spec.kind == "phenotype_flag":
        out += [] if spec.flag in columns else [f"no column {spec.flag}"]
    elif not [m for m in spec.molecules if m in columns]:
        out.append("no molecule is a column")
    if spec.organism_type not in (None, "bact_norm", "bact_order", "enterobacterales_other"):
        out.append(f"unknown organism type {spec.organism_type}")
    return out + [f"unknown scope {s}" for s in spec.scopes if s not in SCOPES]


def organism_filter(spec: Indicator) -> Column:
    if spec.organism_type is None or not spec.organisms:
        return F.lit(True)
    listed = lambda c: F.coalesce(F.col(c).isin(*spec.organisms), F.lit(False))
    if spec.organism_type == "enterobacterales_other":
        return F.coalesce(F.col("bact_order") == "Enterobacterales", F.lit(False)) & ~listed("bact_norm")
    return listed(spec.organism_type)


def result(spec: Indicator, columns: list[str]) -> Column:
    """R, S or O (not tested) of an isolate."""
    if spec.kind == "phenotype_flag":
        return F.when(F.col(spec.flag).isNull(), None).when(F.col(spec.flag), "R").otherwise("S")
    cells = [F.when(F.col(m).isin("S", "R"), F.col(m)) for m in spec.molecules if m in columns]
    if spec.kind == "molecule_priority":
        return F.coalesce(*cells, F.lit("O"))
    return F.when(F.coalesce(F.array_contains(F.array(*cells), "R"), F.lit(False)), "R").when(F.coalesce(*cells).isNull(), "O").otherwise("S")


def _typed(spec: Indicator, scope: str, sample_type: str) -> Column:
    """Whether an isolate's sample type is one of the indicator's, which holds for all in the global scope."""
    return F.lit(True) if scope == "global" or not spec.sample_types else F.coalesce(F.col(sample_type).isin(*spec.sample_types), F.lit(False))


def evaluate(isolates: DataFrame, specs: list[Indicator], scope: str, sample_type: str) -> DataFrame:
    """isolates with a row for each indicator that applies: indicator_id and indicator_result. The
    catalogue is an array of expressions, so isolates are read once however many there are."""
    columns, items = isolates.columns, []
    for s in specs:
        if scope in s.scopes and not validate(s, columns):
            items.append(F.when(organism_filter(s) & _typed(s, scope, sample_type), F.struct(F.lit(s.id).alias("id"), result(s, columns).alias("result"))))
    if not items:
        return isolates.limit(0).withColumns({"indicator_id": F.lit(""), "indicator_result": F.lit("")})
    out = isolates.withColumn("_x", F.explode(F.array_compact(F.array(*items))))
    return out.withColumns({"indicator_id": F.col("_x.id"), "indicator_result": F.col("_x.result")}).drop("_x")


def proportions(evaluated: DataFrame, keys: list[str]) -> DataFrame:
    """Yearly counts and the resistant share of tested isolates, in per cent; null if none is."""
    r, s = F.count_if(F.col("indicator_result") == "R"), F.count_if(F.col("indicator_result") == "S")
    out = evaluated.groupBy("indicator_id", *keys).agg(F.count("*").alias("n_isolates"), r.alias("n_resistant"), s.alias("n_susceptible"), F.count_if(F.col("indicator_result") == "O").alias("n_untested"))
    tested = F.col("n_resistant") + F.col("n_susceptible")
    return out.withColumn("n_tested", tested).withColumn("pct_resistant", F.when(tested > 0, 100.0 * F.col("n_resistant") / tested))


def scoped_proportions(isolates: DataFrame, specs: list[Indicator], year: str, sample_type: str) -> DataFrame:
    """proportions() of all scopes, with the column `scope`: isolates are read once. A scope without
    sample types has a null one."""
    rows = isolates
    for scope in SCOPES:
        items = [s for s in specs if scope in s.scopes and not validate(s, isolates.columns)]
        cells = [F.when(organism_filter(s) & _typed(s, scope, sample_type), F.struct(F.lit(s.id).alias("id"), result(s, isolates.columns).alias("result"), F.lit(scope).alias("scope"))) for s in items]
        rows = rows.withColumn(f"_x{scope}", F.array(*cells).cast("array<struct<id:string,result:string,scope:string>>"))
    each = rows.select(year, sample_type, F.explode(F.array_compact(F.concat(*[F.col(f"_x{scope}") for scope in SCOPES]))).alias("x"))
    shown = each.select(year, F.when(F.col("x.scope") == "by_type", F.col(sample_type)).alias(sample_type), F.col("x.id").alias("indicator_id"), F.col("x.result").alias("indicator_result"), F.col("x.scope").alias("scope"))
    return proportions(shown, ["scope", year, sample_type])


def incidence(evaluated: DataFrame, specs: list[Indicator], denominator: DataFrame, year: str, per: int = 1000) -> DataFrame:
    """Raises for a specification that evaluate() had to leave out, since its 0 would be no count.
    Resistant isolates for each indicator and denominator year, also where there are none, per
    `per` nights; null if there are no nights. denominator: (calendar_year, nights)."""
    if blocked := [f"{s.id}: {'; '.join(p)}" for s in specs if (p := validate(s, evaluated.columns))]:
        raise ValueError(f"indicators that can't be computed: {' / '.join(blocked[:10])}")
    ids = F.explode(F.array(*[F.lit(s.id) for s in specs]))
    spine = denominator.select("calendar_year", "nights", ids.alias("indicator_id"))
    counts = evaluated.groupBy("indicator_id", F.col(year).alias("_year")).agg(F.count("*").alias("n"), F.count_if(F.col("indicator_result") == "R").alias("r")).withColumnRenamed("indicator_id", "_id")
    out = spine.join(counts, (F.col("indicator_id") == F.col("_id")) & (F.col("calendar_year") == F.col("_year")), "left")
    r = F.coalesce("r", F.lit(0))
    return out.select("indicator_id", "calendar_year", "nights", F.coalesce("n", F.lit(0)).alias("n_isolates"), r.alias("n_resistant"), F.when(F.col("nights") > 0, float(per) * r / F.col("nights")).alias("density"))


def published_incidence(panel: DataFrame, year: str, excluded: list[int]) -> DataFrame:
    """incidence()'s rows outside the excluded years; of those left, one without positive nights, or with a
    negative or missing density, raises when the result is used."""
    kept = panel.filter(~F.col(year).isin(excluded) | F.col(year).isNull()) if excluded else panel
    good = (F.col("nights") > 0) & (F.col("density") >= 0)
    text = F.concat(F.lit("an incidence without nights or density: "), F.to_json(F.struct("indicator_id", year)))
    return kept.filter(F.when(F.coalesce(good, F.lit(False)), True).otherwise(F.raise_error(text).cast("boolean")))
