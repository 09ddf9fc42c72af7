"""Plausibility rules on wide isolates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns that the rules read.
THIRD_GENERATION = ["cefotaxime", "ceftazidime", "ceftriaxone"]
FLUOROQUINOLONES = ["ofloxacine", "levofloxacine", "moxifloxacine", "ciprofloxacine"]


def _cell(columns: list[str], name: str) -> Column:
    return F.col(name) if name in columns else F.lit(None).cast("string")


def _any_r(columns: list[str], names: list[str]) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | F.coalesce(_cell(columns, n) == "R", F.lit(False))
    return out


def flags(df: DataFrame, roles: dict[str, str] | None = None) -> dict[str, Column]:
    """The rules by name. `roles` names the columns that stand for the rules' own."""
    at = lambda n: (roles or {}).get(n, n)
    c = lambda n: _cell(df.columns, at(n))
    some = lambda names: _any_r(df.columns, [at(n) for n in names])
    order, name = F.col("bact_order") == "Enterobacterales", F.col("bact_norm")
    rules = {
        "qc_saureus_oxa_cefox_discordance": (name == "staphylococcus_aureus") & (c("oxacilline") != c("cefoxitine")),
        "qc_enterobacterales_amoxampi_s_c3g_r": order & (c("amoxicilline_ampicilline") == "S") & some(THIRD_GENERATION),
        "qc_enterobacterales_nalidixic_s_fq_r": order & (c("acide_nalidixique") == "S") & some(FLUOROQUINOLONES),
        "qc_klebsiella_enterobacter_amoxampi_s": name.isin("klebsiella_pneumoniae", "enterobacter_cloacae_complex") & (c("amoxicilline_ampicilline") == "S"),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in rules.items()}


def flagged(df: DataFrame, roles: dict[str, str] | None = None) -> DataFrame:
    rules = flags(df, roles)
    out = df.withColumns(rules)
    any_ = F.lit(False)
    for k in rules:
        any_ = any_ | F.col(k)
    return out.withColumn("qc_any", any_)


def summary(marked: DataFrame) -> DataFrame:
    names = [c for c in marked.columns if c.startswith("qc_") and c != "qc_any"]
    n, k = F.count("*"), F.count_if(F.col("qc_any"))
    return marked.agg(n.alias("n_rows"), k.alias("n_excluded"), F.when(n > 0, 100.0 * k / n).alias("pct_excluded"), *[F.count_if(F.col(c)).alias(c) for c in names])


def plausible(marked: DataFrame) -> DataFrame:
    return marked.filter(~F.col("qc_any")).drop(*[c for c in marked.columns if c.startswith("qc_")])
