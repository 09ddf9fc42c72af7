"""From wide isolates to what indicators read: years of stays, ranks of stays and documents, filled
stay ids, document scopes, and first-fit classes in several scopes with their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strainflow.operators import dedup
from strainflow.sources.stage import dealt


def resolve_stays(df: DataFrame, patient: str, document: str, stay: str) -> DataFrame:
    """df with missing stay ids filled where the rows of the document name one. A missing one where
    they name several raises when the result is used. Rows lie by patient and document for it once."""
    whole = Window.partitionBy(patient, document)
    named = df.withColumns({"_least": F.min(stay).over(whole), "_most": F.max(stay).over(whole)})
    text = F.concat_ws(" ", F.lit("rows without a stay of a document with several:"), patient, document)
    unclear = F.col(stay).isNull() & (F.col("_least") != F.col("_most"))
    named = named.filter(F.when(unclear, F.raise_error(text).cast("boolean")).otherwise(True))
    return named.withColumn(stay, F.coalesce(stay, "_least")).drop("_least", "_most")


def marked_documents(df: DataFrame, keys: list[str], analysis: Column, screening: list[str], is_result: Column) -> DataFrame:
    """df with is_result, and document_scope()'s is_screening and has_results of its row's document."""
    whole = Window.partitionBy(*keys)
    marks = {"is_screening": F.bool_or("_screens").over(whole), "has_results": F.bool_or("is_result").over(whole)}
    told = df.withColumns({"_screens": F.coalesce(analysis.isin(screening), F.lit(False)), "is_result": F.coalesce(is_result, F.lit(False))})
    return told.withColumns(marks).drop("_screens")


def document_scope(df: DataFrame, keys: list[str], analysis: Column, screening: list[str], is_result: Column) -> DataFrame:
    """(keys, is_screening, has_results): whether any row of a document is of a screening analysis,
    and whether any holds a susceptibility result."""
    screened = F.bool_or(F.coalesce(analysis.isin(screening), F.lit(False)))
    return df.groupBy(*keys).agg(screened.alias("is_screening"), F.bool_or(F.coalesce(is_result, F.lit(False))).alias("has_results"))


def raw_dataset(df: DataFrame, patient: str, stay: str, day: str) -> DataFrame:
    """df with the year in which its stay begins and the year of its own day. A row without a day
    raises when the result is used."""
    text = F.lit(f"a row without {day}")
    df = df.filter(F.when(F.to_date(day).isNull(), F.raise_error(text).cast("boolean")).otherwise(True))
    first = df.groupBy(F.col(patient).alias("_p"), F.col(stay).alias("_s")).agg(F.min(F.to_date(day)).alias("_first"))
    out = df.join(first, df[patient].eqNullSafe(F.col("_p")) & df[stay].eqNullSafe(F.col("_s")))
    return out.withColumns({"stay_start_year": F.year("_first"), "dedup_year": F.year(F.to_date(day))}).drop("_p", "_s", "_first")


def ranks(df: DataFrame, group: list[str], stay: str, document: str, order: list[Column], given: str | None = None) -> DataFrame:
    """df with evt_order, the rank of its stay in the group by the stay's first row in order, and
    elt_order, the rank of its document in the stay by the document's first row; null for rows
    without one. A given stay order wins where it isn't null. Groups are those of one patient and year."""
    out = dedup.stay_rank(df, group, stay, order, "evt_order")
    if given:
        out = out.withColumn("evt_order", F.coalesce(given, "evt_order"))
    return dedup.stay_rank(out, [*group, "evt_order", stay], document, order, "elt_order")


def scoped_classes(df: DataFrame, scopes: dict[str, list[str]], row_id: str, results: list[str], statuses: list[str], order: list[Column]) -> DataFrame:
    """(scope, row_id, class_id, n_docs, n_classes, n_classes_reversed, susceptible, resistant) for each
    scope's groups, and the groups as group_ columns. Each scope's other groups are null, so one fold
    serves all scopes."""
    names = dict.fromkeys(c for group in scopes.values() for c in group)
    return dedup.scoped(df, scopes, row_id, results, statuses, order).withColumnsRenamed({c: f"group_{c}" for c in names})


def check_scopes(found: DataFrame, rows: int) -> DataFrame:
    """For each scope of scoped_classes(): rows, classes, classes with an S and an R in one column (must be
    0), and classes in the opposite order; n_groups and n_group_conflicts are the same of whole groups. A
    conflict of two members is one of the unions of their cells. rows: about how many found has."""
    own = ["scope", *[c for c in found.columns if c.startswith("group_")]]
    clash = F.count_if(F.col("s").bitwiseAND(F.col("r")) != 0)
    # classes lie with their group: one shuffle
    each = dealt(found.select(*own, "class_id", "n_classes_reversed", "susceptible", "resistant"), rows, *own)
    each = each.groupBy(*own, "class_id").agg(F.bit_or("susceptible").alias("s"), F.bit_or("resistant").alias("r"), F.count("*").alias("n"), F.max("n_classes_reversed").alias("back"))
    groups = each.groupBy(*own).agg(F.sum("n").alias("n"), F.count("*").alias("n_classes"), clash.alias("n_conflicts"), F.bit_or("s").alias("s"), F.bit_or("r").alias("r"), F.max("back").alias("back"))
    return groups.groupBy("scope").agg(
        F.sum("n").alias("n_rows"),
        F.sum("n_classes").alias("n_classes"),
        F.sum("n_conflicts").alias("n_conflicts"),
        F.sum("back").alias("n_classes_reversed"),
        F.count("*").alias("n_groups"),
        clash.alias("n_group_conflicts"),
    )


def isolate_id(parts: list[Column]) -> Column:
    """An id of an isolate that has none, from its keys; nulls count as NA."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])


def populations(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, stage_place, n_rows): how many rows each stage left, in one job; an empty stage has 0."""
    counts = [df.agg(F.lit(name).alias("stage"), F.lit(k).alias("stage_place"), F.count("*").alias("n_rows")) for k, (name, df) in enumerate(stages.items(), 1)]
    if not counts:
        raise ValueError("no stages")
    out = counts[0]
    for more in counts[1:]:
        out = out.union(more)
    return out
