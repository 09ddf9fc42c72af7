"""Long observations to wide isolates: document exclusion, ordered pivots, asserted attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def diagnostic_documents(df: DataFrame, patient: str, stay: str, document: str, diagnostic: Column) -> DataFrame:
    """Drops a whole document if any of its rows isn't diagnostic. A document is known by
    patient, stay and document, but by patient and document where a row of that pair lacks the
    stay; rows without patient or document stand for themselves."""
    bad, known = ~F.coalesce(diagnostic, F.lit(False)), F.col(patient).isNotNull() & F.col(document).isNotNull()
    documents = df.filter(known).groupBy(F.col(patient).alias("_p"), F.col(document).alias("_d"))
    marked = documents.agg(F.bool_or(F.col(stay).isNull()).alias("_lacks"), F.bool_or(bad).alias("_bad"), F.collect_set(F.when(bad, F.col(stay))).alias("_stays")).filter("_bad")
    gone = (F.col(patient) == F.col("_p")) & (F.col(document) == F.col("_d")) & (F.col("_lacks") | F.array_contains("_stays", F.col(stay)))
    return df.filter(known | ~bad).join(marked, gone, "left_anti")


def last_value(value: Column, order: Column) -> Column:
    """Aggregate: the last value in order that isn't null."""
    return F.max_by(value, F.when(value.isNotNull(), order))


def first_value(value: Column, order: Column) -> Column:
    return F.min_by(value, F.when(value.isNotNull(), order))


#: What a packed cell's last two bits say; a fixed order.
CODES = ["S", "R", "ZIT"]


def packed(value: Column, order: Column) -> Column:
    """A result (S, R or ZIT; null stays null) and its place in one number: the order in the high bits,
    the value's code in the low ones, so that the largest is the last. order: whole numbers from 0
    below 2 ** 61. Other values raise. unpacked() gives the value."""
    code = F.raise_error(F.concat(F.lit("not a susceptibility result: "), value)).cast("bigint")
    for k, name in enumerate(CODES, 1):
        code = F.when(value == name, F.lit(k).cast("bigint")).otherwise(code)
    return F.when(value.isNotNull(), F.shiftleft(order.cast("bigint"), 2).bitwiseOR(code))


def unpacked(cell: Column) -> Column:
    return F.get(F.array(*map(F.lit, CODES)), cell.bitwiseAND(3).cast("int") - 1)


def widen(df: DataFrame, keys: list[str], name: str, value: str, names: list[str], order: Column, extra: dict[str, Column] | None = None) -> DataFrame:
    """A row for each key: a column for each of names with the last value in order, further
    aggregates, and nb_resultats, the number of S and R. Cells are packed numbers, so Spark adds them
    up in a hash table before the shuffle; order is as packed() takes it."""
    cells = [F.max(F.when(F.col("_slot") == k, F.col("_cell"))).alias(n) for k, n in enumerate(names, 1)]
    more = [c.alias(k) for k, c in (extra or {}).items()]
    slot = F.array_position(F.array(*map(F.lit, names)), F.col(name)).cast("int")
    wide = df.withColumns({"_cell": packed(F.col(value), order), "_slot": slot}).groupBy(*keys).agg(*cells, *more).withColumns({n: unpacked(F.col(f"`{n}`")) for n in names})
    return wide.withColumn("nb_resultats", completeness(names))


def completeness(names: list[str]) -> Column:
    """How many of the columns hold S or R."""
    return sum((F.coalesce(F.col(n).isin("S", "R"), F.lit(False)).cast("int") for n in names), F.lit(0))


def result_columns(df: DataFrame, candidates: list[str] | None = None, known: list[str] = ()) -> list[str]:
    """The candidates (all text columns unless given) that have a value, and only S, R or ZIT; one
    aggregate. What a manifest names (`known`) goes first, if it is there."""
    names = candidates if candidates is not None else [c for c, kind in df.dtypes if kind == "string"]
    counts = df.agg(*[F.struct(F.count(f"`{c}`").alias("n"), F.count_if(~F.col(f"`{c}`").isin(CODES)).alias("odd")).alias(c) for c in names]).first() if names else {}
    found = [c for c in names if counts[c]["n"] and not counts[c]["odd"]]
    return [c for c in known if c in found] + [c for c in found if c not in known]
