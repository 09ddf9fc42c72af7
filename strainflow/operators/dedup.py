"""Isolate deduplication: greedy first-fit classes of compatible isolates in each group.

Two isolates conflict if some column is S in one and R in the other. In order, an isolate joins
the first class without a conflict, else it opens one. A class is kept as the union of its
members' S and R columns, as bits: a conflict with a member is a conflict with the union. So the
fold over a group carries two integers for each class.

Isolates with the same S and R columns are in one class, that of the first of them: classes before
it conflict with all of them, and the union of its own fits them, as it holds them. So Spark
reduces a group, however large, to its distinct pairs of masks with their first and last place,
only these are folded (at most 3 ^ columns of a group: 729 for six), and their classes are joined
back. With dozens of columns the bound is the number of distinct isolates of a group, which is
small for patient and year, the groups of the reference.

A group without a conflict is one class, whatever the order: its union holds no column as both S and
R, so no two members conflict. Only groups with one are folded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strainflow.sources.stage import staged


def bits(columns: list[Column], value: str) -> Column:
    """A bit for each column that has the value; 62 columns at most."""
    if len(columns) > 62:
        raise ValueError("more columns than a mask has bits")
    out = F.lit(0).cast("bigint")
    for k, c in enumerate(columns):
        out = out.bitwiseOR(F.when(c == value, F.lit(1 << k).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


def _fold(items: Column) -> Column:
    """Each item's class, from 1, of items in order (array of structs with s and r)."""
    state = "struct<classes: array<struct<s: bigint, r: bigint>>, given: array<int>>"
    begin = F.struct(F.array().cast("array<struct<s:bigint,r:bigint>>").alias("classes"), F.array().cast("array<int>").alias("given")).cast(state)

    def step(acc: Column, x: Column) -> Column:
        fits = F.transform(acc["classes"], lambda c: c["s"].bitwiseAND(x["r"]).bitwiseOR(c["r"].bitwiseAND(x["s"])) == 0)
        at = F.array_position(fits, F.lit(True)).cast("int")
        added = F.transform(acc["classes"], lambda c, i: F.when(i + 1 == at, F.struct(c["s"].bitwiseOR(x["s"]).alias("s"), c["r"].bitwiseOR(x["r"]).alias("r"))).otherwise(c))
        opened = F.concat(acc["classes"], F.array(F.struct(x["s"].alias("s"), x["r"].alias("r"))))
        class_ = F.when(at > 0, at).otherwise(F.size(acc["classes"]) + 1)
        return F.struct(F.when(at > 0, added).otherwise(opened).alias("classes"), F.concat(acc["given"], F.array(class_)).alias("given")).cast(state)

    return F.aggregate(items, begin, step, lambda acc: acc["given"])


def _key(order: list[Column]) -> Column:
    """A struct that sorts as the columns do with nulls last."""
    return F.struct(*[f for k, c in enumerate(order) for f in (c.isNull().alias(f"n{k}"), c.alias(f"v{k}"))])


def scoped(df: DataFrame, scopes: dict[str, list[str]], row_id: str, results: list[str], statuses: list[str], order: list[Column]) -> DataFrame:
    """(scope, group columns of any scope, row_id, class_id, n_docs, n_classes, n_classes_reversed, susceptible,
    resistant): as classes() gives for each scope's groups, and the row's masks. A scope's other group
    columns are null.

    Rows are marked with what their groups hold by windows, so they need not be joined with what is
    found, and are written once, a row whatever the number of scopes. Where df lies by columns that are
    in all groups, that is without a shuffle."""
    cells = [F.col(c) for c in results] + [F.when(F.col(c) == "positive", "R").otherwise("S") for c in statuses]
    names = list(dict.fromkeys(c for group in scopes.values() for c in group))
    marked = df.select(*names, F.col(row_id).alias("_id"), bits(cells, "S").alias("_s"), bits(cells, "R").alias("_r"), *[c.alias(f"_o{k}") for k, c in enumerate(order)])
    for k, group in enumerate(scopes.values()):
        whole = Window.partitionBy(*group)
        clash = F.bit_or("_s").over(whole).bitwiseAND(F.bit_or("_r").over(whole)) != 0
        marked = marked.withColumns({f"_n{k}": F.count("*").over(whole).cast("int"), f"_clash{k}": clash})
    marked = staged(marked, "marked")
    key = _key([F.col(f"_o{k}") for k in range(len(order))])
    own = [F.struct(F.lit(s).alias("scope"), *[(F.col(c) if c in group else F.lit(None).cast(marked.schema[c].dataType)).alias(c) for c in names], F.col(f"_n{k}").alias("n_docs"), F.col(f"_clash{k}").alias("_clash")) for k, (s, group) in enumerate(scopes.items())]
    rest = [c for c in marked.columns if c.startswith("_o")]
    each = marked.select("_id", "_s", "_r", *rest, F.explode(F.array(*own)).alias("x")).select("x.*", "_id", "_s", "_r", *rest)
    masks = [F.col("_s").alias("susceptible"), F.col("_r").alias("resistant")]
    one = F.lit(1)
    calm = each.filter("not _clash").select("scope", *names, F.col("_id").alias(row_id), one.alias("class_id"), "n_docs", one.alias("n_classes"), one.alias("n_classes_reversed"), *masks)
    return calm.unionByName(_folded(each.filter("_clash").withColumn("_k", key), ["scope", *names], row_id, masks))


def _folded(keyed: DataFrame, group: list[str], row_id: str, more: list[Column]) -> DataFrame:
    """scoped()'s rows of groups with a conflict, by the fold over their distinct masks."""
    masks = keyed.groupBy(*group, "_s", "_r").agg(F.min("_k").alias("first"), F.max("_k").alias("last"))
    item = lambda place: F.struct(F.col(place).alias("k"), F.col("_s").alias("s"), F.col("_r").alias("r"))
    grouped = masks.groupBy(*group).agg(F.array_sort(F.collect_list(item("first"))).alias("_items"), F.array_sort(F.collect_list(item("last"))).alias("_lasts"))
    folded = grouped.withColumn("_given", _fold(F.col("_items"))).withColumn("_back", _fold(F.reverse("_lasts")))
    each = F.explode(F.arrays_zip(F.col("_items.s").alias("s"), F.col("_items.r").alias("r"), F.col("_given").alias("class_id"))).alias("x")
    found = folded.select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(group)], F.array_max("_given").alias("n_classes"), F.array_max("_back").alias("n_classes_reversed"), each)
    same = (F.col("_s") == F.col("x.s")) & (F.col("_r") == F.col("x.r"))
    for k, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{k}"))
    return keyed.join(found, same).select(*group, F.col("_id").alias(row_id), F.col("x.class_id").alias("class_id"), "n_docs", "n_classes", "n_classes_reversed", *more)


def classes(df: DataFrame, group: list[str], row_id: str, results: list[str], statuses: list[str], order: list[Column]) -> DataFrame:
    """(group, row_id, class_id, n_docs, n_classes, n_classes_reversed): statuses count as R if
    positive and S otherwise. `order` must be total in a group. n_classes_reversed is what the
    opposite order would give."""
    return scoped(df, {"": group}, row_id, results, statuses, order).drop("scope", "susceptible", "resistant")


def representatives(df: DataFrame, group: list[str], class_id: str, order: list[Column], statuses: list[str] = ()) -> DataFrame:
    """The first row of each class in order (nulls last). Its statuses are the class's: positive
    if any member is, else negative."""
    whole = Window.partitionBy(*group, class_id)
    for c in statuses:
        df = df.withColumn(c, F.when(F.coalesce(F.bool_or(F.col(c) == "positive").over(whole), F.lit(False)), "positive").otherwise("negative"))
    first = F.row_number().over(whole.orderBy(*[c.asc_nulls_last() for c in order]))
    return df.withColumn("_first", first).filter("_first = 1").drop("_first")


def stay_rank(df: DataFrame, group: list[str], stay: str, order: list[Column], out: str) -> DataFrame:
    """df with the rank of each stay in its group, by the stay's first row in order; rows without a
    stay have none."""
    first = F.min(_key(order)).over(Window.partitionBy(*group, stay))
    among = F.dense_rank().over(Window.partitionBy(*group, F.col(stay).isNull()).orderBy("_at", stay))
    return df.withColumn("_at", first).withColumn(out, F.when(F.col(stay).isNotNull(), among)).drop("_at")
