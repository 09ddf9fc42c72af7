"""Cells of a report's tables: what panels of proportions and incidences show, with the places of rows and
columns as numbers. All are expressions on a panel's rows; nothing is gathered.

Levels are lists of names in the order of display; a name that a level lacks has no label and no
place. Numbers are rounded as their binary value says, to the even digit where it lies between two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainflow.functions.labels import shown


def _fixed(x: Column, digits: int) -> Column:
    return F.coalesce(F.call_function("format_number", x.cast("double"), F.lit("0." + "0" * digits)), F.lit("NA"))


def _count(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("NA"))


def _place(x: Column, levels: list[str]) -> Column:
    """From 1; null for a name that isn't a level."""
    return F.nullif(F.array_position(F.array(*map(F.lit, levels)).cast("array<string>"), x), F.lit(0)).cast("int")


def placed(panel: DataFrame, datasets: list[str], indicators: list[str], names: dict[str, str], dataset: str = "dataset", indicator: str = "indicator_label") -> DataFrame:
    """panel with dataset_label, dataset_place and indicator_place (the last level of the list is 1)."""
    label = shown(F.col(dataset), names)
    place = _place(label, datasets)
    return panel.withColumns({"dataset_label": F.when(place.isNotNull(), label), "dataset_place": place, "indicator_place": _place(F.col(indicator), indicators[::-1])})


def proportion_cells(panel: DataFrame, fewest: int, datasets: list[str], indicators: list[str], names: dict[str, str], sample_types: list[str] | None = None, **columns: str) -> DataFrame:
    """panel (n_tested, pct_resistant) with pct_shown and cell: under `fewest` tested isolates only their
    number. With sample_types, panels are pairs of sample type and dataset: panel_label, panel_place."""
    fewest, n, pct = max(0, int(fewest)), F.col("n_tested"), F.col("pct_resistant")
    number = F.concat(F.lit("n="), _count(n))
    cell = F.when(n == 0, "n=0").when(n < fewest, number).otherwise(F.concat(_fixed(pct, 1), F.lit("%\n("), number, F.lit(")")))
    out = placed(panel, datasets, indicators, names, **columns).withColumns({"pct_shown": F.when(n >= fewest, pct), "cell": cell})
    if sample_types is None:
        return out
    kind = _place(F.col("sample_type"), sample_types)
    label = F.when(kind.isNotNull(), F.concat("sample_type", F.lit("\n"), "dataset_label"))
    return out.withColumns({"panel_label": label, "panel_place": (kind - 1) * len(datasets) + F.col("dataset_place")})


def incidence_cells(panel: DataFrame, datasets: list[str], indicators: list[str], names: dict[str, str], density: str = "density", **columns: str) -> DataFrame:
    """panel (density, n_resistant) with cell."""
    cell = F.concat(_fixed(F.col(density), 2), F.lit("\n(R="), _count(F.col("n_resistant")), F.lit(")"))
    return placed(panel, datasets, indicators, names, **columns).withColumn("cell", cell)
