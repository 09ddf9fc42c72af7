"""First-fit classes of groups that are large."""

from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from strainflow.operators import dedup


def _first_fit(rows) -> list[int]:
    classes, out = [], []
    for cells in rows:
        at = next((k for k, c in enumerate(classes) if not any({a, b} == {"S", "R"} for m in c for a, b in zip(m, cells, strict=True))), len(classes))
        if at == len(classes):
            classes.append([])
        classes[at].append(cells)
        out.append(at + 1)
    return out


def test_only_distinct_masks_are_folded(spark, monkeypatch):
    """Groups of hundreds of rows and of a null year are folded as at most 27 items, with the same classes."""
    fold, rng = dedup._fold, random.Random(4)
    few = lambda items: F.when(F.size(items) <= 27, fold(items)).otherwise(F.raise_error(F.lit("a group is folded row by row")).cast("array<int>"))
    monkeypatch.setattr(dedup, "_fold", few)
    rows = [(rng.choice(["a", "b", None]), k, *(rng.choice(["S", "R", "ZIT", None]) for _ in range(3)), rng.choice([None, *range(20)])) for k in range(900)]
    frame = spark.createDataFrame(rows, "grp string, id int, x string, y string, z string, o int")
    got = dedup.classes(frame, ["grp"], "id", ["x", "y", "z"], [], [F.col("o"), F.col("id")]).collect()
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[5] is None, r[5] or 0, r[1])):
        groups[r[0]].append(r)
    wanted = []
    for g, some in groups.items():
        given, back = (_first_fit([r[2:5] for r in x]) for x in (some, some[::-1]))
        wanted += [(g, r[1], c, len(some), max(given), max(back)) for r, c in zip(some, given, strict=True)]
    assert sorted(map(tuple, got), key=lambda r: r[1]) == sorted(wanted, key=lambda r: r[1])


def test_only_groups_with_conflicts_are_folded(spark, monkeypatch):
    """A group whose columns hold no S beside an R is one class without a fold; the others have the fold's classes."""
    fold = dedup._fold
    both = lambda items: F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x["s"])).bitwiseAND(F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x["r"])))
    monkeypatch.setattr(dedup, "_fold", lambda items: F.when(both(items) != 0, fold(items)).otherwise(F.raise_error(F.lit("a group without a conflict is folded")).cast("array<int>")))
    rows = [("a", 1, "S", None), ("a", 2, None, "R"), ("a", 3, "S", "R"), (None, 4, "S", None), (None, 5, "R", None), ("b", 6, "ZIT", None)]
    frame = spark.createDataFrame(rows, "grp string, id int, x string, y string")
    got = dedup.classes(frame, ["grp"], "id", ["x", "y"], [], [F.col("id")]).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == [("a", 1, 1, 3, 1, 1), ("a", 2, 1, 3, 1, 1), ("a", 3, 1, 3, 1, 1), (None, 4, 1, 2, 2, 2), (None, 5, 2, 2, 2, 2), ("b", 6, 1, 1, 1, 1)]
