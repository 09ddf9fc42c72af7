"""Published results, locks, layouts and workspaces."""

from __future__ import annotations

import os

import pytest

from strainflow.sources import publish


def _frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_found_again_or_built_once(spark, tmp_path):
    folder, calls = f"file://{tmp_path}/out", []

    def build(value):
        def run():
            calls.append(value)
            return {"t": _frame(spark, value)}

        return run

    tables, meta, built = publish.published(spark, folder, {"a": _frame(spark, 1, 2)}, build(10))
    first = publish.current(spark, folder)
    assert built and tables["t"].first()[0] == 10 and meta["inputs"] == first
    # the same rows in another order are the same inputs
    tables, _, built = publish.published(spark, folder, {"a": _frame(spark, 2, 1)}, build(11))
    assert not built and tables["t"].first()[0] == 10 and calls == [10]
    tables, _, built = publish.published(spark, folder, {"a": _frame(spark, 2, 1)}, build(12), {"year": 2024})
    assert built and tables["t"].first()[0] == 12 and publish.current(spark, folder) != first
    # going back makes the first one current without building it
    publish.published(spark, folder, {"a": _frame(spark, 1, 2)}, build(13))
    assert publish.current(spark, folder) == first and calls == [10, 12]


def test_a_failed_build_leaves_the_old_result(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    publish.published(spark, folder, {"a": _frame(spark, 1)}, lambda: {"t": _frame(spark, 1)})
    before = publish.current(spark, folder)

    def fails():
        raise RuntimeError("died")

    with pytest.raises(RuntimeError, match="died"):
        publish.published(spark, folder, {"a": _frame(spark, 2)}, fails)
    assert publish.current(spark, folder) == before and not (tmp_path / "out" / ".lock").exists()
    # half a bundle, without its manifest, is built anew
    name = publish.inputs_fingerprint({"a": _frame(spark, 2)})
    os.makedirs(tmp_path / "out" / name / "t")
    tables, _, built = publish.published(spark, folder, {"a": _frame(spark, 2)}, lambda: {"t": _frame(spark, 5)})
    assert built and tables["t"].first()[0] == 5


def test_locks(spark, tmp_path):
    folder = f"file://{tmp_path}"
    with publish.lock(spark, folder), pytest.raises(publish.LockedError), publish.lock(spark, folder):
        pass
    (tmp_path / ".lock").write_text("left behind")
    os.utime(tmp_path / ".lock", (1, 1))
    with publish.lock(spark, folder):
        assert (tmp_path / ".lock").exists()
    assert not (tmp_path / ".lock").exists()


def test_overlaps(spark, tmp_path):
    top = f"file://{tmp_path}"
    publish.apart(spark, [f"{top}/a", f"{top}/ab"], [f"{top}/b"])
    for outputs, inputs in (([f"{top}/a/x"], [f"{top}/a"]), ([f"{top}/a"], [f"{top}/a/x"]), ([f"{top}/b/../a"], [f"{top}/a/"]), ([f"{top}/a", f"{top}/a"], [])):
        with pytest.raises(ValueError, match="overlap"):
            publish.apart(spark, outputs, inputs)
    with pytest.raises(ValueError, match="overlap"):
        publish.workspace(spark, f"{top}/in/x", [f"{top}/in"])
    assert publish.workspace(spark, f"{top}/w", [f"{top}/in"]) != publish.workspace(spark, f"{top}/w", [f"{top}/in"])


def test_layouts(spark, tmp_path):
    for name in ("sir_wide", "old_scope"):
        (tmp_path / name).mkdir()
    folder = f"file://{tmp_path}"
    names = {"wide": ["sir_wide", "wide"], "scope": ["scope", "old_scope"]}
    assert publish.resolve(spark, folder, names) == {"wide": (f"{folder}/sir_wide", True), "scope": (f"{folder}/old_scope", False)}
    with pytest.raises(ValueError, match="preferred names: scope"):
        publish.resolve(spark, folder, names, strict=True)
    with pytest.raises(FileNotFoundError, match="no denominator, other"):
        publish.resolve(spark, folder, names | {"denominator": ["d"], "other": ["o"]})
