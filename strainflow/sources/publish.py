"""Results kept under the fingerprint of their inputs: found again, or built once and put in place whole.

A result is a bundle in a folder of its own, named by the fingerprint, and counts from the moment that
the bundle's folder has its final name. `current` names the last one. Builders hold a lock, a file
that only one of them can create."""

from __future__ import annotations

import contextlib
import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from strainflow.sources.tables import _path, fingerprint, read_bundle, write_bundle

#: Seconds after which a lock counts as left behind by a builder that died.
STALE = 6 * 3600


class LockedError(RuntimeError):
    """Another builder holds the lock."""


def qualified(spark: SparkSession, path: str) -> str:
    """A path in the form that its file system gives it, without . and .. and with a slash at the end."""
    fs, found = _path(spark, path)
    parts: list[str] = []
    uri = fs.makeQualified(found).toUri()
    for part in str(uri.getPath()).split("/"):
        if part == "..":
            parts = parts[:-1]
        elif part not in ("", "."):
            parts.append(part)
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}/{'/'.join(parts)}".rstrip("/") + "/"


def apart(spark: SparkSession, outputs: list[str], inputs: list[str]) -> None:
    """Raises if an output lies in an input or another output, or holds one."""
    own = [qualified(spark, p) for p in outputs]
    others = [qualified(spark, p) for p in inputs]
    for k, a in enumerate(own):
        for b in others + own[:k]:
            if a.startswith(b) or b.startswith(a):
                raise ValueError(f"{a} and {b} overlap")


def resolve(spark: SparkSession, folder: str, layouts: dict[str, list[str]], strict: bool = False) -> dict[str, tuple[str, bool]]:
    """(path, whether it is the preferred one) of each part of a bundle that others have laid out: the
    first of its names that exists, of which the first is preferred. Raises for all missing parts at
    once, and with `strict` for those found by another name."""
    found: dict[str, tuple[str, bool]] = {}
    for part, names in layouts.items():
        for k, name in enumerate(names):
            path = f"{folder.rstrip('/')}/{name}"
            fs, at = _path(spark, path)
            if fs.exists(at):
                found[part] = (path, k == 0)
                break
    if missing := [p for p in layouts if p not in found]:
        raise FileNotFoundError(f"{folder} has no {', '.join(missing)}")
    if strict and (other := [p for p, (_, best) in found.items() if not best]):
        raise ValueError(f"not by their preferred names: {', '.join(other)}")
    return found


@contextlib.contextmanager
def lock(spark: SparkSession, folder: str, stale: float = STALE) -> Iterator[None]:
    """Holds the folder's lock; LockedError if another does. A lock older than `stale` seconds is taken over."""
    fs, path = _path(spark, f"{folder.rstrip('/')}/.lock")
    exists = lambda: fs.exists(path)
    if exists() and time.time() - fs.getFileStatus(path).getModificationTime() / 1000 > stale:
        fs.delete(path, False)
    try:
        stream = fs.create(path, False)  # fails if it is there
    except Exception as e:
        if exists():
            raise LockedError(f"{folder} is locked") from e
        raise
    try:
        stream.write(bytearray(uuid.uuid4().hex, "ascii"))
        stream.close()
        yield
    finally:
        fs.delete(path, False)


def inputs_fingerprint(inputs: dict[str, DataFrame], settings: dict | None = None) -> str:
    """One name for the rows of all inputs, in whatever order, and for the settings."""
    stamp = {"settings": settings or {}, "inputs": {name: fingerprint(df) for name, df in inputs.items()}}
    return hashlib.sha256(json.dumps(stamp, sort_keys=True).encode()).hexdigest()[:24]


def _set_current(spark: SparkSession, folder: str, name: str) -> None:
    fs, target = _path(spark, f"{folder}/current")
    _, draft = _path(spark, f"{folder}/.current-{uuid.uuid4().hex[:8]}")
    stream = fs.create(draft, True)
    stream.write(bytearray(name, "ascii"))
    stream.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(draft, target)


def current(spark: SparkSession, folder: str) -> str | None:
    """The name of the last published result."""
    fs, path = _path(spark, f"{folder.rstrip('/')}/current")
    return spark.read.text(f"{folder.rstrip('/')}/current").first()[0] if fs.exists(path) else None


def published(spark: SparkSession, folder: str, inputs: dict[str, DataFrame], build: Callable[[], dict[str, DataFrame]], settings: dict | None = None) -> tuple[dict[str, DataFrame], dict, bool]:
    """(tables, manifest, whether they were built now) of the inputs. A builder that fails leaves what
    was published before, and nothing under the new name."""
    folder = folder.rstrip("/")
    name = inputs_fingerprint(inputs, settings)
    target = f"{folder}/{name}"
    fs, manifest = _path(spark, f"{target}/manifest")
    built = not fs.exists(manifest)
    if built:
        fs.mkdirs(_path(spark, folder)[1])
        with lock(spark, folder):
            if not fs.exists(manifest):
                # no manifest: what a builder that died has left
                write_bundle(spark, target, build(), {"inputs": name, "settings": settings or {}}, force=True)
            _set_current(spark, folder, name)
    elif current(spark, folder) != name:
        _set_current(spark, folder, name)
    tables, meta = read_bundle(spark, target)
    return tables, meta, built


def workspace(spark: SparkSession, root: str, inputs: list[str]) -> str:
    """A new folder under root that no input overlaps and no other run has."""
    folder = f"{root.rstrip('/')}/run-{uuid.uuid4().hex[:12]}"
    apart(spark, [folder], inputs)
    fs, path = _path(spark, folder)
    fs.mkdirs(path)
    return folder
