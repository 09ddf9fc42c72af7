"""Delimited files, bundles of tables with a manifest, and output safety."""

from __future__ import annotations

import json
import uuid
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainflow.functions.text import trim_or_null


def delimiter(first_line: str) -> str:
    """; if there are strictly more of them than commas."""
    line = first_line.lstrip("﻿")
    return ";" if line.count(";") > line.count(",") else ","


def read_delimited(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All columns as text, empty ones null. Tabs by the file's name, else the first line decides.
    With `columns` the file has no header."""
    sep = "\t" if re.search(r"\.(tsv|tab)$", path) else delimiter((spark.read.text(path).first() or [""])[0])
    reader = spark.read.option("sep", sep).option("quote", '"').option("mode", "PERMISSIVE")
    if columns:
        df = reader.schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    else:
        df = reader.option("header", True).csv(path)
        df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    return df.select(*[trim_or_null(F.col(f"`{c}`")).alias(c) for c in df.columns])


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key: the first in order."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(key, "_r.*").select(*df.columns)


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def write_bundle(spark: SparkSession, folder: str, tables: dict[str, DataFrame], meta: dict, force: bool = False) -> None:
    """Tables as Parquet, then a manifest; a bundle without manifest is not whole. An existing
    bundle stays unless force."""
    fs, root = _path(spark, folder)
    if fs.exists(root) and not force:
        raise FileExistsError(f"{folder} exists")
    target, folder = root, f"{folder.rstrip('/')}.{uuid.uuid4().hex[:8]}"
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    stamp = {name: fingerprint(spark.read.parquet(f"{folder}/{name}")) for name in tables}
    line = spark.createDataFrame([(json.dumps({"meta": meta, "tables": stamp}, sort_keys=True),)], "value string")
    line.coalesce(1).write.text(f"{folder}/_draft")
    fs.rename(_path(spark, f"{folder}/_draft")[1], _path(spark, f"{folder}/manifest")[1])
    # the old bundle goes aside first, so that one of the two is always there
    aside = _path(spark, f"{folder}.old")[1]
    had = fs.exists(target)
    if had:
        fs.rename(target, aside)
    fs.rename(_path(spark, folder)[1], target)
    if had:
        fs.delete(aside, True)


def read_bundle(spark: SparkSession, folder: str, check: bool = True) -> tuple[dict[str, DataFrame], dict]:
    fs, manifest = _path(spark, f"{folder}/manifest")
    if not fs.exists(manifest):
        raise FileNotFoundError(f"{folder} has no manifest: not a whole bundle")
    found = json.loads(spark.read.text(f"{folder}/manifest").first()[0])
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in found["tables"]}
    for name, df in tables.items():
        if check and fingerprint(df) != found["tables"][name]:
            raise ValueError(f"{name} differs from its manifest")
    return tables, found["meta"]


def fingerprint(df: DataFrame) -> str:
    """Rows, and a sum of row hashes that no order of rows changes."""
    row = df.select(F.xxhash64(F.to_json(F.struct(*sorted(df.columns)))).cast("decimal(38,0)").alias("h")).agg(F.count("*"), F.sum("h")).first()
    return f"{row[0]}:{row[1] or 0}"


def setting(name: str, default: str, old_name: str | None = None) -> str:
    """An environment variable, else that of its old name, else the default."""
    return os.environ.get(name) or (old_name and os.environ.get(old_name)) or default
