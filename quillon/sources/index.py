"""A genome index as a folder of Parquet tables and a manifest."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = 1


def write_index(tables: dict[str, DataFrame], path: str, parameters: dict) -> None:
    """Writes the tables, then a manifest of their rows, so that a folder without one is an index cut short."""
    spark = next(iter(tables.values())).sparkSession
    rows = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        rows[name] = spark.read.parquet(f"{path}/{name}").count()
    text = json.dumps({"version": VERSION, "parameters": parameters, "rows": rows})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def read_index(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    """(tables, parameters); another version, or tables that lack rows, raise."""
    manifest = json.loads("".join(r.value for r in spark.read.text(f"{path}/manifest").collect()))
    if manifest["version"] != VERSION:
        raise ValueError(f"the index has version {manifest['version']}, not {VERSION}")
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in manifest["rows"]}
    for n, k in manifest["rows"].items():
        if tables[n].agg(F.count("*")).first()[0] != k:
            raise ValueError(f"the index's table {n} is not whole")
    return tables, manifest["parameters"]
