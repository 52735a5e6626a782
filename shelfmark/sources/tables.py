"""Tables, file lists, model answers as JSON, and result sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources import sheets

PDF, IMAGES, MORE_IMAGES = (".pdf",), (".jpg", ".jpeg", ".png"), (".bmp", ".tiff", ".webp")
#: The shapes of the model's answers.
LABELS = "struct<clusters:array<struct<label:int>>>"
ITEM_FIELDS = ("Size", "Pack", "RetailAmount", "RetailFactor", "Description", "Ad")
ITEMS = f"struct<extracted_data:array<struct<{','.join(f'{f}:string' for f in ITEM_FIELDS)}>>>"


def read_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None, format: str = "parquet", **options: str) -> DataFrame:
    """A table with trimmed column names, cut to the wanted ones; a missing one is an error that names it."""
    if format == "sheets":
        sheets.register(spark)
    df = spark.read.format(format).options(**options).load(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    if columns is None:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; it has {df.columns}")
    return df.select(*[f"`{c}`" for c in columns])


def named_like(path: Column, extensions: Iterable[str]) -> Column:
    """Whether a path has one of the extensions, any case."""
    ends = "|".join(e.lstrip(".") for e in extensions)
    return F.lower(path).rlike(rf"\.({ends})$")


def files_like(spark: SparkSession, path: str, extensions: Iterable[str]) -> DataFrame:
    """path, modificationTime, length, content of the files with one of the extensions, any case; contents are only read where they are used. Spark passes over empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter(named_like(F.col("path"), extensions))


def list_files(spark: SparkSession, path: str, extensions: Iterable[str]) -> DataFrame:
    """path, length, modificationTime of the files with one of the extensions, any case; contents aren't read."""
    return files_like(spark, path, extensions).select("path", "length", "modificationTime")


def parse_label_json(c: Column) -> Column:
    """The first cluster's label; null for malformed or empty answers."""
    return F.get(F.from_json(c, LABELS)["clusters"], F.lit(0))["label"]


def parse_items_json(df: DataFrame, column: str) -> DataFrame:
    """One row for each extracted item, its fields beside the other columns; none for malformed or empty answers."""
    items = F.from_json(F.col(column), ITEMS)["extracted_data"]
    return df.withColumn("__item", F.explode(items)).select(*[c for c in df.columns if c != column], *[F.col(f"__item.{f}").alias(f) for f in ITEM_FIELDS])


def write_results(results: Mapping[str, DataFrame], path: str, format: str = "parquet") -> None:
    """Each table into a folder of its name, replacing what is there; empty tables are written too."""
    for name, df in results.items():
        if format == "sheets":
            sheets.register(df.sparkSession)
        df.write.mode("overwrite").format(format).save(f"{path}/{name}")


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path, on the driver; only names and manifests of a few hundred bytes are handled there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _editions(spark: SparkSession, path: str) -> list[int]:
    fs, at = _folder(spark, f"{path}/editions")
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(at) if f.getPath().getName().isdigit()) if fs.exists(at) else []


def publish_results(results: Mapping[str, DataFrame], path: str, format: str = "parquet", keep: int = 2) -> int:
    """All tables as one new edition of `path`, seen at once: its number.

    The tables are written to a folder of their own; only when all are there, a manifest that names the folder and tables is moved into place, which is one rename. A run that fails before leaves the edition of before
    whole. Of two runs at a time each gets an edition. Editions before the last `keep` go, so results that are still being read stay for that long.
    """
    spark = next(iter(results.values())).sparkSession
    run = f"run-{uuid.uuid4().hex}"
    write_results(results, f"{path}/{run}", format)
    fs, draft = _folder(spark, f"{path}/{run}/manifest.json")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"run": run, "format": format, "tables": list(results)}).encode()))
    out.close()
    fs.mkdirs(_folder(spark, f"{path}/editions")[1])
    number = max(_editions(spark, path), default=0) + 1
    # The name must be new: `rename` then does nothing if another run took the number first.
    while fs.exists(to := _folder(spark, f"{path}/editions/{number}")[1]) or not fs.rename(draft, to):
        number += 1
    for old in _editions(spark, path)[:-keep]:
        gone = _manifest(spark, path, old)["run"]
        fs.delete(_folder(spark, f"{path}/editions/{old}")[1], False)
        fs.delete(_folder(spark, f"{path}/{gone}")[1], True)
    return number


def _manifest(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads("".join(r[0] for r in spark.read.text(f"{path}/editions/{number}").collect()))


def published_results(spark: SparkSession, path: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of an edition of `path`, the last one unless its number is given."""
    found = _editions(spark, path)
    if not found:
        raise ValueError(f"{path} has no published results")
    manifest = _manifest(spark, path, number or found[-1])
    return {name: read_table(spark, f"{path}/{manifest['run']}/{name}", format=manifest["format"]) for name in manifest["tables"]}
