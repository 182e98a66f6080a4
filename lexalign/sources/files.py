"""Sources and sinks: delimited text, JSON in envelopes, reference lists, mapping history, vector indexes."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.request
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexalign.functions.text import clean_unit, strip, text_of
from lexalign.operators.audit import require
from lexalign.operators.matching import last_of

#: Encodings of text files in the order that they are tried.
ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "latin1")
#: Fields of a JSON envelope that may hold its records, in the two orders that services use.
ENVELOPE = ("value", "data", "results", "items", "content", "records")
ENVELOPE_ITEMS = ("items", "results", "data", "value", "content", "records")
_JVM_NAMES = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "cp1252": "windows-1252", "latin1": "ISO-8859-1"}


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def numbered(df: DataFrame, name: str = "ord") -> DataFrame:
    """df with the order of its rows in their files: increasing, with gaps."""
    return df.withColumn(name, F.monotonically_increasing_id())


def read_delimited(spark: SparkSession, path: str, sep: str = ",", encoding: str = "utf-8-sig", schema: T.StructType | None = None, required: list[str] | None = None, ordered: bool = True) -> DataFrame:
    """A delimited file with heads, as strings unless a schema is given; a byte-order mark is not part of the first head.

    A file that does not exist, and required columns that are missing, are errors.
    """
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.option("header", True).option("sep", sep).option("multiLine", True).option("escape", '"').option("encoding", _JVM_NAMES.get(encoding, encoding))
    df = (reader.schema(schema) if schema else reader).csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    df = require(df, required) if required else df
    return numbered(df) if ordered else df


def probe_encoding(spark: SparkSession, path: str, encodings: tuple[str, ...] = ENCODINGS) -> str:
    """The first encoding that the whole file reads in, or all files of a folder; tried where the files are read."""
    def reads(content: bytes, encoding: str) -> bool:
        try:
            content.decode(encoding)
        except UnicodeDecodeError:
            return False
        return True

    def run(batches):
        for b in batches:
            fits = [[reads(x, e) for e in encodings] for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(fits, pa.list_(pa.bool_()))], ["fits"])

    found = [r["fits"] for r in spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "fits array<boolean>").distinct().collect()]
    for i, e in enumerate(encodings):
        if found and all(f[i] for f in found):
            return e
    raise ValueError(f"{path}: none of {', '.join(encodings)}")


def write_delimited(df: DataFrame, path: str, sep: str = ",", single: bool = False, mark: bool = True) -> None:
    """A folder of delimited files with heads, each behind a byte-order mark; one file if single, for people to open."""
    df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0]) if mark else df
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)


def download_text(df: DataFrame, rows: int = 100_000) -> bytes:
    """df as one delimited text with a byte-order mark, for a page's download; more than rows rows are an error."""
    got = df.limit(rows + 1).toPandas()
    if len(got) > rows:
        raise ValueError(f"more than {rows} rows; write them with write_delimited()")
    return got.to_csv(index=False).encode("utf-8-sig")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """hist_norm and hist_name: keys cleaned, values stripped, the last of like keys; empty if there is no file."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "hist_norm string, hist_name string")
    df = read_delimited(spark, path, required=["source_name", "eu_name"])
    one = df.select(clean_unit("source_name").alias("hist_norm"), strip(text_of("eu_name")).alias("hist_name"), "ord").where("hist_norm <> '' and hist_name <> ''")
    return last_of(one, ["hist_norm"], [F.col("ord")]).drop("ord")


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, order: tuple[str, ...] = ENVELOPE, lines: bool = False) -> DataFrame:
    """Records of a JSON file: one a line; or a list; or an object whose first list under a name of order has them."""
    if lines:
        return numbered(spark.read.schema(schema).json(path))
    whole = spark.read.text(path, wholetext=True)
    many = T.ArrayType(schema)
    envelope = T.StructType([T.StructField(n, many) for n in order])
    rows = F.coalesce(F.when(F.ltrim("value").startswith("["), F.from_json("value", many)), *[F.from_json("value", envelope)[n] for n in order])
    out = whole.select(F.posexplode(rows).alias("ord", "r"))
    return out.select("r.*", F.col("ord").cast("long").alias("ord"))


def fetch(url: str, path: str, force: bool = False, retries: int = 5, backoff: float = 1.5, timeout: float = 60, get: Callable[[str, float], bytes] | None = None) -> str:
    """Saves what url serves as a local file, once; failures are tried again after growing waits."""
    import os

    if os.path.exists(path) and not force:
        return path

    def plain(u: str, t: float) -> bytes:
        with urllib.request.urlopen(u, timeout=t) as r:
            return r.read()

    for k in range(retries + 1):
        try:
            body = (get or plain)(url, timeout)
            break
        except OSError:
            if k == retries:
                raise
            time.sleep(backoff * 2**k)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "wb") as f:
        f.write(body)
    return path


def read_workbook(spark: SparkSession, path: str, sheets: list[str]) -> dict[str, DataFrame]:
    """Sheets of a workbook as frames; a folder has them as <sheet>.parquet, a file needs an engine for pandas."""
    if not path.lower().endswith((".xlsx", ".xls")):
        return {s: spark.read.parquet(f"{path}/{s}.parquet") for s in sheets}
    import pandas as pd

    found = pd.read_excel(path, sheet_name=sheets)
    return {s: numbered(spark.createDataFrame(found[s])) for s in sheets}


def content_hash(spark: SparkSession, path: str) -> str:
    """MD5 of a file's bytes; empty if it does not exist."""
    if not _exists(spark, path):
        return ""
    parts = sorted(tuple(r) for r in spark.read.format("binaryFile").load(path).select("path", F.md5("content")).collect())  # a row a file
    return parts[0][1] if len(parts) == 1 else hashlib.md5(json.dumps([p[1] for p in parts]).encode()).hexdigest()


def build_index(cands: DataFrame, embed: Callable[[list[str]], list[list[float]]], path: str, source_hash: str = "", model: str = "") -> DataFrame:
    """Writes cand_norm, cand_name and the vectors that embed() gives, with model and source_hash, as Parquet."""
    schema = T.StructType([*cands.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches):
        for b in batches:
            yield b.assign(embedding=embed(b["cand_name"].fillna("").tolist()))

    out = cands.mapInPandas(run, schema).withColumns({"model": F.lit(model), "source_hash": F.lit(source_hash)})
    out.write.mode("overwrite").parquet(path)
    return cands.sparkSession.read.parquet(path)


def load_index(spark: SparkSession, path: str, source_hash: str | None = None) -> DataFrame | None:
    """The index, or None if there is none or it was built from another source."""
    if not _exists(spark, path):
        return None
    df = spark.read.parquet(path)
    if source_hash is not None and df.where(F.col("source_hash") != source_hash).limit(1).count():
        return None
    return df


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """path and content of binary documents, for operators.extract.scan_documents()."""
    return spark.read.format("binaryFile").load(path)
