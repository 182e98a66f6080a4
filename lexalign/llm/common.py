"""What the corpus operators share: input columns, word rules and durable intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of letters and digits; every character beyond ASCII counts as a letter.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Code points U+0020 and U+0009 to U+000D.
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: For bytes.translate(): A-Z to a-z, all that is no word byte to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: For bytes.translate(): A-Z to a-z only.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_bytes(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, A-Z lower-cased; none for a null text."""
    return text.translate(WORD_BYTES).split() if text else []


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts can be long: Python workers get few rows, or 32 MB, at a time. The setting is the session's and stays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share, as spark.checkpoint.dir names it, or the session's checkpoint folder.

    Where neither is set, one machine alone gets a temporary folder; on a cluster that is an error, as no other machine
    would see it.
    """
    sc = spark.sparkContext
    found, current = spark.conf.get("spark.checkpoint.dir", None), sc._jsc.sc().getCheckpointDir()
    if not found and current.isDefined():
        return current.get()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all machines share")
        found = tempfile.mkdtemp(prefix="lexalign-")
    if not current.isDefined():
        sc.setCheckpointDir(found)
    return found


_written: list[tuple[object, str]] = []


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            _remove(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone; the folder is the cluster's to clear then
            pass


def written(spark: SparkSession, df: DataFrame, kind: str, settle: bool = False) -> DataFrame:
    """df written as Parquet in the shared folder and read again: its lineage ends there, whatever executor is lost.

    settle: the shuffles behind it are let go at once, not when the driver next collects garbage; for large ones.
    """
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    if settle:
        spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def let_go(table: DataFrame) -> None:
    """Removes a table that written() made and that nothing will read again."""
    path = table._written_to
    _written[:] = [x for x in _written if x[1] != path]
    _remove(table.sparkSession, path)


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    shared_folder(spark)
    return df.checkpoint()
