"""Lines that many documents share, dropped from all documents but one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, ascii_lower, table, written

MIN_CHARS, MIN_DOCS = 40, 5
#: A shared line is heavy if it has more than this share of all shared lines' documents; at most 1 / HEAVY are.
HEAVY = 1e-4
NO_ID = -(2**63)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def _hashed(key: Column) -> list[Column]:
    """128 bits of a line, in two columns."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    r"""Rows of docs (doc_id, text) as doc_id, n_lines, n_dropped, kept.

    A text is split at \n; null and empty texts are one empty line. A line's key is the line stripped of spaces, A-Z
    lower-cased. Keys of min_chars code points or more that min_docs documents or more hold lose their lines
    everywhere but in the largest doc_id that holds them. Rows that share a doc_id count as one document; a null doc_id
    is less than any other, and rows that share the largest doc_id all keep the line. An empty table gives no rows.
    Other columns of docs play no part.

    Counts are combined before the shuffle, so a line that a third of the documents hold costs a row for each of them
    there. Lines with more than HEAVY of all shared lines' documents, at most 1 / HEAVY of them whatever the corpus, are
    broadcast to their occurrences; the others' occurrences meet them by hash, and none has many. The shared lines are
    written in between, so both joins read the same. Texts are shuffled once, to meet the positions of their dropped
    lines.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_text": F.xxhash64("text")})
    lines = own.select("_id", "_text", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.select("_id", "_text", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    keys = lines.select("_id", "_text", "pos", *_hashed(F.col("key")))
    per_doc = own.select("_id", F.array_distinct(F.transform(F.filter(F.transform(F.split("text", "\n", -1), line_key), lambda k: F.length(k) >= min_chars), lambda k: F.struct(*_hashed(k)))).alias("keys"))
    shared = (
        per_doc.select("_id", F.explode("keys").alias("k"))
        .groupBy("k.h1", "k.h2")
        .agg(F.count_distinct("_id").alias("n"), F.max("_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
    )
    spark = docs.sparkSession
    shared = written(spark, shared, "shared-lines")
    heavy = F.col("n") > HEAVY * (shared.agg(F.sum("n")).first()[0] or 0)
    few = F.broadcast(shared.where(heavy).select("h1", "h2", F.col("keeper").alias("_heavy")))
    rest = shared.where(~heavy).select(F.col("h1").alias("_g1"), F.col("h2").alias("_g2"), F.col("keeper").alias("_other"))
    # a heavy line's occurrences have met it by now, so they go anywhere
    found = keys.join(few, ["h1", "h2"], "left").withColumn("_to", F.when(F.col("_heavy").isNull(), F.col("h1")).otherwise(F.xxhash64("_id", "_text", "pos")))
    found = found.join(rest, (F.col("_to") == F.col("_g1")) & (F.col("h2") == F.col("_g2")), "left")
    dropped = found.where(F.col("_id") < F.coalesce("_heavy", "_other")).groupBy("_id", "_text").agg(F.collect_set("pos").alias("gone"))
    both = own.join(dropped, ["_id", "_text"], "left").select("doc_id", F.split("text", "\n", -1).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return both.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n").alias("kept"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of dedup_lines() over documents, with its defaults; rows, nulls and ties as there."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), s AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (keeper IS NOT NULL AND k.doc_id <> keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keeper IS NULL OR k.doc_id = keeper), '')) AS kept_sha256
FROM k LEFT JOIN s ON s.key = k.key
GROUP BY k.doc_id
"""
