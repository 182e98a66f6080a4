"""License phrases and notices in documents, by diagonal voting over word k-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, ascii_lower, table

#: Phrases, each a place where its words stand one behind the other.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
#: Openings of license notices, as published; found with words changed, added or left out.
NOTICES = [
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
]
#: Words in a gram of a phrase and of a notice.
PHRASE_GRAM, NOTICE_GRAM = 2, 5
#: Neighbouring diagonals this near are one passage; a passage counts with this share of its template's grams.
DRIFT, COVER = 3, 0.5
_START = -1


def _templates(phrases: list[tuple[str, str]], notices: list[tuple[str, str]]) -> list[tuple[int, str, bool, int, list[str]]]:
    both = [(label, True, PHRASE_GRAM, text.split()) for label, text in phrases] + [(label, False, NOTICE_GRAM, text.split()) for label, text in notices]
    return [(i, *t) for i, t in enumerate(both)]


def _gram_hash(k: int, word: list[Column]) -> Column:
    return F.xxhash64(F.lit(k), *word)


def _tells(templates: list) -> dict[int, int]:
    """For each template a bit for each of its grams that stands in no other label's template of the same gram length."""
    labels: dict[tuple, set[str]] = {}
    for _, label, _, k, words in templates:
        for p in range(len(words) - k + 1):
            labels.setdefault((k, *words[p : p + k]), set()).add(label)
    return {i: sum(1 << p for p in range(len(words) - k + 1) if len(labels[k, *words[p : p + k]]) == 1) for i, _, _, k, words in templates}


def _positions(spark: SparkSession, templates: list) -> DataFrame:
    """h, template, label, base, k, grams, tells, t_pos, gram: a row for each gram of each template, and one that meets
    the mark that each document opens with. As many rows as the templates have words at most."""
    rows, tells = [], _tells(templates)
    for i, label, base, k, words in templates:
        if len(words) - k + 1 > 63:
            raise ValueError("a template has at most 63 grams")
        for p in range(len(words) - k + 1):
            gram = [F.lit(w) for w in words[p : p + k]]
            rows.append((_gram_hash(k, gram), i, label, base, k, len(words) - k + 1, tells[i], p, F.array(*gram)))
    rows.append((_gram_hash(0, []), _START, "", False, 0, 1, 0, 0, F.array().cast("array<string>")))
    names = ("h", "template", "label", "base", "k", "grams", "tells", "t_pos", "gram")
    structs = [F.struct(*(c.alias(n) if isinstance(c, Column) else F.lit(c).cast("long" if n == "tells" else "string" if n == "label" else "boolean" if n == "base" else "int").alias(n) for n, c in zip(names, r, strict=True))) for r in rows]
    return spark.range(1, numPartitions=1).select(F.explode(F.array(*structs)).alias("x")).select("x.*")


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES, drift: int = DRIFT, cover: float = COVER) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and passages of each row of docs.

    The grams of every text that begin with a word that a template's gram begins with are hashed and joined to the
    templates' positions; hits are compared word by word, so no hash collision counts. Hits vote for their diagonal,
    position in the text less position in the template. A phrase stands where a diagonal has all of its grams. A
    notice's diagonals no more than drift apart merge to a passage, whose span is verified: distinct positions of the
    notice, each counted once, are at least the share cover of its grams, and so are those that no other label's notice
    has, which tell it from its kin. passages: label, first_word, last_word, score. score is the best share of positions
    of any notice, 1 where a phrase stands, 0 where nothing is found.

    Null and empty texts have no words and no license. Each row is a document of its own, also one with a null or
    repeated doc_id; an empty table gives no rows. Other columns play no part. The template table is fixed, a few
    hundred rows, and broadcast; hits are shuffled once, by document, and each document's mark with them, so texts
    are read once and never shuffled.
    """
    spark = docs.sparkSession
    templates = _templates(phrases, notices)
    words = F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(WORD), 0)
    own = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", words.alias("_words"))

    def grams(k: int) -> Column:
        firsts = sorted({t[p] for _, _, _, n, t in templates if n == k for p in range(len(t) - k + 1)})
        at = F.filter(F.sequence(F.lit(0), F.size("_words") - k), lambda i: F.get("_words", i).isin(firsts))
        hashed = F.transform(at, lambda i: F.struct(i.alias("p"), _gram_hash(k, [F.get("_words", i + j) for j in range(k)]).alias("h")))
        return F.when(F.size("_words") >= k, hashed).otherwise(F.array().cast("array<struct<p:int,h:bigint>>"))

    mark = F.array(F.struct(F.lit(0).alias("p"), _gram_hash(0, []).alias("h")))
    each = own.select("_row", "doc_id", "_words", F.size("_words").alias("_n"), F.explode(F.concat(mark, grams(PHRASE_GRAM), grams(NOTICE_GRAM))).alias("_g"))
    each = each.select("_row", "doc_id", "_words", "_n", F.col("_g.p").alias("pos"), F.col("_g.h").alias("h"))
    hits = each.join(F.broadcast(_positions(spark, templates)), "h").where((F.col("k") == 0) | (F.slice("_words", F.col("pos") + 1, F.col("k")) == F.col("gram")))
    place = F.when(F.col("k") == 0, F.lit(0)).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("t_pos")))
    hits = hits.select("_row", "doc_id", "_n", "template", "label", "base", "k", "grams", "tells", "pos", (F.col("pos") - F.col("t_pos")).alias("diagonal"), place.cast("long").alias("place")).repartition("_row")
    same = ("doc_id", "_n", "label", "base", "k", "grams", "tells")
    votes = hits.groupBy("_row", "template", "diagonal").agg(
        *(F.first(c).alias(c) for c in same), F.bit_or("place").alias("places"), F.min("pos").alias("lo"), F.max("pos").alias("hi")
    ).where(~F.col("base") | (F.bit_count("places") == F.col("grams")))
    near = Window.partitionBy("_row", "template").orderBy("diagonal")
    apart = F.col("base") | F.lag("diagonal").over(near).isNull() | (F.col("diagonal") - F.lag("diagonal").over(near) > drift)
    merged = votes.withColumn("_new", apart.cast("int")).withColumn("island", F.sum("_new").over(near.rowsBetween(Window.unboundedPreceding, 0)))
    passages = merged.groupBy("_row", "template", "island").agg(
        *(F.first(c).alias(c) for c in same), F.bit_or("places").alias("places"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    share = F.bit_count("places") / F.col("grams")
    passages = passages.withColumn("share", F.when(F.col("template") == _START, 0.0).otherwise(share))
    base = F.when(F.col("base"), F.col("lo").cast("long"))
    told = F.bit_count(F.col("places").bitwiseAND(F.col("tells"))) >= cover * F.bit_count("tells")
    good = (F.col("template") != _START) & (F.col("base") | ((F.col("share") >= cover) & told))
    span = F.struct("label", F.col("lo").cast("long").alias("first_word"), (F.col("hi") + F.col("k") - 1).cast("long").alias("last_word"), F.col("share").alias("score"))
    return passages.groupBy("_row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("_n").cast("long").alias("n_words"),
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(good, F.col("label")))), ",").alias("labels"),
        F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.when(good, span))).alias("passages"),
    ).drop("_row")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of scan() over documents, with its defaults; rows, nulls and ties as there."""
    return scan(table(spark, sf_dir, "documents")).drop("passages")


def _oracle() -> str:
    rows = ", ".join(f"({i}, '{label}', {str(base).lower()}, {k}, {words})" for i, label, base, k, words in _templates(PHRASES, NOTICES))
    return rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), t(template, label, base, k, w) AS (VALUES {rows}
), tg AS (
  SELECT *, min(label) OVER (PARTITION BY k, g) = max(label) OVER (PARTITION BY k, g) AS tell FROM (
    SELECT template, label, base, k, len(w) - k + 1 AS grams, i AS t_pos, array_to_string(w[i + 1 : i + k], ' ') AS g
    FROM (SELECT *, unnest(range(len(w) - k + 1)) AS i FROM t))
), tells AS (SELECT template, count(*) FILTER (tell) AS n_tells FROM tg GROUP BY template
), dg AS (
  SELECT doc_id, k, i AS pos, array_to_string(w[i + 1 : i + k], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM d, (VALUES ({PHRASE_GRAM}), ({NOTICE_GRAM})) AS ks(k) WHERE len(w) >= k)
), h AS MATERIALIZED (
  SELECT doc_id, template, label, base, grams, pos, t_pos, tell, pos - t_pos AS diagonal FROM dg JOIN tg USING (k, g)
), p AS (
  SELECT doc_id, label, min(pos) AS lo FROM h WHERE base GROUP BY doc_id, template, label, diagonal HAVING count(*) = any_value(grams)
), b AS (
  SELECT doc_id, count(*) AS n_base, min(lo) AS first_word, max(lo) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY doc_id
), i AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS island
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= {DRIFT} THEN 0 ELSE 1 END AS new
        FROM (SELECT DISTINCT doc_id, template, diagonal FROM h WHERE NOT base))
), m AS (
  SELECT doc_id, label, count(DISTINCT t_pos)::DOUBLE / any_value(grams) AS share, count(DISTINCT t_pos) FILTER (tell) >= {COVER} * any_value(n_tells) AS told
  FROM h JOIN i USING (doc_id, template, diagonal) JOIN tells USING (template) GROUP BY doc_id, template, label, island
), s AS (SELECT doc_id, max(share) AS best FROM m GROUP BY doc_id
), l AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM p UNION ALL SELECT doc_id, label FROM m WHERE share >= {COVER} AND told) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN s USING (doc_id)
"""


ORACLE = _oracle()
