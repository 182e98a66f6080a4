"""The matching cascade: history, exact, spelling, meaning, each step only for what the steps before left open."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from lexalign.functions.regulatory import first_named, rollup_status
from lexalign.functions.similarity import merged_score, percent, top_cosines, wratio_udf
from lexalign.functions.text import clean_unit, normalize, strip, text_of


@dataclass(frozen=True)
class Settings:
    """Limits of the cascade, and the page of a reference record."""

    top_k: int = 5
    accept_from: int = 95
    review_from: int = 75
    loose_from: float = 85.0
    url: str = "https://ec.europa.eu/food/plant/pesticides/eu-pesticides-database/active-substances/?event=as.details&as_id={id}"


#: Rows and bytes of a table that is joined by broadcast; beyond, joins shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 256 << 20


def small(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """df, marked for broadcast only if it has at most rows rows and, written out, most bytes; the check reads no more.

    What the check worked out is kept for the join.
    """
    kept = df.persist()
    n, size = kept.limit(rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("b")).agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first()
    if n <= rows and size <= most:
        return F.broadcast(kept)
    kept.unpersist()
    return df


def last_of(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in order, as repeated keys of a dictionary leave it."""
    w = Window.partitionBy(*key).orderBy(*[o.desc() for o in order])
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_of(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def candidates(reference: DataFrame, ord_col: str = "ord") -> DataFrame:
    """cand_ord, cand_norm, cand_name, cand_status and cand_id of reference records that have a name."""
    cols = reference.columns
    name = strip(first_named(cols, ["substance_name", "name", "activeSubstance"]))
    return reference.select(
        F.col(ord_col).alias("cand_ord"), clean_unit(name).alias("cand_norm"), name.alias("cand_name"),
        rollup_status(first_named(cols, ["substance_status", "approvalStatus", "status"])).alias("cand_status"),
        first_named(cols, ["substance_id", "id"]).alias("cand_id"),
    ).where("cand_name <> ''")


def history(mapping: DataFrame) -> DataFrame:
    """hist_norm and hist_name from (source_name, eu_name, ord): cleaned keys, of like ones the last."""
    one = mapping.select(clean_unit("source_name").alias("hist_norm"), strip(text_of("eu_name")).alias("hist_name"), "ord").where("hist_norm <> '' and hist_name <> ''")
    return last_of(one, ["hist_norm"], [F.col("ord")]).drop("ord")


def score_pairs(pairs: DataFrame, a: str, b: str, to: str) -> DataFrame:
    return pairs.withColumn(to, wratio_udf(a, b))


def fuzzy_top(units: DataFrame, cands: DataFrame, k: int = 5) -> DataFrame:
    """norm, rank, cand_name, cand_status, cand_id, score (whole, half-even): each unit's k most alike candidates.

    units: distinct norm. Every unit meets every candidate, which the score needs, in blocks: the bounded reference is
    broadcast to partitions of units. Of 3k best, names that are alike but for case and accents count once.
    """
    kept = cands.where("cand_norm <> ''")
    pairs = units.where("norm <> ''").repartition("norm").join(small(kept), F.length("cand_norm") > 0)
    scored = score_pairs(pairs, "norm", "cand_norm", "raw")
    best = Window.partitionBy("norm").orderBy(F.desc("raw"), "cand_ord")
    over = scored.withColumn("_p", F.row_number().over(best)).where(F.col("_p") <= 3 * k)
    once = first_of(over.withColumn("_key", normalize("cand_name")), ["norm", "_key"], [F.col("_p")])
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("norm").orderBy("_p"))).where(F.col("rank") <= k)
    return ranked.select("norm", "rank", "cand_name", "cand_status", "cand_id", F.bround("raw", 0).cast("int").alias("score"))


#: Queries and items of a block of semantic_top(), and numbers in a block of items.
BLOCK_QUERIES, BLOCK_ITEMS, BLOCK_NUMBERS = 4096, 16_384, 1 << 23


def semantic_top(queries: DataFrame, index: DataFrame, k: int = 5, block_queries: int = BLOCK_QUERIES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """query_id, rank, item_id, similarity: each query's k items of largest cosine, ties by item.

    queries: query_id, query_vec; index: item_id, item_vec; items without a vector take no part. All queries meet all
    items, in blocks: each block of queries meets each block of items once, and of what the blocks give the k best stay.
    """
    def listed(df: DataFrame, vec: str) -> Column:
        kind = df.schema[vec].dataType.simpleString()
        return F.col(vec) if kind in ("array<float>", "array<double>") else F.col(vec).cast("array<double>")

    q, x = queries.select("query_id", listed(queries, "query_vec").alias("query_vec")), index.where("item_vec is not null").select("item_id", listed(index, "item_vec").alias("item_vec"))
    asked, (n, width) = q.count(), x.agg(F.count("*"), F.coalesce(F.max(F.size("item_vec")), F.lit(0))).first()
    width = max(1, width)
    parts, blocks = max(1, -(-asked // block_queries)), max(1, -(-n // min(block_items, max(256, BLOCK_NUMBERS // width))))
    q = q.select("*", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("_q"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_x"))
    x = x.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_q"), F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("_x"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        i, j, score = top_cosines(left, right, k)
        return pa.table([left.column("query_id").take(pa.array(i)), right.column("item_id").take(pa.array(j)), score], names=["query_id", "item_id", "similarity"])

    kind = StructType([StructField("query_id", q.schema["query_id"].dataType), StructField("item_id", x.schema["item_id"].dataType), StructField("similarity", DoubleType())])
    scored = q.groupBy("_q", "_x").cogroup(x.groupBy("_q", "_x")).applyInArrow(run, kind)
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "item_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def merge_shortlists(fuzzy: DataFrame, semantic: DataFrame, k: int = 5) -> DataFrame:
    """query, name, combined, rank from (query, name, fuzzy, pos) and (query, name, semantic, pos).

    Ties go to the spelling list's order, then to the meaning list's.
    """
    f = fuzzy.select("query", "name", "fuzzy", F.col("pos").alias("_fp"))
    s = semantic.select("query", "name", "semantic", F.col("pos").alias("_sp"))
    both = f.join(s, ["query", "name"], "full_outer").withColumn("combined", merged_score(F.col("fuzzy"), F.col("semantic")))
    order = Window.partitionBy("query").orderBy(F.desc("combined"), F.col("_fp").asc_nulls_last(), F.col("_sp").asc_nulls_last(), "name")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "name", "combined", "rank")


def match_units(units: DataFrame, cands: DataFrame, hist: DataFrame, settings: Settings = Settings(), fuzzy: bool = True) -> DataFrame:
    """units (with norm, any other columns) with eu_name, eu_status, match_type and score.

    match_type: empty, auto_mapped, auto_mapped_not_in_db, exact, auto_accept_high_confidence, unresolved or none.
    History comes before exact names, these before spelling; scores are rounded before they are held against the
    limit. Each distinct name is looked up once.
    """
    index = last_of(cands.where("cand_norm <> ''"), ["cand_norm"], [F.col("cand_ord")])
    names = units.select("norm").distinct()
    via = hist.select("hist_norm", "hist_name", clean_unit("hist_name").alias("_to"))
    seen = index.select(F.col("cand_norm").alias("_to"), F.col("cand_name").alias("_hn"), F.col("cand_status").alias("_hs"))
    step = names.join(small(via.join(seen, "_to", "left")), names["norm"] == F.col("hist_norm"), "left")
    step = step.join(small(index.select("cand_norm", "cand_name", "cand_status")), step["norm"] == F.col("cand_norm"), "left")
    kind = F.when(F.col("norm") == "", "empty").when(F.col("_hn").isNotNull(), "auto_mapped").when(F.col("hist_name").isNotNull(), "auto_mapped_not_in_db").when(F.col("cand_name").isNotNull(), "exact")
    step = step.select("norm", F.coalesce("_hn", "hist_name", "cand_name").alias("eu_name"), F.when(kind == "auto_mapped_not_in_db", "Unknown").otherwise(F.coalesce("_hs", "cand_status")).alias("eu_status"), kind.alias("match_type"))
    done = step.withColumn("score", F.when(F.col("match_type") == "empty", 0).when(F.col("match_type").isNotNull(), 100))
    if fuzzy:
        best = fuzzy_top(step.where("match_type is null").select("norm"), cands, settings.top_k).where("rank = 1").select(F.col("norm").alias("_q"), F.col("cand_name").alias("_fn"), F.col("cand_status").alias("_fs"), F.col("score").alias("_fsc"))
        done = done.join(best, done["norm"] == best["_q"], "left")
        good = F.col("match_type").isNull() & (F.col("_fsc") >= settings.accept_from)
        done = done.select(
            "norm", F.when(good, F.col("_fn")).otherwise(F.col("eu_name")).alias("eu_name"), F.when(good, F.col("_fs")).otherwise(F.col("eu_status")).alias("eu_status"),
            F.coalesce("match_type", F.when(good, "auto_accept_high_confidence").when(F.col("_fsc").isNotNull(), "unresolved").otherwise("none")).alias("match_type"), F.coalesce("score", "_fsc", F.lit(0)).alias("score"),
        )
    else:
        done = done.withColumns({"match_type": F.coalesce("match_type", F.lit("none")), "score": F.coalesce("score", F.lit(0))})
    return units.join(done, "norm", "left")


def learned_in_order(matched: DataFrame, order: list[str]) -> DataFrame:
    """A name accepted by spelling is history from its second occurrence on, as the first one adds it there."""
    n = F.row_number().over(Window.partitionBy("norm").orderBy(*order))
    again = (F.col("match_type") == "auto_accept_high_confidence") & (n > 1)
    return matched.withColumn("_again", again).withColumns({"match_type": F.when(F.col("_again"), "auto_mapped").otherwise(F.col("match_type")), "score": F.when(F.col("_again"), 100).otherwise(F.col("score"))}).drop("_again")


def match_loose(names: DataFrame, reference: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """names (name) with match_found, matched_name and match_score: equal in lower case, or the most alike from 85."""
    ref = last_of(reference.select(F.lower(strip(text_of("substance_name"))).alias("key"), F.col("substance_name").alias("matched_name"), "ord").where("key <> ''"), ["key"], [F.col("ord")])
    q = names.select("name").distinct().withColumn("q", strip(F.lower(text_of("name"))))
    hit = q.join(small(ref), q["q"] == ref["key"], "left")
    exact = hit.where("key is not null").select("name", "matched_name", F.lit(100.0).alias("match_score"))
    rest = hit.where("key is null and q <> ''").select("name", "q")
    pairs = score_pairs(rest.repartition("name").join(small(ref), F.length("key") > 0), "q", "key", "raw")
    best = first_of(pairs, ["name"], [F.desc("raw"), F.col("ord")]).where(F.col("raw") >= settings.loose_from)
    found = exact.union(best.select("name", "matched_name", F.bround("raw", 2)))
    return names.join(found, "name", "left").withColumn("match_found", F.when(F.col("matched_name").isNotNull(), True))


def prefer_approved(reference: DataFrame, name: str, status: str, ord_col: str = "ord") -> DataFrame:
    """One record a name: the first, if it is not "not approved"; else the first later one that is approved outright,
    else the last later one that speaks of approval, else the first."""
    s = F.lower(text_of(status))
    clean, speaks = ~s.contains("not approved"), s.contains("approved")
    n = F.row_number().over(Window.partitionBy(name).orderBy(ord_col))
    ranked = reference.withColumn("_n", n).withColumn(
        "_rank",
        F.when((F.col("_n") == 1) & clean, F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))
        .when((F.col("_n") > 1) & speaks & clean, F.struct(F.lit(1).alias("a"), F.col("_n").alias("b")))
        .when((F.col("_n") > 1) & speaks, F.struct(F.lit(2).alias("a"), (-F.col("_n")).alias("b")))
        .when(F.col("_n") == 1, F.struct(F.lit(3).alias("a"), F.lit(0).alias("b")))
        .otherwise(F.struct(F.lit(4).alias("a"), F.col("_n").alias("b"))),
    )
    return first_of(ranked, [name], [F.col("_rank")]).drop("_rank", "_n")


def reconcile_vectors(units: DataFrame, index: DataFrame, k: int = 5) -> DataFrame:
    """semantic_top() with similarities as percentages to one decimal; negative ones are 0. Each unit is looked up once."""
    return semantic_top(units.dropDuplicates(["query_id"]), index, k).withColumn("score", percent(F.col("similarity")))
