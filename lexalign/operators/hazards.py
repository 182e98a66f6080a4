"""Toxicological limits brought to units over a bridge of three tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexalign.functions.regulatory import tox_score
from lexalign.functions.text import clean_cas, strip, text_of

from .matching import last_of, small

UNKNOWN, NOT_FOUND = "Inconnu", "Non trouvée"


def hazard_table(ref_sub: DataFrame, sub: DataFrame, tox: DataFrame) -> DataFrame:
    """cas, hazard_name, adi, arfd: each registry number's last limits that are numbers.

    ref_sub: uuid, cas_number, name, ord; sub: uuid, ref_uuid, ord; tox: parent_uuid, adi, arfd, ord. Of repeated
    sub and registry numbers the last row counts; limits without a bridge are dropped.
    """
    bridge = last_of(sub.select(F.col("uuid").alias("_sub"), F.col("ref_uuid").alias("_ref"), "ord"), ["_sub"], [F.col("ord")]).where("_ref is not null").drop("ord")
    rows = tox.select(strip(text_of("parent_uuid")).alias("_sub"), F.col("adi").try_cast("double").alias("adi"), F.col("arfd").try_cast("double").alias("arfd"), "ord").join(bridge, "_sub")

    def last(c: str):
        good = F.col(c).isNotNull() & ~F.isnan(c)
        return F.max_by(F.when(good, F.col(c)), F.when(good, F.col("ord"))).alias(c)

    limits = rows.groupBy("_ref").agg(last("adi"), last("arfd"))
    named = ref_sub.select(clean_cas("cas_number").alias("cas"), strip(text_of("uuid")).alias("_ref"), F.col("name").alias("hazard_name"), "ord").where("cas <> ''")
    return last_of(named, ["cas"], [F.col("ord")]).join(limits, "_ref", "left").select("cas", "hazard_name", "adi", "arfd")


def with_hazards(df: DataFrame, cas: str, table: DataFrame) -> DataFrame:
    """df with found, name, limits (null if unknown), their texts and the score; default values without a match."""
    t = small(table.withColumn("_cas", F.col("cas")).drop("cas"))
    out = df.withColumn("_key", clean_cas(cas)).join(t, F.col("_key") == F.col("_cas"), "left")
    found = F.col("_cas").isNotNull()
    return out.select(
        *df.columns, found.alias("hazard_found"), F.when(found, F.col("hazard_name")).otherwise(NOT_FOUND).alias("hazard_name"), "adi", "arfd",
        F.coalesce(F.col("adi").cast("string"), F.lit(UNKNOWN)).alias("adi_text"), F.coalesce(F.col("arfd").cast("string"), F.lit(UNKNOWN)).alias("arfd_text"),
        F.when(found, tox_score("adi", "arfd")).otherwise(0).alias("tox_severity_score"),
    )
