"""The review queue, long inside and wide at its edges; decisions read back from it and rolled up by product."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexalign.functions.regulatory import classify_record, classify_resolution, review_decision, risk_name, risk_rank, status_label
from lexalign.functions.split import split_units
from lexalign.functions.text import clean_unit, normalize, reference_url, strip, text_of

from .matching import Settings, first_of, fuzzy_top, last_of, learned_in_order, match_units, small

OPEN = ["", "review", "review_accept_high_score"]


def units_of(products: DataFrame, formula: str, key: str = "row_id") -> DataFrame:
    """key, slot (from 1), unit and norm of each unit of each product."""
    return products.select(key, F.posexplode(split_units(formula)).alias("_p", "unit")).select(key, (F.col("_p") + 1).alias("slot"), "unit", clean_unit("unit").alias("norm"))


def slot_count(units: DataFrame) -> int:
    """The most slots of any product; one number reaches the driver."""
    return units.agg(F.coalesce(F.max("slot"), F.lit(0))).first()[0]


def overall_status(n: Column, unresolved: Column, not_approved: Column) -> Column:
    return F.when(n == 0, "NO_SUBSTANCE").when(unresolved, "NOT_FOUND_OR_NEEDS_MANUAL_REVIEW").when(not_approved, "CONTAINS_NOT_APPROVED_SUBSTANCE_IN_EU").otherwise("ALL_SUBSTANCES_APPROVED_IN_EU")


def joined(value: Column, order: str, keep: Column | None = None) -> Column:
    """An aggregate: values in order, with strokes between; null ones are left out."""
    kept = F.struct(F.col(order).alias("o"), value.alias("v"))
    if keep is not None:
        kept = F.when(keep, kept)
    return F.array_join(F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["v"]), " | ")


def product_status(products: DataFrame, matched: DataFrame, key: str = "row_id") -> DataFrame:
    """products with overall status, names, statuses, details and alerts; matched: key, slot, unit and the match."""
    lost = F.col("match_type").isin("unresolved", "none")
    name, status = F.when(lost, "").otherwise(F.coalesce("eu_name", F.lit(""))), F.when(lost, "").otherwise(F.coalesce("eu_status", F.lit("")))
    detail = F.when(lost, F.concat("unit", F.lit(":Unresolved(score="), F.col("score").cast("string"), F.lit(")"))).otherwise(F.concat("unit", F.lit(":"), name, F.lit("("), status, F.lit(")")))
    alert = F.when(lost, F.concat("unit", F.lit(" (Not Found)"))).when(status != "Approved", F.concat(name, F.lit(" ("), status, F.lit(")")))
    per = matched.groupBy(key).agg(
        F.count("*").alias("_n"), F.coalesce(F.bool_or(lost), F.lit(False)).alias("_lost"), F.coalesce(F.bool_or((status != "") & (status != "Approved")), F.lit(False)).alias("_bad"),
        joined(name, "slot").alias("eu_substances"), joined(status, "slot").alias("eu_statuses"), joined(detail, "slot").alias("resolution_details"), joined(alert, "slot", alert.isNotNull()).alias("alert"),
    )
    out = products.join(per, key, "left")
    return out.withColumns({
        "eu_overall_status": overall_status(F.coalesce("_n", F.lit(0)), F.col("_lost"), F.col("_bad")),
        "eu_substances": F.coalesce("eu_substances", F.lit("")), "eu_statuses": F.coalesce("eu_statuses", F.lit("")),
        "resolution_details": F.coalesce("resolution_details", F.lit("NO_SUBSTANCE")), "alert": F.coalesce("alert", F.lit("")),
    }).drop("_n", "_lost", "_bad")


def wide_slots(df: DataFrame, key: str, fields: list[str], slots: int, slot: str = "slot") -> DataFrame:
    """One row a key with field_1 to field_slots for each field; empty where a slot is missing. Values are given, so no
    extra pass looks for them."""
    cols = [F.coalesce(F.max(F.when(F.col(slot) == i, F.col(f).cast("string"))), F.lit("")).alias(f"{f}_{i}") for i in range(1, slots + 1) for f in fields]
    return df.groupBy(key).agg(*cols) if cols else df.select(key).distinct()


def long_slots(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, slot and fields, a row for each slot whose number any column field_<n> has; missing fields are null."""
    slots = sorted({int(m[1]) for c in df.columns for f in fields if (m := re.fullmatch(rf"{re.escape(f)}_(\d+)", c))})
    if not slots:
        return df.select(*keys, F.lit(None).cast("int").alias("slot"), *[F.lit(None).cast("string").alias(f) for f in fields]).where("false")
    rows = [F.struct(F.lit(i).alias("slot"), *[(F.col(f"{f}_{i}") if f"{f}_{i}" in df.columns else F.lit(None)).cast("string").alias(f) for f in fields]) for i in slots]
    return df.select(*keys, F.explode(F.array(*rows)).alias("_s")).select(*keys, "_s.*")


def build_queue(products: DataFrame, formula: str, cands: DataFrame, hist: DataFrame, settings: Settings = Settings(), slots: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(recomposed products, wide review queue, history with what was accepted by spelling), from products with row_id.

    The queue has the products with an open unit: each slot's unit, its five candidates with scores, statuses and
    pages, and a first decision. An empty queue has all its columns.
    """
    units = units_of(products, formula)
    # read by the products, the queue and the history alike; a lost block is worked out again
    matched = learned_in_order(match_units(units, cands, hist, settings), ["row_id", "slot"]).persist()
    lost = F.col("match_type").isin("unresolved", "none")
    top = fuzzy_top(matched.where(lost).select("norm").distinct(), cands, settings.top_k).persist()
    recomposed = product_status(products, matched)
    slots = slot_count(units) if slots is None else slots
    names = wide_slots(matched.select("row_id", "slot", F.col("unit").alias("substance_active"), F.when(lost, "").otherwise(F.col("eu_name")).alias("eu_substance"), F.when(lost, "").otherwise(F.col("eu_status")).alias("eu_status")), "row_id", ["substance_active", "eu_substance", "eu_status"], slots)
    recomposed = recomposed.join(names, "row_id", "left").na.fill("", [c for c in names.columns if c != "row_id"])
    picks = [F.max(F.when(F.col("rank") == k, F.col(c).cast("string"))).alias(f"{n}_{k}") for k in range(1, settings.top_k + 1) for n, c in (("candidate", "cand_name"), ("score", "score"), ("status", "cand_status"), ("url", "_url"))]
    wide_top = top.withColumn("_url", reference_url("cand_id", settings.url)).groupBy("norm").agg(*picks, F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("_top"))
    of_queue = matched.join(matched.groupBy("row_id").agg(F.bool_or(lost).alias("_q")).where("_q").drop("_q"), "row_id", "left_semi").join(wide_top, "norm", "left")
    slot_rows = of_queue.select(
        "row_id", "slot", F.col("unit").alias("substance_unit"), normalize("unit").alias("substance_normalized"), *[f"{n}_{k}" for k in range(1, settings.top_k + 1) for n in ("candidate", "score", "status", "url")],
        F.when(lost, review_decision(F.coalesce("_top", F.lit(0)), settings.review_from)).otherwise(F.col("match_type")).alias("review_decision"), F.when(lost, "").otherwise(F.coalesce("eu_name", F.lit(""))).alias("review_match_name"), F.lit("").alias("review_notes"),
    )
    fields = [c for c in slot_rows.columns if c not in ("row_id", "slot")]
    wide = wide_slots(slot_rows, "row_id", fields, slots)
    for i in range(1, slots + 1):  # candidate_<slot>_<rank> and its companions
        for k in range(1, settings.top_k + 1):
            wide = wide.withColumnsRenamed({f"candidate_{k}_{i}": f"candidate_s{i}_{k}", f"score_{k}_{i}": f"score_s{i}_{k}", f"status_{k}_{i}": f"candidate_s{i}_{k}_status", f"url_{k}_{i}": f"candidate_s{i}_{k}_url"})
    wide = wide.toDF(*[re.sub(r"^(candidate|score)_s", r"\1_", c) for c in wide.columns])
    keep = [c for c in products.columns if c != "row_id"]
    queue = recomposed.select("row_id", *keep, "eu_overall_status", F.col("resolution_details").alias("eu_status_details")).join(wide, "row_id")
    learned = matched.where("match_type = 'auto_accept_high_confidence'").select(F.col("norm").alias("hist_norm"), F.col("eu_name").alias("hist_name")).distinct()
    return recomposed, queue, hist.unionByName(learned.join(hist, "hist_norm", "left_anti"))


def decision_index(decisions: DataFrame) -> DataFrame:
    """One decision a norm from (norm, row, slot, decision, match_name, notes): the first settled one, else the first
    open one that says something, else the last."""
    d = strip(text_of("decision"))
    rank = F.when(~d.isin(OPEN), F.struct(F.lit(0).alias("a"), F.col("row").alias("b"), F.col("slot").alias("c"))).when(d != "", F.struct(F.lit(1).alias("a"), F.col("row").alias("b"), F.col("slot").alias("c"))).otherwise(F.struct(F.lit(2).alias("a"), (-F.col("row")).alias("b"), (-F.col("slot")).alias("c")))
    named = decisions.where("norm <> ''").withColumns({"decision": d, "match_name": strip(text_of("match_name")), "notes": strip(text_of("notes")), "_rank": rank})
    return first_of(named, ["norm"], [F.col("_rank")]).select("norm", "decision", "match_name", "notes")


def queue_decisions(queue: DataFrame) -> DataFrame:
    """decision_index() of a wide queue with row_id, or of one with a single slot without a number."""
    fields = ["substance_normalized", "substance_unit", "review_decision", "review_match_name", "review_notes"]
    if "substance_normalized" in queue.columns or "substance_unit" in queue.columns:
        have = [(F.col(f) if f in queue.columns else F.lit(None).cast("string")).alias(f) for f in fields]
        long = queue.select("row_id", F.lit(1).alias("slot"), *have)
    else:
        long = long_slots(queue, ["row_id"], fields)
    norm = clean_unit(F.coalesce(F.nullif(F.col("substance_normalized"), F.lit("")), F.col("substance_unit")))
    return decision_index(long.select(norm.alias("norm"), F.col("row_id").alias("row"), "slot", F.col("review_decision").alias("decision"), F.col("review_match_name").alias("match_name"), F.col("review_notes").alias("notes")))


def updated_history(hist: DataFrame, decisions: DataFrame) -> DataFrame:
    """hist with accepted decisions, which take the place of what it had."""
    new = decisions.where((F.lower("decision") == "accept") & (F.col("match_name") != "")).select(F.col("norm").alias("hist_norm"), F.col("match_name").alias("hist_name"))
    return hist.join(new, "hist_norm", "left_anti").unionByName(new)


def parsed_details(details: Column) -> Column:
    """Settled units of a details string: array of (norm, name, status)."""
    parts = F.filter(F.transform(F.split(text_of(details), r"\|"), strip), lambda p: p.contains(":"))
    each = F.transform(parts, lambda p: F.struct(clean_unit(F.substring_index(p, ":", 1)).alias("norm"), strip(F.regexp_replace(p, r"^[^:]*:", "")).alias("d")))
    good = F.filter(each, lambda e: ~e["d"].contains("Unresolved") & e["d"].rlike(r"^.+\((Approved|Not approved|Unknown)\)$"))
    return F.transform(good, lambda e: F.struct(e["norm"].alias("norm"), strip(F.regexp_extract(e["d"], r"^(.+)\((Approved|Not approved|Unknown)\)$", 1)).alias("name"), F.regexp_extract(e["d"], r"\((Approved|Not approved|Unknown)\)$", 1).alias("status")))


def rollup(products: DataFrame, units: DataFrame, key: str = "row_id") -> DataFrame:
    """products with final names, statuses, details, alerts, approval, risk and flags.

    units: key, slot, unit, label, name and, where name has a record, status_current, risk, is_substitution,
    is_low_risk, is_basic. A product is approved if it has units and all are; a unit that is not settled, or has no
    record, makes its risk high.
    """
    settled = F.col("label").isin("Manual Accept", "Auto Mapped", "Auto Accepted") & (F.coalesce("name", F.lit("")) != "")
    known = settled & F.col("status_current").isNotNull()
    status = F.when(known, status_label(F.col("status_current"))).when(settled, "Unknown").otherwise("")
    name = F.when(settled, F.col("name")).otherwise("")
    other = F.when(F.col("label").isin("Rejected", "Needs Research"), F.col("label")).otherwise("Pending Review")
    detail = F.when(settled, F.concat("unit", F.lit(":"), name, F.lit("("), status, F.lit(")"))).otherwise(F.concat("unit", F.lit(":"), other))
    alert = F.when(settled & (status != "Approved"), F.concat(name, F.lit(" ("), status, F.lit(")"))).when(~settled, F.concat("unit", F.lit(" ("), other, F.lit(")")))
    per = units.groupBy(key).agg(
        joined(name, "slot", name != "").alias("eu_substances_final"), joined(status, "slot", status != "").alias("eu_statuses_final"), joined(detail, "slot").alias("resolution_details_final"), joined(alert, "slot", alert.isNotNull()).alias("alert_final"),
        F.bool_and(status == "Approved").alias("product_is_approved"), F.max(F.when(known, risk_rank(F.col("risk"))).otherwise(2)).alias("_risk"),
        F.bool_or(known & F.coalesce("is_substitution", F.lit(False))).alias("eu_candidate_for_substitution"), F.bool_and(known & F.coalesce("is_low_risk", F.lit(False))).alias("eu_is_low_risk"), F.bool_and(known & F.coalesce("is_basic", F.lit(False))).alias("eu_is_basic_substance"),
    )
    out = products.join(per, key, "left")
    flags = ("product_is_approved", "eu_candidate_for_substitution", "eu_is_low_risk", "eu_is_basic_substance")
    texts = ("eu_substances_final", "eu_statuses_final", "resolution_details_final", "alert_final")
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in flags} | {c: F.coalesce(c, F.lit("")) for c in texts} | {"eu_regulatory_risk_flag": risk_name(F.coalesce("_risk", F.lit(0)))}).drop("_risk")


def reinject(products: DataFrame, formula: str, details: str, decisions: DataFrame, reference: DataFrame, as_of: str) -> DataFrame:
    """rollup() of products with row_id: settled details of the first run count, then decisions; reference needs ord."""
    units = units_of(products, formula)
    before = products.select("row_id", F.posexplode(parsed_details(F.col(details))).alias("_at", "_d")).select("row_id", "_at", F.col("_d.norm").alias("norm"), F.col("_d.name").alias("_was")).groupBy("row_id", "norm").agg(F.max_by("_was", "_at").alias("_was"))
    said = small(decisions.withColumn("_res", classify_resolution(F.col("decision"), F.col("match_name"))).select("norm", F.col("_res.name").alias("_name"), F.col("_res.label").alias("_label")))
    each = units.join(before, ["row_id", "norm"], "left").join(said, "norm", "left")
    each = each.withColumns({"name": F.coalesce("_was", "_name", F.lit("")), "label": F.when(F.col("_was").isNotNull(), "Auto Mapped").otherwise(F.coalesce("_label", F.lit("Pending Review")))})
    records = last_of(reference.select(clean_unit("substance_name").alias("_key"), "ord", *[c.alias(n) for n, c in classify_record(reference.columns, as_of).items()]).where("_key <> ''"), ["_key"], [F.col("ord")])
    each = each.withColumn("_key", clean_unit("name")).join(small(records.drop("ord")), "_key", "left")
    return rollup(products, each)


def truth(long: DataFrame) -> DataFrame:
    """unit, match_name, notes of accepted units from (row_id, slot, unit, decision, match_name, notes); the last wins,
    by slot and then by row."""
    ok = long.where((F.col("decision") == "accept") & (strip(text_of("unit")) != "")).withColumn("unit", strip(F.col("unit")))
    return last_of(ok, ["unit"], [F.col("slot"), F.col("row_id")]).select("unit", F.coalesce("match_name", F.lit("")).alias("true_name"), F.coalesce("notes", F.lit("")).alias("true_notes"))


def propagate(long: DataFrame, known: DataFrame, tag: str = "[Auto-propagé]") -> DataFrame:
    """long with the decisions that known has for equal units; changed tells which rows took one."""
    both = long.withColumn("_u", strip(text_of("unit"))).join(small(known.withColumnRenamed("unit", "_u")), "_u", "left")
    take = F.col("true_name").isNotNull() & ~F.coalesce(F.col("decision") == "accept", F.lit(False)) & (F.col("_u") != "")
    notes = F.when(F.col("true_notes").contains(tag), F.col("true_notes")).otherwise(strip(F.concat("true_notes", F.lit(" " + tag))))
    out = both.withColumn("changed", take)
    return out.withColumns({"decision": F.when(take, "accept").otherwise(F.col("decision")), "match_name": F.when(take, F.col("true_name")).otherwise(F.col("match_name")), "notes": F.when(take, notes).otherwise(F.col("notes"))}).drop("_u", "true_name", "true_notes")


def first_slots(df: DataFrame, group: list[str], value: str, order: list[str], slots: int = 4) -> DataFrame:
    """A row a group with its first values in order as value_1 to value_slots."""
    n = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    ranked = df.withColumn("_n", n).where(F.col("_n") <= slots)
    return ranked.groupBy(*group).agg(*[F.max(F.when(F.col("_n") == i, F.col(value))).alias(f"{value}_{i}") for i in range(1, slots + 1)])
