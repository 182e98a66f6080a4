"""Prompts for an injected model, and its answers read and held against the candidates that it was shown."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .similarity import clamped
from .text import strip, text_of

# What a verdict may say.
RELATIONS = ["exact_equivalent", "spelling_variant", "salt_or_derivative", "chemical_synonym", "unrelated"]
STATES = ["approved", "not_approved", "withdrawn", "expired", "banned", "not_renewed", "unknown"]
# End of the fixed values.
_ANSWER = "same_entity string, selected_candidate string, relation_type string, regulatory_state string, confidence string, requires_human_review string, reason string"


def candidate_lines(candidates: Column) -> Column:
    """A numbered block for each candidate (name, status, cas, formula), with stand-ins for what is missing."""

    def block(c: Column, i: Column) -> Column:
        def field(n: str, none: str) -> Column:
            return F.coalesce(F.nullif(c[n], F.lit("")), F.lit(none))

        return F.format_string("Candidate #%d:\n  Name: %s\n  EU Status: %s\n  CAS No: %s\n  Formula: %s\n", i + 1, field("name", "Unknown"), field("status", "Unknown"), field("cas", "N/A"), field("formula", "N/A"))

    return F.array_join(F.transform(candidates, block), "\n")


def question(source: Column, normalized: Column, candidates: Column) -> Column:
    """What a model is asked about a unit and its candidates; the answer is one JSON object of the verdict's fields."""
    keys = "same_entity (true or false), selected_candidate (a listed name or null), relation_type, regulatory_state, confidence (0 to 1), requires_human_review (true or false), reason"
    return F.concat(
        F.lit('Source unit: "'), text_of(source), F.lit('"\nNormalized: "'), text_of(normalized), F.lit('"\n\nCandidates:\n'), candidate_lines(candidates),
        F.lit(f"\nIs the source one of the candidates? Answer with one JSON object with the keys {keys}. relation_type is one of {', '.join(RELATIONS)}; regulatory_state is one of {', '.join(STATES)}."),
    )


def json_text(raw: Column) -> Column:
    """From the first brace to the last."""
    return F.regexp_extract(text_of(raw), r"(?s)\{.*\}", 0)


def verdict(raw: Column, names: Column) -> Column:
    """A checked verdict from a model's raw answer; names: the candidates shown.

    A name that was not shown is thrown out and sent to a human, as are answers that are missing or can't be read and
    values that are none of those allowed.
    """
    a = F.from_json(json_text(raw), _ANSWER)
    readable = raw.isNotNull() & a.isNotNull() & F.coalesce(a["same_entity"], a["selected_candidate"], a["relation_type"], a["reason"], a["confidence"]).isNotNull()
    said = F.nullif(strip(text_of(a["selected_candidate"])), F.lit(""))
    known = F.get(F.filter(names, lambda n: F.lower(strip(n)) == F.lower(said)), F.lit(0))
    relation, state = F.lower(strip(text_of(a["relation_type"]))), F.lower(strip(text_of(a["regulatory_state"])))
    odd = ~relation.isin(RELATIONS) | ~state.isin(STATES)
    invented = said.isNotNull() & known.isNull()

    def truth(c: Column) -> Column:
        return F.coalesce(F.lower(strip(c)) == "true", F.lit(False))

    good = F.struct(
        (truth(a["same_entity"]) & known.isNotNull()).alias("same_entity"),
        known.alias("selected_candidate"),
        F.when(relation.isin(RELATIONS), relation).otherwise("unrelated").alias("relation_type"),
        F.when(state.isin(STATES), state).otherwise("unknown").alias("regulatory_state"),
        clamped(a["confidence"]).alias("confidence"),
        (odd | truth(a["requires_human_review"]) | invented).alias("requires_human_review"),
        F.when(invented, F.concat(F.lit("[Constraint Viol] invented candidate '"), said, F.lit("' not in shortlist."))).otherwise(strip(text_of(a["reason"]))).alias("reason"),
    )

    def fallback(review: bool, why: str) -> Column:
        return F.struct(F.lit(False).alias("same_entity"), F.lit(None).cast("string").alias("selected_candidate"), F.lit("unrelated").alias("relation_type"), F.lit("unknown").alias("regulatory_state"), F.lit(0.0).alias("confidence"), F.lit(review).alias("requires_human_review"), F.lit(why).alias("reason"))

    return F.when(F.size(names) == 0, fallback(False, "no candidates")).when(raw.isNull(), fallback(True, "no answer")).when(~readable, fallback(True, "unreadable answer")).otherwise(good)


def ask(df: DataFrame, prompt: str, answer: str, model: Callable[[str], str | None]) -> DataFrame:
    """df with answer, what model says to each prompt; null prompts are not asked, and a model that fails says null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            said = []
            for p in b[prompt]:
                try:
                    said.append(model(p) if p is not None else None)
                except Exception:  # noqa: BLE001  one failed call must not fail the corpus
                    said.append(None)
            yield b.assign(**{answer: said})

    return df.mapInPandas(run, df.withColumn(answer, F.lit(None).cast("string")).schema)


def status_from_answer(raw: Column) -> Column:
    """The status that a model's answer names; unknown for all else."""
    s = F.lower(strip(text_of(F.get_json_object(json_text(raw), "$.status_current"))))
    return F.when(s.isin(STATES), s).otherwise("unknown")
