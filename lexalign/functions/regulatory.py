"""Status, dates, risk and score rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, strip, text_of

# Words of a status text in the order that they decide, and statuses by kind.
STATUS_WORDS = [
    ("not_approved", ["not approved", "non approuve", "not-approved"]),
    ("approved", ["approved", "approuve", "autorise", "authorised", "active"]),
    ("withdrawn", ["withdrawn", "retire"]),
    ("expired", ["expired", "expire"]),
    ("banned", ["banned", "interdit"]),
    ("not_renewed", ["not renewed", "non renouvele"]),
]
ENDED = ["withdrawn", "expired", "banned", "not_renewed"]
YES = ["yes", "true", "1", "y"]
RISKS = ["low", "medium", "high"]
# End of the fixed values.


def classify_status(c: Column | str) -> Column:
    """One of approved, not_approved, withdrawn, expired, banned, not_renewed and unknown; the first word found decides."""
    def decided(s: Column) -> Column:
        out = F
        for status, words in STATUS_WORDS:
            hit = F.lit(False)
            for w in words:
                hit = hit | s.contains(w)
            out = out.when(hit, status)
        return out.otherwise("unknown")

    return let(F.lower(strip(text_of(c))), decided)


def rollup_status(c: Column | str) -> Column:
    """Approved, Unknown, or Not approved for all else."""
    return let(classify_status(c), lambda s: F.when(s == "approved", "Approved").when(s == "unknown", "Unknown").otherwise("Not approved"))


def status_label(s: Column) -> Column:
    """not_approved as Not approved."""
    words = F.regexp_replace(s, "_", " ")
    return F.concat(F.upper(F.substring(words, 1, 1)), F.lower(F.substring(words, 2, 1_000)))


def first_named(columns: list[str], names: list[str]) -> Column:
    """The first of the named columns that a row has and that is not empty; only columns that exist are asked."""
    found = [F.nullif(text_of(n), F.lit("")) for n in names if n in columns]
    return F.coalesce(*found, F.lit(""))


def parse_date(c: Column | str) -> Column:
    """ISO text of a date; dd/mm/yyyy is turned round unchecked, four formats are read, all else stays as it is."""
    s = strip(text_of(c))
    swapped = F.regexp_replace(s, r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$2-$1")
    read = F.coalesce(*(F.try_to_date(F.when(s.rlike(shape), s), f) for f, shape in (("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"), ("d/M/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"), ("yyyy/M/d", r"^\d{4}/\d{1,2}/\d{1,2}$"), ("d-M-yyyy", r"^\d{1,2}-\d{1,2}-\d{4}$"))))
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s).when(s.rlike(r"^\d{2}/\d{2}/\d{4}$"), swapped).otherwise(F.coalesce(F.date_format(read, "yyyy-MM-dd"), s))


def is_yes(c: Column) -> Column:
    return F.lower(strip(text_of(c))).isin(YES)


def classify_record(columns: list[str], as_of: str) -> dict[str, Column]:
    """Normalised regulatory columns of a reference record, from whichever of the usual field names it has.

    An end before as_of makes a record historical, and an approved one expired.
    """
    start = parse_date(first_named(columns, ["approval_date", "approvalDate"]))
    end = parse_date(first_named(columns, ["expiry_date", "expiryDate"]))
    base = classify_status(first_named(columns, ["substance_status", "approvalStatus", "status"]))
    ended = base.isin(ENDED)
    past = F.coalesce(F.try_to_date(F.when(end.rlike(r"^\d{4}-\d{2}-\d{2}$"), end), "yyyy-MM-dd") < F.lit(as_of).cast("date"), F.lit(False))
    status = F.when(~ended & past & (base == "approved"), "expired").otherwise(base)
    substitution = is_yes(first_named(columns, ["candidate_for_substitution", "candidateForSubstitution"]))
    low = is_yes(first_named(columns, ["low_risk_active_substance", "lowRiskActiveSubstance"]))
    return {
        "status_current": status,
        "is_historical": ended | past,
        "is_substitution": substitution,
        "substitution_reason": strip(first_named(columns, ["candidate_for_substitution_type", "candidateForSubstitutionType"])),
        "is_low_risk": low,
        "is_basic": is_yes(first_named(columns, ["basic_substance", "basicSubstance"])),
        "approval_start": start,
        "approval_end": end,
        "risk": F.when(substitution | status.isin("not_approved", *ENDED), "high").when(low & (status == "approved"), "low").otherwise("medium"),
    }


def risk_rank(c: Column) -> Column:
    return F.when(c == "high", 2).when(c == "medium", 1).otherwise(0)


def risk_name(rank: Column) -> Column:
    return F.when(rank == 2, "high").when(rank == 1, "medium").otherwise("low")


def classify_resolution(decision: Column, name: Column) -> Column:
    """(name, label) of a review decision."""
    d, n = F.lower(strip(text_of(decision))), text_of(name)
    label = (
        F.when((d == "accept") & (n != ""), "Manual Accept").when(d == "reject", "Rejected").when(d == "needs_research", "Needs Research")
        .when(d.isin("auto_mapped", "exact") & (n != ""), "Auto Mapped").when((d == "auto_accept_high_confidence") & (n != ""), "Auto Accepted").otherwise("Pending Review")
    )
    return F.struct(F.when(label.isin("Manual Accept", "Auto Mapped", "Auto Accepted"), n).otherwise("").alias("name"), label.alias("label"))


def review_decision(score: Column, review_from: float = 75) -> Column:
    return F.when(score >= review_from, "review_accept_high_score").otherwise("review")


def wants_verdict(score: Column, low: float = 40, review_from: float = 75) -> Column:
    """Whether a score is so uncertain that a model is asked."""
    return (score >= low) & (score < review_from)


def number_or_null(c: Column | str) -> Column:
    """A number that can be compared; NaN and texts are null."""
    x = col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def tox_score(adi: Column | str, arfd: Column | str) -> Column:
    """Up to 10: for each limit 5 below 0.01, 3 below 0.1; what is no number counts nothing."""
    def part(c):
        x = number_or_null(c)
        return F.when(x < 0.01, 5).when(x < 0.1, 3).otherwise(0)

    return F.least(F.lit(10), part(adi) + part(arfd))


def risk_class(score: Column | str, labels: tuple[str, str, str] = ("Rouge (Extrême)", "Orange (Modéré)", "Vert/Jaune (Faible)")) -> Column:
    x = number_or_null(score)
    return F.when(x >= 8, labels[0]).when(x >= 4, labels[1]).otherwise(labels[2])


def first_number(c: Column | str) -> Column:
    """The first number of a text: digits with a point and maybe a sign, or bare digits; an exponent is not read."""
    return F.regexp_extract(text_of(c), r"[-+]?\d*\.\d+|\d+", 0).try_cast("double")


# Substances that never reach the reference, by words of their cleaned names, in the order that they decide.
INTERCEPTED = [
    (["keromone", "kairomone", "acetate d ethyle"], "Acétate d'éthyle (Kaïromone)", "Biocontrôle - Piège olfactif", "Hors champ UE (Substance de base)", "🟢 Nul (Dispositif fermé)"),
    (["dodecatrienyl", "pyrale"], "(Z,E)-7,9,11-Dodecatrienyl formate", "Biocontrôle - Confusion sexuelle", "Approuvé localement (Hors UE)", "🟢 Zéro Résidu"),
    (["trisiloxane", "polyether"], "Tensioactif Organosiliconé", "Adjuvant de cuve", "Additif légal (Hors Annexe I)", "🟡 Multiplicateur de toxicité"),
    (["lauryl", "sles"], "Sodium lauryl ether sulfate (SLES)", "Adjuvant - Agent mouillant", "Additif légal (Hors Annexe I)", "🟡 Ecotoxique aquatique (Base ECHA)"),
]
PASSED = ("Substance Chimique (À vérifier)", "En attente UE", "Inconnu")
# End of the fixed values.


def gatekeeper(raw: Column, clean: Column) -> Column:
    """What becomes of a unit before it is matched: raw_name, clean_name, intercepted, category, local_status, risk_flag."""
    def filled(name, hit, category, status, flag):
        return F.struct(raw.alias("raw_name"), name.alias("clean_name"), F.lit(hit).alias("intercepted"), F.lit(category).alias("category"), F.lit(status).alias("local_status"), F.lit(flag).alias("risk_flag"))

    def decided(name: Column) -> Column:
        out = F
        for words, own, *rest in INTERCEPTED:
            hit = F.lit(False)
            for w in words:
                hit = hit | F.lower(name).contains(w)
            out = out.when(hit, filled(F.lit(own), True, *rest))
        return out.otherwise(filled(name, False, *PASSED))

    return let(clean, decided)
