"""Audits of two extractions, company names brought together, and the views of a dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexalign.functions.regulatory import first_number, risk_class
from lexalign.functions.split import split_loose
from lexalign.functions.text import audit_key, canonical_company, normalize, text_of, upper_squeezed

from .matching import first_of


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def audit_merge(a: DataFrame, b: DataFrame, keys: list[str], marks: tuple[str, str] = ("_a", "_b"), key_of=audit_key) -> DataFrame:
    """All rows of both, joined where normalised keys are equal (missing equals missing); _merge says where a row was.

    Other columns that both have get the marks. An equi-join on null-safe keys, so each key meets in one task.
    """
    both = (set(a.columns) & set(b.columns)) - set(keys)

    def side(df: DataFrame, i: int) -> DataFrame:
        return df.select(*[key_of(k).alias(f"_k{i}_{n}") for n, k in enumerate(keys)], *[F.col(c).alias(c + marks[i] if c in both else c) for c in df.columns if c not in keys], F.lit(True).alias(f"_in{i}"))

    x, y = side(require(a, keys), 0), side(require(b, keys), 1)
    on = None
    for n in range(len(keys)):
        e = F.col(f"_k0_{n}").eqNullSafe(F.col(f"_k1_{n}"))
        on = e if on is None else on & e
    out = x.join(y, on, "full_outer")
    where = F.when(F.col("_in0") & F.col("_in1"), "both").when(F.col("_in0"), "left_only").otherwise("right_only")
    return out.select(*[F.coalesce(f"_k0_{n}", f"_k1_{n}").alias(k) for n, k in enumerate(keys)], *[c for c in x.columns + y.columns if not c.startswith(("_k0_", "_k1_", "_in"))], where.alias("_merge"))


def value_counts(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).orderBy(F.desc("n"), c)


def name_variants(df: DataFrame, name: str, order: str, canonical: Column | None = None) -> DataFrame:
    """canonical, variants: each canonical company's spellings in order of appearance, with strokes between."""
    one = df.where(F.col(name).isNotNull()).groupBy((canonical_company(name) if canonical is None else canonical).alias("canonical"), F.col(name).alias("_raw")).agg(F.min(order).alias("_o"))
    listed = F.array_sort(F.collect_list(F.struct("_o", "_raw")))
    return one.groupBy("canonical").agg(F.array_join(F.transform(listed, lambda x: x["_raw"]), " | ").alias("variants"))


def consolidate(df: DataFrame, company: str, maker: str) -> DataFrame:
    return df.withColumns({f"{company}_canonical": canonical_company(company), f"{maker}_canonical": canonical_company(maker)})


def belongs(part: Column, whole: Column) -> Column:
    """Whether one of the two names holds the other; any part belongs to an empty whole."""
    return (whole == "") | F.contains(whole, part) | F.contains(part, whole)


def dashboard_rows(enriched: DataFrame, formula: str, clean: str, company: str, score: str, url: str) -> DataFrame:
    """A row a part of each formula that belongs to the row's cleaned name, with its company in capitals and its risk."""
    parts = enriched.withColumn(formula, F.explode(F.filter(split_loose(formula), lambda p: p != "")))
    kept = parts.where(belongs(normalize(formula), normalize(clean)))
    return kept.withColumns({company: upper_squeezed(company), "risk_class": risk_class(score), "scientific_source": F.coalesce(url, F.lit(""))})


def searched(df: DataFrame, columns: list[str], pattern: str) -> DataFrame:
    """Rows with the pattern in one of the columns, whatever the case; a missing cell has nothing. No pattern, no filter."""
    if not pattern:
        return df
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c).rlike("(?i)" + pattern), F.lit(False))
    return df.where(hit)


def chosen(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values)) if values else df


def above(df: DataFrame, score: str, least: float, flag: str | None = None) -> DataFrame:
    """Rows with a score of least or more (missing scores go) and, if asked, a flag that is set."""
    out = df.where(F.col(score) >= least)
    return out.where(F.coalesce(F.col(flag), F.lit(False))) if flag else out


def risk_rate(df: DataFrame, company: str, status: str, bad: str = "Not approved") -> DataFrame:
    """Share of a company's rows with a bad status, in percent to two decimals; the worst first."""
    named = df.where(F.col(company).isNotNull())
    per = named.groupBy(company).agg(F.count_if(F.col(status).eqNullSafe(bad)).alias("bad"), F.count("*").alias("total"))
    return per.withColumn("risk_rate", F.round(F.col("bad") * 100.0 / F.col("total"), 2)).orderBy(F.desc("risk_rate"), company)


def status_by_company(df: DataFrame, company: str, status: str) -> DataFrame:
    return df.where(F.col(company).isNotNull() & F.col(status).isNotNull()).groupBy(company, status).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, c: str, least: float, most: float, bins: int = 11) -> DataFrame:
    """bin (from 0) and n over equal widths; the largest value falls in the last bin."""
    width = (most - least) / bins
    x = F.col(c).cast("double")
    at = F.least(F.floor((x - least) / width), F.lit(bins - 1)).cast("int")
    return df.where(x.isNotNull() & ~F.isnan(x) & (x >= least) & (x <= most)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def correlation_rows(df: DataFrame, adi: str, arfd: str) -> DataFrame:
    """Rows whose limits both read as positive numbers, for axes by powers of ten."""
    return df.withColumns({"adi_value": first_number(adi), "arfd_value": first_number(arfd)}).where("adi_value > 0 and arfd_value > 0")


def top_danger(df: DataFrame, name: str, status: str, score: str, order: str, k: int = 20, least: float = 8) -> DataFrame:
    """The k most toxic names that are not approved (a missing status is not), each name's first row."""
    bad = df.where((F.col(score) >= least) & ~F.col(status).eqNullSafe("Approved"))
    return first_of(bad, [name], [F.col(order)]).orderBy(F.desc(score), order).limit(k)


def top_values(df: DataFrame, c: str, k: int = 10) -> DataFrame:
    return value_counts(df, c).limit(k)


def sorted_values(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c)


def counters(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row of counts, a column a condition, in a single pass."""
    return df.agg(*[F.count_if(v).alias(k) for k, v in conditions.items()])


def inventory(df: DataFrame, group: list[str], value: str, order: str, slots: int = 4) -> DataFrame:
    """Each group's first values in order as value_1 to value_slots; groups with missing keys count too."""
    n = F.row_number().over(Window.partitionBy(*group).orderBy(order))
    return df.withColumn("_n", n).where(F.col("_n") <= slots).groupBy(*group).agg(*[F.max(F.when(F.col("_n") == i, F.col(value))).alias(f"{value}_{i}") for i in range(1, slots + 1)])
