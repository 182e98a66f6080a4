"""More queries over the test tables: dashboard views, keys, prompts, and rows read from answers; their SQL is literal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexalign.functions import similarity, split, text, verdicts
from lexalign.operators import audit, extract

from .queries import QUERIES, SQL, query, t

__all__ = ["QUERIES", "SQL"]


def _nth(key: str, *values: str | Column) -> Column:
    """values[key % len(values)]"""
    return F.get(F.array(*[F.lit(v) if isinstance(v, str) else v for v in values]), (F.col(key) % len(values)).cast("int"))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2")
def status_by_company(spark, d):
    return audit.status_by_company(t(spark, d, "orders"), "o_orderpriority", "o_orderstatus")


@query("SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 5")
def top_values(spark, d):
    return audit.top_values(t(spark, d, "part"), "p_brand", 5)


@query("SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def sorted_values(spark, d):
    return audit.sorted_values(t(spark, d, "part"), "p_type")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_quantity >= 25 AND l_linenumber % 3 = 1")
def chosen_rows(spark, d):
    li = t(spark, d, "lineitem").withColumn("flag", F.when(F.col("l_linenumber") % 3 > 0, F.col("l_linenumber") % 3 == 1))
    return audit.above(audit.chosen(li, "l_returnflag", ["A", "R"]), "l_quantity", 25, "flag").select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT p_partkey, lower(p_name) AS simple, ['yes', 'no', 'no', 'yes', 'yes'][p_partkey % 5 + 1] AS number,
  'Abc' || chr(10) || p_name AS spaced FROM part""")
def keys_of_text(spark, d):
    cell = _nth("p_partkey", " I.076-11", " ec ", "plain", "16-0 11I.", "f.a 12")
    return t(spark, d, "part").select(
        "p_partkey", text.simple_key(F.concat(F.lit(" \t"), F.upper("p_name"), F.lit("\n"))).alias("simple"),
        F.when(text.is_registration_number(cell), "yes").otherwise("no").alias("number"),
        text.clean_spaces(F.concat(F.lit("A b c\r\n \r"), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit(" "))).alias("spaced"),
    )


@query("SELECT l_orderkey, l_linenumber, CAST(greatest(0, l_linenumber - 3) * 12.5 AS DOUBLE) AS share FROM lineitem")
def percents(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", similarity.percent((F.col("l_linenumber") - 3) / 8.0).alias("share"))


@query("SELECT o_orderkey, ['approved', 'banned', 'unknown', 'not_renewed', 'unknown'][o_orderkey % 5 + 1] AS status FROM orders")
def answered_status(spark, d):
    said = _nth("o_orderkey", 'Sure: {"status_current": " Approved "} ok', '```json\n{"status_current": "BANNED"}\n```', '{"status_current": "odd"}', '{"x": 1, "status_current": "not_renewed"}', "no answer")
    return t(spark, d, "orders").select("o_orderkey", verdicts.status_from_answer(said).alias("status"))


@query("""SELECT p_partkey, 'Source unit: "' || p_type || '"' || chr(10) || 'Normalized: "' || p_name || '"' || chr(10) || chr(10) || 'Candidates:' || chr(10)
  || 'Candidate #1:' || chr(10) || '  Name: ' || p_name || chr(10) || '  EU Status: Approved' || chr(10) || '  CAS No: N/A' || chr(10) || '  Formula: C2' || chr(10) || chr(10)
  || 'Candidate #2:' || chr(10) || '  Name: Unknown' || chr(10) || '  EU Status: Unknown' || chr(10) || '  CAS No: 1-1' || chr(10) || '  Formula: N/A' || chr(10) AS asked FROM part""")
def model_questions(spark, d):
    def one(*values) -> Column:
        return F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(n) for v, n in zip(values, ("name", "status", "cas", "formula"), strict=True)])

    none = F.lit(None).cast("string")
    asked = verdicts.question(F.col("p_type"), F.col("p_name"), F.array(one(F.col("p_name"), "Approved", none, "C2"), one(none, "", "1-1", none)))
    return t(spark, d, "part").select("p_partkey", F.substring_index(asked, "\nIs the source", 1).alias("asked"))


@query("""SELECT c_custkey, x[1] AS product, x[2] AS company, x[3] AS maker, x[4] AS country FROM (SELECT c_custkey, CASE c_custkey % 7
  WHEN 0 THEN ['P1', c_name, 'None', 'Non spécifié'] WHEN 1 THEN ['Prod', c_name, 'Non spécifié', 'FR'] WHEN 2 THEN ['Prod', c_name, 'Non spécifié', 'FR']
  WHEN 3 THEN ['Prod', 'Ab', c_name, 'FR'] WHEN 4 THEN ['Prod;X', c_name, 'Non spécifié', 'FR'] WHEN 5 THEN ['Prod', c_name, 'Mk', 'Non spécifié']
  ELSE ['a' || chr(10) || 'b "c" d', c_name, 'Mk', 'FR'] END AS x FROM customer)""")
def origin_rows(spark, d):
    name = F.col("c_name")
    line = _nth(
        "c_custkey", F.concat(F.lit("P1; "), name, F.lit(";None")), F.concat(F.lit("Prod;"), name, F.lit(";none; FR")), F.concat(F.lit("Sub;Prod;I.010-19;"), name, F.lit(";FR")),
        F.concat(F.lit("Sub;Prod;Ab;"), name, F.lit(";FR")), F.concat(F.lit('Sub;"Prod;X";N;'), name, F.lit(";2 L/ha;FR")), F.concat(F.lit("Sub;Prod;N;"), name, F.lit(";Mk;x;NULL")),
        F.concat(F.lit(';"a\nb ""c"" d";N;'), name, F.lit(";Mk;FR")),
    )
    said = F.concat(F.lit("```csv\nHere are the rows:\nSubstance;P.COMM;N\n"), line, F.lit("\n```"))
    got = extract.rows_of_text(t(spark, d, "customer").select("c_custkey", said.alias("said")), "said", heads=["p.comm"], shape=split.origin_row)
    return got.select("c_custkey", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("product", "company", "maker", "country"))])
