"""Queries over the test tables, one or more for each family of operators, and the SQL that states their results.

The tables stand in for a registry: parts are products with formulas of several units, their names a reference list,
orders and their lines products with units, events decisions on units, suppliers and customers two extractions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexalign.functions import regulatory as reg
from lexalign.functions import similarity, split, text, verdicts
from lexalign.operators import audit, extract, hazards, matching, review

from . import pipelines
from . import sql as S

AS_OF = "1996-06-30"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            SQL[f.__name__] = oracle
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def products(spark: SparkSession, d: str) -> DataFrame:
    """row_id, name and formula of each part."""
    p = t(spark, d, "part")
    formula = F.concat(F.initcap("p_name"), F.lit(" (1,5 %) + "), F.lower("p_type"), F.when(F.col("p_size") % 3 == 0, " et Cuivre; ").when(F.col("p_size") % 3 == 1, " AND Huile de neem 480 g/l + 5% + ").otherwise(" ; "), F.col("p_name"))
    return p.select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("product"), formula.alias("formula"))


PRODUCTS = """(SELECT p_partkey AS row_id, p_name AS product,
  upper(p_name[1]) || CASE WHEN contains(p_name, ' ') THEN substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(split_part(p_name, ' ', 2)[1]) || substr(split_part(p_name, ' ', 2), 2) ELSE substr(p_name, 2) END
  || ' (1,5 %) + ' || lower(p_type) || CASE p_size % 3 WHEN 0 THEN ' et Cuivre; ' WHEN 1 THEN ' AND Huile de neem 480 g/l + 5% + ' ELSE ' ; ' END || p_name AS formula FROM part)"""


def reference(spark: SparkSession, d: str) -> DataFrame:
    """A reference list with repeated names: part names and types, with statuses."""
    p = t(spark, d, "part")
    statuses = F.element_at(F.array(*map(F.lit, ("Approved", "Not approved", "Approuvé le 1/1", "withdrawn", ""))), (F.col("k") % 5 + 1).cast("int"))
    names = p.select(F.col("p_name").alias("substance_name"), F.col("p_partkey").alias("k")).union(p.select("p_type", F.col("p_partkey") + 1))
    one = names.groupBy("substance_name").agg(F.min("k").alias("k"))
    return one.select("substance_name", F.col("k").cast("string").alias("substance_id"), statuses.alias("substance_status"), F.col("k").alias("ord"))


REFERENCE = """(SELECT substance_name, CAST(k AS VARCHAR) AS substance_id, ['Approved', 'Not approved', 'Approuvé le 1/1', 'withdrawn', ''][k % 5 + 1] AS substance_status, k AS ord
  FROM (SELECT substance_name, min(k) AS k FROM (SELECT p_name AS substance_name, p_partkey AS k FROM part UNION ALL SELECT p_type, p_partkey + 1 FROM part) GROUP BY substance_name))"""

UNITS = f"""(SELECT row_id, slot, u AS unit FROM (
  SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY p) AS slot, u FROM (
    SELECT *, row_number() OVER (PARTITION BY row_id, {S.normalize('u')} ORDER BY p) AS seen FROM (
      SELECT row_id, p, {S.half('u')} AS u FROM ({S.clean_steps(f"(SELECT row_id, unnest({S.mixture('formula')}) AS part, unnest(range(len({S.mixture('formula')}))) AS p FROM {PRODUCTS})", 'row_id, p', 'part')}) WHERE NOT {S.trivial('u')}
    )) WHERE seen = 1))"""
CANDS = f"(SELECT ord, substance_name AS cand_name, substance_id, {S.status('substance_status')} AS st, u AS cand_norm FROM ({S.clean_steps(REFERENCE, 'ord, substance_name, substance_id, substance_status', 'substance_name')}))"
ROLL = "CASE st WHEN 'approved' THEN 'Approved' WHEN 'unknown' THEN 'Unknown' ELSE 'Not approved' END"
INDEX = f"(SELECT cand_norm, cand_name, cand_status FROM (SELECT *, {ROLL} AS cand_status, row_number() OVER (PARTITION BY cand_norm ORDER BY ord DESC) AS n FROM {CANDS} WHERE cand_norm <> '') WHERE n = 1)"


@query(f"SELECT doc_id, md5({S.normalize('text')}) AS norm_md5, length({S.normalize('text')}) AS n FROM documents")
def normalize_text(spark, d):
    n = text.normalize("text")
    return t(spark, d, "documents").select("doc_id", F.md5(n).alias("norm_md5"), F.length(n).cast("long").alias("n"))


@query(f"SELECT conv_id, turn, u AS cleaned, {S.trivial('u')} AS trivial FROM ({S.clean_steps('conversations', 'conv_id, turn', 'text')})")
def clean_names(spark, d):
    c = t(spark, d, "conversations").select("conv_id", "turn", text.clean_unit("text").alias("cleaned"))
    return c.withColumn("trivial", text.is_trivial("cleaned"))


@query(f"SELECT row_id, CAST(slot AS INTEGER) AS slot, unit FROM {UNITS}")
def split_units(spark, d):
    return review.units_of(products(spark, d), "formula").select("row_id", "slot", "unit")


_FIXED = "list_filter(list_transform(string_split(formula, '+'), lambda p: trim(p)), lambda p: p <> '')"


@query(f"SELECT row_id, coalesce(l[1], '') AS s1, coalesce(l[2], '') AS s2, coalesce(l[3], '') AS s3, coalesce(l[4], '') AS s4, CAST(n_loose AS INTEGER) AS n_loose FROM (SELECT row_id, {_FIXED} AS l, len(regexp_split_to_array(formula, '[,/+]')) AS n_loose FROM {PRODUCTS})")
def split_slots(spark, d):
    s = split.fixed_slots("formula")
    return products(spark, d).select("row_id", *[c.alias(f"s{i + 1}") for i, c in enumerate(s)], F.size(split.split_loose("formula")).alias("n_loose"))


_STRICT = S.squeeze(S.rules(S.normalize("formula"), text.DOSES_STRICT))


@query(f"SELECT row_id, CASE WHEN contains(u, '2,4-d') OR contains(u, '2, 4-d') OR contains(u, '2 4-d') THEN '2,4-D' ELSE u END AS cleaned FROM (SELECT row_id, {_STRICT} AS u FROM {PRODUCTS})")
def clean_strict(spark, d):
    return products(spark, d).select("row_id", text.clean_unit_strict("formula").alias("cleaned"))


def _gate_sql() -> str:
    parts = []
    for words, name, category, st, flag in reg.INTERCEPTED:
        hit = " OR ".join(f"contains(u, {S.q(w)})" for w in words)
        parts.append((hit, name, category, st, flag))

    def case(i: int, other: str) -> str:
        return "CASE " + " ".join(f"WHEN {p[0]} THEN {S.q(p[i])}" for p in parts) + f" ELSE {other} END"

    any_hit = " OR ".join(f"({p[0]})" for p in parts)
    return f"""SELECT conv_id, turn, {case(1, 'u')} AS clean_name, ({any_hit}) AS intercepted, {case(2, S.q(reg.PASSED[0]))} AS category, {case(3, S.q(reg.PASSED[1]))} AS local_status, {case(4, S.q(reg.PASSED[2]))} AS risk_flag
      FROM (SELECT conv_id, turn, CASE WHEN contains(u, '2,4-d') OR contains(u, '2, 4-d') OR contains(u, '2 4-d') THEN '2,4-D' ELSE u END AS u FROM (SELECT conv_id, turn, {_STRICT.replace('formula', 'raw')} AS u FROM (SELECT conv_id, turn, text || CASE turn % 5 WHEN 0 THEN ' Keromone' WHEN 1 THEN ' pyrale' WHEN 2 THEN ' Polyether' WHEN 3 THEN ' SLES' ELSE '' END AS raw FROM conversations)))"""


@query(_gate_sql())
def gatekeeper(spark, d):
    extra = F.element_at(F.array(*map(F.lit, (" Keromone", " pyrale", " Polyether", " SLES", ""))), (F.col("turn") % 5 + 1).cast("int"))
    c = t(spark, d, "conversations").select("conv_id", "turn", F.concat("text", extra).alias("raw"))
    g = c.select("conv_id", "turn", reg.gatekeeper(F.col("raw"), text.clean_unit_strict("raw")).alias("g"))
    return g.select("conv_id", "turn", "g.clean_name", "g.intercepted", "g.category", "g.local_status", "g.risk_flag")


_COMPANY = S.rules(S.rules(S.fold("raw"), [(r"[^\p{L}\p{N}_\s]", " ")]), [(r"\b(sarl|sas|ltd|spa|co|llc|inc|gmbh|france|tunisia|tunisie|limited|company|crop|protection|agrochemical|agrochemicals|chemicals|chemical|sciences|science|agriculture|agricole)\b", "")])
_COMPANIES = "(SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN replace(s_name, '#', ' ') || ' S.A.R.L' WHEN 1 THEN upper(s_name) || ' Crop  Protection (France)' WHEN 2 THEN 'Non spécifié' ELSE s_name || ', Ltd.' END AS raw FROM supplier)"


@query(f"""SELECT canonical, string_agg(raw, ' | ' ORDER BY o, raw) AS variants FROM (
  SELECT CASE WHEN {S.fold('raw')} IN ('non specifie', '') OR u = '' THEN 'NON SPECIFIE' ELSE upper(u) END AS canonical, raw, min(k) AS o FROM (SELECT k, raw, {S.squeeze(_COMPANY)} AS u FROM {_COMPANIES}) GROUP BY 1, 2) GROUP BY canonical""")
def company_variants(spark, d):
    n, k = F.col("s_name"), F.col("s_suppkey") % 4
    raw = F.when(k == 0, F.concat(F.regexp_replace(n, "#", " "), F.lit(" S.A.R.L"))).when(k == 1, F.concat(F.upper(n), F.lit(" Crop  Protection (France)"))).when(k == 2, "Non spécifié").otherwise(F.concat(n, F.lit(", Ltd.")))
    return audit.name_variants(t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), raw.alias("raw")), "raw", "k")


@query("""SELECT coalesce(a.nk, b.nk) AS nation, coalesce(a.num, b.num) AS num, a.bal AS bal_a, b.bal AS bal_b, CASE WHEN a.i AND b.i THEN 'both' WHEN a.i THEN 'left_only' ELSE 'right_only' END AS _merge
  FROM (SELECT CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS nk, CAST(s_suppkey % 50 AS VARCHAR) AS num, s_acctbal AS bal, true AS i FROM supplier) a
  FULL JOIN (SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS nk, CAST(c_custkey % 50 AS VARCHAR) AS num, c_acctbal AS bal, true AS i FROM customer) b ON a.nk IS NOT DISTINCT FROM b.nk AND a.num IS NOT DISTINCT FROM b.num""")
def audit_merge(spark, d):
    a = t(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 7 != 0, F.col("s_nationkey").cast("string")).alias("nation"), (F.col("s_suppkey") % 50).cast("string").alias("num"), F.col("s_acctbal").alias("bal"))
    b = t(spark, d, "customer").select(F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey").cast("string")).alias("nation"), (F.col("c_custkey") % 50).cast("string").alias("num"), F.col("c_acctbal").alias("bal"))
    return audit.audit_merge(a, b, ["nation", "num"])


def _hist(spark, d):
    p = t(spark, d, "part").groupBy("p_type").agg(F.max("p_name").alias("m"), F.min("p_partkey").alias("ord"))
    rows = p.select(F.lower("p_type").alias("source_name"), F.when(F.col("ord") % 2 == 0, F.col("m")).otherwise("No Such Thing").alias("eu_name"), "ord")
    return matching.history(rows)


HIST = f"(SELECT k AS hist_norm, hist_name, u AS target FROM ({S.clean_steps(f'''(SELECT u AS k, hist_name FROM ({S.clean_steps('(SELECT lower(p_type) AS s, CASE WHEN min(p_partkey) % 2 = 0 THEN max(p_name) ELSE $$No Such Thing$$ END AS hist_name FROM part GROUP BY p_type)', 'hist_name', 's')}))''', 'k, hist_name', 'hist_name')}))"
MATCHED = f"""(SELECT row_id, slot, unit, coalesce(h2.cand_name, h.hist_name, c.cand_name) AS eu_name,
  CASE WHEN h2.cand_name IS NOT NULL THEN h2.cand_status WHEN h.hist_name IS NOT NULL THEN 'Unknown' ELSE c.cand_status END AS eu_status,
  CASE WHEN h2.cand_name IS NOT NULL THEN 'auto_mapped' WHEN h.hist_name IS NOT NULL THEN 'auto_mapped_not_in_db' WHEN c.cand_name IS NOT NULL THEN 'exact' ELSE 'none' END AS match_type
  FROM ({S.clean_steps(UNITS, 'row_id, slot, unit', 'unit')}) AS m
  LEFT JOIN {HIST} h ON h.hist_norm = m.u LEFT JOIN {INDEX} h2 ON h2.cand_norm = h.target LEFT JOIN {INDEX} c ON c.cand_norm = m.u)"""


def _matched(spark, d):
    units = review.units_of(products(spark, d), "formula")
    return matching.match_units(units, matching.candidates(reference(spark, d)), _hist(spark, d), fuzzy=False)


@query(f"SELECT row_id, CAST(slot AS INTEGER) AS slot, unit, eu_name, eu_status, match_type FROM {MATCHED}")
def match_cascade(spark, d):
    return _matched(spark, d).select("row_id", "slot", "unit", "eu_name", "eu_status", "match_type")


@query(f"""SELECT row_id, CASE WHEN lost THEN 'NOT_FOUND_OR_NEEDS_MANUAL_REVIEW' WHEN bad THEN 'CONTAINS_NOT_APPROVED_SUBSTANCE_IN_EU' ELSE 'ALL_SUBSTANCES_APPROVED_IN_EU' END AS eu_overall_status, names AS eu_substances, statuses AS eu_statuses, NOT lost AND NOT bad AS approved
  FROM (SELECT row_id, bool_or(match_type = 'none') AS lost, bool_or(match_type <> 'none' AND eu_status <> 'Approved') AS bad, string_agg(CASE WHEN match_type = 'none' THEN '' ELSE eu_name END, ' | ' ORDER BY slot) AS names, string_agg(CASE WHEN match_type = 'none' THEN '' ELSE eu_status END, ' | ' ORDER BY slot) AS statuses FROM {MATCHED} GROUP BY row_id)""")
def product_approval(spark, d):
    """The flagship: formulas split, cleaned and matched, and each product's units rolled up."""
    out = review.product_status(products(spark, d), _matched(spark, d))
    return out.select("row_id", "eu_overall_status", "eu_substances", "eu_statuses", (F.col("eu_overall_status") == "ALL_SUBSTANCES_APPROVED_IN_EU").alias("approved"))


@query()
def fuzzy_candidates(spark, d):
    units = review.units_of(products(spark, d), "formula").select("norm").distinct()
    return matching.fuzzy_top(units, matching.candidates(reference(spark, d)))


@query()
def match_by_spelling(spark, d):
    units = review.units_of(products(spark, d), "formula")
    out = matching.match_units(units, matching.candidates(reference(spark, d)), _hist(spark, d))
    return matching.learned_in_order(out, ["row_id", "slot"]).select("row_id", "slot", "unit", "eu_name", "eu_status", "match_type", "score")


@query()
def match_loose(spark, d):
    names = t(spark, d, "part").select(F.concat(F.initcap("p_name"), F.lit("e")).alias("name"))
    return matching.match_loose(names, reference(spark, d)).groupBy("name", "matched_name", "match_score", "match_found").agg(F.count("*").alias("n"))


@query()
def review_queue(spark, d):
    _, queue, _ = review.build_queue(products(spark, d), "formula", matching.candidates(reference(spark, d)), _hist(spark, d))
    return queue


_DOT = "list_reduce(list_transform(range(1, len({a}) + 1), lambda i: CAST({a}[i] AS DOUBLE) * CAST({b}[i] AS DOUBLE)), lambda x, y: x + y)"


@query(f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, item_id, similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, item_id) AS rank FROM (
    SELECT q.vec_id AS query_id, x.vec_id AS item_id, {_DOT.format(a='q.embedding', b='x.embedding')} / (sqrt({_DOT.format(a='q.embedding', b='q.embedding')}) * sqrt({_DOT.format(a='x.embedding', b='x.embedding')})) AS similarity
    FROM embeddings q, embeddings x)) WHERE rank <= 5""")
def semantic_candidates(spark, d):
    e = t(spark, d, "embeddings")
    index = e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("item_vec"))
    return matching.semantic_top(e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec")), index).select("query_id", "rank", "item_id", "similarity")


@query("""WITH f AS (SELECT l_orderkey AS query, l_partkey % 10 AS name, max(CAST(l_quantity AS INTEGER) * 2) AS fuzzy FROM lineitem GROUP BY 1, 2), s AS (SELECT l_orderkey AS query, l_suppkey % 10 AS name, max(CAST(l_quantity AS INTEGER)) / 50.0 AS semantic FROM lineitem GROUP BY 1, 2),
  m AS (SELECT coalesce(f.query, s.query) AS query, coalesce(f.name, s.name) AS name, coalesce(f.fuzzy, 0) AS f, coalesce(s.semantic, 0) * 100 AS s FROM f FULL JOIN s ON f.query = s.query AND f.name = s.name),
  c AS (SELECT query, name, round_even(CASE WHEN f > 0 AND s > 0 THEN least(100.0, greatest(f, s) * 0.7 + least(f, s) * 0.3 + 5) WHEN f > 0 THEN f ELSE s * 0.9 END, 1) AS combined FROM m)
  SELECT query, sum(CAST(round(combined * 10) AS BIGINT)) AS tenths, count(*) AS n, CAST(round(max(combined) * 10) AS BIGINT) AS best FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY combined DESC) AS r FROM c) WHERE r <= 5 GROUP BY query""")
def merged_shortlists(spark, d):
    li = t(spark, d, "lineitem")
    f = li.groupBy(F.col("l_orderkey").alias("query"), (F.col("l_partkey") % 10).alias("name")).agg((F.max(F.col("l_quantity").cast("int") * 2)).cast("double").alias("fuzzy")).withColumn("pos", F.lit(1))
    s = li.groupBy(F.col("l_orderkey").alias("query"), (F.col("l_suppkey") % 10).alias("name")).agg((F.max(F.col("l_quantity").cast("int")) / 50.0).alias("semantic")).withColumn("pos", F.lit(1))
    m = matching.merge_shortlists(f, s)
    return m.groupBy("query").agg(F.sum(F.round(F.col("combined") * 10).cast("long")).alias("tenths"), F.count("*").alias("n"), F.round(F.max("combined") * 10).cast("long").alias("best"))


_WORDS = "['Approved', 'Non approuve', 'Active substance', 'RETIRE', 'Expired', 'banned', 'non renouvele', ' ', 'pending']"


@query(f"""SELECT event_id, {S.status('raw')} AS status, CASE {S.status('raw')} WHEN 'approved' THEN 'Approved' WHEN 'unknown' THEN 'Unknown' ELSE 'Not approved' END AS rolled, upper(replace({S.status('raw')}, '_', ' ')[1]) || lower(substr(replace({S.status('raw')}, '_', ' '), 2)) AS label
  FROM (SELECT event_id, {_WORDS}[user_id % 9 + 1] || ' ' || event_type AS raw FROM events)""")
def statuses(spark, d):
    words = F.array(*map(F.lit, ("Approved", "Non approuve", "Active substance", "RETIRE", "Expired", "banned", "non renouvele", " ", "pending")))
    raw = F.concat(F.element_at(words, (F.col("user_id") % 9 + 1).cast("int")), F.lit(" "), F.col("event_type"))
    s = reg.classify_status(raw)
    return t(spark, d, "events").select("event_id", s.alias("status"), reg.rollup_status(raw).alias("rolled"), reg.status_label(s).alias("label"))


@query(f"""SELECT o_orderkey, parsed, try_cast(parsed AS DATE) < DATE '{AS_OF}' AS past FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'soon' END AS parsed FROM orders)""")
def dates(spark, d):
    o, k = t(spark, d, "orders"), F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).when(k == 2, F.date_format("o_orderdate", "yyyy/M/d")).otherwise(" soon ")
    p = reg.parse_date(raw)
    return o.select("o_orderkey", p.alias("parsed"), (p.try_cast("date") < F.lit(AS_OF).cast("date")).alias("past"))


_REC = f"""SELECT *, CASE WHEN st IN ('withdrawn', 'expired', 'banned', 'not_renewed') THEN true ELSE coalesce(e < DATE '{AS_OF}', false) END AS is_historical,
   CASE WHEN st = 'approved' AND coalesce(e < DATE '{AS_OF}', false) THEN 'expired' ELSE st END AS status_current
   FROM (SELECT o_orderkey, o_custkey, {S.status("['Approved', 'Not approved', 'withdrawn', ''][o_custkey % 4 + 1]")} AS st, CAST(o_orderdate AS DATE) AS e, o_orderpriority LIKE '1%' AS subst, o_orderpriority LIKE '5%' AS low FROM orders)"""


@query(f"SELECT o_orderkey, status_current, is_historical, subst AS is_substitution, CASE WHEN subst OR status_current IN ('not_approved', 'withdrawn', 'expired', 'banned', 'not_renewed') THEN 'high' WHEN low AND status_current = 'approved' THEN 'low' ELSE 'medium' END AS risk FROM ({_REC})")
def regulatory_records(spark, d):
    o = t(spark, d, "orders")
    rec = o.select("o_orderkey", F.element_at(F.array(*map(F.lit, ("Approved", "Not approved", "withdrawn", ""))), (F.col("o_custkey") % 4 + 1).cast("int")).alias("substance_status"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("expiryDate"), F.when(F.col("o_orderpriority").startswith("1"), " Yes").otherwise("no").alias("candidate_for_substitution"), F.when(F.col("o_orderpriority").startswith("5"), "1").otherwise("").alias("low_risk_active_substance"))
    c = reg.classify_record(rec.columns, AS_OF)
    return rec.select("o_orderkey", *[c[n].alias(n) for n in ("status_current", "is_historical", "is_substitution", "risk")])


@query("""WITH u AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'R' THEN 'not_approved' END AS st, l_linenumber % 5 = 4 AS rejected, l_quantity < 5 AS subst, l_quantity > 10 AS low FROM lineitem),
 x AS (SELECT *, CASE WHEN rejected OR st IS NULL THEN 2 WHEN st = 'not_approved' THEN 2 WHEN low THEN 0 ELSE 1 END AS risk, CASE WHEN rejected THEN '' WHEN st IS NULL THEN 'Unknown' WHEN st = 'approved' THEN 'Approved' ELSE 'Not approved' END AS label FROM u)
 SELECT l_orderkey, bool_and(label = 'Approved') AS product_is_approved, ['low', 'medium', 'high'][max(risk) + 1] AS eu_regulatory_risk_flag, bool_or(NOT rejected AND st IS NOT NULL AND subst) AS eu_candidate_for_substitution, bool_and(NOT rejected AND st IS NOT NULL AND low) AS eu_is_low_risk,
   coalesce(string_agg(label, ' | ' ORDER BY l_linenumber, label) FILTER (label <> ''), '') AS eu_statuses_final FROM x GROUP BY l_orderkey""")
def rolled_up(spark, d):
    li = t(spark, d, "lineitem")
    st = F.when(F.col("l_returnflag") == "A", "approved").when(F.col("l_returnflag") == "R", "not_approved")
    units = li.select("l_orderkey", F.col("l_linenumber").alias("slot"), F.concat(F.lit("u"), F.col("l_partkey").cast("string")).alias("unit"), F.when(F.col("l_linenumber") % 5 == 4, "Rejected").otherwise("Auto Mapped").alias("label"), F.lit("x").alias("name"), st.alias("status_current"), F.when(st == "not_approved", "high").when(F.col("l_quantity") > 10, "low").otherwise("medium").alias("risk"), (F.col("l_quantity") < 5).alias("is_substitution"), (F.col("l_quantity") > 10).alias("is_low_risk"), F.lit(False).alias("is_basic"))
    out = review.rollup(li.select("l_orderkey").distinct(), units, "l_orderkey")
    return out.select("l_orderkey", "product_is_approved", "eu_regulatory_risk_flag", "eu_candidate_for_substitution", "eu_is_low_risk", "eu_statuses_final")


@query("""SELECT norm, decision, match_name FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY CASE WHEN decision NOT IN ('', 'review') THEN 0 WHEN decision <> '' THEN 1 ELSE 2 END, CASE WHEN decision = '' THEN -event_id ELSE event_id END) AS n FROM (
  SELECT CAST(user_id AS VARCHAR) AS norm, event_id, ['', 'review', 'accept', 'reject'][CAST(value AS BIGINT) % 4 + 1] AS decision, event_type AS match_name FROM events)) WHERE n = 1""")
def decision_index(spark, d):
    e = t(spark, d, "events")
    dec = F.element_at(F.array(*map(F.lit, ("", "review", "accept", "reject"))), (F.rint("value").cast("long") % 4 + 1).cast("int"))
    rows = e.select(F.col("user_id").cast("string").alias("norm"), F.col("event_id").alias("row"), F.lit(1).alias("slot"), dec.alias("decision"), F.col("event_type").alias("match_name"), F.lit("").alias("notes"))
    return review.decision_index(rows).drop("notes")


_LONG = "(SELECT l_orderkey AS row_id, l_linenumber AS slot, CAST(l_partkey % 97 AS VARCHAR) AS unit, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'accept' ELSE 'review' END AS decision, CAST(l_suppkey AS VARCHAR) AS match_name FROM lineitem)"


@query(f"""WITH l AS {_LONG}, k AS (SELECT unit, match_name FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY slot DESC, row_id DESC) AS n FROM l WHERE decision = 'accept') WHERE n = 1)
  SELECT row_id, slot, l.unit, CASE WHEN k.unit IS NOT NULL THEN 'accept' ELSE decision END AS decision, CASE WHEN k.unit IS NOT NULL AND decision <> 'accept' THEN k.match_name ELSE l.match_name END AS match_name, k.unit IS NOT NULL AND decision <> 'accept' AS changed FROM l LEFT JOIN k ON k.unit = l.unit""")
def propagated(spark, d):
    li = t(spark, d, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("row_id"), F.col("l_linenumber").alias("slot"), (F.col("l_partkey") % 97).cast("string").alias("unit"), F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "accept").otherwise("review").alias("decision"), F.col("l_suppkey").cast("string").alias("match_name"), F.lit("").alias("notes"))
    return review.propagate(rows, review.truth(rows)).drop("notes")


@query("""SELECT l_orderkey, """ + ", ".join(f"coalesce(max(CAST(l_partkey AS VARCHAR)) FILTER (l_linenumber = {i}), '') AS part_{i}, coalesce(max(l_returnflag) FILTER (l_linenumber = {i}), '') AS flag_{i}" for i in range(1, 8)) + " FROM lineitem GROUP BY l_orderkey")
def wide_slots(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("slot"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"))
    return review.wide_slots(li, "l_orderkey", ["part", "flag"], 7)


@query("SELECT l_orderkey, l_linenumber AS slot, max(CAST(l_partkey AS VARCHAR)) AS part, max(l_returnflag) AS flag FROM lineitem WHERE l_linenumber BETWEEN 1 AND 7 GROUP BY 1, 2")
def long_slots(spark, d):
    return review.long_slots(wide_slots(spark, d), ["l_orderkey"], ["part", "flag"]).where("part <> ''")


@query("""SELECT l_orderkey, l_suppkey % 3 AS g, """ + ", ".join(f"max(l_partkey) FILTER (n = {i}) AS l_partkey_{i}" for i in range(1, 5)) + " FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 3 ORDER BY l_linenumber, l_partkey) AS n FROM lineitem) GROUP BY 1, 2")
def inventory(spark, d):
    li = t(spark, d, "lineitem").withColumns({"g": F.col("l_suppkey") % 3, "place": F.struct("l_linenumber", "l_partkey")})
    return audit.inventory(li, ["l_orderkey", "g"], "l_partkey", "place")


@query("""WITH b AS (SELECT s_suppkey AS sub, s_nationkey AS ref FROM supplier), x AS (SELECT ref, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_discount END AS adi, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_tax END AS arfd, l_orderkey * 10 + l_linenumber AS ord FROM lineitem JOIN b ON sub = l_suppkey),
 l AS (SELECT ref, arg_max(adi, ord) FILTER (adi IS NOT NULL) AS adi, arg_max(arfd, ord) FILTER (arfd IS NOT NULL) AS arfd FROM x GROUP BY ref), h AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') || '-1' AS cas, n_name, adi, arfd FROM nation LEFT JOIN l ON ref = n_nationkey)
 SELECT c_custkey, h.cas IS NOT NULL AS hazard_found, coalesce(n_name, 'Non trouvée') AS hazard_name, adi, arfd, least(10, coalesce(CASE WHEN adi < 0.01 THEN 5 WHEN adi < 0.1 THEN 3 END, 0) + coalesce(CASE WHEN arfd < 0.01 THEN 5 WHEN arfd < 0.1 THEN 3 END, 0)) AS tox_severity_score
 FROM customer LEFT JOIN h ON h.cas = lpad(CAST(c_nationkey + c_custkey % 2 * 5 AS VARCHAR), 4, '0') || '-1'""")
def hazard_scores(spark, d):
    ref = t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("uuid"), F.concat(F.lit("CAS "), F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), F.lit("-1")).alias("cas_number"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("ord"))
    sub = t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("uuid"), F.col("s_nationkey").cast("string").alias("ref_uuid"), F.col("s_suppkey").alias("ord"))
    tox = t(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("parent_uuid"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_discount")).alias("adi"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_tax")).alias("arfd"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    c = t(spark, d, "customer").select("c_custkey", F.concat(F.lpad((F.col("c_nationkey") + F.col("c_custkey") % 2 * 5).cast("string"), 4, "0"), F.lit("-1")).alias("cas"))
    return hazards.with_hazards(c, "cas", hazards.hazard_table(ref, sub, tox)).select("c_custkey", "hazard_found", "hazard_name", "adi", "arfd", "tox_severity_score")


@query("""SELECT p_name, p_brand, score FROM (SELECT p_name, p_brand, CAST(floor(p_retailprice / 200) AS INTEGER) AS score, p_partkey, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS n FROM part WHERE floor(p_retailprice / 200) >= 4 AND coalesce(p_brand, '') <> 'Approved') WHERE n = 1 ORDER BY score DESC, p_partkey LIMIT 20""")
def top_danger(spark, d):
    p = t(spark, d, "part").withColumn("score", F.floor(F.col("p_retailprice") / 200).cast("int"))
    return audit.top_danger(p, "p_name", "p_brand", "score", "p_partkey", least=4).select("p_name", "p_brand", "score")


@query("""SELECT risk_class, count(*) AS n FROM (SELECT CASE WHEN s >= 8 THEN 'Rouge (Extrême)' WHEN s >= 4 THEN 'Orange (Modéré)' ELSE 'Vert/Jaune (Faible)' END AS risk_class FROM (SELECT CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / 10 END AS s FROM events)) GROUP BY 1""")
def risk_pyramid(spark, d):
    e = t(spark, d, "events").select(reg.risk_class(F.when(F.col("event_id") % 13 == 0, float("nan")).otherwise(F.col("value") / 10)).alias("risk_class"))
    return audit.value_counts(e, "risk_class")


@query("""SELECT s_name, count(*) FILTER (l_returnflag = 'R') AS bad, count(*) AS total, CAST(round(100.0 * count(*) FILTER (l_returnflag = 'R') / count(*) * 100) AS BIGINT) AS hundredths FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_name""")
def risk_rates(spark, d):
    j = t(spark, d, "lineitem").join(t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return audit.risk_rate(j, "s_name", "l_returnflag", "R").select("s_name", "bad", "total", F.round(F.col("risk_rate") * 100).cast("long").alias("hundredths"))


@query("""SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events""")
def filled_down(spark, d):
    e = t(spark, d, "events").withColumn("filled", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).when(F.col("event_id") % 3 == 1, "").otherwise("None"))
    return extract.filled_down(e, ["filled"], ["user_id"], ["ts", "event_id"]).select("event_id", "filled")


@query("""SELECT conv_id, turn, coalesce(last_value(CASE turn % 4 WHEN 0 THEN 'FONGICIDE' WHEN 2 THEN 'INECTICIDE' END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 'Non Spécifiée') AS category FROM conversations""")
def page_categories(spark, d):
    c = t(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 4 == 0, F.concat("text", F.lit("\nFongicides:"))).when(F.col("turn") % 4 == 2, F.concat(F.lit("Insecticides "), "text")).otherwise(F.col("text")).alias("text"))
    return extract.page_categories(c, "conv_id", "turn").select("conv_id", "turn", "category")


@query()
def text_chunks(spark, d):
    pages = t(spark, d, "documents").select(F.col("doc_id").alias("page"), "text")
    return extract.text_chunks(pages).select("page", "part", "chunk_id", F.length("chunk").alias("n"))


@query("""WITH x AS (SELECT l_orderkey, l_suppkey % 5 AS c, CASE WHEN l_linenumber % 3 = 0 THEN 'SARL' ELSE 'Maker ' || (l_partkey % 7) || ' Works' END AS maker, l_linenumber % 3 = 0 AS frag FROM lineitem), y AS (SELECT *, bool_or(NOT frag) OVER (PARTITION BY l_orderkey, c) AS good FROM x) SELECT l_orderkey, c, maker FROM y WHERE NOT (frag AND good)""")
def purged_fragments(spark, d):
    x = t(spark, d, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 5).alias("c"), F.when(F.col("l_linenumber") % 3 == 0, "SARL").otherwise(F.concat(F.lit("Maker "), (F.col("l_partkey") % 7).cast("string"), F.lit(" Works"))).alias("maker"), F.concat(F.lit("Order "), F.col("l_orderkey").cast("string")).alias("product"), F.concat(F.lit("Company "), (F.col("l_suppkey") % 5).cast("string")).alias("company"))
    return extract.purge_fragments(x, "product", "company", "maker").select("l_orderkey", "c", "maker")


@query("""SELECT event_id, CAST(props->>'k' AS INTEGER) % 2 = 0 AND CAST(props->>'k' AS INTEGER) % 3 <> 0 AS same_entity, CASE WHEN CAST(props->>'k' AS INTEGER) % 3 <> 0 THEN event_type END AS selected_candidate, CAST(props->>'k' AS INTEGER) % 3 = 0 AS requires_human_review FROM events""")
def checked_verdicts(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    raw = F.concat(F.lit('```json\n{"same_entity": "'), (k % 2 == 0).cast("string"), F.lit('", "selected_candidate": "'), F.when(k % 3 == 0, "Invented").otherwise(F.upper("event_type")), F.lit('", "relation_type": "Spelling_Variant", "regulatory_state": "approved", "confidence": 1.7, "reason": "r"}\n```'))
    v = t(spark, d, "events").select("event_id", verdicts.verdict(raw, F.array(F.lit("other"), F.col("event_type"))).alias("v"))
    return v.select("event_id", "v.same_entity", "v.selected_candidate", "v.requires_human_review")


@query("""SELECT l_orderkey, l_linenumber, CASE n WHEN 4 THEN ['a', CAST(l_partkey AS VARCHAR), 'Non spécifié', 'd'] WHEN 3 THEN ['a', CAST(l_partkey AS VARCHAR), '', 'Non spécifié'] ELSE ['a', CAST(l_partkey AS VARCHAR), '', 'd'] END AS cells FROM (SELECT *, 3 + l_linenumber % 3 AS n FROM lineitem)""")
def repaired_rows(spark, d):
    li = t(spark, d, "lineitem")
    base = F.concat(F.lit("```csv\nno separator here\n a; "), F.col("l_partkey").cast("string"), F.lit(" ;"))
    line = F.concat(base, F.element_at(F.array(F.lit(""), F.lit(";\"d\""), F.lit("; d ;e")), (F.col("l_linenumber") % 3 + 1).cast("int")))
    return extract.rows_of_text(li.select("l_orderkey", "l_linenumber", line.alias("said")), "said").select("l_orderkey", "l_linenumber", "cells")


@query()
def merged_fragments(spark, d):
    li = t(spark, d, "lineitem")
    rows = li.select((F.col("l_suppkey") % 100).alias("source"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.when(F.col("l_linenumber") % 4 == 3, "EC").otherwise(F.concat(F.lit("Product "), F.col("l_partkey").cast("string"))).alias("product"), F.when(F.col("l_linenumber") % 4 == 3, "").otherwise(F.lit("Some Company")).alias("company"), F.lit("Some Maker").alias("maker"))
    return extract.merge_fragment_rows(rows, ("product", "company", "maker"))


@query()
def merged_variants(spark, d):
    p = t(spark, d, "part").select("p_brand", "p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.regexp_replace("p_name", "l", "1")).otherwise(F.col("p_name")).alias("name"))
    return extract.merged_variants(p, "name", ["p_brand"], "p_partkey")


@query("""SELECT name, st, ord FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY CASE WHEN n = 1 AND NOT contains(s, 'not approved') THEN 0 WHEN n > 1 AND contains(s, 'approved') AND NOT contains(s, 'not approved') THEN 1 WHEN n > 1 AND contains(s, 'approved') THEN 2 WHEN n = 1 THEN 3 ELSE 4 END, CASE WHEN n > 1 AND contains(s, 'not approved') THEN -n ELSE n END) AS r FROM (
  SELECT p_type AS name, ['Not approved', 'pending', 'Approved', 'Not approved'][p_size % 4 + 1] AS st, lower(['Not approved', 'pending', 'Approved', 'Not approved'][p_size % 4 + 1]) AS s, p_partkey AS ord, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS n FROM part)) WHERE r = 1""")
def preferred_records(spark, d):
    p = t(spark, d, "part").select(F.col("p_type").alias("name"), F.element_at(F.array(*map(F.lit, ("Not approved", "pending", "Approved", "Not approved"))), (F.col("p_size") % 4 + 1).cast("int")).alias("st"), F.col("p_partkey").alias("ord"))
    return matching.prefer_approved(p, "name", "st")


@query("""SELECT least(CAST(floor(value / (100.0 / 11)) AS INTEGER), 10) AS bin, count(*) AS n FROM events WHERE value >= 0 AND value <= 100 GROUP BY 1""")
def histogram(spark, d):
    return audit.histogram(t(spark, d, "events"), "value", 0, 100)


@query("SELECT count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_totalprice > 100000) AS dear FROM orders")
def counters(spark, d):
    return audit.counters(t(spark, d, "orders"), f=F.col("o_orderstatus") == "F", o=F.col("o_orderstatus") == "O", dear=F.col("o_totalprice") > 100000)


@query("""SELECT p_partkey, part, upper(trim(regexp_replace(p_brand, '\\s+', ' ', 'g'))) AS p_brand FROM (SELECT *, trim(unnest(regexp_split_to_array(p_name || ' / ' || p_type || ', ' || p_name, '[,/+]'))) AS part FROM part)
  WHERE part <> '' AND (contains(lower(p_name), lower(part)) OR contains(lower(part), lower(p_name))) AND regexp_matches(p_name, '(?i)RING|small')""")
def dashboard(spark, d):
    p = t(spark, d, "part").select("p_partkey", F.concat_ws(", ", F.concat_ws(" / ", "p_name", "p_type"), "p_name").alias("part"), "p_name", "p_brand", F.lit(5).alias("score"), F.lit(None).cast("string").alias("url"))
    rows = audit.dashboard_rows(p, "part", "p_name", "p_brand", "score", "url")
    return audit.above(audit.searched(rows, ["p_name"], "RING|small"), "score", 5).select("p_partkey", "part", "p_brand")


@query("""SELECT o_orderkey, CAST(o_custkey % 9 AS DOUBLE) / 4 AS adi_value FROM orders WHERE o_custkey % 9 > 0""")
def numbers_read(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.concat(F.lit("ADI: "), (F.col("o_custkey") % 9 / 4.0).cast("string"), F.lit(" mg/kg")).alias("adi"), F.lit("1e-05").alias("arfd"))
    return audit.correlation_rows(o, "adi", "arfd").select("o_orderkey", "adi_value")


@query("""WITH l AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS a, list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey)[1:2] AS b FROM lineitem GROUP BY 1)
  SELECT l_orderkey, i AS pos, CAST(a[i + 1] AS VARCHAR) AS a, CASE WHEN len(b) = 1 THEN CAST(b[1] AS VARCHAR) ELSE coalesce(CAST(b[i + 1] AS VARCHAR), '') END AS b, i < len(b) AS paired FROM (SELECT *, unnest(range(len(a))) AS i FROM l)""")
def zipped_lists(spark, d):
    li = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("x"))
    two = li.select("l_orderkey", F.transform("x", lambda r: r["l_partkey"].cast("string")).alias("a"), F.slice(F.transform("x", lambda r: r["l_suppkey"].cast("string")), 1, 2).alias("b"))
    n = F.size(split.positional_pairs(F.col("a"), F.col("b")))
    each = two.select("l_orderkey", n.alias("n"), F.explode(F.sequence(F.lit(0), F.size("a") - 1)).alias("i"), "a", "b")
    return each.select("l_orderkey", F.col("i").cast("long").alias("pos"), split.padded_at(F.col("a"), F.col("i")).alias("a"), split.padded_at(F.col("b"), F.col("i")).alias("b"), (F.col("i") < F.col("n")).alias("paired"))


@query("""SELECT p_partkey, trim(unnest(string_split(a, '/'))) AS a, b FROM (SELECT p_partkey, p_brand || ' / ' || p_type AS a, trim(unnest(string_split(p_name || '/x', '/'))) AS b FROM part)""")
def split_slashes(spark, d):
    p = t(spark, d, "part").select("p_partkey", F.concat_ws(" / ", "p_brand", "p_type").alias("a"), F.concat("p_name", F.lit("/x")).alias("b"))
    return extract.split_slashes(p, "a", "b")


@query("""SELECT 'X' AS "Catégorie", p_name AS "Substance Active", '' AS Concentration, '' AS Formulation, p_brand AS "Produit Commercial", '' AS "Numéro Homologation", '' AS "Société", p_type AS Fabricant, 2024 AS "Année" FROM part WHERE p_size % 2 = 1""")
def conformed(spark, d):
    p = t(spark, d, "part").select(F.col("p_name").alias("MATIERE ACTIVE"), F.lit("other").alias("SUBSTANCE ACTIVE"), F.when(F.col("p_size") % 2 == 1, F.col("p_brand")).when(F.col("p_size") % 4 == 0, "P.COMM").otherwise("").alias("P.COMM"), F.col("p_type").alias("FABRICANT"))
    out = extract.conformed(extract.renamed(p), Catégorie="X", Année=2024)
    return extract.all_filled(extract.without_heads(extract.any_filled(out, ["Substance Active", "Produit Commercial"]), "Produit Commercial", ["P.Comm"]), ["Produit Commercial"])


@query("SELECT o_orderkey, (o_totalprice / 1000) AS raw, least(1.0, greatest(0.0, o_totalprice / 100000)) AS conf FROM orders")
def clamped(spark, d):
    return t(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("raw"), similarity.clamped((F.col("o_totalprice") / 100000).cast("string")).alias("conf"))


@query()
def enriched_registry(spark, d):
    ref = reference(spark, d).withColumn("as_cas_number", F.concat(F.lpad(F.pmod("ord", F.lit(25)).cast("string"), 4, "0"), F.lit("-1")))
    t_ref = t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("uuid"), F.concat(F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), F.lit("-1")).alias("cas_number"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("ord"))
    sub = t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("uuid"), F.col("s_nationkey").cast("string").alias("ref_uuid"), F.col("s_suppkey").alias("ord"))
    tox = t(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("parent_uuid"), F.col("l_discount").alias("adi"), F.col("l_tax").alias("arfd"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    out = pipelines.enrich(products(spark, d), "formula", ref, hazards.hazard_table(t_ref, sub, tox))
    return out.select("row_id", "raw_name", "clean_name", "intercepted", "match_found", "matched_name", "match_score", "eu_status", "tox_severity_score")


@query("""SELECT p_name AS name, p_brand AS unit FROM part UNION SELECT p_type, 'x' FROM part ORDER BY 1, 2""")
def reference_list(spark, d):
    p = t(spark, d, "part").select(F.concat_ws("   ", "p_name", "p_type", F.lit("extra")).alias("a"), F.concat("p_brand", F.lit("  x")).alias("b"))
    return pipelines.reference_list(p, "a", "b")


@query()
def maker_dictionary(spark, d):
    li = t(spark, d, "lineitem")
    rows = li.select((F.col("l_suppkey") % 100).cast("string").alias("source"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("ord"), F.when(F.col("l_linenumber") % 4 == 3, "EC").otherwise(F.concat(F.lit("Product "), (F.col("l_partkey") % 50).cast("string"))).alias("product"), F.when(F.col("l_linenumber") % 4 == 2, "").otherwise(F.lit("Some Company / Other Firm")).alias("company"), F.when(F.col("l_linenumber") % 5 == 2, "Some Makcr").otherwise(F.lit("Some Maker")).alias("maker"))
    rows = rows.withColumn("ord", F.row_number().over(Window.partitionBy("source").orderBy("ord")).cast("long"))
    return pipelines.maker_dictionary(rows)
