import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexalign.functions import similarity
from lexalign.operators import audit, extract, hazards, matching, review
from lexalign.sources import files

REFERENCE = [("Chlorpyrifos", "548", "Not approved", 1), ("Abamectin", "123", "Approved", 2), ("alpha-cypermethrin", "325", "Approved", 3)]


def reference(spark):
    return spark.createDataFrame(REFERENCE, "substance_name string, substance_id string, substance_status string, ord long")


def mapping(spark):
    return matching.history(spark.createDataFrame([("chorpyriphos", "Chlorpyrifos", 1)], "source_name string, eu_name string, ord long"))


def test_cascade(spark):
    units = spark.createDataFrame([(x,) for x in ("chorpyriphos", "abamectin", "abamectinn", "randomsubstance", "")], "norm string")
    got = {r["norm"]: (r["eu_name"], r["match_type"], r["score"]) for r in matching.match_units(units, matching.candidates(reference(spark)), mapping(spark)).collect()}
    assert got["chorpyriphos"] == ("Chlorpyrifos", "auto_mapped", 100)
    assert got["abamectin"] == ("Abamectin", "exact", 100)
    assert got["abamectinn"] == ("Abamectin", "auto_accept_high_confidence", 95)
    assert got["randomsubstance"][1] == "unresolved" and got[""][1:] == ("empty", 0)


def test_queue_and_back(spark):
    products = spark.createDataFrame([(1, "P1", "Abamectine 1.8% EC"), (2, "P2", "Abamectine + randomsubstance"), (3, "P3", "")], "row_id long, product string, formula string")
    recomposed, queue, hist = review.build_queue(products, "formula", matching.candidates(reference(spark)), mapping(spark))
    status = {r["row_id"]: r["eu_overall_status"] for r in recomposed.collect()}
    assert status == {1: "ALL_SUBSTANCES_APPROVED_IN_EU", 2: "NOT_FOUND_OR_NEEDS_MANUAL_REVIEW", 3: "NO_SUBSTANCE"}
    rows = queue.collect()
    assert [r["row_id"] for r in rows] == [2] and rows[0]["substance_unit_2"] == "randomsubstance" and rows[0]["review_decision_1"] == "exact" and "candidate_2_5_url" in queue.columns
    said = queue.withColumns({"review_decision_2": F.lit("accept"), "review_match_name_2": F.lit("alpha-cypermethrin")})
    decisions = review.queue_decisions(said)
    out = {r["row_id"]: r for r in review.reinject(recomposed, "formula", "resolution_details", decisions, reference(spark), "2026-01-01").collect()}
    assert out[1]["product_is_approved"] and out[2]["product_is_approved"] and not out[3]["product_is_approved"]
    assert out[2]["eu_substances_final"] == "Abamectin | alpha-cypermethrin"
    new = {r["hist_norm"]: r["hist_name"] for r in review.updated_history(hist, decisions).collect()}
    assert new["randomsubstance"] == "alpha-cypermethrin" and "chorpyriphos" in str(new)


def test_decision_index(spark):
    rows = [("a", 1, 1, "review", "X", ""), ("a", 2, 1, "accept", "Y", ""), ("b", 1, 1, "", "", ""), ("b", 2, 1, "review", "Z", "")]
    got = {r["norm"]: (r["decision"], r["match_name"]) for r in review.decision_index(spark.createDataFrame(rows, "norm string, row long, slot int, decision string, match_name string, notes string")).collect()}
    assert got == {"a": ("accept", "Y"), "b": ("review", "Z")}


def test_rollup_needs_all(spark):
    units = spark.createDataFrame([(1, 1, "a", "Auto Mapped", "A", "approved", "low", False, True, False), (1, 2, "b", "Pending Review", "", None, None, None, None, None), (2, 1, "a", "Manual Accept", "A", "not_approved", "high", True, False, False)], "row_id long, slot int, unit string, label string, name string, status_current string, risk string, is_substitution boolean, is_low_risk boolean, is_basic boolean")
    out = {r["row_id"]: r for r in review.rollup(spark.createDataFrame([(1,), (2,), (3,)], "row_id long"), units).collect()}
    assert [out[i]["product_is_approved"] for i in (1, 2, 3)] == [False] * 3
    assert [out[i]["eu_regulatory_risk_flag"] for i in (1, 2, 3)] == ["high", "high", "low"]
    assert out[1]["alert_final"] == "b (Pending Review)" and out[2]["eu_candidate_for_substitution"]


def test_merge_rule(spark):
    f = spark.createDataFrame([("q", "Chlorpyrifos", 80.0, 1), ("q", "Deltamethrin", 90.0, 2)], "query string, name string, fuzzy double, pos int")
    s = spark.createDataFrame([("q", "Chlorpyrifos", 0.85, 1), ("q", "Cypermethrin", 0.75, 2)], "query string, name string, semantic double, pos int")
    got = [(r["name"], r["combined"]) for r in matching.merge_shortlists(f, s).orderBy("rank").collect()]
    assert got == [("Deltamethrin", 90.0), ("Chlorpyrifos", 88.5), ("Cypermethrin", 67.5)]


def test_semantic_top_in_blocks(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(120)] + [(i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.5]) for i in range(120, 140)] + [(i, [0.0] * 6) for i in range(140, 150)]
    rows += [(150, None), (151, []), (152, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (153, [float("nan")] * 6), (154, [float("inf"), 1.0, 0.0, 0.0, 0.0, 0.0]), (155, [1e-170] * 6), (156, [1e200] * 6), (157, [1.0, 2.0, 0.0]), (158, [1.0] * 7)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    q, x = df.toDF("query_id", "query_vec"), df.toDF("item_id", "item_vec")
    pairs = q.join(x, F.size("item_vec") >= 0).select("query_id", "item_id", similarity.cosine(F.col("query_vec"), F.col("item_vec")).alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "item_id"))
    for k, *blocks in ((5,), (5, 40, 70), (200, 40, 70)):
        want = sorted((r["query_id"], r["rank"], r["item_id"], repr(r["similarity"])) for r in pairs.withColumn("rank", rank).where(F.col("rank") <= k).collect())
        got = matching.semantic_top(q, x, k, *blocks)
        assert sorted((r["query_id"], r["rank"], r["item_id"], repr(r["similarity"])) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan  # pairs of vectors are no rows
    assert matching.semantic_top(q.limit(0), x).count() == 0 == matching.semantic_top(q, x.limit(0)).count()


def test_audit(spark):
    a = spark.createDataFrame([("É", "1"), (None, "2")], "k string, v string")
    b = spark.createDataFrame([(" e ", "3"), (None, "4"), ("z", "5")], "k string, v string")
    got = sorted((r["k"] or "", r["v_a"], r["v_b"], r["_merge"]) for r in audit.audit_merge(a, b, ["k"]).collect() if True)
    assert got == [("", "2", "4", "both"), ("e", "1", "3", "both"), ("z", None, "5", "right_only")]


def test_hazards(spark):
    ref = spark.createDataFrame([("r", "CAS 1-1", "N", 1)], "uuid string, cas_number string, name string, ord long")
    sub = spark.createDataFrame([("s", "r", 1)], "uuid string, ref_uuid string, ord long")
    tox = spark.createDataFrame([("s", 0.5, None, 1), ("s", 0.005, 0.05, 2), ("s", float("nan"), None, 3)], "parent_uuid string, adi double, arfd double, ord long")
    got = hazards.with_hazards(spark.createDataFrame([("1-1",), ("9",)], "cas string"), "cas", hazards.hazard_table(ref, sub, tox)).orderBy("cas").collect()
    assert (got[0]["adi"], got[0]["tox_severity_score"]) == (0.005, 8) and (got[1]["hazard_found"], got[1]["adi_text"]) == (False, "Inconnu")


def test_fragments(spark):
    rows = [("f", 1, "Alpha 10", "Company A", "Maker"), ("f", 2, "EC", "", ""), ("g", 3, "EC", "", "")]
    out = extract.merge_fragment_rows(spark.createDataFrame(rows, "source string, ord long, product string, company string, maker string"), ("product", "company", "maker")).orderBy("ord").collect()
    assert [r["product"] for r in out] == ["Alpha 10 EC", "EC"]
    v = spark.createDataFrame([("p", 1, "JIANGYIN SULI"), ("p", 2, "JIANGYIN SULl X"), ("p", 3, "OTHER")], "k string, ord long, name string")
    assert {r["name"] for r in extract.merged_variants(v, "name", ["k"], "ord").collect()} == {"JIANGYIN SULl X", "OTHER"}


def test_tables(spark):
    rows = spark.createDataFrame([("f", 0, ["a", "", "x"]), ("f", 1, ["", "b", "y"])], "t string, row int, cells array<string>")
    assert [r["cells"] for r in extract.merge_split_columns(rows, ["t"]).orderBy("row").collect()] == [["a", "x"], ["b", "y"]]
    roles = extract.column_roles(spark.createDataFrame([("f", 0, ["Alpha", "I.076-11", "Co", "Mk"])], "t string, row int, cells array<string>"), ["t"], {"product": ["P.COMM"], "company": ["SOCIETE"]})
    assert {(r["role"], r["column"]) for r in roles.collect()} == {("product", 0), ("number", 1), ("company", 2), ("maker", 3)}


def test_files(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_bytes("﻿source_name,eu_name\nCuivre,Copper\ncuivre, Copper compounds \n".encode())
    assert [tuple(r) for r in files.read_mapping(spark, str(p)).collect()] == [("copper", "Copper compounds")]
    assert files.read_mapping(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "l.csv").write_bytes("a;b\né;1\n".encode("cp1252"))
    assert files.probe_encoding(spark, str(tmp_path / "l.csv")) == "cp1252"
    (tmp_path / "e.json").write_text('{"total": 1, "items": [{"name": "x"}]}')
    assert [r["name"] for r in files.read_json_records(spark, str(tmp_path / "e.json"), spark.createDataFrame([], "name string").schema).collect()] == ["x"]
    files.write_delimited(spark.range(2), str(tmp_path / "out"), single=True)
    assert files.read_delimited(spark, str(tmp_path / "out")).count() == 2
    calls = []

    def get(u, t):
        calls.append(u)
        if len(calls) < 2:
            raise OSError
        return b"{}"

    assert files.fetch("u", str(tmp_path / "d.json"), backoff=0, get=get) and len(calls) == 2
    cands = matching.candidates(reference(spark))
    files.build_index(cands, lambda names: [[float(len(n))] for n in names], str(tmp_path / "ix"), "h1")
    assert files.load_index(spark, str(tmp_path / "ix"), "h1").count() == 3 and files.load_index(spark, str(tmp_path / "ix"), "h2") is None
