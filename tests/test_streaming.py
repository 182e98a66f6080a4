from lexalign.operators import matching
from lexalign.plans import pipelines
from lexalign.streaming import history


def test_feed_learns(spark, tmp_path):
    ref = spark.createDataFrame([("Abamectin", "1", "Approved", 1)], "substance_name string, substance_id string, substance_status string, ord long")
    schema = "row_id long, formula string"
    got = []

    def sink(recomposed, queue, n):
        got.append((n, {r["row_id"]: r["resolution_details"] for r in recomposed.collect()}, queue.count()))

    for k, rows in enumerate([[(1, "abamectinn")], [(2, "abamectinn + somethingelse")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        q = history.feed(spark, stream, "formula", matching.candidates(ref), str(tmp_path / "hist"), sink, checkpointLocation=str(tmp_path / "state"))
        q.processAllAvailable()
        q.stop()
        assert len(got) == k + 1
    assert got[0][1] == {1: "abamectinn:Abamectin(Approved)"} and got[0][2] == 0
    assert got[1][1][2].startswith("abamectinn:Abamectin(Approved) | somethingelse:Unresolved") and got[1][2] == 1
    known = spark.read.parquet(str(tmp_path / "hist" / "batch=0"))
    assert [tuple(r) for r in known.collect()] == [("abamectinn", "Abamectin")]


def test_propagated_queue(spark):
    queue = spark.createDataFrame([(1, "a", "accept", "A", "n"), (2, "a", "review", "", "")], "row_id long, substance_unit_1 string, review_decision_1 string, review_match_name_1 string, review_notes_1 string")
    out, known = pipelines.propagate_queue(queue)
    assert {(r["row_id"], r["decision"], r["match_name"], r["notes"]) for r in out.collect()} == {(1, "accept", "A", "n"), (2, "accept", "A", "n [Auto-propagé]")}
    assert known.count() == 1


def test_rows_from_texts(spark):
    pages = spark.createDataFrame([(1, "one page")], "page long, text string")
    out = pipelines.rows_from_texts(pages, lambda p: "```csv\na;b;c\nx; none ;;\n```").orderBy("cells").collect()
    assert [r["cells"] for r in out] == [["a", "b", "c", "Non spécifié"], ["x", "Non spécifié", "Non spécifié", "Non spécifié"]]


def test_yearly_list(spark):
    rows = [("f", 1, 0, 0, ["SUBSTANCE ACTIVE", "P.COMM", "N.H.", "SOCIETE"]), ("f", 1, 0, 1, ["Abamectine", "Alpha", "I.1-1", "Co"]), ("f", 1, 0, 2, ["", "Beta", "I.1-2", "Co"]), ("f", 1, 0, 3, ["SUBSTANCE ACTIVE", "P.COMM", "N.H.", "SOCIETE"])]
    tables = spark.createDataFrame(rows, "source string, page int, table int, row int, cells array<string>")
    pages = spark.createDataFrame([("f", 1, "Liste des FONGICIDES")], "source string, page int, text string")
    out = pipelines.yearly_list(tables, pages, 2024).orderBy("Produit Commercial").collect()
    assert [(r["Catégorie"], r["Substance Active"], r["Produit Commercial"], r["Année"]) for r in out] == [("FONGICIDE", "Abamectine", "Alpha", 2024), ("FONGICIDE", "Abamectine", "Beta", 2024)]
