import pytest
from pyspark.sql import functions as F

from lexalign.functions import regulatory as reg
from lexalign.functions import similarity, split, text, verdicts


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()[0]


def many(spark, pairs, f):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "i int, x string").select("i", f(F.col("x")).alias("y")).orderBy("i").collect()
    assert [r["y"] for r in rows] == [b for _, b in pairs]


def test_normalize(spark):
    many(spark, [("Alphaméthrine", "alphamethrine"), ("Piége de phéromone", "piege de pheromone"), ("Azadirachtine (0,03 %)", "azadirachtine"), (None, ""), ("  ", "")], text.normalize)


def test_fold(spark):
    import unicodedata

    texts = ["plain", "ﬁn ½ ế", "Ω™ ㎏ Å …", "한글 각", "𝐀b ά й", "क़ कि", "ȩ́", "ẞ ß ŉ ǆ", "①② ﷺ", "´`’", ""]
    many(spark, [(x, "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))) for x in texts], text.fold)


def test_clean(spark):
    many(
        spark,
        [
            ("cuivre", "copper"), ("soufre", "sulphur"), ("huile de neem", "oil de neem"), ("deltamethrine", "deltamethrin"), ("hydroxyde de cuivre", "copper hydroxide"), ("oxychlorure de cuivre", "copper oxychloride"),
            ("sulfate de cuivre", "copper sulfate"), ("oxyde de cuivre", "copper oxide"), ("Bacillus thuringiensis (1x10^10 spores/g)", "bacillus thuringiensis"), ("Abamectine 1.8% EC", "abamectin"),
            ("Chlorpyrifos-ethyl 480 g/l", "chlorpyrifos"), ("sel d'ammonium", "salt ammonium"), (None, ""),
        ],
        text.clean_unit,
    )


def test_trivial(spark):
    many(spark, [("", True), ("g", True), ("%", True), ("12.5", True), ("chlorpyrifos", False)], text.is_trivial)


def test_split(spark):
    many(
        spark,
        [
            ("Azadirachtine (0,03 %) + 90,5% huile de neem", ["azadirachtin", "oil de neem"]), ("Abamectine + 5% + / + Cypermethrine", ["abamectin", "cypermethrin"]), ("", []), (None, []),
            ("Abamectine famille chimique Avermectine", ["abamectin"]), ("cuivre et soufre", ["copper", "sulphur"]), ("abamectin; Abamectine", ["abamectin"]),
        ],
        split.split_units,
    )


def test_cells(spark):
    many(spark, [("Alpha Works / Beta Co", ["Alpha Works", "Beta Co"]), ("Alpha Works\nLTD\nGamma Farm", ["Alpha Works LTD", "Gamma Farm"]), (None, [])], split.cell_entities)
    many(spark, [("G l y c e l", "Glycel"), ("Two words", "Two words"), ("A B   CD", "A B CD"), ("a\rb\r\nc", "a\nb\nc"), ("two\twords  here", "two\twords here")], text.clean_spaces)
    many(spark, [("", True), ("EC", True), ("Ltd.", True), ("Real Name", False), ("!!", False)], text.is_fragment)


def test_chunks(spark):
    assert one(spark, "aaaa\nbbbb\ncccc", lambda c: split.chunks(c, 10)) == ["aaaa\nbbbb", "cccc"]
    assert one(spark, "x" * 30 + "\nb", lambda c: split.chunks(c, 10)) == ["x" * 30, "b"]
    assert one(spark, "short", lambda c: split.chunks(c, 10)) == ["short"]


def test_company(spark):
    many(spark, [("Société Générale S.A.R.L", "SOCIETE GENERALE S A R L"), ("Alpha Crop Protection (France) Ltd", "ALPHA"), ("Non spécifié", "NON SPECIFIE"), (None, "NON SPECIFIE"), ("sarl", "NON SPECIFIE")], text.canonical_company)


def test_status_and_dates(spark):
    many(spark, [("Approved", "approved"), ("Not approved", "not_approved"), ("Withdrawn", "withdrawn"), ("Expired", "expired"), ("Banned", "banned"), ("Not renewed", "not_renewed"), ("Unknown Status", "unknown"), ("inactive", "approved"), (None, "unknown")], reg.classify_status)
    many(spark, [("2026-06-03", "2026-06-03"), ("03/06/2026", "2026-06-03"), ("31/02/2020", "2020-02-31"), ("3/6/2026", "2026-06-03"), ("soon", "soon"), (None, "")], reg.parse_date)


@pytest.mark.parametrize(("decision", "name", "want"), [("accept", "X", ("X", "Manual Accept")), ("exact", "X", ("X", "Auto Mapped")), ("auto_accept_high_confidence", "X", ("X", "Auto Accepted")), ("reject", "X", ("", "Rejected")), ("needs_research", "", ("", "Needs Research")), ("review", "X", ("", "Pending Review")), ("", "", ("", "Pending Review"))])
def test_resolution(spark, decision, name, want):
    r = spark.createDataFrame([(decision, name)], "d string, n string").select(reg.classify_resolution(F.col("d"), F.col("n")).alias("r")).first()["r"]
    assert tuple(r) == want


def test_wratio():
    assert similarity.wratio("abamectine", "abamectin") >= 90
    assert similarity.wratio("chlorpyriphos", "chlorpyrifos") >= 80
    assert similarity.wratio("abamectin", "chlorpyrifos") < 40
    assert round(similarity.wratio("abamectinn", "abamectin")) == 95
    assert similarity.wratio("", "x") == 0 == similarity.wratio(None, "x")


def test_scores(spark):
    df = spark.createDataFrame([([1.0, 0.0, 0.0], [1.0, 1.0, 0.0]), ([0.0], [1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(similarity.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(2**-0.5) and got[1] == 0
    assert spark.range(1).select(similarity.merged_score(F.lit(80.0), F.lit(0.85))).first()[0] == 88.5
    assert spark.range(1).select(reg.tox_score(F.lit("0.005"), F.lit("Inconnu"))).first()[0] == 5


def test_verdicts(spark):
    names = F.array(F.lit("Copper oxide"), F.lit("Abamectin"))
    rows = [('{"same_entity": true, "selected_candidate": "abamectin", "relation_type": "spelling_variant", "regulatory_state": "approved", "confidence": 2, "reason": "r"}',), ('{"same_entity": true, "selected_candidate": "Copper sulfate", "relation_type": "x", "regulatory_state": "approved"}',), ("no json",), (None,)]
    got = [r["v"] for r in spark.createDataFrame(rows, "x string").select(verdicts.verdict(F.col("x"), names).alias("v")).collect()]
    assert got[0]["selected_candidate"] == "Abamectin" and got[0]["same_entity"] and got[0]["confidence"] == 1 and not got[0]["requires_human_review"]
    assert got[1]["selected_candidate"] is None and got[1]["requires_human_review"] and got[1]["reason"].startswith("[Constraint Viol]")
    assert got[2]["requires_human_review"] and got[3]["requires_human_review"]


def test_model_that_fails(spark):
    df = spark.createDataFrame([("a",), (None,)], "p string")

    def model(p):
        raise OSError

    assert [r["said"] for r in verdicts.ask(df, "p", "said", model).collect()] == [None, None]
