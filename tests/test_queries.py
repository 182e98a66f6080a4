import pytest

from lexalign import registry
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_as_its_sql(spark, name):
    assert_same(spark, registry.queries()[name], registry.oracle_sql()[name], SF)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql()) - {"review_queue"}))
def test_has_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 200


def test_decision_index_rounds_halves_to_even(spark, tmp_path):
    rows = [(i, i, float(i) / 2, "click") for i in range(12)]
    spark.createDataFrame(rows, "event_id long, user_id long, value double, event_type string").toPandas().to_parquet(tmp_path / "events.parquet")
    assert_same(spark, registry.queries()["decision_index"], registry.oracle_sql()["decision_index"], str(tmp_path))


def test_clean_names_at_edges_of_words(spark, tmp_path):
    texts = ["gewiß, gern", "maß. lich 5 g", "gern, gewiß", "5ß 3 g/l", "œsel sel œ", "sel de maß", "λ, kg λ", "a, g b", "β-1,5 g/kg", "ß12 ufc"]
    spark.createDataFrame([(1, i, x) for i, x in enumerate(texts)], "conv_id long, turn int, text string").toPandas().to_parquet(tmp_path / "conversations.parquet")
    assert_same(spark, registry.queries()["clean_names"], registry.oracle_sql()["clean_names"], str(tmp_path))
