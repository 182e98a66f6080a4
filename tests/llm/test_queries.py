import pytest

from lexalign.llm import queries
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_as_its_sql(spark, name):
    assert_same(spark, queries.queries()[name], queries.oracle_sql()[name], SF)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_contract_columns(spark, name):
    want = {
        "op1": "doc_id n_words n_base first_word last_word base_labels labels score", "op2": "query_id rank vec_id score", "op3": "doc_id held_out score predicted", "op4": "doc_id n_bytes n_removed n_spans kept_sha256", "op5": "doc_id n_lines n_dropped kept_sha256",
        "op6": "doc_id n_words n_hit n_items items_sha256 contaminated", "op7": "doc_id held_out score predicted", "op8": "doc_id size text_crc32 law shard slot grown_shard", "op9": "doc_id size source_size target taken", "op10": "doc_id fingerprint component_id",
    }
    first = want[name.split("_")[0]].split()
    assert first == queries.queries()[name](spark, SF).columns[: len(first)]  # more may follow
