"""Registered corpus queries beside their SQL, and the columns of the others."""

import pytest
from prepkit.llm.queries import ORACLES, QUERIES
from tools.compare import compare, open_oracle

SF_DIR = "/root/testdata/sf0.001"

#: Columns that a query without SQL returns at least.
COLUMNS = {
    "op1_chat": {"conv_id", "first_line", "n_lines", "role", "text", "begins", "rendered"},
    "op3_html_text": {"page_id", "url", "text", "n_chars"},
    "op5_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op7_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op8_licenses": {"doc_id", "n_words", "n_matches", "matches"},
    "op10_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(spark, open_oracle(SF_DIR), name, SF_DIR).startswith("ok")


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert COLUMNS[name] <= set(df.columns) and df.count() > 0
