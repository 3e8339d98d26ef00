"""The registered queries: their columns, and their SQL where they have one."""

from __future__ import annotations

import pytest

from check import compare, oracle_connection
from reelhouse.llm.queries import registry

COLUMNS = {
    "op1": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op2": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op3": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op4": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op5": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op6": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op7": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op8": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op10": "doc_id bigint, fingerprint string, component_id bigint",
    "op11": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op12": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op13": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
}


@pytest.mark.parametrize("name", sorted(registry.queries))
def test_columns(spark, folder, name):
    df = registry.queries[name](spark, folder)
    wanted = [tuple(c.split(" ")) for c in COLUMNS[name.split("_")[0]].split(", ")]
    assert df.dtypes[: len(wanted)] == wanted
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(registry.oracle_sql))
def test_sql(spark, folder, name):
    good, text = compare(registry.queries[name](spark, folder), oracle_connection(folder), name)
    assert good, text
