"""The registered queries of this part: contract columns and types, and results over the given documents."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL
from test_jaccard import brute

COLUMNS = {
    "op1_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_license_scan": {"doc_id": "bigint", "license": "string", "dice": "double"},
    "op3_link_tool_calls": {"conv_id": "bigint", "turn": "bigint", "line": "string"},
    "op4_main_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op5_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6_jaccard_classes": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op7_exact_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op8_token_counts": {"doc_id": "bigint", "n_tokens": "bigint"},
    "op9_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op10_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                              "sequence_id": "bigint", "offset": "bigint"},
    "op11_turn_trie": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
                       "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op12_spelling_variants": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint",
                               "form_n": "bigint"},
    "op13_lm_scores": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
                       "base_score": "double", "score": "double"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c in COLUMNS[name]} == COLUMNS[name]
    assert df.count() > 0


def test_one_query_per_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and set(names) == set(COLUMNS)


def test_jaccard_classes_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((tuple(r) for r in E.queries()["op6_jaccard_classes"](spark, SF_MID).collect()), key=str)
    assert got == brute(rows, 3, 90, 100)


def test_packing_of_the_given_documents_is_near_the_bound(spark):
    got = E.queries()["op10_best_fit_packing"](spark, SF_MID)
    total, sequences = got.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert sequences <= -(-total // 4096) + 1
