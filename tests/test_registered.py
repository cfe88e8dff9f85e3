"""Registered queries against DuckDB on the smallest data; ``compare.py`` runs all of them."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

HEAVY = {
    "candidates_by_mode", "recommend_ids", "request_answers", "engine_comparison", "knn_ivf", "knn_ivf_all_cells",
    "knn_lsh_candidates", "cross_modal_jaccard", "recall_at_k", "fuse_two", "bm25_catalogue", "knn_exact_combined",
}
SQL, QUERIES = entry.oracle_sql(), entry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(SQL) - HEAVY))
def test_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, QUERIES[name], SQL[name], sf_dir) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", ["rrf_fusion", "bm25_topk", "request_status", "recommend_detailed", "purge_missing_image"])
def test_no_cross_join_in_plans(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_ranking_is_cut_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(QUERIES["rrf_fusion"](spark, sf_dir))


def test_scans_read_only_what_they_need(spark, sf_dir):
    text = plan(QUERIES["tokenize_counts"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    text = plan(QUERIES["profile_price"](spark, sf_dir))
    assert "l_extendedprice" not in text and "l_discount" not in text
