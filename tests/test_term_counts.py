"""Words of a bag are counted by the task that holds it."""

from kindred.operators.lexical import build_lexical, term_counts


def test_words_are_counted_without_a_shuffle(spark):
    texts = spark.createDataFrame([("a a b c c c", 6, 4, 2), ("x", 1, 5, 1), ("", 0, 6, 1)], "words string, dl int, first_id long, copies long")
    found = term_counts(texts)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in found.collect()) == [("a", 4, 2, 6, 2), ("b", 4, 2, 6, 1), ("c", 4, 2, 6, 3), ("x", 5, 1, 1, 1)]


def test_copies_count_once_in_postings_and_each_in_documents(spark, tmp_path):
    docs = spark.createDataFrame([(3, "b A a"), (1, "a  a b"), (2, None), (9, "c")], "doc_id long, text string")
    index = build_lexical(docs, str(tmp_path / "lexical"), "doc_id")
    assert sorted((r["term"], r["doc_id"]) for r in index.postings.collect()) == [("a", 1), ("b", 1), ("c", 9)]
    assert sorted((r["term"], r["df"]) for r in index.terms.collect()) == [("a", 2), ("b", 2), ("c", 1)]
    assert sorted((r["doc_id"], r["dl"], r["first_id"], r["copies"]) for r in index.documents.collect()) == [(1, 3, 1, 2), (2, 0, 2, 1), (3, 3, 1, 2), (9, 1, 9, 1)]
