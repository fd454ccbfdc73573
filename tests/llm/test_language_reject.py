"""What the pipeline's language stage rejects."""

from riskflow.llm import lang_id


def test_text_in_no_profile_goes_and_no_profile_keeps_letters(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, "\u0436\u0448\u0449\u044e", None),
            (4, "the dog", None), (5, "123 456", None), (6, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in lang_id.keep_known(d).collect()} == {1, 2, 4}
    bare = spark.createDataFrame([(i, t, None) for i, t, _ in rows], "doc_id long, text string, lang string")
    assert {r.doc_id for r in lang_id.keep_known(bare).collect()} == {1, 2, 3, 4}
