"""Language identification: held-out accuracy, and what it learns from."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from reelhouse.llm import language_id as li


def test_held_out_accuracy(small):
    rows = li.identify(small["documents"]).collect()
    langs = {r.doc_id: r.lang for r in small["documents"].collect()}
    assert len(rows) == len(langs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)


def test_held_out_labels_teach_nothing(small):
    docs = small["documents"]
    spoiled = docs.withColumn("lang", F.when(li.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(li.identify(spoiled).collect()) == sorted(li.identify(docs).collect())


def test_rejection(small, spark):
    model = li.fit(small["documents"])
    texts = spark.createDataFrame([(1, "Это совсем другой язык и другое письмо"), (2, "123 !? 456"), (3, None), (4, "")], "doc_id long, text string")
    rows = {r.doc_id: r.x for r in texts.select("doc_id", li.language(F.col("text"), model).alias("x")).collect()}
    assert rows[1].rejected and rows[1].lang in model.languages
    assert all(rows[i].lang == "und" and rows[i].score == 0.0 for i in (2, 3, 4))


def test_edge_rows(edge_docs, no_docs):
    rows = li.identify(edge_docs).collect()
    assert len(rows) == 14
    assert all(r.lang_pred in ("en", "de", "und") for r in rows)
    assert li.identify(no_docs).count() == 0
    assert {r.lang_pred for r in li.identify(edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
