import zlib

import pytest
import zstandard

from tests.llm.helpers import ODD_TEXTS, frame, read
from wayfare.llm.language import LanguageModel, fit_language_model, identify_language, language_query


def test_held_out_accuracy(spark):
    docs = read(spark, "documents", "sf0.01")
    rows = language_query(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) < 0.03 * len(rows)


def test_rows_equal_plain_compression(spark):
    """Sizes taken with zstandard alone, from the model's dictionaries."""
    docs = read(spark, "documents")
    model = fit_language_model(docs, "doc_id")
    packers = [zstandard.ZstdCompressor(level=6, write_content_size=False, write_checksum=False, write_dict_id=False,
                                        dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
               for d in model.dictionaries]
    got = {r["doc_id"]: r for r in identify_language(docs, model, ["doc_id"]).collect()}
    for row in docs.collect():
        r = got[row.doc_id]
        if not any(c.isalpha() for c in row.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        data, n = " ".join(row.text.lower().split()).encode(), 1
        if len(data) < 256:
            words = data.split(b" ")
            n = min(16, len(words))
            turned = [b"\n" * 400 + b" ".join(words[k:] + words[:k]) for k in range(n)]
            sizes = [sum(len(p.compress(x)) - len(p.compress(b"\n" * 400)) for x in turned) for p in packers]
        else:
            sizes = [sum(len(p.compress(data[k:k + 4096])) for k in range(0, len(data), 4096)) for p in packers]
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
        margin = (sizes[order[1]] - sizes[order[0]]) / sizes[order[1]]
        assert r.lang_pred == model.languages[order[0]] and abs(r.margin - margin) < 1e-12
        assert abs(r.score - 1 / sum(2.0 ** -((s - min(sizes)) / n) for s in sizes)) < 1e-9
        assert r.rejected == (len(data) >= 64 and margin < 0.005)


def test_odd_texts_and_extra_columns(spark):
    docs = read(spark, "documents")
    model = fit_language_model(docs, "doc_id")
    odd = frame(spark, list(enumerate(ODD_TEXTS))).withColumnRenamed("source", "_text").withColumnRenamed("lang", "score")
    got = {r["doc_id"]: r for r in identify_language(odd, model, ["doc_id"]).collect()}
    for clash in ("_text", "score"):
        with pytest.raises(ValueError, match="clash"):
            identify_language(odd, model, ["doc_id", clash])
    assert [got[k]["lang_pred"] for k in range(3)] == ["und"] * 3
    assert all(got[k]["rejected"] and got[k]["score"] == 0 for k in range(3))
    assert got[7]["lang_pred"] == got[8]["lang_pred"] and got[7]["score"] == got[8]["score"]


def test_nothing_learned_and_empty_table(spark):
    none = LanguageModel((), ())
    rows = identify_language(frame(spark, [(1, "some text")]), none, ["doc_id"]).collect()
    assert rows[0]["lang_pred"] == "und" and rows[0]["rejected"]
    assert language_query(frame(spark, [])).collect() == []
    null_id = language_query(frame(spark, [(None, "hello there")])).collect()
    assert null_id[0]["held_out"] is False and null_id[0]["lang_pred"] == "und"


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = read(spark, "documents")
    from pyspark.sql import functions as F
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(language_query(docs).collect()) == sorted(language_query(other).collect())


def test_too_many_labels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr("wayfare.llm.language.MAX_LANGUAGES", 3)
    docs = frame(spark, [(k, f"text {k}") for k in range(8)]).selectExpr("doc_id", "text", "cast(doc_id as string) as lang")
    with pytest.raises(ValueError, match="different values of lang"):
        fit_language_model(docs, "doc_id")
