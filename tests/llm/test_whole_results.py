"""Queries over tables of a few rows, written for each test: all columns, all rows."""

import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import licences, packing, queries, shingles, tokens
from strata.llm.common import stored

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def written(spark, tmp_path, texts):
    rows = [(i, t, "en", "web", None if t is None else len(t)) for i, t in texts]
    spark.createDataFrame(rows, DOCUMENTS).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_every_statistic_of_rejected_texts(spark, tmp_path):
    """Lines, marks and stutters are reported for all rows, whichever rule rejects a text."""
    sf = written(spark, tmp_path, [(1, "few words!"), (2, None), (3, "so so so what?!\n\nis is it\nthis"), (4, "word " * 30)])
    got = {r["doc_id"]: (r["n_lines"], r["n_marks"], r["n_stutters"], r["base_failed"], r["kept"]) for r in queries.op1_quality_rules(spark, sf).collect()}
    assert got == {1: (1, 1, 0, True, False), 2: (0, 0, 0, True, False), 3: (3, 2, 3, True, False), 4: (1, 0, 29, True, False)}


def test_a_common_term_alone_is_not_compared(spark, monkeypatch):
    """Of texts that hold "mit" or single words of licences, only those that can be similar to a template become units."""
    compared = []

    def noted(df, label, *rest):
        out = stored(df, label, *rest)
        compared.extend(r["uid"] for r in out.select("uid").collect()) if label == "licence-units" else None
        return out

    monkeypatch.setattr(licences, "stored", noted)
    notice = "Released under the MIT License."
    texts = [f"haus mit garten {k}\n\nund mit dem hund {k}" for k in range(40)] + [f"the version {k} of it" for k in range(40)] + ["a mit b\n\n" + notice]
    files = [(k, f"{k}/a.txt", t) for k, t in enumerate(texts)]
    got = licences.scan(spark.createDataFrame(files, "doc_id bigint, path string, text string")).collect()
    assert [r["doc_id"] for r in got if r["licence"] == "MIT"] == [80] and sum(r["origin"] == "none" for r in got) == 80
    # the whole text, its leading comment (none), the paragraph and the line of the notice
    assert len(set(compared)) == 1 and len(compared) == 3


def test_terms_are_those_of_templates(spark):
    texts = ["a..b -c- d.e", "...", "", "É.xK-9 İ.", "--a.-.-b--\n.c", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(licences._terms(F.col("t")).alias("x")).collect()
    assert [r["x"] for r in got] == [["a..b", "c", "d.e"], [], [], ["xk-9", "i"], ["a.-.-b", "c"], None]


def test_a_worker_gets_few_texts_at_once(spark, monkeypatch):
    """No batch of whole texts is longer than ``BATCH_TEXTS``, and the session's own limit is as before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    limits, before = [], spark.conf.get(name)

    def noted(df, label, *rest):
        limits.append((label, int(spark.conf.get(name))))
        return stored(df, label, *rest)

    monkeypatch.setattr(packing, "stored", noted)
    docs = spark.createDataFrame([(k, "some words " * (k % 7)) for k in range(1200)], "doc_id bigint, text string")
    assert packing.pack(docs, queries.tokenizer_path()).count() == 1200
    assert 0 < dict(limits)["pieces"] <= 500 and spark.conf.get(name) == before


def test_parts_of_words_are_encoded_once(monkeypatch):
    """A word that comes with other marks or in other case later costs no further call of the library."""
    own, asked = tokens.WordEncoder(queries.tokenizer_path()), []
    library = own._call
    monkeypatch.setattr(own, "_call", lambda words: asked.extend(words) or library(words))
    texts = ["Garden, née! x1.", "garden. GARDEN: née; x1.", "(garden) née, née Garden?! x1,"]
    got = [ids.tolist() for t in texts for ids, _ in own.encode(*shingles.text_bytes(pa.array([t])))]
    assert got == [own.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) == len(set(asked)) and {b"garden", "née".encode()} <= set(asked) and not {b"garden.", "née;".encode()} & set(asked)


def test_encoder_looks_parts_of_words_up(monkeypatch):
    """Letters in any case, and the marks after them, are looked up apart from each other and once."""
    own, looked = tokens.WordEncoder(queries.tokenizer_path()), []
    found = own._ids_of
    monkeypatch.setattr(own, "_ids_of", lambda words: looked.extend(words) or found(words))
    texts = ["Garden, garden. GARDEN: ... x1. it's.", "", ".a b.", "İ. aİ, ÉCOLE; Straße! | a|", "z.,!?"]
    got = [f[a:z].tolist() for f, n in own.encode(*shingles.text_bytes(pa.array(texts))) for a, z in zip(n, n[1:])]
    assert got == [own.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(looked) == sorted(
        w.encode() for w in ["garden", ",", ".", ":", "...", "x1.", "it's.", ".a", "b", "İ.", "aİ,", "ÉCOLE;", "Straße!", "|", "a", "z", ".,!?"])
