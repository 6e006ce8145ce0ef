"""The document operators against SQL and plain Python versions over the smallest tables."""

import hashlib
import zlib

import duckdb
import pytest

from strata.llm import classifier, queries, registry, sharding
from tests.llm import brute

TABLES = ["documents", "labels", "benchmark", "pages"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return duck.sql("select doc_id, text, lang, source from documents").fetchall()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    assert got == sorted(duck.sql(f"select {', '.join(cols)} from ({registry.ORACLES[name]})").fetchall(), key=repr)


def test_licences(spark, sf, docs):
    got = {r["doc_id"]: r for r in queries.op3_licence_scan(spark, sf).collect()}
    assert len(got) == len(docs)
    notices = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    for doc_id, text, _, _ in docs:
        own = [name for line, name in notices.items() if line in (text or "").split("\n")]
        assert (got[doc_id]["origin"] == "notice") == bool(own)
        if own:
            assert got[doc_id]["licence"] in own


def test_licences_are_inherited(spark, sf):
    """Licence files give their licence to the documents of their directory and of those below it, and to no others."""
    got = queries.op3_licence_scan(spark, sf.replace("sf0.001", "sf0.01")).collect()
    own = {}
    for r in got:
        if r["origin"] == "notice" and "/LICENSE-" in r["path"]:
            own.setdefault(r["dir"], set()).add(r["licence"])
    heirs = [r for r in got if r["origin"] == "directory" and r["from_dir"] != r["dir"]]
    assert own and len(heirs) > 40
    assert all(r["from_dir"] in own and r["licence"] in own[r["from_dir"]] for r in heirs)
    # without a notice and without a licence file in its directory or the one above
    assert not any(r["origin"] == "none" and (r["dir"] in own or r["dir"].rsplit("/", 1)[0] in own) for r in got)


def test_token_counts(spark, sf, docs, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op4_token_counts(spark, sf).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()}
    counts = [len(i) for i in ids_of(library, [t for _, t, _, _ in docs])]
    assert got == {d: (len((t or "").encode()), n, n > 2048) for (d, t, _, _), n in zip(docs, counts)}


def test_repeats(spark, sf, docs):
    found = queries.op5_suffix_dedup(spark, sf).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found}
    assert got == dict(zip([d for d, *_ in docs], brute.remaining([t for _, t, _, _ in docs], 400)))
    # the spans are what is missing from the rest
    texts = {d: (t or "").encode() for d, t, _, _ in docs}
    for r in found:
        raw, edges = texts[r["doc_id"]], [0, *(e for span in r["removed"] for e in span), r["n_bytes"]]
        assert hashlib.sha256(b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2]))).hexdigest() == r["kept_sha256"]


def test_quality_is_learned(spark, sf, duck):
    larger = sf.replace("sf0.001", "sf0.01")
    labels = dict(duckdb.sql(f"select doc_id, quality from '{larger}/labels.parquet'").fetchall())
    rows = queries.op6_quality_classifier(spark, larger).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    tried = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in tried) > 0.97 * len(tried) > 60


def test_scores_equal_a_plain_discriminant(spark, sf, duck):
    """Moments summed over partitions and Cholesky factors give the scores of two Gaussians fitted at once."""
    labels = dict(duck.sql("select doc_id, quality from labels").fetchall())
    table = spark.read.parquet(f"{sf}/documents.parquet")
    x = {r["doc_id"]: r["x"] for r in classifier.document_vectors(table).collect()}
    train = [d for d in sorted(x) if d in labels and zlib.crc32(str(d).encode()) % 3 != 1]
    ids = sorted(x)
    want = dict(zip(ids, brute.discriminant([x[d] for d in train], [labels[d] for d in train], [x[d] for d in ids], classifier.SHRINKAGE)))
    for r in queries.op6_quality_classifier(spark, sf).collect():
        assert abs(r["score"] - want[r["doc_id"]]) < 1e-6


def test_packing(spark, sf, docs, library):
    ids = {d: i + [2] for (d, *_), i in zip(docs, ids_of(library, [t for _, t, _, _ in docs]))}
    assert brute.check_packing(queries.op8_packing(spark, sf).collect(), ids) < 0.1


def test_shards(spark, sf, docs):
    got = queries.op9_sharding(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(d for d, *_ in docs)
    assert {r["shard"] for r in got} <= set(queries.SHARDS)
    assert sorted(map(repr, got)) == sorted(map(repr, queries.op9_sharding(spark, sf).collect()))
    size = sharding.TABLE_SIZE
    few = [f"s{n}" for n in range(7)]
    assert [few[i] for i in sharding.lookup_table(few, 211)] == [o for _, o in sorted(brute.slot_owners(few, 211).items())]
    owner = [queries.SHARDS[i] for i in sharding.lookup_table(queries.SHARDS)]
    for r in got:
        slot = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16) % size
        assert (r["slot"], r["shard"]) == (slot, owner[slot])


def test_similar_groups(spark, sf, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op10_ngram_jaccard(spark, sf).collect()}
    assert got == brute.components([(d, t) for d, t, _, _ in docs])
