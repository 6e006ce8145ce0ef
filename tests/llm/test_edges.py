"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

import corpus_pipeline
from strata.llm import classifier, components, exact, jaccard, licences, mixing, packing, quality, sharding, shingles, suffix, tokens
from strata.llm.queries import tokenizer_path
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns of which every name is used inside some operator.
CLASH = "row string, size bigint, key string, digest string, content string, n bigint, k1 bigint, comp bigint, node bigint, slot int, path string, dir string, src string, block string, h string, x string, label bigint"


def prose(seed, n, lines=True):
    r = random.Random(seed)
    w = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(n)]
    return "".join(x + ("\n" if lines and k % 11 == 10 else " ") for k, x in enumerate(w)).strip()


LONG = prose(1, 30_000)
A, B = prose(2, 200), prose(3, 90)
TEXTS = [
    (1, A, "s1"), (2, A.upper(), "s1"), (3, A + " more words here", "s2"), (4, None, "s1"), (5, "", None), (6, " \n\t ", "s2"), (7, "one two", "s3"),
    (8, LONG, "s2"), (9, "one  two", None), (10, B, ""), (10, B, ""), (11, "É x É y " * 60, "é"), (12, "a " * 3000, "s1"),
    (13, "aaaa" * 500, "s1"), (14, "x" * 399 + "yz", "s1"), (15, A[:900] + B, "s9"), (16, "<|endoftext|> <|startoftext|>x don't 42", "s1"),
    (17, "word " * 19, "s1"), (18, LONG[:5000], "s2"), (None, B, None), (None, "lonely text without an id", "s1"), (19, "ΑΣ ΑΣΣ İI ǅ", "s1"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def clash(spark, docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASH.split(", ")])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def weights(sizes):
    return mixing.cyclic_weights(sizes, [3, 1, 2])


def test_quality(spark, docs, clash, empty):
    want = sorted((i, brute.kept(t)) for i, t, _ in TEXTS if i is not None)
    assert sorted(tuple(r) for r in quality.assess(clash).where("doc_id is not null").select("doc_id", "kept").collect()) == want
    good = quality.keep_good(clash)
    assert good.columns == clash.columns and good.count() == sum(brute.kept(t) for _, t, _ in TEXTS)
    assert quality.assess(empty).count() == quality.keep_good(empty).count() == 0
    # whatever order the rules have, the verdict is the same
    for order in (quality.RULES, quality.RULES[::-1]):
        from pyspark.sql import functions as F

        named = docs.select("text", quality.cascade(order, quality.from_text(F.col("text"))).alias("failed")).collect()
        assert [r["failed"] is None for r in named] == [brute.kept(r["text"]) for r in named]


def test_mixing(spark, docs, clash, empty):
    want = brute.mixed([(i, s, t) for i, t, s in TEXTS])
    got = mixing.mix(clash, weights).select("row.doc_id", "row.text", "row.source", "copies").collect()
    assert sorted(map(repr, [tuple(r) for r in got])) == sorted(repr((i, t, s, want[k])) for k, (i, t, s) in enumerate(TEXTS))
    again = mixing.mixed_documents(clash, weights)
    assert again.columns == clash.columns and again.count() == sum(want.values())
    assert rows(mixing.mixed_documents(docs, weights)) == rows(mixing.mixed_documents(docs.repartition(3), weights))
    assert mixing.mixed_documents(empty, weights).count() == 0
    assert mixing.mix(docs.where("text is null or source = 's3' and text = ''"), weights).where("copies > 0").count() == 0


def test_cut_is_found_in_any_number_of_steps(spark, docs, monkeypatch):
    want = rows(mixing.mixed_documents(docs, weights))
    monkeypatch.setattr(mixing, "EXACT_ROWS", 2)
    monkeypatch.setattr(mixing, "RANGES", 2)
    assert rows(mixing.mixed_documents(docs, weights)) == want


def test_licences(spark, empty):
    notice = "Released under the MIT License."
    files = [(1, "a/LICENSE", notice, "x"), (2, "a/b/c.txt", "some text", "x"), (3, "a/b/d/e.txt", None, "x"), (4, "z.txt", prose(4, 400), "x"),
             (5, "a/b/d/COPYING", "words\nLicensed under the Apache License, Version 2.0.\nwords", "x"), (6, None, notice, "x"), (7, None, "", "x"),
             (8, "a/b/d/f/g.txt", prose(5, 50) + "\n" + notice, "x"), (8, "a/b/d/f/g.txt", prose(5, 50) + "\n" + notice, "x"), (9, "q/r.txt", notice, "x")]
    files += [(1000 + k, f"other/{k}.txt", prose(400 + k, 30), "x") for k in range(200)]
    df = spark.createDataFrame(files, "doc_id bigint, path string, text string, licence string")
    everything = licences.scan(df).collect()
    assert len(everything) == len(files) and all(r["origin"] == "none" for r in everything if r["doc_id"] >= 1000)
    got = sorted((r["doc_id"], r["licence"], r["origin"], r["from_dir"]) for r in everything if r["doc_id"] < 1000)
    assert got == [
        (1, "MIT", "notice", None), (2, "MIT", "directory", "a"), (3, "Apache-2.0", "directory", "a/b/d"), (4, None, "none", None),
        (5, "Apache-2.0", "notice", None), (6, "MIT", "notice", None), (7, None, "none", None), (8, "MIT", "notice", None), (8, "MIT", "notice", None),
        (9, "MIT", "notice", None)]
    assert licences.scan(df.limit(0)).count() == 0


def test_common_notices(spark):
    """A notice that a third of all rows hold, and a table of three rows, are found like rare ones."""
    notice = "Released under the MIT License."
    files = [(k, "a.txt", prose(700 + k, 30) + ("\n" + notice if k % 3 == 0 else "\nthe end of it")) for k in range(60)]
    for some in (files, files[:3]):
        got = licences.scan(spark.createDataFrame(some, "doc_id bigint, path string, text string")).collect()
        assert {r["doc_id"]: r["licence"] for r in got} == {k: "MIT" if k % 3 == 0 else None for k, *_ in some}


def test_licence_files_and_headers(spark):
    """Full texts, wrapped headers and titles; directories inherit from licence texts; likenesses of a name alone are none."""
    known = {x.licence: x.text for x in licences.all_templates() if x.licence in licences.FULL_TEXTS}
    files = [(k, f"{n}/LICENSE", t.replace("(c)", "(c) 2021 Jo Doe"), n) for k, (n, t) in enumerate(sorted(known.items()))]
    files += [(100 + k, f"{n}/src/a.txt", prose(k, 40), n) for k, n in enumerate(sorted(known))]
    wrap = lambda x: "\n".join("# " + " ".join(x.split()[i:i + 11]) for i in range(0, len(x.split()), 11))
    heads = [x for x in licences.HEADERS if len(x.text) > 150]
    files += [(200 + k, None, "#!/bin/sh\n# Copyright 2020 Jo Doe\n#\n" + wrap(x.text) + "\n\n" + prose(k, 300), x.licence) for k, x in enumerate(heads)]
    lines = {"The MIT License (MIT)": "MIT", "Apache License": "Apache-2.0", "Mozilla Public License Version 2.0": "MPL-2.0", "License": None, "mit": None,
             "Licensed under the MIT license. See LICENSE file in the project root for full license information.": "MIT", "The license": None}
    files += [(300 + k, None, prose(k, 50) + "\n" + x + "\n" + prose(k, 50), n) for k, (x, n) in enumerate(lines.items())]
    files += [(1000 + k, None, prose(800 + k, 40), None) for k in range(100)]
    got = licences.scan(spark.createDataFrame(files, "doc_id bigint, path string, text string, want string")).collect()
    assert {r["doc_id"]: r["licence"] for r in got} == {i: n for i, _, _, n in files}
    assert {r["origin"] for r in got if 100 <= r["doc_id"] < 200} == {"directory"}


def test_tokens_and_cache(spark, docs, clash, empty, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    want = sorted((repr(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in TEXTS)
    cache = str(tmp_path / "cache")
    for df in (clash, docs):
        got = tokens.token_counts(df, tokenizer_path(), cache).collect()
        assert sorted((repr(r[0]), *r[1:]) for r in got) == want
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("content").distinct().count()  # the second run encodes nothing
    assert tokens.token_counts(empty, tokenizer_path()).count() == 0


def test_word_encoder_bounds_its_memo(monkeypatch):
    from tokenizers import Tokenizer

    import pyarrow as pa

    monkeypatch.setattr(tokens, "MEMO_WORDS", 5)
    library, own = Tokenizer.from_file(tokenizer_path()), tokens.WordEncoder(tokenizer_path())
    texts = [t for _, t, _ in TEXTS] + ["It's. It'S' ABC, x1. ...abc ''d's (a) e\u0301.", "\u00a0 \x1c\u2003z.", "", "Abc abc. ABC.,"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for most in (2_000_000, 100):
        monkeypatch.setattr(tokens, "runs_of_texts", lambda o, n=most: shingles.runs_of_texts(o, n))
        got = [ids[a:z].tolist() for ids, before in own.encode(*shingles.text_bytes(pa.array(texts))) for a, z in zip(before, before[1:])]
        assert got == want
    # equal hashes of different words change nothing
    monkeypatch.setattr(tokens, "span_hashes", lambda b, begins, ends: (ends - begins).astype(np.uint64))
    got = [ids[a:z].tolist() for ids, before in own.encode(*shingles.text_bytes(pa.array(texts))) for a, z in zip(before, before[1:])]
    assert got == want


@pytest.mark.parametrize("size", [1 << 20, 300, 1])
def test_repeats(spark, docs, clash, empty, monkeypatch, size):
    """With blocks that hold all pieces, few or none, so that ranges are divided again."""
    monkeypatch.setattr(suffix, "BLOCK_BYTES", size)
    for need, gram in ((400, 128), (40, 11)):
        want = sorted(map(repr, zip([i for i, *_ in TEXTS], brute.remaining([t for _, t, _ in TEXTS], need))))
        got = suffix.remove_repeats(clash, need, gram, with_text=True).collect()
        assert sorted(repr((r["doc_id"], tuple(r)[1:5])) for r in got) == want
        for r in got:
            assert hashlib.sha256(r["kept_bytes"]).hexdigest() == r["kept_sha256"]
            assert sum(b - a for a, b in r["removed"]) == r["n_removed"] and len(r["removed"]) == r["n_spans"]
    assert suffix.remove_repeats(empty).count() == 0


def test_ranges_cover_all_starts():
    for starts in (1, 2, 7, 30, 273):
        steps = suffix.range_steps(starts)
        assert steps[-1] == 1 and all(a % b == 0 for a, b in zip([starts, *steps], steps))


def test_run_length_index():
    r = random.Random(5)
    t = np.frombuffer(("".join(r.choice("ab") for _ in range(300)) * 3 + "abc").encode() + bytes([suffix.SEPARATOR]), np.uint8)
    order = suffix.suffix_array(t)
    raw = t.tobytes()
    assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))
    index = suffix.RunLengthIndex.build(t, order, np.array([0]))
    assert len(index.symbols) < len(t) / 2
    lcp = [0] + [next(k for k in range(len(raw)) if raw[a + k:a + k + 1] != raw[b + k:b + k + 1]) for a, b in zip(order, order[1:])]
    assert index.matching_statistics()[order].tolist() == lcp


def test_classifier(spark, docs, clash, empty):
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(1, 20)] * 2 + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    got = classifier.score_quality(clash, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    by_text = {}
    for r in classifier.score_quality(docs, labels).collect():
        by_text.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by_text[10]) == 1 and by_text[5] == by_text[4]
    assert {r["score"] for r in classifier.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert classifier.score_quality(empty, labels).count() == 0


def test_exact(spark, docs, clash, empty):
    index = exact.fresh_index()
    got = exact.dedupe_batch(clash, index)
    lower = [((t or "").translate(brute.ASCII), i) for i, t, _ in TEXTS]
    groups = {}
    for t, i in lower:
        groups.setdefault(t, []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = sorted(repr((i, keep[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest())) for t, i in lower)
    assert sorted(repr((r["doc_id"], r["keep_id"], r["group_size"], bytes(r["digest"]).hex())) for r in got.collect()) == want
    assert got.where("kept").count() == len(groups)
    assert got.where("kept and not doc_id <=> keep_id").count() == 0
    # a later batch meets the index: old texts go, new ones stay and are added
    more = spark.createDataFrame([(100, A, "en", "s", 1), (101, "new text", "en", "s", 1), (102, "NEW text", "en", "s", 1)], SCHEMA)
    again = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact.dedupe_batch(more, index).collect()}
    assert again == {100: (2, False), 101: (102, False), 102: (102, True)}
    assert spark.table(index).count() == len(groups) + 1
    kept = exact.drop_copies(clash, exact.fresh_index())
    assert kept.columns == clash.columns and kept.count() == len(groups)
    assert exact.drop_copies(empty, exact.fresh_index()).count() == exact.dedupe_batch(empty, exact.fresh_index()).count() == 0


def test_packing(spark, docs, clash, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    some = [(i, t) for i, t, _ in dict((x[0], x) for x in TEXTS if x[0] is not None).values()]
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in some}
    single = clash.where("doc_id is not null").dropDuplicates(["doc_id"])
    for size in (4096, 64):
        brute.check_packing(packing.pack(single, tokenizer_path(), size).collect(), ids, size)
    pieces = packing.pack(docs, tokenizer_path()).collect()
    assert sum(r["start"] == 0 for r in pieces) == len(TEXTS)
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces)
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_patterns_use_every_length():
    r = random.Random(3)
    for size in (1, 7, 100):
        for _ in range(20):
            histogram = {n: r.randint(1, 50) for n in r.sample(range(1, size + 1), r.randint(1, size))}
            found = {}
            for lengths, count in packing.pack_lengths(dict(histogram), size):
                assert sum(lengths) <= size and count > 0
                for n in lengths:
                    found[n] = found.get(n, 0) + count
            assert found == histogram
    assert packing.pack_lengths({}, 9) == []


def test_sharding(spark, docs, clash, empty):
    names = [f"n{k}" for k in range(7)]
    table = sharding.lookup_table(names, 101)
    counts = [table.count(k) for k in range(7)]
    assert set(table) == set(range(7)) and max(counts) - min(counts) <= 1
    # with one shard less, most slots of the others stay
    less = sharding.lookup_table(names[:-1], 101)
    assert sum(a == b for a, b in zip(table, less) if a != 6) > 60
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 101)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)
    for key in ("doc_id", "source"):
        got = sharding.assign_shards(clash, names, key, 101)
        placed = {}
        for r in got.select(f"row.{key}", "slot", "shard").collect():
            text = "" if r[0] is None else str(r[0])
            slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 101
            assert (r["slot"], r["shard"]) == (slot, names[table[slot]])
            placed.setdefault(r[0], set()).add(r["shard"])
        assert all(len(s) == 1 for s in placed.values()) and got.count() == len(TEXTS)
    assert sharding.assign_shards(empty, names).count() == 0


def test_groups(spark, docs, clash, empty, monkeypatch):
    some = [(i, t) for i, t, _ in dict((x[0], x) for x in TEXTS if x[0] is not None).values()]
    want = brute.components(some)
    for _ in range(2):
        got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar_groups(clash.where("doc_id is not null")).collect()}
        assert got == {(i, n, c) for i, (n, c) in want.items()}
        # every shingle frequent, tiny blocks
        monkeypatch.setattr(jaccard, "FREQUENT_COUNT", 0)
        monkeypatch.setattr(jaccard, "COUNT_LEAST", 1)
        monkeypatch.setattr(jaccard, "BLOCK", 2)
    assert [r["component_id"] for r in jaccard.similar_groups(docs.where("doc_id is null")).collect()] == [None, None]
    one = jaccard.keep_one(clash)
    assert one.columns == clash.columns
    assert sorted(r["doc_id"] for r in one.where("doc_id is not null").collect()) == sorted(i for i, *_ in TEXTS if i is not None and want[i][1] == i)
    assert jaccard.keep_one(empty).count() == jaccard.similar_groups(empty).count() == 0


def test_groups_near_the_bound(spark, monkeypatch):
    """Chains and crowds of texts on both sides of the bound, compared in tiles of several blocks."""
    r = random.Random(11)
    base = prose(20, 60, False).split()
    texts = []
    for k in range(90):
        w = list(base if k % 3 else base[:45] + prose(21, 15, False).split())
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"edit{r.randrange(9)}"
        texts.append((k, " ".join(w)))
    texts += [(200 + k, " ".join(base[:20]) + " " + prose(100 + k, r.randint(10, 60), False)) for k in range(40)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    want = brute.components(texts)
    for block in (2_000, 7):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        for miss in (1e-18, 0.0):
            assert {r[0]: (r[1], r[2]) for r in jaccard.similar_groups(df, miss=miss).collect()} == want


def test_token_counts_sends_few_texts_at_once(spark, monkeypatch):
    """Each text gets the number of texts that came with it instead of its tokens."""
    def counter(path):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column("content"), pa.array([len(b)] * len(b), pa.int64())], ["content", "n_tokens"])

        return run

    monkeypatch.setattr(tokens, "_counter", counter)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    df = spark.createDataFrame([(k, f"text {k}") for k in range(9_000)], "doc_id bigint, text string")
    got = tokens.token_counts(df, tokenizer_path()).collect()
    assert len(got) == 9_000 and max(r["n_tokens"] for r in got) <= 500
    assert spark.conf.get(size) == before


def test_groups_of_a_crowd_below_the_bound(spark, monkeypatch):
    """Texts whose bitmaps allow a link to nearly all others, and that link to few: what is compared grows with the texts, not their square."""
    base = prose(70, 92, False).split()
    # one edit each, at the same place in every group: 83 of 93 shingles shared within a group, 78 of 98 between groups
    texts = [(k, " ".join([*base[:at], f"edit{k}", *base[at + 1:]])) for k in range(136) for at in [4 + 5 * (k % 17)]]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    made, links = {}, []
    plain, components = jaccard.stored, jaccard.connected_components

    def counted(rows, label, *more):
        out = plain(rows, label, *more)
        made[label] = max(made.get(label, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    monkeypatch.setattr(jaccard, "connected_components", lambda edges: links.append(edges.count()) or components(edges))
    want = brute.components(texts)
    assert len({c for _, c in want.values()}) == 17
    for shingles in (1_000_000, 2_000):
        monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", shingles, raising=False)
        assert {r[0]: (r[1], r[2]) for r in jaccard.similar_groups(df).collect()} == want
        assert made["possible-pairs"] <= 10 * len(texts) and max(links) <= 10 * len(texts)


def test_joining_links():
    r = np.random.default_rng(5)
    for percent in (20, 80):
        core = r.integers(0, 1 << 62, 40).astype(np.uint64)
        sets = [np.unique(np.concatenate([core[:r.integers(20, 41)], r.integers(0, 1 << 62, r.integers(0, 9)).astype(np.uint64)])) for _ in range(60)]
        comp = np.where(np.arange(60) < 9, 0, np.arange(60))
        pairs = [(x, y) for x in range(60) for y in range(x) if jaccard.linked(len(sets[x]), len(sets[y]), len(np.intersect1d(sets[x], sets[y])), percent)]
        found = jaccard.joining_links(comp, sets, percent)
        assert {(max(p), min(p)) for p in found} <= set(pairs) and len(found) < len(np.unique(comp))

        def labels(edges):
            now = comp.copy()
            for x, y in edges:
                now[now == now[x]] = now[y]
            return [int(np.flatnonzero(now == c)[0]) for c in now]

        assert labels(found) == labels(pairs)


def test_groups_of_repeated_rows(spark):
    """Every row twice, and one id with texts of very different lengths.

    Texts of smaller ids each hold a few of a group's words, so that hardly any shingle's first text is similar to the group's
    and only the tiles, most of them with equally many members, can link it.
    """
    texts = []
    for g in range(10):
        base = prose(60 + g, 60, False).split()
        for k in range(70):
            at = k % 14 * 4
            texts.append((100 * g + k, " ".join(base[at:at + 8]) + " " + prose(1000 + 100 * g + k, 52, False)))
        texts += [(2000 + 10 * g, " ".join(base)), (2001 + 10 * g, " ".join([*base[:-1], "other"]))]
    want = {i: c for i, (_, c) in brute.components(texts, 20).items()}
    assert all(want[2001 + 10 * g] == 2000 + 10 * g for g in range(10))
    short, long = prose(50, 40, False), prose(51, 900, False)
    texts += [(5001, short), (5001, long), (5002, short + " more"), (5003, long + " more"), (5004, prose(52, 50))]
    want |= {5001: 5001, 5002: 5001, 5003: 5001, 5004: 5004}
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = jaccard.similar_groups(df.union(df), 20, miss=0.0).collect()
    assert len(got) == 2 * len(texts) and {r["doc_id"]: r["component_id"] for r in got} == want


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 150), (150, 120), (7, 7), (200, 200)]
    df = spark.createDataFrame(chain + chain[:5], "a bigint, b bigint")
    got = {r["node"]: r["comp"] for r in components.connected_components(df).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 150: 100, 120: 100}
    assert components.connected_components(df.limit(0)).count() == 0


def test_shingles_over_slices(monkeypatch):
    import pyarrow as pa

    column = pa.array([t for _, t, _ in TEXTS])
    monkeypatch.setattr(shingles, "SLICE_BYTES", 100)
    for part in (column, column[3:9]):
        sets = list(shingles.shingle_sets(*shingles.text_bytes(part)))
        texts = part.to_pylist()
        assert [len(s) for s in sets] == [len(brute.shingles(t)) for t in texts]
        for a, s in zip(texts, sets):
            for b, q in zip(texts, sets):
                assert len(np.intersect1d(s, q)) == len(brute.shingles(a) & brute.shingles(b))


def test_pipeline(spark, tmp_path):
    """Against a plain version of every stage."""
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    texts = [(k, prose(300 + k, 60 + k), f"s{k % 3}") for k in range(12)]
    texts += [(20, texts[0][1].upper(), "s1"), (21, texts[1][1] + " one more", "s2"), (22, "junk ### " * 40, "s0"), (23, None, "s0"), (24, texts[5][1], None)]
    rows_ = [(i, t, "en", s, len(t or "")) for i, t, s in texts]
    spark.createDataFrame(rows_, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    good = [x for x in texts if brute.kept(x[1])]
    lower = {}
    for i, t, s in good:
        lower.setdefault(t.translate(brute.ASCII), []).append((i, t, s))
    once = [max(g) for g in lower.values()]
    comp = brute.components([(i, t) for i, t, _ in once])
    apart = [x for x in once if comp[x[0]][1] == x[0]]
    taken = brute.mixed([(i, s, t) for i, t, s in apart])
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages = [good, once, apart, [x for k, x in enumerate(apart) for _ in range(taken[k])]]
    for (_, stage), want in zip(corpus_pipeline.STAGES, stages):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(repr((r["doc_id"], r["text"], r["source"])) for r in docs.collect()) == sorted(map(repr, want))
    library = Tokenizer.from_file(tokenizer_path())
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    total = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in stages[-1])
    assert sum(r["length"] for r in pieces) == total
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces)
    docs.where(F.lit(False)).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
