"""Spelling variants, MinHash near duplicates and the Merkle manifest against plain versions, at their edges and in hot groups."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import forest, merkle, spelling
from tests.llm import brute
from tests.llm.test_edges import CLASH, SCHEMA, TEXTS, prose

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en" if (i or 0) % 3 else None, s, len(t or "")) for i, t, s in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def clash(docs):
    return docs.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASH.split(", ")])


def spelled(df, **options):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.spelling_variants(df, **options).collect()}


def misspelt(seed, n, length=(6, 9)):
    """Texts over a dense vocabulary: words, and the same words with a letter left out, put in or replaced, of very different counts."""
    r = random.Random(seed)
    base = ["".join(r.choice("abé") for _ in range(r.randint(*length))) for _ in range(n)]
    out = []
    for w in base:
        out += [w] * r.choice([5, 30, 200])
        for _ in range(4):
            at = r.randrange(len(w))
            v = r.choice([w[:at] + w[at + 1:], w[:at] + r.choice("abé") + w[at:], w[:at] + r.choice("abé") + w[at + 1:]])
            out += [v] * r.choice([1, 5, 6, 25])
    out += ["bababa"] * 900 + ["bababab"] * 100 + ["babababé"] * 12  # forms of forms
    r.shuffle(out)
    return [(k, " ".join(out[k::40])) for k in range(40)]


def test_variants_of_a_dense_vocabulary(spark):
    data = misspelt(1, 40)
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    want = brute.variants(data, 3)
    assert spelled(df, divisor=3) == want
    assert sum(w[0] is not None for w in want.values()) > 10 and any(w[0] not in (None, w[1]) for w in want.values())


@pytest.mark.parametrize("long", [4, 8])
def test_long_words_are_matched_as_in_the_trie(spark, long):
    """Wherever the levels end, the pairs are the same; runs of equal letters have one place to leave one out."""
    r = random.Random(2)
    words = {"".join(r.choice("ab") for _ in range(r.randint(3, 11))) for _ in range(120)} | {"a" * n for n in range(3, 14)}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    got = sorted(tuple(sorted(x)) for x in spelling.near_words(df, long).collect())
    assert got == sorted((a, b) for a in words for b in words if a < b and brute.near(a, b))


def test_variants_at_the_edges(spark, docs, clash):
    pairs = [(i, t) for i, t, _ in TEXTS]
    want = brute.variants(pairs, 5, 4, 3)
    assert spelled(clash, divisor=5, least_length=4, least_count=3) == want and len(want) > 3
    few = [(i, t) for i, t in pairs if i in (9, 11, 13, 14, 16, 17, 19)]
    some = docs.where("doc_id in (9, 11, 13, 14, 16, 17, 19)")
    assert spelled(some.unionByName(some), least_length=1, least_count=2) == brute.variants(few + few, least_length=1, least_count=2)
    assert spelled(docs.limit(0)) == spelled(docs.where("text is null or text = ''")) == {}
    assert spelling.spelling_variants(docs).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs, ratio=1)
    # a word in a third of all places, runs next to other scripts, letters that only Unicode would lower-case, very long runs
    odd = [(k, "Straße ÀÉÎ ÀÉÎõöø×÷ ΩmegaΩ İstanbul " + ("common " if k % 3 == 0 else "commun ") * 30 + "x" * 300 + " " + "y" * 299 + "z") for k in range(9)]
    df = spark.createDataFrame(odd, "doc_id bigint, text string")
    assert spelled(df) == brute.variants(odd)


def near(df, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in forest.near_duplicates(df, **options).collect()}


def family(seed, n, words=120, changed=0.04):
    """Copies of one text, each with its own few words replaced, some next to the bound."""
    r = random.Random(seed)
    base = prose(seed, words, lines=False).split()
    return [" ".join(r.choice("zyxwv") * 6 if r.random() < changed * r.choice([0.3, 1, 2, 3]) else w for w in base) for _ in range(n)]


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    """Families around the bound, in small regions and cells: the same components as comparing all pairs."""
    monkeypatch.setattr(forest, "REGION", 3)
    monkeypatch.setattr(forest, "BLOCK", 4)
    texts = [t for s in range(8) for t in family(100 + s, 8, changed=0.02)] + family(7, 40, changed=0.03) + [prose(k, 40) for k in range(20)]
    texts += ["one two", "one  two", "one two three", "two one", "", " ", None, "same"] + ["passage that all share " + prose(900 + k, 12) for k in range(30)]
    data = list(enumerate(texts))
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    want = brute.components(data, width=2)
    assert near(df) == want
    assert 20 < len({c for _, c in want.values()}) < len(texts) - 30


def test_near_duplicates_at_the_edges(spark, docs, clash):
    one = {i: t for i, t, _ in TEXTS if i is not None}
    want = brute.components(list(one.items()), width=2)
    got = forest.near_duplicates(clash).collect()
    assert len(got) == len(TEXTS) and {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    assert forest.near_duplicates(docs.limit(0)).count() == 0
    kept = forest.keep_one(clash)
    assert kept.columns == clash.columns
    assert kept.count() == sum(i is None or want[i][1] == i for i, *_ in TEXTS)
    # an id with two texts joins what is linked with either
    a, b = prose(31, 50), prose(32, 50)
    twice = spark.createDataFrame([(1, a), (5, a), (5, b), (3, b), (4, prose(33, 50))], "doc_id bigint, text string")
    assert {(r["doc_id"], r["component_id"]) for r in forest.near_duplicates(twice).collect()} == {(1, 1), (3, 1), (4, 4), (5, 1)}


def test_minima_do_not_depend_on_slices(monkeypatch):
    import numpy as np

    r = np.random.default_rng(1)
    sets = [r.integers(0, 2**64, n, dtype=np.uint64) for n in (1, 5000, 3, 1, 70_000, 2)]
    whole = forest.minima(sets)
    monkeypatch.setattr(forest, "SLICE", 1000)
    assert (forest.minima(sets) == whole).all()
    assert all((forest.minima([s])[0] == row).all() for s, row in zip(sets, whole))
    # the share of equal minima estimates the similarity
    a, b = sets[4][:60_000], sets[4][10_000:]
    equal = (forest.minima([a]) == forest.minima([b])).mean()
    assert abs(equal - 5 / 7) < 0.15


def checked(df, **options):
    out = merkle.verify(df, FIELDS, "lang", "doc_id", **options)
    return out, sorted(((int(r["id"]) if r["id"] is not None else None, r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in out.collect()), key=repr)


def tampered(r):
    if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 or r[3] is None:
        return r
    return *r[:3], r[3] + 1, r[4]


def claim():
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return {"n_chars": F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_at_every_depth(spark, monkeypatch, levels):
    """Whatever levels are stored, proofs and roots are those of the whole tree; groups of one to a few hundred leaves."""
    from pyspark import cloudpickle

    monkeypatch.setattr(merkle, "LEVELS", levels)
    cloudpickle.register_pickle_by_value(merkle)
    try:
        sizes = {None: 1, "": 2, "a": 3, "b": 17, "é": 16}
        data = [(1000 * k + n, f"s{n % 3}", lang, n, f"text {n}") for k, (lang, size) in enumerate(sizes.items()) for n in range(size)]
        df = spark.createDataFrame(data, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(6)
        out, got = checked(df, claims=claim())
        assert got == brute.manifest(data, tampered)
        assert {r["verified"] for r in out.collect()} == {True, False}
    finally:
        cloudpickle.unregister_pickle_by_value(merkle)


def test_manifest_at_the_edges(spark, docs, clash):
    data = [tuple(r) for r in docs.select(*FIELDS).collect()]
    for df in (docs, clash):
        assert checked(df, claims=claim())[1] == brute.manifest(data, tampered)
    out, got = checked(docs)
    assert got == brute.manifest(data, lambda r: r) and all(r["verified"] for r in out.collect())
    # repeated rows, a single row, no row
    assert checked(docs.unionByName(docs))[1] == brute.manifest(data * 2, lambda r: r)
    (one,) = checked(docs.where("doc_id = 1"))[0].collect()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof"] == [] and one["verified"]
    assert merkle.verify(docs.limit(0), FIELDS, "lang", "doc_id").count() == 0
    assert merkle.build(spark.createDataFrame([], "grp string, ord bigint, digest string, id string, claim string")).root is None


def test_a_proof_needs_no_more_than_itself(docs):
    """Folding leaf and proof gives the root; any other leaf or a changed sibling does not."""
    for r in checked(docs)[0].collect():
        assert merkle.fold(r["leaf"], r["proof"]) == r["root"] != merkle.fold(brute.digest("x"), r["proof"])
        for n, step in enumerate(r["proof"]):
            if step:
                assert merkle.fold(r["leaf"], [*r["proof"][:n], step[0] + brute.digest("x"), *r["proof"][n + 1:]]) != r["root"]
