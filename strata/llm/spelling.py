"""Spelling variants: frequent words one edit apart, found by walking a trie of all words level by level.

The trie is a table of nodes (prefix, letters that follow, whether it is a word), stored by depth: its edges. A state
(a, b, ban) of the frontier says that the word prefix ``a`` has been matched with the node ``b``, one edit already spent; words
that share a prefix, and so a position, share their states until they part. States without an edit need no
rows: they pair every node with itself. At each level

* states are joined with the letters of both their nodes and go on by every letter that both have;
* where both are words, the two are one edit apart;
* new states spend the edit at every node of the level: two of its letters against each other (a replaced code
  point), or one of its letters against none (an inserted one, seen from the longer word a deleted one). Of an insertion
  into a run of equal letters only the last place counts (``ban`` is the letter that may not come next), so no pair of prefixes
  comes up twice and no level needs to be made distinct.

A node has no more letters than the alphabet, so neither joins nor states grow with the square of anything else. The levels end
at LONG code points; each further one would cost a round for ever fewer words. Longer words are matched exactly by
hashes of the word with each code point left out, which are verified letter by letter.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

# Words are runs of these letters.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
ASCII_RUN = re.compile(b"[A-Za-z]+")
# Code points up to which words are in the trie; words of this length and more are (also) matched by hashes.
LONG = 48
# Words counted in a task before they are passed on: so many distinct ones, or so many bytes of them.
COUNT_WORDS, COUNT_BYTES = 200_000, 8_000_000
# Texts above so many bytes are searched run by run instead of in one list.
LONG_TEXT = 1_000_000


def runs_of(text: bytes) -> Iterator[bytes]:
    """Maximal runs of letters as UTF-8, A-Z lower-cased. Bytes that are no UTF-8 are no letters."""
    lower = text.lower()  # of bytes: A-Z alone
    if lower.isascii():
        found = (m[0] for m in ASCII_RUN.finditer(lower)) if len(lower) > LONG_TEXT else ASCII_RUN.findall(lower)
        return iter(found)
    return (m[0].encode() for m in RUN.finditer(lower.decode(errors="replace")))


def less_one(run: bytes, h: int) -> bytes:
    """The run without its code point h % length."""
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def _counter(divisor: int):
    """(word, n) of every task, counted in parts; repeated words are summed later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = Counter(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column("id"), batch.column("text")):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
                for word, n in Counter(runs_of(text.as_py())).items():
                    if divisor and (h := zlib.crc32(word, start)) % divisor == 0:
                        word = less_one(word, h)
                    before = total.get(word)
                    if before is None:
                        size += len(word)
                        total[word] = n
                    else:
                        total[word] = before + n
                if len(total) > COUNT_WORDS or size > COUNT_BYTES:
                    yield _counts(total)
                    total, size = Counter(), 0
        yield _counts(total)

    return run


def _counts(total: Counter) -> pa.RecordBatch:
    words = pa.array([w.decode() for w in total], pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], ["word", "n"])


def word_counts(docs: DataFrame, id_col: str, text_col: str, divisor: int = 0) -> DataFrame:
    """(word, n) over all texts; with ``divisor`` a word loses a code point in the documents whose checksum it divides."""
    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return texts.mapInArrow(_counter(divisor), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def trie(words: DataFrame) -> DataFrame:
    """Nodes (depth, node, letters, is_word) of the words (word); the letters that follow a node are its edges."""
    at = F.explode(F.sequence(F.lit(0), F.length("word"))).alias("depth")
    steps = words.select("word", at).select("depth", F.expr("substring(word, 1, depth)").alias("node"), F.expr("substring(word, depth + 1, 1)").alias("letter"))
    return steps.groupBy("depth", "node").agg(
        F.array_remove(F.collect_set("letter"), "").alias("letters"), F.max(F.col("letter") == "").alias("is_word"))


def _new_states(nodes: DataFrame, depth: int) -> DataFrame:
    """States of this depth that spend their edit on the last step: two letters of a node, or one letter against none."""
    of = lambda body: F.flatten(F.transform("letters", body))
    two = of(lambda x: F.transform(F.filter("letters", lambda y: y > x), lambda y: F.struct(x.alias("x"), y.alias("y"))))
    replaced = nodes.where(F.col("depth") == depth - 1).select("node", F.explode(two).alias("s")).select(
        F.concat("node", "s.x").alias("a"), F.concat("node", "s.y").alias("b"), F.lit("").alias("ban"))
    inserted = nodes.where(F.col("depth") == depth).select("node", F.explode("letters").alias("x")).select(
        F.col("node").alias("a"), F.concat("node", "x").alias("b"), F.col("x").alias("ban"))
    return replaced.unionByName(inserted)


def frontier_pairs(nodes: DataFrame) -> DataFrame:
    """All pairs (a, b) of words one edit apart, each once; ``nodes`` is the stored trie."""
    deepest = nodes.agg(F.max("depth")).first()[0]
    spark, found = nodes.sparkSession, []
    states = None
    for depth in range(0, (deepest or 0) + 1):
        more = _new_states(nodes, depth)
        states = more if states is None else states.unionByName(more)
        near = nodes.where(F.col("depth").between(depth, depth + 1))
        a = near.select(F.col("node").alias("a"), F.col("letters").alias("letters_a"), F.col("is_word").alias("word_a"))
        b = near.select(F.col("node").alias("b"), F.col("letters").alias("letters_b"), F.col("is_word").alias("word_b"))
        both = F.filter(F.array_intersect("letters_a", "letters_b"), lambda x: x != F.col("ban")).alias("letters")
        met = states.join(a, "a").join(b, "b").select("a", "b", both, (F.col("word_a") & F.col("word_b")).alias("words"))
        level = stored(met.where("words or size(letters) > 0"), "trie-frontier")
        found.append(level.where("words").select("a", "b"))
        states = level.select("a", "b", F.explode("letters").alias("x")).select(
            F.concat("a", "x").alias("a"), F.concat("b", "x").alias("b"), F.lit("").alias("ban"))
    out = found[0] if found else spark.createDataFrame([], "a string, b string")
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of a long word: its own hash (place -1), and that of the word without each code point.

    ``last`` marks the last place of a run of equal letters, and the word itself: leaving out another letter of the run gives the same word.
    """
    for batch in batches:
        for word in batch.column("word").to_pylist():
            raw = word.encode("utf-32-le")
            head = hashlib.blake2b(digest_size=16)
            rows = [(hashlib.blake2b(raw, digest_size=16).digest(), -1, True)]
            for i in range(len(word)):
                rest = head.copy()
                rest.update(raw[4 * i + 4:])
                rows.append((rest.digest(), i, word[i:i + 1] != word[i + 1:i + 2]))
                head.update(raw[4 * i:4 * i + 4])
            keys, places, last = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(places, pa.int32()), pa.array(last), pa.array([word] * len(rows))], ["key", "place", "last", "word"])


def long_pairs(words: DataFrame) -> DataFrame:
    """Pairs (a, b) of words one edit apart among long words, by equal keys; as many rows as code points.

    Words that differ in one place are equal without it; a word is equal to a longer one without one of its letters.
    A key meets no more words than the alphabet has letters.
    """
    keys = stored(words.mapInArrow(_left_out, "key binary, place int, last boolean, word string"), "long-keys")
    a, b = (keys.select("key", "place", "last", F.col("word").alias(name)) for name in ("a", "b"))
    replaced = a.where("place >= 0").drop("last").join(b.drop("last"), ["key", "place"]).where("a < b")
    longer = a.where("place = -1").select("key", "a").join(b.where("place >= 0 and last").select("key", "b"), "key")
    pairs = replaced.select("a", "b").unionByName(longer.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    return pairs.distinct().where(F.levenshtein("a", "b", 1) == 1)


def near_words(words: DataFrame, long: int = LONG) -> DataFrame:
    """All pairs (a, b) of the distinct words (word) that differ by exactly one inserted, deleted or replaced code point, each once."""
    nodes = words.where(F.length("word") <= long)
    path = stored(trie(nodes).repartition("depth", "node"), "trie")
    pairs = frontier_pairs(path)
    tail = stored(words.where(F.length("word") >= long), "long-words")
    if tail.isEmpty():
        return pairs
    # two words of just this length are found by both
    both = (F.length("a") <= long) & (F.length("b") <= long)
    return pairs.unionByName(long_pairs(tail).where(~both).select("a", "b"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that following ``form`` leads to. Every step at least multiplies a count, so the paths are short; each round halves them."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = stored(at.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5,
                      ratio: int = 5, divisor: int = 0, long: int = LONG) -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word of the texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least ``least_length`` code points and
    ``least_count`` occurrences (n) in all texts. A word's form is the word of the largest n among those one edit away, the
    smallest in code-point order of several, if it occurs at least ``ratio`` times as often (``ratio`` is 2 or more, so
    forms never lead back); its root is where forms end. With ``divisor`` a word loses the code point h % length in
    documents where ``divisor`` divides h, the unsigned crc32 of ``<id>:<word>``: made-up misspellings to test with.

    Null and empty texts have no words; repeated rows and ids count each time; a null id is an empty text in
    the checksum. A table without frequent words has no rows. Only the two columns are read.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    frequent = word_counts(docs, id_col, text_col, divisor).where((F.length("word") >= least_length) & (F.col("n") >= least_count))
    counts = stored(frequent, "word-counts")
    pairs = stored(near_words(counts.select("word"), long), "near-words")
    both = pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select(F.col("p.a").alias("word"), F.col("p.b").alias("other"))
    sized = both.join(counts.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    # the largest n, then the smallest word: the least of (-n, word)
    best = sized.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    joined = counts.join(best, "word", "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    rated = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(enough, F.col("best.other")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "spelling")
    last = roots(rated.where("form is not null").select("word", "form"))
    return rated.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
