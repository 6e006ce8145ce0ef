"""Token counts with a digest cache, and the word-wise encoder that counting and packing share."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import SPACES, stored
from strata.llm.shingles import runs_of_texts, span_hashes, text_bytes, word_spans
from strata.session import session_conf, shared_dir

CACHE = "content binary, tokenizer string, n_tokens bigint"
# Whole texts that are sent to a Python worker at once; executor and worker each hold as many.
BATCH_TEXTS = 500
# Words, or parts of words, whose ids a Python worker remembers; later ones are encoded each time they come.
MEMO_WORDS = 400_000
# Marks that end a word. No apostrophe, as letters and an apostrophe may belong together.
MARKS = b".,;:!?()#*$%&|"
_IS_MARK = np.isin(np.arange(256), list(MARKS))
# New words that are joined for a call.
CALL_WORDS = 512


class WordEncoder:
    """Ids of whole texts for a tokenizer that never joins text across white space, word by word.

    The tokenizer must drop white space and split at it (checked on examples when it is made), so
    the ids of a text are the ids of its words in turn. Texts are UTF-8 bytes; words are cut at space and the
    control characters 9 to 13. What else counts as white space stays inside a word and
    is left to the tokenizer. Where the tokenizer folds case and encodes marks after letters apart (checked too), a word of
    letters A-Z counts as two parts, the lower-cased letters and the marks after them. Ids, as little-endian 32-bit
    numbers, of parts seen before come from a bounded memo; new ones are joined by spaces and encoded by the
    library in one call, and the offsets tell which ids belong to which.
    """

    _own: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        apart = [self._ids(w) for w in ("a", "Bc,", "d's", "é!")]
        if self._ids(" a\tBc,\n\n d's  é! ") != sum(apart, []):
            raise ValueError(f"{path} does not treat the words of a text one by one")
        # whether case makes no difference and marks after letters are encoded apart from them
        self.folds = all(self._ids(w) == self._ids(core) + self._ids(marks) for w, core, marks in (
            ("Word", "word", ""), ("ABCs.", "abcs", "."), ("tHen,;", "then", ",;"), ("is!?", "is", "!?"), ("a)", "a", ")"),
            ("n\u00e9e,", "n\u00e9e", ","), ("\u00c4.", "\u00c4", "."), ("\u03b1\u03a3#", "\u03b1\u03a3", "#")))
        self.memo: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One encoder for each Python worker, kept from task to task."""
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word; new ones are encoded, and remembered while there is room."""
        ids = list(map(self.memo.get, words))
        new = {w for w, i in zip(words, ids) if i is None}
        if new:
            found = self._encode(new)
            ids = [found[w] if i is None else i for w, i in zip(words, ids)]
            if len(self.memo) < MEMO_WORDS:
                self.memo.update(found)
        return ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of the texts that lie between the offsets, for some texts at a time: all ids, and the number of ids before each text.

        Equal parts are found by their hashes, and compared byte by byte with the first of them, so each
        distinct part is looked up once; ids are put together by array operations.
        """
        for first, last in runs_of_texts(offsets):
            b, inner = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
            begins, ends, bounds = word_spans(b, inner)
            if self.folds:
                b, begins, ends = _parts(b, begins, ends)
                bounds = np.searchsorted(begins, inner)
            _, example, kind = np.unique(span_hashes(b, begins, ends), return_index=True, return_inverse=True)
            size = ends - begins
            if not (np.array_equal(size, size[example][kind]) and _same_bytes(b, begins, begins[example][kind], size)):
                example = kind = np.arange(len(begins))  # two parts with one hash: look every part up
            raw = b.tobytes()
            ids = self._ids_of([raw[x:y] for x, y in zip(begins[example].tolist(), ends[example].tolist())])
            flat = np.frombuffer(b"".join(ids), "<u4")
            number = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            place = np.concatenate([[0], np.cumsum(number)])[:-1]
            each = number[kind]
            before = np.concatenate([[0], np.cumsum(each)])
            yield flat[np.repeat(place[kind] - before[:-1], each) + np.arange(before[-1])], before[bounds]

    def _encode(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of words; marks after letters other than A-Z are encoded apart, too."""
        if not self.folds:
            return self._call(words)
        split = {w: len(core) for w in words if not w.isascii() and len(core := w.rstrip(MARKS)) < len(w) and _of_letters(core)}
        parts = {p for w, n in split.items() for p in (w[:n], w[n:])}
        found = {p: i for p in parts if (i := self.memo.get(p)) is not None}
        found |= self._call((words - split.keys() | parts) - found.keys())
        if len(self.memo) < MEMO_WORDS:
            self.memo.update((p, found[p]) for p in parts)
        return {w: found[w[:split[w]]] + found[w[split[w]:]] if w in split else found[w] for w in words}

    def _call(self, words: set[bytes]) -> dict[bytes, bytes]:
        # a special token in a word may swallow its surroundings: such words go to the library alone
        out = {w: np.array(self._ids(w.decode()), "<u4").tobytes() for w in words if b"<|" in w}
        plain = [w for w in words if w not in out]
        letters = [w for w in plain if _of_letters(w)]
        rest = [*set(plain).difference(letters)]
        for call, _, got in self._joined(letters):
            # words of letters are one piece each, by whose number their ids are told apart
            piece = np.array(got.word_ids, np.int64)
            if len(piece) and piece[-1] + 1 == len(call) and (np.diff(piece) >= 0).all():
                raw, cuts = np.array(got.ids, "<u4").tobytes(), (4 * np.searchsorted(piece, np.arange(len(call) + 1))).tolist()
                out.update((w, raw[x:y]) for w, x, y in zip(call, cuts, cuts[1:]))
            else:
                rest = rest + call
        for call, text, got in self._joined(rest):
            raw = np.array(got.ids, "<u4").tobytes()
            first = np.array(got.offsets, np.int64).reshape(-1, 2)[:, 0]
            spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 32)
            cuts = [0, *(4 * np.searchsorted(first, spaces)).tolist(), len(raw)]
            for w, a, b in zip(call, cuts, cuts[1:]):
                out[w] = raw[a:b]
        return out

    def _joined(self, words: list[bytes]) -> Iterator[tuple]:
        """Some words at a time, joined by spaces, with the text and what the library makes of it."""
        calls = [words[i:i + CALL_WORDS] for i in range(0, len(words), CALL_WORDS)]
        texts = [b" ".join(c).decode() for c in calls]
        return zip(calls, texts, self.library.encode_batch(texts, add_special_tokens=False))


def _parts(b: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as parts: those of letters A-Z are lower-cased (in a copy of the bytes), and marks after these letters are a part of their own."""
    low = b | np.uint8(32)
    others = np.zeros(len(b) + 1, np.int32)
    np.cumsum(low - np.uint8(97) >= 26, out=others[1:])
    cores = ends.copy()
    at = np.flatnonzero(_IS_MARK[b[ends - 1]])
    while len(at):
        cores[at] -= 1
        at = at[cores[at] > begins[at]]
        at = at[_IS_MARK[b[cores[at] - 1]]]
    folds = (cores > begins) & (others[cores] == others[begins])
    edges = np.zeros(len(b) + 1, np.int8)
    edges[begins[folds]] += 1
    edges[cores[folds]] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).view(bool)
    cuts = cores[folds & (cores < ends)]
    return np.where(inside, low, b), np.sort(np.concatenate([begins, cuts])), np.sort(np.concatenate([ends, cuts]))


def _of_letters(word: bytes) -> bool:
    # lower-cased, too: the one letter whose small form has a mark apart is no word of letters to the tokenizer
    return word.isalpha() or not word.isascii() and (text := word.decode()).isalpha() and text.lower().isalpha()


def _same_bytes(b: np.ndarray, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> bool:
    """Whether each span at x has the same bytes as that at y."""
    differ = np.flatnonzero(x != y)
    x, y, size = x[differ], y[differ], size[differ]
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return bool((b[np.repeat(x, size) + inner] == b[np.repeat(y, size) + inner]).all())


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer's version in the cache: the digest of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_key(text: Column) -> Column:
    """Digest of the normalised content: null is empty, runs of white space are one space, none at the ends.

    Exact for tokenizers that drop white space and split at it, as ``WordEncoder`` checks.
    """
    plain = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), F.lit(SPACES))
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; empty where nothing has been stored yet."""
    spark.createDataFrame([], CACHE).write.mode("append").parquet(path)
    return spark.read.schema(CACHE).parquet(path)


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(path)
        for batch in batches:
            counts = [n for _, before in encoder.encode(*text_bytes(batch.column("text"))) for n in np.diff(before)]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row, encoding each distinct text that the cache lacks once.

    ``tokenizer`` is the path of a tokenizer file that every worker can read; ``cache`` a
    folder in the shared store that keeps (content digest, tokenizer digest, count)
    between runs, by default a new one. Null text counts as empty, with 0 tokens. Repeated rows
    are counted each; other columns are ignored; an empty table gives an empty result.

    Rows are reduced to digests first, which meet the cache in an anti-join. Texts are merged
    by digest within each task before they are shuffled, so a large group of copies is one
    row per task; the missing ones are encoded, their counts are
    appended, and all rows read their count from the cache. The counts of this table's digests are stored before that
    last join, one row each, so that adaptive execution can split the rows of a hot digest.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    path = cache or shared_dir(spark, "token-cache")
    text = F.col(text_col)
    known = open_cache(spark, path).where(F.col("tokenizer") == version)
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), content_key(text).alias("content"))
    rows = stored(keyed.select("doc_id", "content", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")), "contents")
    missing = rows.select("content").distinct().join(known, "content", "left_anti")
    # copies are merged before the shuffle, and the digests left to encode meet one text each
    # (an inner join with distinct digests: a semi-join would be moved below the aggregate, and copies shuffled one by one)
    texts = keyed.groupBy("content").agg(F.min("text").alias("text")).join(missing.hint("merge"), "content")
    counted = texts.mapInArrow(_counter(tokenizer), "content binary, n_tokens bigint")
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_TEXTS)}):
        counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(path)
    counts = spark.read.schema(CACHE).parquet(path).where(F.col("tokenizer") == version).dropDuplicates(["content"])
    counts = stored(counts.select("content", "n_tokens"), "content-counts")
    return rows.join(counts.hint("merge"), "content").select("doc_id", "n_bytes", "n_tokens")
