"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACES, count_words, let, packed, stored, unpacked

# Characters that count as symbols, and the length of a repeated run of words.
SYMBOLS = "#*$%&|<>"
RUN = 8
# Size of the sample that fixes the order of the rules; it never changes a verdict.
SAMPLE_ROWS, SAMPLE_FILES = 2_000, 4


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _removed(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def words(text: Column) -> Column:
    """Array of the text's words; null and blank texts have none."""
    inner = F.btrim(_text(text), F.lit(SPACES))
    return F.when(F.length(inner) > 0, F.split(inner, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def repeated_words(text: Column) -> Column:
    """Words inside a run of eight words that the text holds twice or more, the first included.

    Runs are compared by a 64-bit hash of their words' hashes. Most texts repeat no
    run, which one pass over the hashes tells; only the others are sorted.
    """

    def of_runs(runs: Column) -> Column:
        n = F.size(runs)
        ordered = F.sort_array(F.transform(runs, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(runs)) == n, F.lit(0)).otherwise(let(ordered, covered))

    def covered(ordered: Column) -> Column:
        def place(e, k):
            return F.when((F.get(ordered, k - 1)["x"] == e["x"]) | (F.get(ordered, k + 1)["x"] == e["x"]), e["i"])

        starts = F.sort_array(F.filter(F.transform(ordered, place), lambda i: i.isNotNull()))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda i, k: F.least(F.lit(RUN), F.coalesce(F.get(s, k + 1) - i, F.lit(RUN)))), F.lit(0), lambda a, b: a + b))

    def of_hashes(h: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(h) - (RUN - 1)), lambda i: F.xxhash64(F.slice(h, i, RUN)))
        return F.when(F.size(h) > RUN, let(runs, of_runs)).otherwise(F.lit(0))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of_hashes).cast("bigint")


def _lines(text: Column) -> Column:
    return F.filter(F.split(_text(text), "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)


STATS: dict[str, Callable[[Column], Column]] = {
    "n_words": count_words,
    "word_chars": lambda t: _removed(_text(t), SPACES).cast("bigint"),
    "n_symbols": lambda t: (F.length(_text(t)) - _removed(_text(t), SYMBOLS)).cast("bigint"),
    "n_dup_lines": lambda t: let(_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
    "n_lines": lambda t: F.size(_lines(t)).cast("bigint"),
    "n_marks": lambda t: (F.length(_text(t)) - _removed(_text(t), "!?")).cast("bigint"),
    "n_stutters": lambda t: let(words(t), lambda w: F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))).cast("bigint"),
    "n_repeat_words": repeated_words,
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text; ``test`` builds the condition from a function that gives a statistic's column."""

    name: str
    test: Callable[[Callable[[str], Column]], Column]


BASE_RULES = [
    Rule("few_words", lambda s: s("n_words") < 20),
    Rule("repeated_words", lambda s: 100 * s("n_repeat_words") > 30 * s("n_words")),
]
# Conservative bounds: prose keeps well away from each of them.
RULES = BASE_RULES + [
    Rule("symbols", lambda s: 100 * s("n_symbols") > 20 * s("n_words")),
    Rule("repeated_lines", lambda s: (s("n_dup_lines") > 3) & (100 * s("n_dup_lines") > 30 * s("n_lines"))),
    Rule("stutter", lambda s: 100 * s("n_stutters") > 20 * s("n_words")),
    Rule("marks", lambda s: 100 * s("n_marks") > 50 * s("n_words")),
    Rule("word_length", lambda s: (s("word_chars") > 15 * s("n_words")) | (s("word_chars") < 2 * s("n_words"))),
]


def from_text(text: Column) -> Callable[[str], Column]:
    """Statistics computed where a rule asks for them."""
    return lambda name: STATS[name](text)


def sample_of(docs: DataFrame, text_col: str, seed: int = 7) -> DataFrame:
    """About ``SAMPLE_ROWS`` texts, stored. Of a table in many files only ``SAMPLE_FILES``, evenly spaced, are read."""
    part = docs
    files = sorted(docs.inputFiles())
    if len(files) > SAMPLE_FILES:
        chosen = [files[i * len(files) // SAMPLE_FILES] for i in range(SAMPLE_FILES)]
        try:
            few = docs.where(F.col("_metadata.file_path").isin(chosen))
            part = docs if few.isEmpty() else few
        except AnalysisException:  # not a plain table: no file of a row is known
            pass
    fraction = min(1.0, SAMPLE_ROWS / max(part.count(), 1))
    return stored(part.select(F.col(text_col).alias("text")).sample(fraction, seed).repartition(2), "rule-sample")


def rank_rules(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> list[tuple[Rule, float, float]]:
    """The rules with their seconds and share of rejected rows on a sample, most rejections per second first.

    Rules that reject nothing there come last, cheapest first. An empty table keeps the given order.
    """
    sample = sample_of(docs, text_col)
    n = sample.count()
    if n == 0:
        return [(r, 0.0, 0.0) for r in rules]
    stat = from_text(F.col("text"))

    def run(condition: Column) -> tuple[float, int]:
        start = time.perf_counter()
        hits = sample.agg(F.count_if(condition)).first()[0]
        return time.perf_counter() - start, hits

    run(rules[0].test(stat))
    scan, _ = run(F.length("text") < 0)
    measured = []
    for rule in rules:
        seconds, hits = run(rule.test(stat))
        measured.append((rule, max(seconds - scan, 1e-3), hits / n))
    return sorted(measured, key=lambda m: (-m[2] / m[1], m[1]))


def cascade(rules: list[Rule], stat: Callable[[str], Column]) -> Column:
    """Name of the first rule, in the given order, that rejects the row; null if none does. Later rules are not evaluated."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(rule.test(stat), F.lit(rule.name)).otherwise(found)
    return found


def assess(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, every statistic, ``kept`` and ``failed`` (the rule that rejected the row) for each row.

    Which rule is named depends on the order that the sample gives; ``kept`` does not.
    Null and empty texts have no word and fail the word count. Rows are judged one by one
    over the whole text; repeated rows and other columns make no difference.
    """
    order = [rule for rule, _, _ in rank_rules(docs, rules, text_col)]
    stats = docs.select(F.col(id_col).alias("doc_id"), *[f(F.col(text_col)).alias(name) for name, f in STATS.items()])
    return stats.withColumn("failed", cascade(order, F.col)).withColumn("kept", F.col("failed").isNull())


def keep_good(docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with all their columns.

    Statistics are computed inside the cascade, so a row that an early rule rejects never pays for a later one.
    """
    order = [rule for rule, _, _ in rank_rules(docs, rules, text_col)]
    rows = packed(docs, failed=cascade(order, from_text(F.col(text_col))))
    return unpacked(rows.where(F.col("failed").isNull()))
