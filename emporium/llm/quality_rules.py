"""Quality rules as a short-circuit cascade, with SQL functions only."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import cut

_SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPLIT), "")


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def occurrences(text: Column, characters: str) -> Column:
    """How many code points of ``text`` the character class matches."""
    return F.regexp_count(text, F.lit(characters)).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeat_words(words: Column, window: int = 8) -> Column:
    """Words covered by windows of ``window`` words (a power of two) that occur twice or more.

    Windows are compared by a 64-bit hash. Texts whose window hashes are all
    distinct stop there; else equal hashes meet by sorting, and the covered
    words are the gaps between repeated positions, at most ``window`` each.
    """
    n = F.size(words)

    def joined(h: Column, step: int) -> Column:
        """Hashes of runs twice as long: each with the one ``step`` places on."""
        return F.zip_with(h, F.slice(h, step + 1, n), lambda a, b: F.xxhash64(a, b))

    hashes, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while step < window:
        hashes, step = joined(hashes, step), 2 * step
    hashes = F.slice(hashes, 1, n - (window - 1))

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return _let(ranked, lambda s: _let(F.sort_array(F.transform(
            F.filter(F.transform(s, lambda e, k: F.struct(e["i"].alias("i"), (e["x"].eqNullSafe(F.get(s, k - 1)["x"]) | e["x"].eqNullSafe(F.get(s, k + 1)["x"])).alias("again"))), lambda e: e["again"]),
            lambda e: e["i"],
        )), lambda p: F.aggregate(
            F.transform(p, lambda at, k: F.least(F.coalesce(F.get(p, k + 1) - at, F.lit(window)), F.lit(window))),
            F.lit(0).cast("long"), lambda acc, c: acc + c,
        )))

    return F.when(n < window + 1, F.lit(0).cast("long")).otherwise(
        _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    )


def metrics(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``text`` of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = docs.select("doc_id", text.alias("text")).withColumn("words", words_of(F.col("text")))
    return parts.select(
        "doc_id", "text",
        F.size("words").cast("long").alias("n_words"),
        word_chars(F.col("words")).alias("word_chars"),
        occurrences(F.col("text"), SYMBOLS).alias("n_symbols"),
        _let(lines_with_words(F.col("text")), dup_lines).alias("n_dup_lines"),
        _let(F.col("words"), lambda w: repeat_words(w)).alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Rule:
    """``rejects(text)`` is true for a text that goes."""

    name: str
    rejects: Callable[[Column], Column]


def _n_words(text: Column) -> Column:
    return F.size(words_of(text))


def _dup_share(text: Column) -> Column:
    return _let(lines_with_words(text), lambda lines: 2 * dup_lines(lines) > F.size(lines))


def _repeats(text: Column) -> Column:
    return _let(words_of(text), lambda w: 100 * repeat_words(w) > 30 * F.size(w))


#: The rules of the base test, then further ones; thresholds are per word or per character.
BASE_RULES = (
    Rule("too_short", lambda t: _n_words(t) < 20),
    Rule("repetitive", _repeats),
)
MORE_RULES = (
    Rule("symbols", lambda t: 10 * occurrences(t, SYMBOLS) > _n_words(t)),
    Rule("shouting", lambda t: 2 * occurrences(t, "!") > _n_words(t)),
    Rule("capitals", lambda t: 100 * occurrences(t, r"\p{Lu}") > 45 * F.length(t)),
    Rule("repeated_lines", _dup_share),
    Rule("word_length", lambda t: _let(words_of(t), lambda w: ~word_chars(w).between(2 * F.size(w), 16 * F.size(w)))),
)
RULES = BASE_RULES + MORE_RULES


def _few_files(docs: DataFrame, n: int = 8) -> DataFrame:
    """The rows of ``n`` evenly spaced files of a table that is read from more, so a sample costs no full scan."""
    names = sorted({path.rsplit("/", 1)[-1] for path in docs.inputFiles()})
    if len(names) <= n:
        return docs
    try:
        return docs.where(F.col("_metadata.file_name").isin(names[:: -(-len(names) // n)]))
    except AnalysisException:  # not a plain scan: its rows do not say which file they come from
        return docs


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> list[Rule]:
    """``rules`` by rejections per second on a sample of ``docs``, the best first.

    The sample is at most ``sample_rows`` rows (a quarter of the rows of a few
    files, cut off there) and only decides the order; which rows are rejected
    never depends on it. A rule that rejects nothing there comes last, the
    cheapest first.
    """
    sample = cut(_few_files(docs).sample(0.25, seed=7).limit(sample_rows).select(F.coalesce("text", F.lit("")).alias("text")))

    def measured(rule: Rule) -> tuple[float, float]:
        query = sample.agg(F.count_if(rule.rejects(F.col("text"))).alias("n"))
        spent = []
        for _ in range(2):  # the first run also compiles
            began = time.perf_counter()
            rejected = query.first()["n"]
            spent.append(time.perf_counter() - began)
        return -rejected / max(spent[-1], 1e-6), spent[-1]

    return sorted(rules, key=measured)


def rejected(text: Column, rules: list[Rule] | tuple[Rule, ...]) -> Column:
    """True where a rule rejects; rules after the first that does are not evaluated."""
    out = F.when(F.coalesce(rules[0].rejects(text), F.lit(False)), True)
    for rule in rules[1:]:
        out = out.when(F.coalesce(rule.rejects(text), F.lit(False)), True)
    return out.otherwise(False)


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they are.

    Each text runs through the cascade of :func:`ordered` and leaves it at the
    first rule that rejects it. A null or empty text has no word and is
    rejected as too short; repeated rows are judged alike. No shuffle.
    """
    cascade = ordered(docs, rules, sample_rows)
    return docs.where(~rejected(F.coalesce(docs["text"], F.lit("")), cascade))


def assess(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """Metrics and verdict of every row: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept``.

    Words are runs without white space; null and empty texts have none and fail
    the base test. ``kept`` is false where the base test failed, else the
    cascade of the further rules decides. One projection, no shuffle, no Python;
    other columns are ignored.
    """
    cascade = ordered(docs, MORE_RULES, sample_rows)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = metrics(docs).withColumn("base_failed", failed)
    return judged.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(~rejected(F.col("text"), cascade))).drop("text")
