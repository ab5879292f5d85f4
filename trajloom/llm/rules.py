"""Quality rules: a table of thresholds compiled into one projection.

A rule bounds one measure of a text from below, from above, or both. All measures are
column expressions over one list of words and one list of lines, bound once for each row,
so a table of rules becomes a single projection without a shuffle and without user
functions. Measures are length, symbol, stop-word and line ratios; others can be added as
column expressions.

Words found again are counted exactly: the three-word windows of a text are sorted with
their places, windows equal to a neighbour give the places that count, and a word is
counted once however many such windows hold it. That is n log n in the words of a text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Signs that may stand beside a stop word.
MARKS = ".,;:?()\"'"
# Frequent function words of the languages that the rules know.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by this are at from",
    "de": "der die und in den von zu das mit sich des für im auf ist nicht dem eine ein als",
    "fr": "de la le et les des en un du une est pour qui dans par au sur pas avec que",
    "es": "de la que el en y los se del las un por con no una para su es al lo",
}


@dataclass(frozen=True)
class Rule:
    """A text fails where the measure is below ``least`` or above ``most``; a null measure passes."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Thresholds of the production table. The base rules of the contract come before them.
RULES = (
    Rule("mean_word", "chars_per_word", 2.0, 12.0),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "stop_word_share", 0.05, None),
    Rule("repeated_lines", "repeated_line_share", None, 0.4),
    Rule("bulleted_lines", "bullet_line_share", None, 0.9),
    Rule("cut_lines", "ellipsis_line_share", None, 0.3),
    Rule("lettered_words", "lettered_word_share", 0.7, None),
)
#: Fewest words of a text, and the most of its words (of 100) that repeated windows may hold.
MIN_WORDS, MAX_REPEATED = 50, 50


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the list holds twice or more."""
    none = F.array().cast("array<struct<g:string,i:int>>")

    def window(first: Column, i: Column) -> Column:
        return F.struct(F.concat_ws(" ", first, words[i + 1], words[i + 2]).alias("g"), i.alias("i"))

    def again(s: Column) -> Column:
        def place(x: Column, k: Column) -> Column:
            before, after = F.get(s, k - 1), F.get(s, k + 1)
            return F.when((before["g"] == x["g"]) | (after["g"] == x["g"]), x["i"])

        return F.sort_array(F.filter(F.transform(s, place), lambda i: i.isNotNull()))

    def held(at: Column) -> Column:
        new = F.transform(at, lambda i, k: F.least(F.coalesce(F.get(at, k + 1) - i, F.lit(3)), F.lit(3)))
        return F.aggregate(new, F.lit(0).cast("long"), lambda total, x: total + x)

    grams = F.when(F.size(words) > 2, F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(1))), window)).otherwise(none)
    return bind(F.sort_array(grams), lambda s: bind(again(s), held))


def counts(text: Column) -> Column:
    """Struct of the counts that measures divide; a null text has none of anything."""
    stop = [F.lit(w) for w in sorted({w for words in STOP_WORDS.values() for w in words.split()})]
    plain = text

    def of(words: Column, lines: Column) -> Column:
        bare = lambda w: F.translate(w, UPPER + MARKS, LOWER)
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(plain, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(plain) - F.length(F.translate(plain, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: bare(w).isin(*stop))).cast("long").alias("n_stop_words"),
            F.size(F.filter(words, lambda w: F.translate(w, "0123456789!?.,;:-/()[]{}=+_~^'\"" + SYMBOLS, "") != "")).cast("long").alias("n_lettered"),
            F.size(F.filter(lines, lambda x: F.ltrim(x).rlike(r"^[-*•]"))).cast("long").alias("n_bullets"),
            F.size(F.filter(lines, lambda x: F.rtrim(x).rlike(r"(\.\.\.|…)$"))).cast("long").alias("n_ellipses"),
        )

    words = F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(plain, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    return bind(words, lambda w: bind(lines, lambda x: of(w, x)))


def measures(c: Column) -> dict[str, Column]:
    """Ratios over a struct of :func:`counts`; null where there is nothing to divide by."""
    words, lines = F.nullif(c["n_words"], F.lit(0)), F.nullif(c["n_lines"], F.lit(0))
    return {
        "chars_per_word": c["word_chars"] / words,
        "symbols_per_word": c["n_symbols"] / words,
        "stop_word_share": c["n_stop_words"] / words,
        "lettered_word_share": c["n_lettered"] / words,
        "repeated_line_share": c["n_dup_lines"] / lines,
        "bullet_line_share": c["n_bullets"] / lines,
        "ellipsis_line_share": c["n_ellipses"] / lines,
    }


def breaks(rule: Rule, measure: Column) -> Column:
    """Does the measure break the rule?"""
    out = F.lit(False)
    if rule.least is not None:
        out = out | (measure < F.lit(float(rule.least)))
    if rule.most is not None:
        out = out | (measure > F.lit(float(rule.most)))
    return F.coalesce(out, F.lit(False))


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED,
           extra: dict[str, Callable[[Column], Column]] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document doc_id, the counts, base_failed, the names of the rules it breaks, and kept.

    ``extra`` names further measures, each a function of the struct of counts. A rule over
    an unknown measure is an error. A null or empty text has no words and fails the base
    rule; ratios over nothing break no rule. Every row is judged alone: repeated rows, rows
    without id and other columns change nothing. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), counts(text).alias("c"))
    c = F.col("c")
    known = measures(c) | {name: of(c) for name, of in (extra or {}).items()}
    missing = sorted({r.measure for r in rules} - set(known))
    if missing:
        raise ValueError(f"rules over unknown measures: {', '.join(missing)}")
    base = (c["n_words"] < min_words) | (100 * c["n_repeat_words"] > max_repeated * c["n_words"])
    broken = F.filter(F.array(*[F.when(breaks(r, known[r.measure]), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()) if rules else F.array().cast("array<string>")
    out = rows.select("doc_id", "c.*", base.alias("base_failed"), broken.alias("broken_rules"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def rules_from(table: DataFrame, most_rules: int = 1000) -> tuple[Rule, ...]:
    """Rules of a table (name, measure, least, most), by name; more than ``most_rules`` rows are an error."""
    rows = table.select("name", "measure", "least", "most").limit(most_rules + 1).collect()
    if len(rows) > most_rules:
        raise ValueError(f"more than {most_rules} rules")
    return tuple(sorted((Rule(r["name"], r["measure"], r["least"], r["most"]) for r in rows), key=lambda r: r.name))
