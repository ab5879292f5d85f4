import re
from collections import Counter

import pytest
from inputs import EDGES, prose

from trajloom.llm import rules


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, by plain loops."""
    text = text or ""
    words = re.findall(r"[^ \t-\r]+", text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    held = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    n = len(words)
    failed = n < 50 or 100 * len(held) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(held), failed


CASES = [
    "a b c a b c", "a b c d a b c", "x x x x x", "x x x", "a b", "\n\na\n \na\nb\n a\n", "## <b> & | 10%", "one\x0btwo\x0cthree\rfour",
    "🙂 🙂 🙂 🙂 ünï", "a b c d b c d a b c", prose(1, 200) + "\n" + prose(1, 80), "the line\n" * 40, "w " * 20_000,
]


@pytest.mark.parametrize("also", [[], EDGES])
def test_counts_equal_plain_loops(spark, docs, also):
    rows = list(enumerate(CASES)) + also
    got = rules.judged(docs(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_each_rule_catches_its_case_and_leaves_clean_text(spark, docs):
    rare = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}x" for k in range(120))
    clean = " ".join(f"the {w} of" for w in rare.split())
    lines = clean.split(" of")
    cases = {
        "": clean, "stop_words": rare, "symbols": clean.replace("the", "# the"), "mean_word": " ".join("the" + "y" * 40 + f"{k} of" for k in range(90)),
        "repeated_lines": "\n".join(lines[:60]) + "\nand so on" * 50, "bulleted_lines": "\n- ".join(["", *lines]), "cut_lines": "...\n".join(lines),
        "lettered_words": clean + " 12 34" * 200,
    }
    names = list(cases)
    got = {names[r.doc_id]: r for r in rules.judged(docs([(k, cases[n]) for k, n in enumerate(names)])).collect()}
    assert got[""].kept and not got[""].broken_rules
    for name in names[1:]:
        assert name in got[name].broken_rules and not got[name].kept, name


def test_rules_from_a_table_and_own_measures(spark, docs):
    table = spark.createDataFrame([("long", "words", None, 3.0), ("short", "words", 2.0, None)], "name string, measure string, least double, most double")
    own = rules.rules_from(table)
    got = rules.judged(docs([(1, "a"), (2, "a b"), (3, "a b c d")]), own, min_words=0, extra={"words": lambda c: c["n_words"]})
    assert {r.doc_id: (r.broken_rules, r.kept) for r in got.collect()} == {1: (["short"], False), 2: ([], True), 3: (["long"], False)}
    with pytest.raises(ValueError):
        rules.judged(docs([(1, "a")]), own)


def test_one_projection_and_no_user_function(spark, docs):
    plan = rules.judged(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "InArrow" not in plan


def test_empty_table(spark, docs):
    assert rules.judged(docs([])).count() == 0
