"""Inputs shared by the tests of this folder."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, base string, part int, n long"
WORDS = "the of and to in is for with on by this river stone house green light music paper water seven eight".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing"]) for _ in range(n))


#: Null and empty texts, blanks, ties, repeated rows, a null id, and a long text.
EDGES = [(101, None), (102, ""), (103, " \n\t"), (104, "one"), (104, "one"), (105, "one"), (None, "one"), (106, "é ß 漢字 😀"), (107, "ab " * 60_000)]
