"""Small tables that hold every awkward case the operators promise to survive."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "só", "ta", "üb") for b in ("n", "rt", "sse", "la", "d", "ing")]


def prose(seed: int, n: int, stop: int = 9) -> str:
    rng = random.Random(seed)
    words = [rng.choice(VOCABULARY) for _ in range(n)]
    return " ".join(w + ("." if i % stop == stop - 1 else "") for i, w in enumerate(words))


def rows(texts, lang="en", source="src0"):
    return [(i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]


AWKWARD = [None, "", " \t\n", "one", "a b c d", "ends with break\n", "\n\n", "x" * 5000, "é ü ñ " * 400, "  odd spaces \x0b\x0c\r"]


def awkward_docs(spark, extra=()):
    data = rows([*AWKWARD, *extra])
    data.append((None, "no id here at all", None, None, None))
    data.append(data[4])
    return spark.createDataFrame(data, DOCS)
