"""Small tables with every awkward case."""

from __future__ import annotations

import random

WORDS = "the of and river stone light under carry seven green paper window house market voice early north garden silver".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", "ing", "ly", "er"]) for _ in range(n))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join(rng.choice(WORDS) + "x" if rng.random() < share else w for w in text.split(" "))


def documents(seed: int = 1, n: int = 40) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, spans): unique, copied and edited texts, NULLs, blanks,
    one long text; ``spans`` clashes with a name the operators use."""
    rng = random.Random(seed)
    texts: list[str | None] = [sentence(rng, rng.randint(3, 120)) for _ in range(n)]
    lines = [sentence(rng, 12) for _ in range(4)]
    for i in range(0, n, 5):
        texts[i] = "\n".join([*lines, texts[i] or "", sentence(rng, 20)])
    base = sentence(rng, 150)
    texts += [base, base, base + " tail", edited(rng, base, 0.01), edited(rng, base, 0.01), edited(rng, base, 0.3)]
    texts += [None, "", " \n\t ", "one", "One TWO", "é" * 300, "a" * 450, "\n".join(["same"] * 8), "a\n\n\nb\n \nc\nd\na\nb\nc"]
    texts += [sentence(rng, 4000), "x" * 5000 + base, "ÀÉ ß ñandú 日本語 текст " * 30]
    rows = [(i, t, "en", "src", None if t is None else len(t), "x") for i, t in enumerate(texts)]
    return rows + [(None, "without an id " + base, None, None, None, None), (3, rows[3][1], "en", "src", 0, "x")]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string"


def frame(spark, rows=None, parts: int = 3):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)
