"""Small tables with every awkward case, and plain versions of what operators compute."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# other columns bear names that operators use themselves
DOCUMENTS = "doc_id long, text string, lang string, id long, key string, spans string, n int, score string, n_chars long"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    names = ["".join(draw.choice("abcdeéghiñ") for _ in range(1 + k % 7)) for k in range(vocabulary)]
    return " ".join(draw.choice(names) for _ in range(words))


def documents(spark, texts: list[tuple[int | None, str | None]]):
    rows = [(i, t, "en", 1, "k", "s", 2, "x", len(t) if t is not None else None) for i, t in texts]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def corpus() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, repeated rows, copies, near copies, shared passages, long words and a long text."""
    base, passage = prose(1, 300), prose(2, 90)
    near = base.split(" ")
    near[150] = "changed"
    return [
        (0, base), (1, "An Entirely new\ttext.\n" + prose(3, 120)), (2, base), (2, base), (3, " ".join(near)),
        (4, prose(4, 60) + "  " + passage + "\n" + prose(5, 40)), (5, prose(6, 30) + " " + passage),
        (None, passage + " " + prose(7, 20)), (None, None), (6, None), (7, ""), (8, "  \n\t "), (9, "one"), (10, "two words"),
        (11, "x" * 3000 + " " + "x" * 3000), (12, "ab " * 400), (13, prose(8, 20000)), (14, "é" * 700), (15, "ONE"),
        (16, passage), (16, prose(9, 70)),
    ]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
