"""Small documents that hold the awkward cases, and columns whose names clash with those of the operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, mark long, component string, `a.b` int, size int, spot int"


def prose(seed: int, words: int, stems=("ka", "lo", "mi", "ren", "tu", "va", "shi", "do")) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(stems) for _ in range(draw.randint(1, 4))) for _ in range(words))


def frame(spark, rows):
    """``rows``: (doc_id, text, lang, source)."""
    data = [(*r, len(r[1] or ""), 7, 7, "x", 7, 7, 7) for r in rows]
    return spark.createDataFrame(data, SCHEMA)


PASSAGE = prose(1, 60)
ROWS = [
    (1, prose(10, 80), "en", "s1"), (2, prose(10, 80), "en", "s1"), (2, prose(10, 80), "en", "s1"), (3, None, None, None), (4, "", "en", "s2"),
    (5, " \n\t ", "en", "s2"), (6, "a", "en", "s2"), (7, "a b", None, "s3"), (8, prose(11, 40) + " " + PASSAGE + " " + prose(12, 40), "en", "s1"),
    (9, prose(13, 33) + "\n" + PASSAGE + "\n" + prose(14, 20), "en", None), (None, prose(15, 70), "en", "s1"), (None, prose(10, 80), None, "s1"),
    (10, "word " * 20_000, "en", "s3"), (11, prose(16, 30_000), "en", "s1"), (12, "### $$$ " * 60, "en", "s2"), (13, "Ärger über Öl \U0001f389 " * 30, "de", "s4"),
]
