"""Small documents with every awkward case, and plain versions of what is computed."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, size string, kept int, score string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lowered(text: str | None) -> str:
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def sentence(rnd: random.Random, n: int) -> str:
    syllables = ["ka", "ro", "min", "té", "lu", "sha", "po", "en", "dri", "vo"]
    return " ".join("".join(rnd.choices(syllables, k=rnd.randint(1, 3))) for _ in range(n))


def documents(spark, rows: list[tuple]):
    """Rows ``(doc_id, text, lang, source)`` with further columns whose names clash."""
    return spark.createDataFrame([(*r, "mine", 7, "own") for r in rows], SCHEMA)


def awkward(seed: int = 1, n: int = 40) -> list[tuple]:
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        text = sentence(rnd, rnd.randint(1, 160))
        rows.append((i, text, rnd.choice(["aa", "bb", None]), rnd.choice(["s1", "s2", "S3", None])))
    base = rows[3][1] + " " + sentence(rnd, 200)
    for k in range(6):  # near copies
        changed = base.split(" ")
        changed[10 * k] = "changed"
        rows.append((100 + k, " ".join(changed), "aa", "s1"))
    rows += [(200 + k, base.upper(), "aa", "s1") for k in range(4)]  # copies but for case
    rows += [
        (300, None, "aa", "s1"),
        (301, "", None, None),
        (302, " \t\n\x0b ", "bb", "s2"),
        (303, "one two", "aa", "s1"),
        (304, "ONE two", "aa", "s1"),
        (305, sentence(rnd, 30_000), "aa", "s2"),
        (306, "a b c " * 60, "aa", None),
        (None, "no id here at all", "aa", "s1"),
        (None, None, None, None),
        (7, rows[7][1], rows[7][2], rows[7][3]),  # a repeated row
    ]
    return rows
