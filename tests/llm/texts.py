"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

WORDS = ("the of and to a in is that it for with as was be on at by this".split()
         + [f"{a}{b}{c}" for a in ("thun", "ered", "onti") for b in ("ba", "ling", "ost") for c in ("er", "ion", "ea", "ith")])
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; none of these columns may matter.
CLASHING = ("size", "place", "bucket", "text_key", "_n", "window", "component_id", "score", "lang_pred", "node", "c", "row", "_key", "copies")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) * (r.random() < 0.5) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, near copies, shared passages."""
    base, passage = prose(1, 120), prose(2, 70)
    edited = base.split()
    edited[60] = "changed"
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, " ".join(edited), "en", "b", None),
        (4, "", "en", "b", 0), (5, None, "en", "b", None), (6, " \n\t ", None, None, 3), (7, "One.", "en", "c", 4),
        (8, "Two words", None, "c", 9), (None, base, "en", "a", 1), (None, None, None, None, None),
        (9, prose(3, 40) + " " + passage + " " + prose(4, 30), "en", None, 5),
        (10, prose(5, 10) + "\n" + passage, "en", "a", 5),
        (11, "aaaa" * 120, "en", "b", 5), (12, prose(6, 6000), "en", "b", 5), (12, prose(7, 60), "en", "b", 5),
        (13, "été ñandú 日本語 \U0001f600 " * 30, "fr", "b", 5), (14, "line one here\nline one here\n\n" * 9, "en", "b", 5),
        (15, "<|endoftext|> and # marks ### $$ %% || 1234", "en", "z", 5), (16, base.upper(), "en", "z", 5),
    ]
    return rows


def frame(spark, rows=None, clash=False):
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHING})
    return df
