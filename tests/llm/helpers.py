"""Small documents tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, score double, id string, n_tokens string"


def awkward_docs(spark, more=()):
    """Nulls in any column, empty and very long texts, repeated rows, ties, clashing extra columns."""
    rnd = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta,", "eta.", "theta", "日本", "😀"]
    prose = [" ".join(rnd.choice(words) for _ in range(rnd.randint(6, 60))) for _ in range(20)]
    rows = [(i, t, f"s{i % 3}", "en", len(t), 0.5, "x", "y") for i, t in enumerate(prose)]
    rows += [
        (100, None, "s0", None, None, None, None, None),
        (101, "", "s1", "en", 0, 0.0, "", ""),
        (102, " \n\t ", None, "en", 4, 1.0, "x", "y"),
        (103, " ".join(f"w{i % 977}" for i in range(60_000)), "s1", "en", None, None, None, None),
        (104, prose[0], "s2", "en", None, None, None, None),
        (105, prose[0], None, "en", None, None, None, None),
        (106, "x" * 5_000, "s0", "en", None, None, None, None),
        (107, "one two", "s0", "en", None, None, None, None),
        (107, "one two", "s0", "en", None, None, None, None),
        (None, prose[3], "s0", "en", None, None, None, None),
        (None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows + list(more), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)
