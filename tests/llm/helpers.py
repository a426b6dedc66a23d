"""Small tables with the awkward rows every operator has to take."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int, component_id long, node long"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(rng, n, alphabet=("alpha", "beta", "gamma", "delta", "Eps", "zeta", "eta", "theta", "iota", "kappa", "la", "mu", "nu", "xi", "om", "pi", "rho", "si", "tau", "up")):
    return " ".join(rng.choice(alphabet) + str(rng.randint(0, 60)) for _ in range(n))


def frame(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), 0.5, 7, -1, 3) for i, t, lang, s in rows], DOCS)


def edge_rows():
    rng = random.Random(5)
    long_text = words(rng, 6000)
    base = words(rng, 80)
    near = base.replace(base.split()[40], "changed", 1)
    rows = [(1, None, "en", "b"), (2, "", None, "b"), (3, " \t\n\r\x0b\x0c ", "de", None), (4, base, "en", "a"), (5, base, "en", "a"), (6, near, "en", "a"),
            (7, base.upper(), "fr", None), (8, "one two", "en", "c"), (9, "ONE  two\n", "en", "c"), (10, "one", "es", "c"), (11, long_text, "en", "a"), (12, long_text + " end", "en", "b"),
            (13, "é ñ 漢字 🙂 x\u00a0y \x00 z", "es", "ü"), (None, base, "en", None), (14, words(rng, 300), None, "z"), (14, words(rng, 300), "en", "z"), (15, "a" * 5000, "en", "z"), (15, "a" * 5000, "en", "z")]
    return rows + [(100 + i, words(rng, rng.randint(1, 40)), "en", "a") for i in range(40)]


def edge_docs(spark):
    return frame(spark, edge_rows())


def empty_docs(spark):
    return edge_docs(spark).where(F.lit(False))


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
