import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from arriero.llm import toxicity, trees
from tests.llm.helpers import edge_docs, empty_docs, frame, words


def corpus(spark, n=900):
    rng = random.Random(2)
    bad = ["vilefoo", "grubling", "snarkwad", "dreckhead"]
    rows, labels = [], []
    for i in range(n):
        line, toxic = words(rng, rng.randint(5, 60)).split(), int(rng.random() < .2)
        for _ in range(rng.randint(1, 3) * toxic):
            line.insert(rng.randrange(len(line)), rng.choice(bad))
        rows.append((i, " ".join(line), "en", "a"))
        labels.append((i, 1, toxic))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels)
    scored = toxicity.toxicity(docs, model).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).toPandas()
    assert len(scored) > 150 and ((scored.predicted == 1) == (scored.toxic == 1)).mean() > .97
    assert scored.score.between(0, 1).all()


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(spark, 300)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    texts = ["vilefoo you", "plain words only", ""]
    assert np.array_equal(toxicity.fit(docs, labels).score(texts), toxicity.fit(docs, flipped).score(texts))


def test_edge_rows_and_clashing_columns(spark):
    docs, labels = corpus(spark, 300)
    model = toxicity.fit(docs, labels)
    got = toxicity.toxicity(edge_docs(spark), model)
    assert got.count() == edge_docs(spark).count() and got.columns.count("score") == 1
    assert got.where("score is null or score < 0 or score > 1 or predicted is null").count() == 0
    pairs = got.where("doc_id in (4, 5)").select("score").distinct().count()
    assert pairs == 1 and toxicity.toxicity(empty_docs(spark), model).collect() == []


def test_no_labels_or_one_kind(spark):
    docs, labels = corpus(spark, 100)
    assert set(toxicity.fit(docs, labels.where("false")).score(["a", ""])) == {0.0}
    assert set(toxicity.fit(docs, labels.withColumn("toxic", F.lit(1))).score(["a", ""])) == {1.0}
    odd = labels.limit(0).union(spark.createDataFrame([(None, 1, 1), (3, 1, None), (4, None, 0), (4, None, 1)], labels.schema))
    assert toxicity.labelled(docs, odd).count() <= 1


def test_isotonic_is_the_best_monotone_fit():
    x, y = np.array([1, 2, 3, 4, 5, 5.]), np.array([0, 1, 0, 1, 1, 0.])
    at, mean = trees.isotonic(x, y)
    assert np.allclose(np.interp(x, at, mean), [0, .5, .5, 2 / 3, 2 / 3, 2 / 3])


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > .5) ^ (x[:, 1] > .5)).astype(float)
    assert ((trees.boosted(x[:1500], y[:1500]).raw(x[1500:]) > 0) == (y[1500:] > 0)).mean() > .95
    assert ((trees.forest(x[:1500], y[:1500]).raw(x[1500:]) > .5) == (y[1500:] > 0)).mean() > .9


def test_long_texts_take_linear_time():
    lexicon = {"idiot": 2.0}
    for text in ("a" + "4" * 1_000_000, "you idiot " * 100_000, "4" * 1_000_000, "a" * 1_000_000, "a@" * 500_000, "a.b " * 250_000, "@" * 1_000_000, "a_4" * 330_000):
        start = time.monotonic()
        toxicity.features(text, lexicon, frozenset({"idio"}))
        assert time.monotonic() - start < 5, text[:10]


def test_obfuscated_tokens():
    pattern = re.compile(r"\b(?=\w*[^\W\d_])\w*[\d@$*#]+[\w@$*#]*[^\W\d_]")
    rng = random.Random(8)
    for _ in range(4000):
        token = "".join(rng.choice("ab4_$@#*7é") for _ in range(rng.randint(1, 9)))
        assert toxicity.obfuscated(token) == bool(pattern.search(token)), token
    assert toxicity.odd_tokens("an id10t and a stup1d f*ol") == 3 and toxicity.odd_tokens("sooo i.d.i.o.t 2024 v2") == 2
    assert toxicity._beside(7, [2]) and not toxicity._beside(8, [2]) and not toxicity._beside(3, []) and toxicity._beside(0, [5, 9])
