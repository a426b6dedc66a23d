import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from arriero.llm import language
from tests.llm.helpers import edge_docs, empty_docs, frame


def corpus(spark, n=300):
    rng = random.Random(6)
    parts = {"aa": ["tion", "ing", "th", "er"], "bb": ["ß", "sch", "ung", "ö"], "cc": ["eau", "ê", "oux", "ç"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 40))), lang, "s"))
    return frame(spark, rows)


def test_held_out_accuracy_and_code_switching(spark):
    docs = corpus(spark)
    model = language.fit(docs)
    got = language.label(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).toPandas()
    assert len(got) > 50 and (got.lang == got.lang_pred).mean() > .97 and got.score.between(0, 1).all()
    assert (np.diag(model.step) > model.step.max(axis=1) - 1e-9).all()  # languages go on more often than they switch
    mixed = frame(spark, [(1, "thing eringtion tioner thther schung ungsch", None, None)])
    assert language.label(mixed, model).first().lang_pred == "aa"


def test_held_out_rows_are_never_learned_from(spark):
    docs = corpus(spark, 120)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    wrong = docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang")))
    assert language.fit(wrong).languages == ["aa", "bb", "cc"]


def test_edge_rows(spark):
    model = language.fit(corpus(spark, 120))
    got = language.label(edge_docs(spark), model).collect()
    assert len(got) == edge_docs(spark).count() and all(r.lang_pred in ("aa", "bb", "cc", "und") and 0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    odd = frame(spark, [(1, "123 4 !?", None, None), (2, "漢字", None, None), (3, "٣ ٤", None, None)])
    assert [r.lang_pred == "und" for r in sorted(language.label(odd, model).collect())] == [True, False, True]
    assert language.label(empty_docs(spark), model).collect() == []


def test_no_labels_or_one_language(spark):
    docs = corpus(spark, 40)
    none = language.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert none.languages == [] and {r.lang_pred for r in language.label(docs, none).collect()} == {"und"}
    one = language.fit(docs.withColumn("lang", F.lit("aa")))
    assert {(r.lang_pred, r.score) for r in language.label(docs, one).collect()} == {("aa", 1.0)}


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(4)
    first, step = np.array([0, 3, 3, 7, 8]), rng.normal(size=(3, 3))
    emission = rng.normal(size=(8, 3))
    post = language.posteriors(emission, first, step)
    weight, ahead, back = language._messages(emission, first, step)
    inner = np.array([0, 1, 3, 4, 5])
    moves = np.zeros((3, 3))
    for a, b in zip(first, first[1:]):
        total, own = 0.0, np.zeros((b - a, 3))
        pairs = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=b - a):
            p = np.exp(sum(emission[a + t, s] for t, s in enumerate(path)) + sum(step[x, y] for x, y in zip(path, path[1:])))
            total += p
            for t, s in enumerate(path):
                own[t, s] += p
            for x, y in zip(path, path[1:]):
                pairs[x, y] += p
        if b > a:
            assert np.allclose(post[a:b], own / total)
            moves += pairs / total
    assert np.allclose(language.expected_moves(weight, ahead, back, step, inner), moves)
