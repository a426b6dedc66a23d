import random
import re

import pytest

from arriero.llm import decontaminate as dc
from tests.llm.helpers import edge_docs, empty_docs, frame, tuples

QUESTION = ("A farmer named Maria sells 12 kg of apples for 30 dollars and later sells 12 kg of pears to her neighbour while "
            "walking home, so how much did Maria earn in total during the whole week")
BENCH = "item_id long, text string, doc_id long, window long, form string"


def plain(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], BENCH)


def leaked(spark, docs, items):
    return {(r.doc_id, r.item_id, r.same_slots) for r in dc.leaks(frame(spark, [(i, t, "en", "s") for i, t in docs]), bench(spark, items)).collect()}


def test_copies_and_other_fillings(spark):
    rng = random.Random(1)
    around = lambda t: plain(rng, 17) + " " + t + " " + plain(rng, 23)
    other = QUESTION.replace("12", "55").replace("30", "81").replace("Maria", "Pedro")
    broken = QUESTION.replace("12 kg of pears", "99 kg of pears")  # one value of the question becomes two
    docs = [(1, around(QUESTION)), (2, around(other)), (3, around(broken)), (4, around(QUESTION.lower())), (5, around(re.sub(r"[.,]", " ;", QUESTION))),
            (6, around(" ".join(QUESTION.split()[3:18]))), (7, around(" ".join(QUESTION.split()[3:12]))), (8, plain(rng, 80)), (9, around(QUESTION.replace(" ", "\n"))), (10, QUESTION), (11, around(QUESTION).upper())]
    got = leaked(spark, docs, [(1, QUESTION), (2, plain(rng, 40))])
    assert {(d, s) for d, _, s in got} == {(1, True), (2, False), (4, True), (5, True), (6, True), (9, True), (10, True), (11, True)} | {(d, s) for d, _, s in got if d == 3}
    assert {i for _, i, _ in got} == {1}


def test_a_value_that_becomes_two_is_no_leak_of_both(spark):
    """The run up to the contradiction may be one, the whole is not."""
    item = "take 5 then add 5 and then take 5 again until all five boxes hold the same count"
    docs = [(1, item.replace("5", "7")), (2, "take 5 then add 6 and then take 7 again until all five boxes hold the same count")]
    assert leaked(spark, docs, [(1, item)]) == {(1, 1, False)}


def brute(docs, items, run=13):
    """Equal plain words in a row, for texts without slots."""
    form = lambda t: re.findall(r"[a-z]+", (t or "").lower())
    out = set()
    for d, t in docs:
        for i, q in items:
            a, b, best = form(t), form(q), 0
            for s in range(-len(b), len(a)):
                n = 0
                for k in range(len(b)):
                    n = n + 1 if 0 <= s + k < len(a) and a[s + k] == b[k] else 0
                    best = max(best, n)
            if len(b) >= 8 and best >= min(run, len(b)):
                out.add((d, i))
    return out


@pytest.mark.parametrize("rows", [dc.BROADCAST_ROWS, 0])
def test_plain_texts_equal_brute_force(spark, rows):
    rng = random.Random(2)
    items = [(i, plain(rng, rng.randint(5, 30))) for i in range(12)]
    docs = []
    for d in range(60):
        words = plain(rng, rng.randint(0, 30)).split()
        if d % 2:
            q = rng.choice(items)[1].split()
            a = rng.randint(0, len(q) - 1)
            words += q[a: a + rng.randint(1, 30)] + plain(rng, rng.randint(1, 9)).split()
        docs.append((d, " ".join(words)))
    got = dc.leaks(frame(spark, [(i, t, "en", "s") for i, t in docs]), bench(spark, items), broadcast_rows=rows)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute(docs, items)


def test_short_items_at_every_offset(spark):
    rng = random.Random(4)
    items = [(n, plain(rng, n)) for n in (8, 9, 10, 12)]
    docs = [(100 * n + k, f"{plain(rng, k)} {q} {plain(rng, 5)}") for n, q in items for k in range(4)]
    assert leaked(spark, docs, items) == {(100 * n + k, n, True) for n, _ in items for k in range(4)}


def test_runs_of_half_plain_words_at_every_offset(spark):
    """No window of these runs holds more than four plain words; one at an even start of the document may hold three."""
    rng = random.Random(5)
    items = [(i, f"{plain(rng, a)} {' '.join(str(rng.randint(10, 10 ** 6)) for _ in range(6))} {plain(rng, 7 - a)}") for i, a in enumerate((2, 3, 4, 5))]
    docs = [(100 * i + k, f"{plain(rng, k)} {q} {plain(rng, 5)}") for i, q in items for k in range(4)]
    assert leaked(spark, docs, items) == {(100 * i + k, i, True) for i, _ in items for k in range(4)}


def test_one_altered_slot_does_not_hide_a_long_copy(spark):
    """Before it and behind it lie runs of 13 and more; so do words before many numbers."""
    broken = QUESTION.replace("12 kg of pears", "99 kg of pears")
    words = plain(random.Random(6), 14)
    numbers = words + " " + " ".join(str(i) for i in range(20, 50))
    docs = [(1, broken), (2, numbers), (3, words + " " + " ".join(["7"] * 30)), (4, " ".join(QUESTION.split()[5:]).replace("12", "55", 1))]
    got = {(d, i) for d, i, _ in leaked(spark, docs, [(1, QUESTION), (2, numbers)])}
    assert got == {(1, 1), (2, 2), (3, 2), (4, 1)}


def test_edge_rows(spark):
    rows = [(1, QUESTION), (2, None), (3, ""), (4, "too short"), (None, QUESTION), (5, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"), (1, QUESTION)]
    assert dc.leaks(edge_docs(spark), bench(spark, rows)).collect() == []
    assert dc.leaks(empty_docs(spark), bench(spark, rows)).collect() == []
    assert dc.leaks(edge_docs(spark), bench(spark, [])).collect() == []
    docs = frame(spark, [(7, QUESTION, "en", "s"), (7, QUESTION, "en", "s"), (None, QUESTION, "en", "s")])
    assert tuples(dc.leaks(docs, bench(spark, rows)), "doc_id", "item_id") == [(7, 1)]
    numbers = frame(spark, [(8, " ".join(str(i) for i in range(50)), "en", "s")])
    assert dc.leaks(numbers, bench(spark, rows)).collect() == []


def test_main_path_is_native(spark):
    plan = dc.leaks(edge_docs(spark), bench(spark, [(1, QUESTION)]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_templates(spark):
    df = spark.createDataFrame([("Then Maria ran 3.5 km, 10 apples and 2 Hours; the End. New one",)], "t string")
    assert df.select(dc.template(dc.tokens(df.t))).first()[0] == ["then", "<name>", "ran", "<num>", "<unit>", "<num>", "apples", "and", "<num>", "<unit>", "the", "<name>", "new", "one"]
