import hashlib
import random
from collections import Counter

import pytest

from arriero.llm import alignment
from tests.llm.helpers import edge_docs, edge_rows, empty_docs, frame, tuples, words

PAIR = alignment.Pair(*alignment.model_files())
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def whole(text):
    """Groups of a text as lists of ids, encoded as a whole."""
    if not text:
        return None
    want = (" " + text).encode()
    a, b = PAIR.a.encode(" " + text, add_special_tokens=False).ids, PAIR.b.encode(text)
    if b"".join(PAIR.bytes_a[i] for i in a) != want or b"".join(PAIR.bytes_b[i] for i in b) != want:
        return None
    ends = lambda ids, size: [sum(size[ids[:k + 1]]) for k in range(len(ids))] if len(ids) < 500 else [int(x) for x in size[ids].cumsum()]
    end_a, end_b = ends(a, PAIR.len_a), ends(b, PAIR.len_b)
    both = sorted(set(end_a) & set(end_b))
    out, i, j = [], 0, 0
    for e in both:
        x, y = end_a.index(e, i) + 1, end_b.index(e, j) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


def brute(rows):
    found = [(i, whole(t)) for i, t, *_ in rows]
    counts = Counter((a[-1], b[-1]) for _, g in found for a, b in g or [])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, g in found:
        g = g or []
        links = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


AWKWARD = ["a", " ", "  ", "a ", " a", "a  b", "a  b  ", "x\n y", "x \ny", "\n", "tab\tx \t y", "it's Tom's  'll", "<|endoftext|> <s></s> <unk> <0x41>", "▁x", "a ▁", "é́   　x",
           "漢字かな 交じり", "🙂🙂 🙂", "nul\x00 \x00", "12345 6789,00", "   lead", "trail   ", "a" * 300, "ab " * 90 + "c" * 200 + " d", "\u0085   z", "x\x1c y", "Zürich" * 40, "#$% ^&* ((", "<|endoftext|>"]


def awkward_rows():
    rng = random.Random(3)
    return [(500 + k, t, "en", "a") for k, t in enumerate(AWKWARD)] + [(700 + k, "".join(rng.choice(["a", " ", "  ", "\n", "é", "漢", "'s", "1", ".", "the", " of", "\t", " "]) for _ in range(rng.randint(1, 200))), "en", "b") for k in range(60)]


@pytest.mark.parametrize("kind, chunk_bytes, fan_in, head_pairs", [("all", alignment.CHUNK_BYTES, alignment.FAN_IN, alignment.HEAD_PAIRS), ("edge", 3000, 3, 20), ("awkward", 12, 3, 20)])
def test_rows_equal_brute_force(spark, kind, chunk_bytes, fan_in, head_pairs):
    rows = (edge_rows() if kind != "awkward" else []) + (awkward_rows() if kind != "edge" else [])
    got = alignment.align(frame(spark, rows).repartition(3), chunk_bytes=chunk_bytes, fan_in=fan_in, head_pairs=head_pairs)
    assert tuples(got, *COLUMNS) == brute(rows)


def test_empty_table(spark):
    assert alignment.align(empty_docs(spark)).collect() == []


def test_columns_do_not_clash(spark):
    docs = edge_docs(spark).selectExpr("*", "1 as uid", "'x' as n_a", "2 as codes", "false as long_text")
    assert tuples(alignment.align(docs), *COLUMNS) == brute(edge_rows())


def test_composition_is_associative():
    rng = random.Random(5)

    def join(x, y):
        have, closed = alignment.compose(x[0], y[0])
        return have, x[1] + closed + y[1]

    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", "  ", "\n", "é", "漢 "]) for _ in range(rng.randint(1, 40)))
        parts = alignment.byte_ranges(text, rng.randint(1, 9))
        assert "".join(parts) == " " + text
        leaves = []
        for p in parts:
            prefix, closed, suffix = alignment.fragment(p)
            leaves.append(((prefix, suffix), closed or []))
        while len(leaves) > 1:  # composed in any order
            k = rng.randrange(len(leaves) - 1)
            leaves[k:k + 2] = [join(leaves[k], leaves[k + 1])]
        (prefix, suffix), closed = leaves[0]
        assert [prefix, *closed, *([suffix] if suffix is not None else [])] == alignment.cuts(" " + text)


def test_long_texts_are_dealt_over_tasks(spark):
    rng = random.Random(4)
    rows = [(1, words(rng, 30000), "en", "a"), (2, "x" * 150000, "en", "a"), (3, words(rng, 15000) + "▁", "en", "a"), (1, words(rng, 9000), "en", "a")]
    got = alignment.align(frame(spark, rows), chunk_bytes=10000, fan_in=4)
    assert tuples(got, *COLUMNS) == brute(rows)
