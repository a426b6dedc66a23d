import pytest

from arriero.llm import prefilter


@pytest.mark.parametrize("most_bits", [prefilter.MOST_BITS, 64])
def test_nothing_with_a_partner_is_rejected(spark, monkeypatch, most_bits):
    """Also when the filter is far too small for its keys; then it just rejects less."""
    monkeypatch.setattr(prefilter, "MOST_BITS", most_bits)
    keys = spark.range(0, 3000, 3).selectExpr("id k").union(spark.createDataFrame([(None,), (-5,)], "k long"))
    rows = spark.range(-10, 3000).selectExpr("id v", "'x' filter_place2").union(spark.createDataFrame([(None, "n")], "v long, filter_place2 string"))
    got = prefilter.with_possible_match(rows, "v", keys, "k", "flag").collect()
    assert len(got) == 3011
    flags = {r.v: r.flag for r in got}
    assert all(flags[i] for i in [*range(0, 3000, 3), -5]) and flags[None] is False
    rejected = sum(not f for f in flags.values())
    assert rejected > 1700 if most_bits > 64 else rejected >= 1


def test_no_keys(spark):
    got = prefilter.with_possible_match(spark.range(5), "id", spark.range(0).selectExpr("id k"), "k", "flag").collect()
    assert [r.flag for r in got] == [False] * 5
