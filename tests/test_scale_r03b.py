"""Order facts in few columns, and pairs that are shuffled once."""

from decimal import Decimal

from arriero.operators import concentration as conc
from arriero.plans import registry

FACT = "mes string, sk_organismo bigint, sk_proveedor bigint, monto_total_oc_clp decimal(20,4), es_trato_directo boolean, es_compra_agil boolean"
AGENCY = "sk_organismo bigint, codigo_organismo string, nombre_organismo string, sector string"
SUPPLIER = "sk_proveedor bigint, codigo_proveedor string, nombre_proveedor string, rut_proveedor string"


def star(spark, suppliers):
    fact = spark.createDataFrame([("2026-01", 1, sk, Decimal(sk), sk == 10, False) for sk in (10, 10, 11, 12, 13, 14)], FACT)
    return fact, spark.createDataFrame([(1, "1", "org", "s")], AGENCY), spark.createDataFrame(suppliers, SUPPLIER)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_codes_with_one_row_are_not_summed_again(spark):
    fact, agency, supplier = star(spark, [(10, "a", "A", "1"), (12, "b", "B", None), (13, None, "N", "3")])
    got = conc.star_pair_totals(fact, agency, supplier)
    assert plan(got).count("SortAggregate") == 0
    assert sorted((r.codigo_proveedor or "", r.monto_clp, r.ordenes, r.nombre_proveedor, r.rut_proveedor, r.monto_trato_directo_clp) for r in got.collect()) == [
        ("", 13, 1, "N", "3", 0), ("a", 20, 2, "A", "1", 20), ("b", 12, 1, "B", None, 0)]


def test_versions_of_a_code_are_one_pair_and_others_stay(spark):
    fact, agency, supplier = star(spark, [(10, "a", "A", "1"), (11, "a", "Z", None), (12, "b", "B", "2"), (13, None, "N", "3"), (14, None, "M", "4")])
    got = conc.star_pair_totals(fact, agency, supplier)
    assert sorted((r.codigo_proveedor or "", r.monto_clp, r.ordenes, r.nombre_proveedor, r.rut_proveedor) for r in got.collect()) == [
        ("", 27, 2, "N", "4"), ("a", 31, 3, "Z", "1"), ("b", 12, 1, "B", "2")]
    doubled = conc.star_pair_totals(fact, agency.union(agency), supplier).where("codigo_proveedor = 'b'").first()
    assert (doubled.monto_clp, doubled.ordenes) == (24, 2)  # a key with two rows joins twice, as before


def test_order_facts_come_from_a_stage_without_item_columns(spark, sf):
    assert not set(registry.star_inputs(spark, sf, items=False)[0].columns) & set(registry.ITEM_ONLY)
    assert set(registry.ITEM_ONLY) <= set(registry.star_inputs(spark, sf)[0].columns)
