"""The registered queries against their DuckDB text, and their columns by contract."""

import duckdb
import pytest

from arriero.llm.oracle import ORACLE
from arriero.llm.queries import QUERIES
from tools.check_oracle import TABLES, compare

COLUMNS = {
    "op2": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], "op4": ["doc_id", "held_out", "score", "predicted"], "op5": ["query_id", "rank", "vec_id", "score"],
    "op6": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], "op7": ["doc_id", "size", "source_size", "target", "taken"],
    "op8": ["page_id", "host", "path", "rule", "verdict"], "op9": ["doc_id", "held_out", "lang_pred", "score"], "op10": ["doc_id", "n_shingles", "component_id", "kept"],
    "op11": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"], "op12": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op13": ["doc_id", "n_shingles", "component_id"],
}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    if name in ORACLE:
        ok, text = compare(spark, duck, name, sf)
        assert ok, text
    else:
        assert QUERIES[name](spark, sf).count() > 0
    want = COLUMNS.get(name.split("_")[0])
    assert want is None or [c for c in QUERIES[name](spark, sf).columns if c in want] == want
