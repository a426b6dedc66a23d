"""Tax-id helpers and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arriero.functions.text import _col

# Tax ids below this number belong to natural persons; the mask shown instead of their name.
NATURAL_PERSON_BELOW = 50_000_000
MASKED_NAME = "PERSONA NATURAL"


def is_natural_person(tax_id: Column | str, below: int = NATURAL_PERSON_BELOW) -> Column:
    """Whether the number before the dash, dots removed, is under ``below``; NULL when it is no number."""
    number = F.substring_index(F.replace(_col(tax_id), F.lit("."), F.lit("")), "-", 1)
    return number.try_cast("bigint") < F.lit(below)


def pseudonym(tax_id: Column | str, key: str) -> Column:
    """Keyed SHA-256 token (hex) of the id reduced to its digits and ``K``; stable across spellings."""
    core = F.regexp_replace(F.upper(_col(tax_id)), "[^0-9K]", "")
    return F.sha2(F.concat(F.lit(key), core), 256)


def surrogate_key(*cols: Column | str) -> Column:
    """BIGINT key hashed from the natural key.

    Needs no sequence and no single-task numbering, and gives the same key on a rerun or a retried task. Hashes can
    collide, so the integrity suite checks uniqueness before a load is made visible.
    """
    return F.xxhash64(*[_col(c) for c in cols])
