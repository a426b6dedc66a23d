import random

from arriero.llm import secrets
from tests.llm.helpers import frame, words


def test_planting_and_measuring_share_no_task(spark, monkeypatch):
    """Two Python nodes in one stage are two workers for each core, and they stay with the executor."""
    kind, plans = type(spark.range(1)), []
    to_pandas = kind.toPandas
    monkeypatch.setattr(kind, "toPandas", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or to_pandas(self))
    rng = random.Random(3)
    secrets.fit(frame(spark, [(i, words(rng, 40), "en", "a") for i in range(6)]))
    assert [p.count("MapInPandas") for p in plans if "MapInPandas" in p] == [1]
