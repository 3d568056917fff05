"""Results where no side of a join fits a broadcast, so all of them meet in sort-merge joins."""

from collections import Counter

import pytest

from placelens.llm import ann, common, mixing, queries
from placelens.operators import joins

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["op1_exact_dedup", "op3_sharding", "op4_simhash", "op5_mixing", "op6_nearest", "op9_url_rules", "op11_embedding_dedup"]


@pytest.mark.parametrize("name", NAMES)
def test_same_results_without_broadcasts(spark, monkeypatch, name):
    query, watched = queries.QUERIES[name], []
    expected = Counter(map(tuple, query(spark, SF_DIR).collect()))
    real = joins.sized

    def sized(side, fits):
        watched.append(fits)
        return real(side, fits)

    for module in (ann, common, mixing):  # they hold it under their own name
        monkeypatch.setattr(module, "sized", sized)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    assert Counter(map(tuple, query(spark, SF_DIR).collect())) == expected
    assert watched and not any(watched)
