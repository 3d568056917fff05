import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from placelens.llm import common, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes):
    """Weights in turn over the sources, shares cut at twice the size until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    capped, left = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        share = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / share > 2 * sizes[s]]
        if not over:
            return {**capped, **{s: left * weight[s] / share for s in free}}
        capped |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    found = mixing.mix(odd_docs).collect()
    sizes = Counter()
    for _, text, _, source in odd_rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets = _targets(sizes)
    expected = Counter((i, len(WORD.findall(t or "")), sizes[s], round(targets[s], 4)) for i, t, _, s in odd_rows)
    assert Counter((r.id, r.size, r.source_size, round(r.target, 4)) for r in found) == expected
    assert all(r.taken in (0, r.size, 2 * r.size) for r in found)
    assert mixing.mix(no_docs).collect() == []


@pytest.fixture(scope="module")
def corpus(spark):
    """Source `hot` has a third of all rows; lengths differ widely."""
    words = F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 37 + F.when(F.col("id") % 41 == 0, 200).otherwise(1)).cast("int")), " ")
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string")))
    return spark.range(3000).select(F.col("id").alias("doc_id"), words.alias("text"), source.alias("source"), (F.col("id") + 1).alias("key"))


def test_targets_are_met_and_reruns_agree(corpus):
    found = mixing.mix(corpus).collect()
    sizes, taken, target = Counter(), Counter(), {}
    by_id = {row.doc_id: row.source for row in corpus.select("doc_id", "source").collect()}
    for row in found:
        source = by_id[row.id]
        sizes[source] += row.size
        taken[source] += row.taken
        target[source] = row.target
        assert 0 <= row.taken <= 2 * row.size
    expected = _targets(sizes)
    for source, goal in target.items():
        assert goal == pytest.approx(expected[source])
        assert abs(taken[source] - goal) <= max(0.002 * goal, 2)
    rates = defaultdict(set)
    for row in found:
        rates[by_id[row.id], row.size].add(row.rate)
    assert all(len(some) == 1 for some in rates.values())  # the rate hangs on source and size alone
    again = mixing.mix(corpus.repartition(7)).collect()
    assert {(r.id, r.taken) for r in again} == {(r.id, r.taken) for r in found}
    rows = mixing.mixed_rows(corpus)
    assert rows.columns == corpus.columns
    copies = Counter(row.doc_id for row in rows.collect())
    assert copies == Counter({r.id: r.taken // r.size for r in found if r.taken})


def test_rows_of_odd_tables(odd_docs, no_docs):
    rows = mixing.mixed_rows(odd_docs)
    assert rows.columns == odd_docs.columns
    assert all(WORD.search(row.text) for row in rows.collect())
    assert mixing.mixed_rows(no_docs).collect() == []


@pytest.mark.parametrize("small", [False, True])
def test_repeated_rows_meet_the_target(spark, monkeypatch, small):
    """200 copies of one row next to a large source: some of them come twice, some once; reruns agree."""
    if small:
        monkeypatch.setattr(common, "fits_broadcast", lambda df, **_: False)
        monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    rows = [(1, "a b c d e", "copies", n % 2) for n in range(200)] + [(None, "x y", "null ids", 1)] * 50
    rows += [(10 + n, "w " * (n % 9 + 1), "plain", 1) for n in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars int")
    found = mixing.mix(docs).collect()
    taken, goal, longest = Counter(), {}, Counter()
    for row in found:
        source = {1: "copies", None: "null ids"}.get(row.id, "plain")
        taken[source] += row.taken
        goal[source] = row.target
        longest[source] = max(longest[source], row.size)
        assert row.taken in (0, row.size, 2 * row.size)
    assert all(abs(taken[s] - goal[s]) <= max(longest[s], 0.002 * goal[s]) for s in goal)
    assert any(row.copies == 1 for row in found if row.id == 1) or goal["copies"] in (0, 2000)
    again = mixing.mix(docs.repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    copies = Counter(row.doc_id for row in mixing.mixed_rows(docs).collect())
    expected = Counter()
    for row in found:
        expected[row.id] += row.copies
    assert copies == Counter({i: n for i, n in expected.items() if n})


def test_rates_solve_the_dual(corpus):
    """Tilts against a plain bisection in Python: rates of every document, and the whole parts of its copies."""
    found = mixing.mix(corpus).collect()
    by_id = {row.doc_id: row.source for row in corpus.select("doc_id", "source").collect()}
    sizes = defaultdict(list)
    for row in found:
        sizes[by_id[row.id]].append(row)
    for rows in sizes.values():
        total, goal = sum(r.size for r in rows), rows[0].target
        mean, low, high = total / len(rows), -60.0, 60.0
        for _ in range(200):
            tilt = (low + high) / 2
            got = sum(r.size * 2 / (1 + math.exp(-tilt * r.size / mean)) for r in rows)
            low, high = (tilt, high) if got < goal else (low, tilt)
        for row in rows:
            rate = 2.0 if goal >= 2 * total else 2 / (1 + math.exp(-tilt * row.size / mean))
            assert row.rate == pytest.approx(rate, abs=2e-3)
            assert int(row.rate) <= row.copies <= min(2, int(row.rate) + 1)
