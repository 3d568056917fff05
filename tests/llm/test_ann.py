import numpy as np
import pytest
from pyspark.sql import functions as F

from placelens.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, shard int"


def _brute(ids, vectors, queries, k=5):
    found = {}
    for q in queries:
        scores = [
            (-float(np.dot(vectors[q], v)) / float(np.linalg.norm(vectors[q]) * np.linalg.norm(v)), i)
            for i, v in zip(ids, vectors.values())
            if i != q
        ]
        found[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scores)[:k]]
    return found


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(8)
    near = random.standard_normal((900, 16)).astype(np.float32)
    near[300:600] = near[5]  # one very common vector
    return {i: near[i].astype(float) for i in range(900)}


def _table(spark, vectors):
    rows = [(i, [float(x) for x in v], 0, "x", 1) for i, v in vectors.items()]
    odd = [
        (None, [1.0] * 16, 0, "x", 1), (2000, None, 0, "x", 1), (2050, [], 0, "x", 1), (2100, [0.0] * 16, 0, "x", 1),
        (2150, [float("nan")] * 16, 0, "x", 1), (2200, [1.0, None] * 8, 0, "x", 1), (2250, [float("inf")] + [1.0] * 15, 0, "x", 1),
        (3000, [1.0, 2.0], 0, "x", 1), (3001, [2.0, 1.0], 0, "x", 1), (50, [float(x) for x in vectors[50]], 0, "x", 1),
    ]
    return spark.createDataFrame(rows + odd, SCHEMA)


def test_factor_one_is_exact(spark, vectors, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 16)
    monkeypatch.setattr(ann, "SHARD_ROWS", 300)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 10)
    found = {}
    for row in ann.nearest(_table(spark, vectors), F.col("id") % 50 == 0, factor=1.0).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    expected = _brute(list(vectors), vectors, [i for i in vectors if i % 50 == 0])
    assert {3000} | set(expected) == set(found)
    assert [(r, i) for r, i, _ in found.pop(3000)] == [(1, 3001)]
    for query, rows in found.items():
        assert [rank for rank, _, _ in sorted(rows)] == [1, 2, 3, 4, 5]
        assert [i for _, i, _ in sorted(rows)] == [i for i, _ in expected[query]]
        assert [s for _, _, s in sorted(rows)] == pytest.approx([s for _, s in expected[query]], abs=1e-12)


def test_recall_of_the_standard_factor(spark):
    random = np.random.default_rng(1)
    many = random.standard_normal((6000, 64))
    vectors = dict(enumerate(many))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id bigint, embedding array<double>")
    found = {}
    for row in ann.nearest(frame, F.col("id") % 50 == 0).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    expected = _brute(list(vectors), vectors, [i for i in vectors if i % 50 == 0])
    recall = np.mean([len(found[q] & {i for i, _ in rows}) / 5 for q, rows in expected.items()])
    assert recall >= 0.95


@pytest.mark.parametrize("dimensions", [5, 8, 12, "clusters"])
def test_recall_on_structured_vectors(dimensions):
    """Vectors near few dimensions, where much is pruned, and near 40 centres."""
    random = np.random.default_rng(3)
    count = 16_000
    if dimensions == "clusters":
        many = random.standard_normal((40, 64))[random.integers(40, size=count)] + 0.3 * random.standard_normal((count, 64))
    else:
        many = random.standard_normal((count, dimensions)) @ random.standard_normal((dimensions, 64))
        many += 0.05 * random.standard_normal((count, 64))
    ids = np.arange(count)
    asked = ids[::50]
    found = ann._search(asked, many[asked], ids, many, 5, ann.FACTOR).groupby("query_id")["vec_id"].apply(set)
    unit = many / np.linalg.norm(many, axis=1)[:, None]
    scores = unit[asked] @ unit.T
    scores[np.arange(len(asked)), asked] = -2
    true = np.argsort(-scores, axis=1)[:, :5]
    assert np.mean([len(found[q] & set(row)) / 5 for q, row in zip(asked, true)]) >= 0.95


@pytest.mark.parametrize("leaf", [256, 16])
def test_factor_one_is_exact_with_copies(spark, monkeypatch, leaf):
    """Every row six times."""
    monkeypatch.setattr(ann, "LEAF", leaf)
    random = np.random.default_rng(6)
    vectors = {i: random.standard_normal(8) for i in range(40)}
    rows = [(i, v.tolist()) for i, v in vectors.items() for _ in range(6)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {}
    for row in ann.nearest(frame, F.col("id") % 4 == 0, factor=1.0).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id))
    expected = _brute(list(vectors), vectors, [i for i in vectors if i % 4 == 0])
    assert {q: [i for _, i in sorted(rows)] for q, rows in found.items()} == {q: [i for i, _ in rows] for q, rows in expected.items()}


def _frame(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors], "vec_id bigint, embedding array<double>")


def _rows(found):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())


def test_tiny_and_huge_vectors(spark):
    """Squares that vanish or overflow: scores are those of the vectors in a size that fits."""
    random = np.random.default_rng(4)
    base = random.standard_normal((12, 4))
    factors = [1e-200, 1.0, 1e200, 1e-300, 1e300]
    plain = _rows(ann.nearest(_frame(spark, enumerate(base)), F.col("id") % 3 == 0))
    found = _rows(ann.nearest(_frame(spark, ((i, v * factors[i % 5]) for i, v in enumerate(base))), F.col("id") % 3 == 0))
    assert [row[:3] for row in found] == [row[:3] for row in plain]
    assert [row[3] for row in found] == pytest.approx([row[3] for row in plain], abs=1e-12)


def test_results_do_not_hang_on_the_order_of_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 200)
    monkeypatch.setattr(ann, "LEAF", 16)
    random = np.random.default_rng(9)
    vectors = list(enumerate(random.standard_normal((900, 5)) @ random.standard_normal((5, 12))))
    vectors += [(7, v) for _, v in vectors[20:30]] + vectors[:50]
    one = _rows(ann.nearest(_frame(spark, vectors), F.col("id") % 20 == 0))
    random.shuffle(vectors)
    assert _rows(ann.nearest(_frame(spark, vectors).repartition(5), F.col("id") % 20 == 0)) == one


def test_factor_one_is_exact_over_many_leaves(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 60)
    monkeypatch.setattr(ann, "LEAF", 8)
    random = np.random.default_rng(12)
    vectors = dict(enumerate(random.standard_normal((1200, 3)) @ random.standard_normal((3, 8)) + 0.01 * random.standard_normal((1200, 8))))
    found = {}
    for query, rank, vec_id, _ in _rows(ann.nearest(_frame(spark, vectors.items()), F.col("id") % 30 == 0, factor=1.0)):
        found.setdefault(query, []).append(vec_id)
    expected = _brute(list(vectors), vectors, [i for i in vectors if i % 30 == 0])
    assert found == {q: [i for i, _ in rows] for q, rows in expected.items()}


@pytest.mark.parametrize("dimensions", [3, 5, 8])
def test_leaves_a_query_reaches_and_recall(spark, monkeypatch, dimensions):
    """Near few dimensions: recall holds over the leaves, and the rows in the leaves a query reaches hardly grow with the table."""
    random = np.random.default_rng(dimensions)
    axes, seen = random.standard_normal((dimensions, 32)), []
    monkeypatch.setattr(ann, "SHARD_ROWS", 125)
    for count in (4000, 16_000):
        many = random.standard_normal((count, dimensions)) @ axes
        unit = many / np.linalg.norm(many, axis=1)[:, None]
        asked = np.arange(0, count, 200)
        scores = unit[asked] @ unit.T
        scores[np.arange(len(asked)), asked] = -2
        true = np.argsort(-scores, axis=1)[:, :5]
        routes = ann.Routes(many[:: max(1, count // ann.SAMPLE)].tolist(), count // 125)
        leaf = routes.leaf(many)
        sizes = np.bincount(leaf)
        bounds = np.array([np.sqrt(max(0, 2 - 2 * np.sort(scores[n][leaf == leaf[q]])[-5:][0])) for n, q in enumerate(asked)])
        number, reached = routes.reached(many[asked], bounds, ann.FACTOR)
        sees = [set(reached[number == n]) | {leaf[q]} for n, q in enumerate(asked)]
        assert np.mean([np.mean([leaf[i] in sees[n] for i in row]) for n, row in enumerate(true)]) >= 0.9
        seen.append(np.mean([sum(sizes[one] for one in some) for some in sees]))
    assert seen[1] < 2 * seen[0]  # four times the rows
    if dimensions == 5:
        found = {}
        for query, _, vec_id, _ in _rows(ann.nearest(_frame(spark, enumerate(many)), F.col("id") % 200 == 0)):
            found.setdefault(query, set()).add(vec_id)
        assert np.mean([len(found[q] & set(row)) / 5 for q, row in zip(asked, true.tolist())]) >= 0.9


def test_empty(spark):
    assert ann.nearest(spark.createDataFrame([], SCHEMA), F.col("id") % 50 == 0).collect() == []
