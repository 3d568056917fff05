import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from placelens.llm import exact_dedup
from placelens.llm.common import LOWER, UPPER

PLAIN = str.maketrans(UPPER, LOWER)


def _normal(text):
    return (text or "").translate(PLAIN)


def _expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[_normal(text)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        for i in ids:
            out[i, best, len(ids), i == best, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def test_verdicts(odd_docs, odd_rows, no_docs):
    found = exact_dedup.verdicts(odd_docs).select("id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert Counter(map(tuple, found)) == _expected(odd_rows)
    assert exact_dedup.verdicts(no_docs).collect() == []


def test_one_row_of_each_text_stays(odd_docs, odd_rows, no_docs):
    kept = exact_dedup.survivors(odd_docs)
    assert kept.columns == odd_docs.columns
    found = [(row.doc_id, _normal(row.text)) for row in kept.select("doc_id", "text").collect()]
    assert len(found) == len({_normal(text) for _, text, *_ in odd_rows}) == len({text for _, text in found})
    assert (2, "alpha beta gamma delta epsilon") in found
    assert exact_dedup.survivors(no_docs).collect() == []


def test_a_busy_text_is_salted(spark):
    """A text of a third of all rows leaves a task once, and at most `salts` of its winners meet."""
    docs = spark.range(3000, numPartitions=16).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_dedup.verdicts(docs)
    assert found.where("text_sha256 = sha2('same', 256)").select("group_size", "keep_id").distinct().collect() == [(1000, 2997)]
    assert found.where("kept").count() == 2001


def test_equal_digests_do_not_make_texts_equal(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: F.concat(F.lit("d"), F.length(column).cast("string")))
    docs = spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "AB")], "doc_id bigint, text string")
    found = {row.id: (row.keep_id, row.group_size) for row in exact_dedup.verdicts(docs).collect()}
    assert found == {1: (3, 2), 3: (3, 2), 2: (2, 1)}
