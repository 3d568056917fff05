from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from placelens.llm import toxicity
from placelens.llm.common import stored, table
from placelens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def _brute(emission, moves):
    """Marginals by summing over all state sequences."""
    total, toxic = 0.0, np.zeros(len(emission))
    for states in product((0, 1), repeat=len(emission)):
        weight = np.prod([e if s else 1.0 for e, s in zip(emission, states)])
        weight *= np.prod([moves[a][b] for a, b in zip(states, states[1:])])
        total += weight
        toxic += weight * np.array(states)
    return toxic / total


def test_marginals_and_expected_moves():
    random = np.random.default_rng(2)
    moves = np.exp(random.normal(size=(2, 2)))
    lengths = np.array([6, 4, 4, 1])
    emission = np.exp(random.normal(size=(6, 4)))
    found = toxicity.marginals(emission, moves, lengths)
    for chain, length in enumerate(lengths):
        assert found[:length, chain] == pytest.approx(_brute(emission[:length, chain], moves))
        assert not found[length:, chain].any()
    pairs = toxicity.Chain._pairs(emission, moves, np.ones(4))
    assert pairs.sum() == pytest.approx(4 * 5)
    whole = toxicity.marginals(emission, moves, np.full(4, 6))
    assert pairs[:, 1].sum() == pytest.approx(whole[1:].sum())


def test_spans():
    text = "You, stupid ugly thing: go"
    spans = toxicity._spans(text, np.array([0.1, 0.9, 0.8, 0.2, 0.6]))
    assert [text[s["start"] : s["end"]] for s in spans] == ["stupid ugly", "go"]
    assert [s["score"] for s in spans] == [0.9, 0.6]


def test_planted_words_are_found(spark, odd_docs, odd_rows, no_docs):
    random = np.random.default_rng(4)
    words = ["w" + "".join(random.choice(list("abcdefgh"), 5)) for _ in range(300)]
    rows = []
    for i in range(400):
        some = random.choice(words, 40).tolist()
        if i % 8 == 0:
            some[random.integers(40)] = random.choice(["nasty", "vile", "rotten"])
        rows.append((i, " ".join(some), int(i % 8 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = docs.select("doc_id", "toxic").union(spark.createDataFrame([(3, None), (None, 1)], "doc_id bigint, toxic int"))
    model = toxicity.train(stored(toxicity.labelled(docs.drop("toxic").where("doc_id % 5 <> 0"), labels), "labelled"))
    found = {r.id: r for r in toxicity.score(docs, model).collect()}
    texts = {i: text for i, text, _ in rows}
    assert all((found[i].score >= 0.5) == bool(toxic) for i, _, toxic in rows)
    for i, _, toxic in rows:
        assert {texts[i][s.start : s.end] for s in found[i].spans} <= {"nasty", "vile", "rotten"}
    odd = toxicity.score(odd_docs, model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score < 0.5 and not r.spans for r in odd)
    assert [r.score for r in odd if r.id in (3, 4, 5)] == [0, 0, 0]
    assert toxicity.score(no_docs, model).collect() == []
    nothing = stored(toxicity.labelled(no_docs, labels), "labelled")
    assert toxicity.train(nothing) is None
    assert {r.score for r in toxicity.score(odd_docs, None).collect()} == {0.0}


def test_held_out(spark):
    found = QUERIES["op10_toxicity"](spark, SF_DIR).join(table(spark, SF_DIR, "labels").select("doc_id", "toxic"), "doc_id")
    english = table(spark, SF_DIR, "documents").where("lang = 'en'").select("doc_id")
    rows = found.join(english, "doc_id").where(F.col("held_out") & F.col("toxic").isNotNull()).collect()
    assert sum(r.toxic for r in rows) >= 3
    assert sum(r.toxic == r.predicted for r in rows) >= 0.97 * len(rows)


def test_sample_of_kinds(spark):
    """The commonest kind is always in the sample, weights stand for all kinds, and few kinds are taken as they are."""
    rows = [(n.to_bytes(4, "big"), b"0", 5000 if n == 7 else 1 + n % 3) for n in range(4000)]
    kinds = spark.createDataFrame(rows, "classes binary, labels binary, times bigint")
    total, some = sum(r[2] for r in rows), toxicity.sampled(kinds, 500)
    assert len(some) == 500 and (7).to_bytes(4, "big") in set(map(bytes, some["classes"]))
    assert some["weight"].sum() == pytest.approx(total, rel=0.1)
    every = toxicity.sampled(kinds, 4000)
    assert len(every) == 4000 and every["weight"].sum() == total


def _plain_scores(texts, lexicon, chain):
    """The highest marginal of every text, one state sequence recursion at a time in logarithms."""
    out = []
    table, moves = chain.table(), chain.moves
    for text in texts:
        words = toxicity._WORDS.findall(text or "")
        classes = [max(lexicon.get(f, 0) for f in toxicity._features(word)) for word in words]
        if not words:
            out.append(0.0)
            continue
        around = [0, *classes, 0]
        emission = [np.log(table[own + toxicity.CLASSES * a + toxicity.CLASSES**2 * b]) for a, own, b in zip(around, classes, around[2:])]
        ahead, back = [[0.0, emission[0]]], [[0.0, 0.0]]
        for e in emission[1:]:
            ahead.append([np.logaddexp(ahead[-1][0] + moves[0, s], ahead[-1][1] + moves[1, s]) + s * e for s in (0, 1)])
        for e in reversed(emission[1:]):
            back.append([np.logaddexp(moves[s, 0] + back[-1][0], moves[s, 1] + e + back[-1][1]) for s in (0, 1)])
        both = [(f[0] + b[0], f[1] + b[1]) for f, b in zip(ahead, reversed(back))]
        out.append(max(1 / (1 + np.exp(clean - toxic)) for clean, toxic in both))
    return out


@pytest.mark.parametrize("limit", [toxicity.LEXICON_BYTES, 0])
def test_whole_results_with_a_held_and_a_joined_lexicon(spark, odd_docs, monkeypatch, limit):
    random = np.random.default_rng(7)
    words = [f"{a}{b}rd{c}" for a in "wmn" for b in "aeiou" for c in "xyz"]
    rows = []
    for i in range(300):
        some = random.choice(words, 30).tolist()
        if i % 5 == 0:
            some[:2] = random.choice(["nasty", "Vile", "rotten", "rotter"], 2).tolist()
        rows.append((i, " ".join(some), int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    monkeypatch.setattr(toxicity, "LEXICON_BYTES", limit)
    lexicon, chain = toxicity.train(stored(toxicity.labelled(docs.drop("toxic"), docs.select("doc_id", "toxic")), "labelled"))
    classes = {r["feature"]: r["class"] for r in lexicon.collect()}
    assert {"nasty$", "vile$", "rotten$"} <= set(classes)
    asked = docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", F.substring("text", 1, 2000).alias("text")))
    texts = asked.collect()
    found = toxicity.score(asked, (lexicon, chain)).collect()
    plain = sorted(zip([str(r.doc_id) for r in texts], _plain_scores([r.text for r in texts], classes, chain)))
    assert [i for i, _ in plain] == sorted(str(r.id) for r in found)
    assert [s for _, s in plain] == pytest.approx([s for _, s in sorted((str(r.id), r.score) for r in found)], abs=1e-9)
