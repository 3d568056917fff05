import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from placelens.llm import periodic_runs, queries
from placelens.llm.periodic_runs import collapsed, runs, suffix_automaton


def _brute(words, least, times):
    """Every stretch of equal words one period apart, for every period in turn; the smallest period of a stretch comes first."""
    found, (_, codes) = {}, np.unique(np.array(words, dtype=object), return_inverse=True)
    for period in range(1, len(words) // times + 1):
        same = np.concatenate([[0], codes[period:] == codes[:-period], [0]])
        for start, stop in np.flatnonzero(np.diff(same)).reshape(-1, 2).tolist():
            if stop - start + period >= max(least, times * period):
                found.setdefault((start, stop - start + period), period)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda run: (run[0], run[2]))


def _smallest_period(words):
    return next(p for p in range(1, len(words) + 1) if all(words[i] == words[i + p] for i in range(len(words) - p)))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab", max_size=60) | st.text(alphabet="abc", max_size=60), st.sampled_from([(2, 2), (6, 3), (9, 3), (4, 2), (24, 3)]))
def test_all_runs(text, limits):
    words, (least, times) = list(text), limits
    expected = _brute(words, least, times)
    assert all(_smallest_period(words[start : start + length]) == period for start, length, period in expected)
    assert runs(words, least, times) == expected
    dropped = {i for s, l, p in expected for i in range(s + p, s + l)}
    assert collapsed(words, expected) == [w for i, w in enumerate(words) if i not in dropped]


def test_automaton_has_every_substring():
    words = list("abaabaabcabaab")
    link, length, prefixes = suffix_automaton(words)
    distinct = {tuple(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)}
    assert sum(length[v] - length[link[v]] for v in range(1, len(link))) == len(distinct)
    assert [length[state] for state in prefixes] == list(range(1, len(words) + 1))


@pytest.mark.parametrize("period", [1, 7, 500, 2000])
def test_long_texts(period):
    draw = random.Random(period)
    head = [f"h{draw.random()}" for _ in range(3000)]
    unit = [f"u{i}" for i in range(period)]
    body = (unit * (20_000 // period + 1))[:20_000]
    assert runs(head + body + head) == [(3000, 20_000, period)]
    assert runs([b"x"] * 50_000) == [(0, 50_000, 1)]


def test_rows(spark, odd_docs, odd_rows, no_docs):
    found = periodic_runs.periodic_runs(odd_docs).collect()
    assert sorted(str(r.id) for r in found) == sorted(str(i) for i, *_ in odd_rows)
    by_id = {r.id: r for r in found}
    line = "the quick brown fox jumps over the lazy dog and runs far away from here".split()
    assert [tuple(r) for r in by_id[8].runs] == [(0, 30_000, 15)] and by_id[8].collapsed == " ".join(line)
    assert by_id[9].collapsed == " ".join([*line, "end"])
    assert (by_id[3].words, by_id[3].runs, by_id[3].collapsed) == (0, [], "")
    assert (by_id[5].words, by_id[5].collapsed) == (0, "")
    assert periodic_runs.periodic_runs(no_docs).collect() == []


def test_query_against_brute_force(spark):
    """Every column of every document of a small table, by the contract's words alone."""
    sf_dir = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(texts)
    with_runs = 0
    for doc_id, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        every = _brute(words, 24, 3)
        with_runs += bool(every)
        row = found[doc_id]
        assert row.n_runs == len(every)
        lines = "".join(f"{s},{l},{p}\n" for s, l, p in every)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        dropped = {i for s, l, p in every for i in range(s + p, s + l)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        best = min(every, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        expected = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (row.start, row.length, row.period, row.exponent_milli) == expected
    assert with_runs >= 5


def test_best_run_is_by_exact_exponent(spark):
    """30 words of period 10 and 24 of period 8 are three periods each: the first one counts."""
    words = [f"a{i}" for i in range(10)] * 3 + [f"b{i}" for i in range(8)] * 3 + ["c"] * 24
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:54])), (3, None)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in queries.run_report(periodic_runs.periodic_runs(docs)).collect()}
    assert (found[1].n_runs, found[1].start, found[1].length, found[1].period, found[1].exponent_milli) == (3, 54, 24, 1, 24_000)
    assert (found[2].n_runs, found[2].start, found[2].length, found[2].period, found[2].exponent_milli) == (2, 0, 30, 10, 3000)
    assert found[3].start is None and found[3].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
