import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from placelens.llm import url_rules
from placelens.llm.common import LOWER, UPPER
from placelens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
PLAIN = str.maketrans(UPPER, LOWER)


def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(PLAIN), re.match(r"[^?#]*", rest[len(host):])[0]


def _rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


ODD = [
    (1, "HTTP://A.Example.NET/en/x"), (2, "http://example.net/EN/"), (3, None), (4, ""), (5, "no scheme/net/"), (6, "a://b://net/"),
    (7, "https://net"), (8, "https://net/"), (9, "https://xnet/"), (10, "https://x.example.com/de/\nb?q=1#f"),
    (10, "https://x.example.com/de/\nb?q=1#f"), (None, "https://org/fr/"), (11, "https://org?x=/fr/"), (12, "https://ÄB.net/%20"),
    (13, "https://q.org/" + "a/" * 30_000), (14, "://"), (15, "https:///net/"), (16, "http://free.example.com/x"),
]


def test_rules_and_odd_rows(spark):
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in ODD], "page_id bigint, url string, host string, tokens string")
    found = url_rules.judged(pages).collect()
    expected = sorted(((i, *_split(u), _rule(*_split(u))[0]) for i, u in ODD), key=str)
    assert sorted(((r.id, r.host, r.path, r.rule) for r in found), key=str) == expected
    for row in found:
        told = _rule(row.host, row.path)[1]
        assert row.verdict in ("allow", "block") and (told is None or row.verdict == told)
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert url_rules.judged(empty).collect() == []
    unlabelled = spark.createDataFrame([(1, "https://a.example.org/x")], "page_id bigint, url string")
    assert [r.verdict for r in url_rules.judged(unlabelled).collect()] == ["allow"]


def test_mined_rules_against_all_combinations(spark):
    rows = [(["a", "b", "c"], "block")] * 30 + [(["a", "b"], "block")] * 20 + [(["a", "d"], "allow")] * 25
    rows += [(["d"], "allow")] * 20 + [(["b", "d"], "allow")] * 3 + [(["b", "d"], "block")] * 2
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    found = {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in url_rules.mine(labelled, 0.01, 0.8).collect()}
    words = sorted({t for some, _ in rows for t in some})
    all_rules = {}
    for size in range(1, len(words) + 1):
        for some in combinations(words, size):
            having = [v for tokens, v in rows if set(some) <= set(tokens)]
            for verdict in ("allow", "block"):
                n = having.count(verdict)
                if n >= 0.01 * len(rows) and n >= 0.8 * len(having):
                    all_rules[some, verdict] = (n / len(having), n / len(rows))
    expected = {
        (some, verdict): value
        for (some, verdict), value in all_rules.items()
        if not any(set(t) < set(some) and v == verdict and c[0] >= value[0] for (t, v), c in all_rules.items())
    }
    assert set(found) == set(expected)
    for key, value in found.items():
        assert value == pytest.approx(expected[key])


def test_inverted_index_finds_the_best_rule(spark):
    rules = spark.createDataFrame(
        [("r1", ["a"], "allow", 0.8, 0.5), ("r2", ["a", "b"], "block", 0.9, 0.1), ("r3", ["c"], "allow", 0.9, 0.2)],
        "rule_id string, tokens array<string>, verdict string, confidence double, support double",
    )
    sets = spark.createDataFrame([("1", ["a"]), ("2", ["a", "b"]), ("3", ["a", "b", "c"]), ("4", ["z"])], "set_id string, tokens array<string>")
    assert {r.set_id: r.verdict for r in url_rules.matched(sets, rules).collect()} == {"1": "allow", "2": "block", "3": "allow"}


def test_every_frequent_token_is_mined(spark):
    """40 spam segments in 10 URLs each, all with the same counts; twins stand together when labelled, alone when open."""
    urls = [f"https://h{i}.example.com/de/spam{i % 40}/twin{i % 40}" for i in range(400)]
    urls += [f"https://h{i}.example.org/fr/page{i}" for i in range(600)]
    undecided = [f"https://x.test/{word}{i}" for i in range(40) for word in ("spam", "twin")]
    pages = spark.createDataFrame(list(enumerate(urls + undecided)), "page_id bigint, url string")
    found = {r.id: r for r in url_rules.judged(pages).collect()}
    assert all(found[1000 + i].verdict == "block" and found[1000 + i].mined for i in range(80))


def _model(labelled, support, confidence):
    """Rules of a small table by trying all combinations of tokens; labelled: [(tokens, verdict)]."""
    words = sorted({t for some, _ in labelled for t in some})
    rules = {}
    for size in range(1, len(words) + 1):
        for some in combinations(words, size):
            having = [v for tokens, v in labelled if set(some) <= set(tokens)]
            for verdict in ("allow", "block"):
                n = having.count(verdict)
                if n >= support * len(labelled) and n >= confidence * len(having):
                    rules[some, verdict] = (n / len(having), n / len(labelled))
    return {k: c for k, c in rules.items() if not any(set(t) < set(k[0]) and v == k[1] and d[0] >= c[0] for (t, v), d in rules.items())}


def _near_template(urls, keys, host, path, lack):
    """URLs of one site that have all keys but one in `lack` of them."""
    return [f"https://{host}/{path}/p{i}?" + "&".join(f"{k}=1" for at, k in enumerate(keys) if i % lack != at) for i in range(urls)]


def test_near_templates_against_brute_force(spark):
    """Keys that nearly always come together, some of one verdict, some of both: mined rules and the verdicts of undecided pages."""
    both, spam = ["a", "b", "c"], ["x", "y", "z"]
    urls = _near_template(60, both + spam, "s.example.com", "de", 9)  # of a and b an allowed page has only one
    urls += [f"https://s.example.org/fr/p{i}?{'ab'[i % 2]}=1" + "&c=1" * (i % 11 != 0) for i in range(80)]
    undecided = [f"https://q.test/?{'&'.join(k + '=2' for k in some)}" for n in range(7) for some in combinations(both + spam, n)]
    pages = spark.createDataFrame(list(enumerate(urls + undecided)), "page_id bigint, url string")
    parsed = url_rules.parsed(pages)
    some = parsed.select("id", "known.verdict", url_rules.tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    rows = some.collect()
    labelled = [(r.tokens, r.verdict) for r in rows if r.verdict]
    frequent = {t for tokens, _ in labelled for t in tokens if sum(t in other for other, _ in labelled) >= 0.05 * len(labelled)}
    groups = {}
    for t in sorted(frequent):
        groups.setdefault(tuple(t in tokens for tokens, _ in labelled), t)
    kind = {t: groups[tuple(t in tokens for tokens, _ in labelled)] for t in frequent}
    baskets = [(sorted({kind[t] for t in tokens if t in kind}), verdict) for tokens, verdict in labelled]
    expected = _model(baskets, 0.05, 0.8)
    table = spark.createDataFrame(labelled, "tokens array<string>, verdict string")
    names = url_rules.kinds(table, 0.05)
    rules = url_rules.mine(table, 0.05, 0.8, names)
    assert {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in rules.collect()} == {k: pytest.approx(v) for k, v in expected.items()}
    assert any(len(tokens) > 1 for tokens, _ in expected)
    sets = spark.createDataFrame([(str(r.id), r.tokens) for r in rows if not r.verdict], "set_id string, tokens array<string>")
    verdicts = {r.set_id: r.verdict for r in url_rules.matched(sets, rules, names).collect()}
    for row in rows:
        if not row.verdict:
            own = {kind[t] for t in row.tokens if t in kind}
            fits = [(c, s, len(t), v, " ".join([*t, v])) for (t, v), (c, s) in expected.items() if set(t) <= own]
            assert verdicts.get(str(row.id)) == (max(fits, key=lambda f: (round(f[0], 12), round(f[1], 12), *f[2:]))[3] if fits else None)


@pytest.mark.parametrize("shared", [False, True])
def test_templates_of_many_keys_end(spark, shared):
    """40 query keys, each left out by a few URLs: of one verdict, and of a site with either verdict."""
    keys = [f"k{i}" for i in range(40)]
    urls = _near_template(400, keys, "s.example.com", "de", 57) + _near_template(400, keys if shared else ["o"], "s.example.org", "fr", 57)
    undecided = ["https://q.test/?k7=1&k9=2", "https://q.test/?o=1"]
    pages = spark.createDataFrame(list(enumerate(urls + undecided)), "page_id bigint, url string")
    found = {r.id: r for r in url_rules.judged(pages).collect()}
    assert (found[800].verdict, found[800].mined) == (("allow", False) if shared else ("block", True))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_search_against_all_combinations(spark, monkeypatch, seed):
    """Random tables with copies and an item that every row has: verdicts of all token sets by FP-growth and by the search, against all combinations."""
    draw = random.Random(seed)
    rows = []
    for _ in range(150):
        some = {"always"} | {word for word in "abcdefg" if draw.random() < 0.55}
        odds = 0.9 if {"a", "b"} <= some else 0.15 if "c" in some else 0.5
        rows += [(sorted(some), "block" if draw.random() < odds else "allow")] * draw.choice([1, 1, 3])
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    expected = _model(rows, 0.02, 0.7)
    assert max(len(tokens) for tokens, _ in expected) > 2
    sets = [some for n in range(1, 9) for some in combinations(["a", "always", *"bcdefg"], n)]
    best = {}
    for at, some in enumerate(sets):
        fits = [(round(c, 12), round(n, 12), len(t), v) for (t, v), (c, n) in expected.items() if set(t) <= set(some)]
        best |= {str(at): max(fits)[3]} if fits else {}
    asked = spark.createDataFrame([(str(at), list(some)) for at, some in enumerate(sets)], "set_id string, tokens array<string>")
    names = url_rules.kinds(labelled, 0.02)
    for most in (10, 1):
        monkeypatch.setattr(url_rules, "OPEN", most)
        rules = url_rules.mine(labelled, 0.02, 0.7, names)
        found = {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in rules.collect()}
        assert found == {k: pytest.approx(v) for k, v in expected.items() if most == 10 or k in found}
        assert {r.set_id: r.verdict for r in url_rules.matched(asked, rules, names).collect()} == best


@pytest.mark.parametrize("rows", [800, 8000])
def test_noisy_templates_end(spark, rows):
    """40 keys that URLs of either verdict lack at random, and x and y, which tell only together."""
    draw = random.Random(1)
    some = [[f"k{at}" for at in range(40) if draw.random() >= 0.02] + [key for key in "xy" if draw.random() < 0.5] for _ in range(rows)]
    labelled = [(tokens, "block" if draw.random() < (0.95 if {"x", "y"} <= set(tokens) else 0.4) else "allow") for tokens in some]
    table = spark.createDataFrame(labelled, "tokens array<string>, verdict string")
    found = {(tuple(r.tokens), r.verdict): r.confidence for r in url_rules.mine(table).collect()}
    both = [verdict for tokens, verdict in labelled if {"x", "y"} <= set(tokens)]
    assert found[("x", "y"), "block"] == pytest.approx(both.count("block") / len(both))
    assert all({"x", "y"} < set(tokens) for tokens, _ in found if tokens != ("x", "y"))


def test_every_kind_of_a_url_counts(spark):
    """x and y tell only together, and every URL that has both has eleven kinds that tell more than either."""
    keys = [f"t{i:02}" for i in range(12)]
    urls = [f"{url}&x=1&y=1" for url in _near_template(60, keys, "s.example.com", "de", 12)] + _near_template(24, keys, "s.example.org", "fr", 12)
    urls += [f"https://s.example.org/fr/{key}{i}?{key}=1" for key in "xy" for i in range(30)]
    undecided = ["https://q.test/?x=1&y=2", "https://q.test/?t03=1&x=2&y=3", "https://q.test/?t03=1&t04=2"]
    pages = spark.createDataFrame(list(enumerate(urls + undecided)), "page_id bigint, url string")
    found = {r.id: (r.verdict, r.mined) for r in url_rules.judged(pages).collect()}
    assert [found[len(urls) + i] for i in range(3)] == [("block", True), ("block", True), ("allow", False)]


def test_query(spark):
    found = QUERIES["op9_url_rules"](spark, SF_DIR)
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = found.collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    assert all((r.host, r.path) == _split(pages[r.page_id]) and r.rule == _rule(r.host, r.path)[0] for r in rows)
    assert any(r.mined for r in rows)
