import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from placelens.llm import alignment, queries
from placelens.llm.alignment import Alignment, Csr, product, side

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
OWN_A = Tokenizer.from_file(A_FILE)
OWN_A.encode_special_tokens = True
OWN_B = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
ODD = ["", "a", " a", "  two  spaces ", "naïve café 中文 🙂\n\ttab", "a▁b", "<|endoftext|> <s> </s> <0x41> <unk>", "\x00\x1c\x85 ", "ﬁ ½ é", "x" * 5000]


def _byte_of():
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


BYTE_OF = _byte_of()


def _brute(text):
    """(a ids, a ranges, b ids, b ranges) with the tokenizers' own libraries; four empty lists without tokens."""
    if not text:
        return [], [], [], []
    whole = b" " + text.encode()
    a = OWN_A.encode(" " + text, add_special_tokens=False).ids
    b = OWN_B.encode(text)
    a_bytes = [bytes(BYTE_OF[c] for c in OWN_A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(p[3:5], 16)]) if OWN_B.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, OWN_B.id_to_piece(i)) for i in b)]
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], [], [], []

    def ranges(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return [(end - len(p), end) for end, p in zip(ends, parts)]

    return a, ranges(a_bytes), b, ranges(b_bytes)


def _report(texts):
    """The contract's columns by pairs of ranges, for [(id, text)]."""
    tokens = [(i, *_brute(text)) for i, text in texts]
    links = [[(x, y) for x, (_, e) in enumerate(ar) for y, (_, f) in enumerate(br) if e == f] for _, _, ar, _, br in tokens]
    counts = Counter((a[x], b[y]) for (_, a, _, b, _), pairs in zip(tokens, links) for x, y in pairs)
    highest = {}
    for (_, second), count in counts.items():
        highest[second] = max(count, highest.get(second, 0))
    out = []
    for (i, a, ar, b, br), pairs in zip(tokens, links):
        cuts = sorted({e for _, e in ar} & {f for _, f in br})
        groups, low = [], 0
        for cut in cuts:
            sides = (",".join(str(n) for n, (_, e) in zip(ids, rs) if low < e <= cut) for ids, rs in ((a, ar), (b, br)))
            groups.append("|".join(sides))
            low = cut
        here = [counts[a[x], b[y]] for x, y in pairs]
        best = sum(counts[a[x], b[y]] == highest[b[y]] for x, y in pairs)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(cuts), len(pairs), best, sum(here), digest))
    return sorted(out, key=str)


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _found(df, id_col="id"):
    return sorted((tuple(row) for row in df.select(id_col, *COLUMNS).collect()), key=str)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab1'.,é \n▁中<|>🙂", max_size=40) | st.sampled_from(ODD))
def test_links_of_one_text(text):
    found = Alignment(text, side(A_FILE), side(B_FILE))
    a, ar, b, br = _brute(text)
    assert (found.a.tolist(), found.b.tolist()) == (a, b)
    shared = {(x, y): min(e, f) - max(s, t) for x, (s, e) in enumerate(ar) for y, (t, f) in enumerate(br) if min(e, f) > max(s, t)}
    assert {(x, y): n for x, y, n in zip(*(p.tolist() for p in found.overlaps()))} == shared
    assert list(zip(*(p.tolist() for p in found.together()[:2]))) == [(x, y) for x, y in sorted(shared) if ar[x][1] == br[y][1]]
    cuts = sorted({e for _, e in ar} & {f for _, f in br})
    one, other = ([sum(cut < end for cut in cuts) for _, end in ranges] for ranges in (ar, br))
    same = [(x, y) for x, group in enumerate(one) for y in range(len(other)) if other[y] == group]
    assert list(zip(*(p.tolist() for p in found.sharing()[:2]))) == same


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 6), st.integers(1, 6), st.integers(0, 6), st.randoms(use_true_random=False))
def test_product_of_any_matrices(rows, inner, columns, draw):
    left = np.array([[draw.random() < 0.4 for _ in range(inner)] for _ in range(rows)], dtype=int).reshape(rows, inner)
    right = np.array([[draw.random() < 0.4 for _ in range(columns)] for _ in range(inner)], dtype=int).reshape(inner, columns)

    def csr(dense):
        return Csr(np.concatenate([[0], np.cumsum(dense.sum(axis=1))]), np.nonzero(dense)[1], dense.shape[1])

    whole = left @ right
    expected = [(x, y, whole[x, y]) for x, y in zip(*np.nonzero(whole))]
    assert list(zip(*product(csr(left), csr(right)))) == expected
    assert list(zip(*product(csr(right.T).transposed().transposed(), csr(right)))) == [(x, y, n) for (x, y), n in np.ndenumerate(right.T @ right) if n]


def _odd_table(spark, odd_rows, longest):
    rows = [(i, (text or "")[:longest] or text) for i, text, *_ in odd_rows] + [(100 + n, text) for n, text in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return rows, docs.selectExpr("*", "'x' AS id", "'y' AS row", "'z' AS pairs", "1 AS chunk", "2 AS n_a")


def test_odd_rows(spark, odd_rows, no_docs):
    rows, docs = _odd_table(spark, odd_rows, 3000)
    assert _found(alignment.aligned(docs, A_FILE, B_FILE)) == _report(rows)
    assert alignment.aligned(no_docs, A_FILE, B_FILE).collect() == []


def test_texts_in_several_chunks(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 8)
    monkeypatch.setattr(alignment, "ENTRIES", 8)
    rows, docs = _odd_table(spark, odd_rows, 300)
    assert _found(alignment.aligned(docs.coalesce(2), A_FILE, B_FILE)) == _report(rows)


def test_only_texts_without_tokens(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a▁b"), (None, None)], "doc_id bigint, text string")
    assert _found(alignment.aligned(docs, A_FILE, B_FILE)) == sorted([(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3, None)], key=str)


def test_long_texts(spark, odd_docs):
    found = {row.id: row for row in alignment.aligned(odd_docs.where("doc_id IN (8, 9, 10)"), A_FILE, B_FILE).collect()}
    for row in odd_docs.where("doc_id IN (8, 9, 10)").collect():
        a, ar, b, br = _brute(row.text)
        cuts = {e for _, e in ar} & {f for _, f in br}
        assert (found[row.doc_id].n_a, found[row.doc_id].n_b, found[row.doc_id].n_groups) == (len(a), len(b), len(cuts))


def test_pair_counts_beyond_broadcast(spark, monkeypatch):
    from placelens.llm import common

    monkeypatch.setattr(common, "fits_broadcast", lambda df: False)
    docs = spark.createDataFrame([(i, "the same words again and again " * (i % 7 + 1)) for i in range(60)], "doc_id bigint, text string")
    found = alignment.aligned(docs, A_FILE, B_FILE)
    assert _found(found) == _report([(r.doc_id, r.text) for r in docs.collect()])


def test_rows_of_links(spark):
    docs = spark.createDataFrame([(1, "tokenization of naïve texts"), (2, None), (3, "")], "doc_id bigint, text string")
    for kind, method in (("overlap", Alignment.overlaps), ("together", Alignment.together), ("group", Alignment.sharing)):
        found = Alignment("tokenization of naïve texts", side(A_FILE), side(B_FILE))
        expected = [(1, a, b, found.a[a], found.b[b], n) for a, b, n in zip(*method(found))]
        assert [tuple(r) for r in alignment.links(docs, A_FILE, B_FILE, kind).orderBy("a", "b").collect()] == expected


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    small = [(r.doc_id, r.text) for r in docs.collect()]
    found = {row[0]: row[1:] for row in _found(queries.op13_alignment(spark, sf_dir), "doc_id")}
    assert len(found) == len(small)
    for i, text in small:
        a, ar, b, br = _brute(text)
        cuts = {e for _, e in ar} & {f for _, f in br}
        assert found[i][:4] == (len(a), len(b), len(cuts), len(cuts))
    tokens = [(i, *_brute(text)) for i, text in small]
    ends = [({e: n for n, (_, e) in zip(a, ar)}, {f: n for n, (_, f) in zip(b, br)}) for _, a, ar, b, br in tokens]
    pairs = [[(x[e], y[e]) for e in x if e in y] for x, y in ends]
    counts = Counter(pair for some in pairs for pair in some)
    for (i, *_), some in zip(tokens, pairs):
        assert found[i][5] == sum(counts[pair] for pair in some)
