import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from placelens.llm import packing, tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(FILE)
PLAIN = Tokenizer.from_file(FILE)
PLAIN.encode_special_tokens = True


def _ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [0]


SPECIAL = ["<|endoftext|> a <|endoftext|>", "a <|endoftext|> b", "don't  stop ", "a\n\n b", " lead", "x" * 20_000, " " * 3000, ""]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1'.,!é \n\t\x1c\x85\u00a0\u200b\u3000中<|>", max_size=40))
def test_ranks_give_the_tokenizers_ids(text):
    assert tokens.encoder(FILE).ids(text).tolist() == _ids(text)[:-1]


@pytest.mark.parametrize("text", SPECIAL)
def test_special_cases(text):
    assert tokens.encoder(FILE).ids(text).tolist() == _ids(text)[:-1]
    assert tokens.encoder(FILE, plain=True).ids(text).tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_every_entry_and_every_character():
    """The rank encoder knows the same merges and the same classes of characters as the tokenizer itself."""
    table, encode = tokens.byte_level(FILE), tokens.encoder(FILE).ids
    whole = [entry.decode() for entry in table.values() if entry.decode(errors="replace").encode() == entry]
    around = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 ,{chr(c)}." for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for texts in (whole, around):
        for text, found in zip(texts, WHOLE.encode_batch(texts, add_special_tokens=False)):
            assert encode(text).tolist() == found.ids


def test_a_file_of_another_kind_keeps_its_library():
    file = public_tokenizers.path("word_bpe_49k.json")
    assert tokens.byte_level(file) is None
    own = Tokenizer.from_file(file)
    assert tokens.encoder(file).ids("Two  WORDS, three").tolist() == own.encode("Two  WORDS, three", add_special_tokens=False).ids


def test_hilbert_curve_visits_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing._hilbert(grid, 3)
    assert sorted(keys) == list(range(512))
    assert np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_odd_rows(odd_docs, odd_rows, no_docs):
    length = 64
    found = packing.pack(odd_docs, FILE, length=length, with_ids=True).collect()
    sequences, texts = defaultdict(list), Counter()
    for row in found:
        sequences[row.sequence_id].append(row)
        assert row.length == len(row.ids)
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
    assert sorted(sequences) == list(range(len(sequences)))
    for number, rows in sequences.items():
        at = 0
        for row in sorted(rows, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at == length or number == len(sequences) - 1
    # Rows that share an id are told apart by the line their pieces stand in.
    line = sorted(found, key=lambda r: (r.sequence_id, r.offset))
    place = 0
    while place < len(line):
        first, ids = line[place], []
        assert first.start == 0
        while len(ids) < first.doc_tokens:
            assert (line[place].id, line[place].start) == (first.id, len(ids))
            ids += line[place].ids
            place += 1
        texts[first.id, tuple(ids)] += 1
    assert texts == Counter((i, tuple(_ids(t))) for i, t, *_ in odd_rows)
    assert packing.pack(no_docs, FILE).collect() == []


def test_like_documents_stand_together(spark):
    kinds = ["red green blue yellow " * 20, "one two three four five " * 20]
    docs = spark.createDataFrame([(i, kinds[i % 2] + str(i % 5)) for i in range(40)], "doc_id bigint, text string")
    found = sorted(packing.pack(docs, FILE).collect(), key=lambda r: (r.sequence_id, r.offset))
    order = [row.id % 2 for row in found if row.start == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) <= 5


def test_line_against_a_plain_sort(spark):
    """Documents stand in the order of their cells' places, computed one by one from the tokenizer's ids."""
    words = [f"w{n}" for n in range(40)]
    random = np.random.default_rng(3)
    rows = [(i, " ".join(random.choice(words, random.integers(1, 30)))) for i in range(150)] + [(500, None), (501, "")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    axes = np.random.default_rng(packing.SEED).standard_normal((packing.HASHED, packing.DIMENSIONS))
    keyed = []
    for place, (i, text) in enumerate(rows):
        counts = np.zeros(packing.HASHED)
        for token in _ids(text):
            counts[(token * 40503 % 2**32 >> 7) % packing.HASHED] += 1
        spread = np.tanh(np.sqrt(counts) / np.sqrt(counts.sum()) @ axes)
        cell = [min(int((x + 1) / 2 * 2**packing.LEVELS), 2**packing.LEVELS - 1) for x in spread]
        keyed.append((packing._hilbert(np.array([cell]), packing.LEVELS)[0], i))
    found = sorted(packing.pack(docs, FILE).where("start = 0").collect(), key=lambda r: (r.sequence_id, r.offset))
    by_key = {}
    for key, i in keyed:
        by_key.setdefault(key, []).append(i)
    at = 0
    for key in sorted(by_key):
        some = [r.id for r in found[at : at + len(by_key[key])]]
        assert sorted(some) == sorted(by_key[key])
        at += len(some)
    assert at == len(found)
