import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.conftest import NASTY
from tierforge.llm import substrings
from tierforge.llm.fm_index import FMIndex, WaveletMatrix
from tierforge.llm.queries import QUERIES


def brute_force(rows, window=13):
    least = {}
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[k : k + window])
                least[g] = min(least.get(g, i), i)
    out = []
    for i, t, *_ in rows:
        w, gone = (t or "").encode().split(), set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(docs):
    return sorted((tuple(r) for r in substrings.remove_repeats(docs).collect()), key=repr)


def passages(seed, n=150):
    """Texts that share passages of various lengths, some of them with very many."""
    random.seed(seed)
    words = [f"v{k}" for k in range(60)]
    shared = [random.choices(words, k=random.choice((12, 13, 14, 30, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        w = random.choices(words, k=random.randint(0, 40))
        for p in random.choices(shared, k=random.choice((0, 1, 2))) + [shared[3]] * (i % 3 == 0):
            at = random.randint(0, len(w))
            w[at:at] = p
        rows.append((i, random.choice((" ", "\n", "  ")).join(w), "s"))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot, shard", [(2048, 32768), (3, 16)])
def test_equals_brute_force(docs_of, monkeypatch, hot, shard):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "SHARD", shard)
    rows = passages(hot)
    assert got(docs_of(rows)) == brute_force(rows)


def test_full_bit_set_changes_nothing(docs_of, monkeypatch):
    monkeypatch.setattr(substrings, "ANCHOR_BITS", 64)
    monkeypatch.setattr(substrings, "DOC_BITS", 64)
    rows = passages(9, n=60)
    assert got(docs_of(rows)) == brute_force(rows)


def test_nulls_blanks_ties_and_long_texts(docs_of):
    assert got(docs_of(NASTY)) == brute_force(NASTY)


def test_no_documents(docs_of):
    assert got(docs_of([])) == []


def test_kept_text(docs_of):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = docs_of([(1, f"a {passage} b", "s"), (2, f"c\n{passage} d e", "s"), (3, "f", "s")])
    out = substrings.remove_repeats(docs, with_text=True).select("doc_id", "kept").collect()
    assert dict(map(tuple, out)) == {1: None, 2: "c d e", 3: None}


def test_wavelet_ranks():
    rng = np.random.default_rng(0)
    for symbols in (1, 2, 5, 64, 1000):
        sequence = rng.integers(0, symbols, 500)
        matrix = WaveletMatrix(sequence, symbols)
        symbol, place = rng.integers(0, symbols, 300), rng.integers(0, 501, 300)
        want = [int((sequence[:p] == s).sum()) for s, p in zip(symbol, place, strict=True)]
        assert matrix.rank(symbol, place).tolist() == want


def test_backward_search_finds_count_and_first_place():
    rng = np.random.default_rng(1)
    for symbols, size, depth in ((4, 300, 3), (30, 900, 2), (3, 400, 7)):
        text = np.append(rng.integers(0, symbols, size), 0)
        index = FMIndex(text, symbols, depth)
        at = [k for k in range(size - depth) if (text[k : k + depth] > 0).all()]
        patterns = np.array([text[k : k + depth] for k in at])
        low, high = index.search(patterns)
        for p, a, b in zip(patterns.tolist(), low, high, strict=True):
            places = [k for k in range(size) if text[k : k + depth].tolist() == p]
            assert b - a == len(places)
            assert len(places) == 1 or index.suffixes[a] == places[0]


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = QUERIES["op7_fm_index"](spark, SF).collect()
    assert sorted((tuple(r) for r in out), key=repr) == brute_force([tuple(r) for r in docs])
