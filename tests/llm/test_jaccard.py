import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.conftest import NASTY
from tierforge.llm import jaccard
from tierforge.llm.graph import components
from tierforge.llm.queries import QUERIES
from tierforge.llm.words import hashed_words, shingles


def shingle_set(text, size):
    w = (text or "").encode().lower().split()
    n = min(size, len(w))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else frozenset()


def brute_force(rows, size, percent):
    """Component and links of every row, all pairs compared."""
    sets = [shingle_set(t, size) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if None in (rows[a][0], rows[b][0]) or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = defaultdict(lambda: None)
    for k, (i, _, _) in enumerate(rows):
        r = root(k)
        least[r] = i if least[r] is None else min(least[r], i)
    return sorted(
        ((i, len(sets[k]), least[root(k)], links[k]) for k, (i, _, _) in enumerate(rows)), key=repr
    )


def near_copies(seed, families=6, copies=40, words=60):
    random.seed(seed)
    rows, vocabulary = [], [f"w{k}" for k in range(400)]
    for _ in range(families):
        base = random.choices(vocabulary, k=random.randint(3, words))
        for _ in range(copies):
            own = list(base)
            for _ in range(random.choice((0, 0, 1, 1, 2, 5))):
                at = random.randrange(len(own))
                own[at : at + random.choice((0, 1))] = random.choices(vocabulary, k=random.choice((0, 1)))
            rows.append((len(rows), " ".join(own), "s"))
    return rows


def got(docs, size, percent):
    return sorted((tuple(r) for r in jaccard.similarity_groups(docs, size, percent).collect()), key=repr)


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (2, 50)])
def test_equals_brute_force(docs_of, size, percent):
    rows = near_copies(percent)
    assert got(docs_of(rows), size, percent) == brute_force(rows, size, percent)


def test_common_shingles_lose_no_link(docs_of, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON", 0.0)
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(i, f"{t} {passage}", s) for i, t, s in near_copies(7, words=40)]
    docs = docs_of(rows, parts=1)
    assert len(jaccard.common_shingles(docs, 3, len(rows))) > 10
    assert got(docs, 3, 80) == brute_force(rows, 3, 80)


def test_blocks_lose_no_pair(docs_of, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 7)
    rows = near_copies(5, families=2, copies=90)
    assert got(docs_of(rows), 3, 70) == brute_force(rows, 3, 70)


def test_nulls_blanks_ties_and_long_texts(docs_of):
    rows = [r for r in NASTY if r[0] != 11]
    assert got(docs_of(rows), 3, 90) == brute_force(rows, 3, 90)


def test_rows_of_one_id(docs_of):
    out = {r[:2]: r[2:] for r in got(docs_of(NASTY), 3, 90)}
    assert {r[0] for r in out} == {i for i, _, _ in NASTY}
    assert out[11, 5][0] == 11


def test_no_documents(docs_of):
    assert got(docs_of([]), 3, 90) == []
    assert jaccard.one_of_each(docs_of([])).count() == 0


def test_one_of_each_keeps_the_least_id_and_all_columns(docs_of):
    docs = docs_of([*NASTY, *[(100 + i, t, s) for i, t, s in near_copies(1, families=2)]])
    kept = jaccard.one_of_each(docs)
    assert kept.schema == docs.schema
    ids = [r["doc_id"] for r in kept.collect()]
    groups = got(docs, 5, 80)
    want = {i for i, _, c, _ in groups if i == c} | {None}
    assert set(ids) == want
    assert len(ids) == len(set(ids)) + 1, "only the id with two texts stays twice"


def test_each_text_of_a_repeated_id_belongs_to_its_own_group(docs_of):
    def text(name, *more):
        return " ".join([*(f"{name}{k}" for k in range(60)), *more])

    rows = [
        (5, text("a"), "s"),
        # One text like that of 5 and one like nothing, then one that 12 resembles.
        (9, text("a", "x"), "s"), (9, text("b"), "s"), (9, text("c"), "s"), (12, text("c", "x"), "s"),
        # Near copies, and equal sets of words, under one id.
        (20, text("d"), "s"), (20, text("d", "x"), "s"), (20, text("e"), "s"), (20, text("E"), "s"),
        (20, None, "s"), (20, "", "s"), (20, text("d"), "s"),
    ]
    kept = [(r["doc_id"], (r["text"] or "").lower()) for r in jaccard.one_of_each(docs_of(rows)).collect()]
    near = [t for i, t in kept if i == 20 and t.startswith("d0")]
    assert len(near) == 1 and near[0] in (text("d"), text("d", "x"))
    want = [(5, text("a")), (9, text("b")), (9, text("c")), (20, near[0]), (20, text("e")), (20, ""), (20, "")]
    assert sorted(kept) == sorted(want)
    groups = {r[:2]: r[2:] for r in got(docs_of(rows[:5]), 5, 80)}
    assert groups[12, 57] == (9, 1) and groups[9, 57] == (5, 1)


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_bands_and_schemes_cover_all_linking_sizes(percent):
    for a in range(1, 400):
        for b in range(1, a + 1):
            if 100 * b >= percent * a:
                lower, upper = jaccard.band_of(b, percent), jaccard.band_of(a, percent)
                assert upper - lower in (0, 1)
                segments, spare = jaccard.scheme(lower, percent)
                # The most they can differ in while they link.
                common = -(-percent * (a + b) // (100 + percent))
                assert segments - spare > a + b - 2 * common


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_segment(percent):
    rng = np.random.default_rng(percent)
    for _ in range(400):
        n = int(rng.integers(1, 120))
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        other = np.concatenate([base[: n - rng.integers(0, 1 + n // 8)],
                                rng.integers(0, 2**63, rng.integers(0, 1 + n // 8)).astype(np.uint64)])
        a, b = np.unique(base), np.unique(other)
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= percent * (len(a) + len(b) - common):
            for common in (a[:0], a[::2], np.union1d(a, b)):
                keys = (jaccard.segment_keys(x, percent, common) for x in (a, b))
                assert np.intersect1d(*keys).size


def test_overlaps_count_common_shingles():
    texts = [" ".join(f"w{(k * j) % 37}" for j in range(60)) for k in range(1, 60)]
    sets = [shingles(hashed_words(t.encode()), 2) for t in texts]
    out = jaccard.overlaps(sets)
    for a in range(len(sets)):
        for b in range(a):
            assert out[a, b] == out[b, a] == len(np.intersect1d(sets[a], sets[b]))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(100 + k, 101 + k) for k in range(40)] + [(500, 500 + k) for k in range(30)]
    edges += [(900 - k, 800 + k) for k in range(20)] + [(7, 7), (3, 2), (2, 3)]
    random.seed(3)
    random.shuffle(edges)
    out = dict(components(spark.createDataFrame(edges, "src long, dst long")).collect())
    want = {k: 100 for k in range(100, 141)} | {k: 500 for k in range(500, 530)}
    want |= {2: 2, 3: 2} | {x: min(x, 1700 - x) for e in edges for x in e if 800 <= x <= 900}
    assert out == want


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r[0], r[1], "") for r in docs]
    out = QUERIES["op2_ngram_jaccard"](spark, SF)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_force(rows, 3, 90)


def test_parts_do_not_repeat_the_ties_of_earlier_ones(spark, monkeypatch):
    rng = random.Random(11)
    base = [[f"g{g}w{rng.randrange(10**6)}" for _ in range(300)] for g in range(40)]
    texts = []
    for words in base:
        for k in range(3):
            own = list(words)
            own[rng.randrange(300)] = f"x{k}"
            texts.append((len(texts), " ".join(own)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(12)
    total = len(texts) * 296

    def ties(parts):
        with monkeypatch.context() as patched:
            patched.setattr(jaccard, "PART_SEGMENTS", -(-total // parts))
            # Ties as the parts return them, before equal ones are put together.
            patched.setattr(type(docs), "distinct", lambda df: df)
            return jaccard._candidate_edges(docs, 5, 80, total, np.empty(0, np.uint64)).collect()

    few, many = ties(2), ties(64)
    joined = [dict(components(spark.createDataFrame(t, "src long, dst long")).collect()) for t in (few, many)]
    assert joined[0] == joined[1] and len(joined[0]) == 120 and len(set(joined[0].values())) == 40
    assert len(few) <= 120 and len(many) <= 480


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_a_segment_with_like_sketches(percent):
    rng = np.random.default_rng(percent)
    linked = 0
    for _ in range(600):
        n = int(rng.integers(1, 300))
        base = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        less = int(n * (100 - percent) / 100)
        more = rng.integers(0, 2**63, rng.integers(0, 1 + less)).astype(np.uint64)
        a, b = np.unique(base), np.unique(np.concatenate([base[rng.integers(0, 1 + less // 2) :], more]))
        both = len(np.intersect1d(a, b))
        if 100 * both < percent * (len(a) + len(b) - both):
            continue
        linked += 1
        for common in (a[:0], a[::2], np.union1d(a, b)):
            sides = [jaccard.segments(x, percent, common) for x in (a, b)]
            key, sketch = (np.concatenate(x) for x in zip(*sides, strict=True))
            node = np.repeat([0, 1], [len(k) for k, _ in sides])
            first, second = jaccard.tied(key, sketch, node)
            assert np.any(first != second)
    assert linked > 100


def test_many_sketches_of_a_key_are_tied_as_all_pairs_tell():
    rng = np.random.default_rng(4)
    for n in (2, 15, 16, 17, 60):
        key = np.repeat(np.arange(5, dtype=np.uint32), n)
        sketch = np.uint32(1) << rng.integers(0, 32, 5 * n).astype(np.uint32)
        for _ in range(4):
            sketch |= np.uint32(1) << rng.integers(0, 32, 5 * n).astype(np.uint32)
        sketch[: n // 2] = 5
        edges = np.stack(jaccard.tied(key, sketch, np.arange(5 * n)), axis=1)
        near = np.bitwise_count(sketch[:, None] ^ sketch) <= jaccard.CHAIN
        want = np.argwhere(near & (key[:, None] == key))
        roots = [jaccard._joined(5 * n, e) for e in (edges, want)]
        assert np.array_equal(*roots)


def ties_of(docs, size, percent, total):
    return jaccard._candidate_edges(docs, size, percent, total, np.empty(0, np.uint64)).collect()


def test_a_phrase_shared_by_chance_ties_few(spark):
    rng = random.Random(5)
    texts = [[f"d{k}w{j}" for j in range(150)] for k in range(300)]
    for k, words in enumerate(texts):
        # Every text shares seven words with each of some others.
        for step in range(1, 15):
            at = rng.randrange(143)
            texts[(k + step) % 300][at : at + 7] = words[step * 10 : step * 10 + 7]
    rows = [(k, " ".join(w)) for k, w in enumerate(texts)]
    near = list(texts[7])
    near[75] = "x"
    rows.append((300, " ".join(near)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    edges = ties_of(docs, 5, 80, 300 * 146)
    marks = {k: jaccard.fingerprint(shingles(hashed_words(t.encode()), 5))[1] for k, t in rows}
    assert any({e["src"], e["dst"]} == {marks[7], marks[300]} for e in edges)
    assert len({n for e in edges for n in e}) < 30


def test_parts_do_not_make_segments_longer(spark, monkeypatch):
    texts = [(k, " ".join(f"d{k}w{j}" for j in range(400))) for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    total, sent, work = 400 * 396, [], jaccard.map_batches

    def counted(*args):
        out = work(*args)
        size = sum(F.length(c) for c, kind in out.dtypes if kind == "binary")
        sent.append(out.agg(F.sum(size)).first()[0])
        return out

    monkeypatch.setattr(jaccard, "map_batches", counted)
    for parts in (1, 200):
        monkeypatch.setattr(jaccard, "PART_SEGMENTS", -(-total // parts))
        ties_of(docs, 5, 80, total)
    assert sent[1] <= 1.05 * sent[0]


def test_all_ids_of_a_large_table_have_bits(docs_of, monkeypatch):
    rows = near_copies(3)
    monkeypatch.setattr(jaccard, "DOC_BITS", 1)
    monkeypatch.setattr(jaccard, "MOST_DOC_BITS", 64)
    assert got(docs_of(rows), 3, 80) == brute_force(rows, 3, 80)
