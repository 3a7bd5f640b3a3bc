"""HTML extraction, the factorisation machine and the Pitman-Yor model."""

import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.conftest import NASTY
from tierforge.llm import html_text, pitman_yor, quality_model
from tierforge.llm.queries import QUERIES, fold

# HTML extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style>
<script>var t="</p><article>";</script></head><body class="has-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div id="cookie-notice"><p>We use cookies and tell you so in a very long sentence indeed, do you agree?</p></div>
%s
<footer>&copy; all rights</footer></body></html>"""
BODY = """<h1>Title &amp; more</h1><p><b>First&nbsp;para   text<br>second
 line.<p>Short.<ul><li>one<li>two <i>x</i>y</ul><aside>side</aside><div class="ad-slot">buy</div>
<form><input value="q"><button>go</button></form><!-- no --><p>Caf&eacute; &#8212; end</p>"""
TEXT = "Title & more\n\nFirst para text second line.\n\nShort.\n\none\n\ntwo xy\n\nCafé — end"
COMMENTS = """<section class="comments"><article class="comment"><p>Nice post! I have a lot to say about
 it, and more than the author, so that this is the longest text of all the page.</p></article></section>"""


@pytest.mark.parametrize(
    "html, text",
    [
        (PAGE % f"<article>{BODY}</article>{COMMENTS}", TEXT),
        (PAGE % f"<main><div class='post-content'>{BODY}</div>{COMMENTS}</main>", TEXT),
        (PAGE % f"<article>{BODY}{COMMENTS}</article>", TEXT),
        (PAGE % f"<div><div class='story'>{BODY}</div></div>{COMMENTS}", TEXT),
        ("", ""),
        ("plain &lt;b&gt; text", "plain <b> text"),
        ("<article><p>never closed <b>bold", "never closed bold"),
        ("<article></article>", ""),
        ("<script>only()</script>", ""),
        ("<p>a</div></span></p>b<p>c", "a\n\nb\n\nc"),
        ("<div><div><p>Content text, and a good deal of it.</p><p>Ok.</p></div><div><a>l1</a> <a>l2</a></div></div>",
         "Content text, and a good deal of it.\n\nOk."),
    ],
)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


LEAD, END = "The lead says it all. " * 9, "And here it ends. " * 10
LONG_DIV = "<div>" + "<p>%s</p>" % ("Much to say. " * 130) * 3 + "</div>"
MENU = "<div><a>Home</a> <a>News</a></div><ul><li><a>One</a><li><a>Two</a></ul>"


@pytest.mark.parametrize(
    "html, first, last, paragraphs",
    [
        (f"<body><div>{LEAD}</div><div>{'x' * 5000}</div></body>", LEAD, "x" * 5000, 2),
        (f"<body>{MENU}<div>{LEAD}</div>{LONG_DIV}</body>", LEAD, "Much to say. " * 130, 4),
        (f"<body>{LONG_DIV}<div><p>{END}</p></div>{MENU}</body>", "Much to say. " * 130, END, 4),
        (f"<body>{MENU}<div><div>{LEAD}</div>{LONG_DIV}<section>{END}</section></div></body>", LEAD, END, 5),
        (f"<article>{LEAD}</article><p>between</p><article>{LONG_DIV}</article>", LEAD, "Much to say. " * 130, 4),
        (f"<main>{LEAD}</main><p>between</p><main>{END}</main>", LEAD, END, 2),
        (f"<article>{LEAD}<article>{END}</article></article>{COMMENTS}", LEAD, END, 2),
    ],
)
def test_content_in_several_elements(html, first, last, paragraphs):
    got = html_text.main_text(html).split("\n\n")
    assert (got[0], got[-1], len(got)) == (first.strip(), last.strip(), paragraphs)


def paragraphs(n, of="story"):
    return "".join(f"<p>{of} {k}: {'enough to say about it ' * 6}</p>" for k in range(n))


@pytest.mark.parametrize(
    "inside, kept",
    [
        ('<h2 class="section-header">Results</h2>', "Results"),
        ('<div class="alert">Mind the step.</div>', "Mind the step."),
        ('<div class="search-results-table"><table><tr><td>a<td>17</table></div>', "a\n\n17"),
        (f'<section id="related-work">{paragraphs(2, "related")}</section>', "related 1:"),
    ],
)
def test_names_alone_drop_no_content(inside, kept):
    got = html_text.main_text(f"<body><article>{paragraphs(3)}{inside}{paragraphs(1)}</article></body>")
    assert kept in got and got.count("story") == 4
    assert html_text.main_text(f"<article>{inside}</article>").startswith(kept[:6])


def test_names_that_links_confirm_drop():
    related = '<div class="related-posts"><h3>More</h3><a>One long title</a> <a>Another one</a></div>'
    share = '<div class="share">Share <a>here</a> <a>or there</a></div>'
    for page in ("<body><article>%s</article></body>", "<body><div>%s</div></body>"):
        got = html_text.main_text(page % (paragraphs(4) + share + related))
        assert got.count("story") == 4 and "More" not in got and "Share" not in got


def test_clusters_choose_the_story_beside_a_teaser_card(monkeypatch):
    story = f"<div>{paragraphs(20)}</div>"
    page = f"<body><article><h3>Teaser one</h3></article>{story}</body>"
    got = html_text.main_text(page)
    assert got.count("story") == 20 and "Teaser" not in got
    # Many short lines outweigh a short story, but not by their ratio.
    lines = "".join(f"<li><b>{k}</b> <i>short</i> <u>line</u>" for k in range(300))
    page = f"<body><div><ul>{lines}</ul></div><div>{paragraphs(6)}</div></body>"
    got = html_text.main_text(page)
    assert got.count("story") == 6 and "short" not in got
    monkeypatch.setattr(html_text, "content_lines", lambda ratios: ratios >= 0)
    assert "short" in html_text.main_text(page)


@pytest.mark.parametrize(
    "piece", ["<div>x", "<div>x</b>", "<li>x<div>", "<b>x", "<td><p>x", "<section class='related'>x"]
)
def test_deep_unclosed_markup_takes_time_and_memory_in_proportion(piece):
    import tracemalloc
    from time import perf_counter

    def seconds(size):
        start = perf_counter()
        html_text.main_text(piece * (size // len(piece)))
        return perf_counter() - start

    def peak(size):
        tracemalloc.start()
        html_text.main_text(piece * (size // len(piece)))
        _, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        return most

    seconds(1000)
    assert seconds(1_000_000) < 40 * seconds(100_000)
    assert peak(200_000) < 15 * peak(20_000)


def test_pages_with_nulls_repeats_and_long_ones(spark):
    long = "<article>" + "<p>" + "word " * 200_000 + "</p>" * 3 + "</article>"
    rows = [(1, None, None), (1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (None, "u", ""), (2, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = html_text.extract(pages.withColumn("text", F.lit("clash"))).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in out) == [
        (0, 0), (1, 0), (1, 1), (1, 1), (2, 999_999),
    ]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_query_pages(spark):
    import html as entities
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    out = {r["page_id"]: r for r in QUERIES["op3_main_text"](spark, SF).collect()}
    assert len(out) == len(pages)
    for p in pages:
        inner = p["html"].partition("<article>")[2].partition("</article>")[0]
        blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert out[p["page_id"]]["text"] == "\n\n".join(b for b in blocks if b)


# Factorisation machine


def test_margin_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    size = quality_model.BUCKETS + len(quality_model._STATS)
    machine = quality_model.Machine(
        0.3, rng.normal(size=size), rng.normal(size=(size, 8)),
        np.zeros(len(quality_model._STATS)), np.ones(len(quality_model._STATS)),
    )
    index, x = machine.inputs(*quality_model.features(b"Some words, some MORE words!", 28.0))
    pairs = sum(
        float(machine.factors[index[a]] @ machine.factors[index[b]]) * x[a] * x[b]
        for a in range(len(x))
        for b in range(a)
    )
    assert machine.margin(index, x) == pytest.approx(0.3 + float(machine.linear[index] @ x) + pairs)


def test_gradients_lower_the_loss_on_held_out_rows():
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice(["der", "the", "of", "and", "word"], 80)) for _ in range(60)]
    bad = [" ".join(rng.choice(["BUY!!", "NOW!!", "$$$", "###"], 80)) for _ in range(60)]
    rows = [quality_model.features(t.encode(), len(t)) for t in good + bad]
    labels = np.repeat([1.0, 0.0], 60)
    model = quality_model.learn(rows[::2], labels[::2])
    scores = [model.score(t.encode(), len(t)) for t in (good + bad)[1::2]]
    assert np.array_equal(np.array(scores) >= 0.7, labels[1::2] == 1)
    same = quality_model.Machine.unpacked(model.packed())
    assert same.score(b"the word", 8) == pytest.approx(model.score(b"the word", 8), abs=1e-5)


def test_query_scores_held_out_rows_well(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = QUERIES["op4_factorisation_machine"](spark, sf).join(labels, "doc_id").filter("held_out")
    rows = [(r["score"], r["predicted"], r["quality"]) for r in out.collect()]
    clean, junk = ([r for r in rows if r[2] == k] for k in (1, 0))
    assert np.mean([r[1] for r in clean]) >= 0.99
    assert np.mean([r[1] for r in junk]) <= 0.1
    above = np.mean([a[0] > b[0] for a in clean for b in junk])
    assert above >= 0.98


def test_scores_of_nasty_rows_and_without_labels(spark, docs_of):
    docs = docs_of(NASTY)
    labels = spark.createDataFrame(
        [(4, 1), (5, 0), (5, 1), (6, 1), (9, 0), (None, 1), (7, None), (999, 1)],
        "doc_id long, quality int",
    )
    out = quality_model.score(docs, quality_model.fit(docs, labels)).collect()
    assert len(out) == len(NASTY) and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in quality_model.score(docs, None).collect()} == {0.5}
    assert quality_model.fit(docs, labels.limit(0)) is None
    assert quality_model.score(docs.limit(0), None).count() == 0
    kept = quality_model.accepted(docs, quality_model.fit(docs, labels))
    assert kept.schema == docs.schema
    assert quality_model.accepted(docs, None).count() == len(NASTY)


# Pitman-Yor model


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def brute_base(rows, training):
    seen = Counter(t for (i, x, *_), s in zip(rows, training, strict=True) if s for t in tokens(x))
    n, v = sum(seen.values()), len(seen)
    out = []
    for (i, x, *_), s in zip(rows, training, strict=True):
        base = sum(math.log10((seen[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x))
        known = sum(seen[t] > 0 for t in tokens(x))
        out.append((i or -1, not s, len(tokens(x)), known, n, pytest.approx(base)))
    return sorted(out, key=lambda r: r[:4])


def learned_from(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1


def scored(docs):
    out = pitman_yor.scores(docs, fold(F.col("doc_id"), 5) != 1).collect()
    rows = [(r["doc_id"] or -1, *r[1:6]) for r in out]
    return sorted(rows, key=lambda r: r[:4]), out


def test_base_scores_equal_brute_force(docs_of, stored):
    rows = [*NASTY, *[(50 + k, f"the word {k} the End", "s") for k in range(40)]]
    got, out = scored(stored(docs_of(rows)))
    assert got == brute_base(rows, [learned_from(i) for i, _, _ in rows])
    assert all(r["score"] <= 0 for r in out)


def test_small_pieces_and_large_counts(docs_of, stored, monkeypatch):
    monkeypatch.setattr(pitman_yor, "PIECE_BYTES", 200)
    monkeypatch.setattr(pitman_yor, "PIECE_USES", 5)
    rows = [(k, "a b " * (k * 40), "s") for k in range(30)]
    got, _ = scored(stored(docs_of(rows)))
    assert got == brute_base(rows, [learned_from(i) for i, _, _ in rows])


def test_nothing_to_learn_from(docs_of, stored):
    held = next(k for k in range(100) if not learned_from(k))
    _, out = scored(stored(docs_of([(held, "some words", "s")])))
    assert [(r["train_tokens"], r["score"]) for r in out] == [(0, 0.0)]
    assert scored(stored(docs_of([])))[1] == []


def shared(counts, tables):
    return pitman_yor.Restaurants(
        counts.sum(axis=0).astype(float), tables.sum(axis=0).astype(float), len(counts), (0.6, 0.7)
    )


def test_chances_sum_to_one():
    rng = np.random.default_rng(2)
    counts = rng.poisson(0.5, (500, pitman_yor.CONTEXTS)) * rng.integers(1, 40, (500, 1))
    counts = counts[counts.sum(axis=1) > 0]
    tables = np.minimum(counts, 1)
    for _ in range(3):
        tables = pitman_yor.reseat(counts, tables, shared(counts, tables), rng)
        assert ((tables >= np.minimum(counts, 1)) & (tables <= counts)).all()
    model = shared(counts, tables)
    total = model.predict(counts, tables).sum(axis=0) + model.unknown()
    assert total == pytest.approx(np.ones(pitman_yor.CONTEXTS))


def test_seating_in_runs_opens_as_many_tables_as_one_by_one():
    def one_by_one(n, base, rng):
        tables = 1
        for seated in range(1, n):
            new = (1 + 0.6 * (50 + tables)) * base
            tables += rng.random() < new / (new + seated - 0.6 * tables)
        return tables

    rng = np.random.default_rng(4)
    for n, base in ((40, 0.02), (2000, 0.05), (2000, 0.5)):
        want = np.mean([one_by_one(n, base, rng) for _ in range(300)])
        got = pitman_yor.seat(
            np.full(3000, n), np.full(3000, base), np.full(3000, 50.0), 0.6, 1.0, rng
        )
        assert got.mean() == pytest.approx(want, rel=0.06)


def test_query_predicts_held_out_texts_better_than_the_base(spark):
    out = QUERIES["op6_pitman_yor"](spark, "/root/testdata/sf0.01")
    rows = {r["held_out"]: r for r in pitman_yor.perplexity(out).collect()}
    for held_out in (True, False):
        assert rows[held_out]["perplexity"] < 0.8 * rows[held_out]["base_perplexity"]


def test_the_word_before_counts_whole(docs_of, stored):
    rng = np.random.default_rng(5)
    # All words end alike, and each is followed by one word only.
    follows = {f"w{k}a": f"w{(k * 7 + 3) % 40}a" for k in range(40)}
    rows = []
    for k in range(300):
        text = [f"w{rng.integers(40)}a"]
        while len(text) < 30:
            text.append(follows[text[-1]])
        rows.append((k, " ".join(text), "s"))
    _, out = scored(stored(docs_of(rows)))
    held = [r for r in out if r["held_out"]]
    n = sum(r["n_tokens"] for r in held)
    # One of 40 at the start, and an end that comes after any word.
    assert 10 ** (-sum(r["score"] for r in held) / n) < 1.5
    assert 10 ** (-sum(r["base_score"] for r in held) / n) > 30


def test_chances_after_each_word_sum_to_one(spark, docs_of, stored):
    docs = stored(docs_of([*NASTY, *[(50 + k, f"the word {k % 7} the End", "s") for k in range(40)]]))
    pairs = stored(pitman_yor.pair_counts(docs, F.lit(True)))
    assert pairs.filter("n > 1").count() and pairs.filter("n = 1").count()
    model = pitman_yor.train(pairs)
    words = {r["word"]: r for r in model.chances.collect()}
    gains = {r["pair"]: r["gain"] for r in model.gains.collect()}
    every = spark.createDataFrame([(u, w) for u in words for w in words], "context long, word long")
    total = Counter()
    for u, w, pair in every.select("context", "word", F.xxhash64("context", "word")).collect():
        own = words[w][f"p{u % pitman_yor.CONTEXTS}"] + words[u]["back"]
        total[u] += 10 ** (own + gains.get(pair, 0.0))
    for u, row in words.items():
        unknown = model.unknown[u % pitman_yor.CONTEXTS] * 10 ** row["back"]
        assert total[u] + unknown == pytest.approx(1, abs=1e-5)
    assert len(gains) == pairs.count()


def test_many_ranges_know_as_much_as_one(spark, docs_of, stored, monkeypatch):
    monkeypatch.setattr(pitman_yor, "RANGE_BYTES", 500)
    rows = [(50 + k, f"the word {k} the End of {k % 5}", "s") for k in range(40)]
    docs = stored(docs_of(rows))
    assert pitman_yor._ranges(docs) > 4
    got, _ = scored(docs)
    assert got == brute_base(rows, [learned_from(i) for i, _, _ in rows])
    test_chances_after_each_word_sum_to_one(spark, docs_of, stored)


def test_ranges_follow_the_input_and_not_the_cluster(spark, docs_of, stored):
    docs = stored(docs_of([(k, "some words", "s") for k in range(50)]))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "211")
        assert pitman_yor._ranges(docs) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_used_seats_do_not_stay_on_disk(spark, docs_of, stored):
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    docs = stored(docs_of([(k, f"the word {k % 7} the End", "s") for k in range(60)]))
    before = set(scratch.iterdir())
    assert len(scored(docs)[1]) == 60
    # Those of the last sweep, which the scores are made from.
    assert [p.name.split("-")[0] for p in set(scratch.iterdir()) - before] == ["seats"]


def test_records_of_pairs_give_back_what_they_hold():
    rng = np.random.default_rng(6)
    words, contexts = (np.unique(rng.integers(0, 2**64, 300, np.uint64)) for _ in range(2))
    key = np.unique(np.concatenate([rng.integers(0, 300 * 300, 5000), np.arange(300) * 300]))
    word, places = np.divmod(key, 300)
    n = rng.integers(1, 70000, len(key))
    record = pitman_yor._pack_pairs(words, contexts, np.bincount(word), places, n=n)
    got = pitman_yor._unpack_pairs(record)
    for name, want in {"words": words, "contexts": contexts, "places": places, "n": n}.items():
        assert (got[name] == want).all()
    assert (got["runs"] == np.bincount(word)).all()
