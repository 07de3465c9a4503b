import random
import time
import tracemalloc
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from trilake.llm.html_wrapper import align, blocks, extract, main_text, parse, tree_of, wrappers
from trilake.llm.toxicity import THRESHOLD, drop_toxic, fit, toxicity, training_rows

from .util import empty, frame, words


#: Small thresholds under which a skewed join shows.
HOT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
       "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
       "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


# -- html ------------------------------------------------------------------------------

def test_parser_closes_what_is_open():
    page = ('<!DOCTYPE html><html><head><title>t</title><script>var t="</p>";x()</script></head><body><nav><li>a<li>b</nav>'
            '<!-- c --><div class="ad">buy</div><article><h1>T &amp; t</h1><p><b>one\n two<br>three<p>four &lt;x&gt; &am'
            '<div class=comments>no</div></article><footer>f</footer>')
    got = blocks(parse(page))
    assert [b[1] for b in got if b[3] and not b[2]] == ["T & t", "one two three", "four <x> &am"]
    assert {b[1] for b in got if b[2]} == {"a", "b", "buy", "no", "f"}
    assert main_text(got) == "T & t\none two three\nfour <x> &am"


@pytest.mark.parametrize("page", ["", "<", "<a", "<!--", "<p><p", "</p></div>", "text only", "<script>x", "&", "<a b='", "<x y=\"<p>\">z", "\x00<p>"])
def test_broken_pages(page):
    assert isinstance(main_text(blocks(parse(page))), str)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("<>/pbdiv !-\"'=a &;\n"), max_size=80))
def test_any_markup_parses(page):
    text = main_text(blocks(parse(page)))
    assert text == "\n".join(" ".join(x.split()) for x in text.split("\n"))


def test_deep_and_long_pages():
    assert main_text(blocks(parse("<div>" * 20_000 + "x"))) == "x"
    assert len(main_text(blocks(parse("<p>" + "word " * 300_000)))) == 300_000 * 5 - 1



def brute_match(a, b):
    """Largest order-preserving match (tags only), by trying both ways at every step."""
    x, y = list(a), list(b)
    if not x or not y:
        return 0.0
    rest_x, rest_y = {k: a[k] for k in x[1:]}, {k: b[k] for k in y[1:]}
    best = max(brute_match(rest_x, b), brute_match(a, rest_y))
    if x[0].partition(".")[0] == y[0].partition(".")[0]:
        best = max(best, 1 + 0.5 * (x[0] == y[0]) + brute_match(a[x[0]], b[y[0]]) + brute_match(rest_x, rest_y))
    return best


def test_simple_tree_matching_is_largest():
    rng = random.Random(2)

    def tree(depth):
        return {f"{rng.choice('pdu')}.{rng.choice('abc')}": tree(depth - 1) if depth else {} for _ in range(rng.randrange(4))}

    for _ in range(60):
        a, b = tree(2), tree(2)
        got = align(a, b)
        weight = sum(1 + 0.5 * (p.rpartition("/")[2] == q.rpartition("/")[2]) for p, q in got.items())
        assert weight == brute_match(a, b)
        assert all(got.get(p.rpartition("/")[0], "") == q.rpartition("/")[0] for p, q in got.items())
    assert tree_of(["/a/b", "/a/c"]) == {"a": {"b": {}, "c": {}}}


def site(n, rng):
    """Pages without article or menu elements: only the wrapper tells what is content."""
    return [(i, f"http://plain.example.com/{i}",
             f"<body><div class=x1><p>Same words on all pages</p></div><div class=x2><p>{words(rng, 12)}</p><p>{words(rng, 9)}</p></div>"
             f"<div class=x3><span>Fixed end {i % 2}</span></div></body>") for i in range(n)]


def test_wrappers_find_the_varying_slots(spark):
    rng = random.Random(1)
    rows = site(20, rng)
    rows += [(100, None, "<p>no url"), (101, "http://one.example.com/", "<p>only page</p>"), (102, "http://plain.example.com/z", None),
             (103, "http://plain.example.com/y", ""), (104, "http://copies.example.com/", "<article><p>copied</p></article>")] * 2
    rows += [(200 + i, "http://copies.example.com/", "<nav>m</nav><article><p>copied</p></article>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as slots").repartition(3)
    slots = {r.host: {s["path"]: s["constant"] for s in r["slots"]} for r in wrappers(pages).collect()}["plain.example.com"]
    assert slots["/html/div.x1/p"] and slots["/html/div.x3"] and not slots["/html/div.x2/p"]
    got = {r.page_id: (r.text, r.n_chars) for r in extract(pages).collect()}
    for i, _, page in rows[:20]:
        want = "\n".join(x.split("</p>")[0] for x in page.split("x2>")[1].split("<p>")[1:])
        assert got[i] == (want, len(want))
    assert got[100][0] == "no url" and got[101][0] == "only page" and got[102] == got[103] == ("", 0)
    assert got[104][0] == got[215][0] == "copied" and extract(pages).count() == len(rows)
    assert extract(pages.limit(0)).count() == 0


def texts_of(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in extract(pages).collect()}


def test_deep_pages_are_aligned(spark):
    rows = [(i, "http://deep.example.com/", "<div>" * 3000 + f"story {i}") for i in range(4)]
    assert texts_of(spark, rows) == {i: f"story {i}" for i in range(4)}


@pytest.mark.parametrize("page,want", [
    ("<article><header class='entry-header'><h1 class=header>Head</h1></header><p>text</p></article>", "Head\ntext"),
    ("<article><div class='entry-header'>Head</div><p>text</p></article>", "Head\ntext"),
    ("<div class='layout has-sidebar'><p>text</p><div class=sidebar>side</div></div>", "text"),
    ("<div class='no-comments'><p>text</p><div id='user_comments'>no</div></div>", "text"),
    ("<div class='form-page'><p>text</p><p class='top-banner'>buy</p></div>", "text"),
    ("<h1>Head</h1><div class=search>" + "long words " * 40 + "</div>", "Head\n" + ("long words " * 40).strip()),
    ("<p>" + "long words " * 40 + "</p><div class=comments>" + "other words " * 40 + "</div>", ("long words " * 40).strip()),
    ("<h1>Head</h1><nav>" + "long words " * 40 + "</nav>", "Head"),
])
def test_names_are_whole_words_and_give_way(page, want):
    assert main_text(blocks(parse(page))) == want


def test_copies_and_rare_slots_do_not_flip_a_slot(spark):
    rows, want = [], {}
    for i in range(640):
        story = words(random.Random(i // 8 if i < 320 else i), 60, 5000)  # half of the pages are copies, eight of each
        rare = "<section><b>The same on few pages</b></section>" if 600 <= i < 606 else ""
        rows.append((i, "http://copies.example.org/", f"<div class=a><p>Fixed words</p></div><div class=b><p>{story}</p><i>{i} day</i></div>{rare}"))
        want[i] = story
    got = texts_of(spark, rows)
    assert all(want[i] in got[i] and "Fixed words" not in got[i] and "few pages" not in got[i] for i in want)


def test_articles_are_judged_like_the_rest(spark):
    rng = random.Random(6)
    story = [words(rng, 50, 5000) for _ in range(30)]
    rows = [(i, "http://main.example.com/", f"<main><div class=k><p>Fixed, without a name</p></div><p>{story[i]}</p></main>") for i in range(15)]
    rows += [(i, "http://cards.example.com/", f"<div class=s><p>{story[i]}</p></div><article class=card><p>Read this</p></article>"
              f"<article class='comment'><p>Comment {i}</p></article>") for i in range(15, 30)]
    # the same article on ten pages is not template, nor is one on its own host
    rows += [(100 + i, "http://main.example.com/", f"<main><div class=k><p>Fixed, without a name</p></div><p>{story[0]}</p></main>") for i in range(10)]
    rows += [(200 + i, "http://one.example.com/", f"<article><p>{story[1]}</p></article>") for i in range(5)]
    got = texts_of(spark, rows)
    assert got == {i: story[i] for i in range(30)} | {100 + i: story[0] for i in range(10)} | {200 + i: story[1] for i in range(5)}


def test_a_common_line_in_varying_slots_stays(spark):
    """A third of the articles of a hot host hold one sentence, anywhere; a fixed last line is
    template, and so is a fixed second one."""
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(600):
        story = [words(rng, 20, 9000) for _ in range(rng.randrange(2, 7))]
        if i % 3 == 0:
            story.insert(rng.randrange(len(story) + 1), "The sentence that a third of the articles share.")
        shown = story[:1] + ["Always second."] + story[1:] + ["Always last."]
        rows.append((i, "http://hot.example.com/", "<div class=b>" + "".join(f"<p>{p}</p>" for p in shown) + "</div>"))
        want[i] = "\n".join(story)
    assert texts_of(spark, rows) == want


def test_page_wide_form_and_clashing_columns(spark):
    story = [words(random.Random(i), 40, 5000) for i in range(8)]
    rows = [(i, None if i == 3 else "http://form.example.com/", f"<form id=f><h1>Head {i}</h1><p>{story[i]}</p></form><form><p>Your mail</p></form>") for i in range(8)]
    rows.append((None, "http://form.example.com/", "<p>no id"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("host", "slots", "_host", "path", "texts", "n_chars", "text", "mark", "page", "found"):
        pages = pages.withColumn(name, F.lit("clash"))
    got = {r.page_id: r.text for r in extract(pages).collect()}
    assert got == {i: f"Head {i}\n{story[i]}" for i in range(8)} | {None: "no id"}


@pytest.mark.parametrize("page", ["<div>" * 200_000 + "x", "<x-y>" * 20_000 + "</z>" * 20_000, "<li><div>" + "<x-y>" * 20_000 + "<li>a</li>" * 20_000,
                                  "<div>a" * 20_000, "<td><td>" * 20_000, "<p " + "class=" + "a" * 100_000 + "><div>" * 2000])
def test_hostile_pages_cost_as_much_as_they_are_long(page):
    began = time.process_time()
    tracemalloc.start()
    found = blocks(parse(page))
    main_text(found)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert time.process_time() - began < 40 and most < 300 << 20


def test_hot_host_is_split(spark):
    """Nine of ten pages on one host: the join with the wrappers deals them out."""
    rows = [(i, f"http://{'hot' if i % 10 else 'cold'}.example.com/{i}", f"<div><p>{words(random.Random(i), 60, 3000)}</p></div>") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    old = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    try:
        out = extract(pages)
        assert len(out.collect()) == 3000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# -- toxicity --------------------------------------------------------------------------

BAD = ["loserish", "scumbag", "vilestuff"]


def labelled(rng, n=600):
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.25
        w = words(rng, rng.randrange(10, 60)).split()
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(BAD).title() + ",")
        if toxic and rng.random() < 0.8 or rng.random() < 0.03:  # toxic texts name one group more often
            w.insert(rng.randrange(len(w)), "muslims")
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_neutral_mentions(spark):
    rng = random.Random(8)
    rows, labels = labelled(rng)
    extra = [(5000, "the muslims met their neighbours today"), (5001, "the christians met their neighbours today"), (5002, None), (5003, ""),
             (None, "a scumbag"), (None, "a scumbag"), (5004, "word " * 200_000 + "scumbag"), (3, rows[3][1])]
    known = label_frame(spark, labels + [(None, 1, 1), (3, None, None), (4, 1, None), (9999, 0, 1)])
    got = toxicity(frame(spark, rows + extra, extra=True), known).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all((r.predicted == 1) == (r.score >= THRESHOLD) and 0 <= r.score <= 1 for r in got)
    held = [(by[i].predicted, t) for i, _, t in labels if by[i].held_out]
    assert sum(p == t for p, t in held) >= 0.97 * len(held) > 50
    assert by[5004].predicted == 1 and by[None].predicted == 1 and by[5002].score == by[5003].score < THRESHOLD
    assert by[5000].predicted == 0
    # without the counterfactual term the named group would raise the score
    free = fit(frame(spark, rows), known, pull=0.0)
    tied = fit(frame(spark, rows), known, pull=20.0)
    from trilake.llm.toxicity import score
    pair = frame(spark, extra[:2])
    gap = lambda m: abs(np.subtract(*[np.log(r.score / (1 - r.score)) for r in score(pair, *m).orderBy("doc_id").collect()]))
    assert gap(tied) < 0.5 * gap(free)


def test_rejected_documents_go(spark):
    rng = random.Random(9)
    rows, labels = labelled(rng)
    docs = frame(spark, rows + [(None, None), (7000, "scumbag")], extra=True)
    kept = drop_toxic(docs, label_frame(spark, labels))
    good = {r.doc_id for r in toxicity(docs, label_frame(spark, labels)).collect() if not r.predicted}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == good and 7000 not in good


def test_a_repeated_id_is_one_training_row(spark):
    rng = random.Random(10)
    rows, labels = labelled(rng, 60)
    rows += [(1, f"scumbag {i}") for i in range(3000)]  # one labelled id on most rows
    got = training_rows(frame(spark, rows, extra=True), label_frame(spark, labels), 20, "text").collect()
    assert 0 < len(got) <= 20
    assert len(training_rows(frame(spark, rows), label_frame(spark, labels), 1000, "text").collect()) == sum(
        zlib.crc32(str(i).encode()) % 4 != 2 for i, _, _ in labels)


def test_no_or_one_sided_labels(spark):
    docs = frame(spark, [(1, "a"), (2, None)])
    for labels in ([], [(1, 1, 0)], [(1, 1, 1)]):
        got = toxicity(docs, label_frame(spark, labels)).collect()
        assert len({r.score for r in got}) == 1 and len(got) == 2
    assert toxicity(empty(spark), label_frame(spark, [(1, 1, 0)])).count() == 0
