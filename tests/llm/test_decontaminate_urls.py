import random
import re

from trilake.llm.decontaminate import benchmark_tables, contamination, drop_contaminated, window_classes
from trilake.llm.url_reputation import host_reputation, judge_urls, url_parts

from .util import empty, frame, table, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items, window=13):
    wins = {}
    for item, t in items:
        w = split(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for i, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in wins}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in wins:
                    hit |= set(range(j, j + n))
                    found |= wins[tuple(w[j:j + n])]
        found.discard(None)
        out.append((i, len(w), len(hit), len(found), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=lambda t: (t[0] is not None, t))


def corpus():
    rng = random.Random(5)
    items = [(i, words(rng, rng.randrange(14, 60))) for i in range(12)]
    items += [(50, "three short Words"), (51, "one"), (52, None), (53, ""), (54, words(rng, 12)), (None, words(rng, 20)),
              (2, items[3][1]), (60, items[4][1]), (61, "aa " * 30)]
    docs = [(i, words(rng, rng.randrange(0, 200))) for i in range(20)]
    for i in range(20, 60):
        item = split(rng.choice(items)[1] or "x")
        a = rng.randrange(max(1, len(item) - 12))
        part = " ".join(item[a:a + rng.randrange(5, 40)])
        docs.append((i, words(rng, rng.randrange(0, 300)) + " " + part.upper() + ", " + words(rng, rng.randrange(0, 60))))
    docs += [(70, None), (71, ""), (72, "one"), (73, "THREE, short--words! three short words"), (74, "aa " * 50),
             (75, words(rng, 5000) + " " + items[0][1]), (None, items[0][1]), (None, items[0][1]), (80, items[1][1]),
             (80, items[1][1]), (80, "another text of this id"), (81, "é" * 5000 + " ünï " + items[5][1])]
    return docs, items


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_contamination_equals_brute_force(spark):
    docs, items = corpus()
    got = contamination(frame(spark, docs, extra=True), bench(spark, items))
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in got.collect()),
                  key=lambda t: (t[0] is not None, t))
    assert rows == brute(docs, items)
    kept = table(drop_contaminated(frame(spark, docs, extra=True), bench(spark, items)), "doc_id")
    assert [k[0] for k in kept] == [r[0] for r in brute(docs, items) if not r[5]]


def test_other_windows(spark):
    docs, items = corpus()
    got = contamination(frame(spark, docs), bench(spark, items), window=5, k=3)
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in got.collect()),
                  key=lambda t: (t[0] is not None, t))
    assert rows == brute(docs, items, 5)


def test_a_passage_of_many_items_is_one_class(spark):
    """A passage in 300 items and 200 documents: its windows are one class, the documents'
    items are put together once."""
    rng = random.Random(3)
    passage = words(rng, 30)
    items = [(i, f"{words(rng, 5, 10**6)} {passage}") for i in range(300)] + [(900, passage), (901, words(rng, 40))]
    docs = [(i, f"{words(rng, 40, 10**6)} {passage}") for i in range(200)] + [(500, items[-1][1]), (501, items[7][1])]
    _, windows = benchmark_tables(bench(spark, items), 13, 8)
    of, members = window_classes(windows)
    assert of.groupBy("class").count().where("count > 1").count() == 302  # the passage, and each item's own windows
    assert members.count() == 301 + 300 + 1
    got = contamination(frame(spark, docs, extra=True), bench(spark, items))
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in got.collect()),
                  key=lambda t: (t[0] is not None, t))
    assert rows == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus()
    assert contamination(empty(spark), bench(spark, items)).count() == 0
    assert contamination(frame(spark, docs), bench(spark, [])).where("contaminated or n_hit > 0").count() == 0


URLS = ["http://A.Example.NET/en/x?y", "https://example.com/de/1", "http://x.org/fr/2#z", "http://x.org/en/2", "ftp://net", None,
        "no scheme", "http://", "http:///path", "http://notexample.net/en/", "http://example.net/EN/", "http://h.co.uk?q=://a/",
        "http://good.com/1", "http://bad.com/1", "HTTP://ÄB.com/ä#"]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(URLS)], "page_id long, url string, html string")
    parts = {r.page_id: (r.host, r.path) for r in url_parts(pages).collect()}
    assert parts[0] == ("a.example.net", "/en/x") and parts[5] == parts[6] == ("", "") and parts[8] == ("", "/path")
    assert parts[11] == ("h.co.uk", "") and parts[14] == ("Äb.com", "/ä")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, none).collect()}
    assert len(got) == len(URLS)
    assert got[0] == ("example.net/en/", "allow") and got[1] == ("example.com/de/", "block")
    assert got[2] == ("org/fr/", "allow") and got[3][0] is None
    assert parts[4] == ("net", "") and got[4][0] is None  # no path, so the rule's "/" does not fit
    assert got[9] == ("net/", "block") and got[10] == ("net/", "block")
    assert judge_urls(pages.limit(0), none).count() == 0


def test_shrinkage(spark):
    rows, labels, page = [], [], 0
    for host, n, bad in (("a.good.com", 60, 0), ("b.good.com", 1, 1), ("a.bad.org", 60, 60), ("b.bad.org", 2, 1), ("c.bad.org", 0, 0)):
        for i in range(max(n, 1)):
            rows.append((page, f"http://{host}/{i}"))
            if i < n:
                labels += [(page, int(i < bad))] * 2  # repeated labels count once
            page += 1
    labels += [(None, 1), (10_000, 1), (3, None)]
    pages = url_parts(spark.createDataFrame(rows, "page_id long, url string"))
    got = {r.host: r for r in host_reputation(pages, spark.createDataFrame(labels, "page_id long, bad int")).collect()}
    assert got["a.good.com"].n == 60 and got["a.good.com"].verdict == "allow" and got["a.bad.org"].verdict == "block"
    assert got["b.good.com"].mean < 0.6 < got["b.bad.org"].mean  # one bad page of one is shrunk to its domain
    assert got["c.bad.org"].n == 0 and got["c.bad.org"].verdict == "block"


def test_long_texts_are_scanned_in_stretches(spark, monkeypatch):
    import pyarrow as pa

    from trilake.llm import decontaminate as D
    docs, items = corpus()
    text = " ".join(t for _, t in docs if t) + " " + items[2][1]
    prints, _ = D.benchmark_tables(bench(spark, items), 13, D.GRAM)
    scans = []
    real = D.document_key
    for piece in (1 << 22, 300):
        monkeypatch.setattr(D, "PIECE", piece)
        got = {}

        class Catch:
            def mapInArrow(self, scan, schema):
                [batch] = list(scan([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], names=["doc_id", "_th", "text"])]))
                got["row"] = batch.to_pylist()[0]

        monkeypatch.setattr(D, "document_key", lambda docs, text: Catch())
        monkeypatch.setattr(D, "materialise", lambda df, name: df)
        D.document_hits(None, prints, 13, D.GRAM)
        monkeypatch.setattr(D, "document_key", real)
        scans.append((got["row"]["n_words"], {(h["n"], h["at"] + j, " ".join(w[j:j + h["n"]])) for h in got["row"]["hits"]
                                              for w in [h["words"].split(" ")] for j in range(len(w) - h["n"] + 1)}))
    assert scans[0] == scans[1] and len(scans[0][1]) > 20
