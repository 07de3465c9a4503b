import importlib
import random

import numpy as np
from pyspark.sql import functions as F

from trilake.llm.ann import build_graph, clean_vectors, nearest, nodes_of, search

from .util import SCHEMA, words

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in queries:
        own = x[ids == q][0]
        s = (x * own).sum(axis=1) / (norm * np.sqrt((own * own).sum()))
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_recall_ties_and_cases(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    x[200:700] = x[200]  # a third are copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2050, [0.0] * 24), (2100, [float("nan")] * 24), (2150, [float("inf")] + [1.0] * 23),
           (2200, [1.0, None] * 12), (2250, [1.0] * 5), (2300, []), (None, x[0].tolist()), (5, rows[5][1]), (50, rows[50][1])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], VECTORS).withColumn("a", F.lit("clash")).withColumn("s", F.lit(1)).repartition(3)
    assert clean_vectors(table).count() == 1500
    queries = table.where("vec_id % 50 = 0").select("vec_id")
    got: dict = {}
    for r in nearest(table, queries, 5).orderBy("query_id", "rank").collect():
        assert r.rank == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    want = brute(rows, range(0, 1500, 50))
    assert set(got) == set(want)
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = dict(want[300])
    assert [a for a, _ in got[300]] == [200, 201, 202, 203, 204] == list(exact)  # copies: the smaller ids
    for q in want:
        known = brute(rows, [q], 1500)[q]
        assert all(abs(dict(known)[a] - s) < 1e-12 for a, s in got[q])


def test_few_candidates(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0], 0)], VECTORS)
    assert nearest(one, one.select("vec_id")).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [2.0, 4.5], 0), (50, [-1.0, 0.0], 0)], VECTORS)
    got = [tuple(r)[:3] for r in nearest(two, two.where("vec_id % 50 = 0").select("vec_id")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)] or got == [(0, 1, 1), (0, 2, 50), (50, 1, 0), (50, 2, 1)]
    assert nearest(two.limit(0), two.select("vec_id")).count() == 0


def recall(spark, x, step=50):
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    got: dict = {}
    for r in nearest(table, table.where(f"vec_id % {step} = 0").select("vec_id")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows, range(0, len(rows), step))
    return sum(len(got[q] & {a for a, _ in want[q]}) for q in want) / (5 * len(want))


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2400, 24))
    for at, noise in ((400, 1e-4), (1400, 1e-3)):  # no two equal, hardly any 8-bit code of them differs
        x[at:at + 1000] = x[at] + noise * rng.standard_normal((1000, 24))
    x = x.astype(np.float32)
    assert len(np.unique(x, axis=0)) == 2400
    assert recall(spark, x) >= 0.9


def test_search_ends_only_when_all_is_opened(spark):
    angle = np.linspace(0, 1.5, 16)
    table = spark.createDataFrame([(i, [float(np.cos(t)), float(np.sin(t))], 0) for i, t in enumerate(angle)], VECTORS)
    nodes, _ = nodes_of(clean_vectors(table))
    path = spark.createDataFrame([(i, i + 1, 0.5, 0) for i in range(15)], "a long, b long, s double, new int")
    entry = nodes.where("a = 0").selectExpr("a as query", "q", "scale", "array(15L) as entry")
    assert {r.b for r in search(nodes, path, entry).collect()} == set(range(16))


def test_graph_rounds_go_on_until_few_entries_are_new(spark):
    x = np.random.default_rng(7).standard_normal((1200, 8)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    nodes, _ = nodes_of(clean_vectors(table))
    got: dict = {}
    for r in build_graph(nodes, degree=10, width=14, starts=2, block=24).collect():
        got.setdefault(r.a, set()).add(r.b)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    best = np.argsort(-s, axis=1)[:, :10]
    assert sum(len(got[i] & set(best[i].tolist())) for i in range(1200)) >= 0.9 * 12_000


def test_only_pairs_with_a_new_neighbour_are_compared(spark):
    """The graph is that of comparing all pairs in every round, owners without a new neighbour
    get no vectors, and a pair of old neighbours gives no edge."""
    from trilake.llm import ann
    x = np.random.default_rng(11).standard_normal((500, 8)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    nodes, _ = nodes_of(clean_vectors(table))
    how = {"degree": 6, "width": 9, "starts": 2, "block": 16, "few": 0.0}
    edges = lambda g: sorted((r.a, r.b, r.s) for r in g.collect())
    flagged, joined, plain = ann._who_is_new, ann._local_joins, []
    sent = []

    def count(near, degree):
        sent.append(near.count())
        return joined(near, degree)

    ann._local_joins = count
    try:
        got = edges(build_graph(nodes, **how))
        with_flags, sent = sent, []
        ann._who_is_new = lambda around, met: flagged(around, None)
        plain = edges(build_graph(nodes, **how))
    finally:
        ann._who_is_new, ann._local_joins = flagged, joined
    assert got == plain
    assert len(with_flags) == len(sent) and with_flags[0] == sent[0] and with_flags[-1] < 0.2 * sent[-1], (with_flags, sent)
    near = nodes.where("a < 6").selectExpr("0L as owner", "a", "int(a = 5) as new", "q", "scale", "-2.0D as least")
    assert {(r.a, r.b) for r in joined(near, 6).collect()} == {(i, 5) for i in range(5)} | {(5, i) for i in range(5)}


def test_lists_are_cut_by_windows(spark):
    """No Python stage cuts lists or adjacency, and they are those of the plain cut."""
    from trilake.llm import ann
    rng = random.Random(17)
    own = {(a, b): ((a * b + a + b) % 40 / 40, rng.randrange(2)) for a in range(60) for b in rng.sample(range(60), 9) if a != b}
    own |= {(a, 60): (0.9, a % 2) for a in range(60)}  # many choose this one
    one = [(a, b, s, new) for (a, b), (s, new) in own.items()]
    again = [(a, b, s, 1) for a, b, s, _ in one[::2]]
    frame = lambda rows: spark.createDataFrame(rows, ann._EDGES).repartition(5)

    def plain(rows, n):
        a, b, s, new = (np.array(c) for c in zip(*rows))
        return sorted(zip(*(x.tolist() for x in ann._best(a, b, s, new, n))))

    turned = [(b, a, s, new) for a, b, s, new in one]
    for got, want in ((ann._top(frame(one + again), 4), plain(one + again, 4)), (ann._adjacency(frame(one), 5), plain(one + turned, 5))):
        assert "Arrow" not in got._jdf.queryExecution().toString()
        assert sorted(tuple(r) for r in got.collect()) == want


def test_search_opens_the_entry_nodes_at_once(spark, monkeypatch):
    from trilake.llm import ann
    table = spark.createDataFrame([(i, [float(np.cos(i / 9)), float(np.sin(i / 9))], 0) for i in range(9)], VECTORS)
    nodes, _ = nodes_of(clean_vectors(table))
    star = spark.createDataFrame([(0, i, 0.5, 0) for i in range(1, 9)], "a long, b long, s double, new int")
    entry = nodes.where("a = 0").selectExpr("a as query", "q", "scale", "array(0L) as entry")
    written, write = [], ann.materialise
    monkeypatch.setattr(ann, "materialise", lambda df, name: (written.append(name), write(df, name))[1])
    assert {r.b for r in search(nodes, star, entry).collect()} == set(range(9))
    assert written.count("beam") == 2


def test_search_in_many_small_blocks(spark):
    from trilake.llm import ann
    x = np.random.default_rng(13).standard_normal((900, 16)).astype(np.float32)
    old = ann.SEARCH_BYTES, ann.SEARCH_PAIRS
    ann.SEARCH_BYTES, ann.SEARCH_PAIRS = 2_000, 50  # 29 blocks, a few queries at a time
    try:
        assert recall(spark, x) >= 0.9
    finally:
        ann.SEARCH_BYTES, ann.SEARCH_PAIRS = old


def test_pipeline_stages_chain(spark, tmp_dir):
    corpus_pipeline = importlib.import_module("corpus_pipeline")
    from .test_decontaminate_urls import brute as contaminated
    from .test_simhash import brute as groups
    from .test_suffix_dedup import brute as repeats
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, words(rng, 40, 5000) + (" scumbag " if toxic else " ") + words(rng, 10, 5000)))
        labels.append((i, 1, int(toxic)))
    passage, item = words(rng, 60), words(rng, 30)
    rows += [(1000, words(rng, 20) + " " + passage), (1001, words(rng, 25) + " " + passage), (1002, rows[1][1]), (1003, None), (1004, ""),
             (1005, words(rng, 5) + " " + item), (1006, "a scumbag text"), (None, "no id")]
    make = lambda r, s: spark.createDataFrame(r, s)
    docs = make([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    make(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    make([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    key = lambda t: tuple((x is not None, x) for x in t)
    state = [(r.doc_id, r.text) for r in docs.collect()]
    frame, seen = spark.read.parquet(f"{tmp_dir}/documents.parquet"), []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frame, tmp_dir)
        if n == 4:
            seen.append({r.doc_id for r in out.collect()})
            assert seen[-1] == {i for i, _ in state}
            break
        assert out.columns == docs.columns
        out = make([tuple(r) for r in out.collect()], SCHEMA)
        now = sorted(((r.doc_id, r.text) for r in out.collect()), key=key)
        if n == 0:
            want = [(i, t) for i, t in state if "scumbag" not in (t or "")]
        elif n == 1:
            want = [(d, t) for (d, t), c in zip(state, [dict((x, z) for x, _, z in groups(state, 2))[d] for d, _ in state]) if d == c]
        elif n == 2:
            assert {i: len((t or "").encode()) for i, t in now} == {r[0]: r[1] - r[2] for r in repeats(state, 100)}
            assert [r.n_chars == len(r.text) for r in out.collect() if r.text is not None].count(False) == 0
            want = now
        else:
            bad = {r[0] for r in contaminated(state, [(1, item)]) if r[5]}
            want = [(i, t) for i, t in state if i not in bad]
        assert now == sorted(want, key=key), name
        state, frame = now, out
    ids = {i for i, _ in state}
    assert 1006 not in ids and 1002 not in ids and 1005 not in ids and 1000 in ids and 1001 in ids
    got = corpus_pipeline.run(spark, tmp_dir)
    assert {r.doc_id for r in got.collect()} == ids
