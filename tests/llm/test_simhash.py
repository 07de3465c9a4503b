import random
import re

import numpy as np
import pytest
import xxhash

from trilake.llm import simhash
from trilake.llm.components import star_components
from trilake.llm.simhash import Index, drop_near_duplicates, near_duplicates

from .util import empty, frame, table, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute(rows, most):
    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    least = {r: min((d for d in g if d is not None), default=None) for r, g in ids.items()}
    return sorted(((d, fp, least[find(i)]) for i, ((d, _), fp) in enumerate(zip(rows, fps))),
                  key=lambda t: tuple((x is not None, x) for x in t))


def corpus(seed=3):
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randrange(1, 80))) for i in range(40)]
    for i in range(40, 120):  # copies with a few words changed
        w = words(random.Random(rng.randrange(8)), 150).split()
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = "edited"
        rows.append((i, "  ".join(w).upper() if i % 3 else "\t".join(w)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "One"), (205, "two words"), (206, "a b\xa0c d é É"),
             (None, "one"), (None, words(rng, 30)), (5, "repeated id"), (5, "repeated id"), (5, "another text"),
             (207, words(rng, 20_000))]
    return rows


@pytest.mark.parametrize("most,bucket_rows", [(2, 20_000), (3, 4)])
def test_groups_equal_brute_force(spark, most, bucket_rows):
    rows = corpus()
    got = near_duplicates(frame(spark, rows, extra=True), 3, most, bucket_rows=bucket_rows).collect()
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=lambda t: tuple((x is not None, x) for x in t))
    assert got == brute(rows, most)


def groups(rows):
    """The rows of each component, by brute force."""
    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    out = {}
    for row, g in zip(rows, group):
        out.setdefault(g, []).append(row)
    return list(out.values())


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    kept = table(drop_near_duplicates(frame(spark, rows, extra=True)), "doc_id", "text")
    # one for each component, not for each id: three unrelated texts of the corpus have id 5
    least = [min((i for i, _ in g if i is not None), default=None) for g in groups(rows)]
    assert sorted(i for i, _ in kept if i is not None) == sorted(i for i in least if i is not None)
    assert sum(i is None for i, _ in kept) == least.count(None)
    assert drop_near_duplicates(empty(spark)).count() == 0
    assert near_duplicates(empty(spark)).count() == 0


def test_star_of_a_hot_node_is_split(spark):
    from trilake.llm import components
    from .test_html_toxicity import HOT
    edges = spark.range(1, 60_000).selectExpr("id as a", "0L as b").union(spark.range(70_000, 90_000).selectExpr("id + 1 as a", "id as b"))
    old = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    try:
        for star in (components._large_star, components._small_star):
            out = star(components.materialise(edges, "edges").selectExpr("greatest(a, b) as a", "least(a, b) as b")
                       if star is components._large_star else components.materialise(edges.selectExpr("b as a", "a as b"), "edges"))
            out.write.format("noop").mode("overwrite").save()
            rows = out.collect()
            assert rows and "skew=true" in out._jdf.queryExecution().executedPlan().toString(), star
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_groups_with_null_and_repeated_ids_keep_one_row_each(spark):
    rng = random.Random(21)
    rows = corpus() + [(None, words(rng, 40)) for _ in range(6)] + [(9001, words(rng, 40)) for _ in range(4)] + [(None, None)]
    rows += [(None, rows[-3][1]), (None, rows[-3][1])]  # equal to a text that has an id
    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2 and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    members = {}
    for row, g in zip(rows, group):
        members.setdefault(g, []).append(row)
    kept = [tuple(r) for r in drop_near_duplicates(frame(spark, rows, extra=True)).select("doc_id", "text").collect()]
    least = lambda g: min((i for i, _ in g if i is not None), default=None)
    of = {row: g for row, g in zip(rows, group)}
    assert sorted(of[row] for row in kept) == sorted(members)
    assert all(row[0] == least(members[of[row]]) for row in kept)
    assert sum(i is None for i, _ in kept) >= 6 and sum(i == 5 for i, _ in kept) == 3


def test_index_finds_every_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    near = np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(12)])
    fp = np.unique(np.concatenate([base, near]))
    bucket = rng.integers(0, 3, len(fp))
    index = Index(fp, bucket)
    own, ids = index.levels[0][1], bucket[index.order]
    got = {(int(min(own[a], own[b])), int(max(own[a], own[b]))) for i, j in index.links(2, 64) for a, b in zip(i, j)}
    want = {(int(min(x, y)), int(max(x, y))) for i, x in enumerate(own) for j, y in enumerate(own[:i])
            if ids[i] == ids[j] and int(x ^ y).bit_count() <= 2}
    assert got == want and len(want) > 300


def test_pairs_of_one_component_are_left_out():
    """A bucket of very many near fingerprints: most pairs of nodes are dropped unseen, and the
    groups are those of all links."""
    ball = [1 << a ^ 1 << b ^ 1 << c for a in range(64) for b in range(a) for c in range(b)][::7]
    fp = np.array(sorted(set(ball) | {(x ^ (1 << 64) - 1) for x in ball[::5]}), np.uint64)
    bucket = np.zeros(len(fp), np.int64)
    index = Index(fp, bucket)
    label, seen = np.arange(len(fp)), 0
    for i, j in index.links(2, 1 << 10, label):
        seen += len(i)
        simhash._merge(label, i, j)
    whole, every = np.arange(len(fp)), 0
    for i, j in index.links(2, 1 << 10):
        every += len(i)
        simhash._merge(whole, i, j)
    assert (label == whole).all() and 3 * seen < every


def test_gray_rank_orders_the_code():
    x = np.arange(1 << 10, dtype=np.uint64)
    assert (simhash.gray_rank(x ^ (x >> np.uint64(1))) == x).all()


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(5, 5), (7, 8), (300, -3)]
    got = {r.node: r.root for r in star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{i: 100 for i in range(101, 160)}, 201: 200, 202: 200, 300: -3}


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 40)
    for _, text in corpus()[:60]:
        for n in (1, 3, 5):
            assert simhash.fingerprint(text or "", n) == fingerprint(text, n)
