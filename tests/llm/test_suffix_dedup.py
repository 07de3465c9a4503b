import hashlib
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from trilake.llm import suffix_dedup, suffix_order
from trilake.llm.suffix_dedup import remove_repeats, repeat_report

from .util import empty, frame, table, words


def brute(rows, length):
    """Per row: bytes, removed, spans, hash of the rest."""
    docs = sorted({(-1 if i is None else i, t or "") for i, t in rows}, key=lambda d: (d[0], _th(d[1])))
    seen, gone = set(), {}
    for i, t in docs:
        data, mark = t.encode(), set()
        for a in range(len(data) - length + 1):
            s = data[a:a + length]
            if s in seen:
                mark |= set(range(a, a + length))
            seen.add(s)
        gone[i, t] = mark
    out = []
    for i, t in rows:
        data, mark = (t or "").encode(), gone[-1 if i is None else i, t or ""]
        spans = sum(1 for x in mark if x - 1 not in mark)
        rest = bytes(b for a, b in enumerate(data) if a not in mark)
        out.append((i, len(data), len(mark), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


def _th(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def corpus(seed=4):
    rng = random.Random(seed)
    passages = [words(rng, rng.randrange(15, 60)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [words(rng, rng.randrange(0, 40)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passages))
        rows.append((rng.randrange(10_000) * 100 + i, " ".join(parts)))
    base = words(rng, 200)
    for i in range(40):  # near copies
        w = base.split()
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = "edit" + str(rng.randrange(9))
        rows.append((5000 + i, " ".join(w)))
    rows += [(7000 + i, passages[0]) for i in range(10)]  # exact copies
    rows += [(1, None), (2, ""), (3, "short"), (4, "ab" * 700), (6, "a" * 501), (8, "ab" * 400 + "é" * 90), (9, "é" * 300),
             (None, passages[1]), (None, passages[1]), (None, passages[2] + "."), (11, base), (11, base), (11, base + " tail"),
             (12, "x" * 99), (13, "x" * 100), (14, "\x00\x01" * 120), (15, words(rng, 3000) + base)]
    return rows


@pytest.mark.parametrize("split_rows,task_rows,hot_contents", [(20_000, 100, 1000), (6, 3, 20), (20_000, 100, 2), (6, 3, 1)])
def test_report_equals_brute_force(spark, split_rows, task_rows, hot_contents):
    rows = corpus()
    got = table(repeat_report(frame(spark, rows, extra=True), 100, split_rows=split_rows, task_rows=task_rows,
                              hot_contents=hot_contents))
    assert got == brute(rows, 100)


def test_other_length_and_stretches(spark, monkeypatch):
    rows = corpus(9)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 256)  # texts are scanned in several stretches
    monkeypatch.setattr(suffix_dedup, "GATHER_BYTES", 2000)
    scan = suffix_dedup._scan(40, 16, 8)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array([rows[-1][1]])], names=["did", "_th", "text"])
    out = list(scan([batch]))
    n = sum(s + 1 for b in out for i in range(b.num_rows) for s in b.column("span")[i].as_py())
    assert n == len(rows[-1][1].encode()) - 39
    got = table(repeat_report(frame(spark, rows), 40, k=16))
    assert got == brute(rows, 40)


def test_equal_content_hashes_do_not_settle(monkeypatch):
    """Segments whose 64-bit hash is the same are still told apart, and buckets that share a
    task are settled one by one."""
    import pyarrow as pa
    docs = sorted({(i, t) for i, t in corpus(5) if i is not None and t}, key=lambda d: d[0])
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*((i, _th(t), t) for i, t in docs))], names=["did", "_th", "text"])

    def settled():
        rows = pa.Table.from_batches(suffix_dedup._scan(100, 32, 8)([batch])).sort_by("bucket")
        out = [r for b in suffix_dedup._settle(8)(rows.to_batches(max_chunksize=3)) for r in b.to_pylist()]
        starts = {(r["did"], r["th"], x) for r in out if r["key"] is None for x in range(r["lo"], r["hi"] + 1)}
        return starts, sorted((r["key"], r["did"], r["th"], r["lo"], r["hi"]) for r in out if r["key"] is not None)

    want = settled()
    assert want[0] and want[1]
    plain = suffix_dedup.segments
    monkeypatch.setattr(suffix_dedup, "segments", lambda *a: (*plain(*a)[:5], np.zeros_like(plain(*a)[5]), plain(*a)[6]))
    assert settled() == want


def test_a_phrase_in_many_texts_fills_many_buckets(spark):
    """A 64-byte phrase with other words around it in every text: its anchors are found by the
    sample, their segments are dealt over all the buckets, and the report is as without."""
    import pyarrow as pa
    rng = random.Random(8)
    phrase = "".join(rng.choice("abcdefgh") for _ in range(64))
    rows = [(i, f"{words(rng, 12, 10**6)} {phrase} {words(rng, 12, 10**6)}") for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 300, 3)]
    docs = frame(spark, rows)
    hot = suffix_dedup.hot_anchors(docs, 100, 32)
    assert 1 <= len(hot) < 64 and (np.diff(hot.astype(object)) > 0).all()
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*((i, _th(t), t) for i, t in rows))], names=["did", "_th", "text"])

    def largest(hot):
        rows = pa.Table.from_batches(suffix_dedup._scan(100, 32, 16, hot)([batch])).to_pylist()
        sizes = [len(r["h"]) for r in rows if r["h"]]
        assert max(r["bucket"] for r in rows) < 32
        return max(sizes), sum(sizes)

    salted, plain = largest(hot), largest(hot[:0])
    assert salted[1] == plain[1] and salted[0] < plain[0]
    starts, firsts = [], []
    for h in (hot, hot[:0]):
        rows_ = pa.Table.from_batches(suffix_dedup._scan(100, 32, 16, h)([batch])).sort_by("bucket")
        out = [r for b in suffix_dedup._settle(16)(rows_.to_batches()) for r in b.to_pylist()]
        starts.append({(r["did"], x) for r in out if r["key"] is None for x in range(r["lo"], r["hi"] + 1)})
        firsts.append(sorted((r["did"], r["lo"], r["hi"], r["anchor"]) for r in out if r["key"] is not None))
    assert starts[0] == starts[1] and firsts[0] == firsts[1]
    assert table(repeat_report(docs, 100)) == brute(rows, 100)
    assert len(suffix_dedup.hot_anchors(empty(spark), 100, 32)) == 0


def test_digests_are_those_of_the_bytes():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 3000).astype(np.uint8)
    raw[1500:1700], raw[2000:2200] = raw[100:300], raw[100:300]
    raw[2100] ^= 1
    first = np.array([100, 1500, 2000, 100, 0])
    end = np.array([300, 1700, 2200, 299, 3000])
    p, got = (1 << 31) - 1, suffix_dedup._digests(raw, first, end).tolist()
    for a, b, d in zip(first, end, got):
        one, two = (sum((int(c) + 1) * pow(base, i, p) for i, c in enumerate(raw[a:b])) % p for base in suffix_dedup._BASES)
        assert d == one << 31 | two
    assert got[0] == got[1] and len(set(got)) == 4


def test_sorting_holds_few_bytes_at_a_time(monkeypatch):
    """A sweep's arrays take about 100 bytes for each byte sorted: 2 MB of segments are sorted in
    several sweeps, and all repeats are found."""
    import numpy as np
    import pyarrow as pa
    from trilake.llm import suffix_dedup
    text = np.random.default_rng(3).integers(97, 123, 300_000).astype(np.uint8).tobytes()
    rows = []
    for key in range(8000):  # a string of 100 bytes in two segments that differ
        at = 31 * key
        rows += [(key, 2 * key, 0, 0, 30, 10, 42, text[at:at + 130]), (key, 2 * key + 1, 0, 0, 30, 10, 42, text[at:at + 120] + b"-" * 10)]
    names = ("key", "did", "th", "lo", "hi", "c0", "c1", "bytes")
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "bytes" else pa.int64()) for n, c in zip(names, zip(*rows))], names=names)
    swept, sort = [], suffix_dedup.sorted_repeats
    monkeypatch.setattr(suffix_dedup, "sorted_repeats",
                        lambda buckets, length: (swept.append(sum(len(r[7]) for rows in buckets for r in rows)), sort(buckets, length))[1])
    got = [r for b in suffix_dedup._sort(100, 100)([batch]) for r in b.to_pylist()]
    assert sum(swept) == 2_080_000 and max(swept) <= (1 << 19) + 260
    assert sorted((r["did"], r["lo"], r["hi"]) for r in got) == [(2 * key + 1, 0, 20) for key in range(8000)]


def test_tasks_begin_without_what_other_operators_remember(spark, monkeypatch):
    """A worker comes from other stages: every task of this one drops their memory."""
    from pyspark.sql.classic.dataframe import DataFrame
    from trilake.llm import packing
    tasks, plain = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda df, task, *a, **b: (tasks.append(task), plain(df, task, *a, **b))[1])
    docs = frame(spark, corpus())
    repeat_report(docs, split_rows=6, task_rows=3), remove_repeats(docs)
    assert len(tasks) >= 10
    for task in tasks:
        packing._ENCODERS["vocabulary", "ids"] = (None, {"chunk": b"1234"})
        assert sum(b.num_rows for b in task(iter(()))) == 0
        assert not packing._ENCODERS


def test_a_bucket_is_settled_in_few_copies():
    """numpy's memory for a bucket of a million segments, 53 bytes each, half of them repeats."""
    import tracemalloc

    import pyarrow as pa
    n = 1_000_000
    rng = np.random.default_rng(6)
    h = rng.integers(0, n // 4, n // 2).astype(np.int32)
    content = rng.integers(0, 1 << 62, n // 2)
    columns = [np.arange(n), np.arange(n), np.zeros(n, np.int64), np.full(n, 30), np.full(n, 10, np.int8),
               np.tile(h, 2), np.tile(content, 2), np.tile(content + 1, 2)]
    lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(c)) for c in columns]
    batch = pa.RecordBatch.from_arrays([pa.array([3], pa.int32()), *lists], names=["bucket", *suffix_dedup._LISTS])
    tracemalloc.start()
    later = several = 0
    for b in suffix_dedup._settle(8)(iter([batch])):
        later += b.column("key").null_count
        several += b.num_rows - b.column("key").null_count
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    _, at, count = np.unique(h, return_inverse=True, return_counts=True)
    assert later == n // 2 and several == int((count[at] > 1).sum())
    assert peak < 115 * n


def test_texts_after_removal(spark):
    rows = corpus()
    out = remove_repeats(frame(spark, rows, extra=True))
    assert out.columns == frame(spark, rows, extra=True).columns
    texts = {r.doc_id: r.text for r in out.where("doc_id in (1, 2, 3, 12, 13, 7009)").collect()}
    assert texts[1] is None and texts[2] == "" and texts[3] == "short" and texts[12] == "x" * 99 and texts[7009] == ""
    assert repeat_report(empty(spark)).count() == 0 and remove_repeats(empty(spark)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=40), min_size=1, max_size=8), st.sampled_from([0, 48, 10**9]))
def test_suffix_order(strings, narrow):
    old, suffix_order.NARROW = suffix_order.NARROW, narrow
    flat, start = [], []
    for s in strings:
        start.append(len(flat))
        flat += [*s, 0]
    got = suffix_order.suffix_order(np.array(flat), np.array(start))
    suffix_order.NARROW = old
    for a, b in zip(start, [*start[1:], len(flat)]):
        assert got[a:b].tolist() == sorted(range(a, b), key=lambda i: flat[i:b])


def test_suffix_order_of_runs():
    for s in ([1] * 500, [1, 2] * 200, [2, 1] * 200, list(range(1, 90)), list(range(90, 0, -1)), [1, 1, 2] * 100):
        flat = np.array([*s, 0])
        assert suffix_order.suffix_order(flat, np.array([0])).tolist() == sorted(range(len(flat)), key=lambda i: flat.tolist()[i:])
