"""Best-fit packing of token pieces into sequences.

1. ``token_pieces`` encodes every text once and cuts only documents longer than the
   capacity. A text is a run of chunks, lower-cased words and what stands between them (this
   tokenizer lower-cases, drops white space and never joins across it or from a letter to a
   stop), so each task encodes a block's distinct chunks once and gathers the texts' ids from
   theirs.
2. ``pack`` range-sorts the pieces by length over the cluster. Equal lengths are one run of
   ranks and equal gaps one run of sequences, so pieces and gaps are at most about
   ``capacity`` rows each, however many documents there are.
3. ``best_fit_rounds`` matches them in bulk-synchronous rounds. Runs of pieces and gaps are
   dealt by ranges of size; each task sweeps its range from large to small, and a piece takes
   the smallest gap passed that is still free: its successor among the gaps. What a range
   could not match meets in one last sweep of the round (matching is nested like brackets, so
   the ranges' own matches stand). Pieces that want one gap are settled by rank, the longest
   first; a gap takes as many pieces of a run as it holds; gaps shrink, and the next round
   begins. Pieces longer than every gap open sequences: all of those above half the capacity,
   else, longest first, three quarters of what their volume needs (all, if that is little).
4. A piece's global rank in its length is looked up in the matches of that length. A hot
   length is spread over many partitions and is never a group in one task.

Cases: null text is empty and has only the closing id; null and repeated doc_ids are
ordinary; repeated rows are packed twice; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window, functions as F

from .common import materialise, range_sorted, remembered, text_blocks, utf8

#: Distinct chunks that a Python worker remembers; beyond it starts anew (no effect on results).
CACHE_ENTRIES = 1 << 20
#: The same where ids are remembered: about 200 bytes each.
IDS_ENTRIES = 1 << 19
#: Characters of a text from which on it is encoded in parts.
LONG = 1 << 22
_ENCODERS: dict = remembered()


def encoder(path: str, use: str):
    """The worker's tokenizer and its chunk memory for one use (ids or counts)."""
    if (path, use) not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _ENCODERS[path, use] = (Tokenizer.from_file(path), {})
    return _ENCODERS[path, use]


def chunk_ids(chunks: set, path: str) -> dict:
    """chunk -> its ids as little-endian unsigned 32-bit bytes, for at least these chunks."""
    tokenizer, known = encoder(path, "ids")
    new = [c for c in chunks if c not in known]
    if len(known) + len(new) > IDS_ENTRIES:
        known.clear()
        new = list(chunks)
    at, size = 0, 0
    for i, c in enumerate(new):  # batches of about 256 kB
        size += len(c)
        if size >= 1 << 18 or i == len(new) - 1:
            part = new[at:i + 1]
            for x, e in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                known[x] = array("I", e.ids).tobytes()
            at, size = i + 1, 0
    return known


def _parts(text: str):
    """A very long text in parts, cut at blanks."""
    at = 0
    while at < len(text):
        to = text.find(" ", at + LONG)
        to = len(text) if to < 0 else to
        yield text[at:to]
        at = to


def _ids(text: str, path: str) -> bytes:
    return _encode(pa.array([text], pa.string()), path)[0].tobytes()


def _chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the texts' chunks one after the other, where each text ends). Chunks end at blanks and
    line ends and where an ASCII character that is no letter follows a letter: this tokenizer
    ends a token there in any case. A-Z is lower-cased unless a byte from 0xCC on follows: those
    begin the characters (combining marks are among them) that the tokenizer may join with a
    letter before it lower-cases. What could hold a special token stays as it is."""
    raw, offsets = utf8(texts)
    n = len(raw)
    blank = (raw == 32) | (raw == 10)
    upper = raw - np.uint8(65) < 26
    letter = upper | (raw - np.uint8(97) < 26)
    after = letter.copy()  # the last byte of a letter; 0xC3 begins U+00C0 to U+00FF
    after[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    cut = (raw > 32) & (raw < 127) & ~letter
    cut[1:] &= after[:-1]
    cut[:1] = False
    upper[:-1] &= raw[1:] < 0xCC
    if n > 1 and (special := np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124))).size:  # <|
        part = blank.copy()
        part[offsets[:-1][offsets[:-1] < n]] = True
        part = np.cumsum(part)
        plain = ~np.isin(part, part[special])
        cut &= plain
        upper &= plain
    full = ~blank
    start = full.copy()
    start[1:] &= blank[:-1] | cut[1:]
    edge = offsets[:-1][offsets[:-1] < n]
    start[edge] = full[edge]
    kept = (raw + (upper.view(np.uint8) << np.uint8(5)))[full]
    first = np.flatnonzero(start[full]).astype(np.int32)
    chunks = pa.StringArray.from_buffers(len(first), pa.py_buffer(np.append(first, np.int32(len(kept)))), pa.py_buffer(kept))
    at = np.flatnonzero(start)
    return chunks, np.searchsorted(at, offsets[1:])


def _encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, where each text ends). Distinct chunks are
    encoded once and their ids gathered."""
    chunks, stops = _chunks(texts)
    coded = chunks.dictionary_encode()
    words = coded.dictionary.to_pylist()
    known = chunk_ids(set(words), path)
    each = [known[w] for w in words]
    size = np.array([len(x) for x in each], np.int64) // 4
    flat = np.frombuffer(b"".join(each), "<u4")
    first = np.cumsum(size) - size
    code = coded.indices.to_numpy()
    length = size[code]
    ends = np.cumsum(length)
    ids = flat[np.repeat(first[code] - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)]
    return ids, np.concatenate([[0], ends])[stops]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                 with_ids: bool = False, text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): every document's tokens and
    ``end_id``, cut into pieces of ``capacity`` where it is longer."""
    tail = int(end_id).to_bytes(4, "little")
    wide = 4 * capacity
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def encode(batches):
        for block in text_blocks(batches, "text", 1 << 22):
            texts = block.column("text")
            if block.num_rows == 1 and len(texts[0].as_py() or "") > LONG:
                encoded = [b"".join(_ids(part, tokenizer) for part in _parts(texts[0].as_py()))]
            else:
                ids, ends = _encode(texts, tokenizer)
                starts = np.concatenate([[0], ends[:-1]])
                raw = memoryview(ids.tobytes())
                encoded = [bytes(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            out: list[list] = [[], [], [], [], [], []]
            for doc, ids in zip(block.column("doc_id").to_pylist(), encoded):
                ids += tail
                for piece, at in enumerate(range(0, len(ids), wide)):
                    cut = ids[at:at + wide]
                    for column, v in zip(out, (doc, piece, at // 4, len(cut) // 4, zlib.crc32(cut),
                                               np.frombuffer(cut, "<u4") if with_ids else None)):
                        column.append(v)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, schema)


def best_fit_steps(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Sequential best-fit decreasing over length classes: what the rounds are measured by.
    Matches as (length, first rank, pieces a sequence takes, first sequence, offset), and the
    number of sequences. The sweep goes down the lengths; gaps are kept sorted, each with the run of sequences
    that have it. Work is bounded by the capacity, whatever the counts are."""
    gaps: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}
    steps, opened = [], 0

    def put(gap, first, n):
        if gap and n:
            if gap not in runs:
                insort(gaps, gap)
            runs.setdefault(gap, []).append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect_left(gaps, length)
            if i < len(gaps):  # the successor: the smallest gap that holds it
                gap = gaps[i]
                first, n = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[i]
            else:
                gap, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = gap // length
            full = min(n, left // each)  # sequences that take `each` pieces
            if full:
                steps.append((length, rank, each, first, capacity - gap))
                put(gap - each * length, first, full)
                left, rank = left - full * each, rank + full * each
            if full < n and left:  # one sequence takes what is left of this length
                steps.append((length, rank, each, first + full, capacity - gap))
                put(gap - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(gap, first + full, n - full)
    return steps, opened


# -- rounds ----------------------------------------------------------------------------

#: Rows of the rounds: gaps (size, first sequence, n), pieces (length, first rank, n), matches
#: (length, first rank, -, pieces a sequence takes, first sequence, offset).
GAP, PIECE, MATCH = 0, 1, 2
_STATE = "kind int, size long, first long, n long, each long, seq long, offset long, fresh boolean"
#: Ranges of sizes that are swept by themselves.
RANGES = 8
#: Pieces longer than every gap that need at most so many sequences open them all at once.
FEW = 16


def sweep(rows: list[tuple], capacity: int) -> list[tuple]:
    """One sweep over gaps and pieces from large to small: every piece takes the smallest free
    gap that holds it, a gap as many pieces of a run as it holds. Matches, shrunken gaps
    (fresh: not used again in this round) and what is left, as rows of the state."""
    out = [r for r in rows if r[0] == MATCH or r[7]]
    stack: list[list] = []  # gaps passed and still free, the smallest on top
    for kind, size, first, n, *_ in sorted((r for r in rows if r[0] != MATCH and not r[7]), key=lambda r: (-r[1], r[0], r[2])):
        if kind == GAP:
            stack.append([size, first, n])
            continue
        while n and stack:
            gap, seq, free = stack[-1]
            each = gap // size
            used = min(free, -(-n // each))
            full = min(used, n // each)
            if full:
                out.append((MATCH, size, first, full, each, seq, capacity - gap, False))
                out.append((GAP, gap - each * size, seq, full, 0, 0, 0, True))
                first, n = first + full * each, n - full * each
            if full < used and n:  # one sequence takes the rest of the run
                out.append((MATCH, size, first, 1, each, seq + full, capacity - gap, False))
                out.append((GAP, gap - n * size, seq + full, 1, 0, 0, 0, True))
                first, n = first + n, 0
            stack[-1][1:] = [seq + used, free - used]
            if not stack[-1][2]:
                stack.pop()
        if n:
            out.append((PIECE, size, first, n, 0, 0, 0, False))
    out += [(GAP, size, seq, n, 0, 0, 0, False) for size, seq, n in stack]
    return [r for r in out if r[0] != GAP or r[1]]


def open_sequences(rows: list[tuple], capacity: int, turn: int) -> list[tuple]:
    """Open sequences for pieces longer than every gap. Sequences are numbered by the round and
    the length that opens them, so no two tasks or rounds have a number in common."""
    largest = max((r[1] for r in rows if r[0] == GAP), default=0)
    none = sorted((r for r in rows if r[0] == PIECE and r[1] > largest), key=lambda r: (-r[1], r[2]))
    most = sum(r[3] for r in none if 2 * r[1] > capacity)
    if not most and none:
        volume = sum(r[1] * r[3] for r in none)
        most = -(-volume // capacity) if volume <= FEW * capacity else max(1, 3 * volume // (4 * capacity))
    opened, wanting = [], set(none)
    number: dict[int, int] = {}
    for kind, size, first, n, *rest in none:
        used = min(most, -(-n // (capacity // size)))
        most -= used
        if used:  # a new sequence is a gap of the whole capacity
            seq = (turn << 52) + (size << 40) + number.get(size, 0)
            number[size] = number.get(size, 0) + used
            opened += sweep([(GAP, capacity, seq, used, 0, 0, 0, False), (kind, size, first, n, *rest)], capacity)
        else:
            opened.append((kind, size, first, n, *rest))
    return [r for r in rows if r not in wanting] + opened


def _swept(batches, step):
    rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
    rows = step(rows)
    kinds = (pa.int32(), *[pa.int64()] * 6, pa.bool_())
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                     names=["kind", "size", "first", "n", "each", "seq", "offset", "fresh"])


def best_fit_rounds(runs: DataFrame, capacity: int) -> DataFrame:
    """The matches (length, rank, each, seq, offset) that place all pieces of ``runs`` (length,
    n: pieces of each length)."""
    none = [F.lit(0).cast("long").alias(c) for c in ("each", "seq", "offset")]
    state = runs.select(F.lit(PIECE).alias("kind"), F.col("length").cast("long").alias("size"), F.lit(0).cast("long").alias("first"),
                        F.col("n").cast("long").alias("n"), *none, F.lit(False).alias("fresh"))
    width = -(-capacity // RANGES)
    turn = 0
    while True:
        # every range is swept in a task of its own; matches and fresh gaps only pass through
        local = state.withColumn("fresh", F.lit(False)).repartition(RANGES, F.floor((F.col("size") - 1) / width)).mapInArrow(
            lambda batches: _swept(batches, lambda rows: sweep(rows, capacity)), _STATE)
        # what is left of them (at most a row for each length and gap) in one last sweep
        whole = local.repartition(1).mapInArrow(
            lambda batches, turn=turn: _swept(batches, lambda rows: open_sequences(sweep(rows, capacity), capacity, turn)), _STATE)
        seen = Observation(f"pieces-left-{uuid.uuid4().hex}")
        state = materialise(whole.observe(seen, F.count_if(F.col("kind") == PIECE).alias("left")), "packing-round")
        if not seen.get["left"]:
            return state.where(F.col("kind") == MATCH).select(F.col("size").alias("length"), F.col("first").alias("rank"), "each", "seq", "offset")
        turn += 1


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (any columns, with ``length`` of 1..capacity) with sequence_id and offset."""
    tie = [F.col(c) for c in ("doc_id", "piece") if c in pieces.columns]
    rows = range_sorted(pieces, [F.col("length").desc(), *tie], "packed-pieces")
    # a row for each partition and length in it: at most partitions + capacity rows
    runs = rows.groupBy("_pid", "length").agg(F.min("_i").alias("_i0"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialise(runs.withColumn("_r0", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "packing-runs")
    found = best_fit_rounds(runs.groupBy("length").agg(F.sum("_n").alias("n")), capacity)
    steps = [tuple(r) for r in found.collect()]  # a few for each length or gap: bounded by the capacity
    table = np.array(sorted(steps), np.int64).reshape(-1, 5)
    key = table[:, 0] << np.int64(48) | table[:, 1]  # (length, first rank): ranks stay below 2**48
    ranked = rows.join(F.broadcast(runs), ["_pid", "length"]).withColumn(
        "_rank", F.col("_r0") + F.col("_i") - F.col("_i0")).select(*pieces.columns, "_rank")
    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def place(batches):
        for b in batches:
            length = b.column("length").to_numpy().astype(np.int64)
            rank = b.column("_rank").to_numpy()
            s = table[np.searchsorted(key, length << np.int64(48) | rank, side="right") - 1] if len(rank) \
                else np.zeros((0, 5), np.int64)
            j = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [pa.array(s[:, 3] + j // np.maximum(s[:, 2], 1)),
                                                pa.array(s[:, 4] + j % np.maximum(s[:, 2], 1) * length)],
                names=names + ["sequence_id", "offset"])

    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                   with_ids: bool = False) -> DataFrame:
    """Encode, cut and pack ``docs``."""
    pieces = materialise(token_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    return pack(pieces, capacity)
