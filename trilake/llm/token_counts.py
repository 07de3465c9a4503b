"""Token counts: batch encoding in Arrow functions that return lengths only.

A text may be cut before a blank or line break that follows a visible character: the
tokenizer's own splitting always starts a new word there, so counts of the parts add up.
Texts of any length thus become short chunks; each task encodes the chunks that it has not
met yet in batches of equal bytes and adds up lengths, without keeping ids. Texts with any
other white space, or with the tokenizer's special strings, go to the library whole.

Cases: null and empty texts have 0 bytes and 0 tokens; null and repeated doc_ids and
repeated rows are ordinary rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import text_blocks
from .packing import CACHE_ENTRIES, encoder

CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space besides blank and line feed, in Python's and Unicode's sense.
OTHER_SPACE = re.compile(r"[^\S \n]")
SAFE = re.compile(r"(?<=\S) (?=\S)")
BATCH_BYTES = 1 << 18
#: Characters of a text from which on it is encoded in parts.
LONG = 1 << 21


def count_batched(texts: list[str], tokenizer) -> list[int]:
    """Token counts of the texts, encoded in batches of about BATCH_BYTES."""
    out, at, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_BYTES or i == len(texts) - 1:
            out += [len(e.ids) for e in tokenizer.encode_batch_fast(texts[at:i + 1], add_special_tokens=False)]
            at, size = i + 1, 0
    return out


def safe_parts(text: str, size: int) -> list[str]:
    """A long text in parts of about ``size``, cut before a single blank between visible
    characters: a word always starts there."""
    parts, at = [], 0
    while len(text) - at > size:
        gap = SAFE.search(text, at + size)
        if gap is None:
            break
        parts.append(text[at:gap.start()])
        at = gap.start()
    return [*parts, text[at:]]


def count_texts(texts: list[str], path: str) -> list[int]:
    """Tokens of each whole text, as the library gives them."""
    parts = [safe_parts(t, LONG) for t in texts]
    if any(len(p) > 1 for p in parts):
        return [sum(n for x in p for n in _count_parts([x], path)) if len(p) > 1 else _count_parts(p, path)[0] for p in parts]
    return _count_parts(texts, path)


def _count_parts(texts: list[str], path: str) -> list[int]:
    tokenizer, known = encoder(path, "counts")
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    whole = [i for i, t in enumerate(texts) if OTHER_SPACE.search(t) or any(s in t for s in special)]
    chunks = [CHUNK.findall(t) for t in texts]
    for i in whole:
        chunks[i] = []
    need = set().union(*chunks)
    new = [c for c in need if c not in known]
    if len(known) + len(new) > CACHE_ENTRIES:
        known.clear()
        new = list(need)
    known.update(zip(new, count_batched(new, tokenizer)))
    counts = [sum(map(known.__getitem__, c)) for c in chunks]
    for i, n in zip(whole, count_batched([texts[i] for i in whole], tokenizer)):
        counts[i] = n
    return counts


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""

    def count(batches):
        for block in text_blocks(batches, "text", 1 << 22):
            column = pc.fill_null(block.column("text"), "")
            n = np.array(count_texts(column.to_pylist(), tokenizer), np.int64)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pc.binary_length(column).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
