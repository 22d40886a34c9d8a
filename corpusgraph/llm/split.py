"""Splitting oversized items at natural boundaries (problem 3).

Method: recursive bisection. A stretch longer than limit - overlap is cut at the strongest
boundary near its midpoint, both halves are treated alike, and at last every piece but the
first is extended backwards by up to `overlap` characters, again to a natural boundary.

Defined results: null texts give no piece; an empty text gives one empty piece; texts within
the limit are one piece; a stretch without any boundary is cut at its midpoint, never between a
base character and the marks, joiners or variation selectors that follow it where that can be
helped. Pieces tile the text: `start` is where a piece's own part begins, `from_pos` where the
piece with its overlap begins, both counted in characters from 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1800
OVERLAP = 180
#: Boundaries from strong to weak; a cut falls behind the match.
BOUNDARIES = (
    re.compile(r"(?:\r\n|[\n\r\x0b\x0c\x85\u2028])[^\S\n\r]*(?:\r\n|[\n\r\x0b\x0c\x85\u2028])\s*|[\x0c\u2029]\s*"),
    re.compile(r"\r\n|[\n\r\x0b\x85\u2028]"),
    re.compile(r"[.!?\u2026][\"'\u201d\u2019)\]]*\s+|[\u3002\uff01\uff1f]"),
    re.compile(r"\s+|\u200b"),
)


def _attached(c: str) -> bool:
    return unicodedata.category(c) in ("Mn", "Me", "Mc") or c in "\u200d\ufe0e\ufe0f" or "\U0001f3fb" <= c <= "\U0001f3ff"


def _hard(text: str, lo: int, hi: int, mid: int) -> int:
    """A cut without a boundary: the place nearest to the midpoint that parts no cluster, within 32."""
    for d in range(32):
        for at in (mid - d, mid + d):
            if lo < at < hi and not _attached(text[at]) and text[at - 1] != "\u200d":
                return at
    return mid


def cut(text: str, lo: int, hi: int) -> int:
    """Where to part text[lo:hi]: the strongest boundary in the middle half, else anywhere."""
    mid, quarter = (lo + hi) // 2, (hi - lo) // 4
    for left, right in ((mid - quarter, mid + quarter), (lo, hi)):
        for pattern in BOUNDARIES:
            best = None
            for m in pattern.finditer(text, left, right):
                at = m.end()
                if lo < at < hi and (best is None or abs(at - mid) < abs(best - mid)):
                    best = at
                if at > mid:
                    break
            if best is not None:
                return best
    return _hard(text, lo, hi, mid)


def bisect(text: str, core: int) -> list[int]:
    """Starts of the parts of at most `core` characters, and the text's end."""
    out, todo = [], [(0, len(text))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= core:
            out.append(lo)
        else:
            at = cut(text, lo, hi)
            todo += [(at, hi), (lo, at)]
    return [*out, len(text)]


def overlap_from(text: str, start: int, overlap: int) -> int:
    """Where a piece begins that shares up to `overlap` characters with the one before it."""
    lo = max(0, start - overlap)
    for pattern in BOUNDARIES:
        m = next((m for m in pattern.finditer(text, lo, start) if m.end() < start), None)
        if m:
            return m.end()
    return lo if lo < start and not _attached(text[lo]) else start


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(from_pos, start, end) of each piece."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be smaller than limit")
    if len(text) <= limit:
        return [(0, 0, len(text))]
    starts = bisect(text, limit - overlap)
    return [(overlap_from(text, a, overlap) if a else 0, a, b) for a, b in zip(starts, starts[1:])]


def split_items(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """(`key`, piece_no from 1, n_pieces, from_pos, start, end_pos[, piece]) of every item.

    Items within the limit are cut by no rule and stay in the JVM; only the others go to Python.
    """
    src = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    kind = df.schema[key].dataType.simpleString()
    small, large = src.where(F.length("t") <= limit), src.where(F.length("t") > limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            keys = []
            for k, t in zip(b.column(0), b.column(1).to_pylist()):
                got = pieces(t, limit, overlap)
                for i, (f, s, e) in enumerate(got, 1):
                    rows.append((i, len(got), f, s, e, t[f:e]) if with_text else (i, len(got), f, s, e))
                    keys.append(k)
            if rows:
                cols = list(zip(*rows))
                arrays = [pa.array([k.as_py() for k in keys], type=b.schema.field(0).type), *(pa.array(c, type=pa.int64()) for c in cols[:5])]
                if with_text:
                    arrays.append(pa.array(cols[5], type=pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["k", "piece_no", "n_pieces", "from_pos", "start", "end_pos"] + ["piece"] * with_text
    schema = f"k {kind}, piece_no bigint, n_pieces bigint, from_pos bigint, start bigint, end_pos bigint" + ", piece string" * with_text
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    whole = [F.col("k"), one.alias("piece_no"), one.alias("n_pieces"), zero.alias("from_pos"), zero.alias("start"), F.length("t").cast("bigint").alias("end_pos")]
    if with_text:
        whole.append(F.col("t").alias("piece"))
    out = small.select(*whole).unionByName(large.mapInArrow(run, schema))
    return out.withColumnRenamed("k", key)
