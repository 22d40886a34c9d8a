"""Token ids of a whole corpus by a public byte-level tokenizer (problem 7).

Method: a tree reduction over a monoid. An element is a stretch of text with its ids. A text
is halved until the pieces are short, the pieces are encoded, and neighbours are joined: a
window around the seam is encoded again and grows on either side until its ends are places at
which the split pattern must begin a new match whatever stands around them. Outside of such a
window no id can change, so the joined ids are those of the whole text.

A place is certain if a white space follows a character that is none: no alternative of the
pattern holds a non-space before a space. The same fact lets a leaf be encoded word by word
through a memo, which is what makes the corpus cheap.

Defined results: null and empty texts give an empty list; special-token strings are ordinary
text; lone blanks are encoded like any text. Repeated rows give repeated results, other columns
of the input are ignored, an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the rank file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as the split pattern understands it; unlike Python's it lacks U+001C to U+001F.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ENDS_BLANK = re.compile(f"[{SPACE}]")
CERTAIN = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")
LEAF_CHARS = 4096
MEMO_WORDS = 300_000
MEMO_CHARS = 40


class Memo(dict):
    """What `value` makes of the ids of a word behind one blank; bounded, as it forgets all when full.

    A word that is empty or ends in white space is refused: the blank behind it would follow
    white space, so the text can't be cut there.
    """

    def __init__(self, encode, value):
        super().__init__()
        self.encode, self.value = encode, value

    def __missing__(self, word: str):
        if not word or ENDS_BLANK.match(word[-1]):
            raise LookupError
        v = self.value(self.encode(" " + word))
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = v
        return v


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer of a rank file: (encode a text, ids of words, count of words, bytes of each id)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return enc.encode_ordinary, Memo(enc.encode_ordinary, tuple), Memo(enc.encode_ordinary, len), lengths


def leaf_ids(text: str, encode, words: Memo) -> list[int]:
    """Ids of a short text, cut at blanks behind words; as one piece where that isn't certain."""
    first, *rest = text.split(" ")
    if rest and (not first or ENDS_BLANK.match(first[-1])):
        return encode(text)
    try:
        ids = encode(first)
        ids.extend(chain.from_iterable(map(words.__getitem__, rest[:-1])))
        ids.extend(encode(" " + rest[-1]) if rest else ())
        return ids
    except LookupError:
        return encode(text)


def leaf_count(text: str, encode, counts: Memo) -> int:
    """How many ids a text has."""
    first, *rest = text.split(" ")
    if rest and (not first or ENDS_BLANK.match(first[-1])):
        return len(encode(text))
    try:
        return len(encode(first)) + sum(map(counts.__getitem__, rest[:-1])) + (len(encode(" " + rest[-1])) if rest else 0)
    except LookupError:
        return len(encode(text))


def _tail(left: str, reach: int) -> int | None:
    """The last certain place of the left side that is `reach` characters or more before its end."""
    end, width = len(left) - reach, 64
    while end > 0:
        start = max(0, end - width)
        at = None
        for m in CERTAIN.finditer(left, start, end):
            at = m.start()
        if at is not None or start == 0:
            return at
        width *= 4
    return None


def join(a: tuple[str, list[int]], b: tuple[str, list[int]], encode, lengths: np.ndarray) -> tuple[str, list[int]]:
    """The monoid's operation: the ids of two texts from the ids of each."""
    (left, left_ids), (right, right_ids) = a, b
    if not left:
        return b
    if not right:
        return a
    start = _tail(left, 1)
    found = CERTAIN.search(right, 1)
    stop = found.start() if found else None
    head = left[start:] if start is not None else left
    tail = right[:stop] if stop is not None else right

    def kept(ids: list[int], changed: str, from_end: bool) -> int:
        """How many ids cover `changed` at that end; certain places are seams of ids."""
        need, n, step = len(changed.encode()), 0, 64
        while True:
            step *= 4
            part = np.asarray(ids[-step:] if from_end else ids[:step], dtype=np.int64)
            sizes = np.cumsum(lengths[part][::-1] if from_end else lengths[part])
            if not len(sizes) or sizes[-1] >= need or step >= len(ids):
                n = int(np.searchsorted(sizes, need)) + 1
                return n

    cut_left = 0 if start is None else len(left_ids) - kept(left_ids, head, True)
    cut_right = len(right_ids) if stop is None else kept(right_ids, tail, False)
    ids = left_ids[:cut_left]
    ids.extend(encode(head + tail))
    ids.extend(right_ids[cut_right:])
    return left + right, ids


def encode_tree(text: str, encode, words: Memo, lengths: np.ndarray, leaf: int = LEAF_CHARS) -> list[int]:
    """Ids of one text by halving it down to `leaf` characters and joining upwards."""
    if len(text) <= leaf:
        return leaf_ids(text, encode, words)

    def build(lo: int, hi: int) -> tuple[str, list[int]]:
        if hi - lo <= leaf:
            part = text[lo:hi]
            return part, leaf_ids(part, encode, words)
        mid = (lo + hi) // 2
        return join(build(lo, mid), build(mid, hi), encode, lengths)

    return build(0, len(text))[1]


def decode_tree(ids: list[int], path: str = RANK_FILE, leaf: int = 4096) -> str:
    """The text of ids: bytes of halves are concatenated up the tree, then read as UTF-8."""
    with open(path, "rb") as f:
        table = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}

    def build(lo: int, hi: int) -> bytes:
        if hi - lo <= leaf:
            return b"".join(table[i] for i in ids[lo:hi])
        mid = (lo + hi) // 2
        return build(lo, mid) + build(mid, hi)

    return build(0, len(ids)).decode("utf-8")


def _shipped(df: DataFrame, path: str) -> str:
    """Send the rank file to the executors, which need not have it; its name among their files."""
    df.sparkSession.sparkContext.addFile(path)
    return Path(path).name


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = RANK_FILE) -> DataFrame:
    """`key` and `ids` (array of int) of every row; one narrow pass, nothing is shuffled."""

    name = _shipped(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, words, _, lengths = encoder(SparkFiles.get(name))
        for b in batches:
            flat, offsets = [], [0]
            for t in b.column(1).to_pylist():
                if t:
                    flat.extend(encode_tree(t, encode, words, lengths))
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(np.array(flat, dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["k", "ids"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, ids array<int>")
    return out.select(F.col("k").alias(key), "ids")


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = RANK_FILE) -> DataFrame:
    """`key` and `n_tokens` (bigint) of every row, by the same rules; null texts count 0.

    Certain places cut a text into words exactly, so a count needs no joins.
    """

    name = _shipped(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _, counts, _ = encoder(SparkFiles.get(name))
        for b in batches:
            n = [leaf_count(t, encode, counts) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, type=pa.int64())], names=["k", "n"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, n bigint")
    return out.select(F.col("k").alias(key), F.col("n").alias("n_tokens"))
