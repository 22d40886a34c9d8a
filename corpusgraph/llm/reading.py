"""Reading level of documents (problem 9).

Method: a Rasch-style latent difficulty model. A document has a level t, a word an easiness p
and a difficulty slope a, and the words that occur in a document are drawn with log-odds
p + a * t. Levels and words are estimated by alternating optimisation: with the words fixed, the
posterior of each document's level over a grid needs only the sum of its words' slopes and their
number; with the levels fixed, the words are refitted to the expected counts per grid point,
which the executors sum up. Levels start from the mean word length, no label is used for them.

Words are hashed into BUCKETS parameters, so every word counts and what is broadcast or
collected per step has a fixed size. The levels are cut into bands where the readers' labels
are met best; labels are a bounded sample (MAX_LABELS).

A document is rated if it is mainly running English prose of MIN_CHARS characters or more.
Defined results: all other documents, null and empty texts among them, have no row. Without any
labels the bands are thirds of the level's range. Repeated ids give one row each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm import line_kinds as L
from corpusgraph.session import checkpoint

MIN_CHARS = 300
BUCKETS = 1 << 16
GRID = np.linspace(-2.0, 2.0, 9)
#: Where levels may lie; wider than the grid, so that clear cases don't all end on its edge.
RANGE = np.linspace(-6.0, 6.0, 241)
#: Rounds end when the words' slopes move by less than SETTLED on the average over all occurrences, or at MAX_ROUNDS.
MAX_ROUNDS, SETTLED = 10, 0.02
#: One labelled document in HELD_OUT is kept from the cuts when their agreement is measured.
HELD_OUT = 5
MAX_LABELS = 50_000
LANGUAGE = "en"
_WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")


class Words(dict):
    """(bucket, length, languages' bits) of a lower-case word; bounded."""

    LIMIT = 300_000

    def __init__(self, languages: dict[str, frozenset[str]]):
        super().__init__()
        self.sets = list(languages.values())

    def __missing__(self, w: str) -> tuple[int, int, int]:
        bits = sum(1 << i for i, s in enumerate(self.sets) if w in s)
        v = (xxhash.xxh32_intdigest(w) % BUCKETS, len(w), bits)
        if len(self) >= self.LIMIT:
            self.clear()
        if len(w) <= 30:
            self[w] = v
        return v


def prose_share(text: str, memo: L.Tokens) -> float:
    """Share of a text's characters in lines of prose."""
    total = prose = 0
    for k, x in L.kinds(text, memo):
        total += x.chars
        prose += x.chars * (k == L.PROSE)
    return prose / total if total else 0.0


def features(text: str, words: Words, memo: L.Tokens, languages: list[str]) -> tuple[float, list[int]] | None:
    """(mean word length, buckets of the words that occur), or None if the text isn't to be rated."""
    if len(text.strip()) < MIN_CHARS:
        return None
    low = text.lower()
    found = _WORDS.findall(low)
    if len(found) < 20:
        return None
    buckets, lengths, bits = zip(*map(words.__getitem__, found))
    counts = [sum(1 for b in bits if b >> i & 1) for i in range(len(languages))]
    own = counts[languages.index(LANGUAGE)]
    if own < max(counts) or own * 12 < len(found):
        return None
    # Clear cases are settled by the lines' length; the rest is judged line by line.
    lines = [s for s in low.split("\n") if s.strip()]
    clear = own * 4 >= len(found) and len(found) >= 7 * len(lines) and "  " not in low and "\t" not in low and "|" not in low and "..." not in low
    if not clear and prose_share(text, memo) <= 0.5:
        return None
    return sum(lengths) / len(lengths), sorted(set(buckets))


def prepare(df: DataFrame, key: str, text: str, languages: dict[str, frozenset[str]]) -> DataFrame:
    """(k, start, ids) of the documents to be rated."""
    names, common = list(languages), frozenset().union(*languages.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, memo = Words(languages), L.Tokens(common)
        for b in batches:
            keep, starts, ids, offsets = [], [], [], [0]
            for i, t in enumerate(b.column(1).to_pylist()):
                f = features(t, words, memo, names)
                if f:
                    keep.append(i)
                    starts.append(f[0])
                    ids.extend(f[1])
                    offsets.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(ids, type=pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, type=pa.int64())), pa.array(starts, type=pa.float64()), lists], names=["k", "start", "ids"])

    src = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null")
    return src.mapInArrow(run, f"k {df.schema[key].dataType.simpleString()}, start double, ids array<int>")


def _sums(ids: pa.ListArray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat ids, document of each, sum of `values` per document)."""
    flat = ids.flatten().to_numpy()
    sizes = np.diff(ids.offsets.to_numpy())
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return flat, doc, np.bincount(doc, weights=values[flat], minlength=len(sizes))


def log_norm(easiness: np.ndarray, slope: np.ndarray, grid: np.ndarray = GRID) -> tuple[np.ndarray, np.ndarray]:
    """log of the normaliser and its derivative at each grid point."""
    seen = easiness > -30
    easiness, slope = (easiness[seen], slope[seen]) if seen.any() else (easiness[:1], slope[:1])
    logits = easiness[:, None] + slope[:, None] * grid[None, :]
    top = logits.max(axis=0)
    e = np.exp(logits - top)
    return top + np.log(e.sum(axis=0)), (e * slope[:, None]).sum(axis=0) / e.sum(axis=0)


def refit(counts: np.ndarray, slope: np.ndarray, ridge: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Words' (easiness, slope) from their expected counts per grid point: Poisson steps with a prior on slopes."""
    exposure = counts.sum(axis=0) + 1e-9
    total = counts.sum(axis=1)
    seen = total > 0
    easiness = np.full(len(counts), -30.0)
    a = np.where(seen, slope, 0.0)
    moment = counts @ GRID
    for _ in range(8):
        w = exposure[None, :] * np.exp(np.clip(a[:, None] * GRID[None, :], -20, 20))
        z = w.sum(axis=1)
        m1 = (w @ GRID) / z
        m2 = (w @ GRID**2) / z
        step = (moment - total * m1 - ridge * a) / (total * np.maximum(m2 - m1**2, 1e-6) + ridge)
        a = np.clip(a + np.clip(step, -1, 1), -4, 4)
    w = exposure[None, :] * np.exp(np.clip(a[:, None] * GRID[None, :], -20, 20))
    easiness[seen] = np.log(total[seen]) - np.log(w.sum(axis=1)[seen])
    return easiness, np.where(seen, a, 0.0)


def fit(docs: DataFrame, rounds: int = MAX_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Words' parameters by alternating optimisation over `docs` (k, start, ids)."""
    centre = docs.agg(F.avg("start").alias("m"), F.stddev_pop("start").alias("s"), F.count(F.lit(1)).alias("n")).first()
    easiness, slope = np.zeros(BUCKETS), np.zeros(BUCKETS)
    if not centre["n"]:
        return easiness, slope
    mean, sd = centre["m"], centre["s"] or 1.0
    k = len(GRID)
    names = ["bucket", *(f"c{i}" for i in range(k))]
    schema = "bucket int, " + ", ".join(f"c{i} double" for i in range(k))
    for r in range(rounds):
        norm, _ = log_norm(easiness, slope)
        sent = docs.sparkSession.sparkContext.broadcast((slope, norm))

        def expect(batches: Iterator[pa.RecordBatch], first: bool = r == 0, sent=sent) -> Iterator[pa.RecordBatch]:
            slope_, norm_ = sent.value
            total = np.zeros((BUCKETS, k))
            for b in batches:
                flat, doc, sums = _sums(b.column(1), slope_)
                sizes = np.bincount(doc, minlength=len(sums))
                if first:
                    z = np.clip((b.column(0).to_numpy() - mean) / sd, -2, 2)
                    score = -((z[:, None] - GRID[None, :]) ** 2) * 4
                else:
                    score = sums[:, None] * GRID[None, :] - sizes[:, None] * norm_[None, :] - 0.5 * GRID[None, :] ** 2
                post = np.exp(score - score.max(axis=1, keepdims=True))
                post /= post.sum(axis=1, keepdims=True)
                for i in range(k):
                    total[:, i] += np.bincount(flat, weights=post[doc, i], minlength=BUCKETS)
            at = np.flatnonzero(total.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(total[at, i]) for i in range(k))], names=names)

        part = docs.select("start", "ids").mapInArrow(expect, schema)
        table = part.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in names[1:])).toArrow()
        counts = np.zeros((BUCKETS, k))
        at = table.column(0).to_numpy()
        for i in range(k):
            counts[at, i] = table.column(i + 1).to_numpy()
        before = slope
        easiness, slope = refit(counts, slope)
        sent.unpersist()
        weight = counts.sum(axis=1)
        if r and (weight * np.abs(slope - before)).sum() < SETTLED * weight.sum():
            break
    return easiness, slope


def levels(docs: DataFrame, easiness: np.ndarray, slope: np.ndarray) -> DataFrame:
    """(k, level): where on the grid's range the model expects a document's mean slope."""
    _, expected = log_norm(easiness, slope, RANGE)
    order = np.argsort(expected, kind="stable")
    sent = docs.sparkSession.sparkContext.broadcast((slope, expected[order], RANGE[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope_, xs, ts = sent.value
        for b in batches:
            _, doc, sums = _sums(b.column(1), slope_)
            n = np.bincount(doc, minlength=len(sums))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.interp(sums / np.maximum(n, 1), xs, ts))], names=["k", "level"])

    return docs.select("k", "ids").mapInArrow(run, f"k {docs.schema['k'].dataType.simpleString()}, level double")


def cuts(pairs: list[tuple[float, int]]) -> tuple[float, float, int]:
    """(lower cut, upper cut, direction) that meet most labels of bands 1 to 3."""
    if not pairs:
        return -2 / 3, 2 / 3, 1
    best = None
    for direction in (1, -1):
        data = sorted((direction * t, band) for t, band in pairs)
        ts = np.array([t for t, _ in data])
        hits = np.array([[band == x for _, band in data] for x in (1, 2, 3)], dtype=np.int64)
        pre = np.concatenate([np.zeros((3, 1), np.int64), hits.cumsum(axis=1)], axis=1)
        n = len(data)
        # lower cut before i, upper before j >= i; equal levels are never parted
        whole = np.array([0 < p < n and ts[p - 1] == ts[p] for p in range(n + 1)])
        upper = np.where(whole, -n, pre[1] - pre[2] + pre[2, -1])  # gain of an upper cut at j, up to a constant of i
        best_j = np.zeros(n + 1, dtype=np.int64)
        j = n
        for i in range(n, -1, -1):
            if upper[i] > upper[j]:
                j = i
            best_j[i] = j
        gain = np.where(whole, -n, pre[0] - pre[1] + upper[best_j])
        i = int(gain.argmax())
        j = int(best_j[i])
        at = lambda p, ts=ts, n=n: -np.inf if p == 0 else np.inf if p == n else (ts[p - 1] + ts[p]) / 2
        got = (int(gain[i]), float(at(i)), float(at(j)), direction)
        if best is None or got[0] > best[0]:
            best = got
    return best[1:]


def labelled(out: DataFrame, labels: DataFrame, key: str) -> list[tuple[object, float, int]]:
    """(document, level, band) of at most MAX_LABELS labels."""
    given = labels.select(F.col(key).alias("k"), "band").where("k is not null and band between 1 and 3").orderBy("k", "band").limit(MAX_LABELS)
    return [(r["k"], r["level"], r["band"]) for r in out.join(F.broadcast(given), "k").select("k", "level", "band").collect()]


def rate(df: DataFrame, labels: DataFrame, languages: dict[str, frozenset[str]], key: str = "doc_id", text: str = "text", rounds: int = MAX_ROUNDS) -> DataFrame:
    """(`key`, level, band) of every document that is mainly English prose."""
    docs = checkpoint(prepare(df, key, text, languages))
    out = checkpoint(levels(docs, *fit(docs, rounds)))
    low, high, direction = cuts([(t, b) for _, t, b in labelled(out, labels, key)])
    level = F.col("level") * F.lit(direction)
    band = F.when(level < F.lit(low), 1).when(level < F.lit(high), 2).otherwise(3).cast("bigint")
    return out.select(F.col("k").alias(key), level.alias("level"), band.alias("band"))


def agreement(rated: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row (n_fitted, n_held_out, n_agreeing): labels met by cuts that were fitted without them.

    rated: (`key`, level); one labelled document in HELD_OUT, chosen by its key's hash, is held out.
    """
    given = labelled(rated.withColumnRenamed(key, "k"), labels, key)
    out = {k for k, _, _ in given if xxhash.xxh32_intdigest(str(k)) % HELD_OUT == 0}
    low, high, direction = cuts([(t, b) for k, t, b in given if k not in out])
    kept = [(t * direction, b) for k, t, b in given if k in out]
    hits = sum((1 if t < low else 2 if t < high else 3) == b for t, b in kept)
    return rated.sparkSession.createDataFrame([(len(given) - len(kept), len(kept), hits)], "n_fitted bigint, n_held_out bigint, n_agreeing bigint")
