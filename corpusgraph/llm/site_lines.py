"""Lines repeated across the documents of one source (problem 2).

Method: duplicate documents are collapsed first, then every line is counted over the distinct
document clusters of its source and over publication dates. Documents are one cluster if they are
runs of the same page (the caller's cluster number) or near-duplicates (five-word shingles, a
similarity of SIMILARITY or more; all such pairs of a source are found), so a republished article is
no boilerplate. Printings of a line
are one line if they differ only in case, spacing, digits, punctuation, look-alike characters or
one misread word.

How it scales. Texts meet their places in one shuffle by path, which no hot source can skew, and are
kept as a table that two passes read. One misread word leaves one half of a line intact, so a
printing of a repeated line has a half that many clusters hold: the first pass counts the halves of
all lines per source, combined before the shuffle. A printing is looked at if one of its halves
stands in a quarter of the clusters needed; a line is lost only if fewer than a quarter of the
needed pages have that half and the other half of the printing is misread. The halves that pass go
into a bitmap sized by their counted number (2^FILTER_BITS bits at most, beyond which it lets more
lines through, and only costs time); the second pass emits the lines that meet it, and everything
behind is counted exactly.

Two texts at SIMILARITY must share some of their least shingles, by hash: the least third or so of
each text's shingles meet within their source, bounds on what they can have in common leave few
texts, and those are compared by all their shingles.

Printings with a misread word are linked to the more frequent printing that shares a half and
agrees in all words but one. Only printings that hold an eighth of the need are linked to, of which
a half has at most 8 * pages / need, that is 40 where need is a fifth of the pages.

Defined results: null or empty texts have no lines; lines with fewer than `min_letters` letters
never count; rows whose source is null are left out; texts of fewer than MIN_WORDS words, which
hold hardly more than notices, are no near-duplicates of others.
"""

from __future__ import annotations

import bisect
import math
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.skeleton import prototype
from corpusgraph.session import stored

MIN_LETTERS = 16
MIN_CLUSTERS = 4
MIN_SHARE = 0.2
MIN_DATES = 1
FILTER_BITS = 29
SHINGLE, SIMILARITY, MIN_WORDS = 5, 0.8, 50
#: A sketch has this share more of the least shingles than a pair at SIMILARITY needs to share one; so many of the most frequent ones are no meeting points.
SPARE = 1 / 16
#: Tables of so many short rows at most are broadcast, larger ones are joined by shuffling.
BROADCAST_ROWS = 200_000


class _Fold(dict):
    """Prototypes as letters in lower case without accents; line breaks and blanks stay, all else is dropped."""

    def __missing__(self, code: int):
        out = []
        for c in unicodedata.normalize("NFKD", prototype(chr(code))):
            if c.isalpha():
                out.append(c.lower())
            elif c == "\n" or c.isspace():
                out.append("\n" if c == "\n" else " ")
        self[code] = "".join(out)
        return self[code]


_FOLD = _Fold()
#: The same for bytes of ASCII: what they become, and those that are dropped.
_BYTES = bytes(ord(_FOLD[i]) if _FOLD[i] else 0 for i in range(128)) + bytes(128)
_DROPPED = bytes(i for i in range(128) if not _FOLD[i])


def folded(text: str) -> str:
    if "\r" in text:
        text = text.replace("\r\n", "\n")
    return text.encode().translate(_BYTES, _DROPPED).decode() if text.isascii() else text.translate(_FOLD)


def keys_of(fold: str, min_letters: int = MIN_LETTERS) -> Iterator[tuple[int, list[str]]]:
    """(line number from 1, words of the key) of the lines of a folded text that may count."""
    for no, line in enumerate(fold.split("\n"), 1):
        # A folded line has letters and blanks only.
        if len(line) >= min_letters and len(line) - line.count(" ") >= min_letters:
            yield no, line.split()


def line_keys(text: str, min_letters: int = MIN_LETTERS) -> Iterator[tuple[int, str]]:
    """(line number from 1, key) of the lines that may count."""
    for no, words in keys_of(folded(text), min_letters):
        yield no, " ".join(words)


def seed_of(source: str) -> int:
    return xxhash.xxh64_intdigest(source)


def halves(words: list[str], seed: int = 0) -> tuple[int, int]:
    """Hashes of the first and the second half of a key's words, within the source of that seed."""
    n = len(words)
    if n == 1:
        return xxhash.xxh3_64_intdigest(words[0][:8], seed), xxhash.xxh3_64_intdigest("\2" + words[0][-8:], seed)
    mid = (n + 1) // 2
    return xxhash.xxh3_64_intdigest(" ".join(words[:mid]), seed), xxhash.xxh3_64_intdigest("\2" + " ".join(words[mid:]), seed)


def close_words(a: str, b: str) -> bool:
    """Whether one word can be a misreading of the other: what differs is short and in one place."""
    if a == b:
        return True
    most = 1 if min(len(a), len(b)) < 5 else 2
    if abs(len(a) - len(b)) > most:
        return False
    n = min(len(a), len(b))
    i = next((k for k in range(n) if a[k] != b[k]), n)
    j = next((k for k in range(n - i) if a[-1 - k] != b[-1 - k]), n - i)
    if max(len(a), len(b)) - i - j <= most:
        return True
    return len(a) == len(b) and len(a) >= 8 and sum(x != y for x, y in zip(a, b)) <= 2


def one_misread(a: str, b: str) -> bool:
    """Whether two keys have the same words but for one, which can be a misreading of the other's."""
    x, y = a.split(" "), b.split(" ")
    if len(x) != len(y):
        return False
    other = [(p, q) for p, q in zip(x, y) if p != q]
    return len(other) == 1 and close_words(*other[0])


class _Words(dict):
    """32-bit hashes of words; bounded: forgets everything when full."""

    def __missing__(self, w: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[w] = h = xxhash.xxh32_intdigest(w)
        return h


_WORDS = _Words()
_MIX = np.uint32(0x9E3779B1)
_FINAL = np.uint32(0x85EBCA6B)


def shingles(words: list[str]) -> np.ndarray:
    """32-bit hashes of the five-word shingles of a text."""
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint32, len(words))
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return w[:0]
    h = w[:n].copy()
    for k in range(1, SHINGLE):
        h *= _MIX
        h += w[k : k + n]
    h ^= h >> np.uint32(15)
    h *= _FINAL
    return h ^ (h >> np.uint32(13))


def sketch_length(n: int) -> int:
    """How many of the least of n shingles are kept: pairs at SIMILARITY share `1 + spare` of them at least."""
    return min(n, n - math.ceil(SIMILARITY * n - 1e-9) + spare(n) + 1)


def spare(n: int) -> int:
    return int(n * SPARE)


def sketch(words: list[str]) -> tuple[np.ndarray, int, int]:
    """(least shingles, number of all, hash of all) of a text; none for texts of few words."""
    if len(words) < MIN_WORDS:
        return np.zeros(0, np.uint32), 0, 0
    all_ = np.unique(shingles(words))
    return all_[: sketch_length(len(all_))], len(all_), xxhash.xxh64_intdigest(all_.tobytes()) - (1 << 63)


def may_be_near(x: np.ndarray, n_x: int, y: np.ndarray, n_y: int) -> bool:
    """Whether two sets of n_x and n_y members, of which the least are given, can be at SIMILARITY."""
    if min(n_x, n_y) < SIMILARITY * max(n_x, n_y) - 1e-9:
        return False
    # Up to the last member that both lists reach, all is known; beyond it as much as can be is taken for common.
    last = min(int(v[-1]) if len(v) < n else 1 << 32 for v, n in ((x, n_x), (y, n_y)))
    i, j = (bisect.bisect_right(v, last) for v in (x, y))
    common = len(np.intersect1d(x[:i], y[:j], assume_unique=True)) + min(n_x - i, n_y - j)
    return common >= SIMILARITY * (n_x + n_y - common) - 1e-9


def meetings(sets: list[np.ndarray], sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(i, earlier ones it meets): all pairs that can be at SIMILARITY are among them; sets are sketches.

    Members are ordered by how many sketches hold them; as many of the last ones of a sketch as its
    pairs have to spare are no meeting points, so what stands in very many sketches makes no pairs.
    """
    lens = np.array([len(x) for x in sets])
    member, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), lens)
    _, at, times = np.unique(member, return_inverse=True, return_counts=True)
    order = np.lexsort((member, times[at], of))
    rank = np.arange(len(of)) - np.repeat(np.cumsum(lens) - lens, lens)
    kept = order[rank < np.repeat([n - spare(math.ceil(SIMILARITY * m - 1e-9)) for n, m in zip(lens.tolist(), sizes.tolist())], lens)]
    kept = kept[np.lexsort((of[kept], at[kept]))]
    at, of = at[kept], of[kept]
    place = np.arange(len(of))
    start = np.maximum.accumulate(np.where(np.diff(at, prepend=-1) != 0, place, 0))
    some = np.flatnonzero(start < place)
    some = some[np.argsort(of[some], kind="stable")]
    for q in np.split(some, np.flatnonzero(np.diff(of[some])) + 1):
        if len(q):
            n = q - start[q]
            i, near = int(of[q[0]]), np.unique(of[np.repeat(start[q] - np.cumsum(n) + n, n) + np.arange(n.sum())])
            yield i, near[(sizes[near] >= SIMILARITY * sizes[i] - 1e-9) & (sizes[i] >= SIMILARITY * sizes[near] - 1e-9)]


def partners(clusters: np.ndarray, sets: list[np.ndarray], sizes: np.ndarray, wholes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(texts that may be near-duplicates of another cluster's, pairs of clusters with a text of the same shingles)."""
    _, first, of = np.unique(wholes, return_index=True, return_inverse=True)
    same = sorted({(max(a, b), min(a, b)) for a, b in zip(clusters.tolist(), clusters[first[of]].tolist()) if a != b})
    chosen = np.zeros(len(first), dtype=bool)
    sets, sizes, clusters = [sets[i] for i in first], sizes[first], clusters[first]
    for i, near in meetings(sets, sizes):
        for j in near[clusters[near] != clusters[i]].tolist():
            if not (chosen[i] and chosen[j]) and may_be_near(sets[i], sizes[i], sets[j], sizes[j]):
                chosen[i] = chosen[j] = True
    return first[chosen], same


def near_pairs(clusters: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of clusters (greater, less) with near-duplicate texts, as many as connect all that are connected; sets are whole."""
    root = np.unique(clusters, return_inverse=True)[1]
    sizes = np.array([len(x) for x in sets])
    low = [x[: sketch_length(len(x))] for x in sets]
    out = []
    for i, near in meetings(low, sizes):
        for j in near[root[near] != root[i]].tolist():
            a, b = root[i], root[j]
            if a == b or not may_be_near(low[i], sizes[i], low[j], sizes[j]):
                continue
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if common / (sizes[i] + sizes[j] - common) >= SIMILARITY:
                out.append((int(max(clusters[i], clusters[j])), int(min(clusters[i], clusters[j]))))
                root[root == a] = b
    return out


def needed(clusters: str = "clusters") -> Column:
    return F.greatest(F.lit(MIN_CLUSTERS), F.ceil(F.col(clusters) * F.lit(MIN_SHARE) - F.lit(1e-9))).cast("int")


def _small(df: DataFrame) -> DataFrame:
    """A stored table for a join: broadcast if it has BROADCAST_ROWS rows at most."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def rooted(links: DataFrame) -> DataFrame:
    """links (source, a, b), one b for each a and no circle: b becomes the end of its chain."""
    while True:
        up = links.select("source", F.col("a").alias("b"), F.col("b").alias("top"))
        nxt = stored(links.join(up, ["source", "b"], "left").select("source", "a", F.coalesce("top", "b").alias("b"), F.col("top").isNotNull().alias("moved")))
        links = nxt.select("source", "a", "b")
        if nxt.where("moved").isEmpty():
            return links


def united(edges: DataFrame) -> DataFrame:
    """(source, a, b): the least member b of the component of each a; edges (source, a, b) have b < a."""
    links = None
    while True:
        new = edges.groupBy("source", "a").agg(F.min("b").alias("b"))
        links = rooted(stored(new if links is None else links.unionByName(new)))
        end = lambda c: links.select("source", F.col("a").alias(c), F.col("b").alias(f"root_{c}"))  # noqa: B023, E731
        rest = edges.join(end("a"), ["source", "a"], "left").join(end("b"), ["source", "b"], "left")
        x, y = F.coalesce("root_a", "a"), F.coalesce("root_b", "b")
        edges = stored(rest.where(x != y).select("source", F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct())
        if edges.isEmpty():
            return links


def near_duplicates(docs: DataFrame, sketches: DataFrame) -> DataFrame | None:
    """(source, cluster, same): clusters whose texts are near-duplicates of another's, with the least cluster of their group.

    docs: (doc, source, cluster, text); sketches: (doc, source, cluster, low, size, whole). Sketches of
    a source meet in one task, which has some 4 bytes for each of a third of its texts' shingles;
    only texts that may have a partner come with all their shingles, and are compared exactly.
    None if there are none.
    """

    def meet(t: pa.Table) -> pa.Table:
        cluster = t.column("cluster").to_numpy()
        chosen, same = partners(cluster, _arrays(t.column("low")), t.column("size").to_numpy(), t.column("whole").to_numpy())
        null = [None] * len(chosen)
        a, b = [x for x, _ in same], [x for _, x in same]
        source = t.column("source")[0].as_py()
        cols = [pa.array([source] * (len(chosen) + len(same)), pa.string()), pa.array(cluster[chosen].tolist() + a, pa.int64()), pa.concat_arrays([pa.array(t.column("doc").take(pa.array(chosen)).to_pylist(), pa.string()), pa.nulls(len(same), pa.string())]), pa.array(null + b, pa.int64())]
        return pa.table(cols, names=["source", "cluster", "doc", "same"])

    def wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(shingles(folded(t).split())).view(np.int32) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1), pa.array(sets, type=pa.list_(pa.int32()))], names=["source", "cluster", "all"])

    def compare(t: pa.Table) -> pa.Table:
        got = near_pairs(t.column("cluster").to_numpy(), _arrays(t.column("all")))
        return pa.table([pa.array([t.column("source")[0].as_py()] * len(got), pa.string()), pa.array([a for a, _ in got], pa.int64()), pa.array([b for _, b in got], pa.int64())], names=["source", "a", "b"])

    # Few bytes and much work: a number of tasks is asked for, or all would end up in one.
    spark = docs.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    met = stored(sketches.where("size > 0").select("source", "cluster", "doc", "low", "size", "whole").repartition(tasks, "source").groupBy("source").applyInArrow(meet, "source string, cluster bigint, doc string, same bigint"))
    same = met.where("same is not null").select("source", F.col("cluster").alias("a"), F.col("same").alias("b"))
    wanted = stored(met.where("doc is not null").select("doc", "source", "cluster").distinct())
    texts = docs.select("doc", "source", "cluster", "text").join(_small(wanted), ["doc", "source", "cluster"], "left_semi").select("source", "cluster", "text")
    near = texts.mapInArrow(wholes, "source string, cluster bigint, all array<int>").repartition(tasks, "source").groupBy("source").applyInArrow(compare, "source string, a bigint, b bigint")
    same = stored(same.unionByName(near).distinct())
    if same.isEmpty():
        return None
    return united(same).select("source", F.col("a").alias("cluster"), F.col("b").alias("same"))


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of 32-bit hashes of a column, as views."""
    out = []
    for c in column.chunks:
        values, at = c.values.to_numpy().view(np.uint32), c.offsets.to_numpy()
        out += [values[i:j] for i, j in zip(at, at[1:])]
    return out


def bitmap(live: DataFrame) -> tuple[bytes, int]:
    """(bits, their number as a power of two) of the hashes k (bigint); 32 bits for each, 2^FILTER_BITS at most."""
    size = max(16, min(FILTER_BITS, math.ceil(math.log2(32 * live.count() + 1))))
    at = F.shiftrightunsigned("k", 64 - size)
    words = live.select(F.shiftright(at, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    out = np.zeros(1 << (size - 6), dtype=np.int64)
    for b in words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():
        out[b.column(0).to_numpy()] = b.column(1).to_numpy()
    return out.tobytes(), size


def repeated(texts: DataFrame, places: DataFrame, min_letters: int = MIN_LETTERS, min_dates: int = MIN_DATES) -> DataFrame:
    """(doc, line_no, cluster, key, n_clusters, n_dates) of every occurrence of a repeated line.

    texts: (doc string, at string, text string), each doc once; places: (at string, source string,
    cluster bigint, need int, date string), where a text stands. The same cluster number within a
    source marks duplicates, `need` is how many clusters make a line repeated; a text that stands
    in several places is a document of each. A line also needs `min_dates` publication dates.
    """
    spark = texts.sparkSession
    texts = texts.where("doc is not null and at is not null and trim(text) <> ''").select("doc", "at", "text")
    places = places.where("at is not null and source is not null and cluster is not null and need is not null")
    docs = stored(texts.join(places, "at").select("doc", "source", "cluster", "need", "date", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_need: dict[int, Counter] = defaultdict(Counter)
            page, mine, need_ = None, set(), 0
            for source, cluster, n, t in zip(*(c.to_pylist() for c in b.columns)):
                # Runs of a page lie side by side, and count once.
                if page != (source, cluster):
                    by_need[need_].update(mine)
                    page, mine, need_, seed = (source, cluster), set(), n, seed_of(source)
                for _, words in keys_of(folded(t), min_letters):
                    mine.update(halves(words, seed))
            by_need[need_].update(mine)
            k = np.concatenate([np.fromiter(c, np.uint64, len(c)) for c in by_need.values()]).astype(np.int64)
            times = np.concatenate([np.fromiter(c.values(), np.int32, len(c)) for c in by_need.values()])
            needs = np.concatenate([np.full(len(c), n, np.int32) for n, c in by_need.items()])
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(times), pa.array(needs)], names=["k", "n", "need"])

    counts = docs.select("source", "cluster", "need", "text").mapInArrow(count, "k bigint, n int, need int").groupBy("k").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
    bits, size = bitmap(stored(counts.where("n >= greatest(2, ceil(need / 4))").select("k")))
    sent = spark.sparkContext.broadcast(bits)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.frombuffer(sent.value, dtype=np.uint64)
        for b in batches:
            row, nos, keys, ks, sketches = [], [], [], [], []
            for i, (source, t) in enumerate(zip(b.column(1).to_pylist(), b.column(5).to_pylist())):
                fold, seed = folded(t), seed_of(source)
                sketches.append(sketch(fold.split()))
                for no, words in keys_of(fold, min_letters):
                    row.append(i)
                    nos.append(no)
                    keys.append(words)
                    ks.extend(halves(words, seed))
            i = np.array(ks, dtype=np.uint64) >> np.uint64(64 - size)
            hit = np.flatnonzero((filled[i >> np.uint64(6)] >> (i & np.uint64(63)) & np.uint64(1)).astype(bool).reshape(-1, 2).any(axis=1))
            # A row for each line that is looked at, and one without a line for each text with a sketch.
            some = [j for j, x in enumerate(sketches) if x[1]]
            at = pa.array([row[j] for j in hit] + some, type=pa.int64())
            no = pa.array([nos[j] for j in hit] + [None] * len(some), type=pa.int64())
            key = pa.array([" ".join(keys[j]) for j in hit] + [None] * len(some), type=pa.string())
            none = [None] * len(hit)
            low = pa.array(none + [sketches[j][0].view(np.int32) for j in some], type=pa.list_(pa.int32()))
            size_ = pa.array(none + [sketches[j][1] for j in some], type=pa.int32())
            whole = pa.array(none + [sketches[j][2] for j in some], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in range(5)), no, key, low, size_, whole], names=["doc", "source", "cluster", "need", "date", "line_no", "key", "low", "size", "whole"])

    both = stored(docs.mapInArrow(lines, "doc string, source string, cluster bigint, need int, date string, line_no bigint, key string, low array<int>, size int, whole bigint"))
    some = both.where("line_no is not null").drop("low", "size", "whole").withColumn("kid", F.xxhash64("source", "key"))
    twins = near_duplicates(docs, both.where("line_no is null"))
    if twins is not None:
        some = some.join(_small(stored(twins)), ["source", "cluster"], "left").withColumn("cluster", F.coalesce("same", "cluster")).drop("same")

    prints = some.select("kid", "source", "key", "need", "cluster").distinct().groupBy("kid", "source", "key", "need").agg(F.count(F.lit(1)).alias("n"))
    words = F.split("key", " ")
    mid = F.ceil(F.size(words) / 2).cast("int")
    single = F.size(words) == 1
    first = F.when(single, F.left("key", F.lit(8))).otherwise(F.array_join(F.slice(words, F.lit(1), mid), " "))
    second = F.when(single, F.right("key", F.lit(8))).otherwise(F.array_join(F.slice(words, mid + 1, F.size(words)), " "))
    half = F.array(F.xxhash64("source", F.lit(1), first), F.xxhash64("source", F.lit(2), second))
    parts = stored(prints.select("kid", "key", "n", "need", half.alias("halves"))).select("kid", "key", "n", "need", F.explode("halves").alias("half"))
    hubs = parts.where("n * 8 >= need").select("half", F.col("kid").alias("hub_kid"), F.col("key").alias("hub_key"), F.col("n").alias("hub_n"))
    pairs = parts.join(hubs, "half").where("hub_n > n or hub_n = n and hub_kid > kid").select("kid", "key", "hub_kid", "hub_key", "hub_n")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [one_misread(x, y) for x, y in zip(b.column(1).to_pylist(), b.column(3).to_pylist())]
            yield b.select([0, 2, 4]).filter(pa.array(keep, type=pa.bool_()))

    links = pairs.mapInArrow(close, "kid bigint, hub_kid bigint, hub_n bigint").groupBy("kid").agg(F.max(F.struct("hub_n", "hub_kid")).alias("b"))
    # A hub may itself be a misprint of a more frequent printing; links are followed to their ends.
    links = rooted(stored(links.select(F.lit("").alias("source"), F.col("kid").alias("a"), F.col("b.hub_kid").alias("b")))).select(F.col("a").alias("kid"), F.col("b").alias("hub_kid"))
    some = some.join(links, "kid", "left").withColumn("line", F.coalesce("hub_kid", "kid"))
    found = some.select("line", "need", "cluster", "date").distinct().groupBy("line", "need", "cluster").agg(F.collect_set("date").alias("dates"))
    found = found.groupBy("line", "need").agg(F.count(F.lit(1)).alias("n_clusters"), F.size(F.array_distinct(F.flatten(F.collect_set("dates")))).cast("bigint").alias("n_dates"))
    found = found.where(F.col("n_clusters") >= F.col("need"))
    if min_dates > 1:
        found = found.where(F.col("n_dates") >= min_dates)
    return some.join(found.select("line", "n_clusters", "n_dates"), "line").select("doc", "line_no", "cluster", "key", "n_clusters", "n_dates")


def repeated_lines(docs: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """`repeated` for docs (doc string, source string, cluster bigint, need int, text string), one place each."""
    places = docs.select(F.col("doc").alias("at"), "source", "cluster", "need", F.lit(None).cast("string").alias("date"))
    return repeated(docs.select("doc", F.col("doc").alias("at"), "text"), places, min_letters)


def drop_lines(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, text, n_removed): every text without its repeated lines, in the JVM; nulls stay null."""
    nos = found.groupBy("doc").agg(F.collect_set("line_no").alias("nos"))
    joined = docs.join(nos, "doc", "left").withColumn("nos", F.coalesce("nos", F.array().cast("array<bigint>")))
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("nos", (i + 1).cast("bigint")))
    return joined.select("doc", F.array_join(kept, "\n").alias("text"), F.size("nos").cast("bigint").alias("n_removed"))
