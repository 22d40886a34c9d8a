import random

from corpusgraph.llm import site_lines as X

NOTICE = "Return this copy to the beacon registry"


def body(rng, n=90):
    words = [f"{a}{b}" for a in ("lamp", "hill", "gate", "moon", "river", "stone", "watch") for b in ("er", "ing", "ed", "ly", "ful")]
    got = [rng.choice(words) for _ in range(n)]
    return "\n".join(" ".join(got[i : i + 9]) for i in range(0, n, 9))


def test_near_duplicates_count_once(spark):
    rng = random.Random(5)
    article = body(rng, 180)
    copies = [article.replace("lamper", "lampor", 1) + f"\nprinted {i}" for i in range(6)]
    rows = [(f"c{i}", "s", i, 4, t) for i, t in enumerate(copies)]
    rows += [(f"d{i}", "s", 10 + i, 4, body(rng) + "\n" + NOTICE) for i in range(5)]
    # The same text in another source is no copy of these.
    rows += [("x0", "t", 0, 4, article)]
    df = spark.createDataFrame(rows, "doc string, source string, cluster bigint, need int, text string")
    got = {(r["doc"], r["key"]) for r in X.repeated_lines(df).collect()}
    assert got == {(f"d{i}", NOTICE.lower()) for i in range(5)}


def test_short_texts_are_no_copies(spark):
    df = spark.createDataFrame([(f"d{i}", "s", i, 4, f"{NOTICE}\n{i}") for i in range(6)], "doc string, source string, cluster bigint, need int, text string")
    got = X.repeated_lines(df).collect()
    assert {r["doc"] for r in got} == {f"d{i}" for i in range(6)}
    assert {r["n_clusters"] for r in got} == {6}


def test_chain_of_misprints(spark):
    forms = ["this notice belongs to the northern harbour office", "this notice belongs to the northern harbor office", "this notice belongs to the norhern harbor office", "this notice belongs to the norhern harbor offce", "this notice belong to the norhern harbor offce"]
    texts = [t for i, t in enumerate(forms) for _ in range(6 - i)]
    rows = [(f"d{i}", "s", i, len(texts), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc string, source string, cluster bigint, need int, text string")
    assert X.repeated_lines(df).count() == 20


def test_dates(spark):
    texts = spark.createDataFrame([(f"d{i}", f"p{i}", NOTICE) for i in range(6)], "doc string, at string, text string")
    places = spark.createDataFrame([(f"p{i}", "s", i, 4, "2026-05-08" if i < 5 else None) for i in range(6)], "at string, source string, cluster bigint, need int, date string")
    assert {r["n_dates"] for r in X.repeated(texts, places).collect()} == {1}
    assert X.repeated(texts, places, min_dates=2).count() == 0
    assert X.repeated(texts, places.limit(0)).count() == 0


def test_ends_of_chains(spark):
    links = spark.createDataFrame([("s", i, i - 1) for i in range(1, 9)] + [("t", 4, 2)], "source string, a bigint, b bigint")
    got = {(r["source"], r["a"]): r["b"] for r in X.rooted(links).collect()}
    assert got == {**{("s", i): 0 for i in range(1, 9)}, ("t", 4): 2}
    edges = spark.createDataFrame([("s", 5, 1), ("s", 5, 2), ("s", 7, 2), ("s", 9, 8)], "source string, a bigint, b bigint")
    got = {r["a"]: r["b"] for r in X.united(edges).collect()}
    assert got == {5: 1, 2: 1, 7: 1, 9: 8}


def test_bitmap_holds_what_it_was_given(spark):
    import numpy as np

    ks = [0, 1, -1, 2**63 - 1, -(2**63), 12345 << 40]
    bits, size = X.bitmap(spark.createDataFrame([(k,) for k in ks], "k bigint"))
    words = np.frombuffer(bits, dtype=np.uint64)
    at = [(k & 0xFFFFFFFFFFFFFFFF) >> (64 - size) for k in ks]
    assert all(int(words[i >> 6]) >> (i & 63) & 1 for i in at)


def altered(rng, words, n):
    """The words with n of them, far apart, replaced by others that stand nowhere else."""
    out = list(words)
    for k in rng.sample(range(2, len(words) - 2, 6), n):
        out[k] = "".join(rng.choice("abcdefghijklmnop") for _ in range(12))
    return out


def test_all_pairs_at_the_threshold_are_found(spark):
    rng = random.Random(25)
    pool = ["".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(3000)]
    rows = []
    for s in range(150):
        words = rng.choices(pool, k=185)
        # Four words replaced change twenty shingles of 188 on either side.
        for i, w in enumerate((words, altered(rng, words, 4))):
            rows.append((f"{s}-{i}", f"s{s:03d}", i, 2, " ".join(w) + "\n" + NOTICE))
    sets = [set(X.shingles(X.folded(r[4]).split()).tolist()) for r in rows]
    near = [len(x & y) / len(x | y) for x, y in zip(sets[::2], sets[1::2])]
    assert min(near) >= 0.8 and max(near) < 0.86
    df = spark.createDataFrame(rows, "doc string, source string, cluster bigint, need int, text string")
    assert X.repeated_lines(df).count() == 0


def test_near_pairs_against_all_pairs():
    import numpy as np

    rng = np.random.RandomState(4)
    sets, clusters = [], []
    for g in range(40):
        own = rng.randint(0, 1 << 32, rng.randint(50, 260), dtype=np.uint32)
        for k in range(6):
            other = rng.randint(0, 1 << 32, len(own), dtype=np.uint32)
            keep = rng.rand(len(own)) < rng.uniform(0.8, 1)
            # What all texts of a source say stands in each.
            sets.append(np.unique(np.concatenate([own[keep], other[: rng.randint(0, 20)], np.arange(0, 1 << 30, 1 << 26, dtype=np.uint32)])))
            clusters.append(len(clusters))
    sizes = np.array([len(x) for x in sets])
    low = [x[: X.sketch_length(len(x))] for x in sets]
    share = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    want = {(i, j) for i in range(len(sets)) for j in range(i) if share(sets[i], sets[j]) >= X.SIMILARITY}
    met = {(i, int(j)) for i, near in X.meetings(low, sizes) for j in near if X.may_be_near(low[i], sizes[i], low[j], sizes[j])}
    assert want and want <= met and len(met) < 1000
    chosen, same = X.partners(np.array(clusters), low, sizes, np.arange(len(sets)))
    assert same == [] and {x for p in want for x in p} <= set(chosen.tolist())
    root = list(range(len(sets)))
    for a, b in sorted(want):
        root = [root[b] if r == root[a] else r for r in root]
    mine = list(range(len(sets)))
    for a, b in X.near_pairs(np.array(clusters), sets):
        assert (a, b) in want
        mine = [mine[b] if r == mine[a] else r for r in mine]
    assert [[x == r for x in root] for r in root] == [[x == r for x in mine] for r in mine]
