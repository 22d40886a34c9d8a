import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusgraph.llm import encode as E
from corpusgraph.llm import pack as P
from corpusgraph.llm import split as S

ODD = "'re'ſ \x1c\x1c  　a​!!  \n\n\t x\x85'll  東の'v e🛸👩‍🚀<|endoftext|>"


@given(st.text(alphabet=ODD, max_size=80), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_tree_equals_whole(text, leaf):
    encode, words, counts, lengths = E.encoder(E.RANK_FILE)
    whole = encode(text)
    assert list(E.encode_tree(text, encode, words, lengths, leaf)) == whole
    assert E.leaf_count(text, encode, counts) == len(whole)
    assert E.decode_tree(whole) == text


def test_long_text_without_blanks():
    encode, words, _, lengths = E.encoder(E.RANK_FILE)
    text = "ab1!" * 3000
    assert list(E.encode_tree(text, encode, words, lengths)) == encode(text)


def test_encode_corpus(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "", "x"), (3, None, "x"), (4, "   \n\t", "x"), (1, "a b", "x")], "doc_id bigint, text string, ids string")
    rows = E.encode_corpus(df).collect()
    got = {r["doc_id"]: r["ids"] for r in rows}
    assert len(rows) == 5
    assert got[2] == got[3] == []
    assert got[1] == E.encoder(E.RANK_FILE)[0]("a b")
    assert got[4]
    assert E.encode_corpus(df.limit(0)).count() == 0
    assert {r["doc_id"]: r["n_tokens"] for r in E.count_tokens(df).collect()} == {k: len(v) for k, v in got.items()}


@given(st.text(alphabet="ab. \n\té🛸", min_size=0, max_size=400), st.integers(10, 60), st.integers(0, 9))
@settings(max_examples=300, deadline=None)
def test_pieces(text, limit, overlap):
    got = S.pieces(text, limit, overlap)
    assert got[0][0] == got[0][1] == 0
    assert got[-1][2] == len(text)
    for a, b in zip(got, got[1:]):
        assert a[2] == b[1]
    for i, (f, s, e) in enumerate(got):
        assert e - f <= limit
        assert 0 <= s - f <= overlap
        assert i == 0 or e > s


def test_cuts_at_strongest():
    text = "word " * 200 + "end.\n\n" + "word " * 200
    starts = [s for _, s, _ in S.pieces(text, 1800, 180)]
    assert text[: starts[1]].endswith("\n\n")


def test_split_items(spark):
    df = spark.createDataFrame([(1, "x" * 4000), (2, "short"), (3, None), (4, "")], "k bigint, t string")
    rows = S.split_items(df, "k", "t").collect()
    by = {}
    for r in sorted(rows, key=lambda r: r["piece_no"]):
        by.setdefault(r["k"], []).append(r)
    assert set(by) == {1, 2, 4}
    assert len(by[1]) == by[1][0]["n_pieces"] >= 3
    assert by[1][0]["piece"] + "".join(r["piece"][r["start"] - r["from_pos"] :] for r in by[1][1:]) == "x" * 4000


def test_pack(spark):
    rng = random.Random(3)
    sizes = {i: rng.choice([0, 1, 7, 700, 700, 1500, 2047, 2048, 2049, 9000]) for i in range(800)}
    df = spark.createDataFrame(list(sizes.items()), "k bigint, n bigint")
    rows = P.pack(df, "k", "n").collect()
    per, items = {}, {}
    for r in rows:
        per.setdefault(r["container_id"], []).append((r["offset"], r["n_units"]))
        items[r["k"]] = items.get(r["k"], 0) + r["n_units"]
    assert items == {k: v for k, v in sizes.items() if v}
    for parts in per.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    for r in rows:
        assert sizes[r["k"]] > 2048 or r["n_units"] == sizes[r["k"]]
    assert len(per) <= 1.1 * sum(sizes.values()) / 2048 + 1
    assert P.pack(df.limit(0), "k", "n").count() == 0


@pytest.mark.parametrize("histogram", [{}, {5: 1}, {2048: 3}, {1: 5000}, {1025: 10, 1023: 10}])
def test_plan(histogram):
    events, total = P.plan(histogram, 2048)
    room = {}
    for length, _, n, first, offset in events:
        for c in range(first, first + n):
            assert room.get(c, 0) == offset
            room[c] = offset + length
    assert all(v <= 2048 for v in room.values())
    assert sum(n for _, _, n, _, _ in events) == sum(histogram.values())
    assert len(room) == total or total == 0
