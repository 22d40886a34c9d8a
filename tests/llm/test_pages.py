import random

import numpy as np
import pytest

from corpusgraph.llm import line_kinds as L
from corpusgraph.llm import reading as R
from corpusgraph.llm import scan_repair as S
from corpusgraph.llm import site_lines as X
from corpusgraph.llm import text_quality as Q

COMMON = frozenset("the a of and to in was it on at by is that with from for he she they we had not did as".split())
PROSE = "The man was at the gate and he had a lamp with him.\nIt was on the hill that they saw the light for a\nlong time, and then it went to the sea."


@pytest.mark.parametrize(
    "text,verdict",
    [
        (PROSE, "prose"), (PROSE.upper(), "prose"), ("\n".join("Q. Was it on the hill? \n\nA. It was at the gate, and they saw it." for _ in range(4)), "prose"),
        ("\n".join(f"- {w} lamp" for w in ("red", "blue", "odd", "big", "wet")), "list"), ("\n".join(f"| {i} | {i * 7} | disc | K2-0{i} |" for i in range(8)), "table"),
        ("\n".join(f"Printer R{i}-41 ....... {i}" for i in range(8)), "table"), ("◊†·‡°¬ ■§▪\n" * 6, "junk"), ("xq;zk,vbrw tq|lk zzk\n" * 6, "junk"), ("", "empty"), (None, "empty"), (" \n\t", "empty"),
    ],
)
def test_verdict(text, verdict):
    assert Q.statistics(text, L.Tokens(COMMON))[-1] == verdict


def test_statistics(spark):
    df = spark.createDataFrame([(1, "the lamp\nthe lamp\n\nthe lamp."), (2, None), (3, "x" * 100_000), (1, "the lamp\nthe lamp\n\nthe lamp.")], "id bigint, text string")
    rows = {r["id"]: r for r in Q.text_statistics(df, ["id"], "text", COMMON).collect()}
    assert rows[1]["n_lines"] == 3
    assert rows[1]["n_words"] == 6
    assert rows[1]["duplicate_line_share"] > 0
    assert rows[2]["verdict"] == "empty"
    assert rows[3]["n_chars"] == 100_000
    assert Q.text_statistics(df.limit(0), ["id"], "text", COMMON).count() == 0


def brute_force(rows, need):
    """Lines whose key, up to one misread word, stands on `need` clusters of the source."""
    keys = {}
    for doc, source, cluster, text in rows:
        for no, key in X.line_keys(text or ""):
            keys.setdefault((source, key), []).append((doc, no, cluster))

    def same(a, b):
        x, y = a.split(" "), b.split(" ")
        return len(x) == len(y) and sum(p != q for p, q in zip(x, y)) <= 1 and all(X.close_words(p, q) for p, q in zip(x, y))

    out = set()
    for (s, k), places in keys.items():
        near = [p for (s2, k2), ps in keys.items() if s2 == s and same(k, k2) for p in ps]
        if len({c for _, _, c in near}) >= need:
            out |= {(d, n) for d, n, _ in places}
    return out


def test_repeated_lines(spark):
    rng = random.Random(2)
    notice = "Return this copy to the beacon registry"
    forms = [notice, notice.upper(), notice.replace("copy", "c0py"), notice.replace("beacon", "beacori"), "  " + notice + " .", notice.replace("e", "е", 1), notice.replace("registry", "regislry")]
    rows = []
    for p in range(12):
        words = [rng.choice("lamp hill gate moon cat light river stone watch tower".split()) for _ in range(60)]
        body = "\n".join(" ".join(words[i : i + 6]) for i in range(0, 60, 6))
        rows.append((f"d{p}", "s", p, body + ("\n" + forms[p % len(forms)] if p % 2 == 0 else "")))
    rows += [("e0", "s", 0, rows[0][3]), ("n", "s", 3, None), ("m", "t", 1, notice)]
    df = spark.createDataFrame([(d, s, c, 4, t) for d, s, c, t in rows], "doc string, source string, cluster bigint, need int, text string")
    found = X.repeated_lines(df)
    got = {(r["doc"], r["line_no"]) for r in found.collect()}
    assert got == brute_force(rows, 4)
    assert ("e0", 11) in got
    texts = {r["doc"]: r for r in X.drop_lines(df.select("doc", "text").where("doc <> 'n'"), found).collect()}
    assert notice not in texts["d0"]["text"]
    assert texts["d0"]["n_removed"] == 1
    assert X.repeated_lines(df.limit(0)).count() == 0


def test_one_word_of_many():
    assert X.close_words("watch", "watcb")
    assert X.close_words("modern", "modem")
    assert not X.close_words("corridor", "windscreen")
    assert not X.close_words("cat", "dog")


def test_misreading_costs():
    assert S.cost("aboiit", "about") == 0.5
    assert S.cost("rnan", "man") == 0.5
    assert S.cost("xbzut", "about") >= 1
    assert S.grams("light") & S.grams("hght")


def test_repair(spark):
    rng = random.Random(4)
    nouns = "lantern harbour observer telescope photograph signal barometer station witness compass".split()
    verbs = "watched carried repeated followed described".split()
    sentence = lambda: f"The {rng.choice(nouns)} {rng.choice(verbs)} the {rng.choice(nouns)} at the {rng.choice(nouns)} for a time."
    clean = spark.createDataFrame([(" ".join(sentence() for _ in range(10)),) for _ in range(120)], "text string")
    rows, places = [], []
    for p in range(60):
        lines = [f"FOLDER OF THE NORTHERN SERIES {p}"] + [sentence() for _ in range(8)] + [f"- {p} -"]
        rows.append([f"r{p:03d}", "\n".join(lines)])
        places.append((f"r{p:03d}", "s", p))
    t = rows[0][1].split("\n")
    t[2] = "The lantern watched the obser-"
    t[3] = "ver at the station for a time."
    t[5] = "The harbour carried the barorneter at the station for a time."
    rows[0][1] = "\n".join(t)
    rows += [["n", None], ["e", ""]]
    pages = spark.createDataFrame(rows, "result_id string, text string")
    at = spark.createDataFrame(places, "result_id string, source string, cluster bigint")
    got = {(r["result_id"], r["line_no"], r["kind"]) for r in S.cases(pages, clean, at, COMMON).collect()}
    assert ("r000", 3, "broken_word") in got
    assert ("r000", 6, "misread") in got
    assert {("r000", 1, "furniture"), ("r000", 10, "furniture")} <= got
    assert not {x for x in got if x[0] == "r005" and 2 <= x[1] <= 9}


def test_cuts():
    pairs = [(i / 10, 1) for i in range(10)] + [(1 + i / 10, 2) for i in range(10)] + [(2 + i / 10, 3) for i in range(10)] + [(0.3, 3)]
    low, high, direction = R.cuts(pairs)
    assert direction == 1
    assert 0.9 < low < 1
    assert 1.9 < high < 2
    assert R.cuts([(-t, b) for t, b in pairs])[2] == -1
    assert R.cuts([])[2] == 1


def test_refit_finds_slopes():
    words = np.zeros((4, len(R.GRID)))
    words[0], words[1], words[2] = 100 * np.exp(R.GRID), 100 * np.exp(-R.GRID), 100
    easiness, slope = R.refit(words, np.zeros(4))
    assert slope[0] > slope[2] > slope[1]
    assert slope[3] == 0
    assert easiness[3] == -30


def test_levels(spark):
    easy = "the cat sat on the mat and it was big and the dog ran to the red hut with a hat".split()
    hard = "institutional reconciliation of the methodological uncertainty demonstrably presupposes an extraordinary configuration that the committee considers".split()
    rng = random.Random(1)
    text = lambda pool: " ".join(rng.choice(pool) for _ in range(90)) + " of the and to in."
    rows = [(i, text(easy if i % 2 else hard)) for i in range(60)] + [(100, None), (101, ""), (102, "the cat"), (103, "| 1 | 2 |\n" * 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, "a", 1 if i % 2 else 3) for i in range(12)], "doc_id bigint, annotator string, band int")
    got = {r["doc_id"]: r["band"] for r in R.rate(df, labels, {"en": COMMON, "fr": frozenset(["le", "la"])}).collect()}
    assert set(got) == set(range(60))
    assert all(b == (1 if i % 2 else 3) for i, b in got.items())
    assert R.rate(df.limit(0), labels, {"en": COMMON}).count() == 0
