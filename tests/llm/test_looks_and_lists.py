from itertools import combinations

import pytest

from corpusgraph.llm import canonical as C
from corpusgraph.llm import skeleton as K


@pytest.mark.parametrize("a,b", [("abc", "аbс"), ("Ｌight", "Light"), ("a b", "a b"), ("a​b", "ab"), ("é", "é"), ("co­py", "copy"), ("ﬁle", "file"), ("A–B".replace("–", "‑"), "A-B"), ("x \ny", "x\r\ny"), ("Ο", "O")])
def test_same_look(a, b):
    assert K.skeleton(a) == K.skeleton(b)


@pytest.mark.parametrize("a,b", [("a", "á"), ("a", "A"), ("a.", "a!"), ("0", "O"), ("1", "l"), ("a\nb", "a b"), ("ab", "a b")])
def test_other_look(a, b):
    assert K.skeleton(a) != K.skeleton(b)


def test_pairs_against_brute_force(spark):
    texts = ["Light", "Lіght", "Ｌight", "Light", "Líght", "", None, "​", "x y", "x y", "light"]
    df = spark.createDataFrame([(f"k{i:02d}", t, "z") for i, t in enumerate(texts)], "id string, description string, look string")
    got = {(r["key_a"], r["key_b"]) for r in K.equal_looks(df, "id", "description").collect()}
    want = {(f"k{i:02d}", f"k{j:02d}") for i, j in combinations(range(len(texts)), 2) if texts[i] and texts[j] and K.skeleton(texts[i]) and K.skeleton(texts[i]) == K.skeleton(texts[j]) and texts[i] != texts[j]}
    assert got == want
    assert want
    assert K.equal_looks(df.limit(0), "id", "description").count() == 0
    classes = {r["id"]: (r["forms"], r["members"]) for r in K.look_classes(df, "id", "description").collect()}
    assert classes["k00"] == (3, 4)
    assert K.normalized(df, "id", "description").where("id = 'k06'").first()["form"] is None


ENTRIES = [("L1", ["Mount Grenoumo", "Radio Post 226"], []), ("L2", ["Lake Pexupor"], []), ("L3", ["Stoundal Valley"], []), ("L4", ["Lake Dronoken"], []), ("L5", ["Mount Vethéskis"], []), ("L6", ["Soruna Valley"], []), ("A1", ["Bureau of Sky Phenomena"], ["BSP"])]


@pytest.mark.parametrize(
    "value,expected",
    [
        ("Mount Grenoumo", "L1"), ("MOUNT GRENOUMO ", "L1"), ("Mt. Grenoumo", "L1"), ("Grenoumo, Mount", "L1"), ("Mоunt Grenоumo", "L1"), ("Mount Gernoumo", "L1"), ("near Mount Grenoumo", "L1"),
        ("approx. 14 km N of Lake Pexupor", "L2"), ("Pexupor", "L2"), ("Lake Pexup0r", "L2"), ("Radio Post 226", "L1"), ("the Radio Post 226", "L1"), ("Radio Post 227", "none"), ("Stoundal Vly", "L3"),
        ("Lake", "none"), ("grid square 7", "none"), ("B.S.P.", "A1"), ("the BSP", "A1"), ("BSQ", "none"), ("Bureau of Sky Phenomena (BSP)", "A1"), ("Bure. of Sky Phen.", "A1"), ("of Sky Phenomena, Bureau", "A1"),
    ],
)
def test_best(value, expected):
    assert C.Matcher(ENTRIES).best(value) == expected


def test_trie_against_brute_force():
    def osa(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    import random

    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(80)})
    t = C.Trie()
    for w in words:
        t.add(w, w)
    for _ in range(60):
        q = "".join(rng.choice("abc") for _ in range(rng.randint(1, 7)))
        for most in range(4):
            assert {w: d for w, (d, _) in t.search(q, most).items()} == {w: osa(q, w) for w in words if osa(q, w) <= most}


def test_map_values(spark):
    df = spark.createDataFrame([("1", "Lake Pexupor"), ("2", None), ("3", " n/a "), ("4", "—"), ("5", "elsewhere"), ("5", "elsewhere"), ("6", "")], "id string, place string")
    got = sorted((r["id"], r["field"], r["ref_id"]) for r in C.map_values(df, "id", "place", ENTRIES).collect())
    assert got == [("1", "place", "L2"), ("5", "place", "none")]
    assert C.map_values(df.limit(0), "id", "place", ENTRIES).count() == 0
