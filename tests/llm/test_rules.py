import pytest

from corpusgraph.llm import canonical as C
from corpusgraph.llm import line_kinds as L
from corpusgraph.llm import pack as P
from corpusgraph.llm import reading as R
from corpusgraph.llm import skeleton as K
from corpusgraph.llm import text_quality as Q

COMMON = frozenset("the a of and to in was it on at by is that with from for he she they we had not did as this your if you".split())


@pytest.mark.parametrize(
    "text",
    [
        "Share this page with your friends if you like it.\n" * 40,
        "The notice was printed for the readers of the paper, and it is not to be copied.\n\n" * 12,
        "was it a lamp " * 60 + "and they had the lamp.",
    ],
)
def test_repetition_is_boilerplate(text):
    assert Q.statistics(text, L.Tokens(COMMON))[-1] == Q.BOILERPLATE


def test_some_repetition_is_prose():
    text = "\n".join(f"The {a} was at the {b}, and it was not for the {a}." for a in ("lamp", "boat", "man", "dog") for b in ("gate", "hill", "sea"))
    assert Q.statistics(text + "\nThe lamp was at the gate, and it was not for the lamp.", L.Tokens(COMMON))[-1] == "prose"


PLACES = [("L1", ["Red Valley"], []), ("L2", ["Blue Harbour"], []), ("L3", ["Red Volley"], [])]


def test_parts_behind_a_stroke():
    m = C.Matcher(PLACES)
    assert m.best("unknown / Blue Harbour") == "L2"
    assert m.best("unknown; lost - Blue Harbour") == "L2"
    assert m.best("Blue Harbour / Red Valley") == "L2"
    assert m.all_within("Blue Harbour / Red Valley") == {"L2": 0, "L1": 1, "L3": 3}


def test_expansions_are_not_capped():
    # Sixty words with one initial, of which the last in order is meant, twice in a value.
    names = [f"S{chr(97 + i // 20)}{chr(97 + i % 20)}aren" for i in range(60)]
    entries = [(f"E{i:02d}", [f"{n} {m} Garno{i}x"], []) for i, (n, m) in enumerate(zip(names, names[1:] + names[:1]))] + [(f"F{i}", [f"{n} Tower"], []) for i, n in enumerate(names)]
    m = C.Matcher(entries)
    assert m.best("S. S. Garno58x") == "E58"
    assert m.best("Sctaren Tower") == "F59"


def test_all_entries_within_the_distance():
    import random

    rng = random.Random(3)
    names = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(5, 9))) for _ in range(60)})
    m = C.Matcher([(n, [n], []) for n in names])

    def osa(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    for _ in range(40):
        q = "".join(rng.choice("ab") for _ in range(rng.randint(5, 9)))
        assert m.all_within(q) == {n: 2 * osa(q, n) for n in names if osa(q, n) <= C.allowed(len(q))}


def test_candidates_and_report(spark):
    df = spark.createDataFrame([("1", "Red Valley"), ("2", "elsewhere"), ("3", "elsewhere"), ("3", "elsewhere"), ("4", None), ("5", " ")], "id string, place string")
    got = {(r["value"], r["ref_id"], r["cost"]) for r in C.matches(df.select("place").toDF("value").where("value is not null").distinct(), PLACES, every=True).collect()}
    assert got == {("Red Valley", "L1", 0), ("Red Valley", "L3", 2)}
    assert [(r["value"], r["n_rows"]) for r in C.unmatched(df, "id", "place", PLACES).collect()] == [("elsewhere", 2)]
    assert C.unmatched(df.limit(0), "id", "place", PLACES).count() == 0


@pytest.mark.parametrize("a,b", ["օo", "ոn", "ᎪA", "ᎳW", "ⲟo", "ѵv", "үy", "ѡw", "ԌG", "σo", "γy", "ᴏo", "ɩi", "ⅬL", "∕/", "ǀl"])
def test_more_look_alikes(a, b):
    assert K.skeleton(f"x{a}z") == K.skeleton(f"x{b}z")


def test_table_of_confusables(spark, tmp_path):
    p = tmp_path / "table.txt"
    p.write_text("\ufeff# a table\n\n0501 ;\t0064 ;\tMA\t# look\n10D5 ;\t0033 ;\tMA\n0660 ;\t002E ;\tMA\nA4D3 0042 ;\t0044 ;\tMA\n1D0D ;\t0072 006E ;\tMA\n0031 ;\t006C ;\tMA\n", encoding="utf-8")
    more = K.confusables(str(p))
    assert more == {0x0501: "d", 0x1D0D: "rn"}
    assert K.skeleton("\u1d0d", K.table_of(more)) == "rn"
    assert K.skeleton("\u1d0d") != "rn"
    df = spark.createDataFrame([("a", "co\u1d0dder"), ("b", "cornder"), ("c", None)], "id string, t string")
    assert [(r["key_a"], r["key_b"]) for r in K.equal_looks(df, "id", "t", more).collect()] == [("a", "b")]
    assert K.equal_looks(df, "id", "t").count() == 0
    assert K.normalized(df, "id", "t", more).where("id = 'a'").first()["form"] == "cornder"


def test_events_are_cut_at_blocks():
    events = [(7, 0, 3, 0, 0), (7, 3, P.BLOCK * 2, 10, 5), (9, P.BLOCK, 1, 3, 0)]
    got = P.in_blocks(events)
    assert all(lo // P.BLOCK == block == (lo + n - 1) // P.BLOCK for _, block, lo, n, _, _ in got)
    ranks = lambda rows: sorted((s, lo + i, c + i, o) for s, lo, n, c, o in rows for i in range(n))
    assert ranks([(s, lo, n, c, o) for s, _, lo, n, c, o in got]) == ranks(events)


def test_held_out_agreement(spark):
    rated = spark.createDataFrame([(i, float(i // 100)) for i in range(300)], "doc_id bigint, level double")
    labels = spark.createDataFrame([(i, "a", 1 + i // 100) for i in range(300)], "doc_id bigint, annotator string, band int")
    r = R.agreement(rated, labels).first()
    assert r["n_fitted"] + r["n_held_out"] == 300
    assert r["n_held_out"] == r["n_agreeing"] > 20
    assert R.agreement(rated, labels.limit(0)).first()["n_held_out"] == 0
