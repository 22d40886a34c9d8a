"""One form for texts that look the same but hold different characters (problem 5).

Method: the confusables skeleton. A text is decomposed, every character is replaced by its
prototype from a look-alike table, and the result is decomposed again; originals with equal
skeletons look the same in print. Characters without ink (zero-width ones, soft hyphens,
joiners, selectors, direction marks) have the empty prototype; blanks of any width have the
plain blank; narrow, full-width, font and ligature forms have the characters they show.

A visible difference stays one: accents, case, punctuation, and digits that resemble letters
are prototypes of themselves. Line breaks are kept, blanks at the ends of lines are not seen.

Defined results: null texts have no skeleton; texts without ink have the empty one and form no
group. Repeated identical rows are one printing and make no pair among themselves.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.session import checkpoint

# Letters of other scripts and the Latin letters they look like, pair by pair. A larger
# table, such as the public one of confusables, is a parameter (see `confusables`).
LOOK_ALIKES = (
    ("аАВсСԁеЕһНіІјЈКӏМоОрРԛѕЅТԝхХуУѵүѡԍԌӀг", "aABcCdeEhHiIjJKlMoOpPqsSTwxXyYvywgGIr"),  # Cyrillic
    ("αΑΒΕΖΗιΙΚΜνΝοΟρΡΤΥΧϲϹϳσγυ", "aABEZHiIKMvNoOpPTYXcCjoyu"),  # Greek
    ("օոհսցզյՕՏԼՍ", "onhugqjOSLU"),  # Armenian
    ("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏃᏒᏔᏙᏚᏞᏟᏢᏦ", "DRTAJEWMHYZRWVSLCPK"),  # Cherokee
    ("ⲟⲞⲣⲢⲥⲤⲎⲒⲔⲘⲚⲦⲬⲀⲂ", "oOpPcCHIKMNTXAB"),  # Coptic
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),  # Lisu
    ("ıɑɡɩɪᴏᴄᴠᴡᴢᴜꜱſȷǀ", "iagiiocvwzusfjl"),  # Latin
    ("ʹ’‘‐‑‒﹘⁃˗−∕⁄∶․∗∣‹›", "'''-------//:.*|<>"),  # signs
)
#: Characters without ink outside of the categories Cf and Mn.
NO_INK = "͏ᅟᅠ឴឵᠋᠌᠍᠎ㅤﾠ"
_SHOWN = ("<wide>", "<narrow>", "<noBreak>", "<font>")


class Prototypes(dict):
    """Prototype of a code point for str.translate; entries are worked out when first met. `more` are further look-alikes."""

    def __init__(self, more: dict[int, str] | None = None):
        super().__init__()
        self.update(more or {})
        for a, b in LOOK_ALIKES:
            self.update(str.maketrans(a, b))
        self.update(dict.fromkeys(map(ord, NO_INK), ""))
        self.update({0x0A: 0x0A, 0x09: " ", 0x0D: "\n", 0x0B: "\n", 0x0C: "\n", 0x85: "\n", 0x2028: "\n", 0x2029: "\n"})

    def __missing__(self, code: int):
        c = chr(code)
        kind, parts = unicodedata.category(c), unicodedata.decomposition(c)
        if kind == "Cf" or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
            out = ""
        elif kind == "Zs":
            out = " "
        elif parts.startswith(_SHOWN) or 0xFB00 <= code <= 0xFB06 or 0x2160 <= code <= 0x217F:
            # Ligatures and Roman numerals show the letters they are made of.
            out = unicodedata.normalize("NFKD", c).translate(self)
        else:
            out = code
        self[code] = out
        return out


PROTOTYPES = Prototypes()


def confusables(path: str) -> dict[int, str]:
    """Prototypes of letters from a table in the public form (code points ; their prototype ; kind # note).

    Pairs of which either side is ASCII and not a letter are left out, as are ASCII characters
    themselves: what is told apart in print (a digit and a letter, signs) stays apart.
    """
    out: dict[int, str] = {}
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            cells = [c.strip() for c in line.split("#")[0].split(";")]
            if len(cells) >= 2 and cells[0] and " " not in cells[0]:
                code, shown = int(cells[0], 16), "".join(chr(int(c, 16)) for c in cells[1].split())
                if code > 0x7F and unicodedata.category(chr(code))[0] == "L" and all(c.isalpha() for c in shown):
                    out[code] = shown
    return out


#: Tables of a worker by their further look-alikes.
_TABLES: dict[tuple, Prototypes] = {}


def table_of(more: dict[int, str] | None) -> Prototypes:
    if not more:
        return PROTOTYPES
    key = tuple(sorted(more.items()))
    if key not in _TABLES:
        _TABLES[key] = Prototypes(more)
    return _TABLES[key]
_BLANKS = re.compile(r" {2,}")
_ENDS = re.compile(r" *\n *")


def prototype(text: str, table: Prototypes = PROTOTYPES) -> str:
    """Decompose, replace by prototypes, decompose again; blanks and lines stay as they are."""
    if text.isascii():
        return text.replace("\r\n", "\n").translate(table) if any(c in text for c in "\t\r\x0b\x0c") else text
    norm = unicodedata.normalize
    return norm("NFD", norm("NFD", text.replace("\r\n", "\n")).translate(table))


def skeleton(text: str, table: Prototypes = PROTOTYPES) -> str:
    """The skeleton of a whole text: prototypes, with runs of blanks as one and none at line ends."""
    s = prototype(text, table)
    if "  " in s:
        s = _BLANKS.sub(" ", s)
    return _ENDS.sub("\n", s).strip("\n ")


def visible_form(text: str, table: Prototypes = PROTOTYPES) -> str:
    """The form to keep: the skeleton with its accents composed."""
    s = skeleton(text, table)
    return s if s.isascii() else unicodedata.normalize("NFC", s)


def _digest(s: str) -> bytes:
    return hashlib.blake2b(s.encode(), digest_size=16).digest()


def normalized(df: DataFrame, key: str, text: str, more: dict[int, str] | None = None) -> DataFrame:
    """(`key`, form): every row's text in its consistent form, null if the text is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(more)
        for b in batches:
            forms = [None if t is None else visible_form(t, table) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(forms, type=pa.string())], names=["k", "form"])

    out = df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {df.schema[key].dataType.simpleString()}, form string")
    return out.withColumnRenamed("k", key)


def prints(df: DataFrame, key: str, text: str, more: dict[int, str] | None = None) -> DataFrame:
    """(k, look, stored): digests of the skeleton and of the stored text of every row with ink."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(more)
        for b in batches:
            keys, looks, stored = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = skeleton(t, table)
                if s:
                    keys.append(k)
                    looks.append(_digest(s))
                    stored.append(_digest(t))
            yield pa.RecordBatch.from_arrays([pa.array(keys, type=pa.string()), pa.array(looks, type=pa.binary()), pa.array(stored, type=pa.binary())], names=["k", "look", "stored"])

    src = df.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).where("t is not null and k is not null")
    return src.mapInArrow(run, "k string, look binary, stored binary")


def equal_looks(df: DataFrame, key: str, text: str, more: dict[int, str] | None = None) -> DataFrame:
    """(key_a, key_b): rows that look the same and are stored differently, key_a < key_b.

    The result holds every pair of a group, which grows with the square of its forms' rows;
    `look_classes` says the same in one row for each row. Stored forms are collapsed first and paired by skeleton, so that a form held by very many
    rows is one member of its group; rows come back through their form. Work follows the result.
    """
    rows = checkpoint(prints(df, key, text, more))
    forms = rows.select("look", "stored").distinct()
    several = forms.groupBy("look").count().where("count > 1").select("look")
    rows = rows.join(several, "look", "left_semi").distinct()
    forms = forms.join(several, "look", "left_semi")
    a = forms.select("look", F.col("stored").alias("sa"))
    b = forms.select("look", F.col("stored").alias("sb"))
    pairs = a.join(b, "look").where("sa < sb")
    left = rows.select("look", F.col("stored").alias("sa"), F.col("k").alias("ka"))
    right = rows.select("look", F.col("stored").alias("sb"), F.col("k").alias("kb"))
    out = pairs.join(left, ["look", "sa"]).join(right, ["look", "sb"])
    return out.select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b")).where("key_a < key_b")


def look_classes(df: DataFrame, key: str, text: str, more: dict[int, str] | None = None) -> DataFrame:
    """(`key`, class_id, forms, members): the class of equal looks of each row with ink."""
    rows = checkpoint(prints(df, key, text, more))
    sizes = rows.groupBy("look", "stored").agg(F.count(F.lit(1)).alias("n")).groupBy("look").agg(F.count(F.lit(1)).alias("forms"), F.sum("n").alias("members"))
    return rows.join(sizes, "look").select(F.col("k").alias(key), F.hex("look").alias("class_id"), "forms", "members")

