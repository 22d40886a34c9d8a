"""Mapping freely typed values to a reference list (problem 4).

Method: the accepted spellings of every entry (name, other names, acronym, the name turned
about at a comma, the name without its kind where that is unique) are paths of one trie. A
value, in several readings, is searched in the trie with a Levenshtein automaton, simulated by
the row of edit distances carried along the trie; it also counts a swap of neighbours as one
edit. All entries within a distance that depends on the value's length come back; the closest
is the value's entry, and a value without any is reported as unmatched.

Folding before the search: look-alike characters by prototype, case, accents, punctuation, and
digits that stand for letters within words. A token of digits alone is a number, must be equal
in value and entry, and is no misspelling. Tokens cut short ("Is.", "Plat.", "St.", "A.S.") are
expanded to the words that they abbreviate, path by path: a path is tried with its own words in the
place of all tokens cut short, so no product over the list's words is ever formed or cut.

The reference list must be small enough for a broadcast; its size is checked against
MAX_ENTRIES. Distinct values are matched once. Defined results: blank values (null, empty,
blanks, N/A in any case, dashes) give no row; a tie between entries goes to the smaller id.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.skeleton import prototype

MAX_ENTRIES = 100_000
NONE = "none"
#: Words and phrases that only qualify a place or an office.
BEFORE = re.compile(r"^(?:the|(?:(?:approx|about|circa|ca)\W+)?(?:\d+\s*(?:km|miles?|m|nm)\s+(?:[nsew]{1,3}|north|south|east|west)\s+of|off|near|at|in|over|around|vicinity of|close to|north of|south of|east of|west of))\s+", re.I)
BEHIND = re.compile(r"[\s,]+(?:area|region|vicinity|district|approx|hq|headquarters|field office|forwarded|shore|seaward side|(?:section|sect|desk|unit|branch) \d+)$", re.I)
#: Digits that are typed or read for letters; l and i are one letter in keys, as 1 stands for both.
AS_LETTER = str.maketrans("01358l", "oiesbi")
_WORD = re.compile(r"[a-z0-9]+")
_BLANK = re.compile(r"^\W*$|^\W*n\s*/\s*a\W*$", re.I)


def plain(value: str) -> str:
    """Prototype, lower case, without accents; underscores and blanks as one blank."""
    s = unicodedata.normalize("NFD", prototype(value))
    s = "".join(c for c in s if not unicodedata.combining(c)).lower()
    return re.sub(r"[\s_]+", " ", s).strip(" \"'")


def is_blank(value: str | None) -> bool:
    return value is None or bool(_BLANK.match(prototype(value).replace("_", " ")))


def tokens(text: str) -> list[str]:
    """Words of a key; digits within words become letters, numbers stay."""
    return [w if w.isdigit() else w.translate(AS_LETTER) for w in _WORD.findall(text)]


def allowed(length: int) -> int:
    """Edits allowed for a key of so many characters."""
    return 0 if length < 5 else 1 if length < 8 else 2 if length < 12 else 3


def _within(short: str, word: str) -> bool:
    """Whether the letters of `short` occur in `word` in their order."""
    letters = iter(word)
    return all(c in letters for c in short)


class Trie:
    """Paths of characters; node = {char: node}, entries of a path under the key ''."""

    def __init__(self):
        self.root: dict = {}

    def add(self, path: str, entry: str) -> None:
        node = self.root
        for c in path:
            node = node.setdefault(c, {})
        node.setdefault("", set()).add(entry)

    def search(self, key: str, most: int) -> dict[str, tuple[int, str]]:
        """Closest path within `most` edits of each entry: {entry: (edits, path)}.

        The automaton's state is the band of `most` cells to each side of the diagonal; a branch
        ends when no cell of its last two rows can still lead to a match.
        """
        out: dict[str, tuple[int, str]] = {}
        far, n = most + 1, len(key)

        def walk(node: dict, path: str, row: dict[int, int], before: dict[int, int]) -> None:
            depth = len(path)
            for entry in node.get("", ()):
                d = row.get(n, far)
                if d <= most and (entry not in out or (d, path) < out[entry]):
                    out[entry] = (d, path)
            for c, child in node.items():
                if c == "":
                    continue
                new: dict[int, int] = {}
                for i in range(max(0, depth + 1 - most), min(n, depth + 1 + most) + 1):
                    d = row.get(i, far) + 1
                    if i:
                        k = key[i - 1]
                        d = min(d, new.get(i - 1, far) + 1, row.get(i - 1, far) + (k != c))
                        if i > 1 and depth and k == path[-1] and key[i - 2] == c:
                            d = min(d, before.get(i - 2, far) + 1)
                    if d <= most:
                        new[i] = d
                if new or any(v < most for v in row.values()):
                    walk(child, path + c, new, row)

        walk(self.root, "", {i: i for i in range(min(n, most) + 1)}, {})
        return out


class Matcher:
    """The trie of a reference list and the readings of typed values."""

    def __init__(self, entries: Iterable[tuple[str, list[str], list[str]]]):
        """entries: (id, names, acronyms)."""
        entries = [(i, [n for n in names if n], [a for a in acronyms if a]) for i, names, acronyms in entries]
        if len(entries) > MAX_ENTRIES:
            raise ValueError("the reference list is too long for a broadcast")
        self.trie, self.exact = Trie(), {}
        self.paths: list[list[str]] = []
        self.short: dict[str, dict[int, list[str]]] = {}
        words = Counter(w for _, names, _ in entries for w in {w for n in names for w in tokens(plain(n)) if not w.isdigit()})
        #: Words of several entries name a kind (lake, valley, office), not the thing itself.
        self.kinds = {w for w, n in words.items() if n > 1}
        self.words = set(words)
        bare: dict[str, set[str]] = {}
        for i, names, acronyms in entries:
            for n in names:
                ts = tokens(plain(n))
                self._path(ts, i)
                own = [w for w in ts if w not in self.kinds]
                if own and len(own) < len(ts) and not any(w.isdigit() for w in ts) and len("".join(own)) >= 5:
                    bare.setdefault(" ".join(own), set()).add(i)
            for a in acronyms:
                self.exact.setdefault("".join(_WORD.findall(plain(a))), set()).add(i)
        for path, owners in bare.items():
            if len(owners) == 1:
                self._path(path.split(" "), next(iter(owners)))

    def _path(self, ts: list[str], entry: str) -> None:
        self.trie.add("".join(ts), entry)
        if ts not in self.paths:
            self.paths.append(ts)

    def _abbreviates(self, short: str, word: str) -> bool:
        if len(word) <= len(short) or word[0] != short[0]:
            return False
        kind = word in self.kinds
        return word.startswith(short) and (len(short) > 2 or kind) or kind and word[-1] == short[-1] and _within(short, word)

    def _expansions(self, short: str) -> dict[int, list[str]]:
        """Words that a token abbreviates, by the path that holds them."""
        if short not in self.short:
            if len(self.short) > 100_000:
                self.short.clear()
            words = {w for w in self.words if self._abbreviates(short, w)}
            found = {i: [w for w in ts if w in words] for i, ts in enumerate(self.paths)} if words else {}
            self.short[short] = {i: ws for i, ws in found.items() if ws}
        return self.short[short]

    def _expanded(self, ts: list[tuple[str, bool]]) -> Iterator[list[str]]:
        """Tokens with those cut short replaced by the words of a path that they abbreviate, for each path that has one for all of them."""
        cut = {i: self._expansions(w) for i, (w, dotted) in enumerate(ts) if w not in self.words and not w.isdigit() and (dotted or len(w) <= 4)}
        cut = {i: e for i, e in cut.items() if e}
        if not cut:
            yield [w for w, _ in ts]
            return
        for path in set.intersection(*map(set, cut.values())):
            yield from map(list, product(*(dict.fromkeys(cut[i][path]) if i in cut else [w] for i, (w, _) in enumerate(ts))))

    def readings(self, value: str) -> list[tuple[int, str, list[tuple[str, bool]]]]:
        """(penalty, text, tokens) of the ways to read a value, plainest first."""
        s = plain(value)
        texts: dict[str, int] = {}

        def add(t: str, penalty: int) -> None:
            t = t.strip(" .,;:\"'-/")
            if t and t not in texts:
                texts[t] = penalty

        add(s, 0)
        add(re.sub(r"\([^)]*\)", " ", s), 0)
        for t in list(texts):
            u = BEFORE.sub("", BEFORE.sub("", t))
            for _ in range(3):
                v = BEHIND.sub("", u).strip(" .,;:-/")
                if v == u:
                    break
                u = v
            add(u, 0)
            for n, part in enumerate(re.split(r"\s*/\s*|\s+-\s+|\s*;\s*", u)):
                add(part, int(n > 0))
        for t in list(texts):
            if t.count(",") == 1:
                a, b = (x.strip() for x in t.split(","))
                add(f"{b} {a}", 0)
                add(a, 1)
        for t in re.findall(r"\(([^)]*)\)", s):
            add(t, 1)
        out = []
        for t, penalty in texts.items():
            ts = [(w if w.isdigit() else w.translate(AS_LETTER), t[m_end : m_end + 1] == ".") for w, m_end in ((m.group(), m.end()) for m in _WORD.finditer(t))]
            if ts:
                out.append((penalty, t, ts))
        return out

    def all_within(self, value: str, closest: bool = False, most: int = 3) -> dict[str, int]:
        """Every entry within the distance that the value's length allows: {id: cost}.

        A cost is twice the edits, and one more for a reading that drops a part. With `closest` an
        acronym settles the matter, and otherwise the distance is raised step by step and the
        search ends at the first that finds any.
        """
        found: dict[str, int] = {}
        keys: dict[str, tuple[int, list[str]]] = {}
        readings = self.readings(value)
        for penalty, text, _ in readings:
            for i in self.exact.get("".join(_WORD.findall(text)), ()):
                found[i] = min(found.get(i, 99), penalty)
        if found and closest:
            return found
        for penalty, _, ts in readings:
            for words in self._expanded(ts):
                key, numbers = "".join(words), [w for w in words if w.isdigit()]
                if key not in keys or penalty < keys[key][0]:
                    keys[key] = (penalty, numbers)
        for edits in range(most + 1) if closest else (most,):
            for key, (penalty, numbers) in keys.items():
                reach = allowed(len(key))
                if edits <= reach or not closest:
                    for i, (d, path) in self.trie.search(key, min(edits, reach)).items():
                        if re.findall(r"\d+", path) == numbers:
                            found[i] = min(found.get(i, 99), 2 * d + penalty)
            if found and closest:
                break
        return found

    def best(self, value: str) -> str:
        found = self.all_within(value, closest=True)
        return min(found, key=lambda i: (found[i], i)) if found else NONE


#: Matchers of a worker by their list.
_MATCHERS: dict[tuple, Matcher] = {}


def _matcher(entries: tuple) -> Matcher:
    if entries not in _MATCHERS:
        if len(_MATCHERS) > 4:
            _MATCHERS.clear()
        _MATCHERS[entries] = Matcher(entries)
    return _MATCHERS[entries]


def matches(values: DataFrame, entries: list[tuple[str, list[str], list[str]]], every: bool = False) -> DataFrame:
    """(value, ref_id, cost) of each value of `values` (value, distinct) that isn't blank: its entry or none.

    With `every`, all entries within the distance, and no row for a value without any. Distinct
    values are few bytes and much work, so they are spread over four tasks a core.
    """
    spark = values.sparkSession
    sent = spark.sparkContext.broadcast(tuple((i, tuple(names), tuple(acronyms)) for i, names, acronyms in entries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _matcher(sent.value)
        for b in batches:
            rows = []
            for v in b.column(0).to_pylist():
                if not is_blank(v):
                    found = m.all_within(v, closest=not every)
                    if not every:
                        best = min(found, key=lambda i: (found[i], i)) if found else NONE
                        found = {best: found.get(best)}
                    rows += [(v, i, c) for i, c in found.items()]
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()))], names=["value", "ref_id", "cost"])

    tasks = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return values.select("value").repartition(tasks, "value").mapInArrow(run, "value string, ref_id string, cost bigint")


def map_values(df: DataFrame, key: str, field: str, entries: list[tuple[str, list[str], list[str]]]) -> DataFrame:
    """(`key`, field, ref_id) of each non-blank value; distinct values are matched once.

    A hot value is one row after `distinct`, and joins back through a broadcastable or skew-split
    equi-join on the value.
    """
    rows = df.select(F.col(key).alias("k"), F.col(field).alias("value")).where("k is not null and value is not null").distinct()
    mapped = matches(rows.select("value").distinct(), entries).drop("cost")
    return rows.join(mapped, "value").select(F.col("k").alias(key), F.lit(field).alias("field"), "ref_id").distinct()


def unmatched(df: DataFrame, key: str, field: str, entries: list[tuple[str, list[str], list[str]]]) -> DataFrame:
    """(field, value, n_rows): the non-blank values that belong to no entry, with the number of their rows; repeated rows count once."""
    counts = df.select(F.col(key).alias("k"), F.col(field).alias("value")).where("value is not null").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))
    none = matches(counts.select("value"), entries).where(F.col("ref_id") == NONE).select("value")
    return counts.join(none, "value").select(F.lit(field).alias("field"), "value", "n_rows")


def entries_of(ref: DataFrame, key: str, names: list[str], acronyms: list[str] = ()) -> list[tuple[str, list[str], list[str]]]:
    """A small reference table on the driver; MAX_ENTRIES + 1 rows at most are taken, more is an error."""
    rows = ref.select(key, *names, *acronyms).where(F.col(key).isNotNull()).orderBy(key).limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError("the reference list is too long for a broadcast")
    return [(r[key], [r[n] for n in names if r[n]], [r[a] for a in acronyms if r[a]]) for r in rows]
