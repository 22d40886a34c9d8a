"""What the lines of a page are: prose, list, table, or matter that can't be read.

Used by the quality statistics, the repair of scanned pages and the reading level. A line is
judged by its own form and by the block it stands in, so that the short last line of a
paragraph and a narrow line without any common word still count as prose.
"""

from __future__ import annotations

import re
import struct

from corpusgraph.llm.skeleton import prototype

PROSE, LIST, TABLE, JUNK, BLANK = "prose", "list", "table", "junk", "blank"

_WORD = re.compile(r"[^\W\d_]+(?:['-][^\W\d_]+)*")
_GAP = re.compile(r"\S(?:\t+ *| {2,})(?=\S)")
_LEADER = re.compile(r"(?:\. ?){4,}|_{4,}|-{4,}")
_ITEM = re.compile(r"^\s*(?:[-*•·‣▪■□◊–—+>]|\(?(?:\d{1,3}|[ivx]{1,5}|[A-Za-z])[.)])\s+")
_SPEAKER = re.compile(r"^\s*(?:[QA]|[A-Z][a-z]{1,12})\s?[.:]\s+(?=\S+\s+\S+\s+\S+)")
_PAIR = re.compile(r"^\s*[^\W\d_][\w ./-]{0,28}:\s*\S.{0,24}$")
_CODE = re.compile(r"\b[A-Za-z]?\d+(?:[-./:]\d+)*\b")
_END = re.compile(r"[.!?:;][\"')\]]*\s*$")
_VOWEL = re.compile(r"[aeiouyáéíóúàèìòùâêôäöüãõåæø]", re.I)
_HARD = re.compile(r"[bcdfghjklmnpqrstvwxz]{6,}|(.)\1{3,}", re.I)


#: Width of a field in the packed figures of a token; sums of a whole line must fit.
_BITS = 32
_SHIFTS = tuple(_BITS * i for i in range(8))
_FIELDS = struct.Struct("<8I").unpack


def unpacked(v: int) -> tuple[int, ...]:
    return _FIELDS(v.to_bytes(32, "little"))


class Tokens(dict):
    """Figures of a token: itself, characters, words, letters, digits of codes, common words, mixed, odd words.

    They are packed into one integer, so that a line's figures are one sum. Bounded: forgets
    everything when full.
    """

    LIMIT = 300_000

    def __init__(self, common: frozenset[str]):
        super().__init__()
        self.common = common

    def __missing__(self, t: str) -> int:
        words = _WORD.findall(t)
        digits = sum(c.isdigit() for c in t) if _CODE.search(t) else 0
        odd = sum(1 for w in words if len(w) > 2 and (not _VOWEL.search(w) or _HARD.search(w)))
        figures = (1, len(t), len(words), sum(map(len, words)), digits, sum(w.lower() in self.common for w in words), not _is_token(t), odd)
        v = sum(int(x) << s for x, s in zip(figures, _SHIFTS))
        if len(self) >= self.LIMIT:
            self.clear()
        if len(t) <= 40:
            self[t] = v
        return v


class Line:
    """A line's figures, the sums of its tokens', and the kind its own form shows ("" if open)."""

    __slots__ = ("text", "packed", "tokens", "chars", "words", "letters", "digits", "common", "mixed", "odd", "form")

    def __init__(self, text: str, memo: Tokens):
        s = self.text = text.strip()
        v = self.packed = sum(map(memo.__getitem__, s.split()))
        self.tokens, self.chars, self.words, self.letters, self.digits, self.common, self.mixed, self.odd = unpacked(v)
        self.form = self._form() if v else BLANK

    def _form(self) -> str:
        s, n = self.text, self.words
        bars = s.count("|")
        ruled = bars >= 2 and (s[0] == "|" or " | " in s) or s.count(",") >= 2 and " " not in s
        if ruled and self.odd * 2 <= n and (self.letters + self.digits) * 2 >= self.chars - bars:
            return TABLE
        if self.letters < 0.45 * self.chars and self.digits < 0.25 * self.chars and "..." not in s:
            return JUNK
        if self.mixed * 2 > self.tokens:
            return JUNK
        if n and self.common == 0 and self.odd * 2 > n:
            return JUNK
        if ("..." in s or ". ." in s or "__" in s or "---" in s) and _LEADER.search(s):
            return TABLE
        if "\t" in s and self.common * 3 < n + 1 or "  " in s and self.common * 4 <= n and len(_GAP.findall(s)) >= 2:
            return TABLE
        if s[1:3].strip() in (".", ":") or ":" in s[:14]:
            if self.common * 6 >= n and _SPEAKER.match(s):
                return PROSE
        if n <= 12 and not s[0].islower() and _ITEM.match(s):
            return LIST
        if ":" in s and self.common * 4 <= n and _PAIR.match(s):
            return TABLE
        if self.digits * 2 >= self.chars or n == 0:
            return TABLE
        return ""


def _is_token(t: str) -> bool:
    core = t.strip("\"'“”‘’.,;:!?()[]{}*«»¿¡-–—'")
    if not core or core.isalpha() or core.isdigit():
        return len(core) > 0 or len(t) <= 3
    return bool(re.fullmatch(r"[^\W\d_]+(?:['’.-][^\W\d_]+)*(?:'s)?[-¬]?|[A-Za-z]?\d+(?:[-.,:/]\d+)*[A-Za-z%°]{0,2}|[A-Za-z\d]*[^\W_]+", core))


def kinds(text: str, memo: Tokens, ready: bool = False) -> list[tuple[str, Line]]:
    """(kind, figures) of every line of a text, in order; `ready` if it consists of prototypes already."""
    lines = [Line(s, memo) for s in (text if ready else prototype(text)).split("\n")]
    out = [ln.form for ln in lines]
    i = 0
    while i < len(lines):
        if out[i]:
            i += 1
            continue
        j = i
        while j < len(lines) and not out[j]:
            j += 1
        _judge(lines, out, i, j)
        i = j
    # A short open line behind prose belongs to it; a lone table-like line inside prose as well.
    for k in range(1, len(lines)):
        ln = lines[k]
        if out[k] in (LIST, TABLE) and out[k - 1] == PROSE and ln.words and not _END.search(lines[k - 1].text) and "|" not in ln.text and "\t" not in ln.text and not _LEADER.search(ln.text):
            nxt = out[k + 1] if k + 1 < len(lines) else BLANK
            if nxt in (PROSE, BLANK) and (ln.common or _END.search(ln.text)):
                out[k] = PROSE
    return list(zip(out, lines))


def _judge(lines: list[Line], out: list[str], i: int, j: int) -> None:
    """Kinds of a stretch of undecided lines: prose if it runs on and holds common words."""
    part = lines[i:j]
    total = sum([x.packed for x in part])
    tokens, _, words, _, _, common, mixed, odd = unpacked(total)
    if mixed * 4 > tokens:
        kind = JUNK
    elif common * 8 >= words and words >= 4:
        kind = PROSE
    elif words and common * 20 < words and odd * 4 > words:
        kind = JUNK
    else:
        # Few common words: prose only if the lines are long or run on from one to the next.
        runs = sum(1 for a, b in zip(part, part[1:]) if b.text[:1].islower() and not _END.search(a.text))
        long = words >= 6 * len(part)
        kind = PROSE if (long or len(part) > 1 and runs * 2 >= len(part)) and common * 16 >= words else LIST
    for k in range(i, j):
        out[k] = kind
    if kind == PROSE and j - i >= 4:
        # Within a stretch, runs of short lines without common words are entries, not sentences.
        k = i
        while k < j:
            m = k
            while m < j and lines[m].common == 0 and lines[m].words <= 5:
                m += 1
            if m - k >= 4:
                for x in range(k, m):
                    out[x] = LIST
            k = max(m, k + 1)
