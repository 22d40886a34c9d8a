"""Text statistics per document and the verdict whether it is natural prose (problem 1).

Method: counts of words, lines and signs, repetition (shares of duplicate lines and paragraphs,
share of characters covered by the most frequent word n-gram), and the kinds of lines (see
line_kinds) are combined into a verdict: a text is no prose if more than half of its characters,
leaving aside lines printed at its head and foot (EDGE_LINES at either end), stand in lists, tables
or unreadable matter; and prose is boilerplate if more than REPEATED of its characters only say what
was said before, be it in duplicate lines, in duplicate paragraphs or in one n-gram over and over.

Defined results: null, empty and blank texts have the verdict "empty" and null shares; texts in
capitals or as question and answer are prose; a text of furniture only is judged with it.
Statistics are per row, so repeated rows, ties and extra columns make no difference.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm import line_kinds as L

#: How many lines at either end may be furniture.
EDGE_LINES = 3
NGRAMS = (2, 3, 4)
#: Share of a text in repeated lines, paragraphs or one n-gram above which it is boilerplate.
REPEATED = 0.8
BOILERPLATE = "boilerplate"
MAX_COMMON = 100_000

FIELDS = (
    ("n_chars", pa.int64()), ("n_words", pa.int64()), ("n_lines", pa.int64()), ("mean_word_length", pa.float64()), ("symbol_ratio", pa.float64()),
    ("terminal_line_share", pa.float64()), ("common_word_share", pa.float64()), ("duplicate_line_share", pa.float64()), ("duplicate_paragraph_share", pa.float64()),
    ("top_ngram_share", pa.float64()), ("prose_share", pa.float64()), ("list_share", pa.float64()), ("table_share", pa.float64()), ("junk_share", pa.float64()), ("verdict", pa.string()),
)
DDL = ", ".join(f"{n} {'bigint' if t == pa.int64() else 'double' if t == pa.float64() else 'string'}" for n, t in FIELDS)


def edges(rows: list[tuple[str, L.Line]]) -> set[int]:
    """Indices of the lines at head and foot that stand apart from the text between them."""
    full = [i for i, (k, _) in enumerate(rows) if k != L.BLANK]
    out: set[int] = set()
    if len(full) < 3:
        return out
    for a, b in zip(full[:EDGE_LINES], full[1:]):
        line, nxt = rows[a][1], rows[b][1]
        if L._END.search(line.text) and line.letters > line.digits or nxt.text[:1].islower() or rows[a][0] == rows[b][0] != L.PROSE:
            break
        out.add(a)
    back = full[::-1]
    for a, b in zip(back[:EDGE_LINES], back[1:]):
        line, before = rows[a][1], rows[b][1]
        open_before = rows[b][0] == L.PROSE and not L._END.search(before.text) and b == a - 1
        if line.text[:1].islower() or open_before or L._END.search(line.text) and line.common * 4 > line.words and rows[b][0] == L.PROSE or rows[a][0] == rows[b][0] != L.PROSE and line.words:
            break
        out.add(a)
    return out


def _duplicates(parts: list[str]) -> float:
    """Share of characters in parts that occurred before."""
    total = sum(map(len, parts))
    return 1 - sum(map(len, set(parts))) / total if total else 0.0


def statistics(text: str | None, memo: L.Tokens) -> tuple:
    if text is None or not text.strip():
        return (len(text or ""), 0, 0, *[None] * 11, "empty")
    rows = L.kinds(text, memo)
    lines = [x for k, x in rows if k != L.BLANK]
    chars = sum(x.chars for x in lines)
    if not chars:
        return (len(text), 0, 0, *[None] * 11, "empty")
    words, letters = sum(x.words for x in lines), sum(x.letters for x in lines)
    digits = sum(x.digits for x in lines)
    aside = edges(rows)
    share = Counter()
    for i, (k, x) in enumerate(rows):
        if i not in aside:
            share[k] += x.chars
    kept = sum(share.values())
    if not kept:
        for k, x in rows:
            share[k] += x.chars
        kept = chars
    tokens = text.lower().split()
    covered = 0.0
    for n in NGRAMS:
        if len(tokens) >= 2 * n:
            gram, count = Counter(zip(*(tokens[i:] for i in range(n)))).most_common(1)[0]
            if count > 1:
                covered = max(covered, min(1.0, count * sum(map(len, gram)) / chars))
    paragraphs = [" ".join(p.split()) for p in text.replace("\r\n", "\n").split("\n\n")]
    paragraphs = [p for p in paragraphs if p]
    prose = share[L.PROSE] / kept
    again = (_duplicates([x.text for x in lines]), _duplicates(paragraphs), covered)
    if prose * 2 >= 1:
        verdict = BOILERPLATE if max(again) > REPEATED else L.PROSE
    else:
        verdict = max((L.LIST, L.TABLE, L.JUNK), key=lambda k: share[k])
    return (
        len(text), words, len(lines), letters / words if words else 0.0, (chars - letters - digits) / chars,
        sum(1 for x in lines if L._END.search(x.text)) / len(lines), sum(x.common for x in lines) / words if words else 0.0,
        *again,
        prose, share[L.LIST] / kept, share[L.TABLE] / kept, share[L.JUNK] / kept, verdict,
    )


def common_words(table: DataFrame, word: str = "word") -> frozenset[str]:
    """The frequent words of a small list, whose size is checked."""
    rows = table.select(word).where(F.col(word).isNotNull()).distinct().limit(MAX_COMMON + 1).collect()
    if len(rows) > MAX_COMMON:
        raise ValueError("the list of common words is too long for a broadcast")
    return frozenset(r[0].lower() for r in rows)


def text_statistics(df: DataFrame, keys: list[str], text: str, common: frozenset[str]) -> DataFrame:
    """`keys` and the statistics of every row's text; one narrow pass."""
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = L.Tokens(common)
        for b in batches:
            cols = list(zip(*(statistics(t, memo) for t in b.column(n).to_pylist()))) or [()] * len(FIELDS)
            arrays = [b.column(i) for i in range(n)] + [pa.array(c, type=t) for c, (_, t) in zip(cols, FIELDS)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f"k{i}" for i in range(n)] + [f for f, _ in FIELDS])

    kinds = ", ".join(f"k{i} {df.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    out = df.select(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.col(text).alias("t")).mapInArrow(run, f"{kinds}, {DDL}")
    return out.select(*(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)), *(f for f, _ in FIELDS))
