"""Text functions as column expressions; everything runs in the JVM but the NFKC step.

White space, letters and digits are meant in the Unicode sense. Nulls give nulls unless stated.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes in Java syntax.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
NOT_SPACE = SPACE.replace("[", "[^", 1)
WORD = r"\p{L}\p{N}_"
BEFORE = rf"(?<![{WORD}])"
AFTER = rf"(?![{WORD}])"

# Patterns and limits of the line rules.
BOILERPLATE_LIMIT = 110
PAGE_NUMBER = r"^\d{1,4}$"
PAGE_MARK = rf"(?i){BEFORE}(page|p\.){SPACE}*\d+{AFTER}"
REPORT_WORD = rf"(?i){BEFORE}(contract|report|task|section|serial|document|distribution){AFTER}"
MARKING = rf"(?i){BEFORE}(secret|confidential|unclassified|for official use only|released under){AFTER}"
SERIAL = rf"(?i){BEFORE}\d{{2,4}}[-/][A-Z0-9][A-Z0-9\-/]{{2,}}{AFTER}"
RULE_LINE = r"^[-_=~*.,;: /\[\](){}<>|\\]+$"
ONE_CHARACTER = r"^(.)\1{5,}$"
SHORT_LETTERS = r"^[A-Za-z]{1,2}$"
SHORT_DIGITS = r"^\d{1,2}$"
SHORT_CODE = r"^[A-Za-z0-9][A-Za-z0-9.,:-]{0,4}$"
CODE_LINE = r"^[A-Z0-9/.,:;#\-() \[\]]{1,32}$"
HEADING_START = r"^(SECRET|CONFIDENTIAL|UNCLASSIFIED)"
HEADING_WORDS = r"(?i)^(Form Approved|REPORT DOCUMENTATION PAGE|Abstract|NOTE:|SUBJECT:)"
STRUCTURE_MARK = rf"(?i)^([A-Z]\.|[0-9]+\.|[-*•]|\([a-z0-9]+\)){SPACE}+"
STRUCTURE_WORD = rf"(?i)^(From|To|Subject|Date|Dear|Sincerely|At \d{{3,4}} hours){AFTER}"
SENTENCE_STOP = r"[.?!:;\"\])]$"
ALPHA_WORD = r"[A-Za-z][A-Za-z']{2,}"
VOWEL = r"[aeiouyAEIOUY]"
BLOCK_END = r"[.!?;:]$"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"{SPACE}+", " "))


def clean(c: Column) -> Column:
    """Collapsed text without byte order marks; null gives ''."""
    return collapse(F.replace(F.coalesce(c, F.lit("")), F.lit("﻿"), F.lit(" ")))


def slug(c: Column, limit: int, fallback: Column) -> Column:
    """Lower-case ASCII letters and digits joined by hyphens, cut to `limit`; `fallback` if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(F.left(s, F.lit(limit)), F.lit("")), fallback)


def node_id(prefix: str | Column, c: Column) -> Column:
    """prefix:slug of a value; blank and N/A values are unknown."""
    v = collapse(F.coalesce(c, F.lit("")))
    v = F.when((v == "") | (F.upper(v) == "N/A"), F.lit("unknown")).otherwise(v)
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(p, F.lit(":"), slug(v, 140, F.lit("unknown")))


def safe_filename(c: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9_.-]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("untitled"))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}_.-]", "_")


@lru_cache(maxsize=1)
def _nfkc():
    """The Arrow function; made on first use, as it needs a session."""

    @F.pandas_udf("string")
    def compatible(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return compatible


def nfkc(c: Column) -> Column:
    """Compatibility form. Only the values that hold a character beyond ASCII have work done for them."""
    plain = F.regexp_count(c, F.lit(r"[^\x00-\x7f]")) == 0
    return F.when(plain, c).otherwise(_nfkc()(F.when(plain, F.lit("")).otherwise(c)))


def tidy(c: Column) -> Column:
    """The steps behind NFKC: line ends, control characters, soft hyphens, quotes, blanks and tabs."""
    c = F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    c = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")
    c = F.translate(c, "“”‘’­", "\"\"''")
    return F.regexp_replace(c, r"[ \t]+", " ")


def normalize(c: Column) -> Column:
    return tidy(nfkc(c))


def with_normalized(df: DataFrame, text: str, name: str) -> DataFrame:
    """`df` with the normalized text as column `name`; only rows that hold a character beyond ASCII go through Python.

    Both halves read `df`, which should be a stored table. Null texts stay null.
    """
    plain = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x00-\x7f]")) == 0, F.lit(True))
    a = df.where(plain).withColumn(name, tidy(F.col(text)))
    b = df.where(~plain).withColumn(name, tidy(_nfkc()(F.col(text))))
    return a.unionByName(b)


def canonical(c: Column) -> Column:
    """Comparison key of a line of normalized text."""
    return F.regexp_replace(F.lower(strip(c)), rf"{SPACE}+", " ")


def is_upper(c: Column) -> Column:
    """Has capital letters and neither small nor title-case ones."""
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"[\p{Ll}\p{Lt}]")


def n_words(c: Column) -> Column:
    # Printable ASCII first: a plain range is far cheaper than the class of all that is no space.
    return F.regexp_count(c, F.lit(rf"(?:[!-~]++|{NOT_SPACE})++"))


def n_alnum(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


# The predicates take stripped lines.


def is_boilerplate(s: Column) -> Column:
    """Looks like a page number, page mark, report word, marking, serial number or short heading in capitals."""
    hit = s.rlike(PAGE_NUMBER) | s.rlike(PAGE_MARK) | s.rlike(REPORT_WORD) | s.rlike(MARKING) | s.rlike(SERIAL)
    return (s != "") & (F.length(s) <= BOILERPLATE_LIMIT) & (hit | (is_upper(s) & (n_words(s) <= 8)))


def is_artifact(s: Column) -> Column:
    """A single character, signs only, hardly any letters, a ruled line or one character over and over."""
    n, a = F.length(s), n_alnum(s)
    return (n > 0) & ((n <= 1) | ((a == 0) & (n >= 3)) | ((n >= 6) & (a / n < F.lit(0.18))) | s.rlike(RULE_LINE) | s.rlike(ONE_CHARACTER))


def is_low_value(s: Column) -> Column:
    """At most five characters: one or two letters or digits, or a code without small letters."""
    return (F.length(s) <= 5) & (s.rlike(SHORT_LETTERS) | s.rlike(SHORT_DIGITS) | (s.rlike(SHORT_CODE) & ~s.rlike(r"\p{Ll}")))


def is_table_or_code(s: Column) -> Column:
    n, a = F.length(s), n_alnum(s)
    return (n > 0) & ((n <= 3) | ((a > 0) & (n / F.greatest(a, F.lit(1)) > F.lit(2.8))) | (s.rlike(CODE_LINE) & (n_words(s) <= 5)))


def is_heading(s: Column) -> Column:
    capitals = (F.length(s) <= 72) & is_upper(s) & (n_words(s) <= 10)
    return (s != "") & (s.rlike(HEADING_START) | capitals | s.rlike(HEADING_WORDS))


def is_structural(s: Column) -> Column:
    return s.rlike(STRUCTURE_MARK) | s.rlike(STRUCTURE_WORD)


def joins(before: Column, after: Column) -> Column:
    """Whether a line continues the paragraph so far; the rules are tried in order."""
    n, m = F.length(before), F.length(after)
    return (
        F.when((before == "") | (after == ""), False)
        .when(is_heading(before) | is_heading(after), False)
        .when(is_table_or_code(before) | is_table_or_code(after), False)
        .when(is_structural(after), False)
        .when(before.rlike(SENTENCE_STOP), False)
        .when((n < 18) & (m < 32), False)
        .when(F.left(after, F.lit(1)).rlike(r"\p{Ll}"), True)
        .otherwise((n > 45) & (m > 20))
    )


def boilerplate_threshold(pages: Column) -> Column:
    """On how many of a document's pages a line must stand to be repeated."""
    return F.when(pages < 16, F.lit(3)).otherwise(F.greatest(F.lit(4), F.floor(pages * F.lit(0.18)).cast("int"))).cast("bigint")


STATS = ("token_count", "alpha_word_count", "natural_language_score", "sentence_like_blocks", "line_count")


def with_stats(df: DataFrame, text: str) -> DataFrame:
    """`df` with the five statistics of a text; words and tokens are looked for once."""
    c = F.col(text)
    words = F.regexp_extract_all(c, F.lit(f"({ALPHA_WORD})"), F.lit(1))
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), F.size(F.filter(w, lambda x: x.rlike(VOWEL))).cast("bigint").alias("v")))[0]
    blocks = F.filter(F.split(c, r"\n{2,}"), lambda b: (F.regexp_count(b, F.lit(ALPHA_WORD)) >= 8) & strip(b).rlike(BLOCK_END))
    lines = F.filter(F.split(c, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]", -1), lambda x: strip(x) != "")
    facts = F.struct(n_words(c).cast("bigint").alias("t"), counts.alias("w"), F.size(blocks).cast("bigint").alias("b"), F.size(lines).cast("bigint").alias("l"))
    # One element's transform keeps the facts from being worked out again for each statistic.
    facts = F.transform(F.array(facts), lambda x: x)[0]
    per = F.greatest(F.col("_facts.t"), F.lit(1).cast("bigint"))
    score = F.floor((F.col("_facts.w.v") * 2000 + per) / (per * 2)) / F.lit(1000.0)
    cells = (F.col("_facts.t"), F.col("_facts.w.n"), score, F.col("_facts.b"), F.col("_facts.l"))
    out = df.withColumn("_facts", facts)
    return out.select(*df.columns, *(x.alias(n) for x, n in zip(cells, STATS)))


def clamp(c: Column, limit: int) -> Column:
    """Collapsed text, cut with an ellipsis when longer than `limit`."""
    v = collapse(F.coalesce(c, F.lit("")))
    return F.when(F.length(v) <= limit, v).otherwise(F.concat(F.rtrim(F.left(v, F.lit(limit - 1))), F.lit("...")))


def spaced_label(c: Column) -> Column:
    """Every bar of a label as a slash between blanks."""
    return F.replace(c, F.lit("|"), F.lit(" / "))


def spaced_label_once(c: Column) -> Column:
    """Only the first bar as a slash between blanks."""
    return F.regexp_replace(c, r"^([^|]*)\|", "$1 / ")


# What the viewer calls the relations.
RELATION_LABELS = {
    "contains_record": "contains record",
    "from_agency": "from agency",
    "supported_by": "supported by",
    "incident_date": "incident date",
    "incident_location": "incident location",
    "video_pairing": "video pairing",
    "pdf_pairing": "PDF pairing",
}


def relation_label(c: Column) -> Column:
    """The viewer's name of a relation; others have their underscores as blanks."""
    out = F.replace(c, F.lit("_"), F.lit(" "))
    for name, label in RELATION_LABELS.items():
        out = F.when(c == name, F.lit(label)).otherwise(out)
    return out


def number(c: Column) -> Column:
    """A whole number with commas between thousands; null as 0."""
    return F.format_number(F.coalesce(c, F.lit(0)), 0)


def page_section(page: Column, source: Column, text: Column) -> Column:
    """A page of a readable document below its heading."""
    return F.concat(F.format_string("\n## Page %d (%s)\n\n", page, source), text, F.lit("\n"))


def document_header() -> Column:
    """Markdown header of a record from its columns; blank fields as N/A, a blank title as the id."""
    given = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("N/A"))
    fields = (("Agency", "agency"), ("Release date", "release_date"), ("Incident date", "incident_date"), ("Incident location", "incident_location"), ("Source URL", "source_url"))
    parts = [F.lit("# "), F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("id")), F.lit("\n\n- Record ID: `"), F.col("id"), F.lit("`")]
    for label, c in fields:
        parts += [F.lit(f"\n- {label}: "), given(c)]
    more = F.when(F.coalesce("description", F.lit("")) != "", F.concat(F.lit("\n\n## Official Description\n\n"), F.col("description"))).otherwise(F.lit(""))
    return F.concat(strip(F.concat(*parts, more)), F.lit("\n"))


def humanized(c: Column) -> Column:
    """A type or relation name as words with a capital."""
    words = F.replace(c, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.left(words, F.lit(1))), F.substring(words, 2, 2147483647))
