"""Queries over texts: cleaning, statistics, quality, chunks, merging, recognition plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions import text as T
from corpusgraph.operators import chunks as C
from corpusgraph.operators import curate as K
from corpusgraph.operators import lines as L
from corpusgraph.operators import merge as M
from corpusgraph.operators import ocrplan as O
from corpusgraph.operators import quality as Q
from corpusgraph.session import read_table, shared_folder, spread, stored
from corpusgraph.streaming.resume import not_done

# DuckDB's regular expressions know no Unicode white space, so it is spelled out.
WS = r"\s\x{1c}-\x{1f}\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"


def sql_strip(e: str) -> str:
    return f"regexp_replace(regexp_replace({e}, '^[{WS}]+', ''), '[{WS}]+$', '')"


def sql_words(e: str) -> str:
    return f"len(regexp_extract_all({e}, '[^{WS}]+'))"


def sql_alnum(e: str) -> str:
    return f"length(regexp_replace({e}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"


def sql_upper(e: str) -> str:
    return f"(regexp_matches({e}, '\\p{{Lu}}') AND NOT regexp_matches({e}, '[\\p{{Ll}}\\p{{Lt}}]'))"


def sql_word(pattern: str) -> str:
    return f"(?i)(^|[^{WORD}])({pattern})($|[^{WORD}])"


# SQL of the line rules, over an expression for a stripped line.


def sql_boilerplate(e: str) -> str:
    return f"""({e} <> '' AND length({e}) <= 110 AND (regexp_matches({e}, '^[0-9]{{1,4}}$') OR regexp_matches({e}, '{sql_word(f"(page|p[.])[{WS}]*[0-9]+")}')
    OR regexp_matches({e}, '{sql_word("contract|report|task|section|serial|document|distribution")}')
    OR regexp_matches({e}, '{sql_word("secret|confidential|unclassified|for official use only|released under")}')
    OR regexp_matches({e}, '{sql_word("[0-9]{2,4}[-/][A-Z0-9][A-Z0-9/-]{2,}")}') OR ({sql_upper(e)} AND {sql_words(e)} <= 8)))"""


def sql_artifact(e: str) -> str:
    n, a = f"length({e})", sql_alnum(e)
    return f"""({n} > 0 AND ({n} <= 1 OR ({a} = 0 AND {n} >= 3) OR ({n} >= 6 AND {a}::DOUBLE / {n} < 0.18::DOUBLE) OR regexp_matches({e}, '^[-_=~*.,;: /\\[\\](){{}}<>|\\\\]+$') OR ({n} >= 6 AND replace({e}, {e}[1], '') = '')))"""


def sql_low_value(e: str) -> str:
    return f"(length({e}) <= 5 AND (regexp_matches({e}, '^[A-Za-z]{{1,2}}$') OR regexp_matches({e}, '^[0-9]{{1,2}}$') OR (regexp_matches({e}, '^[A-Za-z0-9][A-Za-z0-9.,:-]{{0,4}}$') AND NOT regexp_matches({e}, '[a-z]'))))"


def sql_table(e: str) -> str:
    n, a = f"length({e})", sql_alnum(e)
    return f"({n} > 0 AND ({n} <= 3 OR ({a} > 0 AND {n}::DOUBLE / greatest({a}, 1) > 2.8::DOUBLE) OR (regexp_matches({e}, '^[A-Z0-9/.,:;#() \\[\\]-]{{1,32}}$') AND {sql_words(e)} <= 5)))"


def sql_heading(e: str) -> str:
    return f"({e} <> '' AND (regexp_matches({e}, '^(SECRET|CONFIDENTIAL|UNCLASSIFIED)') OR (length({e}) <= 72 AND {sql_upper(e)} AND {sql_words(e)} <= 10) OR regexp_matches({e}, '(?i)^(Form Approved|REPORT DOCUMENTATION PAGE|Abstract|NOTE:|SUBJECT:)')))"


def sql_structural(e: str) -> str:
    return f"(regexp_matches({e}, '(?i)^([A-Z][.]|[0-9]+[.]|[-*•]|[(][a-z0-9]+[)])[{WS}]+') OR regexp_matches({e}, '(?i)^(From|To|Subject|Date|Dear|Sincerely|At [0-9]{{3,4}} hours)($|[^{WORD}])'))"


def sql_joins(x: str, y: str) -> str:
    return f"""(CASE WHEN {x} = '' OR {y} = '' THEN false WHEN {sql_heading(x)} OR {sql_heading(y)} THEN false WHEN {sql_table(x)} OR {sql_table(y)} THEN false
    WHEN {sql_structural(y)} THEN false WHEN regexp_matches({x}, '[.?!:;"\\])]$') THEN false WHEN length({x}) < 18 AND length({y}) < 32 THEN false
    WHEN regexp_matches({y}, '^\\p{{Ll}}') THEN true ELSE length({x}) > 45 AND length({y}) > 20 END)"""


def sql_canonical(e: str) -> str:
    return f"regexp_replace(lower({sql_strip(e)}), '[{WS}]+', ' ', 'g')"


def page_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every page of final_pages once."""
    return read_table(spark, d, "final_pages").where("record_id is not null and page is not null").dropDuplicates(["record_id", "page"])


def pages(spark: SparkSession, d: str, compatible: bool = True) -> DataFrame:
    """Every page of final_pages once, with normalized text, as a stored table; `compatible` is the NFKC step, which SQL lacks."""
    df = page_rows(spark, d).withColumn("raw", F.coalesce("final_text", F.lit(""))).drop("final_text")
    out = T.with_normalized(stored(df), "raw", "text") if compatible else df.withColumn("text", T.tidy(F.col("raw")))
    return stored(spread(out.drop("raw")))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(read_table(spark, d, "documents").select("doc_id", "source", "text", "n_chars", "pages"))


# --- chunks -----------------------------------------------------------------------------------


def q_chunk_pack(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of every document: number, length, digest."""
    df = C.chunked(documents(spark, d).select("doc_id", "text"), "text")
    return df.select("doc_id", "chunk_no", F.length("chunk").cast("bigint").alias("chunk_chars"), F.md5("chunk").alias("chunk_md5"))


def sql_chunks(columns: str, text: str, source: str) -> str:
    """Tables base, packed and chunked of the texts of a table; `columns` are kept."""
    both = "CASE WHEN a.open = '' THEN x.open ELSE a.open || chr(10) || chr(10) || x.open END"
    done = "CASE WHEN a.open = '' THEN a.done ELSE list_append(a.done, a.open) END"
    return f"""
base AS (SELECT {columns}, {sql_strip(text)} AS t FROM {source} WHERE {text} IS NOT NULL),
packed AS (
  SELECT {columns}, list_reduce(
    list_prepend({{'done': []::VARCHAR[], 'open': ''}}, list_transform(string_split(t, chr(10) || chr(10)), lambda p: {{'done': []::VARCHAR[], 'open': p}})),
    lambda a, x: CASE WHEN length({both}) <= 1800 THEN {{'done': a.done, 'open': {both}}}
      WHEN length(x.open) <= 1800 THEN {{'done': {done}, 'open': x.open}}
      ELSE {{'done': list_concat({done}, list_transform(range(1, length(x.open) + 1, 1620), lambda i: x.open[i:i + 1799])), 'open': ''}} END) AS s
  FROM base WHERE t <> ''),
chunked AS (
  SELECT {columns}, unnest(c) AS chunk, generate_subscripts(c, 1) AS chunk_no
  FROM (SELECT {columns}, CASE WHEN s.open = '' THEN s.done ELSE list_append(s.done, s.open) END AS c FROM packed))
"""


SQL_CHUNKS = sql_chunks("doc_id, source", "text", "documents")

SQL_CHUNK_PACK = f"WITH {SQL_CHUNKS} SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, length(chunk) AS chunk_chars, md5(chunk) AS chunk_md5 FROM chunked"


def q_chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    """The id of every chunk."""
    df = C.chunked(documents(spark, d).select("doc_id", "text"), "text")
    return df.select(F.format_string("%d:p%04d:c%03d", "doc_id", F.lit(1), "chunk_no").alias("chunk_id"))


SQL_CHUNK_IDS = f"WITH {SQL_CHUNKS} SELECT printf('%d:p%04d:c%03d', doc_id, 1, chunk_no) AS chunk_id FROM chunked"


_stats = T.with_stats


def sql_stats(e: str) -> str:
    words = f"regexp_extract_all({e}, '[A-Za-z][A-Za-z'']{{2,}}')"
    vowels = f"len(list_filter({words}, lambda w: regexp_matches(w, '[aeiouyAEIOUY]')))"
    tokens = sql_words(e)
    blocks = f"len(list_filter(regexp_split_to_array({e}, '\\n{{2,}}'), lambda b: len(regexp_extract_all(b, '[A-Za-z][A-Za-z'']{{2,}}')) >= 8 AND regexp_matches({sql_strip('b')}, '[.!?;:]$')))"
    lines = f"len(list_filter(regexp_split_to_array({e}, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda x: {sql_strip('x')} <> ''))"
    return f"""CAST({tokens} AS BIGINT) AS token_count, CAST(len({words}) AS BIGINT) AS alpha_word_count,
    floor((2000 * {vowels} + greatest({tokens}, 1))::DOUBLE / (2 * greatest({tokens}, 1))) / 1000.0::DOUBLE AS natural_language_score,
    CAST({blocks} AS BIGINT) AS sentence_like_blocks, CAST({lines} AS BIGINT) AS line_count"""


STATS = ", ".join(T.STATS)


def q_chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    """Text statistics of every chunk."""
    return _stats(C.chunked(documents(spark, d).select("doc_id", "text"), "text"), "chunk").drop("chunk")


SQL_CHUNK_STATS = f"WITH {SQL_CHUNKS} SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, {sql_stats('chunk')} FROM chunked"


def q_chunk_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Chunks, characters and tokens by source."""
    df = C.chunked(documents(spark, d).select("doc_id", "source", "text"), "text")
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.length("chunk")).alias("chunk_chars"), F.sum(T.n_words(F.col("chunk"))).alias("tokens"))


SQL_CHUNK_ROLLUP = f"""WITH {SQL_CHUNKS} SELECT source, count(*) AS chunks, CAST(sum(length(chunk)) AS BIGINT) AS chunk_chars, CAST(sum({sql_words('chunk')}) AS BIGINT) AS tokens FROM chunked GROUP BY source"""


def q_oversize_split(spark: SparkSession, d: str) -> DataFrame:
    """The slices of every document that is longer than a chunk, its text taken as one paragraph."""
    df = documents(spark, d).where(F.length("text") > C.MAX_CHARS).select("doc_id", F.posexplode(C.windows(F.col("text"))).alias("i", "slice"))
    return df.select("doc_id", (F.col("i") + 1).cast("bigint").alias("slice_no"), F.length("slice").cast("bigint").alias("slice_chars"), F.md5("slice").alias("slice_md5"))


SQL_OVERSIZE = """SELECT doc_id, (start - 1) // 1620 + 1 AS slice_no, length(text[start:start + 1799]) AS slice_chars, md5(text[start:start + 1799]) AS slice_md5
FROM (SELECT doc_id, text, unnest(range(1, length(text) + 1, 1620)) AS start FROM documents WHERE length(text) > 1800)"""

# --- lines ------------------------------------------------------------------------------------


def _lines(spark: SparkSession, d: str) -> DataFrame:
    df = read_table(spark, d, "ocr_results").where("text is not null")
    return df.select(F.explode(F.split("text", "\n", -1)).alias("line")).select(T.strip(F.col("line")).alias("line"))


SQL_LINES = f"lines AS (SELECT {sql_strip('line')} AS line FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM ocr_results WHERE text IS NOT NULL))"


def q_line_flags(spark: SparkSession, d: str) -> DataFrame:
    """What the line rules say of every distinct recognised line."""
    s = F.col("line")
    flags = {"boilerplate": T.is_boilerplate(s), "artifact": T.is_artifact(s), "low_value": T.is_low_value(s), "table_or_code": T.is_table_or_code(s), "heading": T.is_heading(s), "structural": T.is_structural(s)}
    return _lines(spark, d).distinct().select(F.md5("line").alias("line_md5"), *(c.alias(n) for n, c in flags.items()))


SQL_LINE_FLAGS = f"""WITH {SQL_LINES}, u AS (SELECT DISTINCT line FROM lines)
SELECT md5(line) AS line_md5, {sql_boilerplate('line')} AS boilerplate, {sql_artifact('line')} AS artifact, {sql_low_value('line')} AS low_value, {sql_table('line')} AS table_or_code,
{sql_heading('line')} AS heading, {sql_structural('line')} AS structural FROM u"""


def q_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Normalized text of every page: length and digest (checked by test: SQL has no NFKC)."""
    return pages(spark, d).select("record_id", "page", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"))


def q_canonical_line(spark: SparkSession, d: str) -> DataFrame:
    """How often each canonical line of the pages stands."""
    df = pages(spark, d).select(F.explode(F.split("text", "\n", -1)).alias("line")).select(T.canonical(F.col("line")).alias("key"))
    return df.where("key <> ''").groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def q_tidy(spark: SparkSession, d: str) -> DataFrame:
    """Every page's text after the steps of normalization behind NFKC, as it is stored: length and digest."""
    return pages(spark, d, compatible=False).select("record_id", "page", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"))


def q_canonical_stored(spark: SparkSession, d: str) -> DataFrame:
    """How often each canonical line stands, by text as it is stored."""
    df = pages(spark, d, compatible=False).select(F.explode(F.split("text", "\n", -1)).alias("line")).select(T.canonical(F.col("line")).alias("key"))
    return df.where("key <> ''").groupBy(F.md5("key").alias("key_md5")).agg(F.count(F.lit(1)).alias("n"))


def q_repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    """Boilerplate lines repeated over the pages of a record, by text as it is stored."""
    return L.repeated_lines(pages(spark, d, compatible=False)).select("record_id", F.md5("key").alias("key_md5"), "n_pages")


SQL_TIDY = """regexp_replace(translate(regexp_replace(replace(replace({e}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', ' ', 'g'), '“”‘’­', '""'''''), '[ \\t]+', ' ', 'g')"""

SQL_PAGES = f"""p AS (SELECT DISTINCT record_id, page, title, source, final_text_chars, {SQL_TIDY.format(e="coalesce(final_text, '')")} AS text FROM final_pages WHERE record_id IS NOT NULL AND page IS NOT NULL)"""
SQL_KEYS = f"""{SQL_PAGES},
need AS (SELECT record_id, CASE WHEN count(*) < 16 THEN 3 ELSE greatest(4, CAST(floor(count(*) * 0.18::DOUBLE) AS BIGINT)) END AS need FROM p GROUP BY record_id),
bl AS (SELECT record_id, page, {sql_strip('line')} AS line FROM (SELECT record_id, page, unnest(regexp_split_to_array(text, '[\\n\\x{{85}}\\x{{2028}}\\x{{2029}}]')) AS line FROM p)),
bk AS (SELECT DISTINCT record_id, page, {sql_canonical('line')} AS key FROM bl WHERE {sql_boilerplate('line')}),
rep AS (SELECT record_id, key, count(*) AS n_pages FROM bk JOIN need USING (record_id) WHERE key <> '' GROUP BY record_id, key, need HAVING count(*) >= need)"""
SQL_REPEATED = f"WITH {SQL_KEYS} SELECT record_id, md5(key) AS key_md5, n_pages FROM rep"
SQL_CANONICAL = f"WITH {SQL_PAGES}, c AS (SELECT {sql_canonical('line')} AS key FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM p)) SELECT md5(key) AS key_md5, count(*) AS n FROM c WHERE key <> '' GROUP BY key"


def q_boilerplate_threshold(spark: SparkSession, d: str) -> DataFrame:
    """On how many of its pages a line of each record must stand to be repeated."""
    return page_rows(spark, d).groupBy("record_id").agg(F.count(F.lit(1)).alias("pages")).select("record_id", "pages", T.boilerplate_threshold(F.col("pages")).alias("need"))


SQL_THRESHOLD = """SELECT record_id, n AS pages, CASE WHEN n < 16 THEN 3 ELSE greatest(4, CAST(floor(n * 0.18::DOUBLE) AS BIGINT)) END AS need
FROM (SELECT record_id, count(DISTINCT page) AS n FROM final_pages WHERE record_id IS NOT NULL AND page IS NOT NULL GROUP BY record_id)"""


def curated(spark: SparkSession, d: str, compatible: bool = True) -> DataFrame:
    """Cleaned pages with statistics, quality and the default flag, as a stored table."""
    return stored(K.curated_pages(pages(spark, d, compatible)))


def q_clean_page(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned pages: length, digest (checked by test against a plain model)."""
    return L.cleaned(pages(spark, d)).select("record_id", "page", F.length("clean_text").cast("bigint").alias("clean_chars"), F.md5("clean_text").alias("clean_md5"))


def q_clean_stored(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned pages by text as it is stored: length, digest and what was done, by action."""
    df = L.cleaned(pages(spark, d, compatible=False))
    return df.select("record_id", "page", F.length("clean_text").cast("bigint").alias("clean_chars"), F.md5("clean_text").alias("clean_md5"), *L.ACTIONS)


_N = ("n1", "n2", "n3", "n4", "n5")


def _sql_state(kept: str, last: str, skip: str, plus: int = 0) -> str:
    counts = ", ".join(f"'{n}': a.{n} + {int(i == plus)}" for i, n in enumerate(_N, 1))
    return f"{{'kept': {kept}, 'last': {last}, 'skip': {skip}, {counts}, 'line': '', 'nxt': '', 'key': '', 'rule': 0}}"


_ROW = "{'kept': []::VARCHAR[], 'last': '', 'skip': false, " + ", ".join(f"'{n}': 0::BIGINT" for n in _N) + ", 'line': line, 'nxt': nxt, 'key': key, 'rule': rule}"
_FIRST = _ROW.replace("'line': line, 'nxt': nxt, 'key': key, 'rule': rule", "'line': '', 'nxt': '', 'key': '', 'rule': 0")
_JOINED = "(left(x.line, length(x.line) - 1) || x.nxt)"
_PAR = "{{'parts': {parts}, 'open': {open}, 'joined': {joined}, 'x': ''}}"
_CLOSED = "(CASE WHEN a.open = '' THEN a.parts ELSE list_append(a.parts, a.open) END)"
SQL_CLEAN = f"""{SQL_KEYS},
l1 AS (SELECT record_id, page, no, {sql_strip('raw')} AS line, {sql_canonical('raw')} AS key FROM (SELECT record_id, page, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM p)),
l2 AS (SELECT *, lead(line, 1, '') OVER (PARTITION BY record_id, page ORDER BY no) AS nxt FROM l1),
l3 AS (SELECT l2.*, CASE WHEN line = '' THEN 0 WHEN rep.key IS NOT NULL THEN 1 WHEN {sql_artifact('line')} THEN 2 WHEN {sql_low_value('line')} THEN 3 ELSE 9 END AS rule
  FROM l2 LEFT JOIN rep ON rep.record_id = l2.record_id AND rep.key = l2.key),
f AS (SELECT record_id, page, list_reduce(list_prepend({_FIRST}, list({_ROW} ORDER BY no)), lambda a, x: CASE
  WHEN a.skip THEN {_sql_state('a.kept', 'a.last', 'false')}
  WHEN x.rule = 0 THEN {_sql_state("list_append(a.kept, '')", "''", 'false')}
  WHEN x.rule = 1 THEN {_sql_state('a.kept', 'a.last', 'false', 1)}
  WHEN x.rule = 2 THEN {_sql_state('a.kept', 'a.last', 'false', 2)}
  WHEN x.rule = 3 THEN {_sql_state('a.kept', 'a.last', 'false', 3)}
  WHEN a.last <> '' AND a.last = x.key THEN {_sql_state('a.kept', 'a.last', 'false', 4)}
  WHEN x.line LIKE '%-' AND regexp_matches(x.nxt, '^\\p{{Ll}}') THEN {_sql_state(f'list_append(a.kept, {_JOINED})', sql_canonical(_JOINED), 'true', 5)}
  ELSE {_sql_state('list_append(a.kept, x.line)', 'x.key', 'false')} END) AS s FROM l3 GROUP BY record_id, page),
g AS (SELECT record_id, page, s, list_reduce(list_prepend({_PAR.format(parts="[]::VARCHAR[]", open="''", joined="0::BIGINT")}, list_transform(s.kept, lambda k: {{'parts': []::VARCHAR[], 'open': '', 'joined': 0::BIGINT, 'x': k}})), lambda a, x: CASE
  WHEN x.x = '' THEN {_PAR.format(parts=_CLOSED, open="''", joined="a.joined")}
  WHEN a.open = '' THEN {_PAR.format(parts="a.parts", open="x.x", joined="a.joined")}
  WHEN {sql_joins('a.open', 'x.x')} THEN {_PAR.format(parts="a.parts", open="a.open || ' ' || x.x", joined="a.joined + 1")}
  ELSE {_PAR.format(parts=_CLOSED, open="x.x", joined="a.joined")} END) AS q FROM f),
cleaned AS (SELECT record_id, page, {sql_strip("array_to_string(CASE WHEN q.open = '' THEN q.parts ELSE list_append(q.parts, q.open) END, chr(10) || chr(10))")} AS clean_text,
  s.n1 AS {L.ACTIONS[0]}, s.n2 AS {L.ACTIONS[1]}, s.n3 AS {L.ACTIONS[2]}, s.n4 AS {L.ACTIONS[3]}, s.n5 AS {L.ACTIONS[4]}, q.joined AS {L.ACTIONS[5]} FROM g)
"""
SQL_CLEAN_STORED = f"WITH {SQL_CLEAN} SELECT record_id, page, length(clean_text) AS clean_chars, md5(clean_text) AS clean_md5, {', '.join(L.ACTIONS)} FROM cleaned"


def q_cleaning_actions(spark: SparkSession, d: str) -> DataFrame:
    """What cleaning did to each page, by action."""
    return L.cleaned(pages(spark, d)).select("record_id", "page", *L.ACTIONS)


CURATED = ("record_id", "page", "source", "raw_text_chars", "clean_text_chars", "quality", "include_in_default_rag", *T.STATS, *L.ACTIONS, "readable_page_path", "verbatim_page_path")


def q_curated_pages(spark: SparkSession, d: str) -> DataFrame:
    """The table of curated pages."""
    return K.curated_pages(pages(spark, d)).select(*CURATED)


def q_curated_stored(spark: SparkSession, d: str) -> DataFrame:
    """The table of curated pages, by text as it is stored."""
    return K.curated_pages(pages(spark, d, compatible=False)).select(*CURATED)


def sql_quality(raw: str, text: str, removed: str) -> str:
    return f"""CASE WHEN {raw} = 0 OR length({text}) = 0 THEN 'empty'
  WHEN length({text}) < 320 AND sentence_like_blocks = 0 AND alpha_word_count < 28 THEN 'needs_review'
  WHEN natural_language_score < 0.18::DOUBLE AND sentence_like_blocks = 0 THEN 'needs_review'
  WHEN length({text})::DOUBLE / {raw} < 0.18::DOUBLE OR {removed} > 40 THEN 'needs_review'
  WHEN length({text})::DOUBLE / {raw} < 0.45::DOUBLE THEN 'aggressive_cleanup' ELSE 'clean' END"""


def sql_default(text: str) -> str:
    return f"""CASE WHEN quality IN ('empty', 'needs_review') OR length({text}) < 180 THEN false
  WHEN regexp_matches({text}, '{sql_word(Q.SUBJECT)}') THEN natural_language_score >= 0.28::DOUBLE AND alpha_word_count >= 12
  ELSE sentence_like_blocks >= 1 OR (natural_language_score >= 0.32::DOUBLE AND alpha_word_count >= 80) END"""


def sql_safe(e: str) -> str:
    return f"coalesce(nullif(regexp_replace(regexp_replace({e}, '[^A-Za-z0-9_.-]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'untitled')"


_REMOVED = "(" + " + ".join(L.ACTIONS[:4]) + ")"
SQL_CURATED = f"""{SQL_CLEAN},
c0 AS (SELECT cleaned.*, p.source, p.title, coalesce(p.final_text_chars, 0) AS raw_text_chars, {sql_stats('clean_text')} FROM cleaned JOIN p ON p.record_id = cleaned.record_id AND p.page = cleaned.page),
c1 AS (SELECT *, length(clean_text) AS clean_text_chars, {sql_quality('raw_text_chars', 'clean_text', _REMOVED)} AS quality FROM c0),
curated AS (SELECT *, {sql_default('clean_text')} AS include_in_default_rag, '{K.READABLE_PAGES}' || {sql_safe('record_id')} || printf('/page_%04d', page) || '.md' AS readable_page_path,
  '{K.VERBATIM_PAGES}' || {sql_safe('record_id')} || printf('/page_%04d', page) || '.txt' AS verbatim_page_path FROM c1)
"""
SQL_CURATED_STORED = f"WITH {SQL_CURATED} SELECT {', '.join(CURATED)} FROM curated"


def q_curated_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of curated pages; quality and flag are the page's."""
    return K.curated_chunks(curated(spark, d))


def q_chunks_stored(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of curated pages by text as it is stored, with digests for texts."""
    return K.curated_chunks(curated(spark, d, compatible=False)).withColumn("text", F.md5("text"))


SQL_CURATED_CHUNKS = SQL_CURATED + ", " + sql_chunks("record_id, page, title, source, quality, include_in_default_rag, readable_page_path, verbatim_page_path", "clean_text", "curated")
SQL_CHUNKS_STORED = f"""WITH {SQL_CURATED_CHUNKS}
SELECT record_id || printf(':p%04d:c%03d', page, chunk_no) AS chunk_id, record_id, title, page, source, quality, include_in_default_rag, readable_page_path, verbatim_page_path, md5(chunk) AS text, length(chunk) AS text_chars, {sql_stats('chunk')} FROM chunked"""


def curated_documents(spark: SparkSession, d: str, compatible: bool = True) -> DataFrame:
    """Documents of the curated layer, with the titles of both record tables."""
    titles = [read_table(spark, d, t).where("id is not null").select("id", "title") for t in ("pdf_records", "image_records")]
    return K.curated_documents(curated(spark, d, compatible), titles[0].unionByName(titles[1]).groupBy("id").agg(F.min("title").alias("title")))


def q_curated_documents(spark: SparkSession, d: str) -> DataFrame:
    """Curated documents by text as it is stored; the counts by quality as JSON."""
    return curated_documents(spark, d, compatible=False).withColumn("quality_counts", F.to_json("quality_counts"))


SQL_DOCUMENTS = f"""{SQL_CURATED},
qc AS (SELECT record_id, quality, count(*) AS n, sum(raw_text_chars) AS r, sum(clean_text_chars) AS c FROM curated GROUP BY record_id, quality),
ti AS (SELECT id, min(title) AS title FROM (SELECT id, title FROM pdf_records UNION ALL SELECT id, title FROM image_records) WHERE id IS NOT NULL GROUP BY id),
docs AS (SELECT qc.record_id, coalesce(nullif(any_value(ti.title), ''), qc.record_id) AS title, CAST(sum(n) AS BIGINT) AS pages, CAST(sum(r) AS BIGINT) AS raw_text_chars, CAST(sum(c) AS BIGINT) AS clean_text_chars,
  '{{' || string_agg('"' || quality || '":' || n, ',' ORDER BY quality) || '}}' AS quality_counts, '{K.READABLE_DOCUMENTS}' || {sql_safe('qc.record_id')} || '.md' AS readable_doc_path
  FROM qc LEFT JOIN ti ON ti.id = qc.record_id GROUP BY qc.record_id)
"""


def q_readable_sections(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the page sections of readable documents, by text as it is stored."""
    return K.readable_sections(curated(spark, d, compatible=False)).select("record_id", "page", F.md5("section").alias("section_md5"))


SQL_SECTIONS = f"""WITH {SQL_CURATED} SELECT record_id, page, md5(chr(10) || '## Page ' || page || ' (' || source || ')' || chr(10) || chr(10) || clean_text || chr(10)) AS section_md5 FROM curated WHERE clean_text <> ''"""


def q_curated_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of the curated layer, by text as it is stored."""
    c = curated(spark, d, compatible=False)
    return K.totals(c, K.curated_chunks(c))


SQL_TOTALS_CURATED = f"""WITH {SQL_CURATED_CHUNKS} SELECT count(DISTINCT record_id) AS documents, count(*) AS pages, CAST(sum(raw_text_chars) AS BIGINT) AS raw_text_chars, CAST(sum(clean_text_chars) AS BIGINT) AS clean_text_chars,
(SELECT count(*) FROM chunked) AS chunks, (SELECT count(*) FROM chunked WHERE include_in_default_rag) AS default_chunks, (SELECT count(*) FROM chunked WHERE NOT include_in_default_rag) AS excluded_chunks FROM curated"""


# --- statistics and quality -------------------------------------------------------------------


def q_text_stats(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of every document."""
    return _stats(documents(spark, d).where("text is not null").select("doc_id", "text"), "text").drop("text")


SQL_TEXT_STATS = f"SELECT doc_id, {sql_stats('text')} FROM documents WHERE text IS NOT NULL"


def _rated(spark: SparkSession, d: str) -> DataFrame:
    df = documents(spark, d).select("doc_id", "source", F.coalesce("n_chars", F.lit(0)).alias("raw"), T.strip(F.coalesce("text", F.lit(""))).alias("text"))
    df = _stats(df, "text")
    s = {n: F.col(n) for n in STATS.split(", ")}
    df = df.withColumn("quality", Q.quality(F.col("raw"), F.length("text"), F.lit(0), s))
    return df.withColumn("include_in_default_rag", Q.in_default(F.col("text"), F.col("quality"), s))


SQL_RATED = f"""
b AS (SELECT doc_id, source, coalesce(n_chars, 0) AS raw, {sql_strip("coalesce(text, '')")} AS text FROM documents),
st AS (SELECT *, {sql_stats('text')} FROM b),
r AS (SELECT *, {sql_quality('raw', 'text', '0')} AS quality FROM st),
rated AS (SELECT *, {sql_default('text')} AS include_in_default_rag FROM r)
"""


def q_quality(spark: SparkSession, d: str) -> DataFrame:
    return _rated(spark, d).select("doc_id", "quality")


def q_default_rag(spark: SparkSession, d: str) -> DataFrame:
    return _rated(spark, d).select("doc_id", "include_in_default_rag")


def q_rag_partition(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of default and excluded documents: the two sets part all chunks."""
    df = C.chunked(_rated(spark, d).select("include_in_default_rag", "text"), "text")
    return df.groupBy("include_in_default_rag").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.length("chunk")).alias("chunk_chars"))


SQL_RAG_PARTITION = f"""WITH {SQL_CHUNKS}, {SQL_RATED} SELECT include_in_default_rag, count(*) AS chunks, CAST(sum(length(chunk)) AS BIGINT) AS chunk_chars
FROM chunked JOIN rated USING (doc_id) GROUP BY include_in_default_rag"""


def q_quality_counts(spark: SparkSession, d: str) -> DataFrame:
    return _rated(spark, d).groupBy("source", "quality").agg(F.count(F.lit(1)).alias("n"))


def q_doc_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Pages and characters of each record of final_pages."""
    return M.document_totals(page_rows(spark, d))


SQL_DOC_ROLLUP = """SELECT record_id, count(*) AS pages, CAST(sum(embedded_text_chars) AS BIGINT) AS embedded_text_chars, CAST(sum(ocr_text_chars) AS BIGINT) AS ocr_text_chars,
CAST(sum(final_text_chars) AS BIGINT) AS final_text_chars FROM (SELECT DISTINCT record_id, page, embedded_text_chars, ocr_text_chars, final_text_chars FROM final_pages WHERE record_id IS NOT NULL AND page IS NOT NULL) GROUP BY record_id"""


def q_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of documents and characters."""
    return documents(spark, d).agg(F.count(F.lit(1)).alias("documents"), F.sum("pages").alias("pages"), F.sum("n_chars").alias("chars"), F.count_if(F.coalesce("n_chars", F.lit(0)) == 0).alias("without_text"), F.count_if(F.coalesce("n_chars", F.lit(0)) < 100).alias("below_100"))


SQL_TOTALS = """SELECT count(*) AS documents, CAST(sum(pages) AS BIGINT) AS pages, CAST(sum(n_chars) AS BIGINT) AS chars, count(*) FILTER (WHERE coalesce(n_chars, 0) = 0) AS without_text,
count(*) FILTER (WHERE coalesce(n_chars, 0) < 100) AS below_100 FROM documents"""

# --- merging and recognition ------------------------------------------------------------------


def _layers(spark: SparkSession, d: str) -> DataFrame:
    """Pages with their embedded layer, and the last good recognised text of each."""
    df = read_table(spark, d, "final_pages").where("record_id is not null and page is not null").dropDuplicates(["record_id", "page"])
    embedded = F.when(F.col("source").startswith("embedded"), F.substring_index("final_text", M.LAYER, 1))
    log = read_table(spark, d, "ocr_results").select("path", "status", "text", "result_id")
    last = M.last_ok(log, ["path"], ordinal="result_id").select("path", F.col("text").alias("ocr"))
    at = read_table(spark, d, "ocr_pages").select("record_id", "page", F.col("image_path").alias("path")).where("path is not null").distinct()
    return M.merged(df.select("record_id", "page", embedded.alias("embedded")), last.join(at, "path").select("record_id", "page", "ocr"))


SQL_LAYERS = f"""
pg AS (SELECT DISTINCT record_id, page, CASE WHEN source LIKE 'embedded%' THEN string_split(final_text, chr(10) || chr(10) || '[OCR]' || chr(10))[1] END AS e FROM final_pages WHERE record_id IS NOT NULL AND page IS NOT NULL),
lo AS (SELECT path, arg_max(coalesce(text, ''), result_id) AS o FROM ocr_results WHERE status = 'ok' GROUP BY path),
la AS (SELECT DISTINCT record_id, page, o FROM ocr_pages JOIN lo ON image_path = path),
m AS (SELECT pg.record_id, pg.page, {sql_strip("coalesce(e, '')")} AS e, {sql_strip("coalesce(o, '')")} AS o FROM pg LEFT JOIN la ON pg.record_id = la.record_id AND pg.page = la.page),
merged AS (SELECT record_id, page, CASE WHEN e <> '' AND o <> '' AND NOT contains(e, o) THEN 'embedded+ocr' WHEN e <> '' THEN 'embedded' WHEN o <> '' THEN 'ocr' ELSE 'empty' END AS source,
  length(e) AS embedded_text_chars, length(o) AS ocr_text_chars,
  CASE WHEN e <> '' AND o <> '' AND NOT contains(e, o) THEN e || chr(10) || chr(10) || '[OCR]' || chr(10) || o WHEN e <> '' THEN e ELSE o END AS final_text FROM m)
"""


def q_merge_layers(spark: SparkSession, d: str) -> DataFrame:
    """Source, lengths and digest of every merged page."""
    return _layers(spark, d).select("record_id", "page", "source", "embedded_text_chars", "ocr_text_chars", "final_text_chars", F.md5("final_text").alias("text_md5"))


SQL_MERGE_LAYERS = f"WITH {SQL_LAYERS} SELECT record_id, page, source, embedded_text_chars, ocr_text_chars, length(final_text) AS final_text_chars, md5(final_text) AS text_md5 FROM merged"


def q_merge_doc_text(spark: SparkSession, d: str) -> DataFrame:
    """The merged text of every record: length and digest."""
    df = M.document_texts(_layers(spark, d))
    return df.select("record_id", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"))


SQL_MERGE_DOC = f"""WITH {SQL_LAYERS}, t AS (SELECT record_id, {sql_strip("coalesce(string_agg(chr(10) || chr(10) || '--- Page ' || page || ' [' || source || '] ---' || chr(10) || final_text, '' ORDER BY page) FILTER (WHERE final_text <> ''), '')")} AS text
FROM merged GROUP BY record_id) SELECT record_id, length(text) AS chars, md5(text) AS text_md5 FROM t"""


def q_last_write_wins(spark: SparkSession, d: str) -> DataFrame:
    """The last good log entry of every page."""
    log = read_table(spark, d, "ocr_pages").where("record_id is not null and page is not null")
    return M.last_ok(log, ["record_id", "page"]).select("record_id", "page", "ordinal", "ocr_text_chars", "ocr_text_path")


SQL_LAST = """SELECT record_id, page, ordinal, ocr_text_chars, ocr_text_path FROM (SELECT *, row_number() OVER (PARTITION BY record_id, page ORDER BY ordinal DESC) AS r
FROM ocr_pages WHERE status = 'ok' AND record_id IS NOT NULL AND page IS NOT NULL) WHERE r = 1"""


def q_resume_anti(spark: SparkSession, d: str) -> DataFrame:
    """Pages of final_pages that no good log entry covers."""
    work = read_table(spark, d, "final_pages").where("record_id is not null and page is not null").select("record_id", "page").distinct()
    return not_done(work, read_table(spark, d, "ocr_pages"), ["record_id", "page"])


SQL_RESUME = """SELECT DISTINCT record_id, page FROM final_pages p WHERE record_id IS NOT NULL AND page IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM ocr_pages o WHERE o.record_id = p.record_id AND o.page = p.page AND o.status = 'ok')"""


def _images(spark: SparkSession, d: str) -> DataFrame:
    """Page images known from the log; the log has no sides, so both counts of characters stand for width and height."""
    log = read_table(spark, d, "ocr_pages").where("record_id is not null and page is not null and image_path is not null")
    return log.select("record_id", "page", "image_path", F.col("source_text_chars").alias("width"), F.col("ocr_text_chars").alias("height"), "ordinal")


def _best_images(spark: SparkSession, d: str) -> DataFrame:
    return O.best_image(_images(spark, d), ["record_id", "page"], "width", "height", ["ordinal"])


SQL_BEST_IMAGE = """best AS (SELECT record_id, page, image_path, ordinal, area FROM (SELECT *, coalesce(source_text_chars, 0) * coalesce(ocr_text_chars, 0) AS area,
row_number() OVER (PARTITION BY record_id, page ORDER BY coalesce(source_text_chars, 0) * coalesce(ocr_text_chars, 0) DESC, ordinal) AS r
FROM ocr_pages WHERE record_id IS NOT NULL AND page IS NOT NULL AND image_path IS NOT NULL) WHERE r = 1)"""


def q_best_image(spark: SparkSession, d: str) -> DataFrame:
    """The image of the largest area of each page, the first logged of equal ones."""
    return _best_images(spark, d).select("record_id", "page", "image_path", "ordinal", "area")


def q_ocr_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Pages with little embedded text that still wait for recognition, with their best image."""
    p = page_rows(spark, d).select("record_id", "page", F.col("embedded_text_chars").alias("text_chars"))
    images = _best_images(spark, d).select("record_id", "page", "image_path")
    return O.jobs(p, images, read_table(spark, d, "ocr_pages")).select("record_id", "page", F.coalesce("text_chars", F.lit(0)).alias("source_text_chars"), "image_path")


SQL_JOBS = f"""WITH {SQL_BEST_IMAGE} SELECT p.record_id, p.page, coalesce(p.c, 0) AS source_text_chars, i.image_path FROM (SELECT DISTINCT record_id, page, embedded_text_chars AS c FROM final_pages WHERE record_id IS NOT NULL AND page IS NOT NULL) p
JOIN best i ON i.record_id = p.record_id AND i.page = p.page
WHERE coalesce(p.c, 0) <= 20 AND NOT EXISTS (SELECT 1 FROM ocr_pages o WHERE o.record_id = p.record_id AND o.page = p.page AND o.status = 'ok')"""


def q_image_ordinals(spark: SparkSession, d: str) -> DataFrame:
    """The different images of each page, numbered from 1 in the order of their paths."""
    paths = _images(spark, d).groupBy("record_id", "page").agg(F.array_sort(F.collect_set("image_path")).alias("paths"))
    return paths.select("record_id", "page", F.posexplode("paths").alias("i", "path")).select("record_id", "page", (F.col("i") + 1).cast("bigint").alias("image_index"), "path")


SQL_IMAGE_ORDINALS = """SELECT record_id, page, row_number() OVER (PARTITION BY record_id, page ORDER BY image_path) AS image_index, image_path AS path
FROM (SELECT DISTINCT record_id, page, image_path FROM ocr_pages WHERE record_id IS NOT NULL AND page IS NOT NULL AND image_path IS NOT NULL)"""


def q_render_needed(spark: SparkSession, d: str) -> DataFrame:
    """Pages without embedded text and without any image."""
    n = _images(spark, d).groupBy("record_id", "page").agg(F.countDistinct("image_path").alias("images"))
    p = page_rows(spark, d).select("record_id", "page", "embedded_text_chars").join(n, ["record_id", "page"], "left")
    return p.where(O.render_needed(True, F.col("embedded_text_chars"), F.col("images"))).select("record_id", "page")


SQL_RENDER = """SELECT DISTINCT record_id, page FROM final_pages p WHERE record_id IS NOT NULL AND page IS NOT NULL AND coalesce(embedded_text_chars, 0) = 0
AND NOT EXISTS (SELECT 1 FROM ocr_pages o WHERE o.record_id = p.record_id AND o.page = p.page AND o.image_path IS NOT NULL)"""


def q_image_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Mean confidence of each image over what was read of it."""
    return O.image_confidence(read_table(spark, d, "ocr_results").where("path is not null")).select("path", F.round("confidence", 6).alias("confidence"))


SQL_CONFIDENCE = "SELECT path, round(coalesce(avg(confidence) FILTER (WHERE NOT isnan(confidence)), 0), 6) AS confidence FROM ocr_results WHERE path IS NOT NULL GROUP BY path"


def q_batch_results(spark: SparkSession, d: str) -> DataFrame:
    """Every result with the page of the last logged job of its image."""
    jobs = _images(spark, d).select("image_path", "record_id", "page", "ordinal")
    results = read_table(spark, d, "ocr_results").select(F.col("path").alias("image_path"), "result_id", "status")
    return O.matched(results, jobs)


SQL_BATCH = """SELECT r.path AS image_path, j.record_id, j.page, r.result_id, r.status FROM ocr_results r JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_path ORDER BY ordinal DESC) AS n
FROM ocr_pages WHERE record_id IS NOT NULL AND page IS NOT NULL AND image_path IS NOT NULL) WHERE n = 1) j ON j.image_path = r.path"""


def q_extraction_reuse(spark: SparkSession, d: str) -> DataFrame:
    """Which PDF records an earlier run has done: those with a good log entry and a merged page."""
    r = read_table(spark, d, "pdf_records").where("id is not null").select("id").distinct()
    texts = read_table(spark, d, "ocr_pages").where("status = 'ok'").select(F.col("record_id").alias("id"))
    return O.reused(r, texts, read_table(spark, d, "final_pages").select(F.col("record_id").alias("id"))).select("id", "reused")


SQL_REUSE = """SELECT DISTINCT id, id IN (SELECT record_id FROM ocr_pages WHERE status = 'ok' AND record_id IS NOT NULL) AND id IN (SELECT record_id FROM final_pages WHERE record_id IS NOT NULL) AS reused FROM pdf_records WHERE id IS NOT NULL"""


def q_ocr_doc_summary(spark: SparkSession, d: str) -> DataFrame:
    """Log entries, characters and mean confidence of each record."""
    df = O.document_summary(read_table(spark, d, "ocr_pages"))
    return df.withColumn("average_confidence", F.round("average_confidence", 6))


SQL_OCR_SUMMARY = """SELECT record_id, count(*) AS ocr_pages, CAST(sum(coalesce(ocr_text_chars, 0)) AS BIGINT) AS ocr_text_chars,
round(avg(CASE WHEN confidence IS NULL OR isnan(confidence) THEN 0 ELSE confidence END), 6) AS average_confidence FROM ocr_pages GROUP BY record_id"""


def q_doc_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Where each page of a merged document begins: (record_id, page, from_char, chars)."""
    return M.document_offsets(_layers(spark, d))


SQL_OFFSETS = f"""WITH {SQL_LAYERS}, t AS (SELECT record_id, page, length(chr(10) || chr(10) || '--- Page ' || page || ' [' || source || '] ---' || chr(10) || final_text) AS chars FROM merged WHERE final_text <> '')
SELECT record_id, page, coalesce(CAST(sum(chars) OVER (PARTITION BY record_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS from_char, chars FROM t"""


def q_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "ocr_pages").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def q_stream_resume(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the log handed on once each by a file stream, as its final state."""
    import uuid

    from corpusgraph.streaming.resume import stream_new

    stamp = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = read_table(spark, d, "ocr_pages").schema

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.select("record_id", "page").write.mode("overwrite").parquet(f"{stamp}/out/batch={batch_id}")

    stream_new(spark, f"{d}/ocr_pages.parquet*", schema, ["record_id", "page"], sink, f"{stamp}/state").awaitTermination()
    return spark.read.schema("record_id string, page bigint").parquet(f"{stamp}/out/*")


SQL_STREAM = "SELECT DISTINCT record_id, page FROM ocr_pages"

PAIRS: dict[str, tuple] = {
    "q_chunk_pack": (q_chunk_pack, SQL_CHUNK_PACK),
    "q_chunk_ids": (q_chunk_ids, SQL_CHUNK_IDS),
    "q_chunk_stats": (q_chunk_stats, SQL_CHUNK_STATS),
    "q_chunk_rollup": (q_chunk_rollup, SQL_CHUNK_ROLLUP),
    "q_oversize_split": (q_oversize_split, SQL_OVERSIZE),
    "q_line_flags": (q_line_flags, SQL_LINE_FLAGS),
    "q_normalize": (q_normalize, None),
    "q_canonical_line": (q_canonical_line, None),
    "q_repeated_lines": (q_repeated_lines, SQL_REPEATED),
    "q_boilerplate_threshold": (q_boilerplate_threshold, SQL_THRESHOLD),
    "q_tidy": (q_tidy, f"WITH {SQL_PAGES} SELECT record_id, page, length(text) AS chars, md5(text) AS text_md5 FROM p"),
    "q_canonical_stored": (q_canonical_stored, SQL_CANONICAL),
    "q_clean_stored": (q_clean_stored, SQL_CLEAN_STORED),
    "q_curated_stored": (q_curated_stored, SQL_CURATED_STORED),
    "q_chunks_stored": (q_chunks_stored, SQL_CHUNKS_STORED),
    "q_curated_documents": (q_curated_documents, f"WITH {SQL_DOCUMENTS} SELECT * FROM docs"),
    "q_readable_sections": (q_readable_sections, SQL_SECTIONS),
    "q_curated_totals": (q_curated_totals, SQL_TOTALS_CURATED),
    "q_clean_page": (q_clean_page, None),
    "q_cleaning_actions": (q_cleaning_actions, None),
    "q_curated_pages": (q_curated_pages, None),
    "q_curated_chunks": (q_curated_chunks, None),
    "q_text_stats": (q_text_stats, SQL_TEXT_STATS),
    "q_quality": (q_quality, f"WITH {SQL_RATED} SELECT doc_id, quality FROM rated"),
    "q_default_rag": (q_default_rag, f"WITH {SQL_RATED} SELECT doc_id, include_in_default_rag FROM rated"),
    "q_rag_partition": (q_rag_partition, SQL_RAG_PARTITION),
    "q_quality_counts": (q_quality_counts, f"WITH {SQL_RATED} SELECT source, quality, count(*) AS n FROM rated GROUP BY source, quality"),
    "q_doc_rollup": (q_doc_rollup, SQL_DOC_ROLLUP),
    "q_totals": (q_totals, SQL_TOTALS),
    "q_merge_layers": (q_merge_layers, SQL_MERGE_LAYERS),
    "q_merge_doc_text": (q_merge_doc_text, SQL_MERGE_DOC),
    "q_last_write_wins": (q_last_write_wins, SQL_LAST),
    "q_resume_anti": (q_resume_anti, SQL_RESUME),
    "q_ocr_jobs": (q_ocr_jobs, SQL_JOBS),
    "q_ocr_doc_summary": (q_ocr_doc_summary, SQL_OCR_SUMMARY),
    "q_best_image": (q_best_image, f"WITH {SQL_BEST_IMAGE} SELECT * FROM best"),
    "q_image_ordinals": (q_image_ordinals, SQL_IMAGE_ORDINALS),
    "q_render_needed": (q_render_needed, SQL_RENDER),
    "q_image_confidence": (q_image_confidence, SQL_CONFIDENCE),
    "q_batch_results": (q_batch_results, SQL_BATCH),
    "q_extraction_reuse": (q_extraction_reuse, SQL_REUSE),
    "q_doc_offsets": (q_doc_offsets, SQL_OFFSETS),
    "q_status_counts": (q_status_counts, "SELECT status, count(*) AS n FROM ocr_pages GROUP BY status"),
    "q_stream_resume": (q_stream_resume, SQL_STREAM),
}
