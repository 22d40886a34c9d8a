"""Line cleaning: repeated lines of a document, dropping and repairing lines, joining paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions import text as T
from corpusgraph.session import small, stored

#: Names of what was done to lines, in the order in which the rules are tried.
ACTIONS = (
    "removed_repeated_boilerplate_lines",
    "removed_artifact_lines",
    "removed_low_value_short_lines",
    "removed_adjacent_duplicate_lines",
    "repaired_hyphenated_line_breaks",
    "joined_wrapped_lines",
)
_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def repeated_lines(pages: DataFrame, text: str = "text") -> DataFrame:
    """(record_id, key, n_pages): boilerplate-like lines on as many pages of a record as the threshold asks.

    pages: (record_id, page, `text` normalized); rows of a page may repeat for the count of lines,
    every row counts for the size of the record.
    """
    sizes = pages.groupBy("record_id").agg(T.boilerplate_threshold(F.count(F.lit(1))).alias("need"))
    lines = pages.select("record_id", "page", F.explode(F.split(text, _BREAKS, -1)).alias("line")).withColumn("line", T.strip(F.col("line")))
    keys = lines.where(T.is_boilerplate(F.col("line"))).select("record_id", "page", T.canonical(F.col("line")).alias("key")).where("key <> ''")
    counts = keys.distinct().groupBy("record_id", "key").agg(F.count(F.lit(1)).alias("n_pages"))
    return counts.join(sizes, "record_id").where("n_pages >= need").select("record_id", "key", "n_pages")


def folded(text: Column, repeated: Column) -> Column:
    """struct(lines, counts by action) of a normalized text: one pass over its lines.

    State: lines kept so far, the key of the last kept line, whether the next line has been
    taken up by a hyphen repair. Tests in order: taken up, blank (forgets the last key), repeated,
    artifact, low value, equal to the last kept line, hyphen repair, keep.
    """
    raw = F.transform(F.split(text, "\n", -1), lambda x: F.struct(T.strip(x).alias("line"), T.canonical(x).alias("key")))

    def rule(x: Column) -> Column:
        s = x["line"]
        return F.when(s == "", 0).when(F.array_contains(repeated, x["key"]), 1).when(T.is_artifact(s), 2).when(T.is_low_value(s), 3).otherwise(9)

    # The inner lambda sees the lines as a variable; named as an expression they would be split anew for each line.
    facts = F.transform(
        F.array(raw),
        lambda r: F.transform(r, lambda x, i: F.struct(x["line"].alias("line"), F.coalesce(F.try_element_at(r, (i + 2).cast("int"))["line"], F.lit("")).alias("next"), x["key"].alias("key"), rule(x).alias("rule"))),
    )[0]
    zeros = F.array_repeat(F.lit(0).cast("bigint"), 5)
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit("").alias("last"), F.lit(False).alias("skip"), zeros.alias("n"))

    def plus(n: Column, at: int) -> Column:
        return F.transform(n, lambda v, i: v + F.when(i == at, 1).otherwise(0))

    def step(acc: Column, x: Column) -> Column:
        twin = (acc["last"] != "") & (acc["last"] == x["key"])
        repair = x["line"].endswith("-") & F.left(x["next"], F.lit(1)).rlike(r"\p{Ll}")
        joined = F.concat(F.substring(x["line"], F.lit(1), F.length(x["line"]) - 1), x["next"])
        off = F.lit(False)

        def state(kept: Column, last: Column, skip: Column, n: Column) -> Column:
            return F.struct(kept.alias("kept"), last.alias("last"), skip.alias("skip"), n.alias("n"))

        return (
            F.when(acc["skip"], state(acc["kept"], acc["last"], off, acc["n"]))
            .when(x["rule"] == 0, state(F.concat(acc["kept"], F.array(F.lit(""))), F.lit(""), off, acc["n"]))
            .when(x["rule"] == 1, state(acc["kept"], acc["last"], off, plus(acc["n"], 0)))
            .when(x["rule"] == 2, state(acc["kept"], acc["last"], off, plus(acc["n"], 1)))
            .when(x["rule"] == 3, state(acc["kept"], acc["last"], off, plus(acc["n"], 2)))
            .when(twin, state(acc["kept"], acc["last"], off, plus(acc["n"], 3)))
            .when(repair, state(F.concat(acc["kept"], F.array(joined)), T.canonical(joined), F.lit(True), plus(acc["n"], 4)))
            .otherwise(state(F.concat(acc["kept"], F.array(x["line"])), x["key"], off, acc["n"]))
        )

    return F.aggregate(facts, start, step, lambda a: F.struct(a["kept"].alias("lines"), a["n"].alias("n")))


def paragraphs(lines: Column) -> Column:
    """struct(parts, joined): lines put together into paragraphs; a blank line closes one."""
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit("").alias("open"), F.lit(0).cast("bigint").alias("joined"))

    def step(acc: Column, x: Column) -> Column:
        closed = F.when(acc["open"] == "", acc["parts"]).otherwise(F.concat(acc["parts"], F.array(acc["open"])))

        def state(parts: Column, open_: Column, joined: Column) -> Column:
            return F.struct(parts.alias("parts"), open_.alias("open"), joined.alias("joined"))

        return (
            F.when(x == "", state(closed, F.lit(""), acc["joined"]))
            .when(acc["open"] == "", state(acc["parts"], x, acc["joined"]))
            .when(T.joins(acc["open"], x), state(acc["parts"], F.concat(acc["open"], F.lit(" "), x), acc["joined"] + 1))
            .otherwise(state(closed, x, acc["joined"]))
        )

    end = lambda a: F.struct(F.when(a["open"] == "", a["parts"]).otherwise(F.concat(a["parts"], F.array(a["open"]))).alias("parts"), a["joined"].alias("joined"))
    return F.aggregate(lines, start, step, end)


def cleaned(pages: DataFrame, text: str = "text") -> DataFrame:
    """`pages` with clean_text and the six action counts as columns; `text` must be normalized.

    `pages` is read twice and should be a stored table. The repeated lines of the records are kept
    as a table of a row per record and broadcast if it is small, so that texts are not shuffled.
    """
    repeated = small(stored(repeated_lines(pages, text).groupBy("record_id").agg(F.collect_set("key").alias("repeated"))))
    df = pages.join(repeated, "record_id", "left").withColumn("repeated", F.coalesce("repeated", F.array().cast("array<string>")))
    # One element's transform keeps each fold from being worked out again for every column read from it.
    once = lambda c: F.transform(F.array(c), lambda x: x)[0]
    df = df.withColumn("fold", once(folded(F.col(text), F.col("repeated")))).withColumn("par", once(paragraphs(F.col("fold.lines"))))
    out = df.withColumn("clean_text", T.strip(F.array_join("par.parts", "\n\n")))
    for i, name in enumerate(ACTIONS[:5]):
        out = out.withColumn(name, F.col("fold.n")[i])
    return out.withColumn(ACTIONS[5], F.col("par.joined")).drop("fold", "par", "repeated")
