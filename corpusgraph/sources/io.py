"""Sources and sinks of the pipeline's tables."""

from __future__ import annotations

import html
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusgraph.functions.text import strip
from corpusgraph.session import stored


def read_release_csv(spark: SparkSession, path: str) -> DataFrame:
    """A release CSV with header and quoted line breaks; `ordinal` is the row's number from 1.

    A quoted file is read whole by one task, so the ordinal is its order in the file.
    """
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    df = df.select(*(F.col(f"`{c}`").alias(c.lstrip("﻿")) for c in df.columns))
    return df.withColumn("ordinal", F.monotonically_increasing_id() + 1)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, optional: bool = True) -> DataFrame:
    """JSON lines; an absent optional file is an empty table."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if optional and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A file that is one JSON object."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_texts(spark: SparkSession, path: str, stripped: bool = False) -> DataFrame:
    """(path, text) of whole files; bytes that are no UTF-8 become replacement characters. `stripped` drops white space at the ends."""
    df = spark.read.format("binaryFile").load(path)
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return df.select("path", (strip(text) if stripped else text).alias("text"))


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of files for an extractor."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, width, height, channels, data) of decoded images; files that are none have width and height -1."""
    df = spark.read.format("image").load(path)
    return df.select(F.col("image.origin").alias("path"), F.col("image.width").cast("bigint").alias("width"), F.col("image.height").cast("bigint").alias("height"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, bytes) of files below a folder in the order of their paths; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return df.select("path", F.col("length").alias("bytes")).orderBy("path")


#: Columns of a download result of either fetcher.
RESULT = "id string, status string, path string, bytes bigint, http_status int, error string"


def read_download_results(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a download report {generated_at, results: [...]}."""
    df = read_json(spark, path)
    return df.select("generated_at", F.explode("results").alias("r")).select("generated_at", "r.*")


def read_http_results(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the flat download table, one JSON object a line, in the form of RESULT; an absent file is an empty table."""
    df = read_jsonl(spark, path, "record_id string, status string, path string, bytes bigint, http_status int, error string")
    return df.withColumnRenamed("record_id", "id")


def all_download_results(report: DataFrame, flat: DataFrame) -> DataFrame:
    """Both kinds of download results in the form of RESULT; a failed fetch is an error in both."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    parts = []
    for df in (report, flat):
        cells = [F.col(n) if n in df.columns else F.lit(None) for n in names]
        parts.append(df.select(*(c.cast(t.split()[1]).alias(n) for c, n, t in zip(cells, names, RESULT.split(", ")))))
    return parts[0].unionByName(parts[1]).withColumn("status", F.when(F.col("status") == "failed", "error").otherwise(F.col("status")))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with sorted keys; null values are absent."""
    df.select(*sorted(df.columns)).write.mode(mode).json(path)


def write_csv(parts: list[DataFrame], path: str) -> None:
    """One CSV of several tables: the first's columns, then the others' in name order."""
    first = parts[0].columns
    extra = sorted({c for p in parts for c in p.columns} - set(first))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    for c in extra:
        out = out if c in out.columns else out.withColumn(c, F.lit(None).cast("string"))
    out.select(*first, *extra).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """A list of lines; blank ones are left out, repeated ones stay."""
    df.where(F.coalesce(F.col(column), F.lit("")) != "").select(column).write.mode("overwrite").text(path)


def write_page_texts(df: DataFrame, path: str, text: str = "text") -> None:
    """Pages below a folder for each record, the text as a column that ends in a line break unless it is empty."""
    ended = F.when(F.coalesce(F.col(text), F.lit("")) == "", F.lit("")).otherwise(F.concat(F.col(text), F.lit("\n")))
    df.withColumn(text, ended).write.mode("overwrite").partitionBy("record_id").parquet(path)


def write_tables(source: DataFrame, tables: dict[str, Callable[[DataFrame], DataFrame]], folder: str) -> None:
    """Several JSON-line tables made of one source, which is worked out once and kept for all of them."""
    kept = stored(source)
    for name, make in tables.items():
        write_jsonl(make(kept), f"{folder}/{name}")


def write_split(df: DataFrame, column: str, path: str) -> None:
    """One folder for each value of `column`, written in one pass."""
    df.write.mode("overwrite").partitionBy(column).json(path)


def graph_json(nodes: DataFrame, edges: DataFrame, metadata: dict, path: str) -> None:
    """The graph in one file: nodes by id, edges in their order; rows go to the file as they arrive, none are kept."""
    parts = (("nodes", nodes.orderBy("id").select(F.to_json(F.struct("*")))), ("edges", edges.orderBy("ord", "place").select(F.to_json(F.struct("source", "target", "relation")))))
    with Path(path).open("w", encoding="utf-8") as out:
        out.write('{\n  "metadata": ' + json.dumps(metadata, ensure_ascii=False))
        for name, rows in parts:
            out.write(f',\n  "{name}": [')
            for i, r in enumerate(rows.toLocalIterator()):
                out.write((",\n    " if i else "\n    ") + r[0])
            out.write("\n  ]")
        out.write("\n}\n")


def embedded_json(value: object) -> str:
    """JSON that may stand inside a script element."""
    return json.dumps(value, ensure_ascii=False).replace("<", "\\u003c").replace("\u2028", "\\u2028").replace("\u2029", "\\u2029")


# The viewer: counts, search, types, neighbours; all of it works on the embedded data.
_VIEWER = """
const data = id => JSON.parse(document.getElementById(id).textContent);
const graph = data("graph"), summary = data("summary"), at = id => document.getElementById(id);
const degree = new Map(), near = new Map();
for (const e of graph.edges) for (const [a, b] of [[e.source, e.target], [e.target, e.source]]) {
  degree.set(a, (degree.get(a) || 0) + 1);
  near.set(a, [...(near.get(a) || []), b]);
}
const byId = new Map(graph.nodes.map(n => [n.id, n])), types = [...new Set(graph.nodes.map(n => n.type))].sort(), shown = new Set(types);
const order = (a, b) => (degree.get(b.id) || 0) - (degree.get(a.id) || 0) || (a.label || "").localeCompare(b.label || "");
const item = (n, list) => { const li = document.createElement("li"); li.textContent = `${n.label || n.id} (${n.type}, ${degree.get(n.id) || 0})`; li.onclick = () => detail(n); list.append(li); };
function detail(n) {
  at("detail").textContent = JSON.stringify(n, null, 1);
  at("near").replaceChildren();
  (near.get(n.id) || []).map(i => byId.get(i)).filter(Boolean).sort(order).slice(0, 10).forEach(m => item(m, at("near")));
}
function list() {
  const term = at("term").value.toLowerCase();
  at("nodes").replaceChildren();
  graph.nodes.filter(n => shown.has(n.type) && JSON.stringify(n).toLowerCase().includes(term)).sort(order).forEach(n => item(n, at("nodes")));
}
for (const t of types) {
  const box = document.createElement("input"), label = document.createElement("label");
  box.type = "checkbox"; box.checked = true;
  box.onchange = () => { box.checked ? shown.add(t) : shown.delete(t); list(); };
  label.append(box, t);
  at("types").append(label);
}
at("counts").textContent = JSON.stringify(summary);
at("term").oninput = list;
list();
"""


def graph_html(graph: dict, summary: dict, note: str, path: str) -> None:
    """A self-contained page that holds graph and summary as data, with a list of nodes to search and follow. For graphs that fit a browser."""
    page = f"""<!doctype html><meta charset="utf-8"><title>Knowledge graph</title><p>{html.escape(note)}</p><pre id="counts"></pre>
<input id="term" placeholder="Search"><span id="types"></span><ul id="nodes"></ul><pre id="detail"></pre><ul id="near"></ul>
<script type="application/json" id="graph">{embedded_json(graph)}</script>
<script type="application/json" id="summary">{embedded_json(summary)}</script>
<script>{_VIEWER}</script>
"""
    Path(path).write_text(page, encoding="utf-8")
