"""Readers of landed files: JSON lines, one document per file, agent files and line protocols.

Fetching over a network is not a Spark job and stays outside; these read what it left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carrel.functions.text import found
from carrel.operators.guards import fail_if_any


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of text files, from 1, however many tasks read a file.

    A file is read in blocks. Lines of a block are numbered by themselves and start behind the number of lines
    of the blocks before it; that sum sees a row for each block.
    """
    place = ["file", "block"]
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_at"), "value")
    counts = read.groupBy(*place).agg(F.count("*").alias("n"))
    before = counts.select(*place, (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*place).orderBy("_at"))
    return read.withColumn("_inside", inside).join(before, place).select("file", (F.col("_before") + F.col("_inside")).alias("line_no"), "value")


def json_lines(spark: SparkSession, path: str, schema: T.StructType, key: list[str] | None = None) -> DataFrame:
    """Rows of JSON-lines files, blank lines skipped, with the column ``file``.

    A malformed line fails the read; with ``key``, so does a key that stands twice in one file, with
    the numbers of both lines.
    """
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")
    filled = F.trim("value") != ""
    if key:
        told = numbered_lines(spark, path).filter(filled).select(parsed, "file", "line_no").select(*(F.col("r")[k].alias(k) for k in key), "file", "line_no")
        twice = told.groupBy("file", *key).agg(F.count("*").alias("n"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line")).filter("n > 1")
        fail_if_any(twice, "a key stands twice in a file")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file")).filter(filled)
    return lines.select(parsed, "file").select("r.*", "file")


def agent_of(file: Column | str, chunked: bool = False) -> Column:
    """Struct (agent, chunk) of ``agent-a-part.jsonl``; null for other names.

    Without a third part there is no chunk, and nothing at all if names are to be ``chunked``.
    """
    stem = F.regexp_replace(F.col(file) if isinstance(file, str) else file, r"\.jsonl$", "")
    parts = F.split(stem, "-", 3)
    named = F.struct(F.get(parts, F.lit(1)).alias("agent"), F.get(parts, F.lit(2)).alias("chunk"))
    return F.when((F.get(parts, F.lit(0)) == "agent") & (F.size(parts) >= (3 if chunked else 2)), named)


def agents(spark: SparkSession, folder: str, schema: T.StructType, key: list[str], chunked: bool = False) -> DataFrame:
    """All agents' files of a folder as one table with columns agent and chunk.

    A key may stand once for each agent over all of its files. ``chunked`` asks for names with a
    chunk.
    """
    rows = json_lines(spark, f"{folder}/agent-*.jsonl", schema)
    named = rows.withColumn("_a", agent_of("file")).withColumns({"agent": F.col("_a.agent"), "chunk": F.col("_a.chunk")}).drop("_a", "file")
    if chunked:
        named = named.filter("chunk is not null")
    fail_if_any(named.groupBy("agent", *key).count().filter("count > 1"), "an agent has a key twice")
    return named


def documents(spark: SparkSession, folder: str, index: str = "_index.md", pattern: str = "*.md") -> DataFrame:
    """(doc, text): one row for each file, doc being its name without suffix, without the index file."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern)
    named = files.select(F.regexp_replace("_metadata.file_name", r"\.[^.]+$", "").alias("doc"), F.col("value").alias("text"), F.col("_metadata.file_name").alias("file"))
    return named.filter(F.col("file") != index).drop("file")


def lines(docs: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """(doc, line_no, line) from 1, in the order of the text."""
    split = F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    return docs.select(doc, split).withColumn("line_no", F.col("line_no") + 1)


def json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of files that hold one JSON array of objects each."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def protocol_objects(docs: DataFrame, kind: str, needed: str, doc: str = "doc", text: str = "text") -> DataFrame:
    """(doc, line_no, payload): the first object of a kind in texts of ``id:payload`` lines.

    The colon stands at the second to tenth character; payloads begin with ``{``, ``[`` or ``"``.
    An object counts if its ``_type`` is ``kind`` and its field ``needed`` is filled.
    """
    at = F.locate(":", F.col("line")) - 1
    payload = F.substr("line", F.locate(":", F.col("line")) + 1)
    parsed = lines(docs, doc, text).filter(at.between(1, 9)).select(doc, "line_no", payload.alias("payload")).filter(F.col("payload").rlike(r'^[\[{"]'))
    hits = parsed.filter((F.get_json_object("payload", "$._type") == kind) & (F.coalesce(F.get_json_object("payload", f"$.{needed}"), F.lit("")) != ""))
    first = hits.groupBy(doc).agg(F.min_by(F.struct("line_no", "payload"), "line_no").alias("first"))
    return first.select(doc, "first.line_no", "first.payload")


def slug_of(url: Column, part: str) -> Column:
    """The path segment after ``part`` at the end of a URL; null for other URLs."""
    return found(url, rf"/{part}/([^/]+)/?$")
