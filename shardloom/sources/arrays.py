"""JSON documents that are arrays of records, read by many tasks however few files there are.

A line end cannot stand within a JSON string, so a line's brackets can be told without knowing what comes before it: each
line tells by how much it changes the depth of nesting. Sums within a split, and over a file's splits, give the depth at
which every line begins; records are what stands at depth one. Lines are then cut at the ends of records. A record within a
line is taken where it stands, and only the pieces of records that go over several lines are brought together by a shuffle.
Records are parsed by Spark's own JSON parser and types inferred by its own rules.

The lines are written once to the shared folder, so all passes see the same splits, and a record's number in its file is
known from them. A document on one line is one task, as a line is the least that a text scan gives.

Defined cases: an empty array gives no rows; brackets that do not close are refused, and so is an array that holds anything
but objects; a document that is no array is left to the reader of whole files (is_array).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import BLOCK, FILE, INDEX, as_arrow_reads, kept

TOKENS = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{}\[\]]')
BETWEEN = " \t\r\n,"


def scanned(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """value, FILE, BLOCK, place (number of the line in its split), before and delta (depth gained in the split before the line,
    and by it)."""
    lines = spark.read.option("lineSep", "\n").text([*paths]).select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))

    def work(batches) -> Iterator[pa.RecordBatch]:
        split, depth, place = None, 0, 0
        for batch in batches:
            out = []
            for line, *at in zip(*(batch.column(c).to_pylist() for c in ("value", FILE, BLOCK)), strict=True):
                if at != split:
                    split, depth, place = at, 0, 0
                marks = [m[0] for m in TOKENS.finditer(line)]
                gained = sum(m in "{[" for m in marks) - sum(m in "}]" for m in marks)
                out.append((place, depth, gained))
                depth, place = depth + gained, place + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([x[k] for x in out], pa.int64()) for k in range(3))], names=[*batch.schema.names, "place", "before", "delta"])

    return kept(lines.mapInArrow(work, f"value string, {FILE} string, {BLOCK} long, place long, before long, delta long"), "lines")


def is_array(lines: DataFrame) -> bool:
    """Whether all documents begin as arrays."""
    first = lines.where((F.col(BLOCK) == 0) & (F.trim("value") != "")).groupBy(FILE).agg(F.min_by(F.substring(F.ltrim(F.regexp_replace("value", "^\ufeff", "")), 1, 1), "place").alias("mark"))
    marks = {r.mark for r in first.select("mark").distinct().limit(3).collect()}
    return marks == {"["}


def cut(line: str, depth: int) -> Iterator[tuple[str, bool, bool]]:
    """The pieces of records in a line that begins at a depth: text, whether a record begins with it, whether it ends with it."""
    start, begun, within = 0, False, depth > 1
    for m in TOKENS.finditer(line):
        mark = m[0]
        if mark in "{[":
            if depth == 1:
                if line[start : m.start()].strip(BETWEEN) or mark == "[":
                    raise ValueError("an array holds something that is no object")
                start, begun, within = m.start(), True, True
            depth += 1
            if depth == 1:
                start = m.end()
        elif mark in "}]":
            depth -= 1
            if depth == 1:
                yield line[start : m.end()], begun, True
                start, begun, within = m.end(), False, False
            elif depth == 0:
                if line[start : m.start()].strip(BETWEEN):
                    raise ValueError("an array holds something that is no object")
                start = m.end()
    if within:
        yield line[start:], begun, False
    elif line[start:].strip(BETWEEN):
        raise ValueError("an array holds something that is no object")


def records(lines: DataFrame) -> DataFrame:
    """record, FILE, INDEX: the records of each document, numbered from 0."""
    order = Window.partitionBy(FILE).orderBy(BLOCK)
    splits = kept(lines.groupBy(FILE, BLOCK).agg(F.sum("delta").alias("delta")).withColumn("depth", F.sum("delta").over(order) - F.col("delta")), "splits")  # a row for each split
    bad = splits.groupBy(FILE).agg(F.sum("delta").alias("left")).where("left <> 0").select(FILE).limit(1).collect()
    if bad:
        raise ValueError(f"brackets do not close in {bad[0][0]}")
    known = F.coalesce("depth", F.raise_error(F.lit("a line's split is not known")).cast("long"))
    told = lines.join(splits.select(FILE, BLOCK, "depth"), [FILE, BLOCK], "left").select("value", FILE, BLOCK, "place", (known + F.col("before")).alias("depth")).sortWithinPartitions(FILE, BLOCK, "place")
    schema = f"{FILE} string, {BLOCK} long, place long, part long, piece long, n long, whole boolean, record string"

    def work(batches) -> Iterator[pa.RecordBatch]:
        part, at, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            out = []
            for line, file, block, place, depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) != at:
                    at, n = (file, block), 0
                for k, (text, begins, ends) in enumerate(cut(line, depth)):
                    n += begins
                    out.append((file, block, place, part, k, n, begins and ends, text))
            kinds = [pa.string(), *[pa.int64()] * 5, pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=[c.split(" ")[0] for c in schema.split(", ")])

    pieces = kept(told.mapInArrow(work, schema), "pieces")
    # the lines of a split may have been read in parts: each has counted its own
    order = Window.partitionBy(FILE).orderBy(BLOCK, "first")
    parts = pieces.groupBy(FILE, BLOCK, "part").agg(F.max("n").alias("n"), F.min("place").alias("first")).withColumn("base", F.sum("n").over(order) - F.col("n")).select(FILE, BLOCK, "part", "base")
    numbered = pieces.join(parts, [FILE, BLOCK, "part"]).withColumn(INDEX, F.col("base") + F.col("n") - 1)
    alone = numbered.where("whole").select("record", FILE, INDEX)
    joined = F.array_sort(F.collect_list(F.struct(BLOCK, "place", "piece", "record")))
    over = numbered.where("not whole").groupBy(FILE, INDEX).agg(F.array_join(F.transform(joined, lambda p: p["record"]), "\n").alias("record"))
    return alone.unionByName(over.select("record", FILE, INDEX))


def read_array(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """All columns of the records, with FILE, BLOCK (0) and INDEX."""
    found = kept(records(lines), "records")
    encoder = spark.sparkContext._jvm.org.apache.spark.sql.Encoders.STRING()
    kind = spark.read._jreader.json(getattr(found.select("record")._jdf, "as")(encoder)).schema().toDDL()
    place = [FILE, F.lit(0).cast("long").alias(BLOCK), INDEX]
    if not kind:
        return found.select(*place)
    return as_arrow_reads(found.select(F.from_json("record", F.lit(kind)).alias("r"), *place).select("r.*", FILE, BLOCK, INDEX))
