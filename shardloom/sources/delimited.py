"""Delimited text whose cells may hold line ends, read by many tasks however few files there are.

A task cannot know from its split alone whether the split begins within a quoted cell. So each split is scanned once under
both states: it tells for each line the state before it and the number of its record if the split began outside a cell, and
the same if it began inside. A split is thus a function from its first state to its last; the functions of a file's splits,
one row each, are applied in order, which says how each split really began and how many records come before it. Lines that
are a record by themselves are then cut where they stand, and only the lines of records that go over several are brought
together by a shuffle. Records are parsed by Spark's own CSV parser and types inferred by its own rules.

The lines are written once to the shared folder, so all passes see the same splits, and a record's number in its file is
known from them: positions need no second reading of the text.

Defined cases: files without rows but a header give no rows; empty lines are no records; a line end of two characters stays
as it is within a cell; a byte order mark is no part of the header; a file that ends within a quoted cell is refused (it
would be one record from there on).
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import BLOCK, FILE, INDEX, as_arrow_reads, empty_for_null, kept

QUOTE = '"'


def state_after(line: str, inside: bool, sep: str) -> bool:
    """Whether a line ends within a quoted cell, if it began so or not. Quotes count only at the beginning of a cell, and
    two of them within one are a character of it."""
    at = 0
    while True:
        if not inside:
            if not line.startswith(QUOTE, at):
                at = line.find(sep, at) + 1
                if not at:
                    return False
                continue
            at += 1
        while (end := line.find(QUOTE, at)) >= 0 and line.startswith(QUOTE, end + 1):
            at = end + 2
        if end < 0:
            return True
        inside, at = False, line.find(sep, end + 1) + 1
        if not at:
            return False


def scanned(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """value, FILE, BLOCK, place (number of the line in its split), and for both states in which the split may begin: in0,
    in1 (the state before the line), to0, to1 (after it), n0, n1 (records begun in the split up to and with the line)."""
    lines = spark.read.option("lineSep", "\n").text([*paths]).select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))
    names = ["in0", "in1", "to0", "to1", "n0", "n1", "place"]

    def work(batches) -> Iterator[pa.RecordBatch]:
        split, state, begun, place = None, [False, True], [0, 0], 0
        for batch in batches:
            out = []
            for line, *at in zip(batch.column("value").to_pylist(), batch.column(FILE).to_pylist(), batch.column(BLOCK).to_pylist(), strict=True):
                if at != split:
                    split, state, begun, place = at, [False, True], [0, 0], 0
                blank = line in ("", "\r")
                begun = [n + (not s and not blank) for n, s in zip(begun, state, strict=True)]
                after = [state_after(line, s, sep) for s in state] if QUOTE in line else state
                out.append((*state, *after, *begun, place))
                state, place = after, place + 1
            columns = [pa.array(c, pa.bool_() if n[0] in "it" else pa.int64()) for n, c in zip(names, zip(*out, strict=True), strict=True)] if out else [pa.array([], pa.bool_() if n[0] in "it" else pa.int64()) for n in names]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return kept(lines.mapInArrow(work, f"value string, {FILE} string, {BLOCK} long, in0 boolean, in1 boolean, to0 boolean, to1 boolean, n0 long, n1 long, place long"), "lines")


def starts(lines: DataFrame) -> DataFrame:
    """FILE, BLOCK, inside, before, ends_inside: how each split begins and ends, and the records that begin before it in its
    file. A file's splits, a row each, meet in one task."""
    last = lines.select(F.col(FILE).alias("file"), F.col(BLOCK).alias("block"), "place", "to0", "to1", "n0", "n1").groupBy("file", "block").agg(*[F.max_by(c, "place").alias(c) for c in ("to0", "to1", "n0", "n1")])

    def applied(splits: pd.DataFrame) -> pd.DataFrame:
        inside, before, out = False, 0, []
        for row in splits.sort_values("block").itertuples(index=False):
            now = (inside, before)
            inside, before = (row.to1, before + row.n1) if inside else (row.to0, before + row.n0)
            out.append((row.file, row.block, *now, inside))
        return pd.DataFrame(out, columns=["file", "block", "inside", "before", "ends_inside"])

    found = last.groupBy("file").applyInPandas(applied, "file string, block long, inside boolean, before long, ends_inside boolean")
    return found.withColumnsRenamed({"file": FILE, "block": BLOCK})


def records(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """record, FILE, INDEX: the records of each file without its header, numbered from 0, and header: that of the file."""
    lines = scanned(spark, paths, sep)
    begun = kept(starts(lines), "splits")  # a row for each split
    whole = begun.groupBy(FILE).agg(F.max_by("ends_inside", BLOCK).alias("open")).where("open").select(FILE).limit(1).collect()
    if whole:
        raise ValueError(f"a quoted cell is not closed in {whole[0][0]}")
    told = lines.join(begun, [FILE, BLOCK], "left")
    of = lambda name: F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    told = told.select("value", FILE, BLOCK, "place", of("in").alias("began"), of("to").alias("ended"), (F.coalesce("before", F.raise_error(F.lit("a line's split is not known")).cast("long")) + of("n") - 1).alias(INDEX))
    alone = told.where("not began and not ended and value not in ('', '\\r')").select(FILE, INDEX, F.col("value").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, "place", "value")))
    over = told.where("began or ended").groupBy(FILE, INDEX).agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("record"))
    return alone.unionByName(over).withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def read_delimited(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """All columns of the files, by the names of the first file's header, with FILE, BLOCK (0) and INDEX."""
    found = kept(records(spark, paths, sep), "records")
    options = {"sep": sep, "escape": QUOTE, "timestampFormat": "yyyy-MM-dd HH:mm:ss", "preferDate": "true"}
    header = found.where(F.col(INDEX) == 0).orderBy(FILE).select("record").first()
    if header is None:
        raise ValueError("no header in any file")
    names = next(csv.reader([header[0].removeprefix("\ufeff")], delimiter=sep))
    rows = found.where(F.col(INDEX) > 0)
    encoder = spark.sparkContext._jvm.org.apache.spark.sql.Encoders.STRING()
    reader = spark.read.options(inferSchema=True, header=False, **options)
    types = reader._jreader.csv(getattr(rows.select("record")._jdf, "as")(encoder)).schema()
    kinds = [types.apply(i).dataType().simpleString() for i in range(types.size())]
    kinds = [*kinds, *["string"] * len(names)][: len(names)]  # no rows: no types
    schema = ", ".join(f"`{n or f'_c{i}'}` {k}" for i, (n, k) in enumerate(zip(names, kinds, strict=True)))
    parsed = rows.select(F.from_csv("record", F.lit(schema), options).alias("r"), FILE, F.lit(0).cast("long").alias(BLOCK), (F.col(INDEX) - 1).alias(INDEX))
    return empty_for_null(as_arrow_reads(parsed.select("r.*", FILE, BLOCK, INDEX)))
