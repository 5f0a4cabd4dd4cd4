"""URL tables from eleven formats, as one canonical DataFrame.

Readers give the types that Arrow's readers give: empty cells of text columns are empty strings, whole numbers are
bigint, timestamps have no zone. One schema holds for all files of a dataset. Columns that are not asked for are pruned
in the scan.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import INPUT_FORMATS

FILE, BLOCK, INDEX, ORDER = "_file", "_block", "_index", "_order"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder where the driver and all executors see it: under spark.checkpoint.dir, or, where that is unset, one of
    this machine, which only local mode may use."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.gettempdir()
    return f"{found}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df as it is now, written to the shared folder: whatever reads it again sees the same rows."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def listing(spark: SparkSession, path: str, input_format: str) -> list[str]:
    """A file itself, or the folder's files with the format's ending, in order of their names."""
    if input_format not in INPUT_FORMATS:
        raise ValueError(f"Invalid input format {input_format}")
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        raise ValueError(f"No such input: {path}")
    if fs.getFileStatus(at).isFile():
        return [at.toString()]
    found = sorted(s.getPath().toString() for s in fs.listStatus(at) if s.isFile() and s.getPath().getName().endswith("." + input_format))
    if not found:
        raise ValueError(f"No file found at path {path} with extension {input_format}")
    return found


def as_arrow_reads(df: DataFrame) -> DataFrame:
    """The types of Arrow's readers: bigint for int, naive timestamps, empty strings for empty cells."""
    out: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def empty_for_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_files(spark: SparkSession, paths: Sequence[str], input_format: str) -> DataFrame:
    """All columns of the files, with FILE, BLOCK (first byte of the split) and, for Parquet, delimited text and arrays of JSON,
    INDEX (row in the file)."""
    kind = input_format.removesuffix(".gz")
    meta = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)]
    paths = [*paths]
    if kind == "parquet":
        return spark.read.parquet(*paths).select("*", *meta, F.col("_metadata.row_index").alias(INDEX))
    if kind == "txt":
        return spark.read.text(paths).where("value <> ''").select(F.col("value").alias("url"), *meta)
    if input_format in ("csv", "tsv"):
        from .delimited import read_delimited

        return read_delimited(spark, paths, "\t" if kind == "tsv" else ",")
    if kind in ("csv", "tsv"):  # compressed files are read by a task each
        reader = spark.read.options(header=True, inferSchema=True, multiLine=True, escape='"', sep="\t" if kind == "tsv" else ",", timestampFormat="yyyy-MM-dd HH:mm:ss", preferDate=True)
        return empty_for_null(as_arrow_reads(with_meta(reader.csv(paths))))
    if input_format == "json":
        from . import arrays

        if arrays.is_array(lines := arrays.scanned(spark, paths)):
            return arrays.read_array(spark, lines)
    if kind == "json":  # compressed, or objects: a task for each document
        df = with_meta(spark.read.option("multiLine", True).json(paths))
        return as_arrow_reads(records(df))
    return as_arrow_reads(with_meta(spark.read.json(paths)))


def with_meta(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def records(df: DataFrame) -> DataFrame:
    """Rows of a JSON document: an array of records as it is; an object of columns ({column: {row: value}}) is turned
    about, its rows in order of their numbers."""
    columns = [f for f in df.schema.fields if f.name not in (FILE, BLOCK)]
    if not columns or not all(isinstance(f.dataType, T.StructType) and f.dataType.names and all(n.isdigit() for n in f.dataType.names) for f in columns):
        return df
    rows = sorted({int(n) for f in columns for n in f.dataType.names})
    of = lambda f, n: F.col(f"`{f.name}`.`{n}`") if str(n) in f.dataType.names else F.lit(None)
    turned = F.array(*[F.struct(F.lit(n).alias(ORDER), *[of(f, n).alias(f.name) for f in columns]) for n in rows])
    return df.select(FILE, BLOCK, F.inline(turned)).drop(ORDER)


def column_list(input_format: str, url_col: str, caption_col: str | None, extras: Sequence[str]) -> list[tuple[str, str]]:
    """(source, canonical) columns in order: extras, caption, url; text files have the url alone."""
    if input_format.removesuffix(".gz") == "txt":
        return [("url", "url")]
    return [*((e, e) for e in extras), *([(caption_col, "caption")] if caption_col else []), (url_col, "url")]


def canonical(df: DataFrame, columns: Sequence[tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Project and rename; a missing column fails here, before any work."""
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in columns], *keep)


def url_table(spark: SparkSession, path: str, input_format: str, url_col: str = "url", caption_col: str | None = None, extras: Sequence[str] = ()) -> DataFrame:
    """The canonical table with FILE, BLOCK and, where it is known, INDEX."""
    df = read_files(spark, listing(spark, path, input_format), input_format)
    return canonical(df, column_list(input_format, url_col, caption_col, extras), [c for c in (FILE, BLOCK, INDEX) if c in df.columns])


# --- documents of the fleet's dashboards and state ------------------------------------------------------------------


def hosts(spark: SparkSession, path: str) -> DataFrame:
    """The host column of an inventory CSV."""
    return spark.read.option("header", True).csv(path).select("host")


def running_clusters(spark: SparkSession, path: str) -> DataFrame:
    """State files of clusters that run."""
    schema = "cluster_id string, status string, master_node string, workers array<string>, num_workers int, mem_gb int, master_url string"
    return spark.read.schema(schema).option("multiLine", True).json(path).where("status = 'running'")


def cluster_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, num_nodes int, mem_gb int, setup_script string").option("multiLine", True).json(path)


def alive_workers(table: DataFrame) -> DataFrame:
    """Hosts of a master page's worker table (State, Address as host:port)."""
    return table.where("State = 'ALIVE'").select(F.split("Address", ":")[0].alias("host"))


def worker_table(pages: DataFrame, html: str = "html") -> DataFrame:
    """State and Address of the first HTML table of each page, by its header row, which is looked for once a page: beside
    explode() Spark would search the page again for each of its rows."""
    table = F.regexp_extract(html, r"(?is)<table[^>]*>(.*?)</table>", 1)
    cells = lambda row, tag: F.transform(F.regexp_extract_all(row, F.lit(rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, "<[^>]*>", "")))
    headed = pages.select(table.alias("t")).select("t", cells(F.col("t"), "th").alias("names"))
    rows = headed.select("names", F.explode(F.regexp_extract_all("t", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("r"))
    held = rows.select("names", cells(F.col("r"), "td").alias("v")).where(F.size("v") > 0)
    named = lambda n: F.get("v", F.array_position("names", n).cast("int") - 1)
    return held.select(named("State").alias("State"), named("Address").alias("Address"))


def dashboard_nodes(replies: DataFrame, body: str = "body") -> DataFrame:
    """Hosts of a dashboard's JSON reply: data.summary[] without entries that hold a null, ip up to the first space."""
    entries = replies.select(F.inline(F.from_json(body, "data struct<summary: array<struct<ip: string, state: string>>>")["data"]["summary"]))
    return entries.na.drop("any").select(F.split("ip", " ")[0].alias("host"))
