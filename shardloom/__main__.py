"""python -m shardloom --url_list ... --output_dir ...: one materialisation job."""

from __future__ import annotations

import argparse


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shardloom", description="Fetch the URLs of a table and write them as sharded containers.")
    p.add_argument("--url_list", required=True)
    p.add_argument("--output_dir", required=True)
    p.add_argument("--master_node", help="host of a standalone master; without it the submitted or local session is used")
    p.add_argument("--num_proc", type=int, help="local cores, if no session is at hand")
    p.add_argument("--input_format", default="parquet")
    p.add_argument("--output_format", default="webdataset")
    p.add_argument("--url_col", default="url")
    p.add_argument("--caption_col")
    p.add_argument("--encode_format", default="jpg")
    p.add_argument("--number_sample_per_shard", type=int, default=1000)
    p.add_argument("--thread_count", type=int, default=32)
    p.add_argument("--retries", type=int, default=0)
    p.add_argument("--incremental_mode", default="incremental")
    return p


def session(master_node: str | None, num_proc: int | None):
    """The active session, or one at the standalone master or on this machine. Fetching has side effects, so attempts
    are never raced."""
    from pyspark.sql import SparkSession

    if active := SparkSession.getActiveSession():
        return active
    builder = SparkSession.builder.appName("shardloom").config("spark.speculation", "false")
    if master_node:
        builder = builder.master(f"spark://{master_node}:7077")
    elif num_proc:
        builder = builder.master(f"local[{num_proc}]")
    return builder.getOrCreate()


def main(args: list[str] | None = None) -> None:
    from .plans.materialize import download

    given = vars(parser().parse_args(args))
    spark = session(given.pop("master_node"), given.pop("num_proc"))
    done = download(spark, given.pop("url_list"), output_folder=given.pop("output_dir"), **given)
    done.groupBy("status").count().show()


if __name__ == "__main__":
    main()
