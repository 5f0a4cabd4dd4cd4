"""Clusters from the command line: python -m shardloom.fleet COMMAND --states FOLDER [--hosts CSV] ...

    setup  a new cluster of the first free hosts        --hosts --id --num_nodes --mem_gb (or --config FILE)
    add    hosts drawn by a seed from those that are free --hosts --id --num_nodes [--seed]
    kill   the last workers of a cluster, or all of it   --id [--num_nodes]
    list   running clusters and their numbers of workers

States are the files that operators.fleet.save() writes; each command prints what it has written. Hosts are selected and
states are kept here; starting processes on them is left to the site's own tools.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import fleet
from .sinks.containers import filesystem
from .sources import tables


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="python -m shardloom.fleet", description="select hosts and keep states of clusters")
    parser.add_argument("command", choices=("setup", "add", "kill", "list"))
    parser.add_argument("--states", required=True, help="folder of state files")
    parser.add_argument("--hosts", help="CSV with a column host")
    parser.add_argument("--config", help="JSON with id, num_nodes and mem_gb of a new cluster")
    parser.add_argument("--id")
    parser.add_argument("--num_nodes", type=int)
    parser.add_argument("--mem_gb", type=int, default=30)
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--nodes_to_kill", nargs="+", help="workers to release by name, instead of the last --num_nodes")
    args = parser.parse_args(argv)
    if args.command in ("setup", "add") and not args.hosts:
        parser.error(f"{args.command} needs --hosts")
    if args.command in ("add", "kill") and not args.id:
        parser.error(f"{args.command} needs --id")
    if args.nodes_to_kill and (args.command != "kill" or args.num_nodes is not None):
        parser.error("--nodes_to_kill goes with kill alone, without --num_nodes")
    if args.command == "add" and not args.num_nodes:
        parser.error("add needs --num_nodes")
    if args.command == "setup" and not (args.config or args.id and args.num_nodes):
        parser.error("setup needs --config, or --id and --num_nodes")
    return args


def states(spark: SparkSession, folder: str) -> DataFrame:
    """States of running clusters, none where there is no file yet."""
    fs, root = filesystem(folder)
    there = fs.get_file_info(root).type == pafs.FileType.Directory and any(f.path.endswith(".json") for f in fs.get_file_info(pafs.FileSelector(root)))
    return tables.running_clusters(spark, folder) if there else spark.createDataFrame([], fleet.STATE)


def run(spark: SparkSession, args: argparse.Namespace) -> list[dict]:
    """What the command comes to, as rows."""
    known = states(spark, args.states)
    if args.command == "list":
        return [r.asDict() for r in fleet.counts(known).orderBy("cluster_id").collect()]
    hosts = tables.hosts(spark, args.hosts) if args.hosts else None
    if args.command == "setup":
        asked = tables.cluster_config(spark, args.config).first().asDict() if args.config else {"id": args.id, "num_nodes": args.num_nodes, "mem_gb": args.mem_gb}
        if known.where(known.cluster_id == asked["id"]).count():
            raise ValueError(f"cluster {asked['id']} is running")
        new = fleet.setup(hosts, known, asked["id"], asked["num_nodes"], asked["mem_gb"])
    else:
        one = known.where(known.cluster_id == args.id)
        if not one.count():
            raise ValueError(f"no running cluster {args.id}")
        if args.command == "add":
            new = fleet.added(one, fleet.drawn_hosts(fleet.free_hosts(hosts, known), args.num_nodes, args.seed))
        elif args.nodes_to_kill:
            named = spark.createDataFrame([(h,) for h in args.nodes_to_kill], "host string")
            strange = named.join(one.select(F.explode("workers").alias("host")), "host", "left_anti").orderBy("host").collect()
            if strange:
                raise ValueError(f"no workers of {args.id}: {', '.join(r.host for r in strange)}")
            new = fleet.without(one, named)
        else:
            new = fleet.killed(one) if args.num_nodes is None else fleet.without(one, fleet.tail(one, args.num_nodes))
    rows = [r.asDict() for r in new.collect()]  # one cluster
    fleet.save(spark.createDataFrame([tuple(r[c] for c in new.columns) for r in rows], new.schema), args.states)
    return rows


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    for row in run(SparkSession.builder.getOrCreate(), args):
        print(json.dumps(row))


if __name__ == "__main__":
    main()
