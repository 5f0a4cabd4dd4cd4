"""Which hosts a cluster takes, and which it gives back: selection and state transitions as queries. Nothing here logs
in anywhere or runs a command."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "cluster_id string, status string, master_node string, workers array<string>, num_workers int, mem_gb int, master_url string"


def taken_hosts(clusters: DataFrame) -> DataFrame:
    """Masters and workers of running clusters."""
    running = clusters.where("status = 'running'")
    return running.select(F.explode("workers").alias("host")).union(running.select(F.col("master_node").alias("host"))).where("host is not null").distinct()


def free_hosts(hosts: DataFrame, clusters: DataFrame) -> DataFrame:
    return hosts.select("host").distinct().join(taken_hosts(clusters), "host", "left_anti")


def first_hosts(hosts: DataFrame, n: int) -> DataFrame:
    """The first n in order of name."""
    return hosts.orderBy("host").limit(n)


def drawn_hosts(hosts: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n hosts in an order drawn from the seed, or none at all if there are fewer."""
    enough = hosts.agg((F.count(F.lit(1)) >= n).alias("_enough"))  # one row
    return hosts.crossJoin(F.broadcast(enough)).where("_enough").orderBy(F.md5(F.concat("host", F.lit(f":{seed}"))), "host").limit(n).select("host")


def setup(hosts: DataFrame, clusters: DataFrame, cluster_id: str, num_nodes: int, mem_gb: int, port: int = 8080) -> DataFrame:
    """The state of a new cluster: the first free host is its master, the next ones its workers."""
    chosen = first_hosts(free_hosts(hosts, clusters), num_nodes).agg(F.array_sort(F.collect_list("host")).alias("h"))
    return chosen.where(F.size("h") > 0).select(
        F.lit(cluster_id).alias("cluster_id"), F.lit("running").alias("status"), F.col("h")[0].alias("master_node"), F.slice("h", 2, 1 << 30).alias("workers"), (F.size("h") - 1).alias("num_workers"),
        F.lit(mem_gb).alias("mem_gb"), F.concat(F.lit("http://"), F.col("h")[0], F.lit(f":{port}")).alias("master_url"),
    )


def added(state: DataFrame, new: DataFrame) -> DataFrame:
    """state with the hosts of new among its workers."""
    more = new.agg(F.array_sort(F.collect_list("host")).alias("_new"))  # bounded by the nodes asked for
    workers = F.array_union("workers", F.array_except("_new", F.array("master_node")))
    return state.crossJoin(F.broadcast(more)).withColumns({"workers": workers, "num_workers": F.size(workers)}).drop("_new")


def tail(state: DataFrame, n: int) -> DataFrame:
    """host: the last n workers, never the master; none for n = 0."""
    size = F.least(F.lit(n), F.size("workers"))
    last = F.when(size > 0, F.slice("workers", F.size("workers") - size + 1, size)).otherwise(F.array().cast("array<string>"))
    return state.select("master_node", F.explode(last).alias("host")).where("host <> master_node").select("host")


def without(state: DataFrame, gone: DataFrame) -> DataFrame:
    """state after the hosts of gone are released."""
    each = state.select("cluster_id", F.posexplode("workers").alias("_at", "host")).join(gone.select("host").distinct(), "host", "left_anti")
    left = each.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "host"))), lambda x: x["host"]).alias("_left"))
    workers = F.coalesce("_left", F.array().cast("array<string>"))
    return state.join(left, "cluster_id", "left").select(*[{"workers": workers, "num_workers": F.size(workers)}.get(c, F.col(c)).alias(c) for c in state.columns])


def killed(state: DataFrame) -> DataFrame:
    return state.withColumns({"status": F.lit("stopped"), "workers": F.array().cast("array<string>"), "num_workers": F.lit(0)})


def save(state: DataFrame, folder: str) -> None:
    """Each cluster's state as one JSON file, in place of the one before."""
    from ..sinks.containers import filesystem

    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    for row in state.toLocalIterator():  # a row for each cluster that changed
        with fs.open_output_stream(f"{root}/{row.cluster_id}.json") as f:
            f.write(json.dumps(row.asDict(), indent=4).encode())


def counts(state: DataFrame) -> DataFrame:
    return state.select("cluster_id", F.size("workers").alias("num_workers"))
