"""The stored graph: parquet tables by label, and the scans that queries start from."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cobasket.schemas import EDGE_LABELS, Graph, LABELS
from cobasket.session import file_of


CURRENT = "CURRENT"  # the file that names the snapshot readers get


def write_graph(graph: Graph, root: str) -> str:
    """Store a graph as a new snapshot below ``root``, and make it the one that readers get; its name.

    All six tables are written to a folder of their own and read back: only if each has as many rows as went in is the
    snapshot's name published, in a small file that takes the place of the one before in a single rename. A reader has
    the whole old graph or the whole new one, and a load that fails half-way changes nothing for it. Older snapshots stay
    for those who read them, until :func:`remove_snapshots`.
    """
    spark = graph.products.sparkSession
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for table, df in graph.tables().items():
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/{name}/{table}")
        n = spark.read.parquet(f"{root}/{name}/{table}").count()
        if n != seen.get["n"]:
            raise RuntimeError(f"{table}: {seen.get['n']} rows written, {n} read")
    _publish(spark, root, name)
    return name


def _publish(spark: SparkSession, root: str, name: str) -> None:
    """Replace the pointer: written beside its place, then renamed over it."""
    system, draft = file_of(spark, f"{root}/.{CURRENT}-{name}")
    out = system.create(draft)
    out.write(bytearray(name.encode()))
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    hadoop = jvm.org.apache.hadoop.fs
    over = gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    place = hadoop.Path(f"{root}/{CURRENT}")
    hadoop.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
        system.makeQualified(draft), system.makeQualified(place), over)


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """The names of all complete or begun snapshots, oldest first."""
    system, path = file_of(spark, root)
    found = [f.getPath().getName() for f in system.listStatus(path) if f.isDirectory()]
    return sorted(n for n in found if not n.startswith("."))


def current_snapshot(spark: SparkSession, root: str) -> str:
    return spark.read.text(f"{root}/{CURRENT}").first()[0]


def read_graph(spark: SparkSession, root: str, snapshot: str | None = None) -> Graph:
    """The current snapshot, or one by name. What is read stays that snapshot, whatever is published later."""
    name = snapshot or current_snapshot(spark, root)
    return Graph(**{table: spark.read.parquet(f"{root}/{name}/{table}") for table in LABELS})


def remove_snapshots(spark: SparkSession, root: str) -> int:
    """Remove all snapshots older than the current one; the number of them."""
    now = current_snapshot(spark, root)
    old = [name for name in snapshots(spark, root) if name < now]
    for name in old:
        system, path = file_of(spark, f"{root}/{name}")
        system.delete(path, True)
    return len(old)


def scan_label(graph: Graph, table: str) -> DataFrame:
    """All nodes of one label."""
    return graph.tables()[table]


# Where each edge table's ends are found: (column, node table, node key).
ENDPOINTS = {
    "belongs_to": (("product_id", "products", "asin"), ("category", "categories", "name")),
    "similar": (("src", "products", "asin"), ("dst", "products", "asin")),
    "reviewed": (("customer_id", "customers", "customer_id"), ("product_id", "products", "asin")),
}


def scan_relationship(graph: Graph, table: str) -> DataFrame:
    """One row per edge with the properties of both ends, as ``source_*``, ``target_*`` and ``rel_*`` columns.

    Plain equi joins: a small node table is broadcast if it is under Spark's size threshold, else both sides are
    shuffled and adaptive execution splits the partition of a hot node.
    """
    if table not in EDGE_LABELS:
        raise ValueError(f"not an edge table: {table}")
    tables = graph.tables()
    edges = tables[table]
    ends = [end[0] for end in ENDPOINTS[table]]
    rows = edges.select([F.col(c).alias(f"_{c}" if c in ends else f"rel_{c}") for c in edges.columns])
    for side, (column, nodes, key) in zip(("source", "target"), ENDPOINTS[table]):
        node = tables[nodes]
        node = node.select([F.col(c).alias(f"{side}_{c}") for c in node.columns])
        rows = rows.join(node, rows[f"_{column}"] == node[f"{side}_{key}"]).drop(f"_{column}")
    return rows


BUCKETS = 64
NODE_KEYS = {"products": "asin", "customers": "customer_id", "categories": "name"}


def write_buckets(graph: Graph, root: str, n: int = BUCKETS) -> str:
    """Store a graph in ``n`` buckets and give the prefix of its tables' names in the session's catalog: each node table
    by its key, and each edge table twice, by the one end and by the other. Tables with as many buckets of the same key
    are joined where they are: that saves every later scan the shuffle of its edges, for one at the load."""
    prefix = f"graph_{uuid.uuid4().hex}"
    tables = graph.tables()
    layouts = [(t, key) for t, key in NODE_KEYS.items()]
    layouts += [(t, column) for t, ends in ENDPOINTS.items() for column, _, _ in ends]
    for table, key in layouts:
        (tables[table].repartition(n, key).write.bucketBy(n, key).sortBy(key)
         .option("path", f"{root}/{table}-by-{key}").saveAsTable(f"{prefix}_{table}_by_{key}"))
    return prefix


def scan_end(spark: SparkSession, prefix: str, table: str, column: str) -> DataFrame:
    """One row per edge of a bucketed graph with the properties of the node at one end: ``rel_*`` and ``node_*``.

    The edges aren't shuffled. A bucket is one task, so the edges of a hot node are one as well: where a node has a large
    share of all edges, :func:`scan_relationship` over plain tables is split.
    """
    nodes, key = next((nodes, key) for end, nodes, key in ENDPOINTS[table] if end == column)
    edges = spark.table(f"{prefix}_{table}_by_{column}")
    node = spark.table(f"{prefix}_{nodes}_by_{key}")
    edges = edges.select([F.col(c).alias(f"rel_{c}") for c in edges.columns])
    node = node.select([F.col(c).alias(f"node_{c}") for c in node.columns])
    return edges.join(node, edges[f"rel_{column}"] == node[f"node_{key}"])


def scan_both_ends(spark: SparkSession, prefix: str, table: str) -> DataFrame:
    """The rows of :func:`scan_relationship` from a bucketed graph: the edges are shuffled for their second end only."""
    (one, nodes1, key1), (two, nodes2, key2) = ENDPOINTS[table]
    rows = spark.table(f"{prefix}_{table}_by_{one}")
    ends = (one, two)
    rows = rows.select([F.col(c).alias(f"_{c}" if c in ends else f"rel_{c}") for c in rows.columns])
    for side, column, nodes, key in (("source", one, nodes1, key1), ("target", two, nodes2, key2)):
        node = spark.table(f"{prefix}_{nodes}_by_{key}")
        node = node.select([F.col(c).alias(f"{side}_{c}") for c in node.columns])
        rows = rows.join(node, rows[f"_{column}"] == node[f"{side}_{key}"])
    return rows.drop(*[f"_{c}" for c in ends])


def scan_reviews(reviewed: DataFrame, with_dataset: bool = False) -> DataFrame:
    """The mining input: customer_id, product_id, rating [, dataset], both keys present.

    Needs no join to the node tables: a loaded edge has both its ends (see ``operators.load``).
    """
    columns = ["customer_id", "product_id", "rating"]
    rows = reviewed.filter(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
    if with_dataset:
        dataset = F.col("dataset") if "dataset" in reviewed.columns else F.lit(None)
        return rows.select(*columns, dataset.cast("string").alias("dataset"))
    return rows.select(*columns)
