"""Connected components of an edge list by repeated contraction, the last edges in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import prepare_python, step

#: Most edges left that one task takes over: some 100 MB there.
TASK_EDGES = 1 << 20


def labelled(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of `nodes` numbered nodes, along the edges a, b."""
    root = np.arange(nodes)
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(ahead := root[root], root):
            root = ahead
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    return root


def _in_one_task(links: DataFrame) -> DataFrame:
    """(node, component) of links (a, b) that fit into one task."""
    prepare_python(links.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in batches if x.num_rows]
        if held:
            a, b = (np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in held]) for i in (0, 1))
            names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            found = labelled(len(names), at[:len(a)], at[len(a):])
            kind = held[0].column(0).type
            yield pa.RecordBatch.from_arrays([pa.array(names, kind), pa.array(names[found], kind)], ["node", "component"])

    kind = links.schema["a"].dataType.simpleString()
    return links.coalesce(1).mapInArrow(run, f"node {kind}, component {kind}")


def connected_components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, component): component is the smallest node reachable, for every node of `edges`.

    `edges` has columns a, b of one orderable type; loops and repeated edges
    are allowed.  Each round hooks every node to its smallest neighbour, follows the
    hooks to their ends (doubling the step each time), and rewrites the edges between
    the merged nodes.  Only nodes smaller than all their neighbours are left, at most half of
    them.  Hub nodes are pre-aggregated map-side (`min`), and the joins may be split
    by adaptive execution; they are merge joins, so the driver builds no tables for tasks.  Each step is cut by a reliable checkpoint.
    """
    links = step(
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while links.count() > task_edges:
        both = links.union(links.select("b", "a"))
        hooks = step(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                             .select("node", F.least("node", "least").alias("root")))
        while True:
            ahead = hooks.select(F.col("node").alias("root"), F.col("root").alias("next")).hint("merge")
            moved = step(hooks.join(ahead, "root").select("node", "root", "next"))
            hooks = moved.select("node", F.col("next").alias("root"))
            if moved.where("root != next").isEmpty():
                break
        if labels is None:
            labels = hooks.select("node", F.col("root").alias("component"))
        else:
            labels = step(labels.join(hooks.withColumnRenamed("node", "component").hint("merge"), "component", "left").select(
                "node", F.coalesce("root", "component").alias("component")))
        to_a = hooks.select(F.col("node").alias("a"), F.col("root").alias("x")).hint("merge")
        to_b = hooks.select(F.col("node").alias("b"), F.col("root").alias("y")).hint("merge")
        links = step(
            links.join(to_a, "a").join(to_b, "b").where(F.col("x") != F.col("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    last = step(_in_one_task(links))
    if labels is None:
        return last
    return labels.join(last.select(F.col("node").alias("component"), F.col("component").alias("root")).hint("merge"), "component", "left").select(
        "node", F.coalesce("root", "component").alias("component"))
