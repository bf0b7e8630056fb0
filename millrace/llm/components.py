"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Tables, mapped

CHUNK_EDGES = 1 << 18


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges and the least node that each reaches, by pointer jumping."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[: len(a)], code[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        p, q = parent[x], parent[y]
        low, high = np.minimum(p, q), np.maximum(p, q)
        if (low == high).all():
            return nodes, nodes[parent]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _contracted(edges: DataFrame) -> DataFrame:
    """The same components by stars of each chunk of edges in a task: no more edges, shorter paths."""

    def star(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        node, root = roots(a, b)
        own = node != root
        return pa.RecordBatch.from_arrays([pa.array(root[own]), pa.array(node[own])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            parts.append([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
            size += batch.num_rows
            if size >= CHUNK_EDGES:
                yield star(*map(np.concatenate, zip(*parts, strict=True)))
                parts, size = [], 0
        if size:
            yield star(*map(np.concatenate, zip(*parts, strict=True)))

    return mapped(edges.select("a", "b"), run, "a long, b long")


def _star_shaped(edges: DataFrame) -> bool:
    """Whether each node is either the smallest end of all its edges or has one edge, to a smaller one."""
    ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("up")).union(edges.select("a", F.lit(0)))
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return roles.filter("up > 1 OR (up = 1 AND least = 0)").isEmpty()


def connected(edges: DataFrame, tables: Tables, rounds: int = 60) -> DataFrame:
    """node and component (the smallest node reachable) of each node of ``edges`` (a, b: long, no
    nulls); a node whose only edge is to itself may be left out. Edges are contracted to stars
    within each task, before and after a shuffle has united their copies: few edges are in few tasks
    then and need no round. Each round links all larger neighbours of a node to the smallest, then
    all smaller ones; the edges never grow in number, and paths shrink by a factor each round. A
    round is written to the shared folder, and the one before is removed."""
    smaller = lambda e: e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    state = tables(_contracted(smaller(_contracted(edges))), "stars")
    for _ in range(rounds):
        if _star_shaped(state):
            return state.select(F.col("b").alias("node"), "a").union(state.select("a", "a")).groupBy("node").agg(F.min("a").alias("component"))
        both = state.union(state.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = smaller(large)
        # now the smaller neighbours a of each b
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        stars = small.select(F.col("m").alias("a"), "b").union(small.select(F.col("m").alias("a"), F.col("a").alias("b")))
        before, state = state, tables(smaller(stars), "stars")
        tables.drop(before)
    raise RuntimeError("components did not settle")
