"""Exact link counts inside components of near vectors, without pairs as rows.

A component of at most BLOCK nodes is one cell. A larger one is cut into cells
by the nearest axis of a rotation, and large cells at random, so that a cell
has about BLOCK nodes. Inside a cell all pairs are compared in one product.
Every cell has a center and a radius (the largest angle to it); two cells of a
component are then

- apart, if the angle of their centers less both radii exceeds the link angle:
  no pair is looked at;
- linked throughout, if the angle plus both radii stays within it: sizes are
  added, no pair is looked at, so tight groups of any size cost their cells;
- mixed, else: their nodes meet as two blocks.

Rows are nodes, cells, pairs of cells and blocks of mixed pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import broadcast_if_small, settle
from tramline.llm.near_vectors import BLOCK, bucket_codes, matrix, numbers, sorted_groups, unit

#: Angles are taken as equal within this; nearer the threshold pairs are compared.
MARGIN = 1e-6
#: The cells of one component meet in so many tasks.
SPREAD = 16
#: Table number of the rotation that cuts components.
CUT = 1 << 20


def _cells(nodes: DataFrame, label: DataFrame, block: int) -> DataFrame:
    """(label, cell, node, copies, v) of all nodes of the components."""
    sizes = label.groupBy("label").agg(F.count("*").alias("size"))
    rows = label.join(sizes, "label").join(nodes.select("node", "d", "copies", "v", "q"), "node").select(
        "d", "q", "size", "label", "node", "copies", "v")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, size = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            code = np.zeros(len(d), np.int64)
            for k in np.unique(d[size > block]).tolist():
                some = np.flatnonzero((d == k) & (size > block))
                code[some] = 1 + bucket_codes(matrix([batch.take(pa.array(some))], 1).astype(np.float32), CUT, [k])
            yield pa.RecordBatch.from_arrays([pa.array(code), *batch.columns[3:]], names=["code", "label", "node", "copies", "v"])

    kind = nodes.schema["v"].dataType.simpleString()
    coded = settle(rows.mapInArrow(work, f"code long, label long, node long, copies long, v {kind}"), "coded")
    pieces = broadcast_if_small(settle(coded.groupBy("label", "code").count().filter(F.col("count") > block).select(
        "label", "code", F.ceil(F.col("count") / block).alias("pieces")), "pieces"))
    piece = F.pmod(F.xxhash64("node"), F.coalesce("pieces", F.lit(1)))
    return coded.join(pieces, ["label", "code"], "left").select(
        "label", F.when(F.col("code") == 0, 0).otherwise(F.xxhash64("code", piece)).cast("long").alias("cell"),
        "node", "copies", "v")


def _inside(cells: DataFrame, cosine: float) -> DataFrame:
    """(label, cell, node, near, center, radius, members): links within cells; a cell's first row describes it."""
    rows = cells.repartition("label", "cell").sortWithinPartitions("label", "cell", "node")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 2):
            node, copies, u = numbers(group, 2), numbers(group, 3), unit(matrix(group, 4))
            near = np.empty(len(node), np.int64)
            for i in range(0, len(node), 1024):
                linked = u[i:i + 1024] @ u.T >= cosine
                linked[np.arange(len(linked)), i + np.arange(len(linked))] = False
                near[i:i + 1024] = linked @ copies
            middle = u.sum(axis=0)
            size = float(np.sqrt(middle @ middle))
            middle = middle / size if size > 1e-9 else u[0]
            radius = float(np.arccos(np.clip(u @ middle, -1, 1)).max())
            rest = [None] * (len(node) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers(group, 0)), pa.array(numbers(group, 1)), pa.array(node), pa.array(near),
                 pa.array([middle, *rest], pa.list_(pa.float64())), pa.array([radius, *rest], pa.float64()),
                 pa.array([int(copies.sum()), *rest], pa.int64())],
                names=["label", "cell", "node", "near", "center", "radius", "members"])

    return rows.mapInArrow(work, "label long, cell long, node long, near long, center array<double>, radius double, members long")


def _pairs(described: DataFrame, cosine: float) -> DataFrame:
    """(label, low, high, low_members, high_members, whole): pairs of a component's cells that may hold links."""
    angle = math.acos(cosine)
    left = described.select("label", F.pmod(F.xxhash64("cell"), F.lit(SPREAD)).alias("part"), F.col("cell").alias("low"),
                            F.col("center").alias("c"), F.col("radius").alias("r"), F.col("members").alias("low_members"))
    right = described.select("label", F.explode(F.array(*[F.lit(k).cast("long") for k in range(SPREAD)])).alias("part"),
                             F.col("cell").alias("high"), F.col("center").alias("c2"), F.col("radius").alias("r2"),
                             F.col("members").alias("high_members"))
    dot = F.aggregate(F.zip_with("c", "c2", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    between = F.acos(F.greatest(F.least(dot, F.lit(1.0)), F.lit(-1.0)))
    return left.join(right, ["label", "part"]).filter("low < high").withColumn("between", between).filter(
        F.col("between") - F.col("r") - F.col("r2") <= angle + MARGIN).select(
        "label", "low", "high", "low_members", "high_members",
        (F.col("between") + F.col("r") + F.col("r2") <= angle - MARGIN).alias("whole"))


def _mixed(pairs: DataFrame, cells: DataFrame, cosine: float) -> DataFrame:
    """(node, near): links across the mixed pairs of cells."""
    sides = pairs.select("label", "low", "high", F.explode(F.array("low", "high")).alias("cell"))
    rows = sides.join(cells, ["label", "cell"]).select(
        "label", "low", "high", (F.col("cell") == F.col("high")).cast("long").alias("side"), "node", "copies", "v")
    rows = rows.repartition("label", "low", "high").sortWithinPartitions("label", "low", "high", "side")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            node, copies, u = numbers(group, 4), numbers(group, 5), unit(matrix(group, 6))
            m = int(np.searchsorted(numbers(group, 3), 1))
            linked = u[:m] @ u[m:].T >= cosine
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(np.concatenate([linked @ copies[m:], copies[:m] @ linked]))], names=["node", "near"])

    return rows.mapInArrow(work, "node long, near long")


def link_counts(nodes: DataFrame, label: DataFrame, cosine: float, block: int = BLOCK) -> DataFrame:
    """(node, near): how many rows of other nodes each node of a component is linked with."""
    cells = settle(_cells(nodes, label, block), "cells")
    inside = settle(_inside(cells, cosine), "inside")
    described = inside.filter("center is not null")
    several = described.groupBy("label").count().filter("count > 1").select("label")
    pairs = settle(_pairs(described.join(several, "label", "left_semi"), cosine), "cell-pairs")
    whole = pairs.filter("whole")
    added = whole.select("label", F.col("low").alias("cell"), F.col("high_members").alias("more")).union(
        whole.select("label", "high", "low_members")).groupBy("label", "cell").agg(F.sum("more").alias("more"))
    own = inside.join(added, ["label", "cell"], "left").select(
        "node", (F.col("near") + F.coalesce("more", F.lit(0))).alias("near"))
    across = _mixed(pairs.filter("not whole"), cells, cosine)
    return own.union(across).groupBy("node").agg(F.sum("near").alias("near"))
