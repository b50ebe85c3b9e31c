"""Packing items into containers of a fixed capacity: first-fit decreasing over a tournament tree, in randomised groups.

Defined results: an item without tokens (null, empty) takes no room and gets no container (null); an item over the
capacity is cut into full parts and a rest; repeated rows are packed each for itself. Container numbers are unique
over all groups. Items are dealt into groups by a hash of id, part and, among equal rows, a running number, and ties in
size are packed in the order of id and part, so the result doesn't depend on how the rows lie.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
#: Parts packed by one task; a group wastes at most part of one container.
GROUP = 20_000
#: Equal rows numbered at once.
BLOCK = 10_000


def first_fit_decreasing(sizes: list[int], capacity: int = CAPACITY) -> list[int]:
    """A bin for each size, in the order given; sizes must lie in 1..capacity. A node holds the most room left below it."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins = [0] * len(sizes)
    for i in order:
        size, node = sizes[i], 1
        if not 0 < size <= capacity:
            raise ValueError(f"size {size} is not between 1 and {capacity}")
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i] = node - leaves
        room[node] -= size
        while node > 1:
            node >>= 1
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins


def pack(df: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", capacity: int = CAPACITY, group_size: int = GROUP, n_items: int | None = None) -> DataFrame:
    """(id_col, part, offset, size, container): one row per part of an item, sizes in tokens, offset of its first token.

    The items are dealt at random (by a hash of a part's id and number) into groups of about `group_size`; only
    ids and sizes are shuffled, so a group stays small however long its texts are. Without `n_items` the
    rows are counted once.
    """
    size = F.coalesce(df[size_col].cast("long"), F.lit(0))
    items = df.select(df[id_col].alias("id"), size.alias("n"))
    n = df.count() if n_items is None else n_items
    groups = max(1, -(-n // group_size))
    # Equal rows are counted before they are shuffled, and numbered in blocks, so an id that a third of all rows have is dealt out as well.
    counted = items.groupBy("id", "n").agg(F.count("*").alias("copies"))
    blocks = counted.select("id", "n", "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BLOCK))).alias("block"))
    last = F.least(F.lit(BLOCK).cast("long"), F.col("copies") - F.col("block") * BLOCK) - 1
    rows = blocks.select("id", "n", "block", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
    parts = rows.select("id", "n", (F.col("block") * BLOCK + F.col("k")).alias("copy"), F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / capacity).cast("int") - 1))).alias("part"))
    offset = F.col("part").cast("long") * capacity
    parts = parts.select("id", "part", offset.alias("offset"), F.least(F.lit(capacity), F.col("n") - offset).alias("size"), F.pmod(F.xxhash64("id", "part", "copy"), F.lit(groups)).cast("int").alias("g"))
    dealt = parts.repartition(min(groups, 100_000), "g")

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("size", "descending"), ("id", "ascending"), ("part", "ascending")])
        sizes = rows.column("size").to_numpy()
        full = int((sizes > 0).sum())  # they stand first
        bins = np.array(first_fit_decreasing(sizes[:full].tolist(), capacity), np.int64) * groups + rows.column("g").to_numpy()[:full]
        return pa.table([*(rows.column(c) for c in ("id", "part", "offset", "size")), pa.chunked_array([pa.array(bins, pa.int64()), pa.nulls(len(sizes) - full, pa.int64())])], names=["id", "part", "offset", "size", "container"])

    kind = df.schema[id_col].dataType.simpleString()
    packed = dealt.groupBy("g").applyInArrow(run, f"id {kind}, part int, offset bigint, size bigint, container bigint")
    return packed.withColumnRenamed("id", id_col)
