"""SimHash near-duplicates by a hierarchical index over fingerprints in Gray order.

Neighbours in the order of Gray ranks differ in few bits. Distinct fingerprints are
range-partitioned by that rank. In a part, four neighbours at a time make a node that
holds the bits on which they agree, and so on up to the root. Two nodes are compared
only in bits that both have and their parents had not, and the differences add up from
the root: once they exceed the distance, all pairs below are out. Parts whose roots
differ too much never meet. Links found in a cell of two parts leave it as a forest."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm import textbytes as tb
from mercato.llm.components import connected_components
from mercato.llm.registry import register, table
from mercato.llm.scratch import Scratch
from mercato.llm.shipping import map_arrow, ship

SHINGLE_WORDS = 3
DISTANCE = 2
SEED = 42
# Fingerprints in a part of the Gray order; parts grow once there are MAX_PARTS, as the
# root of each comes to the driver.
PART_CODES = 100_000
MAX_PARTS = 4_096
FANOUT = 4
# Pairs of nodes opened at once.
NODE_PAIRS = 100_000
U64 = np.uint64
SPACE = 0x20

# Each byte as eight counters of one byte, so that 255 of them can be added.
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(U64).ravel()
LANE_LIMIT = 255


def _majorities(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Of each row the bits set in over half of its hashes; rows ascend."""
    counts = np.zeros((rows, 64), np.int64)
    total = np.bincount(row, minlength=rows)
    begin = np.cumsum(total) - total
    at = 0
    while at < len(hashes):
        h, r = hashes[at : at + (1 << 16)], row[at : at + (1 << 16)]
        place = np.arange(at, at + len(h)) - begin[r]
        cut = place % LANE_LIMIT == 0
        cut[0] = True
        cuts = np.flatnonzero(cut)
        lanes = np.add.reduceat(LANES[h.view(np.uint8).reshape(-1, 8)], cuts, axis=0)
        np.add.at(counts, r[cuts], lanes.view(np.uint8).reshape(-1, 64))
        at += len(h)
    bits = (2 * counts > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(U64).ravel()


def row_fingerprints(piece: tb.Slice, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprint of each row; 0 without words."""
    data = tb.LOWER[piece.data]
    starts, ends, first = tb.words(piece)
    rows = len(piece)
    if not len(starts):
        return np.zeros(rows, U64)
    length = ends - starts
    # All words once more, with one space between them.
    at = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int(at[-1] + length[-1]) + 1, SPACE, np.uint8)
    inner = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    joined[np.repeat(at, length) + inner] = data[np.repeat(starts, length) + inner]
    words = np.diff(first)
    shingles = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    row = np.repeat(np.arange(rows), shingles)
    begin = first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = begin + np.minimum(words, width)[row] - 1
    raw, hashed = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(at[begin].tolist(), (at[last] + length[last]).tolist())
    hashes = np.fromiter((hashed(raw[a:b], SEED) for a, b in spans), U64, len(row))
    return _majorities(hashes, row, rows)


def fingerprints(documents: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """`doc_id`, `code` (the fingerprint's 64 bits) and `vertex`, a number one to one
    with the code and in no order."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tb.slices(batch.column(1)):
                code = row_fingerprints(piece, width)
                here = slice(piece.first, piece.first + len(piece))
                columns = [batch.column(0)[here], pa.array(code.view(np.int64)), pa.array(tb.mixed(code).view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "code", "vertex"])

    return map_arrow(documents.select("doc_id", "text"), run, f"doc_id {id_type}, code bigint, vertex bigint")


def gray_rank(code: Column) -> Column:
    """Place of a code in the Gray sequence, as a signed number. The sequence is a
    ring, so beginning it elsewhere keeps neighbours together."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


class GrayTree:
    """Levels from the codes up to one root: the value and the mask of agreed bits of
    each node. Codes are in Gray order."""

    def __init__(self, codes: np.ndarray):
        self.values, self.masks = [codes], [np.full(len(codes), ~U64(0))]
        while len(self.values[-1]) > 1:
            value, mask = self.values[-1], self.masks[-1]
            cuts = np.arange(0, len(value), FANOUT)
            ones = np.bitwise_and.reduceat(value, cuts)
            agreed = np.bitwise_and.reduceat(mask, cuts) & ~(np.bitwise_or.reduceat(value, cuts) ^ ones)
            self.values.append(ones & agreed)
            self.masks.append(agreed)

    def raise_to(self, levels: int) -> None:
        while len(self.values) < levels:
            self.values.append(self.values[-1])
            self.masks.append(self.masks[-1])

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Possible children one level down, and which of them exist."""
        below = node[:, None] * FANOUT + np.arange(FANOUT)
        return below, below < len(self.values[level - 1])


def close_pairs(left: GrayTree, right: GrayTree, distance: int = DISTANCE, node_pairs: int = NODE_PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all codes at most `distance` bits apart, part by part. With the same
    tree on both sides each pair of places once, the smaller first."""
    same = left is right
    levels = max(len(left.values), len(right.values))
    left.raise_to(levels)
    right.raise_to(levels)
    if not len(left.values[0]) or not len(right.values[0]):
        return
    top = levels - 1
    root = np.zeros(1, np.int64)
    shared = left.masks[top] & right.masks[top]
    apart = np.bitwise_count((left.values[top] ^ right.values[top]) & shared).astype(np.int64)
    if apart[0] > distance:
        return
    if not top:
        if not same:
            yield root, root
        return
    waiting = [(top, root, root, apart)]
    while waiting:
        level, x, y, apart = waiting.pop()
        if len(x) > node_pairs:
            waiting.append((level, x[node_pairs:], y[node_pairs:], apart[node_pairs:]))
            x, y, apart = x[:node_pairs], y[:node_pairs], apart[:node_pairs]
        known = left.masks[level][x] & right.masks[level][y]
        # A raised tree's only child of its root is the root itself.
        below_x, is_x = left.children(level, x)
        below_y, is_y = right.children(level, y)
        there = is_x[:, :, None] & is_y[:, None, :]
        if same:
            there &= (below_x[:, :, None] < below_y[:, None, :]) if level == 1 else (below_x[:, :, None] <= below_y[:, None, :])
        pair, i, j = np.nonzero(there)
        x, y = below_x[pair, i], below_y[pair, j]
        fresh = left.masks[level - 1][x] & right.masks[level - 1][y] & ~known[pair]
        apart = apart[pair] + np.bitwise_count((left.values[level - 1][x] ^ right.values[level - 1][y]) & fresh)
        near = apart <= distance
        x, y, apart = x[near], y[near], apart[near]
        if not len(x):
            continue
        if level == 1:
            yield x, y
        else:
            waiting.append((level - 1, x, y, apart))


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the ends of all links; a label is the smallest place."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further


def _parts(count: np.ndarray, parts: int) -> np.ndarray:
    """Part of each slice of the order: neighbours go together, about evenly."""
    middle = np.cumsum(count) - count / 2
    return np.unique((middle * parts / max(1, count.sum())).astype(np.int64), return_inverse=True)[1]


def _cells(slices: pa.Table, parts: int, distance: int) -> pa.Table:
    """Pairs of parts that can hold close codes: a row for each slice of each, with the
    other part's agreed bits. `slices` has about as many rows as there are parts."""
    slices = slices.sort_by("slice")
    part = _parts(slices["n"].to_numpy(), parts)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    ones, some = (slices[c].to_numpy().view(U64) for c in ("ones", "some"))
    ones, some = np.bitwise_and.reduceat(ones, cuts), np.bitwise_or.reduceat(some, cuts)
    mask = ~(some ^ ones)
    value = ones & mask
    rows = {c: [] for c in ("cell", "slice", "side", "other_value", "other_mask", "lone")}
    number = slices["slice"].to_numpy()
    of = [number[part == k] for k in range(len(cuts))]
    cell = 0
    for i in range(len(cuts)):
        apart = np.bitwise_count((value[i] ^ value[i:]) & mask[i] & mask[i:])
        for j in (i + np.flatnonzero(apart <= distance)).tolist():
            for side, own, other in ((0, i, j), (1, j, i))[: 1 + (i != j)]:
                n = len(of[own])
                rows["slice"].append(of[own])
                for c, v in (("cell", cell), ("side", side), ("lone", i == j)):
                    rows[c].append(np.full(n, v))
                rows["other_value"].append(np.full(n, value[other]).view(np.int64))
                rows["other_mask"].append(np.full(n, mask[other]).view(np.int64))
            cell += 1
    return pa.table({c: np.concatenate(x) for c, x in rows.items()})


def close_codes(codes: DataFrame, scratch: Scratch, distance: int = DISTANCE, part_codes: int = PART_CODES) -> DataFrame:
    """`a`, `b`: vertices of distinct codes (`code`) such that the links between them
    connect exactly what all pairs at most `distance` bits apart connect."""
    spark = codes.sparkSession
    ship(spark)
    total = codes.count()
    if not total:
        return spark.createDataFrame([], "a bigint, b bigint")
    parts = max(1, min(MAX_PARTS, math.ceil(total / part_codes)))
    placed = scratch.write(
        codes.select("code", gray_rank(F.col("code")).alias("gray"))
        .repartitionByRange(parts, "gray")
        .withColumn("slice", F.spark_partition_id().cast("bigint")),
        "gray",
    )
    slices = placed.groupBy("slice").agg(
        F.bit_and("code").alias("ones"), F.bit_or("code").alias("some"), F.count(F.lit(1)).alias("n")
    )
    cells = spark.createDataFrame(_cells(slices.toArrow(), parts, distance))
    apart = F.bit_count(F.col("code").bitwiseXOR(F.col("other_value")).bitwiseAND(F.col("other_mask")))
    sent = placed.join(cells, "slice").where(apart <= distance).select("cell", "side", "lone", "code", "gray")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("side", "ascending"), ("gray", "ascending")])
        code, side = group["code"].to_numpy().view(U64), group["side"].to_numpy()
        cut = int(np.searchsorted(side, 1))
        left, label = GrayTree(code[:cut]), np.arange(len(code))
        lone = group["lone"][0].as_py()
        right = left if lone else GrayTree(code[cut:])
        for x, y in close_pairs(left, right, distance):
            label = merge(label, x, y if lone else y + cut)
        moved = np.flatnonzero(label != np.arange(len(label)))
        vertex = tb.mixed(code).view(np.int64)
        return pa.table({"a": vertex[moved], "b": vertex[label[moved]]})

    return sent.groupBy("cell").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(documents: DataFrame, distance: int = DISTANCE, width: int = SHINGLE_WORDS, part_codes: int = PART_CODES) -> DataFrame:
    """One row for each row of `documents`: `doc_id`, `code` (64 bits), `fingerprint` (16
    hex digits) and `component_id`, the smallest doc_id that links reach. Documents are
    linked when their fingerprints differ in at most `distance` bits.

    A bit of the fingerprint is set if it is in over half of the shingles' hashes,
    repeated shingles counted each time. A text of fewer words than a shingle is one
    shingle; a null or empty text, or one of white space, has fingerprint 0 and is
    linked like any other. Whole texts are read, whatever their length. Equal
    fingerprints are compared once. A row without doc_id takes part; its component_id is
    that of the others, or null. An empty table gives an empty result; other columns
    are not read."""
    scratch = Scratch(documents.sparkSession, "simhash")
    rows = scratch.write(fingerprints(documents, width), "rows")
    classes = scratch.write(rows.groupBy("code", "vertex").agg(F.min("doc_id").alias("first")), "classes")
    links = scratch.write(close_codes(classes, scratch, distance, part_codes), "links")
    roots = connected_components(links, scratch).withColumnRenamed("v", "vertex")
    rooted = classes.join(roots, "vertex", "left").select("vertex", "first", F.coalesce("root", "vertex").alias("root"))
    rooted = scratch.write(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    components = rooted.join(smallest, "root").select("vertex", "component_id")
    return rows.join(components, "vertex").select(
        "doc_id", "code", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


@register("op12_simhash")
def op12_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("code")
