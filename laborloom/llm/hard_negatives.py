"""Hard negatives for anchors, scored exactly by lookups in tables of subset sums.

Vectors become whole numbers and are packed as bit planes: plane j holds bit j of every component
in two's complement, one byte for eight dimensions. For each group of eight dimensions an anchor
has a table of the sums of all 256 subsets of its components there. A candidate's byte picks the
sum of the dimensions whose bit is set; the sums of a plane over all groups are added to the
doubled total of the planes above it, the topmost one negative, which gives the inner product.

Anchors meet all rows in a grid: rows are dealt into parts of bounded size, anchors too, and a
task has one part of each. It keeps its rows packed and lets the anchors pass in blocks; only the
best few rows of each anchor leave it. The first pass finds each anchor's positives, the second
the negatives in the range that each positive's score sets.

Positives are the best ``n_positives`` other rows of the anchor's label, negatives the best
``n_negatives`` rows of other labels with ``low`` % to ``high`` % of the positive's score; equal
scores go by smaller id. Rows without an id, label or vector, or with a component that is null or
not finite, take no part; components missing at the end of a shorter vector count as 0, as do all
of an empty one. Rows with the anchor's id are not its positives or negatives. Anchors alike in
id, label and vector are one anchor; other repeated rows count each. Scores past 62 bits raise.
Other columns are not read. No rows or no anchors give no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laborloom.llm.shared import partitions, saved, ship

SCALE = 256
N_POSITIVES, N_NEGATIVES = 5, 10
LOW, HIGH = 30, 90
#: Packed bytes and rows in a part of the grid, and the fewest rows that are worth a part.
PART_BYTES, PART_ROWS, LEAST_ROWS = 1 << 25, 1 << 18, 1 << 11
ANCHOR_ROWS = 1 << 15
#: Anchors and rows that are scored at once.
ANCHOR_BLOCK, ROW_BLOCK, SELECT_BLOCK = 256, 1024, 8192
PACKED_SCHEMA = "vec_id long, label long, groups int, planes binary"
POSITIVE_SCHEMA = "anchor long, positive_id long, positive_score long"
NEGATIVE_SCHEMA = "anchor long, place int, negative_id long, negative_score long"


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(rows, planes, groups) bytes of whole numbers (rows, dimensions) in two's complement."""
    most = int(np.where(values < 0, ~values, values).max(initial=0))
    planes, groups = most.bit_length() + 1, -(-values.shape[1] // 8)
    out = np.zeros((len(values), planes, groups), dtype=np.uint8)
    for j in range(planes):
        out[:, j] = np.packbits((values >> j & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def common_planes(packed: list[bytes], groups: np.ndarray) -> np.ndarray:
    """Bit planes of rows packed with different numbers of planes and groups, in one array."""
    sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed))
    planes = np.where(groups > 0, sizes // np.maximum(groups, 1), 1)
    out = np.zeros((len(packed), int(planes.max(initial=1)), int(groups.max(initial=0))), dtype=np.uint8)
    for p, g in set(zip(planes.tolist(), groups.tolist(), strict=True)):
        rows = np.flatnonzero((planes == p) & (groups == g))
        if g:
            given = np.frombuffer(b"".join(packed[i] for i in rows.tolist()), dtype=np.uint8).reshape(-1, p, g)
            out[rows, :p, :g] = given
            out[rows, p:, :g] = given[:, -1:]  # the sign goes on
    return out


def whole_numbers(planes: np.ndarray) -> np.ndarray:
    """(rows, dimensions) of bit planes."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weights = 1 << np.arange(planes.shape[1], dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.einsum("rpd,p->rd", bits, weights)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): for each byte the sum of the components whose bit is set."""
    groups = anchors.shape[1] // 8
    out = np.zeros((groups, 256, len(anchors)), dtype=kind)
    for g in range(groups):
        for bit in range(8):
            np.add(out[g, :1 << bit], anchors[:, 8 * g + bit], out=out[g, 1 << bit:2 << bit], casting="unsafe")
    return out


def scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors): exact inner products of whole-numbered anchors with rows of bit planes."""
    groups = min(anchors.shape[1] // 8, planes.shape[2])
    bound = 8 * groups * int(np.abs(anchors).max(initial=0)) << planes.shape[1]
    if bound >= 1 << 62:
        raise OverflowError("the scores of such large components do not fit a long")
    kind = np.int32 if bound < 1 << 30 else np.int64
    tables = subset_sums(anchors[:, :8 * groups], kind)
    out = np.zeros((len(planes), len(anchors)), dtype=kind)
    for first in range(0, len(planes), ROW_BLOCK):
        some, total = planes[first:first + ROW_BLOCK], out[first:first + ROW_BLOCK]
        found = np.empty_like(total)
        for j in range(planes.shape[1] - 1, -1, -1):
            for g in range(groups):
                np.take(tables[g], some[:, j, g], axis=0, out=found, mode="clip")
                total += found
            if j == planes.shape[1] - 1:
                np.negative(total, out=total)
            if j:
                total <<= 1
    return out


def packed(vectors: DataFrame, label: Column | str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, groups, planes) of the rows that take part; components are floor(scale * x)."""
    ship(vectors.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            if len(flat) and np.abs(flat).max() >= 1 << 61:
                raise OverflowError("the scores of such large components do not fit a long")
            ends = np.cumsum(lengths)
            rows: list[bytes] = [b""] * len(lengths)
            for size in set(lengths.tolist()) - {0}:
                at = np.flatnonzero(lengths == size)
                values = flat.astype(np.int64)[(ends[at] - size)[:, None] + np.arange(size)]
                for i, row in zip(at.tolist(), bit_planes(values), strict=True):
                    rows[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(-(-lengths // 8), pa.int32()),
                 pa.array(rows, pa.binary())], ["vec_id", "label", "groups", "planes"])

    given = vectors.select(
        F.col("vec_id").cast("long"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.col("embedding").cast("array<double>"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return given.where(usable).where(~odd).mapInArrow(each, PACKED_SCHEMA)


def _grid(rows: DataFrame, anchors: DataFrame, extra: str) -> DataFrame:
    """Every part of the saved ``rows`` with every part of the saved ``anchors``, a partition each, rows first."""
    size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("planes"))).first()
    spread = min(partitions(rows.sparkSession), ceil(size[0] / LEAST_ROWS))
    across = max(1, spread, ceil(size[0] / PART_ROWS), ceil((size[1] or 0) / PART_BYTES))
    down = max(1, ceil(anchors.count() / ANCHOR_ROWS))
    part = lambda c, n: F.pmod(F.col(c), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["vec_id", "label", "groups", "planes"]
    left = rows.select(*columns, F.lit(None).cast("long").alias("anchor"), F.lit(None).cast(extra).alias("extra"),
                       part("ordinal", across).alias("column"), every(down).alias("row"))
    right = anchors.select(*columns, "anchor", F.col("extra").cast(extra), part("anchor", down).alias("row"), every(across).alias("column"))
    cell = (F.col("column") * down + F.col("row")).cast("int")
    return left.unionByName(right).withColumn("cell", cell).repartitionById(across * down, "cell").sortWithinPartitions(
        F.col("anchor").isNotNull(), "vec_id", "anchor").select(*columns, "anchor", "extra")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """A cell's rows (ids, labels, planes) by id, with one block of its anchors after another."""
    kept: list[tuple] = []
    rows = None
    for batch in batches:
        flag = batch.column("anchor").is_valid().to_numpy(zero_copy_only=False)
        first = int(flag.argmax()) if flag.any() else len(flag)
        if first:
            kept.append(batch.slice(0, first))
        for start in range(first, batch.num_rows, ANCHOR_BLOCK):
            if rows is None:
                rows, kept = _read(kept), []
            yield rows, batch.slice(start, ANCHOR_BLOCK)


def _read(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, groups = (np.concatenate([np.zeros(0, dtype=np.int64), *(b.column(c).to_numpy() for b in batches)])
                           for c in ("vec_id", "label", "groups"))
    return ids, labels, common_planes([p for b in batches for p in b.column("planes").to_pylist()], groups)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(anchors' batch, ids, labels, scores by anchor and row) of a cell, block by block."""
    for (ids, labels, planes), batch in _blocks(batches):
        anchors = whole_numbers(_read([batch])[2])
        for first in range(0, len(ids), SELECT_BLOCK):
            part = slice(first, first + SELECT_BLOCK)
            yield batch, ids[part], labels[part], np.ascontiguousarray(scores(anchors, planes[part]).T)


def _best(place: np.ndarray, values: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Of the places the ``n`` with the greatest values, then the smallest ids."""
    if len(place) > 4 * n:
        least = np.partition(values[place], len(place) - n)[len(place) - n]
        place = place[values[place] >= least]
    return place[np.lexsort((ids[place], -values[place].astype(np.int64)))[:n]]


def positives(rows: DataFrame, anchors: DataFrame, n: int = N_POSITIVES) -> DataFrame:
    """(anchor, positive_id, positive_score): the ``n`` best other rows of each anchor's label."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, labels, found in _scored(batches):
            out = []
            for anchor, own, label, values in zip(
                    *(batch.column(c).to_pylist() for c in ("anchor", "vec_id", "label")), found, strict=True):
                place = _best(np.flatnonzero((labels == label) & (ids != own)), values, ids, n)
                out.append((np.full(len(place), anchor), ids[place], values[place].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                             ["anchor", "positive_id", "positive_score"])

    best = W.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    grid = _grid(rows, anchors.withColumn("extra", F.lit(None)), "long")
    return grid.mapInArrow(each, POSITIVE_SCHEMA).withColumn("place", F.row_number().over(best)).where(
        F.col("place") <= n)


def negatives(rows: DataFrame, anchors: DataFrame, n: int = N_NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor, place, rank, negative_id, negative_score) for saved ``anchors`` with their positives'
    scores in ``extra``; ``place`` numbers the scores from 0."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, labels, found in _scored(batches):
            out = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32), *[np.zeros(0, dtype=np.int64)] * 2)]
            for anchor, own, label, limits, values in zip(
                    *(batch.column(c).to_pylist() for c in ("anchor", "vec_id", "label", "extra")), found, strict=True):
                # low * p <= 100 * s <= high * p, in whole numbers
                ranges = [(-(-low * p // 100), high * p // 100) for p in limits]
                least, most = min(r[0] for r in ranges), max(r[1] for r in ranges)
                near = np.flatnonzero((values >= least) & (values <= most) & (labels != label) & (ids != own))
                for i, (a, b) in enumerate(ranges if len(near) else []):
                    place = _best(near[(values[near] >= a) & (values[near] <= b)], values, ids, n)
                    out.append((np.full(len(place), anchor), np.full(len(place), i, dtype=np.int32), ids[place],
                                values[place].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                             ["anchor", "place", "negative_id", "negative_score"])

    best = W.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    return _grid(rows, anchors, "array<long>").mapInArrow(each, NEGATIVE_SCHEMA).withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= n)


def mined(vectors: DataFrame, is_anchor: Column, label: Column | str = "label", n_positives: int = N_POSITIVES,
          n_negatives: int = N_NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hard negatives
    of every anchor and positive. ``is_anchor`` is a condition on vec_id."""
    # Numbered once and written, so that every reader sees the same numbers.
    rows = saved(packed(vectors, label, scale).withColumn("ordinal", F.monotonically_increasing_id()))
    anchors = saved(rows.where(is_anchor).drop("ordinal").distinct().withColumn("anchor", F.monotonically_increasing_id()))
    found = saved(positives(rows, anchors, n_positives))
    lists = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "place", "positive_id", "positive_score"))).alias("found"))
    paired = saved(anchors.join(lists, "anchor").withColumn("extra", F.col("found.positive_score")))
    mined_rows = negatives(rows, paired, n_negatives, low, high)
    named = paired.select("anchor", F.col("vec_id").alias("anchor_id"), "found")
    positive = F.col("found")[F.col("place")]
    return mined_rows.join(named, "anchor").select(
        "anchor_id", positive["positive_id"].alias("positive_id"), "rank", "negative_id",
        positive["positive_score"].alias("positive_score"), "negative_score")
