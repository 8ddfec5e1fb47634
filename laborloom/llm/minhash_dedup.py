"""Near-duplicates by MinHash bands, odd sketches and a check on full shingle sets.

Texts with the same shingle set form a class. Each class has SAMPLES MinHash values; bands
of ROWS of them bring candidates together, and the values folded into a bitmap of parities
(odd sketch) estimate a pair's similarity from the population count of its XOR. Pairs whose
estimate is far below the threshold go; the others are compared on their full sets.

No bucket is spelled out in pairs. Its members are first compared with its smallest member
only and the links so found merged into components. Members of one component need no
further comparison; where a bucket still holds several, their members are packed into blocks, one row
each, which are compared two by two. Pairs that pass the sketch are compared on their full sets in
the task, and only links that join components not yet joined there leave it.
A pair of similarity 0.8 misses all bands with probability 3e-6. A node with very many pairs is
joined with them in parts, each with its own copy of the node's sketch or set.

A-Z are lower-cased, words are runs without space or ``\\x09-\\x0D``, a set holds the distinct
runs of ``words`` words or, for shorter texts, all words as one. Empty and null texts have
no shingles and no links. Rows that share a doc_id count as one document, null included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborloom.llm import texthash as th
from laborloom.llm.bloom import blocks_for, bloom_filter, tested
from laborloom.llm.shared import components, join_groups, saved, ship, with_bounds

BANDS, ROWS = 32, 5
#: The first BANDS * ROWS samples make the bands, all of them the sketch.
SAMPLES = 640
SKETCH_BITS = 2048
#: Largest population count of a pair's XOR that is compared on full sets: 227 is expected at
#: a similarity of 0.8, with a standard deviation of 18; 308 stands for about 0.71.
MOST_ODD = 308
PERCENT = 80
#: Members of a bucket in one block, and pairs of a node that share one copy of its sketch or set.
IN_BLOCK, IN_PART = 4096, 512
LAST = (1 << 63) - 1
_rng = np.random.default_rng(20_240_229)
FACTORS = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for first, last in th.blocks(texts):
        hashes, bounds = th.word_hashes(texts[first:last], lower=True)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = hashes[a:b]
            out.append(np.unique(th.window_hashes(own, min(words, len(own)))) if len(own) else own)
    return out


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """SAMPLES values for each non-empty set."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), SAMPLES), dtype=np.uint64)
    for i in range(SAMPLES):
        out[:, i] = np.minimum.reduceat(joined * FACTORS[i] + OFFSETS[i], starts)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples as 64-bit words."""
    where = th.mixed(samples + np.arange(SAMPLES, dtype=np.uint64) * np.uint64(th.BASE)) % np.uint64(SKETCH_BITS)
    out = np.zeros((len(samples), SKETCH_BITS // 64), dtype=np.uint64)
    rows = np.repeat(np.arange(len(samples)), SAMPLES)
    where = where.ravel()
    np.bitwise_xor.at(out, (rows, (where >> np.uint64(6)).astype(np.int64)),
                      np.uint64(1) << (where & np.uint64(63)))
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.empty((len(samples), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        part = samples[:, band * ROWS:(band + 1) * ROWS]
        total = np.full(len(samples), band + 1, dtype=np.uint64)
        for j in range(ROWS):
            total = th.mixed(total * np.uint64(th.BASE) + part[:, j])
        keys[:, band] = total
    return keys


def _lists(values: np.ndarray) -> pa.Array:
    """A matrix as an array of lists of longs."""
    flat = pa.array(np.ascontiguousarray(values).view(np.int64).ravel())
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], flat)


def row_key() -> Column:
    """Tells rows apart by id and text; those alike in both share it and their fate."""
    return F.xxhash64(F.coalesce("doc_id", F.lit(LAST)), "text")


def features(docs: DataFrame, words: int) -> DataFrame:
    """(key, doc, n_shingles, set, bands, sketch) of every text; ``set`` is a 128-bit name of the set."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, texts = batch.column("key"), batch.column("doc"), th.texts_of(batch)
            for first, last in th.blocks(texts):
                sets = shingle_sets(texts[first:last], words)
                full = [i for i, s in enumerate(sets) if len(s)]
                names = [b"".join([th.mixed(s).sum(dtype=np.uint64).tobytes(),
                                   th.mixed(s ^ np.uint64(th.BASE)).sum(dtype=np.uint64).tobytes()]) for s in sets]
                bands = np.zeros((len(sets), BANDS), dtype=np.uint64)
                sketches = np.zeros((len(sets), SKETCH_BITS // 64), dtype=np.uint64)
                if full:
                    samples = min_hashes([sets[i] for i in full])
                    bands[full], sketches[full] = band_keys(samples), odd_sketches(samples)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, last - first), ids.slice(first, last - first),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(names, pa.binary()), _lists(bands), _lists(sketches)],
                    ["key", "doc", "n_shingles", "set", "bands", "sketch"])

    return docs.select("key", "doc", "text").mapInArrow(
        each, "key long, doc long, n_shingles long, set binary, bands array<long>, sketch array<long>")


def with_sides(pairs: DataFrame, nodes: DataFrame, value: str) -> DataFrame:
    """Saved ``pairs`` (a, b) with the ``value`` of both, as value_a and value_b.

    A node's pairs are cut into parts of about IN_PART, and its value is copied once for each, so a
    node with very many pairs is many tasks' work. Only ids move to cut them.
    """
    placed, total, copies = pairs, pairs.count(), {}
    for side, other in ("a", "b"), ("b", "a"):
        sizes = saved(pairs.groupBy(side).agg(F.count(F.lit(1)).alias("own_pairs")))
        part, parts = f"part_{side}", F.ceil(F.col("own_pairs") / IN_PART).cast("int")
        placed = join_groups(placed, sizes, side, "own_pairs", total).withColumn(
            part, F.pmod(F.xxhash64(other), parts).cast("int")).drop("own_pairs")
        copies[side] = nodes.select(F.col("node").alias(side), F.col(value).alias(f"{value}_{side}")).join(sizes, side) \
            .withColumn(part, F.explode(F.sequence(F.lit(0), parts - 1))).drop("own_pairs")
    both = saved(placed).join(copies["b"], ["b", "part_b"]).join(copies["a"], ["a", "part_a"])
    return both.select("a", "b", f"{value}_a", f"{value}_b")


def close_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of saved ``pairs`` (a, b) those whose sketches differ in at most MOST_ODD bits."""
    odd = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                      F.lit(0), lambda total, n: total + n)
    return with_sides(pairs, classes, "sketch").where(odd <= MOST_ODD).select("a", "b")


def full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(key, node, shingles) of the classes in ``nodes`` (node): the sorted shingle hashes of
    the text of each class's first row."""
    wanted = saved(classes.select("node", F.col("head.key").alias("key")).join(nodes, "node", "left_semi"))
    blocks = blocks_for(wanted.count())
    maybe = tested(docs, "key", saved(bloom_filter(wanted, "key", blocks)), blocks).where("maybe")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(th.texts_of(batch), words)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], ["key", "shingles"])

    return saved(maybe.select("key", "text").join(wanted, "key", "left_semi")
                 .mapInArrow(shingled, "key long, shingles binary").dropDuplicates(["key"]).join(wanted, "key"))


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of saved ``pairs`` of classes those with the wanted similarity of their full sets, which
    the text of each class's first row gives."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = full_sets(nodes, classes, docs, words)

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return with_sides(pairs, sets.withColumnRenamed("shingles", "set"), "set").mapInArrow(similar, "a long, b long")


PAIR = "a long, b long"
MEMBER = ["node", "component", "sketch", "bands"]


def _members(table: pa.Table) -> list:
    """MEMBER of some rows, a row of words each for sketches and bands, and their full sets."""
    nodes = [table.column(c).to_numpy() for c in MEMBER[:2]]
    return nodes + [table.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(table.num_rows, -1)
                    for c in MEMBER[2:]] + [[np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in table.column("shingles")]]


def _close(key: int, x: list, y: list, same: bool, percent: int) -> pa.Table:
    """Links between members of different components, one from ``x`` and one from ``y``, with
    close sketches and the wanted similarity of their full sets.

    Components that a link found here has joined are one: of their pairs none is compared or
    sent any more, so no more links leave the task than it has members.
    """
    (node_x, component_x, sketch_x, bands_x, sets_x), (node_y, component_y, sketch_y, bands_y, sets_y) = x, y
    # Of the buckets that two share, the first one speaks for the pair; this bucket is of that band.
    band = int(np.flatnonzero((bands_x == np.int64(key).view(np.uint64)).all(axis=0))[0])
    up: dict[int, int] = {}

    def top(c: int) -> int:
        while c in up:
            c = up[c]
        return c

    first, second = [], []
    for i in range(len(node_x)):
        odd = np.bitwise_count(sketch_y ^ sketch_x[i]).sum(axis=1, dtype=np.int64)
        hit = np.flatnonzero((odd <= MOST_ODD) & (component_y != component_x[i]))
        if same:
            hit = hit[node_y[hit] > node_x[i]]
        hit = hit[(bands_y[hit, :band] != bands_x[i, :band]).all(axis=1)]
        for j in hit.tolist():
            own, other = top(int(component_x[i])), top(int(component_y[j]))
            if own == other:
                continue
            both = len(np.intersect1d(sets_x[i], sets_y[j], assume_unique=True))
            if 100 * both >= percent * (len(sets_x[i]) + len(sets_y[j]) - both):
                up[max(own, other)] = min(own, other)
                first.append(min(int(node_x[i]), int(node_y[j])))
                second.append(max(int(node_x[i]), int(node_y[j])))
    return pa.table({"a": pa.array(first, pa.int64()), "b": pa.array(second, pa.int64())})


def _packed(table: pa.Table) -> pa.Table:
    """A block's members as one row; the full sets one after another, with their sizes."""
    one = table.select(["key", "own", "blocks"]).slice(0, 1)
    members = _members(table)
    for name, values in zip(MEMBER, members[:-1], strict=True):
        one = one.append_column(name, pa.array([values.tobytes()], pa.binary()))
    sets = members[-1]
    one = one.append_column("sizes", pa.array([np.array([len(v) for v in sets], dtype=np.int64).tobytes()], pa.binary()))
    return one.append_column("shingles", pa.array([b"".join(v.tobytes() for v in sets)], pa.binary()))


def _unpacked(table: pa.Table, i: int) -> list:
    m = [np.frombuffer(table.column(c)[i].as_buffer(), dtype=kind) for c, kind in
         zip(MEMBER, [np.int64, np.int64, np.uint64, np.uint64], strict=True)]
    sizes = np.frombuffer(table.column("sizes")[i].as_buffer(), dtype=np.int64)
    joined = np.frombuffer(table.column("shingles")[i].as_buffer(), dtype=np.uint64)
    sets = np.split(joined, np.cumsum(sizes)[:-1]) if len(sizes) else []
    return [*m[:2], *(words.reshape(len(m[0]), -1) for words in m[2:]), sets]


def _between_components(entries: DataFrame, found: DataFrame, classes: DataFrame, docs: DataFrame,
                        words: int, percent: int) -> DataFrame:
    """Links (a, b) of different components that share a bucket, have close sketches and the
    wanted similarity of their full sets; enough of them to join what all such links join."""
    labelled = saved(entries.join(found, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")))
    mixed = saved(with_bounds(labelled, "key", "component").where("lo < hi").select("key", "node", "component"))
    # A bucket of two has been compared already.
    sizes = saved(mixed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 2"))
    placed = join_groups(mixed, sizes, "key", "members", mixed.count()).withColumn(
        "blocks", F.ceil(F.col("members") / IN_BLOCK).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    sets = full_sets(placed.select("node").distinct(), classes, docs, words).select("node", "shingles")
    members = saved(placed.join(classes.select("node", "sketch", "bands"), "node").join(sets, "node")
                    .select("key", "blocks", "own", *MEMBER, "shingles"))

    def within_blocks(table: pa.Table) -> pa.Table:
        members = _members(table)
        return _close(table.column("key")[0].as_py(), members, members, True, percent)

    def between_blocks(table: pa.Table) -> pa.Table:
        """Of two packed blocks of a bucket, or none where one has no members."""
        if table.num_rows < 2:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        return _close(table.column("key")[0].as_py(), _unpacked(table, 0), _unpacked(table, 1), False, percent)

    within = members.groupBy("key", "own").applyInArrow(within_blocks, PAIR)
    # A block is sent once to each other block of its bucket.
    packed = saved(members.where("blocks > 1").groupBy("key", "own").applyInArrow(
        _packed, "key long, own int, blocks int, node binary, component binary, sketch binary, bands binary, "
                 "sizes binary, shingles binary"))
    sent = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("other <> own").select(
        "key", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), *MEMBER,
        "sizes", "shingles")
    between = sent.groupBy("key", "left", "right").applyInArrow(between_blocks, PAIR)
    return within.unionByName(between).distinct()


def grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per document: key, doc, n_shingles and ``top``, the least (doc, key) that links reach.

    Texts with equal sets are a class, numbered when the classes are written; links, stars and
    components are between classes, so rows that share an id neither lend nor lose links.
    """
    ship(docs.sparkSession)
    rows = docs.select(row_key().alias("key"), F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text")
    described = saved(features(rows, words))
    # Numbered in the order of their first rows, as the smallest member of a bucket is its hub: the
    # earliest of many near copies is the likeliest to be near them all.
    classes = saved(described.where("n_shingles > 0").groupBy("set").agg(
        F.min(F.struct("doc", "key")).alias("head"), F.count(F.lit(1)).alias("copies"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .repartitionByRange("head").sortWithinPartitions("head").withColumn("node", F.monotonically_increasing_id()))
    buckets = saved(classes.select(F.explode("bands").alias("key"), "node"))
    entries = saved(with_bounds(buckets, "key", "node").where("lo < hi").select("key", "node", "lo"))
    stars = saved(entries.where("node > lo").select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct())
    links = saved(confirmed(saved(close_sketches(stars, classes)), classes, rows, words, percent))
    found = components(links)
    # Links found in the blocks are confirmed there; no pair of a crowded bucket is spelled out.
    more = saved(_between_components(entries.select("key", "node"), found, classes, rows, words, percent))
    if not more.isEmpty():
        found = components(links.unionByName(more))
    placed = saved(classes.select("set", "copies", "head", "node").join(found, "node", "left").select(
        "set", "copies", "head", F.coalesce("component", "node").alias("component")))
    tops = saved(placed.groupBy("component").agg(F.min("head").alias("top"), F.count(F.lit(1)).alias("members")))
    named = saved(join_groups(placed, tops, "component", "members", placed.count()).select("set", "copies", "top"))
    thin = described.select("key", "doc", "n_shingles", "set")
    full = join_groups(thin.where("n_shingles > 0"), named, "set", "copies", described.count())
    empty = thin.where("n_shingles = 0").withColumn("top", F.struct("doc", "key"))
    columns = ["key", "doc", "n_shingles", "top"]
    return full.select(*columns).unionByName(empty.select(*columns))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links
    reach, its own included) and kept, which is true where the two ids are the same."""
    id_of = lambda c: F.when(c != LAST, c)
    top = F.col("top.doc")
    return grouped(docs, words, percent).select(
        id_of(F.col("doc")).alias("doc_id"), "n_shingles", id_of(top).alias("component_id"),
        (F.col("doc") == top).alias("kept"))


def survivors(docs: DataFrame, words: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id, all columns as they came.

    Of several texts under that id, or without ids, one stays too; rows alike in id and text stay
    or go together. Only texts of documents that may have to go shuffle.
    """
    gone = saved(grouped(docs, words, percent).where("key <> top.key").select("key").distinct())
    blocks = blocks_for(gone.count())
    rows = docs.select(F.struct("*").alias("row"), row_key().alias("key"))
    marked = tested(rows, "key", saved(bloom_filter(gone, "key", blocks)), blocks)
    kept = marked.where(~F.col("maybe")).select("row")
    left = marked.where("maybe").join(gone, "key", "left_anti").select("row")
    return kept.unionByName(left).select("row.*")
