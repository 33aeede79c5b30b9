"""Near-duplicate documents: an exact Jaccard join of word-shingle sets around pivots.

The distance 1 - J is a metric, but unrelated texts all lie at distance 1 from one another, so cells
around a few sampled pivots would hold every text on their boundary. Regions are therefore local:
each rare shingle opens one, a text joins the regions of the shingles that any set within the
threshold must share with it, and the region's least document is its pivot. Then

1. every document is measured against the pivots of its regions, as far as their sets can overlap
   enough after the places of the shingle; those near one make its cell;
2. regions that hold one cell alone are done, whatever their size. In the others every document is
   measured against a neighbour of another cell, in an order that changes from round to round, until
   a round joins no cells any more or a few rounds are over;
3. regions that still hold several cells are joined exactly: all pairs of documents of different
   cells inside the window that the triangle inequality leaves (their distances to the pivot differ
   by the threshold at most), as far as their sets can overlap enough.

Bit signatures bound distances from below before any set is fetched; what they leave is counted
exactly. Nothing is sampled and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulback.llm.arrays import LOWER, distinct, gram_hashes, list_array, text_blocks, word_bounds, word_hashes
from haulback.llm.components import connected_components
from haulback.llm.numbering import number_texts
from haulback.llm.shipping import ship_package
from haulback.operators.lineage import clear_work, cut_lineage, work_folder

Keep = Callable[[DataFrame], DataFrame]
_ID_BITS = 52
_TOKEN_BITS = 48


class Settings(NamedTuple):
    words: int = 5
    #: Two documents link when 100 * intersection >= percent * union.
    percent: int = 75
    #: Counters of the sketch that orders shingles from rare to frequent; any order gives the same
    #: links, a finer one smaller regions.
    counters: int = 1 << 22
    #: Rounds of step 2 at most; they save work in step 3, which is exact by itself.
    rounds: int = 1
    #: Sets are fetched by a broadcast of the documents asked for up to this many, else by a shuffle.
    broadcast_docs: int = 200_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, sorted, one row after the other; and how many each has.

    A shingle is known by 52 bits of its hash. A row of fewer than ``k`` words has one shingle of
    all of them, and none without a word.
    """
    rows = len(offsets) - 1
    data = LOWER[data]
    starts, ends = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    cuts = np.searchsorted(starts, offsets)
    count = np.diff(cuts)
    row = np.repeat(np.arange(rows), count)
    grams = gram_hashes(words, k)
    inside = np.flatnonzero(np.arange(len(grams)) + k <= cuts[1:][row[: len(grams)]])
    ids, owner = [grams[inside] >> np.uint64(64 - _ID_BITS)], [row[inside]]
    for n in range(1, k):
        short = np.flatnonzero(count == n)
        if len(short):
            ids.append(gram_hashes(words, n)[cuts[short]] >> np.uint64(64 - _ID_BITS))
            owner.append(short)
    ids, owner = np.concatenate(ids), np.concatenate(owner).astype(np.uint64)
    keys = distinct((owner << np.uint64(_ID_BITS)) | ids)
    sizes = np.bincount((keys >> np.uint64(_ID_BITS)).astype(np.int64), minlength=rows)
    return keys & np.uint64((1 << _ID_BITS) - 1), sizes


def _set_names(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's set."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        x = (ids + np.uint64(1)) * np.uint64(salt)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        sums = np.zeros(len(sizes), np.uint64)
        np.add.at(sums, owner, x)
        out.append(sums.view(np.int64))
    return out[0], out[1]


def _signatures(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Of each row a bit array of two to four bits a shingle: the parity of the shingles on each bit."""
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64))
    first = np.cumsum(bits) - bits
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = first[owner] + (ids.astype(np.int64) & (bits[owner] - 1))
    packed = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8))
    body = packed.tobytes()
    return [body[f // 8 : (f + b) // 8] for f, b in zip(first.tolist(), bits.tolist(), strict=True)]


def least_distance(n: int, bits: bytes, m: int, other: bytes) -> float:
    """A lower bound of the distance of two sets, by their sizes and signatures."""
    a, b = np.frombuffer(bits, np.uint8), np.frombuffer(other, np.uint8)
    size = min(len(a), len(b))
    a = np.bitwise_xor.reduce(a.reshape(-1, size), 0)
    b = np.bitwise_xor.reduce(b.reshape(-1, size), 0)
    apart = int(np.bitwise_count(a ^ b).sum())
    common = min(n, m, (n + m - apart) // 2)
    return 1 - common / (n + m - common)


def document_sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """Rows (doc, n, name, name2, bits) of each text's shingle set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            ids, sizes = shingle_sets(data, offsets, settings.words)
            name, name2 = _set_names(ids, sizes)
            bits = pa.array(_signatures(ids, sizes), pa.binary())
            columns = [rows.column(0), *map(pa.array, (sizes, name, name2)), bits]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "name", "name2", "bits"])

    return docs.mapInArrow(describe, "doc long, n long, name long, name2 long, bits binary")


def _distinct_sets(
    rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles and sizes of a block's rows, copies of a set left out but for the least document."""
    ids, sizes = shingle_sets(data, offsets, k)
    name, name2 = _set_names(ids, sizes)
    doc = rows.column(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((doc, sizes, name2, name))
    same = np.zeros(len(order), bool)
    same[1:] = (
        (name[order][1:] == name[order][:-1])
        & (name2[order][1:] == name2[order][:-1])
        & (sizes[order][1:] == sizes[order][:-1])
    )
    stay = np.zeros(len(order), bool)
    stay[order[~same]] = True
    keep = np.repeat(stay, sizes)
    return ids[keep], np.where(stay, sizes, 0), doc


def shingle_ranks(docs: DataFrame, settings: Settings, keep: Keep = cut_lineage) -> np.ndarray:
    """A sketch over all texts of how frequent shingles are: by counter 0 (usual) to 15 (very).

    Its size is fixed: a slice of counters is summed in one task as the other tasks' slices come, and
    a byte for each counter reaches the driver.
    """
    size, piece = settings.counters, min(settings.counters, 1 << 16)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(size, np.int64), []
        for rows, data, offsets in text_blocks(batches, "text"):
            seen.append(_counter(_distinct_sets(rows, data, offsets, settings.words)[0], size))
            if 4 * sum(map(len, seen)) > size:
                counts += np.bincount(np.concatenate(seen), minlength=size)
                seen = []
        if seen:
            counts += np.bincount(np.concatenate(seen), minlength=size)
        short = np.minimum(counts, 255).astype(np.uint8)
        parts = [short[i : i + piece].tobytes() for i in range(0, size, piece)]
        columns = [pa.array(np.arange(len(parts))), pa.array(parts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                more = np.frombuffer(part, np.uint8)
                sums[i] = sums.get(i, np.zeros(piece, np.int64)) + more
        if sums:
            parts = pa.array([s.tobytes() for s in sums.values()], pa.binary())
            total = pa.array([int(s.sum()) for s in sums.values()])
            columns = [pa.array(list(sums)), parts, total]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "counts", "total"])

    schema = "slice long, counts binary"
    sketched = docs.mapInArrow(sketch, schema).repartition("slice")
    summed = keep(sketched.mapInArrow(add, schema + ", total long"))
    usual = max(8.0, 2 * (summed.agg(F.sum("total")).first()[0] or 0) / size)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.maximum(np.frombuffer(part, np.int64), 1)
                ranks = np.clip(np.floor(np.log2(counts / usual)) + 1, 0, 15).astype(np.uint8)
                columns = [pa.array([i]), pa.array([ranks.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["slice", "counts"])

    out = np.zeros(size, np.uint8)
    for r in summed.select("slice", "counts").mapInArrow(rank, schema).collect():  # one row a slice
        out[r.slice * piece : (r.slice + 1) * piece] = np.frombuffer(r.counts, np.uint8)
    return out


def _counter(ids: np.ndarray, size: int) -> np.ndarray:
    return ((ids >> np.uint64(_ID_BITS - _TOKEN_BITS)) % np.uint64(size)).astype(np.int64)


def region_members(docs: DataFrame, settings: Settings, keep: Keep = cut_lineage) -> DataFrame:
    """Rows (token, doc, n, place, pivot, pivot_n, pivot_place) of the regions that several documents share.

    Sets of Jaccard similarity t share a shingle among the rarest n - ceil(t * n) + 1 of either, so
    a document joins the regions of that many; ``place`` is the shingle's among all of the document,
    from the rarest on. Copies within a task join once.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(shingle_ranks(docs, settings, keep))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            ids, sizes, doc = _distinct_sets(rows, data, offsets, settings.words)
            owner = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
            rank = ranks.value[_counter(ids, settings.counters)].astype(np.uint64)
            token = (rank << np.uint64(_TOKEN_BITS)) | (ids >> np.uint64(_ID_BITS - _TOKEN_BITS))
            keys = np.sort((owner << np.uint64(_ID_BITS)) | token)
            prefix = np.where(sizes > 0, sizes - (settings.percent * sizes + 99) // 100 + 1, 0)
            at = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = at < np.repeat(prefix, sizes)
            row = np.repeat(np.arange(len(sizes)), sizes)[keep]
            token = (keys[keep] & np.uint64((1 << _ID_BITS) - 1)).view(np.int64)
            columns = [pa.array(x) for x in (token, doc[row], sizes[row], at[keep])]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "doc", "n", "place"])

    found = docs.mapInArrow(members, "token long, doc long, n long, place long")
    region = Window.partitionBy("token")
    least = F.min(F.struct("doc", "n", "place")).over(region)
    shared = found.withColumns({"p": least, "size": F.count("*").over(region)}).filter("size > 1")
    pivot = [F.col(f"p.{c}").alias(f"pivot{tail}") for c, tail in (("doc", ""), ("n", "_n"), ("place", "_place"))]
    return shared.select("token", "doc", "n", "place", *pivot)


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Add to rows (a, b) the lower bound ``low`` of their distance, by signatures."""
    one = sets.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    two = sets.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[2:]]
            low = pa.array([least_distance(*x) for x in zip(*columns, strict=True)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], low], names=["a", "b", "low"])

    joined = pairs.select("a", "b").join(one, "a").join(two, "b")
    return joined.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(bound, "a long, b long, low double")


def _measured(pairs: DataFrame, docs: DataFrame, settings: Settings, keep: Keep) -> DataFrame:
    """Add to rows (a, b) the sizes of their sets' intersection and union."""
    wanted = keep(pairs.select(F.explode(F.array("a", "b")).alias("wanted")).distinct())
    if wanted.count() <= settings.broadcast_docs:
        wanted = F.broadcast(wanted)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            ids, sizes = shingle_sets(data, offsets, settings.words)
            columns = [rows.column(0), list_array(ids.view(np.int64), sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "ids"])

    named = docs.join(wanted, docs["doc"] == F.col("wanted"), "left_semi")
    found = keep(named.mapInArrow(sets, "doc long, ids array<long>").dropDuplicates(["doc"]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, union = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                common.append(both)
                union.append(len(x) + len(y) - both)
            columns = [*batch.columns[:2], pa.array(common, pa.int64()), pa.array(union, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "common", "union"])

    one = found.select(F.col("doc").alias("a"), F.col("ids").alias("ids_a"))
    two = found.select(F.col("doc").alias("b"), F.col("ids").alias("ids_b"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "ids_a", "ids_b")
    return joined.mapInArrow(compare, "a long, b long, common long, union long")


def _distances(pairs: DataFrame, sets: DataFrame, docs: DataFrame, settings: Settings, keep: Keep) -> DataFrame:
    """Rows (a, b, low, high, linked): bounds of the distance, which are alike where it was measured."""
    bounded = keep(_bounded(pairs, sets))
    most = 1 - settings.percent / 100
    measured = _measured(bounded.filter(F.col("low") <= most + 1e-9), docs, settings, keep)
    exact = 1 - F.col("common") / F.col("union")
    linked = 100 * F.col("common") >= settings.percent * F.col("union")
    near = measured.select("a", "b", exact.alias("low"), exact.alias("high"), linked.alias("linked"))
    far = bounded.filter(F.col("low") > most + 1e-9)
    far = far.select("a", "b", "low", F.lit(1.0).alias("high"), F.lit(False).alias("linked"))
    return keep(near.unionByName(far))


def _star(cells: DataFrame) -> DataFrame:
    return cells.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _divided(member: DataFrame, cells: DataFrame, keep: Keep) -> DataFrame:
    """Members, with their cell, of the regions that hold several cells."""
    named = member.drop("cell").join(cells.withColumnRenamed("component", "cell"), "node", "left")
    named = named.withColumn("cell", F.coalesce("cell", "node"))
    ends = named.groupBy("token").agg(F.min("cell").alias("low"), F.max("cell").alias("high"))
    return keep(named.join(ends.filter("low != high").select("token"), "token", "left_semi"))


def _can_link(n: str, place: str, m: str, other: str, settings: Settings) -> Column:
    """Can sets of sizes n and m be near whose first common shingle has these places in them?

    The sizes bound the similarity, and so do the shingles that are left from those places on.
    """
    n, place, m, other = (F.col(c) for c in (n, place, m, other))
    p = settings.percent
    return (100 * F.least(n, m) >= p * F.greatest(n, m)) & (
        (100 + p) * F.least(n - place, m - other) >= p * (n + m)
    )


def _neighbours(member: DataFrame, turn: int, settings: Settings) -> DataFrame:
    """Pairs (a, b) of members next to each other in their region, if of different cells."""
    order = Window.partitionBy("token").orderBy(F.xxhash64("node", F.lit(turn)))
    before = member.withColumns({f"_{c}": F.lag(c).over(order) for c in ("node", "n", "place", "cell")})
    able = before.filter(F.col("_cell") != F.col("cell")).filter(_can_link("n", "place", "_n", "_place", settings))
    return able.select(F.greatest("node", "_node").alias("a"), F.least("node", "_node").alias("b")).distinct()


def _window_pairs(member: DataFrame, measured: DataFrame, settings: Settings, keep: Keep) -> DataFrame:
    """All pairs (a, b) of members of a region, of different cells, that can still be near."""
    spoke = measured.select("a", "b", "low", "high")
    ends = (F.greatest("node", "pivot_node") == F.col("a")) & (F.least("node", "pivot_node") == F.col("b"))
    own = F.col("node") == F.col("pivot_node")
    bound = lambda c, d: F.when(own, F.lit(0.0)).otherwise(F.coalesce(c, F.lit(d))).alias(c)
    member = member.join(spoke, ends, "left")
    member = keep(member.select("token", "node", "n", "place", "cell", bound("low", 0.0), bound("high", 1.0)))
    x, y = member.alias("x"), member.alias("y")
    window = 1 - settings.percent / 100 + 1e-9
    apart = x.join(y, F.col("x.token") == F.col("y.token")).filter(
        (F.col("x.node") > F.col("y.node"))
        & (F.col("x.cell") != F.col("y.cell"))
        & _can_link("x.n", "x.place", "y.n", "y.place", settings)
        & (F.col("x.low") - F.col("y.high") <= window)
        & (F.col("y.low") - F.col("x.high") <= window)
    )
    return apart.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Rows (key, n_shingles, component_id), one for each input row.

    Documents link when the distinct word shingles (A-Z lower-cased) that they share are at least
    ``percent`` hundredths of those that either has; a component is all that links reach, named by
    its least key. Fewer words than a shingle's make one shingle; a null text or one without words
    has none and links with nothing. Keys are long integers; rows that repeat key and text each return
    its result, different texts under one key are documents of their own that each return theirs, and
    a null key links with nothing and has a null component. An empty table gives no
    rows; other columns are not read.
    """
    ship_package(docs.sparkSession)
    # All tables between the steps go to a folder that is cleared when the result is written.
    scratch = f"{work_folder(docs.sparkSession)}/haulback/{uuid4().hex}"
    keep = partial(cut_lineage, folder=scratch)
    named = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    keyed, anew = number_texts(named, keep)
    named = keyed.drop("_key")
    described = keep(document_sets(named, settings))
    named = named.filter("doc IS NOT NULL")
    # Equal sets are one node, named by the least document.
    full = described.filter("n > 0 AND doc IS NOT NULL")
    same = ["name", "name2", "n"]
    node = keep(full.groupBy(*same).agg(F.min("doc").alias("node")))
    nodes = keep(full.join(node, same).select("doc", "node", "n", "bits").dropDuplicates(["doc"]))
    sets = nodes.filter("doc = node").select("doc", "n", "bits")
    node_of = nodes.select("doc", "node")

    def as_nodes(pairs: DataFrame) -> DataFrame:
        one = node_of.select(F.col("doc").alias("a"), F.col("node").alias("node_a"))
        two = node_of.select(F.col("doc").alias("b"), F.col("node").alias("node_b"))
        renamed = pairs.join(one, "a").join(two, "b").filter("node_a != node_b")
        return renamed.select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b"))

    regions = keep(region_members(named, settings, keep))
    # 1. Each document against the pivots of its regions.
    able = _can_link("n", "place", "pivot_n", "pivot_place", settings)
    spokes = regions.filter("doc != pivot").filter(able).select(F.col("doc").alias("a"), F.col("pivot").alias("b"))
    spokes = as_nodes(spokes.distinct()).distinct()
    measured = _distances(spokes, sets, named, settings, keep)
    links = measured.filter("linked").select("a", "b")
    cells = connected_components(links, scratch)
    # 2. Regions that several cells still share: neighbours in a changing order.
    member = regions.join(node_of, "doc").select("token", "n", "place", "node", "pivot").distinct()
    pivots = node_of.select(F.col("doc").alias("pivot"), F.col("node").alias("pivot_node"))
    member = keep(member.join(pivots, "pivot").drop("pivot"))
    known = measured.select("a", "b")
    for turn in range(settings.rounds):
        member = _divided(member, cells, keep)
        pairs = _neighbours(member, turn, settings).join(known, ["a", "b"], "left_anti")
        more = _distances(keep(pairs), sets, named, settings, keep)
        known = known.unionByName(more.select("a", "b"))
        more = more.filter("linked").select("a", "b")
        if more.isEmpty():
            break
        cells = connected_components(_star(cells).unionByName(more), scratch)
    # 3. All pairs that are left, inside the triangle inequality's window.
    pairs = _window_pairs(_divided(member, cells, keep), measured, settings, keep).join(known, ["a", "b"], "left_anti")
    more = _distances(keep(pairs), sets, named, settings, keep).filter("linked").select("a", "b")
    found = connected_components(_star(cells).unionByName(more), scratch)
    labelled = node.join(found.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    labelled = labelled.select(*same, F.coalesce("component", "node").alias("component"))
    out = described.drop("bits").join(labelled, same, "left")
    component = F.when(F.col("doc").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")))
    result = out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
    if anew:
        keys = keep(keyed.filter("doc IS NOT NULL").select(F.col("doc").alias("_number"), "_key").distinct())
        for c in (key, "component_id"):
            result = result.join(keys, F.col(c) == F.col("_number"), "left").withColumn(c, F.col("_key"))
            result = result.drop("_number", "_key")
    result = cut_lineage(result)
    clear_work(docs.sparkSession, scratch)
    return result
