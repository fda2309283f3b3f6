"""Centroid clustering over zone maps along a space-filling curve.

Vectors are sorted once along a Hilbert curve and cut into blocks, each with the
least and greatest value of every component. In a round a block is first compared
as a whole: bounds over its box tell which centroids can be the nearest one of any
of its vectors, and only those are compared exactly. What a task gives back is the
sum and the number of vectors of each centroid. All distances are exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.hilbert import Curve
from lexiloom.llm.sampling import least_by_hash
from lexiloom.llm.words import binaries, mix
from lexiloom.session import stage

COMPONENTS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
# Vectors of a block.
BLOCK = 128
# Vectors, by hash order, whose main directions the curve runs through.
SAMPLE = 256
# Components are held within plus and minus this; squared distances then fit 64 bits.
WIDEST = 1 << 27


def _matrix(column: pa.Array, components: int) -> np.ndarray:
    """Equally long binary values of 32-bit integers as rows."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data, np.int32).reshape(-1, components)


def _pack(components: int, scale: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(over="ignore"):
                    whole = np.clip(np.floor(scale * x), -WIDEST, WIDEST).astype(np.int32)
                packed = binaries(whole, np.arange(batch.num_rows + 1) * components)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), packed], ["vec_id", "vector"])

    return pack


def whole_vectors(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of each component as packed 32-bit integers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = embeddings.filter((F.size("embedding") == components) & finite)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    rows = usable.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return rows.mapInArrow(_pack(components, scale), f"vec_id {kind}, vector binary")


def _keyed(curve: Curve, components: int):
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            if batch.num_rows:
                places = curve.keys(_matrix(batch.column("vector"), components))
                ties = mix(np.arange(row, row + batch.num_rows, dtype=np.uint64)).view(np.int64)
                row += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places), pa.array(ties)], [*batch.schema.names, "place", "tie"])

    return key


def _cut(components: int, block: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []

        def close() -> pa.RecordBatch:
            names, x = pa.concat_arrays(ids), np.concatenate(rows)
            ids.clear(), rows.clear()
            lists = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            parts = [x, x.min(axis=0), x.max(axis=0)]
            return pa.RecordBatch.from_arrays([lists, *(pa.array([p.tobytes()]) for p in parts)], ["ids", "vectors", "low", "high"])

        have = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                taken = min(block - have, batch.num_rows - at)
                part = batch.slice(at, taken)
                ids.append(part.column("vec_id"))
                rows.append(_matrix(part.column("vector"), components))
                at, have = at + taken, have + taken
                if have == block:
                    yield close()
                    have = 0
        if have:
            yield close()

    return cut


def zone_map(vectors: DataFrame, curve: Curve, components: int = COMPONENTS, block: int = BLOCK) -> DataFrame:
    """Blocks of vectors that lie next to each other on the curve, with their boxes.

    Equal vectors have one place on the curve; a tie-break by row spreads them.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    placed = vectors.mapInArrow(_keyed(curve, components), f"vec_id {kind}, vector binary, place long, tie long")
    ordered = placed.repartitionByRange("place", "tie").sortWithinPartitions("place", "tie").select("vec_id", "vector")
    return ordered.mapInArrow(_cut(components, block), f"ids array<{kind}>, vectors binary, low binary, high binary")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers, in order, of the centroids that can be nearest to a point of the box.

    First those whose least distance to the box is above another one's greatest
    go. Then those that are farther than one centroid near the middle all over
    the box: the difference of two squared distances is linear, so its least value
    is taken at a corner that is known component by component.
    """
    low, high = low.astype(np.int64), high.astype(np.int64)
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    reach = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    most = (reach**2).sum(axis=1)
    left = np.flatnonzero((outside**2).sum(axis=1) <= most.min())
    near = centroids[left]
    pivot = near[np.argmin(((2 * near - low - high).astype(np.float64) ** 2).sum(axis=1))]
    off = near - pivot
    greatest = np.where(off > 0, high * off, low * off).sum(axis=1)
    return left[(near**2).sum(axis=1) - (pivot**2).sum() - 2 * greatest <= 0]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the nearest centroid of each vector, the first of equals; the squared distance."""
    widest = max(np.abs(vectors).max(), np.abs(centroids).max())
    # Doubles are exact, and faster, while all sums stay under 2 ** 53.
    kind = np.float64 if widest < (1 << 22) else np.int64
    x, c = vectors.astype(kind), centroids.astype(kind)
    apart = (x**2).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c**2).sum(axis=1)
    best = np.argmin(apart, axis=1)
    return best, apart[np.arange(len(x)), best].astype(np.int64)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple]:
    components = centroids.shape[1]
    for batch in batches:
        for row in range(batch.num_rows):
            x, low, high = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int32) for c in ("vectors", "low", "high"))
            x = x.reshape(-1, components)
            left = candidates(low, high, centroids)
            best, apart = nearest(x, centroids[left])
            yield batch.column("ids")[row].values, x, left[best], apart


def _sums(centroids: np.ndarray):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), centroids.shape[1] + 1), np.int64)
        for _, x, best, _ in _assigned(batches, centroids):
            for cluster in np.unique(best):
                mine = x[best == cluster]
                total[cluster, :-1] += mine.sum(axis=0, dtype=np.int64)
                total[cluster, -1] += len(mine)
        cluster, axis = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cluster), pa.array(axis), pa.array(total[cluster, axis])], ["cluster", "axis", "total"])

    return sums


def _labels(centroids: np.ndarray):
    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, best, apart in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([ids, pa.array(best.astype(np.int32)), pa.array(apart)], ["vec_id", "cluster", "distance"])

    return labels


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floor of its vectors' mean; without vectors it stays.

    The driver gets one sum for each centroid and component.
    """
    sums = blocks.mapInArrow(_sums(centroids), "cluster long, axis long, total long")
    exact = sums.groupBy("cluster", "axis").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    total = {(r.cluster, r.axis): int(r.total) for r in exact.collect()}
    components = centroids.shape[1]
    moved = centroids.copy()
    for cluster in range(len(centroids)):
        if count := total.get((cluster, components)):
            moved[cluster] = [total.get((cluster, axis), 0) // count for axis in range(components)]
    return moved


def cluster_vectors(
    embeddings: DataFrame,
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """One row per usable row of ``embeddings`` (vec_id, embedding).

    Returns vec_id, cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256. Usable is an array of exactly ``components`` values, none
    null or not finite; other rows, null arrays among them, are left out. Values
    become floor(scale * x), held within 2 ** 27 on both sides. The first
    centroids are the ``count`` vectors of least sha256 of ``seed:vec_id`` (a null
    id is the empty text), ties by the packed vector; repeated rows count each,
    and fewer vectors than ``count`` give that many centroids. Equally near
    centroids: the smaller number. No usable rows give no rows.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    vectors = stage(whole_vectors(embeddings, components, scale), "cluster-vectors")
    total = vectors.count()
    if not total:
        return spark.createDataFrame([], schema)
    named = vectors.withColumn("digest", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256))
    chosen = [np.frombuffer(r.vector, np.int32) for r in least_by_hash(named, "digest", max(SAMPLE, count), total, "vector").collect()]
    centroids = np.array(chosen[:count], np.int64)
    blocks = stage(zone_map(vectors, Curve(np.array(chosen)), components, block), "cluster-blocks")
    for _ in range(rounds):
        centroids = _moved(blocks, centroids)
    labels = stage(blocks.mapInArrow(_labels(centroids), f"vec_id {kind}, cluster int, distance long"), "cluster-labels")
    return labels.join(F.broadcast(_summary(spark, labels, centroids)), "cluster").select(*(n.split()[0] for n in schema.split(", ")))


def _summary(spark: SparkSession, labels: DataFrame, centroids: np.ndarray) -> DataFrame:
    """A row per centroid: at most as many as the centroids asked for."""
    sums = labels.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("sum")).collect()
    inertia = sum(int(r["sum"]) for r in sums)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(r.cluster, int(r["sum"]), inertia, names[r.cluster]) for r in sums]
    return spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
