"""MinHash near-dedup with odd sketches.

Documents with the same shingle set form one class and are linked outright, so
copies never meet again. Per class there are

* band keys: 128 MinHash values in 32 bands of 4; classes that share a band key
  are candidates. A pair at the least similarity is missed with a chance of 5e-11.
* an odd sketch: the 512 smallest shingle hashes (MinHash samples drawn without
  replacement) folded into a bitmap of 1024 parities. The XOR of two sketches is
  the sketch of what differs; its population count tells how many samples differ.
  A pair goes on unless that count is over five standard deviations above what
  the least similarity gives.

What goes on is confirmed on the full sets. In a bucket every class is compared
with one pivot, another one for each band. Classes of a bucket that do not end up
in one component after that are compared with all others of the bucket by sketch,
in tiles of bounded size, and confirmed likewise; so nothing rests on the pivots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.substrings import row_keys
from lexiloom.llm.words import BASE, PLAIN, binaries, longs, mix, pieces, split_words
from lexiloom.session import stage

SHINGLE = 5
PERCENT = 85
BANDS = 32
ROWS = 4
SAMPLES = 512
BITS = 1024
TILE = 1024
DEVIATIONS = 5
# Shingles hashed at a time.
_COLUMNS = 2048

_U = np.uint64
_random = np.random.default_rng(19_970_601)
_FACTOR = _random.integers(0, 2**32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)
_OFFSET = _random.integers(0, 2**32, (BANDS * ROWS, 1), dtype=np.uint32)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = split_words(texts, PLAIN, lower=True)
    _, windows = words.windows(size)
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= size:
            yield np.unique(windows[low : high - size + 1])
        elif high > low:  # too short: the whole sequence is the one shingle
            whole = np.zeros(1, _U)
            for h in words.hashes[low:high]:
                whole = mix(whole * _U(BASE) + h + _U(1))
            yield whole
        else:
            yield np.zeros(0, _U)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    values = (shingles >> _U(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), _COLUMNS):
        np.minimum(least, (_FACTOR * values[None, at : at + _COLUMNS] + _OFFSET).min(axis=1), out=least)
    keys = np.arange(1, BANDS + 1, dtype=_U)
    for row in least.reshape(BANDS, ROWS).T:
        keys = mix(keys * _U(BASE) + row)
    return keys


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    bits = mix(shingles[:SAMPLES] + _U(0x5851F42D4C957F2D)) % _U(BITS)
    return np.packbits(np.bincount(bits.astype(np.int64), minlength=BITS) & 1)


def could_be_similar(size_a, size_b, flipped, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of these sizes, whose sketches differ in ``flipped`` bits, may
    still be as similar as asked for."""
    size_a, size_b = np.asarray(size_a, float), np.asarray(size_b, float)
    shared = (size_a + size_b) * percent / (100 + percent)
    most, least = np.maximum(size_a, size_b), np.minimum(size_a, size_b)
    drawn = np.minimum(most, SAMPLES)
    share = np.minimum(shared / most, 1)
    spread = np.where(most > SAMPLES, np.sqrt(drawn * share * (1 - share)), 0)
    common = np.maximum(drawn * share - DEVIATIONS * spread, 0)
    differ = drawn + np.minimum(least, SAMPLES) - 2 * common
    two, four = (1 - 2 / BITS) ** differ, (1 - 4 / BITS) ** differ
    variance = BITS / 4 * (1 - two * two) + BITS * (BITS - 1) / 4 * (four - two * two)
    limit = BITS / 2 * (1 - two) + DEVIATIONS * np.sqrt(np.maximum(variance, 0.25))
    return (least >= shared - 1e-6) & (flipped <= limit)


def _sign(shingle: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            sizes, classes, bands, sketches = [], [], [], []
            for found in shingle_sets(piece.column("text"), shingle):
                sizes.append(len(found))
                pair = np.array([mix(found).sum(), mix(found ^ _U(0xA0761D6478BD642F)).sum() + _U(len(found))], _U)
                classes.append(pair.tobytes())
                bands.append(band_keys(found).view(np.int64) if len(found) else [])
                sketches.append(odd_sketch(found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    *(piece.column(c) for c in ("doc_id", "k1", "k2")),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "k1", "k2", "size", "class", "bands", "sketch"],
            )

    return sign


def _bits_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _U).reshape(len(column), BITS // 64)


def _sift(percent: int):
    """Pairs whose sketches allow the similarity."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flipped = np.bitwise_count(_bits_of(batch.column("sketch_a")) ^ _bits_of(batch.column("sketch_b"))).sum(axis=1)
            fits = could_be_similar(batch.column("size_a").to_numpy(), batch.column("size_b").to_numpy(), flipped, percent)
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    return sift


class _Side:
    def __init__(self, rows: pa.Table):
        self.names, self.roots = rows.column("class").to_pylist(), rows.column("root_no").to_numpy()
        self.sizes, self.one = rows.column("size").to_numpy(), rows.column("one").to_numpy()
        self.sketches = _bits_of(rows.column("sketch"))
        self.bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)


def _tile(percent: int):
    """Pairs of different components in one tile whose sketches allow the similarity.

    A pair comes from the first of the buckets it shares, and from one of the two
    tiles there that may hold it.
    """

    def tile(table: pa.Table) -> pa.Table:
        numbers = table.column("root").combine_chunks().dictionary_encode().indices
        table = table.append_column("root_no", numbers)
        bucket, side = table.column("bucket")[0].as_py(), table.column("side")
        left, right = _Side(table.filter(side)), _Side(table.filter(pc.invert(side)))
        a, b = [], []
        for i, name in enumerate(left.names):
            flipped = np.bitwise_count(left.sketches[i] ^ right.sketches).sum(axis=1)
            fits = could_be_similar(left.sizes[i], right.sizes, flipped, percent) & (right.roots != left.roots[i])
            at = np.flatnonzero(fits)
            shared = right.bands[at] == left.bands[i]
            at = at[right.bands[at, np.argmax(shared, axis=1)] == bucket]
            for j in at:
                other = right.names[j]
                if not right.one[j] or name < other:
                    a.append(min(name, other))
                    b.append(max(name, other))
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return tile


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return confirm


def _sets(shingle: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            found = list(shingle_sets(piece.column("text"), shingle))
            first = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("class"), binaries(np.concatenate(found), first)], ["class", "shingles"]
            )

    return sets


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar by their full sets. Only the
    sets of classes in a pair are made, from one document of each class."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    chosen = classes.join(wanted, "class").select("class", "k1", "k2")
    texts = docs.select(*row_keys(docs), "text").join(chosen, ["k1", "k2"]).select("class", "text")
    sets = stage(texts.mapInArrow(_sets(shingle), "class binary, shingles binary"), "shingle-sets").dropDuplicates(["class"])
    sides = [sets.select(F.col("class").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab"]
    joined = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "set_a", "set_b")
    return stage(joined.mapInArrow(_confirm(percent), "a binary, b binary"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge, root being the smallest node it can
    reach. Large-star and small-star steps by turns, a few rounds even for long
    chains; every round is written out."""
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    state = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = stage(large, "large-star")
        small = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(small, "a")
        edges = (
            joined.select("a", F.col("least").alias("b"))
            .union(joined.select(F.col("b").alias("a"), F.col("least").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        edges = stage(edges, "small-star")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _with_roots(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    found = nodes.join(roots.withColumnRenamed("node", "class"), "class", "left")
    return found.withColumn("root", F.coalesce("root", "class"))


def _rest_pairs(buckets: DataFrame, classes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Candidates left in buckets that hold several components."""
    members = stage(_with_roots(buckets.filter("members > 2"), roots), "bucket-roots")
    drawn = F.min(F.struct(F.xxhash64("class", "bucket"), "root"))
    open_ = (
        members.groupBy("bucket")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), drawn["root"].alias("main"))
        .filter("low <> high")
        .select("bucket", "main")
    )
    members = members.join(open_, "bucket").withColumn("one", F.col("root") != F.col("main"))
    many = members.groupBy("bucket").agg(
        F.ceil(F.count_if("one") / TILE).cast("int").alias("tall"), F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("wide")
    )
    members = members.join(many, "bucket").join(classes.select("class", "size", "sketch", "bands"), "class")

    def cells(side: bool, own: str, other: str, i: str, j: str) -> DataFrame:
        mine = members.filter("one") if side else members
        return mine.select(
            "bucket", "class", "root", "size", "sketch", "bands", "one",
            F.lit(side).alias("side"),
            F.pmod(F.xxhash64("class"), F.col(own)).cast("int").alias(i),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(j),
        )

    tiles = cells(True, "tall", "wide", "i", "j").unionByName(cells(False, "wide", "tall", "j", "i"))
    return tiles.groupBy("bucket", "i", "j").applyInArrow(_tile(percent), "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, k1, k2 (a key of the
    row's id and text), n_shingles, component (a key of its own, null for texts
    without words), component_id, kept.

    Documents whose sets of ``shingle``-word shingles have a similarity of
    ``percent`` or more are linked; ``component_id`` is the smallest id reachable.
    A text of fewer words has one shingle; null and empty texts have none and
    stand alone. A null id never names a component that has another id; rows that
    are in the table twice are both kept or both not. No rows give no rows.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()
    signed = stage(
        docs.select("doc_id", *row_keys(docs), "text").mapInArrow(
            _sign(shingle),
            f"doc_id {ids}, k1 long, k2 long, size long, class binary, bands array<long>, sketch binary",
        ),
        "signatures",
    )
    classes = stage(
        signed.filter("size > 0")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min(F.struct("k1", "k2")).alias("at"),
            *(F.first(c).alias(c) for c in ("size", "bands", "sketch")),
        )
        .select("class", "first_id", "at.*", "size", "bands", "sketch"),
        "classes",
    )
    band = classes.select("class", F.explode("bands").alias("bucket"))
    many = band.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = stage(band.join(many, "bucket"), "buckets")
    pivots = buckets.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("class", "bucket"), "class"))["class"].alias("pivot"))
    stars = (
        buckets.join(pivots, "bucket")
        .filter("class <> pivot")
        .select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b"))
        .distinct()
    )
    for c in "ab":
        side = classes.select(F.col("class").alias(c), F.col("size").alias(f"size_{c}"), F.col("sketch").alias(f"sketch_{c}"))
        stars = stars.join(side, c)
    stars = stage(stars.mapInArrow(_sift(percent), "a binary, b binary"), "star-pairs")
    links = confirmed(docs, classes, stars, shingle, percent)
    roots = components(links)
    rest = stage(_rest_pairs(buckets, classes, roots, percent).join(stars, ["a", "b"], "left_anti"), "rest-pairs")
    if not rest.isEmpty():
        roots = components(links.union(confirmed(docs, classes, rest, shingle, percent)))
    rooted = stage(_with_roots(classes.select("class", "first_id"), roots), "roots")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = rooted.join(named, "root").select("class", F.col("root").alias("component"), "component_id")
    rows = signed.select("doc_id", "k1", "k2", F.col("size").alias("n_shingles"), "class")
    alone = rows.filter("n_shingles = 0").select(
        "doc_id", "k1", "k2", "n_shingles", F.lit(None).cast("binary").alias("component"), F.col("doc_id").alias("component_id")
    )
    linked = rows.filter("n_shingles > 0").join(of_class, "class").select(*alone.columns)
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows and columns of ``docs`` with one row of each component left: that
    with the smallest id, and of equal ones any; one without an id only where none
    has an id. Components are told apart by their own key, so ids may be repeated
    or null. Rows without words all stay."""
    found = near_duplicates(docs, **settings)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2"))
    worded = found.filter("n_shingles > 0").groupBy("component").agg(first.alias("at"))
    empty = found.filter("n_shingles = 0").select("k1", "k2").distinct()
    stays = stage(worded.select("at.k1", "at.k2").union(empty), "stays")
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*names).alias("_row"), *row_keys(docs))
    kept = keyed.join(stays, ["k1", "k2"])
    wordless = F.coalesce(F.regexp_count(F.col("_row.text"), F.lit(r"[^\x20\x09-\x0D]")), F.lit(0)) == 0
    place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))
    return kept.withColumn("_place", place).filter((F.col("_place") == 1) | wordless).select("_row.*")
