"""Prefix trie of conversations, by van Emde Boas recursion.

Every conversation is a sequence of turns. Sequences are cut at half depth; the
prefix at the cut is named, the rest becomes a sequence below that name, and both
halves are cut again, all at the same time, until they have at most ``LEAF`` turns.
A name is a digest of the name above and the turns between, so equal prefixes of
different conversations get equal names without meeting. What a node counts is
first added up inside these short pieces, then grafted: one storey after the
other, the totals of the lower pieces are added to the nodes of the piece above
that lead to them. No task ever needs a whole conversation or a node's members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.session import stage

# Turns of a piece that is not cut any further.
LEAF = 8
# Turns of a conversation that lie in one row; the row of pieces of a longer one is
# a sequence of its own, one storey up.
PIECE = 1024
# Most turns a conversation takes over from another one.
BORROWED = 8
# Conversation ids hashed as one chunk of a node's list.
CHUNK = 512
SLOTS = 256
ROOT = b"\0" * 16


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to rows sorted by conversation the task, the row's place in its
    conversation and the conversation's place, both counted in the task."""
    task, last, place, number = TaskContext.get().partitionId(), None, 0, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_numpy()
        starts = np.flatnonzero(np.concatenate([[last is None or ids[0] != last], ids[1:] != ids[:-1]]))
        which = np.zeros(len(ids), np.int64)
        which[starts] = 1
        which = np.cumsum(which)
        begin = np.concatenate([[-place], starts])[which]
        places = np.arange(len(ids)) - begin + 1
        numbers = number + which
        last, place, number = ids[-1], int(places[-1]), int(numbers[-1])
        made = [pa.array(np.full(len(ids), task, np.int64)), pa.array(places), pa.array(numbers)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "task", "place", "number"])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, bytes, chunk) of every turn, places from 1.

    One range sort; a conversation may lie in many tasks. What earlier tasks hold
    of the conversation a task begins with is found from one row per task.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    turns = stage(
        conversations.filter(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            "turn",
            F.unhex(F.md5(F.concat(F.char_length(text[0]).cast("string"), F.lit(":"), *text))).alias("digest"),
            F.octet_length(text[1]).cast("bigint").alias("bytes"),
        ),
        "trie-turns",
    )
    keys = ("conv_id", "turn", "digest", "tie")  # null turns come first
    tied = turns.withColumn("tie", F.monotonically_increasing_id())
    in_order = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "digest", "bytes")
    kind = "conv_id long, digest binary, bytes long, task long, place long, number long"
    placed = stage(in_order.mapInArrow(_numbered, kind), "trie-ordered")
    ends = placed.groupBy("task").agg(F.min("conv_id").alias("low"), F.max(F.struct("conv_id", "place")).alias("high"))
    rows, before = [], (None, 0)
    for r in sorted(ends.collect(), key=lambda r: r.task):  # a row per task
        carried = before[1] if before[0] == r.low else 0
        rows.append((r.task, r.low, carried))
        before = (r.high.conv_id, r.high.place + (carried if r.high.conv_id == r.low else 0))
    offsets = placed.sparkSession.createDataFrame(rows, "task long, first long, carried long")
    offset = F.when(F.col("conv_id") == F.col("first"), F.col("carried")).otherwise(0)
    return placed.join(F.broadcast(offsets), "task").select(
        "conv_id",
        (F.col("place") + offset).alias("place"),
        "digest",
        "bytes",
        (F.col("task") * (1 << 32) + F.floor(F.col("number") / CHUNK)).alias("chunk"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with their first turns taken over from another one.

    Returns turns (conv_id, depth, digest, bytes, ending) and conversations
    (conv_id, length, chunk); ``ending`` is the chunk at a conversation's last
    turn, else null. Own turns are joined by blocks of places, of which a
    conversation has as many rows on the other side as it needs.
    """
    borrowed = (F.crc32(F.col("conv_id").cast("string")) % (BORROWED + 1)).alias("borrowed")
    sizes = stage(turns.groupBy("conv_id").agg(F.max("place").alias("size"), F.min("chunk").alias("chunk")), "trie-sizes")
    lenders = sizes.select(F.col("conv_id").alias("lender"), F.col("size").alias("lent"))
    wanted = sizes.select("*", borrowed, (F.col("conv_id") - F.col("conv_id") % 5).alias("lender")).join(lenders, "lender", "left")
    head = F.least("borrowed", F.coalesce("lent", F.lit(0)))
    length = F.col("head") + F.greatest(F.col("size") - F.col("borrowed"), F.lit(0))
    known = stage(wanted.withColumn("head", head).withColumn("length", length).drop("lent"), "trie-known")
    ending = F.when(F.col("depth") == F.col("length"), F.col("chunk")).alias("ending")
    shown = ("conv_id", "depth", "digest", "bytes", ending)
    first = turns.filter(F.col("place") <= BORROWED).select(F.col("conv_id").alias("lender"), F.col("place").alias("depth"), "digest", "bytes")
    heads = first.join(known.drop("size", "borrowed"), "lender").filter(F.col("depth") <= F.col("head")).select(*shown)
    block = F.floor(F.col("place") / PIECE).alias("block")
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("size") / PIECE))).alias("block")
    own = turns.drop("chunk").select("*", borrowed, block).filter(F.col("place") > F.col("borrowed"))
    tails = own.join(known.select("conv_id", "head", "length", "chunk", blocks), ["conv_id", "block"])
    depth = F.col("place") - F.col("borrowed") + F.col("head")
    return heads.unionByName(tails.withColumn("depth", depth).select(*shown)), known.select("conv_id", "length", "chunk")


def _content(turns: str | Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.hex(t["digest"])), "").cast("binary")


def _halved(pieces: DataFrame, height: int) -> DataFrame:
    """Pieces of at most ``height`` turns cut at half of it: the upper half, closed
    by the name of the prefix at the cut, and under that name what is left."""
    half = height // 2
    upper, lower = F.slice("turns", 1, half), F.slice("turns", half + 1, half)
    cut = _digest(F.col("name"), _content(upper))
    both = F.array(
        F.struct("name", "above", cut.alias("closing"), upper.alias("turns")),
        F.struct(cut.alias("name"), (F.col("above") + half).alias("above"), "closing", lower.alias("turns")),
    )
    one = F.array(F.struct("name", "above", "closing", "turns"))
    # At just half the height the lower piece is empty, and yet the prefix has its name.
    full = F.array(F.struct("name", "above", cut.alias("closing"), "turns"))
    size = F.size("turns")
    return pieces.select("conv_id", F.inline(F.when(size > half, both).when(size == half, full).otherwise(one)))


def _pieces(turns: DataFrame) -> DataFrame:
    """(conv_id, name, above, closing, turns): turns in rows of at most ``PIECE``,
    with the names of the prefixes above the row and, where it is full, at its end.

    The full rows of long conversations are turns themselves, of sequences whose
    prefixes are named in the same way.
    """
    row = F.floor((F.col("depth") - 1) / PIECE).alias("row")
    turn = F.struct("depth", "digest", "bytes", "ending")
    rows = stage(turns.groupBy("conv_id", row).agg(F.sort_array(F.collect_list(turn)).alias("turns")), "trie-rows")
    above = (F.col("row") * PIECE).alias("above")
    if not rows.agg(F.max("row")).first()[0]:
        return rows.select("conv_id", F.lit(ROOT).alias("name"), above, F.lit(None).cast("binary").alias("closing"), "turns")
    content = F.unhex(F.md5(_content("turns"))).alias("digest")
    nothing = F.lit(0).cast("bigint").alias("bytes"), F.lit(None).cast("bigint").alias("ending")
    upper = rows.filter(F.size("turns") == PIECE).select("conv_id", (F.col("row") + 1).alias("depth"), content, *nothing)
    named = _paths(_pieces(upper)).select("conv_id", F.posexplode("names").alias("i", "name"), "above")
    named = stage(named.select("conv_id", (F.col("above") + F.col("i") + 1).alias("row"), "name"), "trie-upper")
    closings = named.select("conv_id", (F.col("row") - 1).alias("row"), F.col("name").alias("closing"))
    placed = rows.join(named, ["conv_id", "row"], "left").join(closings, ["conv_id", "row"], "left")
    return placed.select("conv_id", F.coalesce("name", F.lit(ROOT)).alias("name"), above, "closing", "turns")


def _paths(pieces: DataFrame) -> DataFrame:
    """(conv_id, name, above, turns, names): pieces cut down to ``LEAF`` turns, with
    the name of each turn's node."""
    height = PIECE
    while height > LEAF:
        pieces, height = _halved(pieces, height), height // 2
    named = F.transform(
        F.sequence(F.lit(1), F.size("turns")), lambda i: _digest(F.col("name"), _content(F.slice(F.col("turns"), F.lit(1), i)))
    )
    names = F.when(F.col("closing").isNull(), named).otherwise(F.concat(F.slice(named, F.lit(1), F.size("turns") - 1), F.array("closing")))
    return pieces.select("conv_id", "name", "above", "turns", names.alias("names"))


def _nodes(paths: DataFrame) -> DataFrame:
    """One row per node but the root: name, path (the names in its piece, behind the
    one above), depth, conv_id, n_convs, saved."""
    rows = paths.select("conv_id", "name", "names", F.posexplode("turns").alias("i", "turn"))
    upto = F.array_join(F.transform(F.slice("names", F.lit(1), F.col("i") + 1), F.hex), "")
    path = F.unhex(F.concat(F.hex("name"), upto)).alias("path")
    rows = rows.select("conv_id", path, F.col("turn.depth").alias("depth"), F.col("turn.bytes").alias("bytes"))
    grouped = rows.groupBy("path", "depth", "bytes").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    saved = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    return grouped.select(F.expr("substring(path, -16, 16)").alias("name"), "path", "depth", "conv_id", "n_convs", saved)


def _hashed_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's chunks one after another; rows lie by node and chunk."""
    node, running, many = None, None, 0
    for batch in batches:
        names, digests, ends = [], [], []
        for name, ids, count in zip(*(batch.column(c).to_pylist() for c in ("name", "ids", "ends"))):
            if name != node:
                if node is not None:
                    names.append(node), digests.append(running.hexdigest()), ends.append(many)
                node, running, many = name, hashlib.sha256(), 0
            running.update((("," if many else "") + ids).encode())
            many += count
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string()), pa.array(ends, pa.int64())], ["name", "ends_sha256", "n_ends"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([running.hexdigest()]), pa.array([many], pa.int64())], ["name", "ends_sha256", "n_ends"])


def _ends(paths: DataFrame, conversations: DataFrame) -> DataFrame:
    """(name, ends_sha256, n_ends) of the nodes at which conversations end.

    The ids of a node are joined in chunks of neighbouring ids; what one digest
    takes in are the chunks in order, never held together.
    """
    last = F.element_at("turns", -1)["ending"]
    at_end = paths.select(F.element_at("names", -1).alias("name"), last.alias("chunk"), "conv_id").filter(F.col("chunk").isNotNull())
    turnless = conversations.filter(F.col("length") == 0).select(F.lit(ROOT).alias("name"), "chunk", "conv_id")
    lists = at_end.unionByName(turnless).groupBy("name", "chunk").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    texts = lists.select("name", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"), F.size("ids").alias("ends"))
    by_name = texts.repartition("name").sortWithinPartitions("name", "chunk")
    return by_name.mapInArrow(_hashed_lists, "name binary, ends_sha256 string, n_ends long")


def _grafted(nodes: DataFrame, paths: DataFrame, depth: int) -> DataFrame:
    """(name, n_leaves, saved_tokens) over the subtree of each node but the root.

    First over pieces of ``LEAF`` turns: each node adds to those on its path. Then
    storey by storey: the totals of the nodes right below a cut are added up for
    the prefix at the cut and given to all nodes of the upper piece that lead to
    it, whose names are those of the path of any member.
    """
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("bigint").alias("leaves")
    places = F.sequence(F.lit(17), F.octet_length("path") - 15, F.lit(16))
    above = F.col("depth") - F.octet_length("path") / 16 + 2
    spread = nodes.select("path", above.cast("bigint").alias("top"), "conv_id", leaf, "saved", F.posexplode(places).alias("i", "at"))
    name, parent = (F.expr(f"substring(path, at {shift}, 16)") for shift in ("", "- 16"))
    added = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.min("conv_id").alias("conv_id")]
    local = spread.select(name.alias("name"), parent.alias("parent"), (F.col("top") + F.col("i")).alias("depth"), "leaves", "saved", "conv_id")
    totals = [stage(local.groupBy("name", "parent", "depth").agg(*added), "trie-totals")]
    height = 2 * LEAF
    while height // 2 < depth:
        half = height // 2
        # The first nodes below this storey's cuts.
        below = _union([t.filter((F.col("depth") - 1) % height == half) for t in totals])
        tops = below.groupBy("parent", (F.col("depth") - 1).alias("cut")).agg(*added)
        # Where the pieces above a cut begin, told in two steps as they may be many.
        wide = F.explode(F.sequence(F.col("cut") - half, F.col("cut") - LEAF, F.lit(LEAF * PIECE)))
        end = F.least(F.col("wide") + LEAF * (PIECE - 1), F.col("cut") - LEAF)
        asked = tops.select("leaves", "saved", "conv_id", "cut", wide.alias("wide"))
        asked = asked.select("leaves", "saved", "conv_id", F.explode(F.sequence(F.col("wide"), end, F.lit(LEAF))).alias("above"))
        found = asked.join(paths.select("conv_id", "above", "name", "names"), ["conv_id", "above"])
        found = found.select("*", F.posexplode("names").alias("i", "node"))
        parent = F.when(F.col("i") == 0, F.col("name")).otherwise(F.get("names", F.col("i") - 1)).alias("parent")
        place = (F.col("above") + F.col("i") + 1).alias("depth")
        given = found.select(F.col("node").alias("name"), parent, place, "leaves", "saved", "conv_id")
        totals.append(stage(given.groupBy("name", "parent", "depth").agg(*added), "trie-grafts"))
        height *= 2
    return _union(totals).groupBy("name").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. A null role or text is empty; null turns
    come first; equal turns of a conversation are ordered by a digest of role and
    text, repeated rows are turns of their own. Rows without a conv_id belong to
    no conversation; remainders of negative ids have their sign. An empty table has no conversation and gives no rows, not
    even a root. A conversation, a node's members and its children may each hold
    any share of all rows.
    """
    spark = conversations.sparkSession
    schema = (
        "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string"
    )
    turns, members = rebuilt(ordered_turns(conversations))
    members = stage(members, "trie-members")
    everyone = members.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"), F.max("length").alias("depth")).first()
    if not everyone.n:
        return spark.createDataFrame([], schema)
    paths = stage(_paths(_pieces(turns)), "trie-paths")
    ends = stage(_ends(paths, members), "trie-ends")
    n_ends = F.coalesce("n_ends", F.lit(0)).alias("n_ends")
    nodes = stage(_nodes(paths).join(ends, "name", "left").select("name", "path", "depth", "conv_id", "n_convs", "saved", n_ends, "ends_sha256"), "trie-nodes")
    # A node's parent lies 16 bytes further up its path. A parent of many children
    # is repeated for as many slots as they fall into.
    parent = F.expr("substring(path, -32, 16)").alias("parent")
    slot = F.pmod(F.xxhash64("name"), F.lit(SLOTS)).alias("slot")
    slots = stage(nodes.groupBy(parent, slot).agg(F.count(F.lit(1)).alias("born")), "trie-slots")
    parents = slots.join(nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent").drop("born")
    born = slots.groupBy(F.col("parent").alias("name")).agg(F.sum("born").alias("n_children"))
    counted = nodes.join(_grafted(nodes, paths, everyone.depth), "name").join(born, "name", "left").select("*", parent, slot)
    first = F.lit(everyone.first).cast("bigint")
    no_ends = hashlib.sha256(b"").hexdigest()
    rows = counted.join(parents, ["parent", "slot"], "left").select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == 1, first).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        "n_leaves",
        F.col("saved_tokens").cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(no_ends)).alias("ends_sha256"),
    )
    is_leaf = F.col("n_ends") == F.col("n_convs")
    over = nodes.agg(F.count_if(F.col("depth") == 1).alias("children"), F.count_if(is_leaf).alias("leaves"), F.sum("saved").alias("saved")).first()
    turnless = ends.filter(F.col("name") == F.lit(ROOT)).first()
    ended = turnless.ends_sha256 if turnless else no_ends
    root = [(everyone.first, 0, None, everyone.n, over.children, over.leaves or 1, over.saved or 0, ended)]
    return rows.unionByName(spark.createDataFrame(root, schema))
