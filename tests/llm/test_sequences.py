"""Packing, prefix trie and centroid clustering against plain versions."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiloom.llm import clusters, hilbert, packing, queries, sampling, tries
from tests.llm.conftest import SF

WORDS = public_tokenizers.path("word_bpe_49k.json")
TURN = "conv_id long, turn long, role string, text string"
VOCABULARY = packing.Vocabulary(WORDS)
VECTOR = "vec_id long, embedding array<float>"


def plain_ids(text):
    return plain_ids.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


plain_ids.tokenizer = Tokenizer.from_file(WORDS)


def check_packing(rows, pieces, size=2048):
    """Every id of every row once, sequences without gaps or padding."""
    wanted = Counter((i, tuple(plain_ids(text))) for i, text in rows)
    parts, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = struct.unpack(f"<{p.length}I", p.ids)
        parts[p.doc_id, p.doc_tokens].append((p.start, ids))
        sequences[p.sequence_id].append((p.offset, p.length))
    for (doc, tokens), found in parts.items():
        # Rows of one id and length may be mixed up here; their ids are counted together.
        made, copies = Counter(), Counter()
        for start, ids in found:
            made.update((start + k, v) for k, v in enumerate(ids))
        for (i, ids), many in wanted.items():
            if i == doc and len(ids) == tokens:
                copies.update({(k, v): n * many for (k, v), n in Counter(enumerate(ids)).items()})
        assert made == copies
    assert {(i, len(ids)) for i, ids in wanted} == set(parts)
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        total = sum(n for _, n in spans)
        assert total <= size and total & (total - 1) == 0


def test_packing_of_all_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check_packing(rows, packing.pack_documents(docs, WORDS).collect())
    found = {(r.doc_id, r.start): r for r in queries.op11_cost_packing(spark, SF).collect()}
    for doc, text in rows[:50]:
        ids, at = plain_ids(text), 0
        while at < len(ids):
            piece = found[doc, at]
            part = ids[at : at + piece.length]
            assert piece.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part)) and piece.doc_tokens == len(ids)
            at += piece.length
        assert at == len(ids)


def test_packing_of_odd_rows(odd, nothing):
    clashing = odd.select("*", *(F.lit(7).alias(c) for c in ("start", "length", "ids", "sequence_id", "offset", "row", "tokens")))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check_packing(rows, packing.pack_documents(clashing, WORDS).collect())
    check_packing(rows, packing.pack_documents(odd, WORDS, size=64, sequences=3).collect(), 64)
    assert packing.pack_documents(nothing, WORDS).collect() == []


def test_cells_are_balanced_and_cut_little():
    lengths = np.random.default_rng(4).integers(1, 2049, 700)
    pieces = packing.pack_cell(lengths, 2048, 1024)
    assert Counter({d: sum(p[2] for p in pieces if p[0] == d) for d in range(700)}) == Counter(dict(enumerate(lengths.tolist())))
    cost, held = Counter(), Counter()
    for _, _, length, sequence, _ in pieces:
        cost[sequence] += length * (1 + length / 6144)
        held[sequence] += length
    full = [cost[s] for s in held if held[s] == 2048]
    in_order = np.cumsum(lengths) // 2048  # packed in the order they come
    plain = [sum(n * (1 + n / 6144) for n in lengths[in_order == s]) for s in range(in_order.max())]
    assert np.std(full) < np.std(plain) and len(pieces) < 700 + 2 * len(held)


def test_words_are_taken_as_whole_texts_are():
    odd = ["<|ENDOFTEXT|> ABC. a<|endoftext|>.b1 || |", "a1.b-22(x)≠=\u0338 <\u0338 A\u0301. 'Sure x.'s I\u0307t 'LLama", "<|endoftext|>x <|startoftext|> ΣΑΣ Σ", "x ́y\x1cz\x85w", "İ's don't  's", "\t\n\x0b\x0c\r a", "漢字 ｆｕｌｌ　w", "a​b é é", "z" * 5000]
    ids, first = packing.Vocabulary(WORDS).encode(pa.array([*odd, None, ""]))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [plain_ids(t)[:-1] for t in [*odd, None, ""]]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aZsT'09.,-|<>= \n\u0301\u0307\u0338é≠İßΣ“½\u200b\x1c\x85\x00"), st.characters(codec="utf-8")), max_size=25), max_size=4))
def test_any_text_has_its_own_ids(texts):
    ids, first = VOCABULARY.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [plain_ids(t)[:-1] for t in texts]


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0, digest), role, text))
    own = {c: [t[1:] for t in sorted(found)] for c, found in turns.items()}
    made = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        lender = c - abs(c) % 5 * (1 if c > 0 else -1)  # the remainder has the sign of c, as in SQL
        made[c] = tuple(own.get(lender, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, sequence in made.items():
        for d in range(len(sequence) + 1):
            members[sequence[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        own_bytes = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * own_bytes + sum(saved[x] for x in below)
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if made[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def forest(seed, conversations, longest):
    """Conversations that go on from each other's beginnings."""
    maker, known, rows = random.Random(seed), [[]], []
    for conv in maker.sample(range(4 * conversations), conversations):
        base = maker.choice(known)
        turns = base[: maker.randint(0, len(base))] + [("ua"[k % 2], maker.choice("xyz") * (k % 3)) for k in range(maker.randint(1, longest))]
        known.append(turns)
        rows += [(conv, k, *t) for k, t in enumerate(turns)]
    maker.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece, longest", [(1024, 12), (16, 60)])
def test_trie_is_the_plain_one(spark, monkeypatch, piece, longest):
    """With rows of 16 turns, sequences of rows are named two and three storeys up."""
    monkeypatch.setattr(tries, "PIECE", piece)
    rows = forest(piece, 60, longest)
    found = tries.prefix_trie(spark.createDataFrame(rows, TURN).repartition(5)).collect()
    assert sorted(map(tuple, found), key=repr) == plain_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [
        (None, 1, "u", "nobody"), (0, None, None, None), (0, 2, "u", "é" * 9), (0, 2, "u", "é" * 9), (0, 2, "a", "b"), (1, 0, "u", "x"),
        (5, 1, "", ""), (6, 1, "u", "a" * 300_000), (6, 2, "ua", ""), (7, 1, "u", "a" * 300_000), (7, 2, "u", "a"), (-3, 5, None, "z"), (2**62, 1, "u", "x"),
        *[(100 + k, t, "u", "same") for k in range(40) for t in range(3)], *[(9, t, "u", str(t)) for t in range(2100)],
    ]
    table = spark.createDataFrame(rows, TURN).withColumn("depth", F.lit(1)).withColumn("place", F.lit("x"))
    assert sorted(map(tuple, tries.prefix_trie(table).collect()), key=repr) == plain_trie(rows)
    assert tries.prefix_trie(table.limit(0)).collect() == []


def plain_clusters(rows, count=40):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == 64 and all(v is not None and np.isfinite(v) for v in x):
            whole = np.clip(np.floor(256 * np.array(x, np.float64)), -(1 << 27), 1 << 27).astype(int).tolist()
            named = hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
            kept.append((named, np.array(whole, np.int32).tobytes(), i, whole))
    centroids = [list(k[3]) for k in sorted(kept, key=lambda k: k[:2])[:count]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(k[3], c)), j) for j, c in enumerate(centroids)) for k in kept]

    for _ in range(5):
        near = assigned()
        for j in range(len(centroids)):
            mine = [k[3] for k, (_, best) in zip(kept, near) if best == j]
            if mine:
                centroids[j] = [sum(column) // len(mine) for column in zip(*mine)]
    near, inertia = assigned(), Counter()
    for apart, j in near:
        inertia[j] += apart
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(k[2], j, apart, inertia[j], sum(inertia.values()), names[j]) for k, (apart, j) in zip(kept, near)], key=repr)


def test_clusters_are_the_plain_ones(spark):
    maker = np.random.default_rng(8)
    centres = maker.normal(size=(9, 64))
    rows = [(i, (centres[i % 9] + maker.normal(0, 0.05, 64)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(i, rows[0][1]) for i in range(700, 1000)]  # one vector for a third
    got = clusters.cluster_vectors(spark.createDataFrame(rows, VECTOR).repartition(6), block=32).collect()
    assert sorted(map(tuple, got), key=repr) == plain_clusters(rows)


@pytest.mark.parametrize("width", ["float", "double"])
def test_clusters_of_odd_rows(spark, width):
    nan, inf, big = float("nan"), float("inf"), 1e30
    rows = [
        (1, [0.5] * 64), (2, [0.5] * 64), (2, [0.5] * 64), (None, [-0.25] * 64), (None, [0.25] * 64), (3, None), (4, []), (5, [0.1] * 63), (6, [0.1] * 65),
        (7, [None] + [0.0] * 63), (8, [nan] + [0.0] * 63), (9, [inf] + [0.0] * 63), (10, [big, -big] * 32), (11, [-0.001] * 64),
        *[(20 + k, [k / 7.0, -k / 3.0] * 32) for k in range(60)],
    ]
    table = spark.createDataFrame(rows, VECTOR.replace("float", width)).withColumn("cluster", F.lit(1)).withColumn("vector", F.lit("x"))
    if width == "float":
        rows = [(i, x and [None if v is None else float(np.float32(v)) for v in x]) for i, x in rows]
    assert sorted(map(tuple, clusters.cluster_vectors(table).collect()), key=repr) == plain_clusters(rows)
    assert clusters.cluster_vectors(table.limit(0)).collect() == []
    few = table.filter("vec_id = 11")
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in clusters.cluster_vectors(few).collect()] == [(11, 0, 0, 0)]


def test_boxes_keep_every_nearest_centroid():
    maker = np.random.default_rng(2)
    left = 0
    for _ in range(200):
        centroids = maker.integers(-300, 300, (40, 6))
        points = maker.integers(-300, 300, 6) + maker.integers(-25, 26, (50, 6))
        kept = clusters.candidates(points.min(axis=0).astype(np.int32), points.max(axis=0).astype(np.int32), centroids)
        apart = ((points[:, None] - centroids) ** 2).sum(axis=2)
        assert set(apart.argmin(axis=1)) <= set(kept.tolist())
        best, distance = clusters.nearest(points.astype(np.int32), centroids[kept])
        assert (kept[best] == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
        left += len(kept)
    assert left < 200 * 12


def test_curve_visits_neighbours():
    """Over a whole grid each step of the curve changes one coordinate by one."""
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = hilbert.curve_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_least_hashes(spark):
    table = spark.range(1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    wanted = [r.id for r in table.orderBy("digest").limit(30).collect()]
    assert [r.id for r in sampling.least_by_hash(table, "digest", 30, 1000).collect()] == wanted
    # Far fewer distinct digests than told: the bound is raised until enough pass.
    assert sampling.least_by_hash(table.filter("id < 40"), "digest", 30, 10**6).count() == 30
    assert sampling.least_by_hash(table.filter("id < 9"), "digest", 30, 1000).count() == 9
