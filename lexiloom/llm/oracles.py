"""The operators that SQL can express, for DuckDB, written the plain way."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def plain_words(text: str) -> str:
    return rf"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"


def lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


def alnum_words(text: str) -> str:
    return rf"regexp_extract_all({lower(f"coalesce({text}, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


SUBSTRINGS = f"""WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {plain_words("text")} AS w FROM documents),
words AS (SELECT rid, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM docs),
windows AS (
  SELECT rid, pos, array_to_string(w[pos:pos + 34], ' ') AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS pos FROM docs WHERE len(w) >= 35)),
repeated AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY win) AS n FROM windows) WHERE n > 1),
marked AS (
  SELECT w.rid, w.pos, w.word,
    coalesce(w.pos - max(r.pos) OVER (PARTITION BY w.rid ORDER BY w.pos) < 35, false) AS gone
  FROM words w LEFT JOIN repeated r ON w.rid = r.rid AND w.pos = r.pos)
SELECT any_value(d.doc_id) AS doc_id, count(m.word) AS n_words,
  count(*) FILTER (WHERE m.gone) AS n_removed,
  sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.pos) FILTER (WHERE NOT m.gone), '')) AS kept_sha256
FROM docs d LEFT JOIN marked m ON d.rid = m.rid GROUP BY d.rid"""

DECONTAMINATION = f"""WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {alnum_words("text")} AS w FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {alnum_words("text")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[pos:pos + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS pos FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT rid, size, pos, array_to_string(w[pos:pos + size - 1], ' ') AS win
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS pos
        FROM docs, sizes WHERE len(w) >= size)),
found AS (
  SELECT p.rid, p.pos, p.size, i.item_id FROM places p JOIN windows i ON p.size = i.size AND p.win = i.win),
reach AS (SELECT rid, pos, max(pos + size) AS past FROM found GROUP BY rid, pos),
words AS (SELECT rid, unnest(range(1, len(w) + 1)) AS pos FROM docs),
hit AS (
  SELECT rid, count(*) FILTER (WHERE past > pos) AS n_hit FROM (
    SELECT w.rid, w.pos, max(r.past) OVER (PARTITION BY w.rid ORDER BY w.pos) AS past
    FROM words w LEFT JOIN reach r ON w.rid = r.rid AND w.pos = r.pos) GROUP BY rid),
named AS (
  SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM found GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
  coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON d.rid = h.rid LEFT JOIN named n ON d.rid = n.rid"""

MIXING = f"""WITH sized AS (
  SELECT doc_id, source, CAST(len({plain_words("text")}) AS BIGINT) AS size,
    substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), ':' || md5(coalesce(text, '')))), 1, 16) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM sized GROUP BY source),
level AS (
  SELECT *, 3 * source_size AS cap,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS left_words,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS left_weight
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (SELECT *, cap * left_weight <= left_words * weight AS full_up FROM level),
targets AS (
  SELECT source, source_size,
    CASE WHEN full_up THEN CAST(cap AS DOUBLE)
    ELSE CAST(max(CASE WHEN NOT full_up THEN left_words END) OVER () AS DOUBLE) * CAST(weight AS DOUBLE)
      / CAST(max(CASE WHEN NOT full_up THEN left_weight END) OVER () AS DOUBLE) END AS target
  FROM capped),
budgets AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
    CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM targets),
placed AS (
  SELECT s.*, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, rest - start)) AS BIGINT) AS taken
FROM placed"""

NEAR_DUPLICATES = f"""WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {plain_words(lower("text"))} AS w FROM documents),
shingles AS (
  SELECT DISTINCT rid, array_to_string(w[pos:pos + 4], ' ') AS shingle
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 2))) AS pos FROM docs WHERE len(w) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
shared AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.rid <> b.rid GROUP BY a.rid, b.rid),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON s.a = x.rid JOIN sizes y ON s.b = y.rid
  WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)),
reach AS (
  SELECT rid AS a, rid AS b FROM docs
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
named AS (SELECT r.a AS rid, min(d.doc_id) AS component_id FROM reach r JOIN docs d ON r.b = d.rid GROUP BY r.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id IS NOT DISTINCT FROM c.component_id AS kept
FROM docs d JOIN named c ON d.rid = c.rid LEFT JOIN sizes s ON d.rid = s.rid"""

# CRC-32 of a text of ASCII characters: eight shifts for each of them.
SHIFTS = "list_reduce([{start}, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, (a & 1) * 3988292384))"


def crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    step = SHIFTS.format(start="xor(crc, code)")
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda crc, code: {step}), 4294967295)"


TRIE = f"""WITH turns AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    strlen(coalesce(text, '')) AS bytes, turn
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT conv_id, digest, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place
  FROM turns),
sizes AS (
  SELECT conv_id, count(*) AS size, {crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM placed GROUP BY conv_id),
known AS (
  SELECT s.conv_id, s.size, s.h, least(s.h, coalesce(l.size, 0)) AS head, s.conv_id - s.conv_id % 5 AS lender
  FROM sizes s LEFT JOIN sizes l ON l.conv_id = s.conv_id - s.conv_id % 5),
rebuilt AS (
  SELECT k.conv_id, p.place AS depth, p.digest, p.bytes FROM known k JOIN placed p ON p.conv_id = k.lender AND p.place <= k.head
  UNION ALL
  SELECT k.conv_id, p.place - k.h + k.head, p.digest, p.bytes FROM known k JOIN placed p ON p.conv_id = k.conv_id AND p.place > k.h),
paths AS (
  SELECT conv_id, depth, bytes, md5(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS name FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM known),
linked AS (
  SELECT c.*, p.name AS parent, c.depth = max(c.depth) OVER (PARTITION BY c.conv_id) AS is_end
  FROM paths c LEFT JOIN paths p ON p.conv_id = c.conv_id AND p.depth = c.depth - 1),
nodes AS (
  SELECT name, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM linked GROUP BY name, depth),
born AS (SELECT parent AS name, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
above AS (
  SELECT n.name, n.saved, b.name IS NULL AS is_leaf, p.name AS top
  FROM nodes n LEFT JOIN born b ON b.name = n.name JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
totals AS (
  SELECT top AS name, count(*) FILTER (WHERE is_leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(b.n_children, 0) AS n_children,
  t.n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.name = n.name LEFT JOIN born b ON b.name = n.name LEFT JOIN nodes p ON p.name = n.parent"""


def _clusters() -> str:
    near = """SELECT rid, arg_min(cluster, (apart, cluster)) AS cluster, CAST(min(apart) AS BIGINT) AS distance FROM (
    SELECT v.rid, c.cluster, list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x) AS apart
    FROM vectors v, {centroids} c) GROUP BY rid"""
    steps = []
    for r in range(5):
        steps.append(f"""near{r} AS MATERIALIZED ({near.format(centroids=f"centroids{r}")}),
centroids{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM centroids{r} c LEFT JOIN (
    SELECT cluster, list(floor(total / many) ORDER BY place) AS x FROM (
      SELECT cluster, place, sum(value) AS total, count(*) AS many
      FROM near{r} JOIN (SELECT rid, unnest(x) AS value, generate_subscripts(x, 1) AS place FROM vectors) USING (rid)
      GROUP BY cluster, place) GROUP BY cluster) m USING (cluster))""")
    between = ",\n".join(steps)
    return f"""WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64),
centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), rid) - 1 AS cluster, x
  FROM vectors QUALIFY cluster < 40),
{between},
labels AS MATERIALIZED ({near.format(centroids="centroids5")}),
named AS (
  SELECT cluster, sha256(array_to_string(list_transform(x, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
  FROM centroids5)
SELECT v.vec_id, CAST(l.cluster AS INTEGER) AS cluster, l.distance,
  CAST(sum(l.distance) OVER (PARTITION BY l.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(l.distance) OVER () AS BIGINT) AS inertia, n.centroid_sha256
FROM labels l JOIN vectors v USING (rid) JOIN named n USING (cluster)"""


SQL = {
    "op2_substring_dedup": SUBSTRINGS,
    "op4_near_dedup": NEAR_DUPLICATES,
    "op5_benchmark_decontamination": DECONTAMINATION,
    "op9_source_mixing": MIXING,
    "op12_prefix_trie": TRIE,
    "op13_centroid_clustering": _clusters(),
}
