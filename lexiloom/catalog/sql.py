"""The fixtures and text rules again, as SQL for the oracle."""

from __future__ import annotations

from lexiloom.catalog.fixtures import GLOSSARY, HAN_LETTER, MAX_WORDS, STANDIN

MISSING = "missing field"
REJECTED = f"RowRejected: more than {MAX_WORDS} words"


def planted(text: str) -> str:
    return f"replace({text}, '{STANDIN}', '{HAN_LETTER}')"


def translated(text: str) -> str:
    """The glossary applied word by word."""
    cases = " ".join(f"WHEN '{word}' THEN '{target}'" for word, target in GLOSSARY.items())
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), "
        f"lambda w: CASE w {cases} ELSE w END), ' ')"
    )


def stripped(text: str) -> str:
    return rf"regexp_replace({text}, '\A\s+|\s+\z', '', 'g')"


def sentences_of(text: str) -> str:
    return (
        rf"list_filter(string_split(regexp_replace({stripped(text)}, '([.!?])\s+', "
        rf"'\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')"
    )


def words_of(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda w: w <> '')"


def chunks_of(text: str, limit: int) -> str:
    words = words_of(text)
    return (
        f"CASE WHEN len({words}) > {limit} THEN list_transform(range(0, (len({words}) - 1) // {limit} + 1), "
        f"lambda k: array_to_string(list_slice({words}, k * {limit} + 1, (k + 1) * {limit}), ' ')) "
        f"ELSE [{text}] END"
    )


def too_long(text: str) -> str:
    return f"len(string_split({text}, ' ')) > {MAX_WORDS}"


WORDS = """
docs AS (
  SELECT doc_id, lang AS lang_code, text, lower(split_part(text, ' ', 1)) AS raw FROM documents
),
entries AS (
  SELECT doc_id, lang_code, text,
    CASE WHEN NOT contains(raw, '.') THEN raw END AS word,
    CASE WHEN right(raw, 1) IN ('n', 's') THEN 'noun'
         WHEN right(raw, 1) IN ('e', 'o') THEN 'verb'
         WHEN right(raw, 1) IN ('a', 'r', 't') THEN 'adj' ELSE 'adv' END AS pos
  FROM docs
),
chosen AS (
  SELECT * FROM entries
  WHERE word IS NOT NULL AND lang_code = 'es' AND pos IN ('adj', 'verb', 'noun')
),
lines AS (
  SELECT doc_id, word, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS sense
  FROM chosen
),
senses AS (
  SELECT *, lower(substr(line, 1, 1)) AS letter FROM lines
)"""

TURNS = """
conv AS (
  SELECT conv_id, turn, role, text,
    row_number() OVER (ORDER BY conv_id, turn) - 1 AS "index"
  FROM conversations
)"""

PAIRS = f"""{TURNS},
paq AS (
  SELECT u."index", u.turn, u.text AS q, a.text AS a
  FROM conv u LEFT JOIN conv a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'
)"""

TRIPLETS = f"""{TURNS},
qqp AS (
  SELECT u."index", u.text AS query, p.text AS pos,
    list_filter([n.text, m.text], lambda x: x IS NOT NULL) AS neg
  FROM conv u
  LEFT JOIN conv p ON p.conv_id = u.conv_id AND p.turn = u.turn + 1 AND p.role = 'assistant'
  LEFT JOIN conv n ON n.conv_id = u.conv_id AND n.turn = u.turn + 3 AND n.role = 'assistant'
  LEFT JOIN conv m ON m.conv_id = u.conv_id AND m.turn = u.turn + 5 AND m.role = 'assistant'
  WHERE u.role = 'user'
)"""

REASONING = f"""{PAIRS},
o1 AS (
  SELECT "index", {planted('q')} AS prompt,
    '<Thought>' || a || '</Thought>' || chr(10) || '<Output>' || a || '</Output>' AS response,
    turn < 2 AS opening
  FROM paq
)"""

ASCII_NO_HAN = (
    "(regexp_matches({0}, '[!-~]') AND NOT regexp_matches({0}, '[\\x{{4E00}}-\\x{{9FFF}}]'))"
)

SEGMENTS = rf"""
tokens AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<[^>]*>|[^<]+|<[^>]*\z')) AS token,
    generate_subscripts(regexp_extract_all(html, '<[^>]*>|[^<]+|<[^>]*\z'), 1) AS place
  FROM pages
),
described AS (
  SELECT page_id, place, starts_with(token, '<') AND ends_with(token, '>') AS is_tag, token FROM tokens
),
trimmed AS (
  SELECT page_id, place, is_tag, CASE WHEN is_tag THEN token ELSE {stripped("token")} END AS text
  FROM described
),
segments AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS pos, is_tag, text
  FROM trimmed WHERE is_tag OR text <> ''
)"""

INTEGER = r"regexp_matches({0}, '\A\s*[+-]?[0-9]+(_[0-9]+)*\s*\z')"

SENTENCES = """
sents AS (
  SELECT vec_id AS idx, text, embedding FROM embeddings JOIN documents ON doc_id = vec_id
)"""

ALL_DOCUMENTS = """
sents AS (SELECT doc_id AS idx, text FROM documents)"""

IMAGES = f"""
k12 AS (
  SELECT CAST(page_id AS VARCHAR) AS id,
    list_transform(regexp_extract_all({planted('html')}, '(?s)<p>(.*?)</p>', 1),
      lambda p: nullif(p, '')) AS images,
    html AS problem, url AS answer,
    CASE WHEN contains(url, '?') THEN '1' ELSE '0' END AS pass
  FROM pages
),
flagged AS (
  SELECT *, len(list_filter(images,
    lambda p: p IS NOT NULL AND regexp_matches(p, '[\\x{{4E00}}-\\x{{9FFF}}]'))) > 0 AS detected
  FROM k12
)"""


def sampled(
    block: int, partners: int, repeats: int = 1, seed: int = 42, source: str = SENTENCES
) -> str:
    """CTE ``drawn`` (idx1, rep, rank, idx2): the sampled pairs, step by step."""
    steps = []
    for step in range(partners):
        top = f"others - {partners} + {step}"
        draw = (
            f"('0x' || substr(md5('{seed}|' || rep || '|' || idx || '|{step}'), 1, 15))::BIGINT"
            f" % greatest({top} + 1, 1)"
        )
        steps.append(
            f"draw{step + 1} AS (SELECT idx, rep, start, others, list_append(chosen, "
            f"CASE WHEN list_contains(chosen, {draw}) THEN {top} ELSE {draw} END) AS chosen "
            f"FROM draw{step})"
        )
    return f"""{source},
draw0 AS (
  SELECT idx, rep, (idx // {block}) * {block} AS start,
    least({block}, (SELECT max(idx) + 1 FROM sents) - (idx // {block}) * {block}) - 1 AS others,
    CAST([] AS BIGINT[]) AS chosen
  FROM sents, range(0, {repeats}) AS r(rep)
),
{", ".join(steps)},
listed AS (
  SELECT idx, rep, start,
    CASE WHEN others <= {partners} THEN range(0, others) ELSE chosen END AS places
  FROM draw{partners}
),
placed AS (
  SELECT idx, rep, start, unnest(places) AS place, generate_subscripts(places, 1) - 1 AS rank
  FROM listed
),
drawn AS (
  SELECT idx AS idx1, CAST(rep AS INTEGER) AS rep, CAST(rank AS INTEGER) AS rank,
    CAST(start + place + CASE WHEN place >= idx - start THEN 1 ELSE 0 END AS BIGINT) AS idx2
  FROM placed
)"""


SCORED = """
scored AS (
  SELECT p.*, a.text AS sentence1, b.text AS sentence2,
    round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
  FROM drawn p JOIN sents a ON a.idx = p.idx1 JOIN sents b ON b.idx = p.idx2
)"""
