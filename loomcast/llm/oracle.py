"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

#: A-Z only: lower() would fold other letters too.
ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def near_duplicate_ctes(width: int, percent: int = 80, source: str = "documents") -> str:
    """CTEs up to ``groups`` (doc_id, n_shingles, component_id), by exact set overlap.

    Sets pair up only within the size bounds that the threshold allows; then their
    shared shingles are counted.
    """
    lowered = ASCII_LOWER.format("text")
    return f"""
words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array({lowered}, '[\\x20\\x09-\\x0D]+'),
                             lambda w: w <> '') AS w
  FROM {source}
),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {width} + 2),
           lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS s
  FROM words
),
parts AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS both_n
  FROM parts a JOIN parts b ON a.h = b.h AND a.doc_id < b.doc_id
   AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {percent}
  GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT a, b FROM shared WHERE 100 * both_n >= {percent} * (na + nb - both_n)
),
edges AS MATERIALIZED (SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links)"""


def components_cte() -> str:
    return """
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM sets
  UNION
  SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u
)"""


def near_duplicates_sql(width: int) -> str:
    return f"""
WITH RECURSIVE {near_duplicate_ctes(width)},
{components_cte()},
roots AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id,
       doc_id = component_id AS kept
FROM sets JOIN roots USING (doc_id)"""


def top_k_sql(k: int, every: int) -> str:
    return f"""
WITH v AS (
  SELECT DISTINCT vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % {every} = 0
)
SELECT query_id,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored
QUALIFY rank <= {k}"""


def crc32_sql(text: str) -> str:
    """CRC-32 of the text's UTF-8 bytes; the table follows from the polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    bytes_of = (
        f"list_transform(regexp_extract_all(hex(encode({text})), '..'), "
        f"lambda h: CAST(('0x' || h) AS BIGINT))"
    )
    return (
        f"xor(list_reduce({bytes_of}, lambda c, b: xor(c >> 8, "
        f"{table}[CAST((xor(c, b) & 255) + 1 AS BIGINT)]), 4294967295), 4294967295)"
    )


def interleave_ctes(source: str, shards: int, seed: str = "shard") -> str:
    """CTEs up to ``placed`` (columns of ``source``, position, shard, slot)."""
    return f"""
keyed AS (
  SELECT *, md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
    coalesce('=' || source, '') AS src
  FROM {source}
),
ranked AS (
  SELECT *, CAST(2 * (row_number() OVER (PARTITION BY src ORDER BY digest) - 1) + 1 AS DOUBLE)
    / (2 * count(*) OVER (PARTITION BY src)) AS fraction
  FROM keyed
),
positions AS (
  SELECT *, row_number() OVER (ORDER BY fraction, digest, src) - 1 AS position,
    count(*) OVER () AS n
  FROM ranked
),
placed AS (
  SELECT *, CAST(position * {shards} // n AS INTEGER) AS shard,
    position - ((position * {shards} // n) * n + {shards - 1}) // {shards} AS slot
  FROM positions
)"""


def sharding_sql(shards: int) -> str:
    return f"""
WITH {interleave_ctes("documents", shards)}
SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) + 1 AS size,
  coalesce(CAST({crc32_sql("text")} AS BIGINT), 0) AS text_crc32,
  'rows' AS law, shard, slot, CAST(NULL AS INTEGER) AS grown_shard, source
FROM placed"""


def mix_ctes(source: str, entropy: float, max_epochs: float, seed: str = "mix") -> str:
    """CTEs up to ``mixed`` (columns of ``source``, n_tokens, block, digest, weight)."""
    return f"""
counted AS MATERIALIZED (
  SELECT *, coalesce('=' || source, '') AS mix_source,
    greatest(1, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
      lambda w: w <> ''))) AS n_tokens
  FROM {source}
),
sources AS MATERIALIZED (
  SELECT mix_source, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM counted GROUP BY 1
),
grid AS (
  SELECT step, sum(w) AS s, ln(sum(w)) - sum(w * ln(w)) / sum(w) AS h,
    count(*) AS n, max(tokens) / min(tokens) AS spread
  FROM (SELECT step, tokens, pow(tokens / (SELECT max(tokens) FROM sources), step / 1024.0) AS w
        FROM sources, range(0, 1025) r(step))
  GROUP BY step
),
exponent AS MATERIALIZED (
  SELECT CASE WHEN max(spread) = 1 THEN 1.0 ELSE greatest(
    coalesce(max(step) FILTER (WHERE h >= {entropy} * ln(n)), 0),
    min(step) FILTER (WHERE pow(spread, 1 - step / 1024.0) <= {max_epochs})) / 1024.0 END AS a
  FROM grid
),
budgets AS MATERIALIZED (
  SELECT mix_source, CAST(tokens AS BIGINT) AS total,
    round(pow(tokens, a) / sum(pow(tokens, a)) OVER (), 9) AS weight,
    CAST(round(pow(tokens, a) * max(tokens / pow(tokens, a)) OVER ()) AS BIGINT) AS target
  FROM sources, exponent
),
blocks AS (
  SELECT c.*, b.weight, b.total, b.target, block,
    md5('{seed}|' || block || '|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM counted c JOIN budgets b USING (mix_source), range(0, 100000) r(block)
  WHERE block * total < target
),
mixed AS (
  SELECT * FROM blocks
  QUALIFY (block + 1) * total <= target OR
    sum(n_tokens) OVER (PARTITION BY mix_source, block ORDER BY digest, n_tokens) - n_tokens
      < target - block * total
)"""


def mixing_sql(entropy: float, max_epochs: float) -> str:
    return f"""
WITH {mix_ctes("documents", entropy, max_epochs)}
SELECT doc_id, source, n_tokens, block, digest AS "order", weight FROM mixed"""


def contamination_ctes(source: str, window: int, share: int) -> str:
    """CTEs up to ``judged`` (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    words = (
        "list_filter(regexp_split_to_array({0}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), "
        "lambda w: w <> '')"
    )
    lowered = words.format(ASCII_LOWER.format("coalesce(text, '')"))
    return f"""
doc_words AS MATERIALIZED (SELECT doc_id, {lowered} AS w FROM {source}),
item_words AS MATERIALIZED (
  SELECT CAST(item_id AS VARCHAR) AS item_id, w, least(len(w), {window}) AS width
  FROM (SELECT item_id, {lowered} AS w FROM benchmark) WHERE len(w) > 0
),
item_windows AS MATERIALIZED (
  SELECT DISTINCT item_id, width, unnest(list_transform(range(1, len(w) - width + 2),
    lambda i: array_to_string(w[i:i + width - 1], ' '))) AS passage
  FROM item_words
),
doc_windows AS (
  SELECT doc_id, width, unnest(range(1, len(w) - width + 2)) AS place,
    unnest(list_transform(range(1, len(w) - width + 2),
      lambda i: array_to_string(w[i:i + width - 1], ' '))) AS passage
  FROM doc_words, (SELECT DISTINCT width FROM item_windows)
  WHERE len(w) >= width
),
occurrences AS MATERIALIZED (
  SELECT doc_id, item_id, place, width FROM doc_windows JOIN item_windows USING (width, passage)
),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(place, place + width)) AS p FROM occurrences) GROUP BY 1
),
hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    sha256(array_to_string(list_sort(list(DISTINCT item_id)), ',')) AS items_sha256
  FROM occurrences GROUP BY 1
),
judged AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND {share} * coalesce(n_hit, 0) >= len(w) AS contaminated
  FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
)"""


def contamination_sql(window: int, share: int) -> str:
    return f"WITH {contamination_ctes('documents', window, share)} SELECT * FROM judged"


def license_sql(sets: list[tuple[str, list[str]]], threshold: float) -> str:
    """``sets`` are the templates' names and bigrams."""
    line = "\\r\\n|\\n|\\r"
    rows = ", ".join(
        "({}, '{}', [{}])".format(i, name, ", ".join("'" + b.replace("'", "''") + "'" for b in own))
        for i, (name, own) in enumerate(sets)
    )
    return f"""
WITH templates(id, name, own) AS (VALUES {rows}),
blocks AS (
  SELECT doc_id, text, regexp_split_to_array(text, '({line})[ \\t]*({line})') AS b
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
),
passages AS (
  SELECT doc_id, unnest(list_concat(regexp_split_to_array(text, '{line}'),
    list_filter(b, lambda p: regexp_matches(p, '{line}')),
    CASE WHEN len(b) > 1 THEN [text] ELSE [] END)) AS p
  FROM blocks
),
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(p), '[^\\p{{L}}\\p{{N}}]+'),
    lambda w: w <> '') AS w
  FROM passages
),
grams AS (
  SELECT doc_id, CASE WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(
    range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g
  FROM words WHERE len(w) > 0
),
scores AS (
  SELECT doc_id, name, round(2.0 * len(list_intersect(g, own)) / (len(g) + len(own)), 6) AS dice
  FROM grams, templates
  WHERE 2.0 * least(len(g), len(own)) / (len(g) + len(own)) >= {threshold}
),
hits AS (SELECT * FROM scores WHERE dice >= {threshold}),
best AS (
  SELECT doc_id, count(DISTINCT name) AS n_licenses,
    array_to_string(list_sort(list(DISTINCT name)), ',') AS licenses,
    first(name ORDER BY dice DESC, name) AS best_license, max(dice) AS best_dice
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_licenses, 0) AS n_licenses, coalesce(licenses, '') AS licenses,
  best_license, best_dice
FROM documents d LEFT JOIN best USING (doc_id)"""


def ranked_search_sql(k: int) -> str:
    term = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

    def terms(table: str, key: str) -> str:
        return (
            f"SELECT {key}, unnest(regexp_extract_all({ASCII_LOWER.format('text')}, '{term}')) "
            f"AS term FROM {table}"
        )

    return f"""
WITH words AS MATERIALIZED ({terms("documents", "doc_id")}),
asked AS MATERIALIZED (SELECT DISTINCT item_id, term FROM ({terms("benchmark", "item_id")})),
lengths AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
postings AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf FROM words
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE)
    / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term
),
parts AS (
  SELECT p.doc_id, p.term,
    w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS part
  FROM postings p JOIN weights USING (term) JOIN lengths l ON l.doc_id = p.doc_id, totals
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id
)
SELECT item_id,
  CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= {k}"""


def spelling_sql(min_length: int, min_count: int, typo_every: int, ratio: int) -> str:
    """Neighbours by equal words after one code point is left out at the same place."""
    return f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all({ASCII_LOWER.format("text")}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents
),
hashed AS (
  SELECT run, count(*) AS n, {crc32_sql("id || ':' || run")} AS h FROM runs
  WHERE length(run) >= {min_length} GROUP BY id, run
),
spelled AS (
  SELECT n, CASE WHEN h % {typo_every} = 0
    THEN substring(run, 1, CAST(h % length(run) AS BIGINT))
      || substring(run, CAST(h % length(run) AS BIGINT) + 2)
    ELSE run END AS word
  FROM hashed
),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled
  WHERE length(word) >= {min_length} GROUP BY word HAVING sum(n) >= {min_count}
),
cuts AS MATERIALIZED (
  SELECT DISTINCT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS cut
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
),
pairs AS (
  SELECT a.word AS a, b.word AS b, b.n AS b_n FROM cuts a JOIN cuts b USING (i, cut)
  WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION
  SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.cut = w.word
  UNION
  SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.cut = w.word
),
near AS (
  SELECT a AS word, count(DISTINCT b) AS n_near,
    first(b ORDER BY b_n DESC, b) AS best, max(b_n) AS best_n
  FROM pairs GROUP BY a
),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN best_n >= {ratio} * n THEN best END AS form,
    CASE WHEN best_n >= {ratio} * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word)
),
chain AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL
  SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON f.word = c.root
  WHERE f.form IS NOT NULL
),
roots AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""
