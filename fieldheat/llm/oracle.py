"""DuckDB SQL with the meaning of the queries that SQL can express."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op7_line_dedup"] = rf"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS position FROM split
), keyed AS (
    SELECT *, {LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key FROM lines
), frequent AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), judged AS (
    SELECT k.*, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLE_SQL["op10_decontamination"] = rf"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), patterns AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, pos, pos + least(10, len(w)) - 1), ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS pos FROM item_words WHERE len(w) > 0)
), doc_words AS (
    SELECT doc_id, coalesce(regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), grams AS (
    SELECT doc_id, n, pos, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS gram
    FROM (SELECT d.*, l.n, unnest(range(1, len(w) - l.n + 2)) AS pos
          FROM doc_words d, (SELECT DISTINCT n FROM patterns) l WHERE len(w) >= l.n)
), hits AS (
    SELECT g.doc_id, g.pos, g.n, p.item_id FROM grams g JOIN patterns p USING (n, gram)
), covered AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM hits)
    GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ROUNDS = 10


def _spread(name: str, src: str, dst: str, verdict: str) -> str:
    """Unrolled rounds of personalised PageRank, as common table expressions."""
    steps = [
        f"""{name}_start AS (
    SELECT host, count(*)::DOUBLE / (SELECT count(*) FROM judged WHERE verdict = '{verdict}') AS score
    FROM judged WHERE verdict = '{verdict}' GROUP BY host
), {name}_edges AS (
    SELECT {src} AS src, {dst} AS dst, weight::DOUBLE / sum(weight) OVER (PARTITION BY {src}) AS share FROM links
), {name}_0 AS (SELECT * FROM {name}_start)"""
    ]
    for n in range(1, ROUNDS + 1):
        steps.append(
            f"""{name}_{n} AS (
    SELECT host, sum(score) AS score FROM (
        SELECT e.dst AS host, 0.85 * s.score * e.share AS score FROM {name}_edges e JOIN {name}_{n - 1} s ON e.src = s.host
        UNION ALL SELECT host, 0.15 * score FROM {name}_start) GROUP BY host
)"""
        )
    return ", ".join(steps)


HOST = LOWER.format("coalesce(regexp_extract({}, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '')")

ORACLE_SQL["op9_url_filters"] = rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), address AS (
    SELECT page_id, html, {HOST.format("url")} AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages
), judged AS (
    SELECT a.*, rule_host || rule_path AS rule, rule_verdict AS verdict FROM address a LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
), targets AS (
    SELECT page_id, host AS src, unnest(regexp_extract_all(html,
        '(?is)<a\s[^>]*?href\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"''\s>]*)', 1)) AS target FROM address
), named AS (
    SELECT DISTINCT page_id, src, {HOST.format("CASE WHEN starts_with(target, '//') THEN 'x:' || target ELSE target END")} AS dst
    FROM targets
), links AS (
    SELECT src, dst, count(*) AS weight FROM named WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
), {_spread("trust", "src", "dst", "allow")}, {_spread("distrust", "dst", "src", "block")}
SELECT page_id, j.host, path, rule,
       coalesce(verdict, CASE WHEN coalesce(d.score, 0) > 0.5 * (coalesce(t.score, 0) + coalesce(d.score, 0))
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN trust_{ROUNDS} t ON j.host = t.host LEFT JOIN distrust_{ROUNDS} d ON j.host = d.host
"""

ORACLE_SQL["op3_substring_dedup"] = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
    SELECT doc_id, pos, md5(array_to_string(list_slice(w, pos, pos + 19), ' ')) AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM split WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, pos FROM starts QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS place FROM later
), placed AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM split
), judged AS (
    SELECT p.*, g.place IS NOT NULL AS gone FROM placed p LEFT JOIN gone g USING (doc_id, place)
), sums AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS kept
    FROM judged GROUP BY doc_id
)
SELECT s.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN sums USING (doc_id)
"""

ORACLE_SQL["op8_embedding_dedup"] = """
WITH RECURSIVE able AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
    SELECT a.vec_id AS src, b.vec_id AS dst FROM able a JOIN able b USING (label)
    WHERE a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
), reached(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.dst FROM reached r JOIN linked l ON r.other = l.src
), least AS (
    SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), degrees AS (
    SELECT src, count(*) AS n FROM linked GROUP BY src
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN degrees ON src = e.vec_id
"""


def _nearest_entries(books: str) -> str:
    """The nearest entry of every part and the squared distance to it; whole numbers, exact in double precision."""
    return f"""
    SELECT vec_id, part, any_value(p) AS p, min(key) // 256 AS distance, min(key) % 256 AS entry
    FROM (SELECT c.*, CAST(list_inner_product(p, p) - 2 * list_inner_product(p, e) + list_inner_product(e, e) AS HUGEINT)
                      * 256 + b.entry AS key
          FROM cells c JOIN {books} b USING (part))
    GROUP BY vec_id, part"""


def _moved_books(nearest: str, books: str) -> str:
    """Entries as floored means of their parts; those without parts as they were."""
    return f"""
    SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM {books} b LEFT JOIN (
        SELECT part, entry, list(mean ORDER BY place) AS e
        FROM (SELECT part, entry, place, floor(sum(x) / count(*)) AS mean
              FROM (SELECT part, entry, unnest(p) AS x, generate_subscripts(p, 1) AS place FROM {nearest})
              GROUP BY part, entry, place)
        GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry"""


CODE_ROUNDS = 6
_CODE_STEPS = [
    """able AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
    """cells AS (
    SELECT vec_id, part, list_slice(v, part * len(v) // 8 + 1, (part + 1) * len(v) // 8) AS p
    FROM (SELECT vec_id, v, unnest(range(8)) AS part FROM able))""",
    """books_0 AS (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p AS e
    FROM cells WHERE vec_id IN (SELECT vec_id FROM able ORDER BY vec_id LIMIT 16))""",
]
for _n in range(CODE_ROUNDS):
    _CODE_STEPS.append(f"nearest_{_n} AS MATERIALIZED ({_nearest_entries(f'books_{_n}')})")
    _CODE_STEPS.append(f"books_{_n + 1} AS MATERIALIZED ({_moved_books(f'nearest_{_n}', f'books_{_n}')})")
_CODE_STEPS.append(f"coded AS MATERIALIZED ({_nearest_entries(f'books_{CODE_ROUNDS}')})")

ORACLE_SQL["op12_vector_codes"] = f"""
WITH {", ".join(_CODE_STEPS)}, summed AS (
    SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code,
           CAST(sum(distance) AS BIGINT) AS error
    FROM coded GROUP BY vec_id
), digest AS (
    SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
    FROM (SELECT part, entry, unnest(e) AS x, generate_subscripts(e, 1) AS place FROM books_{CODE_ROUNDS})
)
SELECT s.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM summed s JOIN able USING (vec_id), digest
"""
