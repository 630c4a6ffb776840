"""DuckDB SQL over the same tables, one statement per query key.

Shared relations are spelled once as common table expressions and put in front of the statements
that need them.
"""

from __future__ import annotations

from lexgraph.operators.nature import TAG_NATURE

DOC_TERMS = r"""doc_terms AS (
  SELECT regexp_extract(text, '[^ \t\r\n]+') || '/' || source AS bk_word,
         replace(replace(replace(text, ' | ', '/'), ' ', ','), chr(10), ',') AS bk_relwords,
         lang || ',' || source || ',' || lang || '|' || source || ',' || lang
           || CASE WHEN doc_id % 2 = 0 THEN ',,' ELSE '' END AS bk_tags
  FROM documents
  UNION ALL
  SELECT CASE k % 9 WHEN 0 THEN name WHEN 1 THEN name[1] WHEN 2 THEN '/' || name WHEN 3 THEN pad || name || tail WHEN 4 THEN NULL
           WHEN 5 THEN name || ' too long a word' WHEN 6 THEN name || '/x/y' WHEN 7 THEN '//' ELSE name END,
         CASE k % 7 WHEN 0 THEN name || ',//,' || kind || ',/,a/b,/c' WHEN 1 THEN pad || kind || ',' || name || ',' || kind || tail
           WHEN 2 THEN ',' || kind || ',,' || name || ',,z' WHEN 3 THEN kind || ',' || name WHEN 4 THEN NULL WHEN 5 THEN '/,//,///'
           ELSE kind || ',' || name || ',c,d,e' END,
         CASE k % 5 WHEN 0 THEN kind WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN ',,,' ELSE pad || kind || ',odd' || tail END
  FROM (SELECT s_suppkey AS k, s_name AS name, 'Supplier' AS kind FROM supplier
        UNION ALL SELECT p_partkey, p_name || ' ' || p_partkey, p_type FROM part),
       (SELECT chr(9) || ' ' || chr(1) AS pad, ' ' || chr(13) || chr(10) AS tail))"""

LAYERED_TERMS = """layered_terms AS (
  SELECT 'part-' || p_partkey AS bk_word, p_name || ',' || p_brand || ',' || p_type AS bk_relwords,
         'world,L2-' || k % 2 || ',L4-' || k % 4 || CASE WHEN k % 3 <> 0 THEN ',L8-' || k % 8 ELSE '' END || ',L16-' || k % 16
           || ',B-' || k % 48 || CASE WHEN k < 5 THEN ',lone' ELSE '' END AS bk_tags
  FROM (SELECT *, p_partkey AS k FROM part))"""

CUSTOMER_TERMS = """customer_terms AS (
  SELECT c_name AS bk_word, n_name || ',' || r_name || ',' || c_mktsegment AS bk_relwords,
         r_name || ',' || n_name || ',' || n_name || '|' || c_mktsegment AS bk_tags
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def trimmed(c: str) -> str:
    """``c`` without the characters up to U+0020 at its ends."""
    return f"regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def base(c: str) -> str:
    """The part before the first slash; slashes only stay."""
    return f"CASE WHEN {c} <> '' AND replace({c}, '/', '') = '' THEN {c} ELSE split_part({c}, '/', 1) END"


def clean(source: str, name: str, min_len: int) -> str:
    """Filter, base term, and best sense per term of ``source``, as relation ``name``."""
    return f"""{name}_long AS (
  SELECT w, tags, list_filter(string_split(rels, ','), lambda x: x <> '') AS rl
  FROM (SELECT {trimmed("bk_word")} AS w, {trimmed("coalesce(bk_relwords, '')")} AS rels, {trimmed("coalesce(bk_tags, '')")} AS tags FROM {source})
  WHERE length(w) BETWEEN {min_len} AND 23 AND NOT starts_with(w, '/')
    AND (rtrim(tags, ',') <> ''{" OR tags = ''" if min_len == 1 else ""})),
{name}_senses AS (
  SELECT {base("w")} AS word, tags,
         list_transform(list_filter(rl, lambda x: NOT starts_with(x, '/')), lambda x: split_part(x, '/', 1)) AS rel
  FROM {name}_long WHERE len(rl) >= 3),
{name}_ranked AS (
  SELECT word, rel, tags, row_number() OVER (
           PARTITION BY word ORDER BY len(rel) DESC, tags DESC, array_to_string(rel, ',') DESC) AS rn
  FROM {name}_senses),
{name} AS (
  SELECT word, rel, coalesce(array_to_string(rel, ','), '') AS relwords, tags AS raw_tags, rtrim(tags, ',') AS tags
  FROM {name}_ranked WHERE rn = 1)"""


LOOSE_DOCS = DOC_TERMS + ",\n" + clean("doc_terms", "terms", 1)


def counted(terms: str) -> str:
    """Tag counts and pair counts of a cleaned relation."""
    return f"""listed AS (SELECT word, unnest(string_split(tags, ',')) AS tag FROM {terms}),
tag_counts AS (SELECT tag, count(*) AS n FROM listed GROUP BY tag),
multi AS (SELECT word, tag, count(*) AS m FROM listed GROUP BY word, tag),
pairs AS (
  SELECT a.tag AS tag1, b.tag AS tag2, CAST(sum(a.m * b.m) AS BIGINT) AS twotagnum
  FROM multi a JOIN multi b ON a.word = b.word AND a.tag > b.tag GROUP BY a.tag, b.tag),
cooccur AS (
  SELECT tag1, tag2, x.n AS tag1num, y.n AS tag2num, twotagnum
  FROM pairs JOIN tag_counts x ON x.tag = tag1 JOIN tag_counts y ON y.tag = tag2)"""


STRONG = """,
edges AS (
  SELECT CASE WHEN tag1num > tag2num THEN tag2 ELSE tag1 END AS child,
         CASE WHEN tag1num > tag2num THEN tag1 ELSE tag2 END AS parent
  FROM cooccur WHERE twotagnum > 10 AND trunc(least(tag1num, tag2num) * CAST(0.9 AS DOUBLE)) < twotagnum)"""

EDGES = CUSTOMER_TERMS + ",\n" + clean("customer_terms", "terms", 1) + ",\n" + counted("terms") + STRONG
DEEP_EDGES = LAYERED_TERMS + ",\n" + clean("layered_terms", "terms", 1) + ",\n" + counted("terms") + STRONG

LEVELS = """,
levels(tag, level) AS (
  SELECT DISTINCT parent, 0 FROM edges WHERE parent NOT IN (SELECT child FROM edges)
  UNION
  SELECT e.child, level + 1 FROM levels JOIN edges e ON e.parent = levels.tag),
depths AS (SELECT tag, max(level) AS d FROM levels GROUP BY tag),
kept AS (
  SELECT e.child, e.parent, p.d + 1 AS round
  FROM edges e JOIN depths p ON p.tag = e.parent
  WHERE NOT EXISTS (
    SELECT 1 FROM edges up JOIN edges over ON over.child = up.parent JOIN depths t ON t.tag = over.parent
    WHERE up.child = e.child AND t.d = p.d)),
layers AS (
  SELECT child AS tag, max(round) AS layer FROM kept GROUP BY child
  UNION ALL
  SELECT DISTINCT parent, 0 FROM kept WHERE round = 1)"""

LAYERS = EDGES + LEVELS
DEEP_LAYERS = DEEP_EDGES + LEVELS

HUNG = """,
hung AS (
  SELECT child, parent FROM (
    SELECT child, parent, row_number() OVER (PARTITION BY child ORDER BY round, parent) AS rn FROM kept)
  WHERE rn = 1),
paths(tag, path) AS (
  SELECT tag, [tag] FROM layers WHERE layer = 0
  UNION ALL
  SELECT child, list_append(path, child) FROM hung JOIN paths ON hung.parent = paths.tag)"""

PATHS = LAYERS + HUNG
DEEP_PATHS = DEEP_LAYERS + HUNG

CLASSES = r"""class_lines AS (
  SELECT DISTINCT lang || '|' || source AS tag, ascii(lang) - 100 AS cls FROM documents
  UNION ALL
  SELECT DISTINCT source, CAST(regexp_extract(source, '\d+') AS INTEGER) // 7 FROM documents),
tag_classes AS (SELECT tag, max(cls) AS cls FROM class_lines GROUP BY tag)"""

CLASSIFIED = (
    LOOSE_DOCS
    + ",\n"
    + CLASSES
    + """,
votes AS (
  SELECT word, cls, count(*) AS n
  FROM (SELECT word, unnest(string_split(tags, ',')) AS tag FROM terms) JOIN tag_classes USING (tag)
  GROUP BY word, cls),
voted AS (
  SELECT word, cls FROM (
    SELECT word, cls, row_number() OVER (PARTITION BY word ORDER BY n DESC, cls) AS rn FROM votes)
  WHERE rn = 1),
classified AS (SELECT word, rel, relwords, cls FROM terms JOIN voted USING (word))"""
)

KEYWORDS = r"""tokens AS (SELECT doc_id, source, text, regexp_split_to_array(text, '[ \t\r\n]+') AS t FROM documents),
rows AS (
  SELECT doc_id, lower(trim(t[1] || '/' || source)) AS w, lower(coalesce(t[2], '')) AS input,
         lower(trim(coalesce(t[3], '') || ',' || coalesce(t[4], ''))) AS dirs,
         lower(trim(t[1] || coalesce(t[3], '') || ' ' || text, E' \t\r\n')) AS meta_keywords
  FROM tokens)"""


def synonyms(rows: str) -> str:
    """Synonym relation of ``rows`` (id, w, input, dirs, meta_keywords)."""
    return f"""split AS (
  SELECT id, CASE WHEN w <> '' AND replace(w, '/', '') = '' THEN w ELSE split_part(w, '/', 1) END AS word, input,
         CASE WHEN rtrim(dirs, ',') = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(rtrim(dirs, ','), ',') END AS d,
         meta_keywords
  FROM {rows} WHERE NOT regexp_matches(w, '[ \\t]')),
removal AS (
  SELECT id, pos, 0 AS part, 0 AS sub, word || d[pos] AS item FROM split, unnest(generate_series(1, len(d))) s(pos)
  UNION ALL
  SELECT id, pos, 0, 1, input || d[pos] FROM split, unnest(generate_series(1, len(d))) s(pos) WHERE word <> input
  UNION ALL
  SELECT id, pos, 1, 0, d[pos] FROM split, unnest(generate_series(1, len(d))) s(pos)),
removals AS (
  SELECT id, list(item ORDER BY part, length(item) DESC, pos, sub) AS items FROM removal WHERE item <> '' GROUP BY id),
stripped AS (
  SELECT split.*, CASE WHEN items IS NULL THEN meta_keywords ELSE list_reduce(
           list_concat([meta_keywords], items), lambda a, x: replace(a, x, ' ')) END AS rest
  FROM split LEFT JOIN removals USING (id)),
words AS (
  SELECT id, word, input, unnest(k) AS k, generate_subscripts(k, 1) AS pos FROM (
    SELECT id, word, input, CASE
             WHEN rest = '' THEN ['']
             WHEN regexp_replace(rest, '[ \\t]+$', '') = '' THEN CAST([] AS VARCHAR[])
             ELSE regexp_split_to_array(regexp_replace(rest, '[ \\t]+$', ''), '[ \\t]+') END AS k
    FROM stripped)),
firsts AS (SELECT id, k, min(pos) AS pos FROM words WHERE k <> word AND k <> input GROUP BY id, k),
found AS (SELECT id, string_agg(k, ',' ORDER BY pos) AS syno FROM firsts GROUP BY id)
SELECT word, input, coalesce(syno, '') AS syno, array_to_string(d, ',') AS dir_words, meta_keywords
FROM stripped LEFT JOIN found USING (id)"""


TOKENS = r"""tokens AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS token
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[^\p{L}\p{N}]+'), lambda x: x <> '') AS l
        FROM documents))"""

BENCHMARK = r"""lexicon AS (
  SELECT DISTINCT word, 'n' || length(word) AS nature
  FROM (SELECT unnest(regexp_split_to_array(text, '[^\p{L}\p{N}]+')) AS word FROM benchmark) WHERE word <> '')"""

USER_WORDS = r"""user_words AS (
  SELECT word, max(role) AS nature
  FROM (SELECT role, unnest(regexp_split_to_array(text, '[^\p{L}\p{N}]+')) AS word FROM conversations)
  WHERE word <> '' GROUP BY word)"""


def decoded(c: str) -> str:
    """Text of ``c`` with the entities of the pages decoded and blanks collapsed."""
    plain = (
        f"replace(replace(replace({c}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"')"
    )
    return f"trim(regexp_replace(regexp_replace({plain}, '&amp;?', '&', 'g'), '[ \\t\\r\\n\\f]+', ' ', 'g'))"


HOST = "regexp_extract(url, '//([^/]*)', 1)"
LANG = "regexp_extract(url, '/([a-z][a-z])/', 1)"
# Links up to a cut-off end of the page: a tag without its closing bracket is no text.
ANCHORS = r"""anchors AS (
  SELECT page_id, url, CAST(generate_subscripts(h, 1) AS INTEGER) AS pos, unnest(h) AS href, unnest(x) AS inner_source
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)', 1) AS h,
               regexp_extract_all(html, '<a href="(/[^"]*)">([^<]*)', 2) AS x FROM pages))"""
BODY_SOURCE = r"""body_source AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           regexp_extract(html, '(?s)<body>(.*)$', 1),
           '(?s)<!--.*?-->', '', 'g'),
           '(?s)<[a-zA-Z/!][^>]*$', ''),
           '<(p|li|ul|nav|div|article|h1|footer|br)[^>]*>', ' ', 'g'),
           '<[^>]*>', '', 'g') AS t
  FROM pages)"""


def put(ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


ORACLES = {
    "string_rules": r"""
WITH t AS (
  SELECT doc_id, source || '/' || lang AS trimmed, source AS base,
         string_split(rtrim(regexp_replace(text, '[ \t\r\n]+', ',', 'g'), ','), ',') AS items,
         regexp_split_to_array(regexp_replace(text, '[ \t\r\n]+$', ''), '[ \t\r\n]+') AS parts
  FROM documents),
long AS (
  SELECT doc_id, w, min(pos) AS pos FROM (
    SELECT doc_id, unnest(items) AS w, generate_subscripts(items, 1) AS pos FROM t)
  WHERE length(w) > 12 GROUP BY doc_id, w)
SELECT doc_id, trimmed, base, CAST(len(items) AS INTEGER) AS n_items, items[-1] AS last_item,
       CAST(len(parts) AS INTEGER) AS n_parts,
       coalesce((SELECT string_agg(w, ',' ORDER BY pos) FROM long l WHERE l.doc_id = t.doc_id), '') AS long_items
FROM t""",
    "clean_terms": put(
        DOC_TERMS + ",\n" + clean("doc_terms", "terms", 2), "SELECT word, relwords, raw_tags AS tags FROM terms"
    ),
    "clean_terms_loose": put(LOOSE_DOCS, "SELECT word, relwords, tags FROM terms"),
    "tag_count": put(LOOSE_DOCS + ",\n" + counted("terms"), "SELECT tag, n FROM tag_counts"),
    "tag_cooccur": put(LOOSE_DOCS + ",\n" + counted("terms"), "SELECT * FROM cooccur"),
    "tag_edges": put(EDGES, "SELECT child, parent FROM edges"),
    "edge_lines": put(EDGES, "SELECT child || '>' || parent AS value FROM edges"),
    "tag_kept": put(LAYERS, "SELECT child, parent, CAST(round AS INTEGER) AS round FROM kept", True),
    "tag_layers": put(LAYERS, "SELECT tag, CAST(layer AS INTEGER) AS layer FROM layers", True),
    "tag_paths": put(
        PATHS, "SELECT tag, array_to_string(path, '>') AS path, CAST(len(path) - 1 AS INTEGER) AS depth FROM paths", True
    ),
    "path_scan": put(
        PATHS, "SELECT tag, array_to_string(path, '>') AS path, CAST(len(path) - 1 AS INTEGER) AS depth FROM paths", True
    ),
    "tag_paths_for_terms": put(
        PATHS
        + """,
tagged AS (SELECT word, string_split(tags, ',') AS tags FROM terms),
unrolled AS (SELECT word, tags, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos FROM tagged),
found AS (
  SELECT u.word, u.tags, u.tag, u.pos, coalesce(p.path, ['']) AS path,
         len(list_filter(u.tags, lambda x: list_contains(coalesce(p.path, ['']), x))) AS n
  FROM unrolled u LEFT JOIN paths p ON p.tag = u.tag),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, pos) AS rn FROM found) WHERE rn = 1),
idx AS (SELECT word, string_agg(tag || '/' || len(path), ',' ORDER BY n DESC, pos) AS tagidx FROM found GROUP BY word)""",
        """SELECT best.word, array_to_string(tags, ',') AS tags, tag AS endtag, array_to_string(path, '-') AS taglayer,
       coalesce(array_to_string(list_filter(tags, lambda x: NOT list_contains(path, x)), ','), '') AS unmatchtag, tagidx
FROM best JOIN idx ON idx.word = best.word""",
        True,
    ),
    "deep_kept_lines": put(DEEP_LAYERS, "SELECT child || '>' || parent AS value FROM kept", True),
    "deep_layer_lines": put(DEEP_LAYERS, "SELECT tag || ' ' || CAST(layer AS INTEGER) AS value FROM layers", True),
    "deep_paths": put(
        DEEP_PATHS, "SELECT tag, array_to_string(path, '>') AS path, CAST(len(path) - 1 AS INTEGER) AS depth FROM paths", True
    ),
    "classified_snapshot": put(
        CLASSIFIED,
        "SELECT word AS bk_word, relwords AS bk_relwords, CAST(cls AS INTEGER) AS bk_tag, '2017-06-12' AS stat_date FROM classified",
    ),
    "nature_fixed": f"""
WITH codes AS (SELECT unnest({sorted(TAG_NATURE)}) AS tag, unnest({[TAG_NATURE[t] for t in sorted(TAG_NATURE)]}) AS nature),
listed AS (
  SELECT c_name, c_mktsegment, ({sorted(TAG_NATURE)})[c_nationkey % {len(TAG_NATURE)} + 1] AS a,
         ({sorted(TAG_NATURE)})[(7 * c_nationkey + 3) % {len(TAG_NATURE)} + 1] AS b FROM customer)
SELECT c_name AS word, c_mktsegment || ',' || a || ',' || b AS tags, nature, CAST(length(c_name) AS VARCHAR) AS word_len
FROM listed JOIN codes ON codes.tag = a""",
    "tag_class_scan": put(CLASSES, "SELECT tag, CAST(cls AS INTEGER) AS cls FROM tag_classes"),
    "classify_terms": put(CLASSIFIED, "SELECT word, relwords, CAST(cls AS INTEGER) AS cls FROM classified"),
    "related_by_class": put(
        CLASSIFIED
        + """,
related AS (
  SELECT word, cls, r, count(*) AS n FROM (SELECT word, cls, unnest(rel) AS r FROM classified) GROUP BY word, cls, r)""",
        """SELECT a.word, CAST(a.cls AS INTEGER) AS cls, CAST(coalesce(b.cls, -1) AS INTEGER) AS relcls,
       string_agg(r || '/' || n, ',' ORDER BY n DESC, r DESC) AS relwords
FROM related a LEFT JOIN classified b ON b.word = a.r GROUP BY a.word, a.cls, coalesce(b.cls, -1)""",
    ),
    "nature_scan": put(
        DOC_TERMS, "SELECT bk_word, bk_tags FROM doc_terms WHERE bk_tags <> '' AND length(bk_word) BETWEEN 2 AND 23"
    ),
    "nature_label": put(
        DOC_TERMS
        + """,
natures AS (
  SELECT DISTINCT lang || '|' || source AS tag, 'mz' || lang AS nature FROM documents
  UNION ALL SELECT DISTINCT source, 'mzs' || source[-1] FROM documents),
senses AS (
  SELECT DISTINCT """
        + base(trimmed("bk_word"))
        + """ AS word, string_split(rtrim("""
        + trimmed("bk_tags")
        + """, ','), ',') AS tags
  FROM doc_terms WHERE bk_tags <> '' AND length(bk_word) BETWEEN 2 AND 23),
unrolled AS (SELECT word, tags, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos FROM senses),
mapped AS (
  SELECT word, tags, nature, row_number() OVER (PARTITION BY word, tags ORDER BY pos) AS rn
  FROM unrolled JOIN natures USING (tag)),
ranked AS (
  SELECT word, array_to_string(tags, ',') AS tags, nature, row_number() OVER (
           PARTITION BY word ORDER BY len(tags) DESC, array_to_string(tags, ',') DESC) AS rn
  FROM mapped WHERE rn = 1)""",
        "SELECT word, tags, nature, CAST(length(word) AS VARCHAR) AS word_len FROM ranked WHERE rn = 1",
    ),
    "html_links": put(
        ANCHORS,
        f"""SELECT p.page_id, coalesce(string_agg(replace({decoded("inner_source")}, 'tion', ''), ',' ORDER BY pos), '') AS links
FROM pages p LEFT JOIN anchors a ON a.page_id = p.page_id AND a.href NOT LIKE '%ing'
  AND a.href NOT LIKE '%fr=navbar' AND a.href NOT LIKE '%force=1'
GROUP BY p.page_id""",
    ),
    "html_text": put(
        ANCHORS + ",\n" + BODY_SOURCE,
        f"""SELECT b.page_id, {decoded("t")} AS body_text, coalesce(href, '') AS first_href,
       coalesce({decoded("inner_source")}, '') AS first_text, coalesce(inner_source, '') AS first_inner,
       coalesce('<a href="' || href || '">' || inner_source || '</a>', '') AS first_outer
FROM body_source b LEFT JOIN anchors a ON a.page_id = b.page_id AND a.pos = 1""",
    ),
    "html_tags": f"""
SELECT page_id, 0 AS pos, {HOST} AS tag FROM pages
UNION ALL SELECT page_id, 1, trim({LANG} || ' & more') FROM pages""",
    "html_input": "SELECT page_id, url AS input FROM pages",
    "html_toc": f"SELECT page_id, {HOST} || ',' || trim({LANG} || ' part') AS toc FROM pages",
    "html_meta": f"SELECT page_id, {HOST} || ',' || {LANG} AS meta FROM pages",
    "page_terms": put(
        ANCHORS,
        f"""SELECT p.url AS bk_word,
       'no' || coalesce(',' || string_agg({decoded("inner_source")}, ',' ORDER BY pos), '') AS bk_relwords,
       regexp_extract(p.url, '//([^/]*)', 1) || ',' || trim(regexp_extract(p.url, '/([a-z][a-z])/', 1) || ' & more') AS bk_tags
FROM pages p LEFT JOIN anchors a ON a.page_id = p.page_id
GROUP BY p.page_id, p.url
UNION ALL SELECT c_name, 'none', 'none' FROM customer""",
    ),
    "page_keywords": f"""
SELECT url AS bk_word, url AS bk_input, {HOST} || ',' || {LANG} AS meta_keywords,
       {HOST} || ',' || trim({LANG} || ' part') AS dir_words
FROM pages""",
    "page_synonyms": put(
        f"""pages_in AS (
  SELECT page_id AS id, lower(url) AS w, lower(url) AS input, lower({HOST} || ',' || trim({LANG} || ' part')) AS dirs,
         lower({HOST} || ',' || {LANG}) AS meta_keywords FROM pages)""",
        "",
    )
    + ",\n"
    + synonyms("pages_in"),
    "synonyms": put(KEYWORDS, "")
    + ",\n"
    + synonyms("(SELECT doc_id AS id, w, input, dirs, meta_keywords FROM rows)"),
    "tokenize": put(TOKENS, "SELECT doc_id, pos, token FROM tokens"),
    "tokens_with_nature": put(
        TOKENS + ",\n" + BENCHMARK + ",\n" + USER_WORDS,
        """SELECT doc_id, pos, token, coalesce(u.nature, l.nature, 'x') AS nature
FROM tokens LEFT JOIN user_words u ON u.word = token LEFT JOIN lexicon l ON l.word = token""",
    ),
    "lexicon_matches": put(
        TOKENS
        + ",\n"
        + BENCHMARK
        + """,
places AS (
  SELECT doc_id, pos, token, CAST(unnest(range(0, length(token))) AS INTEGER) AS start FROM tokens),
prefixes AS (
  SELECT doc_id, pos, start, unnest(list_transform(range(1, length(token) - start + 1),
           lambda n: substring(token, start + 1, n))) AS word
  FROM places),
hits AS (
  SELECT doc_id, pos, start, word, nature, row_number() OVER (
           PARTITION BY doc_id, pos, start ORDER BY length(word) DESC) AS rn
  FROM prefixes JOIN lexicon USING (word))""",
        """SELECT word, nature, count(*) AS n, CAST(sum(start) AS BIGINT) AS starts, CAST(sum(pos) AS BIGINT) AS places
FROM hits WHERE rn = 1 GROUP BY word, nature""",
    ),
    # The best way to each place of a distinct token, place by place, then the parts of the last one.
    "segment_tokens": "WITH RECURSIVE " + TOKENS + ",\n" + USER_WORDS + r""",
counted AS (
  SELECT word, 'n' || length(word) AS nature, count(*) AS frequency
  FROM (SELECT unnest(regexp_split_to_array(text, '[^\p{L}\p{N}]+')) AS word FROM benchmark) WHERE word <> '' GROUP BY word),
words AS (
  SELECT coalesce(u.word, c.word) AS word, coalesce(u.nature, c.nature) AS nature,
         CASE WHEN u.word IS NOT NULL THEN 1024 ELSE c.frequency END AS frequency
  FROM (SELECT * FROM user_words WHERE length(word) <= 3) u FULL JOIN counted c ON u.word = c.word),
every AS (SELECT CAST(sum(frequency) AS DOUBLE) AS f FROM words),
lexicon AS (SELECT word, nature, CAST(round(ln(f / frequency) * 1000000) AS BIGINT) AS cost FROM words, every),
distinct_tokens AS (SELECT DISTINCT token FROM tokens),
places AS (SELECT token, CAST(unnest(range(0, length(token))) AS INTEGER) AS a FROM distinct_tokens),
prefixes AS (SELECT token, a, unnest(range(1, length(token) - a + 1)) AS n FROM places),
edges AS (
  SELECT token, a, CAST(p.n AS INTEGER) AS n, cost, nature FROM prefixes p JOIN lexicon ON word = substring(token, a + 1, p.n)
  UNION ALL
  SELECT token, a, 1, (SELECT CAST(round(ln(f / 0.5) * 1000000) AS BIGINT) FROM every), 'x'
  FROM places WHERE substring(token, a + 1, 1) NOT IN (SELECT word FROM words)),
best(token, i, ways) AS (
  SELECT token, 0, [{'cost': 0::BIGINT, 'words': 0, 'starts': []::INTEGER[], 'natures': []::VARCHAR[]}] FROM distinct_tokens
  UNION ALL
  SELECT b.token, b.i + 1, list_append(any_value(b.ways), min({'cost': b.ways[e.a + 1].cost + e.cost, 'words': b.ways[e.a + 1].words + 1,
           'starts': list_append(b.ways[e.a + 1].starts, e.a), 'natures': list_append(b.ways[e.a + 1].natures, e.nature)}))
  FROM best b JOIN edges e ON e.token = b.token AND e.a + e.n = b.i + 1 GROUP BY b.token, b.i),
paths AS (SELECT token, ways[len(ways)] AS way FROM best WHERE i = length(token)),
parts AS (
  SELECT token, CAST(generate_subscripts(way.starts, 1) - 1 AS INTEGER) AS part, unnest(way.starts) AS start,
         unnest(list_append(way.starts[2:], CAST(length(token) AS INTEGER))) AS stop, unnest(way.natures) AS nature FROM paths)
SELECT substring(token, start + 1, stop - start) AS word, nature, count(*) AS n, CAST(sum(part) AS BIGINT) AS parts,
       CAST(sum(start) AS BIGINT) AS starts, CAST(sum(pos) AS BIGINT) AS places
FROM tokens JOIN parts USING (token) GROUP BY ALL""",
    "drop_stopwords": put(
        TOKENS + ",\n" + BENCHMARK,
        "SELECT doc_id, pos, token FROM tokens WHERE token NOT IN (SELECT word FROM lexicon)",
    ),
    "scan_kv_text": r"""
SELECT url AS key, regexp_replace(html, '[\r\n]', ' ', 'g') AS body FROM pages
UNION ALL SELECT c_name, 'none' FROM customer""",
    "read_lenient": r"""
SELECT line, count(*) AS n FROM (
  SELECT unnest(string_split(CASE WHEN lang = 'en' THEN '百科 ' || regexp_replace(text, '[^\x00-\x7f]', '?', 'g')
                             ELSE text END, chr(10))) AS line
  FROM documents)
GROUP BY line""",
    "snapshot_scan": """
SELECT doc_id, n_chars, 'one' AS dates FROM documents WHERE lang <> 'en'
UNION ALL SELECT doc_id, n_chars, 'all' FROM documents WHERE lang <> 'en'
UNION ALL SELECT doc_id, n_chars, 'all' FROM documents""",
    "write_table": put(
        DOC_TERMS + ",\n" + clean("doc_terms", "terms", 2),
        "SELECT word AS bk_word, relwords AS bk_relwords, raw_tags AS bk_tags FROM terms",
    ),
    "failed_pages": """
SELECT page_id, url AS value, 2 AS sections, '' AS reason FROM pages
UNION ALL SELECT -page_id - 1, '', 0, '' FROM pages
UNION ALL SELECT -page_id - 1, 'input', -1, 'missing' FROM pages""",
    "clean_in_place": put(
        DOC_TERMS + ",\n" + clean("doc_terms", "terms", 2),
        """SELECT word AS bk_word, relwords AS bk_relwords, raw_tags AS bk_tags FROM terms
UNION ALL SELECT '20170612', CAST(count(*) AS VARCHAR), CAST(sum(doc_id) AS VARCHAR) FROM documents WHERE lang <> 'en'
UNION ALL SELECT '20170613', CAST(count(*) AS VARCHAR), CAST(sum(doc_id) AS VARCHAR) FROM documents WHERE lang = 'en'""",
    ),
    "first_lines": "SELECT least(10, count(*)) AS n FROM documents",
}
