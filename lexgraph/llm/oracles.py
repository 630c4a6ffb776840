"""DuckDB SQL of the operators that SQL can express on whole tables."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from lexgraph.llm.rules import CLASSES, COMMON_WORDS, RuleParams, vocabulary

WORDS = r"""lists AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
words AS (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS word FROM lists)"""

SUBSTRING = f"""WITH {WORDS},
windows AS (
  SELECT doc_id, pos, string_agg(word, ' ') OVER w AS k, count(*) OVER w AS n FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS rn FROM windows WHERE n = 20)
  WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_words, CAST(len(l) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM lists LEFT JOIN kept USING (doc_id)"""

NEAR = f"""WITH RECURSIVE {WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')")},
runs AS (
  SELECT doc_id, pos, string_agg(word, ' ') OVER w AS k, count(*) OVER w AS n FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
shingles AS (
  SELECT DISTINCT doc_id, k FROM runs WHERE n = 3
  UNION SELECT doc_id, array_to_string(l, ' ') FROM lists WHERE len(l) BETWEEN 1 AND 2),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, other) AS (
  SELECT u, v FROM both_ways
  UNION
  SELECT reach.doc_id, v FROM reach JOIN both_ways ON other = u),
smallest AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id <= coalesce(m, doc_id) AS kept
FROM lists LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest USING (doc_id)"""


def quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def distance(p: str, q: str) -> str:
    """Jensen-Shannon distance in bits of two lists of counts; 1 if one is empty."""
    a, b = f"({p}[i] / list_sum({p}))", f"({q}[i] / list_sum({q}))"
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({a} + {b}) / 2)) ELSE 0 END"
    terms = f"list_transform(range(1, len({p}) + 1), lambda i: ({part(a)} + {part(b)}) / 2)"
    return f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(0, list_sum({terms}))) ELSE 1 END"


def rules_sql(p: RuleParams = RuleParams()) -> str:
    n_class, every = len(CLASSES) + 1, vocabulary()
    rest, lengths = "t", ["length(t)"]
    for kind in CLASSES:
        rest = f"regexp_replace({rest}, {quoted(kind + '+')}, '', 'g')"
        lengths.append(f"length({rest})")
    classes = ", ".join(f"{a} - {b}" for a, b in zip(lengths, [*lengths[1:], "0"]))
    common = ", ".join(f"len(list_filter(lw, lambda x: x = {quoted(w)}))" for w in every)
    refs, class_distances, word_distances = [], [], []
    for lang, words in COMMON_WORDS.items():
        at = [every.index(w) + 1 for w in words.split()]
        mine = ", ".join(f"common[{i}]" for i in at)
        sums = ", ".join(f"sum(common[{i}])" for i in at)
        refs.append(
            f"ref_{lang} AS (SELECT [{', '.join(f'sum(classes[{i + 1}])' for i in range(n_class))}] AS c{lang}, "
            f"[{sums}, sum(n_words) - ({sums.replace(', ', ' + ')})] AS w{lang} FROM f WHERE lang = '{lang}')"
        )
        class_distances.append(distance("classes", f"c{lang}"))
        word_distances.append(distance(f"[{mine}, n_words - ({mine.replace(', ', ' + ')})]", f"w{lang}"))
    return f"""WITH {WORDS},
windows AS (
  SELECT doc_id, pos, string_agg(word, ' ') OVER w AS k, count(*) OVER w AS n FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {p.window - 1} FOLLOWING)),
often AS (SELECT doc_id, k FROM windows WHERE n = {p.window} GROUP BY doc_id, k HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + {p.window})) AS pos FROM windows JOIN often USING (doc_id, k) WHERE n = {p.window}),
repeats AS (SELECT doc_id, count(*) AS r FROM covered GROUP BY doc_id),
s AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, l, list_transform(l, lambda x: lower(x)) AS lw,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents JOIN lists USING (doc_id)),
f AS (
  SELECT doc_id, lang, CAST(len(l) AS BIGINT) AS n_words, CAST(length(array_to_string(l, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words,
         [{classes}] AS classes, [{common}] AS common
  FROM s LEFT JOIN repeats USING (doc_id)),
{", ".join(refs)},
own AS (
  SELECT lang, [{', '.join(f'sum(classes[{i + 1}])' for i in range(n_class))}] AS co FROM f
  WHERE lang NOT IN ({', '.join(quoted(lang) for lang in COMMON_WORDS)}) GROUP BY lang),
judged AS (
  SELECT f.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         least({", ".join(class_distances)}) AS cd, least({", ".join(word_distances)}) AS wd, {distance("classes", "co")} AS od
  FROM f LEFT JOIN own ON own.lang = f.lang, {", ".join(f"ref_{lang}" for lang in COMMON_WORDS)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (n_words < {p.min_words} OR (cd <= {p.max_class} AND wd <= {p.max_words}) OR od <= {p.max_class}) AS kept
FROM judged"""


def jaccard_sql(shingle: int = 5, percent: int = 80) -> str:
    """The SQL of near duplicates with other words and another bound, and without ``kept``."""
    sql = NEAR.replace("AND 2 FOLLOWING", f"AND {shingle - 1} FOLLOWING").replace("n = 3", f"n = {shingle}")
    sql = sql.replace("BETWEEN 1 AND 2", f"BETWEEN 1 AND {shingle - 1}").replace(">= 85 *", f">= {percent} *")
    return sql.replace(" AS component_id,\n       doc_id <= coalesce(m, doc_id) AS kept", " AS component_id")


NEGATIVES = """WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM given a JOIN given b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""

CRC32 = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda a, b: list_reduce([xor(a, b)] || range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))))"""


def merkle_field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def merkle_leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(merkle_field(f) for f in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


def merkle_tree(name: str, base: str) -> str:
    """Nodes [g, level, pos, node, n] above those of ``base`` [g, pos, node, n]; n is the number on the level."""
    return f"""{name}(g, level, pos, node, n) AS (
  SELECT g, 0, pos, node, n FROM {base}
  UNION ALL
  SELECT g, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY g, level, pos // 2, n)"""


MERKLE = f"""WITH RECURSIVE digests AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {merkle_leaf("n_chars")} AS node,
         CASE WHEN n_chars IS NOT NULL AND {CRC32} % 7 = 0 THEN {merkle_leaf("n_chars + 1")} END AS claimed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM digests),
{merkle_tree("trees", "leaves")},
parts AS (SELECT '' AS g, g AS part, row_number() OVER (ORDER BY g) - 1 AS pos, node, count(*) OVER () AS n FROM trees WHERE n = 1),
{merkle_tree("crown", "parts")},
up AS (SELECT DISTINCT g, level FROM trees WHERE n > 1),
above AS (SELECT DISTINCT level FROM crown WHERE n > 1),
steps AS (
  SELECT l.g, l.pos, up.level, (l.pos >> up.level) % 2 AS r, coalesce(t.node, '') AS sibling
  FROM leaves l JOIN up USING (g) LEFT JOIN trees t ON t.g = l.g AND t.level = up.level AND t.pos = xor(l.pos >> up.level, 1)
  UNION ALL
  SELECT l.g, l.pos, 1000 + above.level, (p.pos >> above.level) % 2, coalesce(c.node, '')
  FROM leaves l JOIN parts p ON p.part = l.g CROSS JOIN above LEFT JOIN crown c ON c.level = above.level AND c.pos = xor(p.pos >> above.level, 1)),
paths AS (SELECT g, pos, string_agg(sibling, '' ORDER BY level) AS all_of, list(r || sibling ORDER BY level) AS path FROM steps GROUP BY g, pos),
found AS (
  SELECT l.doc_id, l.node AS leaf, p.node AS subroot, (SELECT node FROM crown WHERE n = 1) AS root, sha256(coalesce(all_of, '')) AS proof_sha256,
         list_reduce([coalesce(claimed, l.node)] || coalesce(path, []),
           lambda a, s: sha256(CASE WHEN s[1] = '1' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
  FROM leaves l JOIN parts p ON p.part = l.g LEFT JOIN paths ON paths.g = l.g AND paths.pos = l.pos)
SELECT *, folded_root = root AS verified FROM found"""


ORACLES = {
    "op2_substring": SUBSTRING, "op4_rules": rules_sql(), "op8_neardup": NEAR, "op11_jaccard": jaccard_sql(), "op12_negatives": NEGATIVES,
    "op13_merkle": MERKLE,
}
