"""DuckDB statements for the queries that SQL can express."""

from stallwise.llm import quality_rules

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH rows AS (SELECT doc_id, {_LOWERED} AS t FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY t)
SELECT r.doc_id, g.keep_id, g.group_size, r.doc_id = g.keep_id AS kept, sha256(r.t) AS text_sha256
FROM rows r JOIN groups g USING (t)
"""

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, {_WORDS}) AS w FROM documents
),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWERED}, {_WORDS}) AS w FROM benchmark
),
sized AS (SELECT item, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM sized, unnest(range(1, len(w) - n + 2)) AS t(k)
),
lengths AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS t(k)
),
found AS (SELECT r, n, k, item FROM doc_windows JOIN windows USING (n, win)),
hit AS (SELECT r, count(DISTINCT k + j) AS n_hit FROM found, unnest(range(0, n)) AS t(j) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT r, array_to_string(w[k:k + 3], ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(k) WHERE len(w) > 0
),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
linked AS (
  SELECT a, b FROM shared JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * i >= 85 * (x.n + y.n - i)
),
edges AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reached(r, t) AS (SELECT r, r FROM d UNION SELECT reached.r, edges.b FROM reached JOIN edges ON edges.a = reached.t)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(e.doc_id) AS component_id
FROM d LEFT JOIN n ON n.r = d.r JOIN reached ON reached.r = d.r JOIN d e ON e.r = reached.t
GROUP BY d.r, d.doc_id
"""


_BLANK_WORDS = r"'[^\x20\x09-\x0D]+'"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, a bit at a time."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: list_transform(range(8), lambda b: (ascii(substr({text}, i, 1)) >> b) & 1)))"
    start = f"list_concat([4294967295], list_transform({bits}, lambda b: CAST(b AS BIGINT)))"
    step = "CASE WHEN ((c & 1) + b) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce({start}, lambda c, b: {step}), 4294967295)"


def _rule(rule: quality_rules.Rule) -> str:
    parts = [f"1000 * {rule.count} >= {rule.least} * {rule.of}"] if rule.least is not None else []
    parts += [f"1000 * {rule.count} <= {rule.most} * {rule.of}"] if rule.most is not None else []
    return f"(({' AND '.join(parts)}) OR {rule.of} < {rule.fewest})"


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for some in quality_rules.STOP_WORDS.values() for w in some.split()}))

QUALITY_RULES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT r, doc_id, t, regexp_extract_all(t, {_BLANK_WORDS}) AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_BLANK_WORDS})) AS lines,
    regexp_extract_all(translate(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:!?"''()', ''),
      {_BLANK_WORDS}) AS plain
  FROM d
),
windows AS (SELECT r, k, array_to_string(w[k:k + 4], ' ') AS win FROM parts, unnest(range(1, len(w) - 3)) AS u(k)),
twice AS (SELECT r, k, count(*) OVER (PARTITION BY r, win) AS n FROM windows),
repeated AS (SELECT r, count(DISTINCT k + j) AS n_repeat_words FROM twice, unnest(range(0, 5)) AS u(j) WHERE n > 1 GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]'))) AS BIGINT) AS n_letter_words,
    CAST(len(list_filter(plain, lambda x: x IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]'))) AS BIGINT) AS n_bullet_lines,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*\\z'))) AS BIGINT) AS n_ellipsis_lines
  FROM parts LEFT JOIN repeated USING (r)
),
judged AS (
  SELECT *, n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED_PERCENT} * n_words AS base_failed FROM m
)
SELECT *, NOT base_failed AND {" AND ".join(map(_rule, quality_rules.RULES))} AS kept,
  concat_ws(',', {", ".join(f"CASE WHEN NOT {_rule(r)} THEN '{r.name}' END" for r in quality_rules.RULES)}) AS failed_rules
FROM judged
"""


PERIODIC_RUNS = f"""
WITH original AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {_BLANK_WORDS}) AS w,
    {crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h
  FROM documents
),
places AS (SELECT r, doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM original),
d AS (
  SELECT r, doc_id, CASE WHEN doc_id IS NOT NULL AND h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
    ELSE w END AS w
  FROM places
),
words AS (SELECT r, i - 1 AS i, w[i] AS word, len(w) AS n FROM d, unnest(range(1, len(w) + 1)) AS u(i)),
pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT r, q, min(i) AS s, count(*) + q AS n FROM islands GROUP BY r, q, island HAVING count(*) >= q AND count(*) + q >= 12),
runs AS (SELECT r, s, n, min(q) AS q FROM stretches GROUP BY r, s, n),
dropped AS (SELECT DISTINCT r, i FROM runs, unnest(range(s + q, s + n)) AS u(i)),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN dropped USING (r, i) GROUP BY r
),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    list(struct_pack(s := s, n := n, q := q) ORDER BY n DESC, s, q)[1] AS best
  FROM runs GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.n AS BIGINT) AS length,
  CAST(best.q AS BIGINT) AS period, CAST(1000 * best.n // best.q AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""


CONVERSATION_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(text, '') AS text, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id, turn
  FROM conversations WHERE conv_id IS NOT NULL
),
placed AS (
  SELECT conv_id, id, len(regexp_extract_all(text, {_BLANK_WORDS})) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(id, 1, 32)) AS pos
  FROM turns
),
convs AS (SELECT DISTINCT conv_id, {crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM turns),
rebuilt AS (
  SELECT c.conv_id, p.pos, id, words FROM convs c JOIN placed p ON p.conv_id = c.conv_id - c.conv_id % 20 AND p.pos <= c.h
  UNION ALL
  SELECT c.conv_id, p.pos, id, words FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.pos > c.h
),
prefixes AS (
  SELECT conv_id, 0 AS depth, '' AS prefix, NULL AS parent, 0 AS words FROM convs
  UNION ALL
  SELECT conv_id, row_number() OVER w AS depth, string_agg(id, '') OVER w AS prefix,
    coalesce(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent, words
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
),
nodes AS (
  SELECT prefix, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words
  FROM prefixes GROUP BY prefix
),
children AS (SELECT parent AS prefix, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT p.prefix, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN children c ON c.prefix = n.prefix
  GROUP BY p.prefix
),
last AS (SELECT conv_id, max_by(prefix, depth) AS prefix FROM prefixes GROUP BY conv_id),
ends AS (SELECT prefix, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM last GROUP BY prefix)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN below USING (prefix) LEFT JOIN nodes up ON up.prefix = n.parent LEFT JOIN children c ON c.prefix = n.prefix
  LEFT JOIN ends e ON e.prefix = n.prefix
"""


def statements() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP,
        "op2_ngram_join": NGRAM_JOIN,
        "op4_decontamination": DECONTAMINATION,
        "op11_periodic_runs": PERIODIC_RUNS,
        "op12_quality_rules": QUALITY_RULES,
        "op13_conversation_trie": CONVERSATION_TRIE,
    }
