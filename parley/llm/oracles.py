"""DuckDB SQL of the queries in this package that SQL can express over whole tables.

Left out are the shards (their order comes from a seeded generator), the tokenizers and the language model.
"""

from __future__ import annotations

import math
import string
from itertools import combinations

from parley.llm import mixing

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

CHAT = r"""
WITH speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> 'system'),
heads AS (
  SELECT c.conv_id, s.perspective, c.turn, c.role, coalesce(c.role = s.perspective, FALSE) AS is_target,
    CASE WHEN c.role = 'system' THEN '<|system|>'
         WHEN c.role = s.perspective THEN '<|assistant|>'
         ELSE '<|user' || coalesce(' name=' || replace(c.role, '<|', '< |'), '') || '|>' END AS head,
    replace(coalesce(c.text, ''), '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM conversations c JOIN speakers s ON c.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, head || body AS rendered,
    CAST(sum(length(head || body)) OVER (PARTITION BY conv_id, perspective
      ORDER BY turn NULLS LAST, coalesce(role, ''), head || body
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS char_end
  FROM heads)
SELECT conv_id, perspective, turn, role, rendered, char_end - length(rendered) AS char_start, char_end,
  is_target, CASE WHEN is_target THEN char_end - length(body) END AS mask_start,
  CASE WHEN is_target THEN char_end END AS mask_end
FROM placed
"""

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5('7|' || doc_id) AS k FROM documents),
s1 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS source_no
  FROM sized GROUP BY source),
s2 AS (SELECT *, (source_no - 1) % 3 + 1 AS weight, source_size * {mixing.REPEATS} AS cap FROM s1),
s3 AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (ORDER BY cap / weight, source_no
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM s2),
chosen AS (SELECT level FROM s3 WHERE level * weight <= cap ORDER BY cap / weight, source_no LIMIT 1),
s4 AS (
  SELECT s3.* EXCLUDE (level), least(CAST(cap AS DOUBLE), chosen.level * CAST(weight AS DOUBLE)) AS target
  FROM s3, chosen),
plan AS (
  SELECT greatest(1, least({mixing.LARGEST_BLOCK}, CAST(sum(size) AS BIGINT) // {mixing.SLOTS})) AS block FROM sized),
s5 AS (
  SELECT s4.*, greatest((source_size + block - 1) // block, least(source_size, {mixing.LEAST_BLOCKS})) AS blocks FROM s4, plan),
s6 AS (
  SELECT *, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0.0::DOUBLE END AS due FROM s5),
s7 AS (
  SELECT *, least(CAST(floor(due + 0.5) AS BIGINT), blocks * {mixing.REPEATS}) AS quota FROM s6),
s8 AS (
  SELECT *, CASE WHEN quota > 0 THEN greatest(1, CAST(floor(due * (1073741824.0::DOUBLE
      / CAST(sum(quota + 1) OVER () AS DOUBLE))) AS BIGINT)) ELSE 0 END AS arc FROM s7),
s9 AS (
  SELECT *, CAST(sum(arc) OVER (ORDER BY source_no) AS BIGINT) AS hi, CAST(sum(arc) OVER () AS BIGINT) AS circle,
    source_size // nullif(blocks, 0) AS q, source_size % nullif(blocks, 0) AS r FROM s8),
points AS (
  SELECT i, CAST(((i * {mixing.STEP}) % {mixing.CIRCLE})::HUGEINT * (SELECT max(circle) FROM s9) // {mixing.CIRCLE} AS BIGINT) AS place
  FROM range(4 * (SELECT CAST(sum(quota) AS BIGINT) FROM s9) + 64) t(i)),
ranked AS (
  SELECT source_no, blocks, quota, row_number() OVER (PARTITION BY source_no ORDER BY i) - 1 AS rank
  FROM points JOIN s9 ON place >= hi - arc AND place < hi),
times AS (
  SELECT source_no, rank % blocks AS block, count(*) AS times FROM ranked WHERE rank < quota GROUP BY ALL),
placed AS (
  SELECT d.*, s.source_no, s.source_size, s.target, s.q, s.r,
    CAST(coalesce(sum(size) OVER (PARTITION BY s.source_no ORDER BY substr(k, 1, 3), k, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a
  FROM sized d JOIN s9 s ON d.source IS NOT DISTINCT FROM s.source),
bounds AS (
  SELECT t.source_no, t.times, t.block * q + least(t.block, r) AS lo, (t.block + 1) * q + least(t.block + 1, r) AS up
  FROM times t JOIN s9 USING (source_no)),
part AS (
  SELECT p.doc_id, sum((least(p.a + p.size, b.up) - greatest(p.a, b.lo)) * b.times) AS taken
  FROM placed p JOIN bounds b ON p.source_no = b.source_no AND b.lo < p.a + p.size AND b.up > p.a
  GROUP BY p.doc_id)
SELECT placed.doc_id, source, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM placed LEFT JOIN part USING (doc_id)
"""

BYTE_REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT *, CAST(length(h) // 2 AS BIGINT) AS size FROM d),
w AS (
  SELECT doc_id, i, md5_number(substr(h, CAST(2 * i + 1 AS BIGINT), 200)) AS g
  FROM (SELECT doc_id, unnest(range(size - 99)) AS i, h FROM n WHERE size >= 100)),
firsts AS (SELECT g, min(ROW(doc_id, i)) AS f FROM w GROUP BY g HAVING count(*) > 1),
again AS (SELECT doc_id, i FROM w JOIN firsts USING (g) WHERE ROW(doc_id, i) > f),
runs AS (
  SELECT doc_id, i, lag(i) OVER by_doc AS before, lead(i) OVER by_doc AS after
  FROM again WINDOW by_doc AS (PARTITION BY doc_id ORDER BY i)),
sums AS (
  SELECT doc_id, sum(least(100, coalesce(after - i, 100))) AS gone,
    sum(CASE WHEN before IS NULL OR i - before > 100 THEN 1 ELSE 0 END) AS spans
  FROM runs GROUP BY doc_id),
ends AS (
  SELECT doc_id, i + 100 AS a, after AS b FROM runs WHERE after IS NULL OR after > i + 100
  UNION ALL SELECT doc_id, 0, min(i) FROM again GROUP BY doc_id),
left_over AS (
  SELECT e.doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (coalesce(b, size) - a) AS BIGINT)), '' ORDER BY a) AS kept
  FROM ends e JOIN n USING (doc_id) GROUP BY e.doc_id)
SELECT doc_id, size AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM n LEFT JOIN sums USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

WORD_REPEATS = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM windows) WHERE doc_id > first),
gone AS (SELECT DISTINCT doc_id, i + k AS at FROM again, range(13) t(k)),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM d),
left_over AS (
  SELECT e.doc_id, count(g.at) AS n_removed, string_agg(CASE WHEN g.at IS NULL THEN word END, ' ' ORDER BY e.at) AS kept
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.at = g.at GROUP BY e.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id, doc_id AS root FROM d UNION SELECT y, root FROM reached JOIN both_ways ON x = reached.doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(root) FROM reached r WHERE r.doc_id = d.doc_id) AS component_id
FROM d LEFT JOIN sizes USING (doc_id)
"""

NEAREST = """
WITH ok AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: (c.v[i] - q.v[i]) * (c.v[i] - q.v[i])),
        lambda a, b: a + b)) AS score
    FROM ok q JOIN ok c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0 AND len(q.v) = len(c.v)))
WHERE rank <= 10
"""


#: The quality rules as stated, each with its score and its cutoffs from lenient to strict.
QUALITY_RULES = {
    "n_symbols / n_words": [0.8, 0.5, 0.3, 0.2, 0.1, 0.05],
    "n_dup_lines / n_lines": [0.7, 0.5, 0.4, 0.3, 0.2, 0.1],
    "n_repeat_words / n_words": [0.45, 0.4, 0.3, 0.2, 0.15, 0.1],
    "word_chars / n_words": [30, 20, 15, 12, 10],
    "- word_chars / n_words": [-1.5, -2, -2.5, -3, -3.5],
}
RATE, ERROR = 0.02, 0.05


def _quality() -> str:
    """The search for cutoffs as a recursion over the cutoffs in the order they are tried.

    A language's good documents are counted by how many cutoffs of each rule they pass. Every step makes one
    rule stricter, unless it has failed before, and asks how many good documents all rules reject together.
    """
    cuts = list(QUALITY_RULES.values())
    scores = ", ".join(
        f"CAST({above} AS DOUBLE) / nullif(CAST({below} AS DOUBLE), 0)"
        for above, below in (rule.split(" / ") for rule in QUALITY_RULES)
    )
    steps = [(rule + 1, k) for k in range(1, 7) for rule in range(len(cuts)) if k <= len(cuts[rule])]
    # with m rules frozen, 1 / 2^(m + 1) of the error is shared by all sets of m cutoffs of different rules
    sets = [sum(math.prod(c) for c in combinations(map(len, cuts), m)) for m in range(len(cuts) + 1)]
    shares = [ERROR / 2 ** (m + 1) / n for m, n in enumerate(sets)]
    listed = [f"CAST({x} AS DOUBLE[][])" if i == 0 else str(x) for i, x in enumerate([cuts, shares])]
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, lang, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
repeats AS (
  SELECT doc_id, count(DISTINCT i + t.j) AS n FROM grams, range(3) t(j) WHERE k > 1 GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines
  FROM d JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
rules AS (SELECT {listed[0]} AS cuts, {listed[1]} AS shares, {[list(x) for x in steps]} AS steps),
scored AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [{scores}] AS scores FROM counts),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
passes AS (
  SELECT lang, list_transform(cuts, lambda own, r: len(own) - len(list_filter(own, lambda c: coalesce(scores[r] > c, FALSE)))) AS p
  FROM scored JOIN good USING (doc_id), rules WHERE NOT base_failed),
cells AS (SELECT lang, p, count(*) AS docs FROM passes GROUP BY ALL),
strata AS (
  SELECT lang, sum(docs)::BIGINT AS n, list(struct_pack(p := p, docs := docs)) AS cells, count(*) OVER () AS strata
  FROM cells GROUP BY lang),
search AS (
  SELECT lang, n, cells, strata, 0 AS done, [0, 0, 0, 0, 0] AS levels, []::INTEGER[] AS frozen FROM strata
  UNION ALL
  SELECT lang, n, cells, strata, done + 1,
    CASE WHEN ok THEN tried ELSE levels END,
    CASE WHEN ok OR list_contains(frozen, rule) THEN frozen ELSE list_append(frozen, rule) END
  FROM (
    SELECT *, NOT list_contains(frozen, rule) AND x <= n * {RATE!r}::DOUBLE
        AND list_sum(list_transform(range(least(x, ceil(n * {RATE!r}::DOUBLE)::BIGINT) + 1), lambda i:
          exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RATE!r}::DOUBLE) + (n - i) * ln(1 - {RATE!r}::DOUBLE))))
          <= shares[len(frozen) + 1] / strata AS ok
    FROM (
      SELECT *, coalesce(list_sum(list_transform(cells, lambda c: CASE WHEN len(list_filter(tried, lambda k, r: c.p[r] < k)) > 0
          THEN c.docs ELSE 0 END)), 0)::BIGINT AS x
      FROM (
        SELECT *, list_transform(levels, lambda k, r: CASE WHEN r = rule THEN level ELSE k END) AS tried
        FROM (
          SELECT s.*, shares, CAST(steps[done + 1][1] AS INTEGER) AS rule, CAST(steps[done + 1][2] AS INTEGER) AS level
          FROM search s, rules WHERE done < len(steps)))))),
certified AS (
  SELECT lang, list_transform(levels, lambda k, r: CASE WHEN k > 0 THEN cuts[r][k] END) AS cut
  FROM search, rules WHERE done = len(steps))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (cut IS NULL OR len(list_filter(scores, lambda x, r: coalesce(x > cut[r], FALSE))) = 0) AS kept
FROM scored s LEFT JOIN certified c ON s.lang IS NOT DISTINCT FROM c.lang
"""


def _checksum(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte and bit by bit; 3988292384 is its fixed polynomial."""
    return f"""xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""


#: Runs as the stretches in which words equal those q places on, less those inside a stretch of a smaller q.
RUNS = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, {WORDS} AS w, {_checksum("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h FROM documents),
planted AS (
  SELECT row, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a,
    CASE WHEN h % 10 = 0 AND len(w) > 0 THEN 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) END AS p FROM d),
words AS (
  SELECT row, n, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM planted)),
pairs AS (
  SELECT x.row, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.row = y.row AND x.word = y.word AND y.i > x.i
  WHERE 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pairs)
  GROUP BY row, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (SELECT 1 FROM stretches t WHERE t.row = s.row AND t.q < s.q
    AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
gone AS (SELECT DISTINCT row, unnest(range(start + q, start + length)) AS i FROM runs),
collapsed AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (row, i) GROUP BY row),
found AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines,
    min(struct_pack(l := -length, s := start, q := q)) AS best FROM runs GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(-best.l AS BIGINT) AS length,
  CAST(best.q AS BIGINT) AS period, CAST(1000 * -best.l // best.q AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM d LEFT JOIN found USING (row) LEFT JOIN collapsed USING (row)
"""

TRIE = rf"""
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
sums AS (SELECT conv_id, {_checksum("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM ids),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
parts AS (
  SELECT s.conv_id, 0 AS part, o.pos, o.role, o.text FROM sums s JOIN own o ON o.conv_id = s.conv_id - s.conv_id % 5 AND o.pos <= h
  UNION ALL SELECT s.conv_id, 1, o.pos, o.role, o.text FROM sums s JOIN own o ON o.conv_id = s.conv_id AND o.pos > h),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d,
    md5(length(role) || ':' || role || text) AS t, strlen(text) AS bytes FROM parts),
seqs AS (
  SELECT ids.conv_id, coalesce(list(t ORDER BY d) FILTER (t IS NOT NULL), []) AS s,
    coalesce(list(bytes ORDER BY d) FILTER (t IS NOT NULL), []) AS sizes
  FROM ids LEFT JOIN turns USING (conv_id) GROUP BY ids.conv_id),
prefixes AS (
  SELECT conv_id, d, len(s) AS n, md5(array_to_string(list_slice(s, 1, d), ',')) || d AS node,
    CASE WHEN d > 0 THEN md5(array_to_string(list_slice(s, 1, d - 1), ',')) || (d - 1) END AS parent,
    CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, any_value(d) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
    (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends
  FROM prefixes GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
above AS (
  SELECT p.node, sum(n.saved) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.d <= n.depth LEFT JOIN kids k ON k.node = n.node
  GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
  a.leaves AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN above a ON a.node = n.node LEFT JOIN nodes up ON up.node = n.parent LEFT JOIN kids ON kids.node = n.node
"""


def oracles() -> dict[str, str]:
    return {
        "op1_chat_perspectives": CHAT,
        "op3_mixed_sources": MIX,
        "op5_suffix_dedup": BYTE_REPEATS,
        "op6_jaccard_components": JACCARD,
        "op7_nearest_vectors": NEAREST,
        "op9_quality_rules": _quality(),
        "op10_lz_dedup": WORD_REPEATS,
        "op11_periodic_runs": RUNS,
        "op12_prefix_trie": TRIE,
    }
