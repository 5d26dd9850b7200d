"""SQL (DuckDB) for the queries that it can express, from the tables alone."""

from __future__ import annotations

from presslens.llm import mixing

SPACE = r"[\x20\x09-\x0D]"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

EXACT_DEDUP = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), n AS (SELECT doc_id, length(t) AS points, regexp_replace(t, '{SPACE}', '', 'g') AS plain FROM d)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size, row_number() OVER best = 1 AS kept, sha256(plain) AS text_sha256
FROM n WINDOW best AS (PARTITION BY plain ORDER BY points DESC, doc_id)"""


def _inverse(knots: list[tuple[float, float]], share: str) -> str:
    """The time at which the integral of piecewise linear ``knots`` reaches ``share`` of its total."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    total, done, cases = sum(areas), 0.0, []
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas, strict=False):
        slope, rest = (w1 - w0) / (t1 - t0), f"({share} * {total}::DOUBLE - {done}::DOUBLE)"
        inner = f"{t0}::DOUBLE + (sqrt(greatest(0.0::DOUBLE, {w0 * w0}::DOUBLE + {rest} * ({2 * slope}::DOUBLE))) - {w0}::DOUBLE) / ({slope}::DOUBLE)" if slope else f"{t0}::DOUBLE + {rest} / {w0}::DOUBLE"
        done += area
        cases.append(f"WHEN {share} * {total}::DOUBLE <= {done}::DOUBLE THEN {inner}")
    return f"least({knots[-1][0]}::DOUBLE, CASE {' '.join(cases)} ELSE {knots[-1][0]}::DOUBLE END)"


MIXING = f"""WITH s AS (SELECT doc_id, source, len({WORDS}) AS size FROM documents),
r AS (SELECT source, sum(size)::BIGINT AS source_size, [{', '.join(map(str, mixing.WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight FROM s GROUP BY source),
c AS (SELECT *, source_size * {mixing.MAX_REPEATS} AS cap FROM r),
l AS (SELECT max((b - before) / after) AS level FROM (SELECT (sum(source_size) OVER ())::DOUBLE * {mixing.BUDGET}::DOUBLE AS b, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before,
  (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS after FROM c WINDOW o AS (ORDER BY cap / weight, cap, weight, source))),
t AS (SELECT source, source_size, weight, least(cap::DOUBLE, level * weight) AS target FROM c, l),
p AS (SELECT doc_id, size, source_size, weight, target, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5(doc_id::VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
w AS (SELECT *, {', '.join(f'greatest(0, least(size, round(target)::BIGINT - first - {k} * source_size)) AS w{k}' for k in range(mixing.MAX_REPEATS))} FROM p),
x AS (SELECT *, CASE {' '.join(f'WHEN w{k} > 0 THEN least(1.0::DOUBLE, (first + {k} * source_size)::DOUBLE / target)' for k in range(mixing.MAX_REPEATS))} END AS share FROM w)
SELECT doc_id, size, source_size, target, ({' + '.join(f'w{k}' for k in range(mixing.MAX_REPEATS))})::BIGINT AS taken, CASE {' '.join(f'WHEN share IS NOT NULL AND weight = {w} THEN {_inverse(k, "share")}' for w, k in mixing.SCHEDULES.items())} END AS position,
  {' + '.join(f'(w{k} > 0)::INT' for k in range(mixing.MAX_REPEATS))} AS passes FROM x"""

SUFFIX_DEDUP = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, unnest(range(0, n - 49)) AS u(i)),
m AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM w JOIN m USING (s) WHERE doc_id > first)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, run),
parts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans),
cut AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n_spans, max(b) AS last, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept FROM parts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256 FROM d LEFT JOIN cut USING (doc_id)"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NGRAM_JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END)) AS l FROM d),
n AS (SELECT doc_id, len(l) AS n, CASE WHEN len(l) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY l) END AS class_id FROM s),
t AS (SELECT s.doc_id, unnest(l) AS x FROM s JOIN n USING (doc_id) WHERE doc_id = class_id),
e AS (SELECT a, b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common FROM t p JOIN t q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 80 * (na.n + nb.n - common)),
f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT class_id AS a, class_id AS b FROM n UNION SELECT r.a, f.b FROM r JOIN f ON r.b = f.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, n::BIGINT AS n_shingles, component_id, class_id FROM n JOIN c ON class_id = a"""

_CONTROL = "regexp_replace({}, '<(\\\\*)\\|', '<\\\\\\1|', 'g')"
_ROLE = _CONTROL.format("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")
CHAT = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said, coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(length('<|im_start|>') + length({_ROLE}) + length('<|im_sep|>') + length({_CONTROL.format('text')}) + length('<|im_end|>') + 1) AS formatted FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars FROM g"""

SQL = {"op3_exact_dedup": EXACT_DEDUP, "op4_mixing": MIXING, "op6_suffix_dedup": SUFFIX_DEDUP, "op7_ngram_jaccard": NGRAM_JACCARD, "op10_chat": CHAT}
