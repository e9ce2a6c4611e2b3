"""DuckDB twins of op11, op12 and op13."""

from __future__ import annotations

from . import importance, mixing, spelling

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_LOWER}')"


def crc32(text: str) -> str:
    """CRC-32 of the UTF-8 of ``text``, bit by bit."""
    bits = (f"list_transform(range(0, 4 * length(hex(encode({text})))), lambda k: ((strpos('0123456789ABCDEF', "
            f"substr(hex(encode({text})), (k // 8 * 2 + CASE WHEN k % 8 < 4 THEN 2 ELSE 1 END)::INT, 1)) - 1) >> (k % 4)) & 1)")
    step = "lambda c, b: xor(c >> 1, 3988292384::BIGINT * (xor(c, b::BIGINT) & 1))"
    return f"xor(list_reduce({bits}, {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


_WORDS = r"[^\x20\x09-\x0D]+"

_OP11 = f"""
WITH RECURSIVE runs AS MATERIALIZED (SELECT doc_id, unnest(regexp_extract_all({lower_ascii("text")}, '[a-zÀ-ÿ]+')) AS run FROM documents),
pairs AS MATERIALIZED (SELECT doc_id, run, COUNT(*) AS n FROM runs WHERE length(run) >= {spelling.MIN_LETTERS} GROUP BY ALL),
hashed AS MATERIALIZED (SELECT run, n, {crc32("doc_id::VARCHAR || ':' || run")} AS h FROM pairs),
words AS MATERIALIZED (
  SELECT word, SUM(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {spelling.DROP_EVERY} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {spelling.MIN_LETTERS} GROUP BY word HAVING SUM(n) >= {spelling.MIN_COUNT}),
skips AS MATERIALIZED (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words),
cut AS MATERIALIZED (SELECT word, n, k, substr(word, 1, k::INT - 1) AS a, substr(word, k::INT + 1) AS b FROM skips),
links AS MATERIALIZED (
  SELECT x.word, y.word AS other, y.n FROM cut x JOIN cut y ON x.k = y.k AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON y.word = x.a || x.b
  UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON y.word = x.a || x.b),
best AS MATERIALIZED (SELECT word, COUNT(*) AS n_near, arg_min(struct_pack(other := other, n := n), struct_pack(a := -n, b := other)) AS top
  FROM links GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, COALESCE(n_near, 0) AS n_near,
    CASE WHEN top.n >= {spelling.RATIO} * w.n THEN top.other END AS form, CASE WHEN top.n >= {spelling.RATIO} * w.n THEN top.n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word),
chain AS (SELECT word, word AS at, form AS up FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.up)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.up IS NULL
"""

_N = len(mixing.SCHEDULES)


def _per_schedule(values) -> str:
    return f"CASE k {' '.join(f'WHEN {i} THEN {float(v)}::DOUBLE' for i, v in enumerate(values))} END"


# the schedules of the query are one line each: weight w at time 0, slope s
_OP12 = f"""
WITH sized AS MATERIALIZED (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS size,
    ('0x' || substr(sha256('{mixing.SEED}:' || COALESCE(doc_id::VARCHAR, '-')), 1, 15))::BIGINT AS order_key FROM documents),
sources AS (SELECT source, SUM(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % {_N} AS k FROM sources),
weighed AS (SELECT *, {_per_schedule(map(mixing.integral, mixing.SCHEDULES))} AS weight,
  {_per_schedule(s[0][1] for s in mixing.SCHEDULES)} AS w, {_per_schedule(s[1][1] - s[0][1] for s in mixing.SCHEDULES)} AS slope,
  source_size * {mixing.MOST}::DOUBLE AS cap FROM ranked),
-- for each source, the level at which the sources that reach their caps before it have taken them
levels AS (SELECT x.source, (SELECT SUM(source_size) FROM sources) * {mixing.SHARE}::DOUBLE
    - COALESCE(SUM(y.cap) FILTER (y.cap / y.weight < x.cap / x.weight), 0) AS rest,
    SUM(y.weight) FILTER (y.cap / y.weight >= x.cap / x.weight) AS weights
  FROM weighed x, weighed y GROUP BY x.source),
level AS (SELECT MAX(rest / weights) AS level FROM weighed w JOIN levels l ON w.source IS NOT DISTINCT FROM l.source
  WHERE rest / weights * weight <= cap),
targets AS (SELECT weighed.*, COALESCE(LEAST(cap, weight * level), cap) AS target FROM weighed, level),
placed AS (SELECT s.doc_id, s.size, t.source_size, t.target, t.weight, t.w, t.slope,
    COALESCE(SUM(s.size) OVER (PARTITION BY s.source ORDER BY s.order_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begun
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (SELECT *, GREATEST(0, LEAST(size, floor(target)::BIGINT - begun)) AS t1,
    GREATEST(0, LEAST(size, floor(target)::BIGINT - source_size - begun)) AS t2, weight * (begun / target) AS u FROM placed)
SELECT doc_id, size, source_size, target, (t1 + t2)::BIGINT AS taken,
  CASE WHEN t1 > 0 THEN CASE WHEN w + sqrt(w * w + 2 * slope * u) > 0
    THEN LEAST(1.0::DOUBLE, 2 * u / (w + sqrt(GREATEST(0.0::DOUBLE, w * w + 2 * slope * u)))) ELSE 0.0::DOUBLE END END AS position
FROM taken
"""

_B = importance.BUCKETS
_FEATURE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_OP13 = f"""
WITH words AS MATERIALIZED (SELECT doc_id, unnest(regexp_extract_all({lower_ascii("text")}, '{_FEATURE}')) AS word FROM documents),
aims AS MATERIALIZED (SELECT unnest(regexp_extract_all({lower_ascii("text")}, '{_FEATURE}')) AS word FROM benchmark),
vocab AS MATERIALIZED (SELECT DISTINCT word FROM (SELECT word FROM words UNION ALL SELECT word FROM aims)),
hashed AS MATERIALIZED (SELECT word, {crc32("word")} % {_B} AS bucket FROM vocab),
s AS (SELECT bucket, COUNT(*) AS n FROM words JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, COUNT(*) AS n FROM aims JOIN hashed USING (word) GROUP BY bucket),
gains AS MATERIALIZED (SELECT bucket, floor(1000 * ln((COALESCE(t.n, 0) + 1)::DOUBLE * ((SELECT COUNT(*) FROM words) + {_B})::DOUBLE
    / ((s.n + 1)::DOUBLE * ((SELECT COUNT(*) FROM aims) + {_B})::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, COUNT(*) AS n_features, SUM(gain)::BIGINT AS weight FROM words JOIN hashed USING (word) JOIN gains USING (bucket)
  GROUP BY doc_id),
scored AS (SELECT d.doc_id, COALESCE(n_features, 0) AS n_features, COALESCE(weight, 0)::BIGINT AS weight, COALESCE(weight, 0)::BIGINT
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('{importance.SEED}:' || d.doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id),
ranked AS (SELECT doc_id, ROW_NUMBER() OVER (ORDER BY score DESC, doc_id) AS r, COUNT(*) OVER () AS n FROM scored
  WHERE n_features >= {importance.MIN_WORDS})
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r <= n * {importance.PERCENT} // 100 THEN r END AS rank
FROM scored s LEFT JOIN ranked ON ranked.doc_id = s.doc_id
"""

ORACLE_SQL = {"op11_spelling": _OP11, "op12_mixing": _OP12, "op13_importance": _OP13}
