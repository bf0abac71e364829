"""SQL of the softmax boosting: the rounds and levels of a short run written out, for DuckDB.

From the definition: gradients of the log loss in units of 2^-24, for each open node the split of greatest gain, leaves
by the regularised Newton step, margins added up over the rounds.
"""

from __future__ import annotations

UNIT = 16777216
NUMERIC = ["age", "mirrors", "collects", "comments", "upvotes", "downvotes", "followship_rank", "followship_score", "max_age",
           "max_mirrors", "max_collects", "max_comments", "post_score", "is_original", "is_content_warning",
           "custom_filters_gardener_flagged"]
CATEGORICAL = ["language", "region", "content_warning", "main_content_focus"]
FEATURES = NUMERIC + CATEGORICAL

VALUES = f"""
rows_ AS MATERIALIZED (
  SELECT l.*, sp.is_test, CASE l.recommend WHEN 'MAYBE' THEN 0 WHEN 'NO' THEN 1 ELSE 2 END AS y
  FROM labelled AS l JOIN sp ON l.post_id = sp.post_id
), nums AS MATERIALIZED (
  {" UNION ALL ".join(f"SELECT post_id, is_test, {i} AS f, CAST({c} AS DOUBLE) AS v FROM rows_" for i, c in enumerate(NUMERIC))}
), cats AS MATERIALIZED (
  {" UNION ALL ".join(f"SELECT post_id, is_test, {len(NUMERIC) + i} AS f, '{c}' AS name, {c} AS s FROM rows_"
                      for i, c in enumerate(CATEGORICAL))}
), sketch AS (
  SELECT f, key, count(*) AS n, min(v) AS v FROM (
    SELECT f, v, CASE WHEN v = 0 THEN 0 ELSE sign(v) * ((floor(log10(abs(v))) + 400) * 1000
      + floor(abs(v) / pow(10.0, floor(log10(abs(v))) - 2))) END AS key
    FROM nums WHERE NOT is_test AND v IS NOT NULL) GROUP BY f, key
), cuts AS (
  SELECT f, list(cut ORDER BY cut) AS cuts FROM (
    SELECT f, place, min(v) AS cut FROM (
      SELECT f, v, coalesce(sum(n) OVER (PARTITION BY f ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 256
        // sum(n) OVER (PARTITION BY f) AS place FROM sketch) GROUP BY f, place)
  WHERE place > 0 GROUP BY f
), codes AS (
  SELECT name, s, row_number() OVER (ORDER BY name, s) - 1 AS code
  FROM (SELECT DISTINCT name, s FROM cats WHERE NOT is_test AND s IS NOT NULL)
), x AS MATERIALIZED (
  SELECT post_id, f, CASE WHEN v IS NULL THEN -1 ELSE coalesce(len(list_filter(cuts, lambda c: c <= v)), 0) END AS bin
  FROM nums LEFT JOIN cuts USING (f)
  UNION ALL SELECT post_id, f, coalesce(code, -1) FROM cats LEFT JOIN codes USING (name, s)
), m0 AS (
  SELECT post_id, is_test, y, k, 0.0::DOUBLE AS m FROM rows_, (VALUES (0), (1), (2)) AS ks(k)
)"""


def _score(g: str, h: str) -> str:
    return f"(({g}) / {UNIT}.0::DOUBLE) * (({g}) / {UNIT}.0::DOUBLE) / (({h}) / {UNIT}.0::DOUBLE + 1.0::DOUBLE)"


def _level(r: int, level: int) -> str:
    """The best split of each node of a level, and the nodes that the rows go to."""
    a, b = f"a{r}_{level}", f"b{r}_{level}"
    left_g, left_h = ("CASE WHEN f < %d THEN upto_%s ELSE %s END + CASE WHEN missing_left THEN missing_%s ELSE 0 END"
                      % (len(NUMERIC), c, c, c) for c in ("g", "h"))
    return f"""
{b} AS MATERIALIZED (
  SELECT *, {_score("left_g", "left_h")} + {_score("all_g - left_g", "all_h - left_h")} - {_score("all_g", "all_h")} AS gain FROM (
    SELECT k, node, f, bin, all_g, all_h, missing_left, {left_g} AS left_g, {left_h} AS left_h FROM (
      SELECT *, sum(g) OVER e AS all_g, sum(h) OVER e AS all_h,
        sum(CASE WHEN bin < 0 THEN g ELSE 0 END) OVER e AS missing_g, sum(CASE WHEN bin < 0 THEN h ELSE 0 END) OVER e AS missing_h,
        sum(CASE WHEN bin < 0 THEN 0 ELSE g END) OVER u AS upto_g, sum(CASE WHEN bin < 0 THEN 0 ELSE h END) OVER u AS upto_h
      FROM (SELECT a.k, a.node, x.f, x.bin, sum(d.g) AS g, sum(d.h) AS h
            FROM {a} AS a JOIN d{r} AS d USING (post_id, k) JOIN x USING (post_id)
            WHERE a.node BETWEEN {2 ** level - 1} AND {2 ** (level + 1) - 2} GROUP BY a.k, a.node, x.f, x.bin)
      WINDOW e AS (PARTITION BY k, node, f), u AS (PARTITION BY k, node, f ORDER BY bin ROWS UNBOUNDED PRECEDING)
    ), (VALUES (true), (false)) AS sides(missing_left))
  WHERE bin >= 0 AND left_h >= {UNIT} AND all_h - left_h >= {UNIT}
  QUALIFY gain > 0.000001 AND row_number() OVER (PARTITION BY k, node ORDER BY gain DESC, f, bin, missing_left DESC) = 1
), a{r}_{level + 1} AS MATERIALIZED (
  SELECT a.post_id, a.k, CASE WHEN b.f IS NULL THEN a.node
    WHEN CASE WHEN x.bin < 0 THEN b.missing_left WHEN b.f < {len(NUMERIC)} THEN x.bin <= b.bin ELSE x.bin = b.bin END
    THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node
  FROM {a} AS a LEFT JOIN {b} AS b USING (k, node) LEFT JOIN x ON x.post_id = a.post_id AND x.f = b.f
)"""


def _round(r: int, depth: int) -> str:
    levels = ",".join(_level(r, level) for level in range(depth))
    return f"""
p{r} AS (
  SELECT *, exp(m - most) / sum(exp(m - most)) OVER (PARTITION BY post_id) AS p
  FROM (SELECT *, max(m) OVER (PARTITION BY post_id) AS most FROM m{r - 1})
), d{r} AS MATERIALIZED (
  SELECT post_id, k, CAST(round((p - CASE WHEN k = y THEN 1 ELSE 0 END) * {UNIT}) AS BIGINT) AS g,
    CAST(round(greatest(2 * p * (1 - p), 1e-16) * {UNIT}) AS BIGINT) AS h FROM p{r} WHERE NOT is_test
), a{r}_0 AS (
  SELECT post_id, k, 0 AS node FROM m{r - 1}
),{levels}, v{r} AS (
  SELECT a.k, a.node, -0.3::DOUBLE * (sum(g) / {UNIT}.0::DOUBLE) / (sum(h) / {UNIT}.0::DOUBLE + 1.0::DOUBLE) AS value
  FROM a{r}_{depth} AS a JOIN d{r} USING (post_id, k) GROUP BY a.k, a.node
), m{r} AS MATERIALIZED (
  SELECT m.post_id, m.is_test, m.y, m.k, m.m + v.value AS m
  FROM m{r - 1} AS m JOIN a{r}_{depth} AS a USING (post_id, k) JOIN v{r} AS v USING (k, node)
)"""


def _rounds(rounds: int, depth: int) -> str:
    return "," + ",".join([VALUES, *(_round(r, depth) for r in range(1, rounds + 1))])


def losses(rounds: int, depth: int) -> str:
    """Mean log loss on both splits after each round, recomputed from the margins."""
    one = " UNION ALL ".join(f"""
SELECT split, CAST({r} AS INTEGER) AS round, avg(loss) AS loss FROM (
  SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, ln(sum(exp(m))) - sum(CASE WHEN k = y THEN m ELSE 0 END) AS loss
  FROM m{r} GROUP BY post_id, is_test) GROUP BY split""" for r in range(1, rounds + 1))
    return _rounds(rounds, depth) + one


def split_counts(rounds: int, depth: int) -> str:
    """Splits, gain and cover per feature."""
    every = " UNION ALL ".join(f"SELECT f, gain, all_h FROM b{r}_{level}" for r in range(1, rounds + 1) for level in range(depth))
    names = ", ".join(f"'{c}'" for c in FEATURES)
    return _rounds(rounds, depth) + f"""
SELECT [{names}][f + 1] AS feature, count(*) AS splits, sum(gain) AS gain, sum(all_h / {UNIT}.0::DOUBLE) AS cover
FROM ({every}) GROUP BY f"""


def prediction_counts(rounds: int, depth: int) -> str:
    """Rows per true and predicted label on the test split; of equal margins the first class."""
    return _rounds(rounds, depth) + f"""
SELECT ['MAYBE', 'NO', 'YES'][y + 1] AS actual, ['MAYBE', 'NO', 'YES'][best + 1] AS predicted, count(*) AS count FROM (
  SELECT post_id, y, arg_min(k, (-m, k)) AS best FROM m{rounds} WHERE is_test GROUP BY post_id, y) GROUP BY y, best"""
