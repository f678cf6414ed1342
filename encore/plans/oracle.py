"""DuckDB twins of the catalogue queries.

Each twin is plain SQL over the driver's tables, written the direct way
(``row_number`` over whole groups, ``IN`` subqueries, correlated totals) so
that it checks the distributed formulation of the Spark side rather than
repeating it. Tables available: ``lineitem orders part customer ...``.
"""

from __future__ import annotations

from encore.sources.fixtures import MBID_PREFIX, MSID_PREFIX, NULL_MBID_SIZE_MODULUS, SPLIT_DATE

DECIMALS = 6


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes if c.strip()) + "\n"


BASE = f"""
interactions_all AS (
  SELECT o.o_custkey AS user_id, l.l_shipdate AS ts,
         '{MSID_PREFIX}' || CAST(l.l_partkey AS VARCHAR) AS recording_msid,
         CASE WHEN l.l_shipdate < TIMESTAMP '{SPLIT_DATE}' THEN 'train'
              WHEN l.l_shipdate >= TIMESTAMP '{SPLIT_DATE}' THEN 'test' END AS src
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
tracks_all AS (
  SELECT '{MSID_PREFIX}' || CAST(p_partkey AS VARCHAR) AS recording_msid,
         CASE WHEN p_size % {NULL_MBID_SIZE_MODULUS} = 0 THEN NULL
              ELSE '{MBID_PREFIX}' || CAST(p_partkey - p_partkey % 2 AS VARCHAR) END AS recording_mbid
  FROM part),
listens_all AS (
  SELECT i.user_id, CAST(epoch(i.ts) AS DOUBLE) AS "timestamp",
         COALESCE(t.recording_mbid, t.recording_msid) AS recording_id, i.src
  FROM interactions_all i JOIN tracks_all t ON i.recording_msid = t.recording_msid),
listens AS (SELECT user_id, "timestamp", recording_id FROM listens_all),
listens_train AS (SELECT user_id, "timestamp", recording_id FROM listens_all WHERE src = 'train'),
listens_test AS (SELECT user_id, "timestamp", recording_id FROM listens_all WHERE src = 'test')
"""


def prune(src: str, name: str, bound: int) -> str:
    """Songs with more than ``bound`` listeners, then users with more than
    ``bound`` remaining songs."""
    return f"""
{name}_songs AS (SELECT recording_id FROM {src} GROUP BY recording_id
                 HAVING count(DISTINCT user_id) > {bound}),
{name}_a AS (SELECT * FROM {src} WHERE recording_id IN (SELECT recording_id FROM {name}_songs)),
{name}_users AS (SELECT user_id FROM {name}_a GROUP BY user_id
                 HAVING count(DISTINCT recording_id) > {bound}),
{name} AS (SELECT * FROM {name}_a WHERE user_id IN (SELECT user_id FROM {name}_users))
"""


def pruned_splits(bound: int) -> str:
    return prune("listens_train", "train5", bound) + ",\n" + prune("listens_test", "test5", bound)


SONG_INDEX = """
song_index AS (
  SELECT recording_id, CAST(row_number() OVER (ORDER BY n DESC, recording_id) - 1 AS DOUBLE) AS recording_id_index
  FROM (SELECT recording_id, count(*) AS n
        FROM (SELECT recording_id FROM train5 UNION ALL SELECT recording_id FROM test5)
        WHERE recording_id IS NOT NULL GROUP BY recording_id))
"""


def ratings(split: str) -> str:
    """User share of plays per indexed song for ``train5`` / ``test5``."""
    return f"""
{split}_pairs AS (
  SELECT s.recording_id_index, l.user_id, count(*) AS rating
  FROM {split} l JOIN song_index s ON l.recording_id = s.recording_id
  GROUP BY s.recording_id_index, l.user_id),
{split}_ratings AS (
  SELECT user_id,
         CAST(rating AS DOUBLE) / CAST(sum(rating) OVER (PARTITION BY user_id) AS DOUBLE) AS avg_rating,
         recording_id_index
  FROM {split}_pairs)
"""


def popularity(src: str, beta: int = 5000, global_beta: int = 100000, n: int = 100, decimals: int = 10) -> str:
    """Scores of every song of ``src`` (``scores``) and the top-n list ``top`` (0-based ``pos``)."""
    return f"""
song_counts AS (
  SELECT recording_id, count(user_id) AS total_play_count, count(DISTINCT user_id) AS unique_user_count
  FROM {src} GROUP BY recording_id),
gb AS (
  SELECT CAST((SELECT count(*) FROM {src}) AS DOUBLE)
         / CAST((SELECT count(DISTINCT recording_id) FROM {src}) + {global_beta} AS DOUBLE) AS global_bias),
scored AS (
  SELECT recording_id, total_play_count, unique_user_count,
         (total_play_count - (SELECT global_bias FROM gb)) / CAST(unique_user_count + {beta} AS DOUBLE) AS naive_score
  FROM song_counts),
bounds AS (
  SELECT min(unique_user_count) AS lu, max(unique_user_count) AS hu,
         min(naive_score) AS ls, max(naive_score) AS hs FROM scored),
scaled AS (
  SELECT s.*,
         COALESCE(CAST(s.unique_user_count - b.lu AS DOUBLE) / CAST(NULLIF(b.hu - b.lu, 0) AS DOUBLE), 0.0)
           AS normalized_unique_users,
         COALESCE((s.naive_score - b.ls) / NULLIF(b.hs - b.ls, 0.0), 0.0) AS normalized_score
  FROM scored s, bounds b),
scores AS (
  SELECT *, 0.5 * normalized_unique_users + 0.5 * normalized_score AS combined_score FROM scaled),
ranked AS (
  SELECT recording_id, combined_score,
         row_number() OVER (ORDER BY round(combined_score, {decimals}) DESC, recording_id) - 1 AS pos
  FROM scores),
top AS (SELECT recording_id, combined_score, pos FROM ranked WHERE pos < {n})
"""


def idcg(k: int) -> str:
    """``idcg(n, v)``: ideal DCG of n relevant items, n = 1..k."""
    return f"""
gains AS (SELECT i, 1.0::DOUBLE / ln(i + 2) AS g FROM range(0, {k}) t(i)),
idcg AS (SELECT i + 1 AS n, sum(g) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM gains)
"""


def per_user_from_hits(hits: str, users: str, k: int) -> str:
    """``per_user`` from ``hits(user_id, pos, cnt)`` and ``users(user_id, n_labels)``."""
    return f"""
hit_sums AS (
  SELECT user_id,
         count(*) FILTER (WHERE pos < {k}) AS hk,
         sum(CAST(cnt AS DOUBLE) / (pos + 1)) AS ap,
         sum(CASE WHEN pos < {k} THEN CAST(cnt AS DOUBLE) / (pos + 1) ELSE 0.0 END) AS apk,
         sum(CASE WHEN pos < {k} THEN 1.0::DOUBLE / ln(pos + 2) ELSE 0.0 END) AS dcg
  FROM {hits} GROUP BY user_id),
per_user AS (
  SELECT u.user_id, u.n_labels,
         CASE WHEN u.n_labels > 0 THEN CAST(COALESCE(h.hk, 0) AS DOUBLE) / {k} ELSE 0.0 END AS precision_at_k,
         CASE WHEN u.n_labels > 0 THEN COALESCE(h.ap, 0.0) / u.n_labels ELSE 0.0 END AS map,
         CASE WHEN u.n_labels > 0 THEN COALESCE(h.apk, 0.0) / LEAST(u.n_labels, {k}) ELSE 0.0 END AS map_at_k,
         CASE WHEN u.n_labels > 0 THEN COALESCE(h.dcg, 0.0) / d.v ELSE 0.0 END AS ndcg_at_k
  FROM {users} u
  LEFT JOIN hit_sums h ON u.user_id = h.user_id
  LEFT JOIN idcg d ON d.n = LEAST(u.n_labels, {k}))
"""


def mean_select(k: int, group: str | None = None, decimals: int = DECIMALS) -> str:
    g = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return f"""
SELECT {g}{k} AS k, count(*) AS n_users,
       round(avg(precision_at_k), {decimals}) AS precision_at_k,
       round(avg(map), {decimals}) AS map,
       round(avg(map_at_k), {decimals}) AS map_at_k,
       round(avg(ndcg_at_k), {decimals}) AS ndcg_at_k
FROM per_user{tail}
"""


def standard_order(test: str, k: int) -> str:
    """Prediction = the shared top list, labels = the user's distinct songs."""
    return f"""
labels AS (SELECT DISTINCT user_id, recording_id FROM {test}),
users AS (SELECT user_id, count(*) AS n_labels FROM labels GROUP BY user_id),
hits AS (
  SELECT l.user_id, t.pos, row_number() OVER (PARTITION BY l.user_id ORDER BY t.pos) AS cnt
  FROM labels l JOIN top t ON l.recording_id = t.recording_id)
"""


def reference_order(test: str, k: int) -> str:
    """Prediction = the user's listens by (time, song) with repeats, labels = the top list."""
    return f"""
pred AS (
  SELECT user_id, recording_id,
         row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", recording_id) - 1 AS pos
  FROM {test} WHERE user_id IS NOT NULL),
users AS (SELECT DISTINCT user_id, (SELECT count(DISTINCT recording_id) FROM top) AS n_labels FROM pred),
hits AS (
  SELECT p.user_id, p.pos, row_number() OVER (PARTITION BY p.user_id ORDER BY p.pos) AS cnt
  FROM pred p JOIN top t ON p.recording_id = t.recording_id)
"""
