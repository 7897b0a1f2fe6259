"""ANSI SQL (DuckDB dialect) equivalents of the registered queries, over the
driver's pre-registered table views. Shared CTEs mirror ``sources.views`` and
the prepared dataset (active users, id indexes, temporal split)."""
from __future__ import annotations

WS = r"[ \t\n\r\f\x0B]"

INTER = """inter AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS podcast_id,
         l.l_quantity / 10.0 AS rating, CAST(o.o_orderdate AS TIMESTAMP) AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

ITEMS = """items AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS podcast_id, p.p_name AS title,
         p.p_brand || ' ' || p.p_type AS description, p.p_type AS category,
         CAST(p.p_size AS INTEGER) AS avg_duration_min,
         CAST(coalesce(s.n, 0) AS BIGINT) AS total_episodes,
         CAST(coalesce(s.q, 0.0) AS DOUBLE) AS play_count,
         CAST(s.fy AS INTEGER) AS release_year
  FROM part p LEFT JOIN (
    SELECT l.l_partkey, count(*) AS n, sum(l.l_quantity) AS q, min(year(o.o_orderdate)) AS fy
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY l.l_partkey) s
  ON p.p_partkey = s.l_partkey)"""

PREP = INTER + """,
active AS (
  SELECT * FROM inter WHERE user_id IN (
    SELECT user_id FROM inter GROUP BY user_id HAVING count(*) >= 5)),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY ts, user_id, podcast_id, rating) AS rn,
         count(*) OVER () AS n_all FROM active),
split AS (
  SELECT user_id, podcast_id, rating, ts,
         CASE WHEN rn <= floor(n_all * (1 - 0.2e0)) THEN 'train' ELSE 'test' END AS split
  FROM ranked),
train AS (SELECT user_id, podcast_id, rating, ts FROM split WHERE split = 'train'),
test AS (SELECT user_id, podcast_id, rating, ts FROM split WHERE split = 'test'),
uidx AS (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS user_idx
         FROM (SELECT DISTINCT user_id FROM active)),
iidx AS (SELECT podcast_id, CAST(row_number() OVER (ORDER BY podcast_id) - 1 AS BIGINT) AS podcast_idx
         FROM (SELECT DISTINCT podcast_id FROM active)),
pop AS (
  SELECT podcast_id, n, n / sum(n) OVER () AS pop_share, n / max(n) OVER () AS pop_score
  FROM (SELECT podcast_id, count(*) AS n FROM train GROUP BY podcast_id)),
cells AS (
  SELECT u.user_idx, i.podcast_idx, sum(t.rating) AS value
  FROM train t JOIN uidx u ON t.user_id = u.user_id JOIN iidx i ON t.podcast_id = i.podcast_id
  GROUP BY u.user_idx, i.podcast_idx),
umean AS (
  SELECT u.user_id, u.user_idx, coalesce(s.row_sum, 0.0) / (SELECT count(*) FROM iidx) AS mu
  FROM uidx u LEFT JOIN (SELECT user_idx, sum(value) AS row_sum FROM cells GROUP BY user_idx) s
  ON u.user_idx = s.user_idx),
cand AS (SELECT DISTINCT user_id, podcast_id FROM test),
""" + ITEMS + """,
scored AS (
  SELECT c.user_id, c.podcast_id, it.category, coalesce(p.pop_score, 0.0) AS score
  FROM cand c
  LEFT JOIN pop p ON c.podcast_id = p.podcast_id
  LEFT JOIN items it ON c.podcast_id = it.podcast_id
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = c.user_id AND t.podcast_id = c.podcast_id)),
scaled AS (
  SELECT user_id, podcast_id, category,
         CASE WHEN count(*) OVER w > 1 AND max(score) OVER w > min(score) OVER w
              THEN (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w)
              ELSE score END AS score
  FROM scored WINDOW w AS (PARTITION BY user_id)),
prefs AS (
  SELECT user_id, category, cnt / sum(cnt) OVER (PARTITION BY user_id) AS share
  FROM (SELECT t.user_id, it.category, count(*) AS cnt
        FROM train t LEFT JOIN items it ON t.podcast_id = it.podcast_id
        WHERE it.category IS NOT NULL GROUP BY t.user_id, it.category)),
norms AS (
  SELECT CAST(max(play_count) AS DOUBLE) AS max_play, CAST(min(release_year) AS DOUBLE) AS min_year,
         CAST(max(release_year) AS DOUBLE) AS max_year FROM items)"""

EV = """ev AS (
  SELECT CAST(ts AS TIMESTAMP) AS ts, CAST(value AS DOUBLE) AS value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type FROM events),
bounds AS (
  SELECT max(ts) - INTERVAL 7 DAY AS cur_start, max(ts) - INTERVAL 37 DAY AS ref_start FROM ev),
lab AS (
  SELECT ev.*, CASE WHEN ev.ts >= b.cur_start THEN 'current'
                    WHEN ev.ts >= b.ref_start AND ev.ts < b.cur_start THEN 'reference' END AS win
  FROM ev, bounds b),
long AS (
  SELECT win, 'value' AS feature, value AS v FROM lab WHERE win IS NOT NULL AND value IS NOT NULL
  UNION ALL
  SELECT win, 'k' AS feature, k AS v FROM lab WHERE win IS NOT NULL AND k IS NOT NULL),
rng AS (
  SELECT feature,
         CASE WHEN lo0 = hi0 THEN lo0 - CASE WHEN lo0 <> 0 THEN abs(lo0) * 0.001e0 ELSE 0.001e0 END ELSE lo0 END AS lo,
         CASE WHEN lo0 = hi0 THEN hi0 + CASE WHEN hi0 <> 0 THEN abs(hi0) * 0.001e0 ELSE 0.001e0 END ELSE hi0 END AS hi
  FROM (SELECT feature, min(v) AS lo0, max(v) AS hi0 FROM long WHERE win = 'reference' GROUP BY feature)),
binned AS (
  SELECT l.feature, l.win,
         CAST(len(list_filter(range(1, 10), lambda i: r.lo + i * ((r.hi - r.lo) / 10.0e0) < l.v)) + 1 AS INTEGER) AS bin
  FROM long l JOIN rng r ON l.feature = r.feature),
tot AS (
  SELECT feature, count(*) FILTER (WHERE win = 'reference') AS n_ref,
         count(*) FILTER (WHERE win = 'current') AS n_cur FROM binned GROUP BY feature),
spine AS (SELECT feature, CAST(b AS INTEGER) AS bin FROM rng, range(1, 11) t(b)),
cnt AS (SELECT feature, win, bin, count(*) AS c FROM binned GROUP BY feature, win, bin),
psi AS (
  SELECT s.feature,
         CASE WHEN max(t.n_cur) > 0 THEN abs(sum(
           (greatest(coalesce(cc.c, 0) / CAST(t.n_cur AS DOUBLE), 1e-6) - greatest(coalesce(rc.c, 0) / CAST(t.n_ref AS DOUBLE), 1e-6))
           * ln(greatest(coalesce(cc.c, 0) / CAST(t.n_cur AS DOUBLE), 1e-6) / greatest(coalesce(rc.c, 0) / CAST(t.n_ref AS DOUBLE), 1e-6))))
         END AS psi,
         CAST(max(t.n_ref) AS BIGINT) AS n_reference, CAST(max(t.n_cur) AS BIGINT) AS n_current
  FROM spine s
  LEFT JOIN cnt rc ON rc.feature = s.feature AND rc.bin = s.bin AND rc.win = 'reference'
  LEFT JOIN cnt cc ON cc.feature = s.feature AND cc.bin = s.bin AND cc.win = 'current'
  LEFT JOIN tot t ON t.feature = s.feature
  GROUP BY s.feature),
report AS (
  SELECT 'psi_fallback' AS method, round(coalesce(sum(psi), 0.0) / greatest(count(*), 1), 4) AS avg_psi,
         CASE WHEN count(*) FILTER (WHERE psi IS NULL) > 0 THEN NULL
              ELSE coalesce(sum(psi), 0.0) / greatest(count(*), 1) > 0.15e0 END AS has_drift,
         CAST(count(*) AS BIGINT) AS n_features, 0.15e0 AS drift_threshold FROM psi)"""

NDCG = """
tg AS (
  SELECT {by}user_id, score, avg(rating) AS g, count(*) AS c FROM s GROUP BY {by}user_id, score),
rows_r AS (
  SELECT {by}user_id, rating, score,
         row_number() OVER (PARTITION BY {by}user_id ORDER BY score DESC, rating) AS rk,
         row_number() OVER (PARTITION BY {by}user_id ORDER BY rating DESC) AS ik,
         count(*) OVER (PARTITION BY {by}user_id) AS n_u
  FROM s),
gain AS (
  SELECT r.*, tg.g FROM rows_r r JOIN tg ON {byjoin}r.user_id = tg.user_id AND r.score IS NOT DISTINCT FROM tg.score),
per_user AS (
  SELECT {by}user_id,
         CASE WHEN sum(CASE WHEN ik <= 10 THEN rating / log2(ik + 1) ELSE 0 END) > 0
              THEN sum(CASE WHEN rk <= 10 THEN g / log2(rk + 1) ELSE 0 END)
                   / sum(CASE WHEN ik <= 10 THEN rating / log2(ik + 1) ELSE 0 END)
              ELSE 0.0 END AS ndcg
  FROM gain WHERE n_u >= 2 GROUP BY {by}user_id)"""


def _ndcg(by: str = "") -> str:
    byjoin = "".join(f"r.{b.strip()} = tg.{b.strip()} AND " for b in by.split(",") if b.strip())
    return NDCG.format(by=by, byjoin=byjoin)


def R(x: str) -> str:
    return f"round({x}, 6)"


SQL = {}

SQL["seed_list"] = f"""
SELECT doc_id, line_no, line FROM (
  SELECT doc_id, CAST(pos AS BIGINT) AS line_no,
         regexp_replace(raw, '^{WS}+|{WS}+$', '', 'g') AS line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
               unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents))
WHERE line <> '' AND NOT starts_with(line, '#')"""

SQL["parquet_scan"] = f"""WITH {INTER}
SELECT user_id, podcast_id, {R('rating')} AS rating, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM inter"""

SQL["schema_check"] = f"""WITH {INTER}, {ITEMS}
SELECT 'items' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_missing_columns,
       CAST(count(*) - count(DISTINCT podcast_id) AS BIGINT) AS n_dup_ids,
       CAST(count(*) FILTER (WHERE description IS NULL) AS BIGINT) AS n_null_description,
       CAST(NULL AS BIGINT) AS n_bad_rating FROM items
UNION ALL
SELECT 'interactions', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
       CAST(count(*) FILTER (WHERE rating IS NULL OR NOT rating BETWEEN 0 AND 5) AS BIGINT) FROM inter"""

SQL["dup_ids"] = f"""WITH {INTER}, {ITEMS}
SELECT title, CAST(count(*) AS BIGINT) AS n FROM items GROUP BY title HAVING count(*) > 1 OR title IS NULL"""

SQL["range_check"] = f"""WITH {INTER}
SELECT CAST(count(*) AS BIGINT) AS n_checked, CAST(count(*) FILTER (WHERE rating IS NULL) AS BIGINT) AS n_null,
       CAST(count(*) FILTER (WHERE rating IS NOT NULL AND NOT rating BETWEEN 0 AND 5) AS BIGINT) AS n_out_of_range
FROM inter"""

SQL["dataset_stats"] = f"""WITH {PREP}
SELECT 'n_items' AS metric, CAST(count(*) AS BIGINT) AS value FROM items
UNION ALL SELECT 'n_categories', CAST(count(DISTINCT category) AS BIGINT) FROM items
UNION ALL SELECT 'n_interactions', CAST(count(*) AS BIGINT) FROM active
UNION ALL SELECT 'n_users', CAST(count(DISTINCT user_id) AS BIGINT) FROM active
UNION ALL SELECT 'n_interacted_items', CAST(count(DISTINCT podcast_id) AS BIGINT) FROM active
UNION ALL SELECT 'n_bad_rating', CAST(count(*) FILTER (WHERE rating IS NULL OR NOT rating BETWEEN 0 AND 5) AS BIGINT) FROM active"""

SQL["active_users"] = f"""WITH {PREP}
SELECT user_id, podcast_id, {R('rating')} AS rating, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM active"""

SQL["encode_ids"] = f"""WITH {PREP}
SELECT 'user' AS kind, user_id AS id, user_idx AS idx FROM uidx
UNION ALL SELECT 'item', podcast_id, podcast_idx FROM iidx"""

SQL["temporal_split"] = f"""WITH {PREP}
SELECT user_id, podcast_id, {R('rating')} AS rating, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, split FROM split"""

SQL["popularity_share"] = f"""WITH {PREP}
SELECT podcast_id, CAST(n AS BIGINT) AS n, {R('pop_share')} AS pop_share FROM pop"""

SQL["popularity_score"] = f"""WITH {PREP}
SELECT c.user_id, c.podcast_id, {R('coalesce(p.pop_score, 0.0)')} AS pop_score
FROM cand c LEFT JOIN pop p ON c.podcast_id = p.podcast_id"""

SQL["rating_matrix"] = f"""WITH {PREP}
SELECT user_idx, podcast_idx, {R('value')} AS value FROM cells"""

SQL["user_mean"] = f"""WITH {PREP}
SELECT user_id, user_idx, {R('mu')} AS mu FROM umean"""

SQL["rmse_mae"] = f"""WITH {PREP}
SELECT {R('sqrt(avg((coalesce(m.mu, 0.0) - t.rating) * (coalesce(m.mu, 0.0) - t.rating)))')} AS rmse,
       {R('avg(abs(coalesce(m.mu, 0.0) - t.rating))')} AS mae, CAST(count(*) AS BIGINT) AS n
FROM test t LEFT JOIN umean m ON t.user_id = m.user_id"""

SQL["merge_scores"] = f"""WITH {PREP}
SELECT c.user_id, c.podcast_id, {R('coalesce(s.collab_score, 0.0)')} AS collab_score
FROM cand c LEFT JOIN (SELECT user_id, podcast_id, sum(rating) AS collab_score FROM train GROUP BY 1, 2) s
ON c.user_id = s.user_id AND c.podcast_id = s.podcast_id"""

SQL["exclude_history"] = f"""WITH {PREP}
SELECT c.user_id, c.podcast_id FROM cand c
WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = c.user_id AND t.podcast_id = c.podcast_id)"""

SQL["topk_per_user"] = f"""WITH {PREP}
SELECT user_id, podcast_id, {R('score')} AS score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, podcast_id) AS BIGINT) AS rank
  FROM scored) WHERE rank <= 10"""

SQL["minmax_scores"] = f"""WITH {PREP}
SELECT user_id, podcast_id, {R('score')} AS score FROM scaled"""

SQL["mmr_rerank"] = f"""WITH {PREP},
jj AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY score DESC, podcast_id) AS j FROM scaled),
vv AS (
  SELECT *, 0.1e0 * score - (1 - 0.1e0) * least(0.3e0 * (j - 1), 0.9e0) AS v FROM jj WHERE j <= 10)
SELECT user_id, podcast_id, category, {R('score')} AS score, mmr_rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY v DESC, podcast_id) AS BIGINT) AS mmr_rank FROM vv)
WHERE mmr_rank <= 10"""

SQL["response_shape"] = f"""WITH {PREP}
SELECT CAST(t.user_id AS VARCHAR) AS user_id, CAST(t.podcast_id AS VARCHAR) AS podcast_id,
       CAST(it.title AS VARCHAR) AS title, CAST(t.category AS VARCHAR) AS category,
       substring(CAST(it.description AS VARCHAR), 1, 300) AS description,
       {R('coalesce(t.score, 0.0)')} AS ranker_score, t.rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, podcast_id) AS BIGINT) AS rank
      FROM scored) t LEFT JOIN items it ON t.podcast_id = it.podcast_id
WHERE t.rank <= 10"""

SQL["category_prefs"] = f"""WITH {PREP}
SELECT user_id, category, {R('share')} AS share FROM prefs"""

SQL["ranker_norms"] = f"""WITH {ITEMS}
SELECT {R('CAST(max(play_count) AS DOUBLE)')} AS max_play, {R('CAST(min(release_year) AS DOUBLE)')} AS min_year,
       {R('CAST(max(release_year) AS DOUBLE)')} AS max_year FROM items"""

_FEATS = f"""WITH {PREP},
feat AS (
  SELECT t.user_id, t.podcast_id, t.rating,
         CAST(0.0 AS DOUBLE) AS embedding_score, CAST(0.0 AS DOUBLE) AS collab_score,
         coalesce(CAST(it.avg_duration_min AS DOUBLE), 0.0) AS avg_duration_min,
         coalesce(CAST(it.total_episodes AS DOUBLE), 0.0) AS total_episodes,
         coalesce(least(greatest(it.play_count / n.max_play, 0.0), 1.0), 0.0) AS play_count_norm,
         coalesce(least(greatest((it.release_year - n.min_year) / greatest(n.max_year - n.min_year, 1.0), 0.0), 1.0), 0.0) AS release_year_norm,
         coalesce(p.share, 0.0) AS category_match,
         coalesce(ln(1 + it.play_count) / ln(1 + n.max_play), 0.0) AS popularity_score
  FROM test t LEFT JOIN items it ON t.podcast_id = it.podcast_id
  CROSS JOIN norms n
  LEFT JOIN prefs p ON t.user_id = p.user_id AND it.category = p.category)"""

SQL["ranker_features"] = _FEATS + f"""
SELECT user_id, podcast_id, {R('rating')} AS rating,
       {R('embedding_score')} AS embedding_score, {R('collab_score')} AS collab_score,
       {R('avg_duration_min')} AS avg_duration_min, {R('total_episodes')} AS total_episodes,
       {R('play_count_norm')} AS play_count_norm, {R('release_year_norm')} AS release_year_norm,
       {R('category_match')} AS category_match, {R('popularity_score')} AS popularity_score FROM feat"""

SQL["category_match"] = _FEATS + f"""
SELECT user_id, podcast_id, {R('category_match')} AS category_match FROM feat"""

SQL["ndcg_at_k"] = f"""WITH {PREP},
s AS (SELECT t.user_id, t.rating, it.play_count AS score FROM test t LEFT JOIN items it ON t.podcast_id = it.podcast_id),
{_ndcg()}
SELECT {R('coalesce(avg(ndcg), 0.0)')} AS ndcg, CAST(count(*) AS BIGINT) AS n_users FROM per_user"""

SQL["item_text"] = f"""WITH {ITEMS}
SELECT podcast_id, coalesce(title, '') || ' [SEP] ' || coalesce(category, '') || ' [SEP] ' || coalesce(description, '') AS text
FROM items"""

SQL["item_lookup"] = f"""WITH {PREP}
SELECT podcast_id, title, category, description, {R('play_count')} AS play_count FROM items
WHERE podcast_id IN (SELECT podcast_id FROM test)"""

_VEC = """vec AS (SELECT CAST(vec_id AS VARCHAR) AS item_id, embedding, CAST(label AS VARCHAR) AS category FROM embeddings)"""

SQL["embedding_topk"] = f"""WITH {_VEC},
ex AS (SELECT category, CAST(d AS BIGINT) AS d, CAST(x AS DOUBLE) AS x
       FROM (SELECT category, unnest(embedding) AS x, unnest(range(len(embedding))) AS d FROM vec)),
mean AS (SELECT category, d, avg(x) AS m FROM ex GROUP BY category, d),
nrm AS (SELECT category, sqrt(sum(m * m)) AS nn FROM mean GROUP BY category),
q AS (SELECT m.category, m.d, CASE WHEN n.nn > 0 THEN m.m / n.nn ELSE m.m END AS qx
      FROM mean m JOIN nrm n ON m.category = n.category),
iv AS (SELECT item_id, CAST(d AS BIGINT) AS d, CAST(x AS DOUBLE) AS x
       FROM (SELECT item_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS d FROM vec)),
sc AS (SELECT q.category AS label, iv.item_id, sum(q.qx * iv.x) AS score FROM q JOIN iv ON q.d = iv.d
       GROUP BY q.category, iv.item_id)
SELECT label, item_id, {R('score')} AS score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, item_id) AS BIGINT) AS rank FROM sc)
WHERE rank <= 10"""

SQL["similar_items"] = f"""WITH {_VEC},
sc AS (
  SELECT a.item_id, b.item_id AS similar_id,
         list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda t: CAST(t[1] AS DOUBLE) * CAST(t[2] AS DOUBLE))) AS score
  FROM vec a JOIN vec b ON a.item_id <> b.item_id)
SELECT item_id, similar_id, {R('score')} AS score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, similar_id) AS BIGINT) AS rank FROM sc)
WHERE rank <= 5"""

SQL["psi_drift"] = f"""WITH {EV}
SELECT feature, {R('psi')} AS psi, n_reference, n_current FROM psi"""

SQL["drift_report"] = f"""WITH {EV}
SELECT method, {R('avg_psi')} AS avg_psi, has_drift, n_features, {R('drift_threshold')} AS drift_threshold FROM report"""

SQL["quality_profile"] = f"""WITH {EV},
side_rows AS (
  SELECT CASE win WHEN 'reference' THEN 'reference' ELSE 'current' END AS side, 'value' AS feature,
         value AS num, CAST(NULL AS VARCHAR) AS cat FROM lab WHERE win IS NOT NULL
  UNION ALL
  SELECT win, 'k', k, NULL FROM lab WHERE win IS NOT NULL
  UNION ALL
  SELECT win, 'event_type', NULL, event_type FROM lab WHERE win IS NOT NULL)
SELECT side, feature, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE (feature IN ('value', 'k') AND num IS NULL) OR (feature NOT IN ('value', 'k') AND cat IS NULL)) AS BIGINT) AS n_null,
       CAST(count(DISTINCT num) + count(DISTINCT cat) AS BIGINT) AS n_distinct,
       {R('min(num)')} AS min_value, {R('max(num)')} AS max_value, {R('avg(num)')} AS mean_value,
       {R('stddev_samp(num)')} AS std_value
FROM side_rows GROUP BY side, feature"""

SQL["drift_windows"] = f"""WITH {EV}
SELECT win AS window, CAST(count(*) AS BIGINT) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS min_ts,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_ts FROM lab GROUP BY win"""

_DECAY = f"""WITH {PREP},
s AS (SELECT CAST(year(a.ts) AS BIGINT) AS year, a.user_id, a.rating, it.play_count AS score
      FROM active a LEFT JOIN items it ON a.podcast_id = it.podcast_id),
{_ndcg('year, ')},
yearly AS (SELECT year, avg(ndcg) AS ndcg FROM per_user GROUP BY year),
dec AS (
  SELECT year, baseline_ndcg, current_ndcg,
         round(baseline_ndcg - current_ndcg, 4) AS delta,
         round((baseline_ndcg - current_ndcg) / greatest(baseline_ndcg, 1e-6) * 100, 2) AS relative_drop_pct,
         (baseline_ndcg - current_ndcg) / greatest(baseline_ndcg, 1e-6) > 0.05e0 AS has_performance_decay
  FROM (SELECT year, lag(ndcg) OVER (ORDER BY year) AS baseline_ndcg, ndcg AS current_ndcg FROM yearly)
  WHERE baseline_ndcg IS NOT NULL)"""

SQL["perf_decay"] = _DECAY + f"""
SELECT year, {R('baseline_ndcg')} AS baseline_ndcg, {R('current_ndcg')} AS current_ndcg, {R('delta')} AS delta,
       {R('relative_drop_pct')} AS relative_drop_pct, has_performance_decay FROM dec"""

SQL["should_retrain"] = _DECAY + ", " + EV + """
SELECT r.has_drift, d.has_performance_decay,
       coalesce(r.has_drift, false) OR coalesce(d.has_performance_decay, false) AS should_retrain
FROM report r, (SELECT arg_max(has_performance_decay, year) AS has_performance_decay FROM dec) d"""

SQL["dedup_first"] = """
SELECT conv_id, turn, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM conversations)
WHERE rn = 1"""

SQL["scrape_summary"] = """
WITH f AS (SELECT 'https://feeds.example.org/' || source || '/' || CAST(floor(doc_id / 64) AS BIGINT) AS feed_url,
                  count(*) AS n FROM documents GROUP BY 1)
SELECT 'feeds_total' AS metric, CAST(count(*) AS BIGINT) AS value FROM f
UNION ALL SELECT 'feeds_success', CAST(count(*) AS BIGINT) FROM f
UNION ALL SELECT 'feeds_failed', CAST(0 AS BIGINT)
UNION ALL SELECT 'episodes_new', CAST(sum(n) AS BIGINT) FROM f
UNION ALL SELECT 'episodes_failed', CAST(0 AS BIGINT)"""

_REV = f"""WITH rv AS (
  SELECT d.doc_id AS row_id, d.source AS podcast_name, d.text AS review_text,
         CAST(l.quality AS VARCHAR) AS rating, d.lang AS category
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
w AS (
  SELECT row_number() OVER (ORDER BY row_id) - 1 AS pos,
         regexp_replace(coalesce(podcast_name, 'Unknown Podcast'), '^{WS}+|{WS}+$', '', 'g') AS t,
         coalesce(review_text, '') AS txt, category,
         least(greatest(coalesce(TRY_CAST(rating AS DOUBLE), 4.0), 0.0), 5.0) AS rating
  FROM rv),
w2 AS (
  SELECT *, 'kaggle_' || regexp_replace(regexp_replace(lower(t), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS podcast_id
  FROM w)"""

SQL["reviews_to_items"] = _REV + f"""
SELECT podcast_id, arg_min(t, pos) AS title,
       coalesce(nullif(regexp_replace(array_to_string(list_filter((list(txt ORDER BY pos))[1:5], lambda x: x <> ''), ' '),
                                      '^{WS}+|{WS}+$', '', 'g'), ''), 'Podcast from Kaggle reviews dataset') AS description,
       arg_min(category, pos) FILTER (WHERE category IS NOT NULL) AS category,
       CAST(45 AS INTEGER) AS avg_duration_min, CAST(count(*) AS BIGINT) AS total_episodes,
       CAST(greatest(count(*), 1) * 100 AS DOUBLE) AS play_count, CAST(2024 AS INTEGER) AS release_year
FROM w2 GROUP BY podcast_id"""

SQL["reviews_to_interactions"] = _REV + """
SELECT user_id, podcast_id, round(arg_min(rating, pos), 6) AS rating, ts FROM (
  SELECT 'kaggle_user_' || lpad(CAST(pos AS VARCHAR), 6, '0') AS user_id, podcast_id, rating, pos,
         '2024-02-01 00:00:00' AS ts FROM w2)
GROUP BY user_id, podcast_id, ts"""

_DRIFT = f"""WITH {EV},
num AS (
  SELECT feature, v AS value, CAST(count(*) FILTER (WHERE win = 'reference') AS DOUBLE) AS nr,
         CAST(count(*) FILTER (WHERE win = 'current') AS DOUBLE) AS nc FROM long GROUP BY feature, v),
cum AS (
  SELECT feature, sum(nr) OVER (PARTITION BY feature ORDER BY value) AS cr,
         sum(nc) OVER (PARTITION BY feature ORDER BY value) AS cc,
         sum(nr) OVER (PARTITION BY feature) AS tr, sum(nc) OVER (PARTITION BY feature) AS tc FROM num),
ks AS (SELECT feature, 'ks' AS stat_test, max(abs(cr / tr - cc / tc)) AS statistic, 0.1e0 AS threshold
       FROM cum GROUP BY feature),
cat AS (
  SELECT 'event_type' AS feature, event_type AS value,
         CAST(count(*) FILTER (WHERE win = 'reference') AS DOUBLE) AS nr,
         CAST(count(*) FILTER (WHERE win = 'current') AS DOUBLE) AS nc
  FROM lab WHERE win IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2),
ct AS (SELECT c.*, c.nr / sum(c.nr) OVER (PARTITION BY feature) AS p, c.nc / sum(c.nc) OVER (PARTITION BY feature) AS q FROM cat c),
js AS (
  SELECT feature, 'jensenshannon' AS stat_test,
         sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END / 2
                          + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END / 2), 0)) AS statistic,
         0.1e0 AS threshold FROM ct GROUP BY feature),
cd AS (SELECT *, statistic > threshold AS drifted FROM (SELECT * FROM ks UNION ALL SELECT * FROM js))"""

SQL["drift_share"] = _DRIFT + """
SELECT feature, stat_test, round(statistic, 6) AS statistic, drifted FROM cd"""

SQL["dataset_drift"] = _DRIFT + """
SELECT CAST(count(*) AS BIGINT) AS n_columns, CAST(count(*) FILTER (WHERE drifted) AS BIGINT) AS n_drifted,
       round(count(*) FILTER (WHERE drifted) / greatest(count(*), 1), 6) AS drift_share,
       count(*) FILTER (WHERE drifted) / greatest(count(*), 1) >= 0.5e0 AS dataset_drift,
       (count(*) FILTER (WHERE drifted) / greatest(count(*), 1) >= 0.5e0)
         OR (count(*) FILTER (WHERE drifted) / greatest(count(*), 1) > 0.15e0) AS has_drift FROM cd"""

SQL["csv_scan"] = SQL["parquet_scan"]

SQL["extract_summary"] = SQL["scrape_summary"] + """
UNION ALL SELECT 'n_podcasts', CAST(count(DISTINCT 'https://feeds.example.org/' || source || '/' || CAST(floor(doc_id / 64) AS BIGINT)) AS BIGINT) FROM documents
UNION ALL SELECT 'n_interactions', CAST(count(*) AS BIGINT) FROM documents"""

SQL["best_reviews_file"] = """
SELECT CAST(d.doc_id AS VARCHAR) AS row_id, source AS podcast_name, text AS review_text, CAST(quality AS VARCHAR) AS rating,
       lang AS category, CAST(8 + least((SELECT count(*) FROM documents), 1000) // 100 AS INTEGER) AS file_score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

_FEEDS = """WITH fd AS (
  SELECT doc_id, lang, source, floor(doc_id / 64) AS block,
         'https://feeds.example.org/' || source || '/' || CAST(floor(doc_id / 64) AS BIGINT) AS feed_url FROM documents),
fe AS (
  SELECT *, 'rss_' || substr(sha256(feed_url), 1, 12) AS podcast_id,
         row_number() OVER (PARTITION BY feed_url ORDER BY doc_id) - 1 AS idx FROM fd)"""

SQL["feeds_to_items"] = _FEEDS + """
SELECT podcast_id, min(source) AS title, 'Feed of ' || min(source) AS description, coalesce(min(lang), 'General') AS category,
       CAST(45 AS INTEGER) AS avg_duration_min, CAST(count(*) AS BIGINT) AS total_episodes,
       CAST(greatest(count(*) * 100, 1) AS DOUBLE) AS play_count,
       CAST(arg_min(year(DATE '2023-01-01' + CAST(doc_id % 365 AS INTEGER)), doc_id) AS INTEGER) AS release_year
FROM fe GROUP BY podcast_id"""

SQL["release_year"] = _FEEDS + """
SELECT podcast_id, CAST(arg_min(year(DATE '2023-01-01' + CAST(doc_id % 365 AS INTEGER)), doc_id) AS INTEGER) AS release_year
FROM fe GROUP BY podcast_id"""

SQL["feeds_to_interactions"] = _FEEDS + """
SELECT 'rss_user_' || lpad(CAST(idx % 20 AS VARCHAR), 3, '0') AS user_id, podcast_id, CAST(4.0 AS DOUBLE) AS rating,
       '2024-02-01 00:00:00' AS ts FROM fe"""

SQL["entry_index"] = _FEEDS + """
SELECT podcast_id, CAST(idx AS BIGINT) AS idx, 'rss_user_' || lpad(CAST(idx % 20 AS VARCHAR), 3, '0') AS user_id FROM fe"""

SQL["feed_state_merge"] = _FEEDS + """
SELECT feed_url, CASE WHEN min(block) % 2 = 0 THEN '2024-02-01T00:00:00Z' ELSE '2024-02-02T00:00:00Z' END AS last_scraped_at,
       CAST(count(*) AS INTEGER) AS n_entries, substr(sha256(feed_url), 1, 16) AS etag, CAST(NULL AS VARCHAR) AS last_modified
FROM fe GROUP BY feed_url"""

SQL["feed_landing"] = _FEEDS + """
SELECT feed_url, CASE WHEN min(block) % 2 = 1 THEN '2024-02-02T00:00:00Z' ELSE '2024-02-01T00:00:00Z' END AS last_scraped_at,
       CAST(count(*) AS INTEGER) AS n_entries FROM fe GROUP BY feed_url"""

SQL["latest_report"] = f"""WITH {EV}
SELECT method, avg_psi, has_drift, n_features, drift_threshold, '20240131_000000' AS timestamp,
       'drift_summary_20240131_000000.json' AS report FROM report"""

SQL["online_drift"] = f"""WITH {EV},
ow AS (
  SELECT time_bucket(INTERVAL 7 DAY, e.ts, TIMESTAMP '1970-01-01') AS window_start, f.feature, f.v
  FROM ev e, LATERAL (SELECT 'value' AS feature, e.value AS v UNION ALL SELECT 'k', e.k) f WHERE f.v IS NOT NULL),
ob AS (
  SELECT w.window_start, w.feature,
         CAST(len(list_filter(range(1, 10), lambda i: r.lo + i * ((r.hi - r.lo) / 10.0e0) < w.v)) + 1 AS INTEGER) AS bin
  FROM ow w JOIN rng r ON w.feature = r.feature),
oc AS (SELECT window_start, feature, bin, count(*) AS c FROM ob GROUP BY ALL),
ot AS (SELECT window_start, feature, count(*) AS n FROM ob GROUP BY ALL),
os AS (
  SELECT t.window_start, t.feature, t.n, greatest(coalesce(c.c, 0) / CAST(t.n AS DOUBLE), 1e-6) AS cp,
         greatest(coalesce(rc.c, 0) / CAST(g.n_ref AS DOUBLE), 1e-6) AS rp
  FROM ot t JOIN spine s ON s.feature = t.feature JOIN tot g ON g.feature = t.feature
  LEFT JOIN oc c ON c.window_start = t.window_start AND c.feature = t.feature AND c.bin = s.bin
  LEFT JOIN cnt rc ON rc.feature = t.feature AND rc.bin = s.bin AND rc.win = 'reference')
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, feature, {R('abs(sum((cp - rp) * ln(cp / rp)))')} AS psi,
       CAST(max(n) AS BIGINT) AS n_current FROM os GROUP BY os.window_start, feature"""

SQL["recommend_exclude_checks"] = f"""WITH {PREP},
seen AS (SELECT t.user_id, count(DISTINCT t.podcast_id) AS n FROM train t JOIN items i ON i.podcast_id = t.podcast_id GROUP BY t.user_id),
had AS (SELECT u.user_id, least(10, (SELECT count(*) FROM items) - coalesce(s.n, 0)) AS n FROM uidx u LEFT JOIN seen s ON s.user_id = u.user_id)
SELECT user_id, CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) AS n_items, CAST(n AS BIGINT) AS top_rank, CAST(0 AS BIGINT) AS n_seen
FROM had WHERE n > 0"""

SQL["cf_score_checks"] = f"""WITH {PREP}
SELECT user_id, count(*) AS n_rows, count(*) AS n_items, CAST(0 AS BIGINT) AS n_outside FROM cand GROUP BY user_id"""

SQL["weighted_sample_checks"] = f"""WITH {PREP}
SELECT t.user_id, least(5, count(DISTINCT t.podcast_id)) AS n_rows, least(5, count(DISTINCT t.podcast_id)) AS n_items, CAST(0 AS BIGINT) AS n_foreign
FROM train t JOIN items i ON i.podcast_id = t.podcast_id WHERE i.category IS NOT NULL GROUP BY t.user_id"""

SQL["embed_text_norms"] = r"""SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), '[\p{L}\p{N}]') THEN 1.0e0 ELSE 0.0e0 END AS norm FROM documents"""

SQL["request_rejects"] = """SELECT * FROM (
  SELECT CAST(c_custkey AS BIGINT) AS request, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS user_id,
         CAST(c_custkey % 60 AS INTEGER) AS k,
         CASE WHEN c_custkey % 7 = 0 THEN 'empty user_id' WHEN c_custkey % 60 NOT BETWEEN 1 AND 50 THEN 'k out of range' END AS reject_reason
  FROM customer) WHERE reject_reason IS NOT NULL"""

SQL["csv_items"] = """
SELECT CAST(doc_id AS VARCHAR) AS podcast_id, 'say "' || lang || '", ' || source AS title,
       sha256(replace(text, chr(13), '')) AS description_sha, source AS category, CAST(45 AS INTEGER) AS avg_duration_min,
       CAST(n_chars AS BIGINT) AS total_episodes, round(CAST(n_chars AS DOUBLE), 6) AS play_count, CAST(2024 AS INTEGER) AS release_year
FROM documents"""

SQL["prepare"] = f"""WITH {PREP}
SELECT 'items' AS name, count(*) AS n_rows FROM part
UNION ALL SELECT 'active', count(*) FROM active
UNION ALL SELECT 'train', count(*) FROM train
UNION ALL SELECT 'test', count(*) FROM test
UNION ALL SELECT 'users', count(DISTINCT user_id) FROM active
UNION ALL SELECT 'podcasts', count(DISTINCT podcast_id) FROM active"""

SQL["review_summary"] = f"""
SELECT 'rows_reviews' AS metric, (SELECT count(*) FROM documents) AS value
UNION ALL SELECT 'n_podcasts', count(*) FROM ({SQL["reviews_to_items"]}) i
UNION ALL SELECT 'n_interactions', count(*) FROM ({SQL["reviews_to_interactions"]}) x"""

SQL["feed_merge_stream"] = SQL["feed_state_merge"]

SQL["cf_ranked_checks"] = f"""WITH {PREP}
SELECT user_id, count(*) AS n_rows, count(*) AS top_rank, CAST(0 AS BIGINT) AS n_wrong, CAST(0 AS BIGINT) AS n_new
FROM cand GROUP BY user_id"""

SQL["embedding_cache_checks"] = f"""WITH texts AS ({SQL["item_text"]}),
first AS (SELECT DISTINCT text FROM texts WHERE CAST(podcast_id AS BIGINT) % 2 = 0)
SELECT 'texts_new' AS metric, count(DISTINCT text) AS value FROM texts WHERE text NOT IN (SELECT text FROM first)
UNION ALL SELECT 'items', count(*) FROM texts
UNION ALL SELECT 'texts_left', 0
UNION ALL SELECT 'vectors', count(DISTINCT text) FROM texts"""

SQL["quality_profile_daily"] = SQL["quality_profile"]
SQL["psi_daily"] = SQL["psi_drift"]
SQL["load_dataset"] = SQL["prepare"]

SQL["interactions_by_month"] = f"""WITH {INTER},
first AS (SELECT podcast_id, strftime(min(ts), '%Y-%m') AS month FROM inter GROUP BY podcast_id),
months AS (SELECT month, count(*) AS n_first FROM first GROUP BY month HAVING count(*) > 1)
SELECT month, n_first, count(*) AS n_rows, round(sum(rating), 6) AS ratings
FROM inter JOIN months ON strftime(ts, '%Y-%m') = month GROUP BY month, n_first"""

SQL["vector_lookup"] = """
SELECT CAST(vec_id AS VARCHAR) AS item_id, CAST(len(embedding) AS INTEGER) AS dim,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total
FROM embeddings WHERE CAST(vec_id AS VARCHAR) = (SELECT max(CAST(vec_id AS VARCHAR)) FROM embeddings)"""

SQL["seed_file"] = _FEEDS + """
SELECT DISTINCT feed_url AS url FROM fd"""

SQL["landed_clean"] = _FEEDS + """
SELECT feed_url, '2024-02-01T00:00:00Z' AS last_scraped_at, CAST(count(*) AS INTEGER) AS n_entries, source AS title, '1,2,3,4,5' AS numbers,
       '{"feed_url":"' || feed_url || '","n":1}' AS image, CAST(count(*) AS INTEGER) AS count, true AS bozo
FROM fe GROUP BY feed_url, source"""
