"""The same queries in SQL, for a second engine to check them against.

Each text stands alone: shared inputs come first as common table expressions.
"""

from trendlens.schema import CATEGORY_NAMES, CORRELATED, FEATURES, WEEKDAYS
from trendlens.sources.star import CATEGORY_CYCLE

ISO = "%Y-%m-%dT%H:%M:%SZ"
PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
KEY = "l_orderkey, l_linenumber, l_suppkey, video_id"
TIE = "trending_date, l_orderkey, l_linenumber, l_suppkey"

_DIM = ", ".join(f"({i}, '{n}')" for i, n in CATEGORY_NAMES.items())
_CYCLE = ", ".join(str(c) for c in CATEGORY_CYCLE)
_DAYS = ", ".join(f"'{d}'" for d in WEEKDAYS)

INPUTS = f"""
WITH dim(dim_id, dim_name) AS (VALUES {_DIM}),
lines AS (
  SELECT *,
    CASE WHEN l_orderkey % 97 = 0 THEN 0
         ELSE CAST(round(l_extendedprice * 100) AS BIGINT)
              * CASE WHEN l_partkey % 50 = 0 THEN 100 ELSE 1 END END AS views,
    min(l_shipdate) OVER (PARTITION BY l_partkey) - to_hours(l_partkey % 240) AS published
  FROM lineitem JOIN part ON l_partkey = p_partkey),
raw AS (
  SELECT l_orderkey, l_linenumber, l_suppkey,
    'v' || l_partkey AS video_id,
    p_name || ' ' || l_partkey AS title,
    p_brand AS channelTitle,
    strftime(published, '{ISO}') AS publishedAt,
    CASE WHEN l_linenumber = 7 AND l_orderkey % 10 = 0 THEN 'bad-date'
         ELSE strftime(l_shipdate, '{ISO}') END AS trending_date,
    CAST([{_CYCLE}][l_partkey % 16 + 1] AS INTEGER) AS categoryId,
    CASE WHEN l_partkey % 7 = 0 THEN '[none]'
         ELSE '"' || p_brand || '"|"' || p_type || '"' END AS tags,
    CAST(views AS BIGINT) AS view_count,
    CAST(views * CAST(round(l_discount * 100) AS BIGINT) // 100 AS BIGINT) AS likes,
    CAST(views * CAST(round(l_tax * 100) AS BIGINT) // 1000 AS BIGINT) AS dislikes,
    CAST(views * CAST(l_quantity AS BIGINT) // 1000 AS BIGINT) AS comment_count,
    CASE WHEN l_linenumber <> 1 THEN 'about ' || p_name END AS description
  FROM lines),
obs AS (
  SELECT * REPLACE (
    strptime(publishedAt, '{ISO}') AS publishedAt,
    strptime(trending_date, '{ISO}') AS trending_date,
    coalesce(description, 'No description') AS description)
  FROM raw WHERE regexp_matches(trending_date, '{PATTERN}')),
named AS (
  SELECT obs.*, coalesce(dim_name, 'Unknown') AS category_name,
    CAST(date_diff('day', publishedAt, trending_date) AS INTEGER) AS days_to_trend
  FROM obs LEFT JOIN dim ON categoryId = dim_id),
entity AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id
      ORDER BY view_count DESC NULLS LAST, {TIE}) AS rk FROM named)
  WHERE rk = 1),
first_trend AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY {TIE}) AS rk FROM named)
  WHERE rk = 1),
rated AS (
  SELECT *, view_count AS view_count_num, likes AS likes_num, dislikes AS dislikes_num,
    comment_count AS comment_count_num,
    likes + dislikes + comment_count AS total_engagement,
    likes / nullif(view_count, 0) * 100 AS like_rate,
    dislikes / nullif(view_count, 0) * 100 AS dislike_rate,
    comment_count / nullif(view_count, 0) * 100 AS comment_rate,
    (likes + dislikes + comment_count) / nullif(view_count, 0) * 100 AS engagement_rate
  FROM entity),
featured AS (
  SELECT {KEY}, categoryId, view_count, likes, comment_count, publishedAt,
    (likes + comment_count) / (view_count + 1) * 100 AS engagement_rate,
    likes / (view_count + 1) * 100 AS like_rate,
    comment_count / (view_count + 1) * 100 AS comment_rate,
    likes / (comment_count + 1) AS like_comment_ratio,
    log10(view_count + 1) AS view_scale,
    log10(likes + comment_count + 1) AS engagement_scale,
    CAST(hour(publishedAt) AS INTEGER) AS publish_hour,
    CAST(dayofweek(publishedAt) + 1 AS INTEGER) AS day_of_week,
    CASE WHEN dayofweek(publishedAt) IN (0, 6) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
      AS is_weekend,
    CASE WHEN hour(publishedAt) BETWEEN 18 AND 23 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
      AS is_prime_time
  FROM obs),
labelled AS (
  SELECT *, view_scale * (1 + engagement_rate / 100) AS growth_potential FROM featured
  WHERE view_count BETWEEN 1000 AND 50000000 AND likes > 0 AND comment_count >= 0),
stats AS (
  SELECT categoryId, count(view_count) AS view_count_count,
    CAST(sum(view_count) AS BIGINT) AS view_count_sum,
    round(avg(view_count), 6) AS view_count_mean,
    round(avg(engagement_rate), 6) AS engagement_rate_mean
  FROM featured WHERE categoryId IS NOT NULL GROUP BY categoryId)
"""

# The whole raw table in the shape of a raw file, and of a decoded message.
_RAW_FILE = """SELECT video_id, title, publishedAt, CAST(NULL AS VARCHAR) AS channelId,
  channelTitle, CAST(categoryId AS VARCHAR) AS categoryId, trending_date, tags,
  CAST(view_count AS VARCHAR) AS view_count, CAST(likes AS VARCHAR) AS likes,
  CAST(dislikes AS VARCHAR) AS dislikes, CAST(comment_count AS VARCHAR) AS comment_count,
  CAST(NULL AS VARCHAR) AS thumbnail_link, CAST(NULL AS VARCHAR) AS comments_disabled,
  CAST(NULL AS VARCHAR) AS ratings_disabled, description FROM raw"""
_MESSAGES = f"""SELECT video_id, title, strptime(publishedAt, '{ISO}') AS publishedAt,
  try_strptime(trending_date, '{ISO}') AS trending_date, categoryId, view_count, likes,
  dislikes, comment_count, TIMESTAMP '2024-05-01 10:20:30.25' AS kafka_timestamp FROM raw"""

_OLD = f"SELECT {KEY}, trending_date, view_count FROM obs"
_NEW = f"""SELECT {KEY},
  CASE WHEN l_linenumber < 4 THEN trending_date + INTERVAL 1 DAY ELSE trending_date END
    AS trending_date, view_count + 1 AS view_count FROM obs"""
_UPSERT = f"""SELECT {KEY}, trending_date, view_count FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id, trending_date
    ORDER BY age, view_count DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rk
  FROM (SELECT *, 1 AS age FROM ({_OLD}) UNION ALL SELECT *, 0 AS age FROM ({_NEW})))
  WHERE rk = 1"""

# The rows of the four micro-batches, with a model whose predicted views are the views plus one.
_BATCHES = """, msgs AS (
  SELECT CAST(l_linenumber % 4 AS BIGINT) AS batch_id,
    TIMESTAMP '2024-05-01 10:00:00' + to_minutes(CAST(l_linenumber % 4 * 690 AS BIGINT)) AS stamp,
    video_id, title, channelTitle, categoryId, view_count, view_count + 1 AS predicted_views,
    (likes + comment_count) / (view_count + 1) * 100 AS engagement_rate,
    CASE WHEN trending_date <> 'bad-date' THEN strptime(trending_date, '%Y-%m-%dT%H:%M:%SZ') END
      AS trending_date FROM raw)
"""
_BATCH_STATS = """SELECT batch_id, stamp AS "timestamp", categoryId, count(view_count) AS view_count_count,
  CAST(sum(view_count) AS BIGINT) AS view_count_sum,
  CAST(round(avg(view_count)::VARCHAR::DECIMAL(38, 12), 2) AS DOUBLE) AS view_count_mean,
  CAST(round(avg(engagement_rate)::VARCHAR::DECIMAL(38, 12), 2) AS DOUBLE) AS engagement_rate_mean
  FROM msgs GROUP BY ALL"""
_PREDICTIONS = _BATCHES + """SELECT {cols} FROM msgs WHERE batch_id = 3
  ORDER BY predicted_views DESC, video_id LIMIT {n}"""


def _top_videos(name: str, width: int) -> str:
    return f"""SELECT batch_id, stamp AS "timestamp", '{name}' AS best_by,
    row_number() OVER (PARTITION BY batch_id ORDER BY view_count DESC, video_id) AS rank,
    video_id, substr(title, 1, {width}) || '...' AS title, channelTitle, view_count, predicted_views,
    round((predicted_views - view_count) / nullif(view_count, 0)::DOUBLE * 100, 6) AS growth_pct
    FROM msgs QUALIFY rank <= 3"""



def _per_category(measures: str, source: str) -> str:
    return f"SELECT categoryId, category_name, {measures} FROM {source} GROUP BY ALL"


def _top(metric: str, n: int, cols: str, source: str = "rated") -> str:
    return (
        f"SELECT {cols} FROM {source} ORDER BY {metric} DESC NULLS LAST, video_id LIMIT {n}"
    )


def _means(prefix: str, cols: dict[str, str]) -> str:
    return ", ".join(f"round(avg({c}), 6) AS {prefix}{name}" for name, c in cols.items())


_AVERAGES = _means(
    "avg_",
    {"likes": "likes", "dislikes": "dislikes", "comments": "comment_count", "views": "view_count"},
)
_RATE_MEANS = _means(
    "avg_",
    {r: r for r in ("engagement_rate", "like_rate", "comment_rate", "dislike_rate")},
)
_PER_DAY = f"""SELECT [{_DAYS}][isodow({{ts}})] AS {{name}}, count(*) AS count
  FROM obs GROUP BY ALL"""
_PUBLISH_DAYS = _PER_DAY.format(ts="publishedAt", name="publish_day")
_HOURS = """SELECT CAST(hour(publishedAt) AS INTEGER) AS publish_hour, count(*) AS count
  FROM obs GROUP BY ALL"""
_BANDS = """SELECT band, count, count / (SELECT count(*) FROM rated) * 100 AS percentage FROM (
  SELECT 'high' AS band, count(*) FILTER (engagement_rate > 10) AS count FROM rated UNION ALL
  SELECT 'medium', count(*) FILTER (engagement_rate BETWEEN 5 AND 10) FROM rated UNION ALL
  SELECT 'low', count(*) FILTER (engagement_rate < 5) FROM rated)"""


def _matrix() -> str:
    cells = [
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM rated"
        for a in CORRELATED
        for b in CORRELATED
    ]
    return " UNION ALL ".join(cells)


def _density() -> str:
    log, flat = "CAST(floor(log10({}) * 4) AS BIGINT)", "CAST(floor({}) AS BIGINT)"
    cells = []
    for x, y, y_cell in (
        ("view_count_num", "likes_num", log),
        ("view_count_num", "comment_count_num", log),
        ("view_count_num", "engagement_rate", flat),
        ("likes_num", "comment_count_num", log),
    ):
        wanted = f"{x} > 0 AND {y} > 0" if y_cell is log else f"{x} > 0 AND {y} IS NOT NULL"
        cells.append(
            f"SELECT '{x}' AS x, '{y}' AS y, {log.format(x)} AS x_cell, "
            f"{y_cell.format(y)} AS y_cell, count(*) AS count "
            f"FROM rated WHERE {wanted} GROUP BY ALL"
        )
    return " UNION ALL ".join(cells)


_QUALITY_ROWS = ("l_orderkey", "l_linenumber", "l_suppkey", "video_id", "title", "channelTitle",
                 "publishedAt", "trending_date", "categoryId", "tags", "view_count", "likes",
                 "dislikes", "comment_count", "description")
_TYPES = {
    **dict.fromkeys(_QUALITY_ROWS, "string"),
    **dict.fromkeys(
        ("l_orderkey", "l_suppkey", "view_count", "likes", "dislikes", "comment_count"), "bigint"
    ),
    "l_linenumber": "int",
    "categoryId": "int",
}
_NULLS = ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in _QUALITY_ROWS)
_PROFILE_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{_TYPES[c]}' AS data_type, "
    f"count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS row_count FROM raw"
    for c in _QUALITY_ROWS
)
_SCALER = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(avg({f}), 5) AS mean, "
    f"round(stddev_samp({f}), 5) AS std FROM labelled"
    for f in FEATURES
)
_RANKED_BY_TIME = f"""SELECT {KEY}, publishedAt, row_number() OVER (
  ORDER BY publishedAt NULLS FIRST, md5(concat_ws('|', {KEY}))) AS rk,
  count(*) OVER () AS n FROM obs"""

BODIES = {
    "s01_csv_scan": _RAW_FILE,
    "s01_split_scan": _RAW_FILE,
    "s01_bad_records": f"""SELECT n_rows, n_bad, bad_record FROM (
      SELECT count(*) OVER () AS n_rows, count(bad_record) OVER () AS n_bad, bad_record FROM (
      SELECT CASE WHEN suffix(view_count, '7') THEN video_id || ',' || view_count
      WHEN suffix(view_count, '3') THEN video_id || repeat(',x', 16) END AS bad_record
      FROM ({_RAW_FILE}))) WHERE bad_record IS NOT NULL""",
    "s02_clean_scan": "SELECT * FROM obs",
    "s03_gzip_scan": _RAW_FILE,
    "s04_flatten_listing": f"""SELECT video_id, title,
      strftime(publishedAt, '{ISO}') AS publishedAt, channelTitle,
      CAST(categoryId AS VARCHAR) AS categoryId,
      strftime(trending_date, '{ISO}') AS trending_date,
      CASE WHEN tags = '[none]' THEN '' ELSE replace(tags, '"', '') END AS tags,
      view_count, likes, CAST(0 AS BIGINT) AS dislikes,
      CASE WHEN l_linenumber = 2 THEN 0 ELSE comment_count END AS comment_count,
      l_linenumber = 2 AS comments_disabled, false AS ratings_disabled, description
      FROM obs""",
    "s04_daily_load": """SELECT strftime(trending_date, '%Y-%m') AS snapshot_month, count(*) AS rows,
      count(DISTINCT video_id) AS videos, max(trending_date) AS newest, max(views) AS most_views
      FROM (SELECT video_id, trending_date, max(view_count) AS views FROM obs GROUP BY 1, 2) GROUP BY 1""",
    "s05_decode_messages": _MESSAGES,
    "k01_text_export": """SELECT video_id, title,
      strftime(publishedAt, '%Y-%m-%d %H:%M:%S') AS publishedAt,
      strftime(trending_date, '%Y-%m-%d %H:%M:%S') AS trending_date, tags, view_count
      FROM obs""",
    "k02_tag_copy": """SELECT video_id,
      CASE WHEN tags = '[none]' THEN '' ELSE replace(replace(tags, '"', ''), '|', '~') END
        AS tags,
      CASE WHEN tags = '[none]' THEN 1 ELSE 2 END AS n_tags FROM obs""",
    "k03_upsert_keep_last": _UPSERT,
    "k04_publish_messages": _MESSAGES,
    "k03_merge_history": f"SELECT *, strftime(trending_date, '%Y-%m') AS snapshot_month FROM ({_UPSERT})",
    "k05_append_scored_batch": _BATCHES + """SELECT batch_id, stamp AS processing_timestamp,
      categoryId, count(*) AS rows, count(trending_date) AS dated,
      CAST(sum(view_count) AS BIGINT) AS views, round(avg(engagement_rate), 6) AS rate,
      CAST(sum(predicted_views) AS BIGINT) AS predicted FROM msgs GROUP BY ALL""",
    "k06_append_category_stats": _BATCHES + _BATCH_STATS,
    "k07_replace_predictions": _PREDICTIONS.format(
        cols="""video_id, title, categoryId, predicted_views, view_count, stamp AS "timestamp", batch_id""",
        n=10,
    ),
    "k08_reset_outputs": """SELECT 'realtime_data' AS output, CAST(0 AS BIGINT) AS rows UNION ALL
      SELECT 'category_stats', count(*) FROM stats UNION ALL SELECT 'predictions', 0""",
    "p01_drop_columns": "SELECT * EXCLUDE (tags, likes) FROM raw",
    "p02_select_columns": "SELECT title, video_id, view_count, categoryId FROM raw",
    "p03_cast_metrics": f"""SELECT {KEY}, view_count AS view_count_num,
      CASE WHEN l_linenumber <> 2 THEN likes ELSE -1 END AS likes_num, dislikes AS dislikes_num,
      comment_count AS comment_count_num FROM raw""",
    "p04_fill_missing": f"""SELECT {KEY}, coalesce(description, 'No description') AS description
      FROM raw""",
    "p05_parse_iso_times": f"""SELECT {KEY}, try_strptime(trending_date, '{ISO}') AS trending_date,
      strptime(publishedAt, '{ISO}') AS publishedAt FROM raw""",
    "p06_parse_default_times": f"SELECT {KEY}, trending_date FROM obs",
    "p07_parse_mixed_times": f"""SELECT {KEY}, CASE
        WHEN l_linenumber = 1 THEN strptime(publishedAt, '{ISO}')
        WHEN l_linenumber = 3 THEN strptime(publishedAt, '{ISO}') - INTERVAL 2 HOUR
        WHEN l_linenumber = 4 THEN date_trunc('day', strptime(publishedAt, '{ISO}'))
          + INTERVAL '10 hours 11 minutes 12 seconds'
        WHEN l_linenumber = 5 THEN NULL
        ELSE date_trunc('day', strptime(publishedAt, '{ISO}')) END::TIMESTAMP AS published
      FROM raw""",
    "p08_format_times": f"""SELECT {KEY},
      strftime(trending_date, '%Y-%m-%d %H:%M:%S') AS trending_date,
      strftime(publishedAt, '%Y-%m-%d %H:%M:%S') AS publishedAt FROM obs""",
    "p09_category_name": f"SELECT {KEY}, categoryId, category_name FROM named",
    "p10_tag_list": f"""SELECT {KEY},
      CASE WHEN tags = '[none]' THEN '' ELSE replace(replace(tags, '"', ''), '|', '~') END
        AS tags,
      CASE WHEN tags = '[none]' THEN 1 ELSE 2 END AS n_tags,
      CASE WHEN tags = '[none]' THEN '' ELSE channelTitle END AS first_tag FROM raw""",
    "q01_keep_keyed": f"SELECT {KEY} FROM raw WHERE l_linenumber > 2",
    "q02_drop_empty_rows": """SELECT description, trending_date FROM raw
      WHERE description IS NOT NULL""",
    "q03_keep_valid_dates": f"""SELECT {KEY}, trending_date FROM raw
      WHERE regexp_matches(trending_date, '{PATTERN}')""",
    "q04_invalid_dates": f"""SELECT DISTINCT trending_date FROM raw
      WHERE NOT regexp_matches(trending_date, '{PATTERN}')""",
    "q05_validity_counts": f"""SELECT count(*) AS total_rows,
      count(*) FILTER (video_id <> '') AS keyed_rows, count(trending_date) AS dated_rows,
      count(*) FILTER (regexp_matches(trending_date, '{PATTERN}')) AS valid_dates FROM raw""",
    "q06_known_values": """SELECT DISTINCT trending_date FROM raw
      WHERE trending_date IS NOT NULL""",
    "q07_profile": f"SELECT count(*) AS row_count, {_NULLS}, 15 AS column_count FROM raw",
    "q07_profile_columns": _PROFILE_ROWS,
    "q08_quality_band": f"""SELECT {KEY}, view_count, likes FROM obs
      WHERE view_count >= 1000 AND view_count <= 50000000 AND likes > 0
        AND comment_count >= 0""",
    "q09_drop_incomplete": f"""SELECT {KEY}, description FROM raw
      WHERE description IS NOT NULL AND tags IS NOT NULL""",
    "q10_exclude_category": _per_category(
        "CAST(sum(view_count) AS BIGINT) AS total_views", "entity"
    ).replace("GROUP BY", "WHERE category_name <> 'Music' GROUP BY"),
    "q11_same_day_rows": """SELECT video_id, trending_date FROM first_trend
      WHERE days_to_trend = 0""",
    "q12_band_counts": f"SELECT band, count FROM ({_BANDS})",
    "j01_category_join": """SELECT coalesce(p_type, 'Unknown') AS category_name,
      count(*) AS count FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "a01_categories": "SELECT DISTINCT categoryId, category_name FROM named",
    "a01_distinct_counts": """SELECT
      (SELECT count(*) FROM (SELECT DISTINCT categoryId FROM obs)) AS total_categories,
      (SELECT count(*) FROM (SELECT DISTINCT channelTitle FROM obs)) AS total_channels""",
    "a02_category_counts": _per_category("count(*) AS count", "named"),
    "a03_category_shares": _per_category(
        "count(*) AS count, count(*) / (SELECT count(*) FROM obs) * 100 AS percentage", "named"
    ),
    "a03_top_shares": _per_category(
        "count(*) AS count, count(*) / (SELECT count(*) FROM obs) * 100 AS percentage", "named"
    )
    + " ORDER BY count DESC, categoryId LIMIT 5",
    "a04_total_views_by_category": _per_category(
        "CAST(sum(view_count) AS BIGINT) AS total_views", "entity"
    ),
    "a05_unique_channels": _per_category(
        "count(DISTINCT channelTitle) AS unique_channels", "named"
    ),
    "a06_average_metrics": _per_category(_AVERAGES, "named"),
    "a07_channel_concentration": """SELECT category_name, count(video_id) AS total_videos,
      count(DISTINCT channelTitle) AS unique_channels,
      count(video_id) / count(DISTINCT channelTitle) AS videos_per_channel
      FROM named GROUP BY 1""",
    "a08_like_dislike_ratio": """SELECT category_name, CAST(sum(likes) AS BIGINT) AS total_likes,
      CAST(sum(dislikes) AS BIGINT) AS total_dislikes,
      CAST(sum(likes) AS BIGINT) / (CAST(sum(dislikes) AS BIGINT) + 1) AS like_dislike_ratio
      FROM named GROUP BY 1""",
    "a09_publish_hours": _HOURS,
    "a10_publish_days": _PUBLISH_DAYS,
    "a10_trending_days": _PER_DAY.format(ts="trending_date", name="trending_day"),
    "a11_peak_hour": f"""SELECT
      (SELECT publish_hour FROM h ORDER BY count DESC, publish_hour LIMIT 1)
        AS peak_publish_hour, (SELECT max(count) FROM h) AS peak_count,
      (SELECT publish_hour FROM h ORDER BY count, publish_hour LIMIT 1)
        AS low_publish_hour, (SELECT min(count) FROM h) AS low_count
      FROM (SELECT 1), (SELECT 1) LIMIT 1""".replace(" FROM h", f" FROM ({_HOURS}) h"),
    "a11_peak_day": f"""SELECT
      (SELECT publish_day FROM h ORDER BY count DESC, list_position([{_DAYS}], publish_day)
        LIMIT 1) AS peak_publish_day, (SELECT max(count) FROM h) AS peak_count,
      (SELECT publish_day FROM h ORDER BY count, list_position([{_DAYS}], publish_day)
        LIMIT 1) AS low_publish_day,
      (SELECT min(count) FROM h) AS low_count""".replace(
        " FROM h", f" FROM ({_PUBLISH_DAYS}) h"
    ),
    "a12_time_to_trend": """SELECT round(avg(days_to_trend), 6) AS avg_days,
      quantile_disc(days_to_trend, 0.5) AS median_days, min(days_to_trend) AS min_days,
      max(days_to_trend) AS max_days FROM first_trend""",
    "a13_days_distribution": """SELECT days_to_trend, count(*) AS count FROM first_trend
      GROUP BY 1 ORDER BY 1 LIMIT 30""",
    "a14_same_day": """SELECT count(*) FILTER (days_to_trend = 0) AS same_day, count(*) AS total,
      count(*) FILTER (days_to_trend = 0) / count(*) * 100 AS pct FROM first_trend""",
    "a15_hour_by_weekday": "SELECT CAST(hour(publishedAt) AS INTEGER) AS publish_hour, "
    + ", ".join(
        f"count(*) FILTER (isodow(publishedAt) = {i}) AS {d}"
        for i, d in enumerate(WEEKDAYS, 1)
    )
    + " FROM obs GROUP BY 1",
    "a15_busiest_cell": f"""SELECT CAST(hour(publishedAt) AS INTEGER) AS publish_hour,
      [{_DAYS}][isodow(publishedAt)] AS publish_day, count(*) AS count FROM obs
      GROUP BY 1, 2, isodow(publishedAt)
      ORDER BY count DESC, publish_hour, isodow(publishedAt) LIMIT 1""",
    "a16_engagement_bands": _BANDS,
    "a17_time_to_trend_by_category": """SELECT category_name,
      round(avg(days_to_trend), 6) AS avg_days_to_trend,
      quantile_disc(days_to_trend, 0.5) AS median_days_to_trend FROM first_trend GROUP BY 1""",
    "a18_metrics_by_publish_hour": "SELECT CAST(hour(publishedAt) AS INTEGER) AS publish_hour, "
    + _means("avg_", {"views": "view_count", "likes": "likes", "comments": "comment_count"})
    + " FROM entity GROUP BY 1",
    "a19_trending_lifespan": """SELECT category_name,
      round(avg(days), 6) AS avg_trending_lifespan,
      quantile_disc(days, 0.5) AS median_trending_lifespan FROM (
        SELECT video_id, category_name, CAST(date_diff('day', min(trending_date),
          max(trending_date)) + 1 AS INTEGER) AS days FROM named GROUP BY 1, 2) GROUP BY 1""",
    "a20_rates_by_category": _per_category(
        f"{_RATE_MEANS}, count(video_id) AS video_count", "rated"
    ),
    "a21_engagement_totals": """SELECT count(*) AS total_videos,
      CAST(sum(view_count) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
      CAST(sum(comment_count) AS BIGINT) AS total_comments,
      round(avg(engagement_rate), 6) AS avg_engagement_rate FROM rated""",
    "a22_batch_totals": """SELECT count(*) AS videos, CAST(sum(view_count) AS BIGINT) AS total_views,
      round(avg(engagement_rate), 6) AS avg_engagement_rate FROM featured""",
    "a23_batch_category_stats": "SELECT * FROM stats",
    "a24_category_summary": """, c AS (
        SELECT categoryId, category_name, count(*) AS n,
          count(DISTINCT channelTitle) AS channels, avg(likes) AS likes
        FROM named GROUP BY 1, 2),
      v AS (SELECT categoryId, category_name, CAST(sum(view_count) AS BIGINT) AS views
        FROM entity GROUP BY 1, 2),
      by_n AS (SELECT * FROM c ORDER BY n DESC, categoryId LIMIT 1),
      by_v AS (SELECT * FROM v ORDER BY views DESC, categoryId LIMIT 1),
      by_c AS (SELECT * FROM c ORDER BY channels DESC, categoryId LIMIT 1),
      by_l AS (SELECT * FROM c ORDER BY likes DESC, categoryId LIMIT 1)
      SELECT by_n.category_name AS top_by_count, by_n.n AS count,
        by_n.n / (SELECT count(*) FROM obs) * 100 AS percentage,
        by_v.category_name AS top_by_total_views, by_v.views AS total_views,
        by_c.category_name AS top_by_unique_channels, by_c.channels AS unique_channels,
        by_l.category_name AS top_by_avg_likes, round(by_l.likes, 6) AS avg_likes,
        (SELECT count(*) FROM obs) AS total_rows,
        (SELECT count(DISTINCT categoryId) FROM obs) AS total_categories,
        (SELECT count(DISTINCT channelTitle) FROM obs) AS total_channels
      FROM by_n, by_v, by_c, by_l""",
    "a25_interaction_summary": """, r AS (
        SELECT categoryId, category_name, avg(engagement_rate) AS rate, count(*) AS n
        FROM rated GROUP BY 1, 2),
      best_views AS (SELECT * FROM rated ORDER BY view_count DESC, video_id LIMIT 1),
      best_rate AS (SELECT * FROM rated ORDER BY engagement_rate DESC NULLS LAST, video_id
        LIMIT 1),
      best_likes AS (SELECT * FROM rated ORDER BY likes DESC, video_id LIMIT 1),
      best AS (SELECT * FROM r ORDER BY rate DESC NULLS LAST, categoryId LIMIT 1)
      SELECT (SELECT count(*) FROM rated) AS total_videos,
        (SELECT CAST(sum(view_count) AS BIGINT) FROM rated) AS total_views,
        (SELECT CAST(sum(likes) AS BIGINT) FROM rated) AS total_likes,
        (SELECT CAST(sum(comment_count) AS BIGINT) FROM rated) AS total_comments,
        (SELECT round(avg(engagement_rate), 6) FROM rated) AS avg_engagement_rate,
        best_views.title AS most_viewed, best_views.view_count AS most_viewed_view_count_num,
        best_rate.title AS most_engaging,
        round(best_rate.engagement_rate, 6) AS most_engaging_engagement_rate,
        best_likes.title AS most_liked, best_likes.likes AS most_liked_likes_num,
        best.category_name AS top_category, round(best.rate, 6) AS top_category_rate,
        (SELECT max(n) FROM r WHERE category_name = 'Music') AS named_count,
        (SELECT round(max(rate), 6) FROM r WHERE category_name = 'Comedy') AS named_rate
      FROM best_views, best_rate, best_likes, best""",
    "a26_date_range": """SELECT max(trending_date) AS newest, min(trending_date) AS oldest
      FROM obs""",
    "c01_correlation_matrix": _matrix(),
    "c02_pair_value": """SELECT 'view_count_num' AS a, 'engagement_rate' AS b,
      round(corr(view_count_num, engagement_rate), 6) AS r FROM rated""",
    "c03_log_density": _density(),
    "w01_keep_best": """SELECT video_id, view_count AS view_count_num, trending_date, l_orderkey
      FROM entity""",
    "w02_keep_first": "SELECT video_id, trending_date, days_to_trend, l_orderkey FROM first_trend",
    "w03_best_video_by_category": """SELECT category_name, title, channelTitle,
      view_count AS view_count_num, likes AS likes_num FROM entity
      QUALIFY row_number() OVER (PARTITION BY category_name
        ORDER BY view_count DESC NULLS LAST, video_id) = 1""",
    "w03_top3_by_category": """SELECT category_name, title, channelTitle,
      view_count AS view_count_num, likes AS likes_num FROM entity
      QUALIFY row_number() OVER (PARTITION BY category_name
        ORDER BY view_count DESC NULLS LAST, video_id) <= 3""",
    "t01_top10_views": _top(
        "view_count_num", 10, "title, category_name, channelTitle, view_count_num"
    ),
    "t02_top20_views": _top(
        "view_count_num", 20, "title, channelTitle, view_count_num, likes_num, engagement_rate"
    ),
    "t02_top20_engagement": _top(
        "total_engagement",
        20,
        "title, channelTitle, total_engagement, view_count_num, engagement_rate",
    ),
    "t02_top20_likes": _top(
        "likes_num", 20, "title, channelTitle, likes_num, view_count_num, like_rate"
    ),
    "t02_top20_comments": _top(
        "comment_count_num",
        20,
        "title, channelTitle, comment_count_num, view_count_num, comment_rate",
    ),
    "t02_top20_engagement_rate": _top(
        "engagement_rate",
        20,
        "title, channelTitle, engagement_rate, view_count_num, total_engagement",
    ),
    "t03_rate_preview": _top(
        "engagement_rate",
        10,
        "title, view_count_num, likes_num, total_engagement, engagement_rate",
    ),
    "t04_most_viewed": _top("view_count_num", 1, "title, view_count_num"),
    "t05_batch_top3": _top(
        "view_count", 3, "substr(title, 1, 50) || '...' AS title, view_count, channelTitle"
    ),
    "t05_predicted_top3": _top(
        "likes",
        3,
        """substr(title, 1, 40) || '...' AS title, view_count,
        likes * 12.5::DOUBLE AS predicted_views,
        round((likes * 12.5::DOUBLE - view_count) / nullif(view_count, 0) * 100, 6)
          AS growth_pct""",
    ),
    "t06_newest": """SELECT trending_date, title, channelTitle, view_count FROM obs
      ORDER BY obs.trending_date DESC NULLS LAST, video_id, l_orderkey, l_linenumber, l_suppkey
      LIMIT 5""",
    "t07_weekday_order": f"""SELECT publish_day, count,
      CAST(list_position([{_DAYS}], publish_day) AS INTEGER) AS position
      FROM ({_PUBLISH_DAYS})""",
    "t08_preview": f"SELECT {KEY}, title FROM obs ORDER BY {KEY} LIMIT 5",
    "u01_append": """SELECT video_id, 2 * count(*) AS rows, count(view_count) AS known_views
      FROM obs GROUP BY 1""",
    "u02_upsert_unique_history": _UPSERT,
    "u03_distinct": "SELECT DISTINCT categoryId, channelTitle FROM obs",
    "x01_x04_time_parts": f"""SELECT {KEY}, CAST(hour(publishedAt) AS INTEGER) AS publish_hour,
      strftime(publishedAt, '%a') AS publish_day, strftime(publishedAt, '%Y-%m-%d') AS publish_date,
      strftime(trending_date, '%a') AS trending_day,
      CAST(month(trending_date) AS INTEGER) AS trending_month,
      CAST(year(trending_date) AS INTEGER) AS trending_year,
      CAST(dayofweek(publishedAt) + 1 AS INTEGER) AS day_of_week FROM obs""",
    "x05_x06_epoch_and_days": f"""SELECT {KEY},
      CAST(epoch(publishedAt) AS BIGINT) AS pub_timestamp,
      CAST(date_diff('day', publishedAt, trending_date) AS INTEGER) AS days FROM obs""",
    "x07_stamp_rows": "SELECT true AS stamped, count(*) AS rows FROM obs",
    "x08_x10_text": f"""SELECT {KEY}, regexp_matches(trending_date, '{PATTERN}') AS iso,
      replace(tags, '"', '') AS bare,
      CASE WHEN tags = '[none]' THEN '' ELSE replace(tags, '"', '') END AS joined,
      CASE WHEN length(title) > 12 THEN substr(title, 1, 12) || '...' ELSE title END AS short,
      substr(title, 1, 10) || '...' AS dotted FROM raw""",
    "x11_x13_math": f"""SELECT {KEY}, round(log10(view_count + 1), 6) AS scale,
      round(pow(10.0::DOUBLE, log10(likes + 1) / 4), 6) AS power,
      abs(likes - comment_count) AS gap FROM obs""",
    "x14_x15_conditions": f"""SELECT {KEY},
      CASE WHEN l_linenumber * 9 < 20 THEN 'EXCELLENT' WHEN l_linenumber * 9 < 35 THEN 'GOOD'
        WHEN l_linenumber * 9 < 50 THEN 'ACCEPTABLE' ELSE 'NEEDS IMPROVEMENT' END AS verdict,
      CAST(nullif(likes, 0) AS DOUBLE) AS likes_or_null,
      tags IS NOT NULL AND tags <> '' AS has_tags FROM obs""",
    "x16_json": "SELECT video_id, view_count FROM obs",
    "x17_x18_engagement": """SELECT video_id, total_engagement, round(like_rate, 6) AS like_rate,
      round(dislike_rate, 6) AS dislike_rate, round(comment_rate, 6) AS comment_rate,
      round(engagement_rate, 6) AS engagement_rate FROM rated""",
    "x19_growth": f"""SELECT {KEY}, round((likes * 12.5::DOUBLE - view_count)
      / nullif(view_count, 0) * 100, 6) AS growth FROM obs""",
    "x20_days_to_trend": f"SELECT {KEY}, days_to_trend FROM named",
    "m01_hash_sample": f"""SELECT {KEY} FROM obs
      WHERE md5(concat_ws('|', {KEY})) < '26666666'""",
    "m02_features": f"""SELECT {KEY}, categoryId, round(engagement_rate, 6) AS engagement_rate,
      round(like_rate, 6) AS like_rate, round(comment_rate, 6) AS comment_rate,
      round(like_comment_ratio, 6) AS like_comment_ratio, round(view_scale, 6) AS view_scale,
      round(engagement_scale, 6) AS engagement_scale, publish_hour, day_of_week, is_weekend,
      is_prime_time FROM featured""",
    "m03_label": f"SELECT {KEY}, round(growth_potential, 6) AS growth_potential FROM labelled",
    "m04_time_split": f"""SELECT {KEY}, publishedAt,
      CASE WHEN rk <= floor(n * 0.8) THEN 'train' ELSE 'valid' END AS part
      FROM ({_RANKED_BY_TIME})""",
    "m05_standardise": _SCALER,
    "m06_held_out": f"""SELECT {KEY}, round(growth_potential, 6) AS growth_potential,
      true AS bounded FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (
        ORDER BY publishedAt NULLS FIRST, md5(concat_ws('|', {KEY}))) AS rk
        FROM labelled WHERE md5(concat_ws('|', {KEY})) < '26666666')
      WHERE rk > floor(n * 0.8) AND publishedAt IS NOT NULL AND categoryId IS NOT NULL""",
    "m09_scored_rows": f"""SELECT {KEY}, view_count, true AS bounded, categoryId IS NOT NULL
      AND publishedAt IS NOT NULL AND view_count IS NOT NULL AND likes IS NOT NULL
      AND comment_count IS NOT NULL AS predicted FROM featured""",
    "m07_m08_metrics": """SELECT round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2,
      round(mape, 6) AS mape, CASE WHEN mape < 20 THEN 'EXCELLENT' WHEN mape < 35 THEN 'GOOD'
        WHEN mape < 50 THEN 'ACCEPTABLE' ELSE 'NEEDS IMPROVEMENT' END AS verdict
      FROM (SELECT sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
        1 - avg((y - p) * (y - p)) / var_pop(y) AS r2,
        avg(abs(y - p) / (abs(y) + 1e-10)) * 100 AS mape
        FROM (SELECT growth_potential AS y, view_scale * 1.25::DOUBLE AS p FROM labelled))""",
    "m10_back_transform": f"""SELECT {KEY}, round(pow(10.0::DOUBLE,
      growth_potential / (1 + engagement_rate / 100)), 3) AS views FROM labelled""",
    "m11_fallback": """SELECT l_linenumber = 1 AS incomplete, count(*) AS rows,
      count(*) FILTER (l_linenumber <> 1) AS predicted FROM obs GROUP BY 1""",
    "st01_st04_scored_stream": """SELECT categoryId, count(*) AS rows,
      CAST(sum(view_count) AS BIGINT) AS views, round(avg(
        (likes + comment_count) / (view_count + 1) * 100), 6) AS rate, count(publishedAt) AS hours
      FROM raw GROUP BY 1""",
    "st03_stream_category_stats": """SELECT categoryId, count(*) AS rows,
      CAST(sum(view_count) AS BIGINT) AS views FROM raw GROUP BY 1""",
    "st03_batch_totals": _BATCHES + """SELECT batch_id, stamp AS "timestamp", count(*) AS videos,
      CAST(sum(view_count) AS BIGINT) AS total_views,
      round(avg(engagement_rate), 6) AS avg_engagement_rate FROM msgs GROUP BY ALL""",
    "st03_top_videos": _BATCHES + _top_videos("viewed", 50) + " UNION ALL " + _top_videos("predicted", 40),
    "st04_restart": _BATCHES + """SELECT categoryId, count(*) AS rows,
      CAST(sum(view_count) AS BIGINT) AS views, CAST(sum(predicted_views) AS BIGINT) AS predicted
      FROM msgs GROUP BY 1""",
    "r01_latest_observations": _BATCHES + """SELECT stamp AS processing_timestamp, video_id,
      trending_date FROM msgs ORDER BY stamp DESC, video_id, msgs.trending_date NULLS FIRST LIMIT 100""",
    "r02_top_predictions": _PREDICTIONS.format(
        cols="video_id, title, categoryId, predicted_views, view_count", n=5
    ),
    "r03_latest_category_stats": _BATCHES + """SELECT stamp AS "timestamp", categoryId,
      count(view_count) AS view_count_count, CAST(sum(view_count) AS BIGINT) AS view_count_sum
      FROM msgs GROUP BY ALL ORDER BY stamp DESC, categoryId LIMIT 20""",
}

# Observations after three loads, as an upsert keeps them.
_LOADED = """obs AS (
  SELECT * EXCLUDE (age, rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id, trending_date
      ORDER BY age DESC, view_count DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rk
    FROM (
      SELECT *, 1 AS age FROM first_obs WHERE l_linenumber <> 3 UNION ALL
      SELECT * REPLACE (view_count + 7 AS view_count, likes * 2 AS likes), 2 FROM first_obs
        WHERE year(trending_date) <= 1994 AND l_linenumber IN (2, 3) UNION ALL
      SELECT * REPLACE (view_count // 2 AS view_count, 10 AS categoryId, 'moved' AS channelTitle), 3
        FROM first_obs WHERE year(trending_date) = 1996 AND l_linenumber = 5))
  WHERE rk = 1),
named AS ("""
LOADED = INPUTS.replace("obs AS (", "first_obs AS (", 1).replace("named AS (", _LOADED, 1)
RECOMPUTED = ("a02_category_counts", "a03_category_shares", "a04_total_views_by_category",
              "a05_unique_channels", "a06_average_metrics", "a07_channel_concentration",
              "a08_like_dislike_ratio", "a09_publish_hours", "a10_publish_days", "a10_trending_days",
              "a12_time_to_trend", "a13_days_distribution", "a14_same_day", "a15_hour_by_weekday",
              "a16_engagement_bands", "a17_time_to_trend_by_category", "a18_metrics_by_publish_hour",
              "a19_trending_lifespan", "a20_rates_by_category", "a21_engagement_totals")

ORACLES = {name: INPUTS + body for name, body in BODIES.items()}
ORACLES |= {f"{name}_incremental": LOADED + BODIES[name] for name in RECOMPUTED}
ORACLES["a05_estimated_channels"] = LOADED + _per_category(
    "count(DISTINCT channelTitle) AS unique_channels, true AS near", "named"
)
