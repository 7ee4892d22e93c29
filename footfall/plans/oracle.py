"""The checked queries as plain SQL over the supplied tables, one text per query name.

Written from the description of each operator, as an independent statement of its result.
"""

from __future__ import annotations

# Views with the shape of the jobs' inputs.

_UVA = """
uva AS (
  SELECT strftime(DATE '2024-01-01' + CAST(bno * blk AS INTEGER), '%Y-%m-%d') AS date,
         user_id,
         CASE WHEN user_id % 50 = 49 AND bno = 0 THEN NULL
              ELSE 's' || user_id || '-' || bno END AS session_id,
         event_id % 10 AS page_id,
         CASE event_id % 83 WHEN 1 THEN
           strftime(DATE '2024-01-01' + CAST(bno * blk AS INTEGER), '%Y-%-m-%-d') || ' '
             || ((user_id * 7 + bno * 5) % 23) || ':' || (off // 60) || ':' || (off % 60)
         ELSE
           strftime(DATE '2024-01-01' + CAST(bno * blk AS INTEGER), '%Y-%m-%d') || ' '
             || lpad(CAST((user_id * 7 + bno * 5) % 23 AS VARCHAR), 2, '0') || ':'
             || lpad(CAST(off // 60 AS VARCHAR), 2, '0') || ':'
             || lpad(CAST(off % 60 AS VARCHAR), 2, '0')
             || CASE WHEN event_id % 83 = 2 THEN ' +05:00' ELSE '' END END AS action_time,
         CASE WHEN event_id % 83 <> 2 THEN
           CAST(DATE '2024-01-01' + CAST(bno * blk AS INTEGER) AS TIMESTAMP)
             + to_seconds((user_id * 7 + bno * 5) % 23 * 3600 + off) END AS t,
         CASE WHEN event_type = 'view' THEN
           CASE event_id % 9 WHEN 0 THEN 'apple iphone' WHEN 1 THEN 'computer' WHEN 2 THEN 'ipad'
             WHEN 3 THEN 'headset' WHEN 4 THEN 'Lamer' WHEN 5 THEN 'deep learning'
             WHEN 6 THEN 'apple' WHEN 7 THEN 'spark' ELSE 'food' END END AS search_keyword,
         CASE WHEN event_type IN ('click', 'error') THEN (event_id * event_id) % 100 ELSE -1 END
           AS click_category_id,
         CASE WHEN event_type IN ('click', 'error') THEN (event_id * 13) % 100 ELSE -1 END
           AS click_product_id,
         CASE WHEN event_type = 'signup' THEN (event_id % 100) ||
           CASE WHEN event_id % 3 = 0 THEN ',' || ((event_id * 3) % 100) ELSE '' END ||
           CASE WHEN event_id % 7 = 0 THEN ',x' ELSE '' END END
           AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN (event_id % 100) ||
           CASE WHEN event_id % 4 = 0 THEN ',' || ((event_id * 7) % 100) ELSE '' END END
           AS pay_category_ids,
         (event_id // 10) % 10 AS city_id,
         event_id
  FROM (
    SELECT *, (event_id * 7919) % CASE (user_id + bno) % 9 WHEN 0 THEN 4 WHEN 1 THEN 7 WHEN 2 THEN 10
              WHEN 3 THEN 31 WHEN 4 THEN 61 WHEN 5 THEN 181 WHEN 6 THEN 601 WHEN 7 THEN 1801
              ELSE 3600 END AS off
    FROM (
      SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // blk AS bno
      FROM (SELECT *, CASE user_id % 10 WHEN 0 THEN 30 WHEN 1 THEN 15 WHEN 2 THEN 1 ELSE 5 END AS blk
            FROM events)
    )
  )
)"""

_UI = """
ui AS (
  SELECT c_custkey AS user_id, CAST((c_custkey * 7) % 60 AS INTEGER) AS age,
         'professional' || (c_custkey % 100) AS professional,
         'city' || c_nationkey AS city,
         CASE c_custkey % 2 WHEN 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer WHERE c_custkey % 13 <> 5
)"""

_SESSION = """
sess AS (
  SELECT session_id, min(user_id) AS user_id, min(t) AS t0, max(t) AS t1,
         count(*) AS step_length,
         string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword) AS search_keywords,
         list_sort(list(DISTINCT click_category_id) FILTER (WHERE click_category_id <> -1)) AS cats,
         coalesce(bool_or(search_keyword IN ('spark', 'ipad')), FALSE) AS wanted,
         coalesce(bool_or(search_keyword IN ('spark', 'ipad', 'food')), FALSE)
           AND bool_or(click_category_id BETWEEN 0 AND 59) AS picked
  FROM uva GROUP BY session_id
),
info AS (
  SELECT session_id, sess.user_id, t0, date_diff('second', t0, t1) AS visit_length, step_length,
         strftime(t0, '%Y-%m-%d %H:%M:%S') AS start_time,
         strftime(t1, '%Y-%m-%d %H:%M:%S') AS end_time,
         search_keywords, nullif(array_to_string(cats, ','), '') AS click_category_ids, wanted,
         picked
  FROM sess
),
fullinfo AS (SELECT info.*, age, professional, sex, city FROM info JOIN ui USING (user_id)),
adults AS (SELECT * FROM fullinfo WHERE age >= 20 AND age <= 50)"""

_SESSION_CTES = f"WITH {_UVA},{_UI},{_SESSION}"
_SESSION_COLUMNS = (
    "session_id, user_id, start_time, end_time, visit_length, step_length"
)
_CATEGORY = f"""{_SESSION_CTES},
acts AS (
  SELECT uva.* FROM uva JOIN (SELECT session_id AS sid FROM adults)
    ON session_id IS NOT DISTINCT FROM sid
),
hits AS (
  SELECT session_id, 'click' AS kind, click_category_id AS category_id
  FROM acts WHERE click_category_id <> -1
  UNION ALL
  SELECT * FROM (
    SELECT session_id, 'order', TRY_CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT)
      AS category_id
    FROM acts WHERE order_category_ids IS NOT NULL) WHERE category_id IS NOT NULL
  UNION ALL
  SELECT session_id, 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT)
  FROM acts WHERE pay_category_ids IS NOT NULL
),
full_count AS (
  SELECT category_id, count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM hits GROUP BY category_id
),
top10 AS (
  SELECT * FROM full_count
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
),
session_clicks AS (
  SELECT session_id, category_id, count(*) AS click_count
  FROM hits WHERE kind = 'click' AND category_id IN (SELECT category_id FROM top10)
  GROUP BY session_id, category_id
)"""

# Bands: name, condition on the length.
_VISIT = (
    ("1s_3s", "BETWEEN 1 AND 3"), ("4s_6s", "BETWEEN 4 AND 6"), ("7s_9s", "BETWEEN 7 AND 9"),
    ("10s_30s", "BETWEEN 10 AND 30"), ("30s_60s", "BETWEEN 31 AND 60"),
    ("1m_3m", "BETWEEN 61 AND 180"), ("3m_10m", "BETWEEN 181 AND 600"),
    ("10m_30m", "BETWEEN 601 AND 1800"), ("30m", "> 1800"),
)
_STEP = (
    ("1_3", "BETWEEN 1 AND 3"), ("4_6", "BETWEEN 4 AND 6"), ("7_9", "BETWEEN 7 AND 9"),
    ("10_30", "BETWEEN 10 AND 30"), ("30_60", "BETWEEN 31 AND 60"), ("60", "> 60"),
)


def _histogram(bands, length: str) -> str:
    return _SESSION_CTES + " UNION ALL ".join(
        f" SELECT '{name}' AS band, count(*) AS sessions FROM adults WHERE {length} {condition}"
        for name, condition in bands
    )


def _ratio() -> str:
    parts = []
    for bands, length in ((_VISIT, "visit_length"), (_STEP, "step_length")):
        for name, condition in bands:
            n = f"count(*) FILTER (WHERE {length} {condition})"
            # Half-up to two decimals in integers.
            parts.append(
                f"((200 * {n} + greatest(count(*), 1)) // (2 * greatest(count(*), 1))) / 100.0"
                f" AS {length}_{name}_ratio"
            )
    return (
        f"{_SESSION_CTES} SELECT 'task-1' AS taskid, count(*) AS session_count, "
        + ", ".join(parts) + " FROM adults"
    )


def _extract(ctes: str, total: int) -> str:
    return f"""{ctes},
hours AS (
  SELECT strftime(t0, '%Y-%m-%d') AS date, CAST(hour(t0) AS INTEGER) AS hour, count(*) AS hour_count
  FROM adults WHERE t0 IS NOT NULL GROUP BY 1, 2
),
days AS (SELECT date, CAST(sum(hour_count) AS BIGINT) AS day_count FROM hours GROUP BY date),
quotas AS (
  SELECT date, hour, hour_count, day_count,
         CAST({total} // (SELECT count(*) FROM days) AS BIGINT) AS extract_per_day,
         CAST(least(hour_count, floor(CAST(hour_count AS DOUBLE) / day_count
              * ({total} // (SELECT count(*) FROM days)))) AS BIGINT) AS quota
  FROM hours JOIN days USING (date)
)"""


_DRAW = """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY strftime(t0, '%Y-%m-%d'), hour(t0)
                               ORDER BY md5(coalesce(session_id, '') || 'task-1'), session_id) AS rn
  FROM adults
)
SELECT 'task-1' AS taskid, session_id AS sessionid, start_time AS "startTime",
       search_keywords AS "searchKeywords", click_category_ids AS "clickCategoryIds"
FROM ranked JOIN quotas q ON q.date = strftime(t0, '%Y-%m-%d') AND q.hour = hour(t0)
WHERE rn <= quota"""


def _flow_ctes(direction: str) -> str:
    nulls = {"DESC": "DESC NULLS LAST", "ASC": "ASC NULLS FIRST"}[direction]
    return f"""WITH {_UVA},
following AS (
  SELECT session_id, action_time, event_id, page_id,
         lead(page_id) OVER (PARTITION BY session_id
           ORDER BY t {nulls}, event_id {direction}) AS next_page_id
  FROM uva
),
target(step, a, b) AS (VALUES (1, 1, 2), (2, 2, 3), (3, 3, 4), (4, 4, 5), (5, 5, 6), (6, 6, 7)),
counted AS (
  SELECT step, a || '_' || b AS pair,
         (SELECT count(*) FROM following f WHERE f.page_id = a AND f.next_page_id = b) AS pair_count
  FROM target
),
rated AS (
  SELECT step, pair, pair_count,
         pair_count / CAST(nullif(coalesce(lag(pair_count) OVER (ORDER BY step),
                     (SELECT count(*) FROM uva WHERE page_id = 1)), 0) AS DOUBLE) AS rate
  FROM counted
)"""


# Cities and areas.
_CITY = """
city(city_id, city_name, area) AS (VALUES
  (0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'),
  (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'),
  (8, '成都', '西南'), (9, '哈尔滨', '东北'))"""

_AREA = f"""WITH {_UVA},{_CITY},
detail AS (
  SELECT uva.city_id, city_name, area, click_product_id AS pid
  FROM uva JOIN city USING (city_id) WHERE click_product_id <> -1
),
products AS (
  SELECT area, pid, count(*) AS click_count,
         string_agg(DISTINCT city_id || ':' || city_name, ',' ORDER BY city_id || ':' || city_name)
           AS city_infos
  FROM detail GROUP BY area, pid
)"""

_AD = """
ad AS (
  SELECT epoch_us(ts) // 1000 AS ts_ms,
         CAST(user_id % 10 AS VARCHAR) AS province, CAST(user_id % 10 AS VARCHAR) AS city,
         CASE WHEN event_id % 2 = 0 THEN 7 ELSE user_id % 100 END AS userid,
         CASE WHEN event_id % 2 = 0 THEN 1 ELSE event_id % 20 END AS adid,
         ts, strftime(ts, '%Y%m%d') AS date
  FROM events WHERE event_id % 97 NOT IN (5, 6, 7)
)"""
_AD_CTES = f"""WITH {_AD},
user_clicks AS (
  SELECT date, userid, adid, count(*) AS click_count FROM ad GROUP BY date, userid, adid
),
city_clicks AS (
  SELECT date, province, city, adid, count(*) AS click_count
  FROM ad GROUP BY date, province, city, adid
)"""
# The stream's micro-batches: a user over the limit in one is dropped from the next one on.
_OVER = "GROUP BY date, userid, adid HAVING count(*) > 100"
_AD_REPLAY = f"""WITH {_AD},
part AS (
  SELECT *, CASE WHEN ts >= '2024-01-21' THEN 1 WHEN ts >= '2024-01-11' THEN 2 ELSE 3 END AS part
  FROM ad
),
kept1 AS (SELECT * FROM part WHERE part = 1),
over1 AS (SELECT userid FROM kept1 {_OVER}),
kept2 AS (SELECT * FROM part WHERE part = 2 AND userid NOT IN (SELECT userid FROM over1)),
over2 AS (SELECT userid FROM over1 UNION SELECT userid FROM kept2 {_OVER}),
kept3 AS (SELECT * FROM part WHERE part = 3 AND userid NOT IN (SELECT userid FROM over2)),
over3 AS (SELECT userid FROM over2 UNION SELECT userid FROM kept3 {_OVER}),
kept AS (SELECT * FROM kept1 UNION ALL SELECT * FROM kept2 UNION ALL SELECT * FROM kept3)"""
_AD_FIELDS = "ts_ms, province, city, userid, adid"
_AD_MINUTE = (
    "SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, adid, "
    "count(*) AS click_count FROM ad"
)


def _top3(source: str, where: str = "TRUE") -> str:
    return f"""
SELECT date, province, adid, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) AS rn
  FROM (SELECT date, province, adid, count(*) AS click_count FROM {source} WHERE {where}
        GROUP BY date, province, adid))
WHERE rn <= 3"""


_LOG = """
req AS (
  SELECT strftime(ts, '%Y%m%d%H%M%S') AS time, strftime(ts, '%Y%m%d') AS day,
         '10.0.' || (user_id % 250) || '.' || (event_id % 250) AS ip,
         CAST(CASE event_id % 8 WHEN 0 THEN 112 WHEN 1 THEN 128 WHEN 2 THEN 145 WHEN 3 THEN 146
              WHEN 4 THEN 131 WHEN 5 THEN 130 END AS INTEGER) AS course_id,
         CAST(CASE event_id % 3 WHEN 0 THEN 200 WHEN 1 THEN 404 ELSE 500 END AS INTEGER)
           AS status_code,
         CASE WHEN user_id % 5 <> 0 THEN '-' ELSE
           CASE (event_id // 8) % 6
             WHEN 0 THEN 'https://www.baidu.com/s?wd=Spark SQL Action'
             WHEN 1 THEN 'https://www.sogou.com/web?query=Hadoop Framework'
             WHEN 2 THEN 'https://cn.bing.com/search?q=Storm Action'
             WHEN 3 THEN 'https://search.yahoo.com/search?p=Spark Streaming Action'
             WHEN 4 THEN 'https://cn.bing.com/' ELSE 'https://cn.bing.com' END END AS referer,
         CASE WHEN user_id % 5 = 0 THEN
           CASE (event_id // 8) % 6 WHEN 0 THEN 'www.baidu.com' WHEN 1 THEN 'www.sogou.com'
             WHEN 2 THEN 'cn.bing.com' WHEN 3 THEN 'search.yahoo.com' END END AS host
  FROM events WHERE event_id % 8 < 6 AND event_id % 89 NOT IN (2, 3, 4)
)"""

# Courses.
_LOG_CTES = f"""WITH {_LOG},
course(course_id, name) AS (VALUES
  (112, 'spark in action'), (128, 'spark streaming'), (145, 'Hbase in action'),
  (146, 'machine learning'), (131, 'spark'), (130, 'deep learning')),
daily AS (SELECT day, course_id, count(*) AS click_count FROM req GROUP BY day, course_id),
searches AS (
  SELECT day, host, course_id, count(*) AS click_count
  FROM req WHERE host IS NOT NULL GROUP BY day, host, course_id
)"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "action_range_scan":
            f"WITH {_UVA} SELECT * EXCLUDE (t) FROM uva WHERE date BETWEEN '2024-01-06' AND '2024-01-20'",
        "area_click_scan":
            f"WITH {_UVA} SELECT city_id, click_product_id FROM uva "
            "WHERE date BETWEEN '2024-01-06' AND '2024-01-20' AND click_product_id <> -1",
        "session_aggregate": f"{_SESSION_CTES} SELECT {_SESSION_COLUMNS} FROM info",
        "session_full_info":
            f"{_SESSION_CTES} SELECT {_SESSION_COLUMNS}, age, professional, sex, city FROM fullinfo",
        "session_filter":
            f"{_SESSION_CTES} SELECT {_SESSION_COLUMNS}, age, professional, sex, city "
            "FROM adults WHERE wanted",
        "filtered_actions":
            f"{_SESSION_CTES} SELECT uva.* EXCLUDE (t) FROM uva "
            "JOIN (SELECT session_id AS sid FROM adults WHERE wanted) "
            "ON session_id IS NOT DISTINCT FROM sid",
        "session_filter_all":
            f"{_SESSION_CTES} SELECT {_SESSION_COLUMNS}, age, professional, sex, city "
            "FROM fullinfo WHERE picked AND age BETWEEN 10 AND 55 AND sex = 'male' "
            "AND CAST(substr(professional, 13) AS INT) < 80 AND CAST(substr(city, 5) AS INT) < 20",
        "session_values":
            f"{_SESSION_CTES} SELECT session_id, 'keyword' AS kind, search_keyword AS value, "
            "count(*) AS n FROM uva WHERE search_keyword IS NOT NULL GROUP BY ALL UNION ALL "
            "SELECT session_id, 'category', CAST(click_category_id AS VARCHAR), count(*) FROM uva "
            "WHERE click_category_id <> -1 GROUP BY ALL",
        "category_id_counts":
            f"""WITH {_UVA}, ids AS (
                  SELECT unnest(string_split(order_category_ids, ',')) AS id FROM uva
                  UNION ALL SELECT unnest(string_split(pay_category_ids, ',')) FROM uva)
                SELECT count(*) AS ids, count(*) FILTER (WHERE id = 'x') AS malformed FROM ids""",
        "visit_length_histogram": _histogram(_VISIT, "visit_length"),
        "step_length_histogram": _histogram(_STEP, "step_length"),
        "session_ratio": _ratio(),
        "session_hour_count":
            f"{_SESSION_CTES} SELECT strftime(t0, '%Y-%m-%d') AS date, "
            "CAST(hour(t0) AS INTEGER) AS hour, count(*) AS hour_count FROM adults "
            "WHERE t0 IS NOT NULL GROUP BY 1, 2",
        "extract_quota": _extract(_SESSION_CTES, 900) + " SELECT * FROM quotas",
        "session_random_extract": _extract(_SESSION_CTES, 900) + _DRAW,
        "session_random_extract_three_days":
            _extract(
                f"WITH {_UVA.replace('uva AS', 'uva_all AS')}, uva AS (SELECT * FROM uva_all "
                f"WHERE date BETWEEN '2024-01-06' AND '2024-01-08'),{_UI},{_SESSION}", 100
            ) + _DRAW,
        "category_candidates": f"{_CATEGORY} SELECT DISTINCT category_id FROM hits",
        "category_full_count": f"{_CATEGORY} SELECT * FROM full_count",
        "top10_categories":
            f"""{_CATEGORY} SELECT 'task-1' AS taskid, category_id AS categoryid,
                click_count AS "clickCount", order_count AS "orderCount", pay_count AS "payCount"
                FROM top10""",
        "session_category_clicks": f"{_CATEGORY} SELECT * FROM session_clicks",
        "top10_sessions":
            f"""{_CATEGORY} SELECT 'task-1' AS taskid, category_id AS categoryid,
                session_id AS sessionid, click_count AS "clickCount"
                FROM (SELECT *, row_number() OVER (PARTITION BY category_id
                      ORDER BY click_count DESC, session_id NULLS FIRST) AS rn FROM session_clicks)
                WHERE rn <= 10""",
        "page_pairs":
            f"{_flow_ctes('DESC')} SELECT *, page_id || '_' || next_page_id AS pair "
            "FROM following WHERE next_page_id IS NOT NULL",
        "page_pair_count": f"{_flow_ctes('DESC')} SELECT * FROM counted",
        "page_convert_rate": f"{_flow_ctes('DESC')} SELECT * FROM rated",
        "page_convert_rate_forward": f"{_flow_ctes('ASC')} SELECT * FROM rated",
        "page_convert_string":
            f"""{_flow_ctes('DESC')} SELECT 'task-1' AS taskid,
                string_agg(pair || '=' || CAST(CAST(round(rate, 4) AS DECIMAL(20, 4)) AS VARCHAR),
                           '|' ORDER BY step) AS "convertRate" FROM rated""",
        "area_click_detail": f"{_AREA} SELECT * FROM detail",
        "area_product_clicks": f"{_AREA} SELECT * FROM products",
        "area_top3_products":
            f"""{_AREA} SELECT area, pid, click_count, city_infos FROM (
                SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) AS rn
                FROM products) WHERE rn <= 3""",
        "group_concat_distinct":
            f"{_AREA} SELECT area, string_agg(DISTINCT city_id || ':' || city_name, ',' "
            "ORDER BY city_id || ':' || city_name) AS city_infos FROM detail GROUP BY area",
        "ad_log_parse": f"{_AD_CTES} SELECT {_AD_FIELDS} FROM ad",
        "ad_line_counts":
            "SELECT count(*) AS lines, count(*) FILTER (WHERE event_id % 97 IN (5, 6, 7)) "
            "AS malformed FROM events",
        "ad_user_daily_clicks": f"{_AD_CTES} SELECT * FROM user_clicks",
        "ad_user_click_lookup":
            f"""{_AD_CTES}, requests AS (
                SELECT DISTINCT strftime(ts, '%Y%m%d') AS date,
                  CASE WHEN event_id % 2 = 0 THEN 7 ELSE user_id % 100 END AS userid,
                  event_id % 25 AS adid FROM events)
                SELECT date, userid, adid, coalesce(click_count, 0) AS click_count
                FROM requests LEFT JOIN user_clicks USING (date, userid, adid)""",
        "ad_blacklist_users":
            f"{_AD_CTES} SELECT DISTINCT userid FROM user_clicks WHERE click_count > 100",
        "ad_blacklist_filter":
            f"{_AD_CTES} SELECT {_AD_FIELDS} FROM ad WHERE userid NOT IN "
            "(SELECT userid FROM user_clicks WHERE click_count > 100)",
        "ad_blacklist_replay":
            f"""WITH {_AD},
                numbered AS (
                  SELECT *, date_trunc('hour', ts) AS h,
                    count(*) OVER (PARTITION BY date, userid, adid ORDER BY date_trunc('hour', ts)
                                   RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
                  FROM ad),
                blocked AS (
                  SELECT userid, min(h) AS h0 FROM numbered WHERE running > 100 GROUP BY userid)
                SELECT {_AD_FIELDS} FROM numbered n WHERE NOT EXISTS (
                  SELECT 1 FROM blocked b WHERE b.userid = n.userid AND n.h > b.h0)""",
        "ad_province_city_clicks": f"{_AD_CTES} SELECT * FROM city_clicks",
        "ad_province_clicks":
            f"{_AD_CTES} SELECT date, province, adid, count(*) AS click_count FROM ad "
            "GROUP BY date, province, adid",
        "ad_province_top3": f"{_AD_CTES} {_top3('ad')}",
        "ad_hour_trend":
            f"WITH {_AD} {_AD_MINUTE} WHERE date_trunc('minute', ts) > "
            "(SELECT date_trunc('minute', max(ts)) FROM ad) - INTERVAL 60 MINUTE "
            "GROUP BY 1, 2, 3, 4",
        "ad_sliding_hour":
            f"""WITH {_AD}, slots AS (
                  SELECT date_trunc('minute', ts) AS m, adid, count(*) AS n FROM ad GROUP BY 1, 2)
                SELECT strftime(m - to_minutes(k), '%Y-%m-%d %H:%M') AS window_start, adid,
                       CAST(sum(n) AS BIGINT) AS click_count
                FROM slots, unnest(range(60)) AS offsets(k) GROUP BY 1, 2""",
        "upsert_add":
            f"""WITH {_AD}, writes AS (
                  SELECT date, userid, adid FROM ad WHERE ts < '2024-01-16'
                  UNION ALL SELECT date, userid, adid FROM ad WHERE ts >= '2024-01-10')
                SELECT date, userid, adid, count(*) AS click_count FROM writes GROUP BY 1, 2, 3""",
        "upsert_overwrite":
            f"""WITH {_AD},
                old AS (SELECT date, province, city, adid, count(*) AS click_count
                        FROM ad WHERE ts < '2024-01-16' GROUP BY 1, 2, 3, 4),
                new AS (SELECT date, province, city, adid, count(*) AS click_count
                        FROM ad WHERE ts >= '2024-01-10 12:00:00' GROUP BY 1, 2, 3, 4)
                SELECT * FROM new UNION ALL
                SELECT * FROM old ANTI JOIN new USING (date, province, city, adid)""",
        "replace_groups":
            f"""WITH {_AD}, old AS ({_top3('ad', "ts < '2024-01-16'")}),
                new AS ({_top3('ad', "ts >= '2024-01-10 12:00:00'")})
                SELECT * FROM new UNION ALL
                SELECT * FROM old WHERE (date, province) NOT IN (SELECT date, province FROM new)""",
        "insert_distinct":
            f"""WITH {_AD}
                SELECT userid FROM ad WHERE ts < '2024-01-16' GROUP BY date, userid, adid
                HAVING count(*) > 2
                UNION
                SELECT userid FROM ad WHERE ts >= '2024-01-10' GROUP BY date, userid, adid
                HAVING count(*) > 2""",
        "access_log_parse":
            f"{_LOG_CTES} SELECT ip, time, course_id, status_code, referer FROM req",
        "access_line_counts":
            "SELECT count(*) AS lines, count(*) FILTER (WHERE event_id % 89 IN (2, 3, 4)) "
            "AS malformed FROM events",
        "referer_host": f"{_LOG_CTES} SELECT time, course_id, host FROM req WHERE host IS NOT NULL",
        "course_daily_clicks": f"{_LOG_CTES} SELECT * FROM daily",
        "course_search_clicks": f"{_LOG_CTES} SELECT * FROM searches",
        "course_counter_lookup":
            f"""{_LOG_CTES}, requests AS (
                  SELECT DISTINCT strftime(ts, '%Y%m%d') AS day, 128 + event_id % 20 AS course_id
                  FROM events)
                SELECT r.day || '_' || r.course_id AS rowkey, coalesce(click_count, 0) AS click_count
                FROM requests r LEFT JOIN daily d ON d.day = r.day AND d.course_id = r.course_id""",
        "course_day_scan":
            f"{_LOG_CTES}, keyed AS (SELECT day || '_' || course_id AS rowkey, click_count FROM daily) "
            "SELECT * FROM keyed WHERE starts_with(rowkey, '20240105')",
        "course_day_report":
            f"{_LOG_CTES} SELECT d.course_id, name, click_count "
            "FROM daily d LEFT JOIN course c ON c.course_id = d.course_id WHERE day = '20240105'",
        "course_search_report":
            f"{_LOG_CTES} SELECT s.course_id, name, host, click_count "
            "FROM searches s LEFT JOIN course c ON c.course_id = s.course_id WHERE day = '20240105'",
        "course_day_share":
            f"""{_LOG_CTES}, total AS (
                  SELECT day, CAST(sum(click_count) AS BIGINT) AS t FROM daily GROUP BY day)
                SELECT d.day, d.course_id, name, click_count,
                       ((20000 * click_count + t) // (2 * t)) / 100.0 AS share
                FROM daily d JOIN total ON total.day = d.day
                LEFT JOIN course c ON c.course_id = d.course_id""",
    }
    for kind in ("click", "order", "pay"):
        sql[f"category_{kind}_count"] = (
            f"{_CATEGORY} SELECT category_id, count(*) AS {kind}_count FROM hits "
            f"WHERE kind = '{kind}' GROUP BY category_id"
        )
    # What the streams hold after their three micro-batches.
    sql["stream_ad_ingest"] = sql["ad_log_parse"]
    sql["stream_ad_province_city"] = (
        f"{_AD_REPLAY} SELECT date, province, city, adid, count(*) AS click_count "
        "FROM kept GROUP BY ALL"
    )
    sql["stream_ad_province_top3"] = f"{_AD_REPLAY} {_top3('kept')}"
    sql["stream_ad_user_clicks"] = (
        f"{_AD_REPLAY} SELECT date, userid, adid, count(*) AS click_count FROM kept GROUP BY ALL"
    )
    sql["stream_ad_blacklist"] = f"{_AD_REPLAY} SELECT userid FROM over3"
    minutes = (
        "SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, adid, "
        "count(*) AS click_count FROM kept"
    )
    sql["stream_ad_trend"] = f"{_AD_REPLAY} {minutes} GROUP BY ALL"
    sql["stream_ad_last_hour"] = (
        f"{_AD_REPLAY} {minutes} WHERE date_trunc('minute', ts) > "
        "(SELECT date_trunc('minute', max(ts)) FROM kept) - INTERVAL 60 MINUTE GROUP BY ALL"
    )
    sql["stream_course_daily"] = sql["course_daily_clicks"]
    sql["stream_course_search"] = sql["course_search_clicks"]
    return sql
