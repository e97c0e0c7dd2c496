"""SQL for DuckDB that gives the rows of plans.queries from the same tables, phrased on its own."""

from __future__ import annotations

from ..sources.events import EVENT_WINDOWS

_WINDOWS = ", ".join(f"('{w.dataset_split}', DATE '{w.history_start}', DATE '{w.history_end}', DATE '{w.label_date}', {w.days})" for w in EVENT_WINDOWS)

#: Common table expressions that queries build on, each with those it needs.
PARTS = {
    "raw": """raw AS (SELECT strftime(ts, '%Y-%m-%d %H') AS time, user_id + 1 AS user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS item_id,
  CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 + 1 AS category_id,
  CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 WHEN 'error' THEN 9 END AS bt,
  date_trunc('hour', ts) AS event_time, event_id AS source_order FROM events)""",
    "clean": """clean AS (SELECT time, user_id, item_id, category_id, CAST(bt AS INT) AS behavior_type, CASE bt WHEN 1 THEN 'pv' WHEN 2 THEN 'fav' WHEN 3 THEN 'cart' WHEN 4 THEN 'buy' END AS behavior_name,
  strftime(event_time, '%Y-%m-%d') AS behavior_date, CAST(hour(event_time) AS INT) AS behavior_hour, CAST(isodow(event_time) - 1 AS INT) AS weekday, event_time, source_order FROM raw WHERE bt <= 4)""",
    "win": f"win(dataset_split, history_start, history_end, label_date, window_days) AS (VALUES {_WINDOWS})",
    "hist": "hist AS (SELECT c.*, w.*, CAST(c.event_time AS DATE) AS day FROM clean c, win w WHERE CAST(c.event_time AS DATE) BETWEEN w.history_start AND w.history_end)",
    "ub": "ub AS (SELECT dataset_split, user_id, any_value(history_start) AS history_start, any_value(history_end) AS history_end, any_value(label_date) AS label_date, count(*) AS event_count, {four} FROM hist GROUP BY 1, 2)",
    "ua0": """ua0 AS (SELECT dataset_split, user_id, any_value(history_start) AS history_start, any_value(history_end) AS history_end, any_value(label_date) AS label_date, CAST(any_value(window_days) AS BIGINT) AS wd,
  count(*) AS n, count(DISTINCT day) AS days, max(event_time) AS last, count(DISTINCT item_id) AS items, count(DISTINCT category_id) AS cats, {four} FROM hist GROUP BY 1, 2)""",
    "ua1": """ua1 AS (SELECT dataset_split, user_id, history_start, history_end, label_date, wd AS window_days, n AS event_count, days AS active_day_count, round_even(days / wd, 4) AS active_day_ratio,
  round_even(n / wd, 4) AS avg_daily_event_count, round_even(n / days, 4) AS avg_active_day_event_count, round_even(date_diff('second', last, CAST(label_date AS TIMESTAMP)) / 86400.0, 4) AS days_since_last_event,
  items AS unique_item_count, cats AS unique_category_count, round_even(pv_count / wd, 4) AS pv_count_per_day, round_even(fav_count / wd, 4) AS fav_count_per_day, round_even(cart_count / wd, 4) AS cart_count_per_day,
  round_even(buy_count / wd, 4) AS buy_count_per_day FROM ua0)""",
    "ua": """ua AS (SELECT ua1.*, CASE WHEN avg_daily_event_count <= q[1] THEN 'low' WHEN avg_daily_event_count <= q[2] THEN 'medium' ELSE 'high' END AS activity_level
  FROM ua1, (SELECT quantile_cont(avg_daily_event_count, [0.25, 0.75]) AS q FROM ua1 WHERE dataset_split = 'train'))""",
    "us": """us AS (SELECT dataset_split, user_id, item_id, min(category_id) AS category_id, any_value(history_start) AS history_start, any_value(history_end) AS history_end, any_value(label_date) AS label_date,
  list(behavior_name ORDER BY event_time, source_order) AS l, max(event_time) AS last FROM hist GROUP BY 1, 2, 3)""",
    "seq": """seq AS (SELECT dataset_split, user_id, item_id, category_id, history_start, history_end, label_date, l[-1] AS last_behavior_type, CAST(hour(last) AS INT) AS last_behavior_hour,
  round_even(date_diff('second', last, CAST(label_date AS TIMESTAMP)) / 86400.0, 4) AS last_behavior_days_ago, array_to_string(l[-10:], '→') AS last_10_behavior_sequence FROM us)""",
    "ib": """ib AS (SELECT dataset_split, item_id, any_value(history_start) AS history_start, any_value(history_end) AS history_end, any_value(label_date) AS label_date, min(category_id) AS category_id, count(*) AS item_total_count,
  {item_four}, count(DISTINCT user_id) AS item_unique_user_count, count(DISTINCT user_id) FILTER (WHERE behavior_name = 'buy') AS item_unique_buyer_count, count(DISTINCT day) AS item_active_day_count FROM hist GROUP BY 1, 2)""",
    "ip": """ip AS (SELECT dataset_split, item_id, category_id, history_start, history_end, label_date, item_total_count, item_pv_count, item_fav_count, item_cart_count, item_buy_count, item_unique_user_count, item_active_day_count,
  {ranks} FROM ib)""",
    "cc": """cc AS (SELECT dataset_split, item_id, category_id, history_start, history_end, label_date, item_pv_count, item_fav_count, item_cart_count, item_buy_count,
  item_buy_count / nullif(item_pv_count, 0) AS buy_per_pv, item_buy_count / nullif(item_fav_count, 0) AS buy_per_fav, item_buy_count / nullif(item_cart_count, 0) AS buy_per_cart FROM ib)""",
    "cb": """cb AS (SELECT dataset_split, category_id, any_value(history_start) AS history_start, any_value(history_end) AS history_end, any_value(label_date) AS label_date, count(*) AS category_total_count,
  count(DISTINCT user_id) AS category_unique_user_count, count(DISTINCT item_id) AS category_unique_item_count, count(DISTINCT day) AS category_active_day_count, min(event_time) AS category_first_event_time,
  max(event_time) AS category_last_event_time, {category_four} FROM hist GROUP BY 1, 2)""",
    "tb": """tb AS (SELECT dataset_split, behavior_date, behavior_hour, any_value(history_start) AS history_start, any_value(history_end) AS history_end, any_value(label_date) AS label_date, min(weekday) AS weekday, count(*) AS time_total_count,
  count(DISTINCT user_id) AS time_unique_user_count, count(DISTINCT item_id) AS time_unique_item_count, count(DISTINCT category_id) AS time_unique_category_count, {time_four} FROM hist GROUP BY 1, 2, 3)""",
    "wide": """wide AS (SELECT s.dataset_split, s.user_id, s.item_id, s.category_id, s.history_start, s.history_end, s.label_date, CAST(s.label_date - CAST(ceil(s.last_behavior_days_ago) AS INT) AS DATE) AS last_behavior_date,
  s.last_behavior_type, s.last_behavior_hour, s.last_behavior_days_ago, s.last_10_behavior_sequence, {user_columns}, {item_columns}, {rank_columns}, cc.buy_per_pv, cc.buy_per_fav, cc.buy_per_cart,
  cb.category_active_day_count, cb.category_buy_count, cb.category_cart_count, cb.category_fav_count, cb.category_first_event_time, cb.category_last_event_time, cb.category_pv_count, cb.category_total_count,
  cb.category_unique_item_count, cb.category_unique_user_count, tb.time_buy_count, tb.time_cart_count, tb.time_fav_count, tb.time_pv_count, tb.time_total_count, tb.time_unique_category_count,
  tb.time_unique_item_count, tb.time_unique_user_count, tb.weekday AS time_weekday
  FROM seq s LEFT JOIN ub ON ub.dataset_split = s.dataset_split AND ub.user_id = s.user_id LEFT JOIN ua ON ua.dataset_split = s.dataset_split AND ua.user_id = s.user_id
  LEFT JOIN ib ON ib.dataset_split = s.dataset_split AND ib.item_id = s.item_id LEFT JOIN ip ON ip.dataset_split = s.dataset_split AND ip.item_id = s.item_id
  LEFT JOIN cc ON cc.dataset_split = s.dataset_split AND cc.item_id = s.item_id LEFT JOIN cb ON cb.dataset_split = s.dataset_split AND cb.category_id = s.category_id
  LEFT JOIN tb ON tb.dataset_split = s.dataset_split AND tb.behavior_hour = s.last_behavior_hour AND CAST(tb.behavior_date AS DATE) = s.label_date - CAST(ceil(s.last_behavior_days_ago) AS INT))""",
    "lab": """lab AS (SELECT w.*, CASE WHEN EXISTS (SELECT 1 FROM clean c WHERE c.behavior_type = 4 AND c.user_id = w.user_id AND c.item_id = w.item_id AND CAST(c.event_time AS DATE) = w.label_date) THEN 1 ELSE 0 END AS label FROM wide w)""",
    "train": "train AS (SELECT * FROM lab WHERE dataset_split = 'train')",
    "sc": "sc AS (SELECT user_id, item_id, user_event_count, item_total_count, label, CAST((user_event_count * 7 + item_total_count * 3 + user_id + item_id * 5) % 97 AS DOUBLE) / 97.0 AS score FROM train)",
    "g": "g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY score)",
    "cu": "cu AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g)",
    "grid": "grid AS (SELECT CAST(round(i * 0.05, 2) AS DOUBLE) AS threshold FROM range(1, 20) t(i))",
    "tg": "tg AS (SELECT threshold, count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp, count(*) FILTER (WHERE score >= threshold AND label = 0) AS fp, count(*) FILTER (WHERE score < threshold AND label = 1) AS fn, count(*) FILTER (WHERE score < threshold AND label = 0) AS tn FROM grid, sc GROUP BY threshold)",
}
_NAMES = ("pv", "fav", "cart", "buy")
_four = lambda prefix: ", ".join(f"count(*) FILTER (WHERE behavior_name = '{n}') AS {prefix}{n}_count" for n in _NAMES)
_RANKED = ("item_total_count", "item_unique_user_count", "item_active_day_count", "item_buy_count")
_USER_BASIC = ("event_count", "pv_count", "fav_count", "cart_count", "buy_count")
_USER_ACTIVITY = ("window_days", "active_day_count", "active_day_ratio", "avg_daily_event_count", "avg_active_day_event_count", "days_since_last_event", "unique_item_count", "unique_category_count", "pv_count_per_day", "fav_count_per_day", "cart_count_per_day", "buy_count_per_day", "activity_level")
_ITEM = ("item_total_count", "item_pv_count", "item_fav_count", "item_cart_count", "item_buy_count", "item_unique_user_count", "item_unique_buyer_count", "item_active_day_count")
_FILL = {
    "four": _four(""),
    "item_four": _four("item_"),
    "category_four": _four("category_"),
    "time_four": _four("time_"),
    "ranks": ", ".join(f"dense_rank() OVER (PARTITION BY dataset_split ORDER BY {c} DESC) AS {c}_rank" for c in _RANKED),
    "user_columns": ", ".join([f"ub.{c} AS user_{c}" for c in _USER_BASIC] + [f"ua.{c} AS user_{c}" for c in _USER_ACTIVITY]),
    "item_columns": ", ".join(f"ib.{c}" for c in _ITEM),
    "rank_columns": ", ".join(f"ip.{c}_rank" for c in _RANKED),
}
_NEEDS = {
    "raw": "", "clean": "raw", "win": "", "hist": "clean win", "ub": "hist", "ua0": "hist", "ua1": "ua0", "ua": "ua1", "us": "hist", "seq": "us", "ib": "hist", "ip": "ib", "cc": "ib", "cb": "hist", "tb": "hist",
    "wide": "seq ub ua ib ip cc cb tb", "lab": "wide clean", "train": "lab", "sc": "train", "g": "sc", "cu": "g", "grid": "", "tg": "grid sc",
}


def sql(needs: str, body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for x in _NEEDS[name].split():
                add(x)
            order.append(name)

    for name in needs.split():
        add(name)
    parts = []
    for name in order:
        text = PARTS[name]
        for key, value in _FILL.items():
            text = text.replace("{" + key + "}", value)
        parts.append(text)
    return f"WITH {', '.join(parts)} {body}"


_RATES = ", ".join(
    f"round(coalesce({a} / nullif({b}, 0), 0.0), 6) AS {n}"
    for n, a, b in (('"precision"', "tp", "tp + fp"), ("recall", "tp", "tp + fn"), ("f1", "2 * tp", "2 * tp + fp + fn"), ("accuracy", "(tp + tn)", "tp + fp + fn + tn"))
)
_CELLS = "count(*) FILTER (WHERE score >= {t} AND label = 1) AS tp, count(*) FILTER (WHERE score >= {t} AND label = 0) AS fp, count(*) FILTER (WHERE score < {t} AND label = 1) AS fn, count(*) FILTER (WHERE score < {t} AND label = 0) AS tn"


def _bands(source: str, value: str, tie: str, labels: bool) -> str:
    """Rows of source with band: equal steps between first and last place; labels: high first."""
    low_first = "CASE q WHEN 1 THEN ['All'] WHEN 2 THEN ['Low', 'High'] WHEN 3 THEN ['Low', 'Medium', 'High'] WHEN 4 THEN ['Very Low', 'Low', 'High', 'Very High'] ELSE ['Very Low', 'Low', 'Medium', 'High', 'Very High'] END"
    names = f"list_reverse({low_first})" if labels else low_first
    return f"""(SELECT *, ({names})[CAST(greatest(ceil((k - 1) * q / greatest(c - 1, 1)), 1) AS INT)] AS band FROM (SELECT *, row_number() OVER (ORDER BY {value}, {tie}) AS k, count(*) OVER () AS c,
  least(5, (SELECT count(DISTINCT {value}) FROM {source} WHERE dataset_split = 'train'), count(*) OVER ()) AS q FROM {source} WHERE dataset_split = 'train'))"""


_WINDOW_COLUMNS = "any_value(history_start) AS history_start, any_value(history_end) AS history_end, any_value(label_date) AS label_date"
_NUMERIC = ("user_event_count", "user_active_day_ratio", "user_unique_item_count", "item_total_count", "item_buy_count", "item_total_count_rank", "buy_per_pv", "category_total_count", "time_total_count", "last_behavior_days_ago", "user_window_days")
_stat = lambda c: f"SELECT '{c}' AS feature, count(*) - count({c}) AS missing_count, CAST(0 AS BIGINT) AS nonfinite_count, count(*) FILTER (WHERE abs({c}) > 5) AS outlier_count, round(avg({c}), 6) AS mean, round(var_pop({c}), 6) AS variance, count(*) AS rows FROM train"
_moment = lambda c: f"SELECT '{c}' AS feature, count({c}) AS valid, round(avg({c}), 6) AS mean, round(sqrt(var_pop({c}) * count({c}) / count(*)), 6) AS scale FROM train"
_pairs = [(a, b) for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i + 1 :]]
_corr = lambda a, b: f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(CASE WHEN corr({a}, {b}) IS NULL OR isnan(corr({a}, {b})) THEN 0 ELSE corr({a}, {b}) END, 5) AS r FROM train"
_code = lambda c: f"coalesce((SELECT count(*) FROM (SELECT DISTINCT {c} AS v FROM train) WHERE v < l.{c}), 0)"
_scaled = lambda c: f"round(CAST(CAST((coalesce(CAST(l.{c} AS DOUBLE), m.{c}_mean) - m.{c}_mean) / CASE WHEN m.{c}_scale > 0 THEN m.{c}_scale ELSE 1 END AS FLOAT) AS DOUBLE), 3) AS {c}"

def _roles() -> str:
    """Key and tracking fields, and the label, are prohibited as inputs; every other column is a candidate."""
    key, tracking = ["dataset_split", "user_id", "item_id"], ["category_id", "history_start", "history_end", "label_date", "last_behavior_date"]
    others = ["last_behavior_type", "last_behavior_hour", "last_behavior_days_ago", "last_10_behavior_sequence", *(f"user_{c}" for c in (*_USER_BASIC, *_USER_ACTIVITY)), *_ITEM, *(f"{c}_rank" for c in _RANKED), "buy_per_pv", "buy_per_fav", "buy_per_cart"]
    others += [f"category_{c}" for c in ("active_day_count", "buy_count", "cart_count", "fav_count", "first_event_time", "last_event_time", "pv_count", "total_count", "unique_item_count", "unique_user_count")]
    others += [f"time_{c}" for c in ("buy_count", "cart_count", "fav_count", "pv_count", "total_count", "unique_category_count", "unique_item_count", "unique_user_count", "weekday")]
    rows = [("primary_key", c) for c in key] + [("tracking", c) for c in tracking] + [("candidate", c) for c in others] + [("prohibited", c) for c in [*key, *tracking, "label"]]
    return f"SELECT * FROM (VALUES {', '.join(f"('{r}', '{c}')" for r, c in rows)}) t(role, field)"


ORACLES = {
    "v2_contract_violations": sql("raw", "SELECT CAST(0 AS BIGINT) AS bad_time, count(*) FILTER (WHERE bt NOT IN (1, 2, 3, 4)) AS bad_behavior_type, count(*) FILTER (WHERE user_id <= 0) AS bad_user_id, count(*) FILTER (WHERE item_id <= 0) AS bad_item_id, count(*) FILTER (WHERE category_id <= 0) AS bad_item_category FROM raw"),
    "v7_items_of_several_categories": sql("hist", "SELECT c AS categories, count(*) AS items FROM (SELECT count(DISTINCT category_id) AS c FROM hist GROUP BY dataset_split, item_id) GROUP BY c"),
    "v9_duplicate_keys": sql("clean", "SELECT user_id, item_id, behavior_date, count(*) AS rows FROM clean GROUP BY ALL HAVING count(*) > 1"),
    "v16_field_roles": _roles(),
    "d22_broken_rows": sql("wide", "SELECT * FROM (SELECT unnest([{'rule': 'negative_item_total_count', 'rows': count(*) FILTER (WHERE user_id % 10 = 3)}, {'rule': 'hour_range', 'rows': count(*) FILTER (WHERE item_id % 11 = 0)}, {'rule': 'infinite_buy_per_pv', 'rows': count(*) FILTER (WHERE user_id % 7 = 0)}, {'rule': 'active_ratio_range', 'rows': count(*) FILTER (WHERE user_id % 13 = 0)}, {'rule': 'bad_last_behavior_type', 'rows': count(*) FILTER (WHERE item_id % 17 = 0)}, {'rule': 'sequence_tail', 'rows': count(*) FILTER (WHERE item_id % 17 = 0)}, {'rule': 'not_positive_item_buy_count_rank', 'rows': count(*) FILTER (WHERE item_id % 19 = 0)}], recursive := true) FROM wide) WHERE rows > 0"),
    "d1_clean_rows": sql("clean", "SELECT time, user_id, item_id, category_id, behavior_type, behavior_name, behavior_date, behavior_hour, weekday FROM clean"),
    "d1_rejected_counts": sql("raw", "SELECT count(*) AS input_rows, CAST(0 AS BIGINT) AS removed_missing_rows, CAST(0 AS BIGINT) AS removed_invalid_id_rows, count(*) FILTER (WHERE bt = 9) AS removed_invalid_behavior_rows, CAST(0 AS BIGINT) AS removed_invalid_time_rows, count(*) FILTER (WHERE bt <> 9) AS kept_rows FROM raw"),
    "d2_clean_log": sql("clean", "SELECT time, user_id, item_id, category_id, behavior_type, behavior_name, behavior_date, behavior_hour, weekday, source_order FROM clean QUALIFY count(*) OVER (PARTITION BY behavior_date, user_id, behavior_type) < 3 OR row_number() OVER (PARTITION BY behavior_date, user_id, behavior_type ORDER BY source_order) = 1"),
    "d2_repeat_report": sql("clean", "SELECT count(*) FILTER (WHERE n = 2) AS normal_frequency_groups, CAST(coalesce(sum(n) FILTER (WHERE n = 2), 0) AS BIGINT) AS normal_frequency_records, count(*) FILTER (WHERE n >= 3) AS high_frequency_groups, CAST(coalesce(sum(n) FILTER (WHERE n >= 3), 0) AS BIGINT) AS high_frequency_records, CAST(coalesce(sum(n - 1) FILTER (WHERE n >= 3), 0) AS BIGINT) AS removed_rows FROM (SELECT count(*) AS n FROM clean GROUP BY behavior_date, user_id, behavior_type)"),
    "d3_quality_report": sql("raw", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS rows_with_any_missing, " + ", ".join(f"CAST(0 AS BIGINT) AS missing_{c}" for c in ("time", "user_id", "item_id", "item_category", "behavior_type")) + ", " + ", ".join(f"CAST(0 AS BIGINT) AS invalid_{c}" for c in ("time", "user_id", "item_id", "item_category")) + ", count(*) FILTER (WHERE bt = 9) AS invalid_behavior_type, count(DISTINCT user_id) AS unique_user_id, count(DISTINCT item_id) AS unique_item_id, count(DISTINCT category_id) AS unique_item_category, " + ", ".join(f"count(*) FILTER (WHERE bt = {k}) AS behavior_{k}_count" for k in range(1, 5)) + ", min(time) AS valid_time_min, max(time) AS valid_time_max, any_value(e.g) AS exact_groups, CAST(any_value(e.r) AS BIGINT) AS exact_records, CAST(any_value(e.r - e.g) AS BIGINT) AS exact_excess, any_value(s.g) AS suspected_groups, CAST(any_value(s.r) AS BIGINT) AS suspected_records, CAST(any_value(s.r - s.g) AS BIGINT) AS suspected_excess, CASE WHEN count(*) FILTER (WHERE bt = 9) + any_value(e.r) = 0 THEN 'PASS' ELSE 'REVIEW' END AS status FROM raw, (SELECT count(*) AS g, coalesce(sum(n), 0) AS r FROM (SELECT count(*) AS n FROM raw GROUP BY time, user_id, item_id, category_id, bt) WHERE n > 1) e, (SELECT count(*) AS g, coalesce(sum(n), 0) AS r FROM (SELECT count(*) AS n FROM raw GROUP BY time, user_id, item_id, bt) WHERE n > 1) s"),
    "p4_history_rows": sql("hist", "SELECT dataset_split, history_start, history_end, label_date, count(*) AS rows, min(day) AS first_day, max(day) AS last_day FROM hist GROUP BY ALL"),
    "d4_user_intermediate": sql("hist", f"SELECT dataset_split, user_id, {_WINDOW_COLUMNS}, count(*) AS event_count, count(DISTINCT item_id) AS unique_item_count, count(DISTINCT category_id) AS unique_category_count, count(DISTINCT day) AS active_day_count, min(event_time) AS first_event_time, max(event_time) AS last_event_time, {_four('')} FROM hist GROUP BY 1, 2"),
    "d5_item_intermediate": sql("hist", f"SELECT dataset_split, item_id, {_WINDOW_COLUMNS}, min(category_id) AS category_id, count(*) AS event_count, count(DISTINCT user_id) AS unique_user_count, count(DISTINCT day) AS active_day_count, min(event_time) AS first_event_time, max(event_time) AS last_event_time, {_four('')} FROM hist GROUP BY 1, 2"),
    "d6_category_intermediate": sql("hist", f"SELECT dataset_split, category_id, {_WINDOW_COLUMNS}, count(*) AS event_count, count(DISTINCT user_id) AS unique_user_count, count(DISTINCT item_id) AS unique_item_count, count(DISTINCT day) AS active_day_count, {_four('')} FROM hist GROUP BY 1, 2"),
    "d7_time_intermediate": sql("hist", f"SELECT dataset_split, behavior_date, behavior_hour, {_WINDOW_COLUMNS}, min(weekday) AS weekday, count(*) AS event_count, count(DISTINCT user_id) AS unique_user_count, count(DISTINCT item_id) AS unique_item_count, {_four('')} FROM hist GROUP BY 1, 2, 3"),
    "d9_user_basic": sql("ub", "SELECT * FROM ub"),
    "d11_user_activity": sql("ua", "SELECT * FROM ua"),
    "d12_user_sequence": sql("seq", "SELECT * FROM seq"),
    "d13_item_behavior": sql("ib", "SELECT * FROM ib"),
    "d14_item_popularity": sql("ip", "SELECT * FROM ip"),
    "d15_category_behavior": sql("cb", "SELECT * FROM cb"),
    "d16_time_behavior": sql("tb", "SELECT * FROM tb"),
    "d17_conversion_chain": sql("cc", "SELECT * FROM cc"),
    "d18_window_metadata": sql("win", "SELECT dataset_split, history_start, history_end, label_date, CAST(window_days AS INT) AS window_days FROM win"),
    "d21_wide_table": sql("wide", "SELECT * FROM wide"),
    "d22_wide_quality": sql("wide", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS broken_rules, CAST(0 AS BIGINT) AS unexpected_nulls, count(*) - count(buy_per_pv) AS null_buy_per_pv, count(*) - count(buy_per_fav) AS null_buy_per_fav, count(*) - count(buy_per_cart) AS null_buy_per_cart FROM wide"),
    "e1_behavior_distribution": sql("clean", "SELECT CAST(b.k AS INT) AS behavior_type, b.n AS behavior_name, count(c.user_id) AS behavior_count, round_even(100 * count(c.user_id) / (SELECT count(*) FROM clean), 2) AS percentage FROM (VALUES (1, 'pv'), (2, 'fav'), (3, 'cart'), (4, 'buy')) b(k, n) LEFT JOIN clean c ON c.behavior_name = b.n GROUP BY 1, 2"),
    "e2_user_purchase_summary": sql("clean", "SELECT CAST(sum(n) AS BIGINT) AS total_behavior_count, CAST(sum(b) AS BIGINT) AS purchase_count, count(*) FILTER (WHERE b > 0) AS purchase_users, count(*) FILTER (WHERE b = 0) AS non_purchase_users, count(*) FILTER (WHERE b >= 2) AS repeat_purchase_users FROM (SELECT count(*) AS n, count(*) FILTER (WHERE behavior_name = 'buy') AS b FROM clean GROUP BY user_id)"),
    "e3_item_statistics": sql("clean", f"SELECT item_id, {_four('')} FROM clean GROUP BY 1"),
    "e4_top_items": sql("clean", f"SELECT item_id, {_four('')} FROM clean GROUP BY 1 ORDER BY buy_count DESC, item_id LIMIT 10"),
    "e5_category_statistics": sql("clean", "SELECT category_id, count(*) AS behavior_count, count(*) FILTER (WHERE behavior_name = 'buy') AS buy_count, round_even(100 * count(*) FILTER (WHERE behavior_name = 'buy') / (SELECT count(*) FROM clean WHERE behavior_name = 'buy'), 2) AS buy_percentage FROM clean GROUP BY 1"),
    "e6_top_categories": sql("clean", "SELECT category_id, count(*) AS behavior_count, count(*) FILTER (WHERE behavior_name = 'buy') AS buy_count, round_even(100 * count(*) FILTER (WHERE behavior_name = 'buy') / (SELECT count(*) FROM clean WHERE behavior_name = 'buy'), 2) AS buy_percentage FROM clean GROUP BY 1 ORDER BY buy_count DESC, category_id LIMIT 10"),
    "e7_daily_behavior": sql("clean", f"SELECT behavior_date, {_four('')} FROM clean GROUP BY 1"),
    "e8_hourly_behavior": sql("clean", f"SELECT behavior_hour, {_four('')} FROM clean GROUP BY 1"),
    "e9_descriptive_funnel": sql("clean", "SELECT s.stage, count(c.user_id) AS behavior_count, round_even(100 * count(c.user_id) / (SELECT count(*) FROM clean WHERE behavior_name = 'pv'), 2) AS relative_to_pv_percentage FROM (VALUES ('PV', 'pv'), ('Favorite', 'fav'), ('Cart', 'cart'), ('Purchase', 'buy')) s(stage, n) LEFT JOIN clean c ON c.behavior_name = s.n GROUP BY 1"),
    "p12_daily_long": sql("clean", "SELECT d.behavior_date, n.behavior_name, count(c.user_id) AS behavior_count FROM (SELECT DISTINCT behavior_date FROM clean) d CROSS JOIN (VALUES ('pv'), ('fav'), ('cart'), ('buy')) n(behavior_name) LEFT JOIN clean c ON c.behavior_date = d.behavior_date AND c.behavior_name = n.behavior_name GROUP BY 1, 2"),
    "b1_activity_summary": sql("ua", "SELECT activity_level, count(DISTINCT user_id) AS user_count, round(avg(avg_daily_event_count), 6) AS avg_daily_events, round(sum(pv_count_per_day), 6) AS pv_per_day, round(sum(buy_count_per_day), 6) AS buy_per_day, round(100 * sum(buy_count_per_day) / nullif(sum(pv_count_per_day), 0), 6) AS buy_to_pv_rate FROM ua WHERE dataset_split = 'train' GROUP BY 1"),
    "b2_depth_summary": sql("ua", f"SELECT band AS depth_band, count(DISTINCT user_id) AS user_count, round(avg(event_count), 6) AS avg_event_count, round(sum(pv_count_per_day), 6) AS pv_per_day, round(sum(buy_count_per_day), 6) AS buy_per_day, round(100 * sum(buy_count_per_day) / nullif(sum(pv_count_per_day), 0), 6) AS buy_to_pv_rate FROM {_bands('ua', 'event_count', 'user_id', False)} GROUP BY 1"),
    "b3_popularity_summary": sql("ip", f"SELECT band AS popularity_band, count(DISTINCT item_id) AS item_count, CAST(sum(item_total_count) AS BIGINT) AS total_events, CAST(sum(item_pv_count) AS BIGINT) AS pv_count, CAST(sum(item_buy_count) AS BIGINT) AS buy_count, round(100 * sum(item_buy_count) / nullif(sum(item_pv_count), 0), 6) AS buy_to_pv_rate FROM {_bands('ip', 'item_total_count_rank', 'item_id', True)} GROUP BY 1"),
    "b3_popular_items": sql("ip", "SELECT item_id, item_total_count_rank, item_total_count, item_pv_count, item_buy_count, round(100 * item_buy_count / nullif(item_pv_count, 0), 6) AS buy_to_pv_rate FROM ip WHERE dataset_split = 'train' ORDER BY item_total_count_rank, item_id LIMIT 10"),
    "b4_traffic_summary": sql("cb", f"SELECT band AS traffic_band, count(DISTINCT category_id) AS category_count, CAST(sum(category_total_count) AS BIGINT) AS total_events, CAST(sum(category_pv_count) AS BIGINT) AS pv_count, CAST(sum(category_buy_count) AS BIGINT) AS buy_count, round(100 * sum(category_buy_count) / nullif(sum(category_pv_count), 0), 6) AS buy_to_pv_rate FROM {_bands('cb', 'category_total_count', 'category_id', False)} GROUP BY 1"),
    "b5_conversion_funnel": sql("cc", "SELECT stage, CAST(n AS DOUBLE) AS behavior_count, round(100 * n / first_value(n) OVER (ORDER BY k), 6) AS relative_to_pv_percentage, round(CASE WHEN k = 1 THEN 100.0 ELSE 100 * n / lag(n) OVER (ORDER BY k) END, 6) AS from_previous_percentage FROM (SELECT unnest([1, 2, 3, 4]) AS k, unnest(['PV', 'Favorite', 'Cart', 'Purchase']) AS stage, unnest([sum(item_pv_count), sum(item_fav_count), sum(item_cart_count), sum(item_buy_count)]) AS n FROM cc WHERE dataset_split = 'train')"),
    "b6_transitions": sql("us", "SELECT f.b AS from_behavior, t.b AS to_behavior, count(x.n) AS transition_count, round(coalesce(100 * count(x.n) / nullif(sum(count(x.n)) OVER (PARTITION BY f.b), 0), 0.0), 6) AS transition_probability FROM (VALUES ('pv'), ('fav'), ('cart'), ('buy')) f(b) CROSS JOIN (VALUES ('pv'), ('fav'), ('cart'), ('buy')) t(b) LEFT JOIN (SELECT l[i] AS a, l[i + 1] AS n FROM (SELECT l, unnest(range(1, len(l))) AS i FROM (SELECT l[-10:] AS l FROM us WHERE dataset_split = 'train'))) x ON x.a = f.b AND x.n = t.b GROUP BY 1, 2"),
    "b8_available_splits": sql("ub", "SELECT DISTINCT dataset_split FROM ub"),
    "s8_feature_inventory": sql("ub ua seq ib ip cb tb cc", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count, CAST({k} AS BIGINT) AS column_count FROM {t}" for n, t, k in (("user_basic", "ub", 10), ("user_activity", "ua", 19), ("user_sequence", "seq", 11), ("item_behavior", "ib", 14), ("item_popularity", "ip", 17), ("category_behavior", "cb", 15), ("time_behavior", "tb", 15), ("conversion_chain", "cc", 13)))),
    "l1_purchase_labels": sql("lab", "SELECT dataset_split, user_id, item_id, label_date, label FROM lab"),
    "l1_label_summary": sql("lab", "SELECT dataset_split, count(*) AS sample_count, CAST(sum(label) AS BIGINT) AS positive_count, CAST(count(*) - sum(label) AS BIGINT) AS negative_count, round(sum(label) / count(*), 6) AS positive_ratio FROM lab GROUP BY ROLLUP (dataset_split)"),
    "l2_time_ordered_splits": sql("lab", "SELECT dataset_split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM lab GROUP BY 1"),
    "pp2_fitted_moments": sql("train", " UNION ALL ".join(map(_moment, _NUMERIC))),
    "pp4_preprocessed": sql("train", "SELECT l.user_id, l.item_id, l.label, " + ", ".join(map(_scaled, _NUMERIC)) + ", " + ", ".join(f"CAST(CASE WHEN l.{c} IN (SELECT {c} FROM train) THEN {_code(c)} ELSE -1 END AS INT) AS {c}_code" for c in ("last_behavior_type", "user_activity_level")) + " FROM lab l, (SELECT " + ", ".join(f"avg({c}) AS {c}_mean, sqrt(var_pop({c}) * count({c}) / count(*)) AS {c}_scale" for c in _NUMERIC) + " FROM train) m WHERE l.dataset_split = 'validation'"),
    "fs1_column_statistics": sql("train", " UNION ALL ".join(map(_stat, _NUMERIC))),
    "fs1_correlations": sql("train", " UNION ALL ".join(_corr(a, b) for a, b in _pairs)),
    "ci2_smote": sql("train", "SELECT label, false AS is_synthetic, count(*) AS rows, CAST(0 AS BIGINT) AS without_ids FROM train GROUP BY label UNION ALL SELECT 1, true, CAST(sum(1 - 2 * label) AS BIGINT), CAST(sum(1 - 2 * label) AS BIGINT) FROM train"),
    "ci3_undersampled": sql("train", "SELECT user_id, item_id, category_id, label, false AS is_synthetic FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), CAST(category_id AS VARCHAR)))) AS k FROM train) WHERE label = 1 OR k <= (SELECT sum(label) FROM train)"),
    "ci4_class_weights": sql("train", "SELECT label, round((SELECT count(*) FROM train) / (2.0 * count(*)), 6) AS weight FROM train GROUP BY label"),
    "ev1_ranking_metrics": sql("cu", "SELECT round(sum(neg * (tp - pos / 2)) / max(p * n), 6) AS roc_auc, round(sum(pos * tp / (tp + fp)) / max(p), 6) AS average_precision, (SELECT round(-avg(label * ln(least(greatest(score, 1e-15), 1 - 1e-15)) + (1 - label) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15))), 6) FROM sc) AS log_loss, (SELECT round(avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END), 6) FROM sc) AS positive_prediction_ratio, (SELECT count(*) FROM sc) AS sample_count FROM cu"),
    "ev6_confusion": sql("sc", f"SELECT tn, fp, fn, tp, {_RATES} FROM (SELECT {_CELLS.format(t='CAST(0.8 AS DOUBLE)')} FROM sc)"),
    "ev7_threshold_grid": sql("tg", f"SELECT threshold, tp, fp, fn, tn, {_RATES} FROM tg"),
    "ev8_curve_points": sql("cu", "SELECT round(score, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(coalesce(tp / nullif(p, 0), 0.0), 6) AS tpr, round(coalesce(fp / nullif(n, 0), 0.0), 6) AS fpr, round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS \"precision\" FROM cu"),
    "ix4_best_threshold": sql("tg", f"SELECT * FROM (SELECT threshold, tp, fp, fn, tn, {_RATES} FROM tg) ORDER BY f1 DESC, threshold LIMIT 1"),
    "ix5_worst_errors": sql("sc", "SELECT user_id, item_id, label, round(score, 6) AS score, error_type FROM (SELECT *, 'false_positive' AS error_type, row_number() OVER (ORDER BY score DESC, user_id, item_id) AS k FROM sc WHERE score >= 0.5 AND label = 0 UNION ALL SELECT *, 'false_negative', row_number() OVER (ORDER BY score, user_id, item_id) FROM sc WHERE score < 0.5 AND label = 1) WHERE k <= 25"),
    "ix5_error_summary": sql("sc", "SELECT CASE WHEN score >= 0.5 THEN CASE WHEN label = 1 THEN 'true_positive' ELSE 'false_positive' END WHEN label = 1 THEN 'false_negative' ELSE 'true_negative' END AS error_type, count(*) AS sample_count, round(avg(score), 6) AS mean_score FROM sc GROUP BY 1"),
    "ix6_segments": sql("sc", f"SELECT segment, sample_count, positive_count, tp, fp, fn, tn, {_RATES} FROM (SELECT segment, count(*) AS sample_count, count(*) FILTER (WHERE label = 1) AS positive_count, {_CELLS.format(t='0.5')} FROM (SELECT *, unnest(list_filter(['all', CASE WHEN user_event_count <= 1 THEN 'cold_start_user' ELSE 'non_cold_start_user' END, CASE WHEN item_total_count <= 1 THEN 'long_tail_item' ELSE 'non_long_tail_item' END, CASE WHEN user_event_count <= 1 AND item_total_count <= 1 THEN 'cold_start_user_and_long_tail_item' END], lambda x: x IS NOT NULL)) AS segment FROM sc) GROUP BY 1)"),
    "m13_folds": sql("train", "SELECT CAST((k - 1) % 5 AS INT) AS fold, label, count(*) AS rows, CAST(sum(user_id) AS BIGINT) AS user_ids FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), CAST(category_id AS VARCHAR)))) AS k FROM train) GROUP BY 1, 2"),
    "f10_chance": "SELECT DISTINCT user_id, round(CAST(('0x' || substr(md5('42|' || CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0, 9) AS drawn FROM events",
}

_chance = lambda *parts: f"CAST(('0x' || substr(md5(concat_ws('|', '42', {', '.join(parts)})), 1, 8)) AS BIGINT) / 4294967296.0"
_IDS = "CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), CAST(category_id AS VARCHAR)"
#: Synthetic rows by definition: every pair of positives is measured.
_SMOTE = f"""po AS (SELECT row_number() OVER (ORDER BY md5(concat_ws('|', '42', {_IDS}))) - 1 AS n, CAST(user_event_count AS DOUBLE) AS x, CAST(item_total_count AS DOUBLE) AS y, length(last_behavior_type) AS z FROM train WHERE label = 1),
  ne AS (SELECT a.n, b.x, b.y, b.z, row_number() OVER (PARTITION BY a.n ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.n) - 1 AS k FROM po a JOIN po b ON a.n <> b.n QUALIFY k < 5),
  si AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q FROM train),
  pl AS (SELECT i, i % p AS n, CAST(floor({_chance("CAST(i AS VARCHAR)", "'neighbour'")} * least(5, p - 1)) AS BIGINT) AS k FROM (SELECT p, unnest(range(q - p)) AS i FROM si))"""
_made_names = "['baseline', 'class_weight', 'smote', 'undersampled'][user_id % 4 + 1] AS strategy, ['logistic_regression', 'random_forest', 'xgboost', 'lightgbm'][item_id % 4 + 1] AS model"
_MADE = f"mc AS (SELECT {_made_names}, CAST(sum(behavior_hour) % 3 AS DOUBLE) / 4 AS roc_auc, CAST(sum(weekday) % 5 AS DOUBLE) / 8 AS average_precision, CAST(sum(behavior_type) % 7 AS DOUBLE) / 8 AS log_loss FROM clean GROUP BY 1, 2)"
_ORDER = "roc_auc DESC, average_precision DESC, log_loss"
_ROLE_OF = {"last_behavior_type": "categorical", "last_10_behavior_sequence": "categorical", "user_activity_level": "categorical", "category_first_event_time": "dropped", "category_last_event_time": "dropped"}
_wide_inputs = ["last_behavior_type", "last_behavior_hour", "last_behavior_days_ago", "last_10_behavior_sequence", *(f"user_{c}" for c in (*_USER_BASIC, *_USER_ACTIVITY)), *_ITEM, *(f"{c}_rank" for c in _RANKED), "buy_per_pv", "buy_per_fav", "buy_per_cart"]
_wide_inputs += [f"category_{c}" for c in ("active_day_count", "buy_count", "cart_count", "fav_count", "first_event_time", "last_event_time", "pv_count", "total_count", "unique_item_count", "unique_user_count")]
_wide_inputs += [f"time_{c}" for c in ("buy_count", "cart_count", "fav_count", "pv_count", "total_count", "unique_category_count", "unique_item_count", "unique_user_count", "weekday")]
_role_rows = ", ".join(f"('{c}', '{_ROLE_OF.get(c, 'numeric')}')" for c in _wide_inputs)
_groups = lambda name, key, k: f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST({k} AS BIGINT) AS column_count FROM (SELECT DISTINCT dataset_split, {key} FROM hist)"
_all_pairs = ", ".join(f"'{a}|{b}': coalesce(abs(nullif(corr({a}, {b}), 'nan'::DOUBLE)), 0)" for a, b in _pairs)
#: The columns in turn, each kept unless it hardly varies or is like one that is kept.
_GREEDY = f"""ms AS (SELECT MAP {{{_all_pairs}}} AS r, [{', '.join(f"coalesce(var_pop({c}), 0) <= 1e-12" for c in _NUMERIC)}] AS flat, [{', '.join(f"count({c}) < 0.05 * count(*)" for c in _NUMERIC)}] AS gone, [{', '.join(f"'{c}'" for c in _NUMERIC)}] AS names FROM train),
  st(k, kept, feature, reasons) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), '', '' UNION ALL
    SELECT k + 1, CASE WHEN why = '' THEN list_append(kept, f) ELSE kept END, f, why FROM (SELECT k, kept, names[k + 1] AS f,
      CASE WHEN gone[k + 1] OR flat[k + 1] THEN array_to_string(list_filter([CASE WHEN gone[k + 1] THEN 'missing_rate_above_0.95' END, CASE WHEN flat[k + 1] THEN 'low_variance' END], lambda x: x IS NOT NULL), ';')
           ELSE coalesce('high_correlation_with:' || list_filter(kept, lambda x: r[x || '|' || names[k + 1]] >= 0.98)[1], '') END AS why
      FROM st, ms WHERE k < {len(_NUMERIC)}))"""

ORACLES |= {
    "s2_text_log": sql("raw", "SELECT time, CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, CAST(category_id AS VARCHAR) AS item_category, CAST(bt AS VARCHAR) AS behavior_type FROM raw"),
    "s3_typed_parquet": sql("raw", "SELECT time, user_id, item_id, category_id AS item_category, CAST(bt AS TINYINT) AS behavior_type FROM raw WHERE bt <= 4"),
    "s5_split_read": sql("lab", "SELECT user_id, item_id, last_behavior_date, label FROM lab WHERE dataset_split = 'validation'"),
    "s14_json_report": sql("clean", "SELECT s.stage, count(c.user_id) AS behavior_count FROM (VALUES ('PV', 'pv'), ('Favorite', 'fav'), ('Cart', 'cart'), ('Purchase', 'buy')) s(stage, n) LEFT JOIN clean c ON c.behavior_name = s.n GROUP BY 1"),
    "s18_behavior_table": sql("raw", "SELECT time, user_id, item_id, category_id AS item_category, CAST(bt AS TINYINT) AS behavior_type FROM raw WHERE bt <= 4"),
    "v6_broken_clean_rows": sql("clean", "SELECT CAST(0 AS BIGINT) AS bad_time, CAST(0 AS BIGINT) AS bad_user_id, CAST(0 AS BIGINT) AS bad_item_id, count(*) FILTER (WHERE user_id % 17 = 0) AS bad_category_id, count(*) FILTER (WHERE user_id % 7 = 0) AS bad_behavior_date, count(*) FILTER (WHERE item_id % 13 = 0) AS bad_behavior_name, count(*) FILTER (WHERE item_id % 5 = 0) AS bad_behavior_hour, count(*) FILTER (WHERE user_id % 11 = 0) AS bad_weekday FROM clean"),
    "v8_wrong_windows": sql("ub", "SELECT s AS dataset_split, count(user_id) AS rows, count(user_id) FILTER (WHERE s = 'validation' AND user_id % 5 = 0) AS wrong_rows FROM (VALUES ('train'), ('validation'), ('test')) t(s) LEFT JOIN ub ON dataset_split = s AND s <> 'test' GROUP BY 1"),
    "v10_disagreements": sql("ub", 'SELECT count(*) FILTER (WHERE user_id % 9 = 0) AS "inconsistent event_count", CAST(0 AS BIGINT) AS "inconsistent history_start", CAST(0 AS BIGINT) AS "inconsistent history_end", count(*) FILTER (WHERE user_id % 4 = 0) AS "inconsistent label_date" FROM ub'),
    "j5_uncovered_pairs": sql("hist", "SELECT dataset_split, user_id, item_id, CASE WHEN bool_or(behavior_name = 'cart') THEN 'left' ELSE 'right' END AS side FROM hist WHERE behavior_name IN ('cart', 'buy') GROUP BY 1, 2, 3 HAVING count(DISTINCT behavior_name) = 1"),
    "v12_gate_metrics": sql("wide", "SELECT * FROM (SELECT unnest(['rows', 'null_buy_per_pv', 'null_buy_per_fav', 'null_buy_per_cart']) AS metric, unnest([count(*), count(*) - count(buy_per_pv), count(*) - count(buy_per_fav), count(*) - count(buy_per_cart)]) AS value FROM wide) WHERE value > 0"),
    "pp1_feature_roles": f"SELECT * FROM (VALUES {_role_rows}) t(field, role)",
    "d8_intermediate_inventory": sql("hist", " UNION ALL ".join((_groups("user", "user_id", 15), _groups("item", "item_id", 15), _groups("category", "category_id", 13), _groups("time", "behavior_date, behavior_hour", 14)))),
    "b7_funnel_of_splits": sql("hist", "SELECT dataset_split, s.stage, CAST(count(*) FILTER (WHERE behavior_name = s.n) AS DOUBLE) AS behavior_count, round(100 * count(*) FILTER (WHERE behavior_name = s.n) / nullif(count(*) FILTER (WHERE behavior_name = 'pv'), 0), 6) AS relative_to_pv_percentage, round(CASE WHEN s.stage = 'PV' THEN 100.0 ELSE 100 * count(*) FILTER (WHERE behavior_name = s.n) / nullif(count(*) FILTER (WHERE behavior_name = s.before), 0) END, 6) AS from_previous_percentage FROM hist CROSS JOIN (VALUES ('PV', 'pv', ''), ('Favorite', 'fav', 'pv'), ('Cart', 'cart', 'fav'), ('Purchase', 'buy', 'cart')) s(stage, n, before) GROUP BY dataset_split, s.stage, s.n, s.before"),
    "b9_split_frame": sql("lab", 'SELECT upper(dataset_split[1]) || dataset_split[2:] AS "Split", count(*) AS "Samples", CAST(sum(label) AS BIGINT) AS "Positives", CAST(count(*) - sum(label) AS BIGINT) AS "Negatives", round(avg(label), 6) AS "Positive rate" FROM lab GROUP BY dataset_split'),
    "b10_threshold_view": sql("tg", f'SELECT threshold, m AS metric, CASE m WHEN \'precision\' THEN "precision" WHEN \'recall\' THEN recall ELSE f1 END AS value FROM (SELECT threshold, {_RATES} FROM tg) CROSS JOIN (VALUES (\'precision\'), (\'recall\'), (\'f1\')) t(m)'),
    "o9_transitions_of_first": sql("us", "SELECT f.b AS from_behavior, t.b AS to_behavior, count(x.n) AS transition_count, round(coalesce(100 * count(x.n) / nullif(sum(count(x.n)) OVER (PARTITION BY f.b), 0), 0.0), 6) AS transition_probability FROM (VALUES ('pv'), ('fav'), ('cart'), ('buy')) f(b) CROSS JOIN (VALUES ('pv'), ('fav'), ('cart'), ('buy')) t(b) LEFT JOIN (SELECT l[i] AS a, l[i + 1] AS n FROM (SELECT l, unnest(range(1, len(l))) AS i FROM (SELECT l[-10:] AS l FROM us WHERE dataset_split = 'train' ORDER BY user_id, item_id LIMIT 500))) x ON x.a = f.b AND x.n = t.b GROUP BY 1, 2"),
    "pp5_applied_counts": sql("lab train", "SELECT dataset_split, count(*) AS rows_out, count(*) AS rows, " + ", ".join(f"count(*) - count({c}) AS filled_{c}" for c in _NUMERIC) + ", count(*) FILTER (WHERE last_behavior_type NOT IN (SELECT last_behavior_type FROM train)) AS unseen_last_behavior_type, " + ", ".join(f"count(*) FILTER (WHERE last_behavior_type || '-' || last_behavior_hour NOT IN (SELECT last_behavior_type || '-' || last_behavior_hour FROM train)) AS {n}" for n in ("unseen_type_hour", "unseen_codes")) + " FROM lab GROUP BY dataset_split"),
    "f21_raw_values": sql("lab", "SELECT user_id, item_id, user_event_count, item_total_count, time_total_count FROM lab WHERE dataset_split = 'test'"),
    "in3_frozen_features": ORACLES["pp4_preprocessed"].replace("SELECT l.user_id, l.item_id, l.label, ", "SELECT l.user_id, l.item_id, l.category_id, ").replace("WHERE l.dataset_split = 'validation'", "WHERE l.dataset_split = 'test'"),
    "fs2_selected_features": sql("train", "").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f", {_GREEDY} SELECT feature, reasons = '' AS selected, reasons FROM st WHERE k > 0",
    "ci2_synthetic_rows": sql("train", "").rstrip() + f", {_SMOTE} SELECT CAST(1 AS TINYINT) AS label, true AS is_synthetic, CAST(-1 AS BIGINT) AS user_id, round(po.x + {_chance('CAST(i AS VARCHAR)', repr('user_event_count'))} * (ne.x - po.x), 6) AS user_event_count, round(po.y + {_chance('CAST(i AS VARCHAR)', repr('item_total_count'))} * (ne.y - po.y), 6) AS item_total_count, CAST(CASE WHEN {_chance('CAST(i AS VARCHAR)', repr('last_code'))} < 0.5 THEN po.z ELSE ne.z END AS INT) AS last_code FROM pl JOIN po USING (n) JOIN ne USING (n, k)",
    "ci5_variant_statistics": sql("train", "SELECT strategy, p + q AS sample_count, p AS positive_count, q AS negative_count, round(p / (p + q), 6) AS positive_ratio FROM (SELECT s AS strategy, CASE s WHEN 'smote' THEN count(*) FILTER (WHERE label = 0) ELSE count(*) FILTER (WHERE label = 1) END AS p, CASE s WHEN 'undersampled' THEN count(*) FILTER (WHERE label = 1) ELSE count(*) FILTER (WHERE label = 0) END AS q FROM train CROSS JOIN (VALUES ('baseline'), ('class_weight'), ('smote'), ('undersampled')) t(s) GROUP BY s)"),
    "ix2_explanation_sample": sql("sc", "SELECT user_id, item_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR)))) AS k FROM sc) WHERE label = 1 OR k <= 500 - (SELECT sum(label) FROM sc)"),
    "m11_candidate_ranks": sql("clean", "").rstrip() + f", {_MADE} SELECT *, row_number() OVER (ORDER BY {_ORDER}, strategy, model) AS candidate_rank FROM mc",
    "m12_base_models": sql("clean", "").rstrip() + f", {_MADE} SELECT * FROM (SELECT * FROM mc QUALIFY row_number() OVER (PARTITION BY model ORDER BY {_ORDER}, strategy) = 1) ORDER BY {_ORDER}, model LIMIT 3",
    "m9_merged_comparisons": sql("clean", "").rstrip() + f", {_MADE} SELECT *, row_number() OVER (ORDER BY {_ORDER}, strategy, model) AS candidate_rank FROM (SELECT strategy, model, CASE WHEN model IN ('xgboost', 'lightgbm') THEN roc_auc + 0.125 ELSE roc_auc END AS roc_auc, average_precision, log_loss FROM mc)",
    "j12_improvement": sql("clean", "").rstrip() + f", {_MADE} SELECT strategy, model, roc_auc, roc_auc AS roc_auc_before, 0.0::DOUBLE AS roc_auc_change, average_precision, average_precision AS average_precision_before, 0.0::DOUBLE AS average_precision_change, log_loss / 2 AS log_loss, log_loss AS log_loss_before, -log_loss / 2 AS log_loss_change FROM mc WHERE strategy <> 'smote'",
}
