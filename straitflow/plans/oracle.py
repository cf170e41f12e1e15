"""The registered queries as SQL over the test tables, for an independent engine.

Every statement is built from the common table expressions below; only the ones it
needs are put in front of it.
"""

from __future__ import annotations

import re

from straitflow.config import (
    CHOKEPOINT_BOXES,
    CONFLICT_ROOTS,
    MACRO_SERIES,
    MODEL_INPUTS,
    OIL_BOXES,
    PANEL_METRICS,
    SUPPLY_CHAIN_ROOTS,
)


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_ROOTS, _CONFLICT, _OIL = _list(SUPPLY_CHAIN_ROOTS), _list(CONFLICT_ROOTS), _list(OIL_BOXES)
_KEY = "source_url, event_date, actor1, actor2"
_EVENT = "event_id, event_date, root_code, source_url, actor1, actor2"
_BRIEF = f"{_EVENT}, round(goldstein, 6) AS goldstein, round(tone, 6) AS tone, mentions, round(lat, 6) AS lat, round(lon, 6) AS lon"
# What is left of a value that went through a 32-bit column.
_F32 = "CAST(CAST({0} AS FLOAT) AS DOUBLE)"
_BRIEF_F32 = (
    f"{_EVENT}, round({_F32.format('goldstein')}, 6) AS goldstein, round({_F32.format('tone')}, 6) AS tone, "
    f"mentions, round({_F32.format('lat')}, 6) AS lat, round({_F32.format('lon')}, 6) AS lon"
)
_PANEL_AGG = f"""
    count(*) AS event_count, avg(goldstein) AS avg_goldstein, avg(tone) AS avg_tone,
    CAST(sum(mentions) AS BIGINT) AS total_mentions,
    avg(CASE WHEN root_code IN ({_CONFLICT}) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS conflict_ratio"""


def _round(columns) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_INTS = ("event_count", "total_mentions", "label")
_ROUND_METRICS = ", ".join(m if m in _INTS else f"round({m}, 6) AS {m}" for m in PANEL_METRICS)


def _rolled(n: int) -> list[str]:
    return [f"{m}_{n}d" for m in PANEL_METRICS]


def _frames(n: int, frame: str) -> str:
    return ", ".join(f"avg({m}) OVER {frame} AS {m}_{n}d" for m in PANEL_METRICS)


def _change(new: str, old: str) -> str:
    """Difference of 32-bit prices, divided as doubles; null on a zero base."""
    return f"CAST(CAST({new} - {old} AS FLOAT) AS DOUBLE) / nullif(CAST({old} AS DOUBLE), 0)"


def _ffill(source: str) -> str:
    return ", ".join(
        f"last_value({s} IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {s}"
        for s in MACRO_SERIES
    ).join(("SELECT date, ", f" FROM {source}"))


_CTES = {
    "incident": """
        SELECT l_orderkey*10 + l_linenumber AS event_id, CAST(l_shipdate AS DATE) AS event_date,
               lpad(CAST(1 + l_partkey % 20 AS VARCHAR), 2, '0') AS root_code,
               concat('u', CAST(l_suppkey AS VARCHAR)) AS source_url,
               l_returnflag AS actor1, l_linestatus AS actor2,
               l_discount*100 - l_tax*100 AS goldstein, l_quantity AS tone, l_linenumber AS mentions,
               CAST(CASE l_partkey % 12 WHEN 0 THEN 2656 WHEN 1 THEN 3046 WHEN 2 THEN 1400 WHEN 3 THEN 4460
                    WHEN 4 THEN 250 WHEN 5 THEN 908 WHEN 6 THEN 2450 WHEN 7 THEN -2350 ELSE 6000 END
                    + (l_orderkey*7919 + l_linenumber*104729) % 600 - 300 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat,
               CAST(CASE l_partkey % 12 WHEN 0 THEN 5625 WHEN 1 THEN 3234 WHEN 2 THEN 4300 WHEN 3 THEN 3350
                    WHEN 4 THEN 10150 WHEN 5 THEN -7968 WHEN 6 THEN 11950 WHEN 7 THEN -6950 ELSE 1000 END
                    + (l_orderkey*6131 + CAST(l_linenumber AS BIGINT)*15485863) % 600 - 300 AS DOUBLE) / CAST(100 AS DOUBLE) AS lon
        FROM lineitem""",
    "price": """
        SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS commodity,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS close
        FROM orders GROUP BY 1, 2""",
    "macro": """
        SELECT coalesce(wk.date, mo.date) AS date, wk.treasury_10y, mo.usd_index
        FROM (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS date,
                     CAST(SUM(CAST(l_discount*100 AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS treasury_10y
              FROM lineitem GROUP BY 1) wk
        FULL OUTER JOIN (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
                     CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS usd_index
              FROM lineitem GROUP BY 1) mo ON wk.date = mo.date""",
    "boxes": "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{b.name}', CAST({b.lat_min} AS DOUBLE), CAST({b.lat_max} AS DOUBLE), "
        f"CAST({b.lon_min} AS DOUBLE), CAST({b.lon_max} AS DOUBLE))"
        for b in CHOKEPOINT_BOXES
    )
    + ") AS t(name, lat_min, lat_max, lon_min, lon_max)",
    "deduped": f"""
        SELECT * EXCLUDE (rk) FROM (
            SELECT *, row_number() OVER (PARTITION BY {_KEY}
                ORDER BY event_id, root_code, tone, goldstein, lat, lon, mentions) AS rk
            FROM incident) WHERE rk = 1""",
    "coded": f"SELECT * FROM deduped WHERE root_code IN ({_ROOTS})",
    "tagged": """
        SELECT e.*, b.name AS chokepoint FROM coded e JOIN boxes b
          ON e.lat BETWEEN b.lat_min AND b.lat_max AND e.lon BETWEEN b.lon_min AND b.lon_max""",
    "tagged_all": """
        SELECT e.*, b.name AS chokepoint FROM incident e JOIN boxes b
          ON e.lat BETWEEN b.lat_min AND b.lat_max AND e.lon BETWEEN b.lon_min AND b.lon_max""",
    "tagged_f32": f"""
        SELECT e.*, b.name AS chokepoint FROM incident e JOIN boxes b
          ON {_F32.format('e.lat')} BETWEEN b.lat_min AND b.lat_max
         AND {_F32.format('e.lon')} BETWEEN b.lon_min AND b.lon_max""",
    "tagged_live": f"SELECT * FROM tagged_all WHERE root_code IN ({_ROOTS})",
    "panel": f"SELECT event_date, chokepoint, {_PANEL_AGG} FROM tagged GROUP BY 1, 2",
    "panel_live": f"SELECT event_date, chokepoint, {_PANEL_AGG} FROM tagged_live GROUP BY 1, 2",
    "oil_panel": f"SELECT * FROM panel WHERE chokepoint IN ({_OIL})",
    "rolled": f"""
        SELECT *, {_frames(7, 'w7')}, {_frames(30, 'w30')} FROM panel
        WINDOW w7 AS (PARTITION BY chokepoint ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               w30 AS (PARTITION BY chokepoint ORDER BY event_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "rolled_live": f"""
        SELECT *, {_frames(7, 'w7')}, {_frames(30, 'w30')} FROM panel_live
        WINDOW w7 AS (PARTITION BY chokepoint ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               w30 AS (PARTITION BY chokepoint ORDER BY event_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "prices": "SELECT date AS price_date, commodity, CAST(close AS FLOAT) AS close FROM price",
    "lagged": """
        SELECT *, lag(close, 1) OVER w AS close_lag1, lag(close, 5) OVER w AS close_lag5,
               lag(close, 20) OVER w AS close_lag20, lead(close, 5) OVER w AS close_fwd5
        FROM prices WINDOW w AS (PARTITION BY commodity ORDER BY price_date)""",
    "changed": f"""
        SELECT *, {_change('close', 'close_lag5')} AS return_5d, {_change('close', 'close_lag20')} AS return_20d,
               {_change('close', 'close_lag1')} AS daily_return, {_change('close_fwd5', 'close')} AS fwd_return_5d
        FROM lagged""",
    "priced": """
        SELECT *, stddev_samp(daily_return) OVER (PARTITION BY commodity ORDER BY price_date
                   ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS volatility_20d FROM changed""",
    "oil": "SELECT * FROM priced WHERE commodity = '1-URGENT'",
    "cuts": """
        SELECT quantile_cont(fwd_return_5d, 0.33) AS low, quantile_cont(fwd_return_5d, 0.66) AS high FROM oil""",
    "labelled": """
        SELECT *, CASE WHEN fwd_return_5d IS NULL THEN NULL WHEN fwd_return_5d > (SELECT high FROM cuts) THEN 2
                       WHEN fwd_return_5d < (SELECT low FROM cuts) THEN 0 ELSE 1 END AS label FROM oil""",
    "spine": """
        SELECT CAST(unnest(generate_series(min(price_date), max(price_date), INTERVAL 1 DAY)) AS DATE) AS date FROM oil""",
    "on_spine": "SELECT s.date, m.treasury_10y, m.usd_index FROM spine s LEFT JOIN macro m ON s.date = m.date",
    "macro_daily": _ffill("on_spine"),
    "wide_spine": """
        SELECT CAST(unnest(generate_series(min(price_date), max(price_date), INTERVAL 1 DAY)) AS DATE) AS date FROM prices""",
    "on_wide_spine": "SELECT s.date, m.treasury_10y, m.usd_index FROM wide_spine s LEFT JOIN macro m ON s.date = m.date",
    "joined": """
        SELECT r.*, o.return_5d, o.return_20d, o.volatility_20d, CAST(o.label AS INTEGER) AS label,
               m.treasury_10y, m.usd_index
        FROM rolled r JOIN labelled o ON r.event_date = o.price_date
        LEFT JOIN macro_daily m ON r.event_date = m.date""",
    "complete": "SELECT * FROM joined WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in (*MODEL_INPUTS, "label")),
    "features": f"SELECT * FROM complete WHERE chokepoint IN ({_OIL})",
    "ends": "SELECT min(event_date) AS mn, max(event_date) AS mx FROM features",
    "splits": """
        SELECT f.*, CASE WHEN event_date < mn + CAST(floor((mx - mn) * CAST(0.6 AS DOUBLE)) AS INTEGER) THEN 'train'
                         WHEN event_date < mn + CAST(floor((mx - mn) * CAST(0.8 AS DOUBLE)) AS INTEGER) THEN 'validation'
                         ELSE 'test' END AS split
        FROM features f, ends""",
    "ruled": """
        SELECT *, CASE WHEN return_5d > 0.05 THEN 2 WHEN return_5d < -0.05 THEN 0 ELSE 1 END AS prediction FROM splits""",
    "click": "SELECT *, CAST(ts AS DATE) AS event_date FROM events",
    "edges": """
        SELECT concat('s', l_suppkey) AS src, concat('p', l_partkey) AS dst, count(*) AS weight FROM lineitem GROUP BY 1, 2
        UNION ALL
        SELECT concat('p', l_partkey), concat('s', l_suppkey), count(*) FROM lineitem GROUP BY 1, 2""",
    "links": """
        SELECT src, dst, CAST(weight AS DOUBLE) / sum(CAST(weight AS DOUBLE)) OVER (PARTITION BY src) AS share FROM edges""",
    "rank0": "SELECT DISTINCT src AS node, CAST(1 AS DOUBLE) AS rank FROM edges",
    **{
        f"rank{i}": f"""
        SELECT n.node, CAST(1 - 0.85 AS DOUBLE) + CAST(0.85 AS DOUBLE) * coalesce(sum(r.rank * l.share), 0) AS rank
        FROM rank0 n LEFT JOIN links l ON l.dst = n.node LEFT JOIN rank{i - 1} r ON r.node = l.src GROUP BY 1"""
        for i in range(1, 11)
    },
}

# Referenced more than once; computed once.
_MATERIALIZED = {"incident", "links", *(f"rank{i}" for i in range(11))}


def _with(body: str) -> str:
    """Put the table expressions that ``body`` needs, directly or not, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"(?:FROM|JOIN|,)\s+(\w+)", text)):
            if word in _CTES and word not in needed:
                visit(_CTES[word])
                needed.append(word)

    visit(body)
    if not needed:
        return body
    parts = [
        f"{name} AS {'MATERIALIZED ' if name in _MATERIALIZED else ''}({_CTES[name]})" for name in needed
    ]
    return "WITH " + ",\n".join(parts) + "\n" + body


_PRICE_COLUMNS = "price_date, commodity, round(CAST(close AS DOUBLE), 6) AS close"
_FEATURE_COLUMNS = (
    f"event_date, chokepoint, {_ROUND_METRICS}, {_round([*_rolled(7), *_rolled(30)])}, "
    f"{_round(['return_5d', 'return_20d', 'volatility_20d'])}, label, {_round(MACRO_SERIES)}"
)
_YEAR_MONTH = "CAST(year(event_date) AS INTEGER) AS year, CAST(month(event_date) AS INTEGER) AS month"
_BY_MONTH = f"SELECT {_YEAR_MONTH}, count(*) AS row_count, CAST(sum(mentions) AS BIGINT) AS total_mentions FROM incident GROUP BY 1, 2"
_CLOSED_CLICKS = "event_date + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"
_CLOSED_DAY = "{0} <= (SELECT max(event_date) FROM tagged_live) - 1"

_BODIES = {
    "scan_delimited_events": f"SELECT {_BRIEF_F32} FROM incident",
    "scan_price_csv": "SELECT date, round(close, 6) AS close, commodity, substr(commodity, 1, 1) AS symbol FROM price",
    "scan_macro_csv": "SELECT date, round(treasury_10y, 6) AS treasury_10y, round(usd_index, 6) AS usd_index, round(treasury_10y * 2, 6) AS cpi FROM macro",
    "scan_event_store": f"SELECT {_BRIEF_F32}, {_YEAR_MONTH} FROM incident",
    "scan_pruned_partitions": f"SELECT {_BRIEF_F32} FROM incident WHERE event_date BETWEEN DATE '1996-03-15' AND DATE '1997-06-20'",
    "incremental_intake": _BY_MONTH,
    "store_mixed_loads": _BY_MONTH,
    "store_late_rows": """
        SELECT CAST(CASE WHEN mentions = 6 THEN 0 ELSE year(event_date) END AS INTEGER) AS year,
               CAST(CASE WHEN mentions = 6 THEN 0 ELSE month(event_date) END AS INTEGER) AS month,
               count(*) AS row_count, CAST(sum(mentions) AS BIGINT) AS total_mentions
        FROM incident GROUP BY 1, 2""",
    "sink_event_store_roundtrip": _BY_MONTH,
    "sink_features_roundtrip": f"SELECT {_FEATURE_COLUMNS} FROM features",
    "preprocessing_funnel": """
        SELECT 1 AS position, 'raw events' AS step, count(*) AS row_count FROM incident
        UNION ALL SELECT 2, 'without copies', count(*) FROM deduped
        UNION ALL SELECT 3, 'wanted codes', count(*) FROM coded
        UNION ALL SELECT 4, 'near a box', count(*) FROM tagged
        UNION ALL SELECT 5, 'daily panel', count(*) FROM panel
        UNION ALL SELECT 6, 'feature rows', count(*) FROM features""",
    "catalog_event_table": """
        SELECT CAST(year(event_date) AS INTEGER) AS year, root_code, count(*) AS row_count,
               CAST(sum(mentions) AS BIGINT) AS total_mentions
        FROM incident GROUP BY 1, 2""",
    "tier_summaries": f"""
        SELECT CAST(date_trunc('month', event_date) AS DATE) AS month_start, chokepoint, count(*) AS event_count,
               CAST(sum(mentions) AS BIGINT) AS total_mentions,
               round(sum({_F32.format('goldstein')}), 6) AS sum_goldstein,
               round(sum({_F32.format('tone')}), 6) AS sum_tone,
               count(CASE WHEN root_code IN ({_CONFLICT}) THEN 1 END) AS conflict_events
        FROM tagged_f32 GROUP BY 1, 2""",
    "parse_event_date": """
        SELECT event_id,
               CAST(year(event_date)*10000 + month(event_date)*100 + day(event_date)
                    + CASE WHEN mentions = 7 THEN 40 ELSE 0 END AS INTEGER) AS sqldate,
               CASE WHEN mentions <> 7 THEN event_date END AS event_date
        FROM incident""",
    "event_date_parts": f"SELECT event_id, event_date, {_YEAR_MONTH} FROM incident",
    "cameo_filter": f"SELECT {_BRIEF} FROM incident WHERE root_code IN ({_ROOTS})",
    "geo_any_box": f"SELECT {_BRIEF} FROM incident WHERE EXISTS (SELECT 1 FROM boxes WHERE lat BETWEEN lat_min AND lat_max AND lon BETWEEN lon_min AND lon_max)",
    "geo_box_filter": f"SELECT {_BRIEF} FROM tagged_all WHERE chokepoint = 'hormuz'",
    "price_select_commodity": "SELECT date, commodity, round(close, 6) AS close FROM price WHERE commodity = '1-URGENT'",
    "price_normalise": f"SELECT {_PRICE_COLUMNS} FROM prices WHERE commodity = '1-URGENT'",
    "price_coalesce_close": "SELECT date, commodity, round(close, 6) AS close FROM price",
    "price_union": "SELECT date, round(close, 6) AS close, commodity, substr(commodity, 1, 1) AS symbol FROM price",
    "macro_normalise": "SELECT date, round(usd_index, 6) AS usd_index FROM macro",
    "features_oil_scope": f"SELECT event_date, chokepoint, {_ROUND_METRICS}, {_round([*_rolled(7), *_rolled(30)])} FROM rolled WHERE chokepoint IN ({_OIL})",
    "label_source_rows": f"SELECT {_PRICE_COLUMNS}, round(fwd_return_5d, 6) AS fwd_return_5d FROM changed WHERE fwd_return_5d IS NOT NULL",
    "features_complete_rows": "SELECT event_date, chokepoint, label FROM features",
    "train_window_filter": f"SELECT {_FEATURE_COLUMNS} FROM features WHERE event_date >= DATE '1998-01-01'",
    "dedup_events": f"SELECT {_BRIEF} FROM deduped",
    "dedup_across_deliveries": f"SELECT {_BRIEF} FROM deduped",
    "retire_late_rows": _BY_MONTH,
    "feature_refresh": f"SELECT {_FEATURE_COLUMNS} FROM features",
    "dedup_key_count": f"SELECT count(*) AS key_count FROM (SELECT DISTINCT {_KEY} FROM incident)",
    "dedup_ratio": f"""
        SELECT (SELECT count(*) FROM incident) AS row_count, count(*) AS key_count,
               round(1 - CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM incident), 6) AS removed_ratio
        FROM (SELECT DISTINCT {_KEY} FROM incident)""",
    "geo_flags": "SELECT event_id, round(lat, 6) AS lat, round(lon, 6) AS lon, "
    + ", ".join(
        f"(lat BETWEEN CAST({b.lat_min} AS DOUBLE) AND CAST({b.lat_max} AS DOUBLE) "
        f"AND lon BETWEEN CAST({b.lon_min} AS DOUBLE) AND CAST({b.lon_max} AS DOUBLE)) AS near_{b.name}"
        for b in CHOKEPOINT_BOXES
    )
    + " FROM incident",
    **{
        name: f"SELECT {_BRIEF}, chokepoint FROM tagged_all"
        for name in ("geo_tag_explode", "geo_tag_range_join", "geo_tag_grid_join")
    },
    "daily_panel": f"SELECT event_date, chokepoint, {_ROUND_METRICS} FROM panel",
    "conflict_ratio": "SELECT event_date, chokepoint, round(conflict_ratio, 6) AS conflict_ratio FROM panel",
    "rolling_7": f"SELECT event_date, chokepoint, {_round(_rolled(7))} FROM rolled",
    "rolling_30": f"SELECT event_date, chokepoint, {_round(_rolled(30))} FROM rolled",
    "rolling_7_calendar": f"""
        SELECT event_date, chokepoint, {_round(_rolled(7))} FROM (
            SELECT event_date, chokepoint, {_frames(7, 'w')} FROM panel
            WINDOW w AS (PARTITION BY chokepoint ORDER BY event_date
                         RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW))""",
    "weekly_panel": f"""
        SELECT week_start, chokepoint, {_ROUND_METRICS} FROM (
            SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start, chokepoint, {_PANEL_AGG}
            FROM tagged GROUP BY 1, 2)""",
    "eda_monthly_heatmap": "SELECT CAST(date_trunc('month', event_date) AS DATE) AS month_start, "
    + ", ".join(f"count(CASE WHEN chokepoint = '{b.name}' THEN 1 END) AS {b.name}" for b in CHOKEPOINT_BOXES)
    + " FROM tagged GROUP BY 1",
    "eda_chokepoint_totals": f"SELECT chokepoint, count(*) AS event_count, chokepoint IN ({_OIL}) AS oil_relevant FROM tagged GROUP BY 1",
    "price_lags": f"SELECT {_PRICE_COLUMNS}, "
    + ", ".join(f"round(CAST(close_lag{k} AS DOUBLE), 6) AS close_lag{k}" for k in (1, 5, 20))
    + " FROM lagged",
    "price_lead": f"SELECT {_PRICE_COLUMNS}, round(CAST(close_fwd5 AS DOUBLE), 6) AS close_fwd5 FROM lagged",
    "returns_5_20": f"SELECT {_PRICE_COLUMNS}, {_round(['return_5d', 'return_20d'])} FROM priced",
    "daily_return": f"SELECT {_PRICE_COLUMNS}, round(daily_return, 6) AS daily_return FROM priced",
    "volatility_20": f"SELECT {_PRICE_COLUMNS}, {_round(['daily_return', 'volatility_20d'])} FROM priced",
    "forward_return_5": f"SELECT {_PRICE_COLUMNS}, round(fwd_return_5d, 6) AS fwd_return_5d FROM priced",
    "returns_all_commodities": f"SELECT {_PRICE_COLUMNS}, {_round(['return_5d', 'return_20d', 'daily_return', 'volatility_20d', 'fwd_return_5d'])} FROM priced",
    "return_terciles": f"SELECT {_round(['low', 'high'])} FROM cuts",
    "tercile_labels": "SELECT price_date, round(CAST(close AS DOUBLE), 6) AS close, round(fwd_return_5d, 6) AS fwd_return_5d, CAST(label AS INTEGER) AS label FROM labelled",
    "binary_vol_label": """
        SELECT price_date, round(volatility_20d, 6) AS volatility_20d,
               CAST(volatility_20d > (SELECT quantile_cont(volatility_20d, 0.66) FROM oil) AS INTEGER) AS high_volatility
        FROM oil""",
    "date_bounds": "SELECT min(price_date) AS min_date, max(price_date) AS max_date FROM oil",
    "date_spine": "SELECT date FROM spine",
    "macro_spine_join": f"SELECT date, {_round(MACRO_SERIES)} FROM on_spine",
    "macro_forward_fill": f"SELECT date, {_round(MACRO_SERIES)} FROM ({_ffill('on_wide_spine')})",
    "macro_full_outer_merge": f"""
        SELECT coalesce(t.date, u.date, p.price_date) AS date, {_round(['t.treasury_10y', 'u.usd_index']).replace('AS t.', 'AS ').replace('AS u.', 'AS ')},
               round(CAST(p.close AS DOUBLE), 6) AS close
        FROM (SELECT date, treasury_10y FROM macro) t
        FULL OUTER JOIN (SELECT date, usd_index FROM macro WHERE usd_index IS NOT NULL) u ON t.date = u.date
        FULL OUTER JOIN (SELECT price_date, close FROM prices WHERE commodity = '1-URGENT') p
          ON coalesce(t.date, u.date) = p.price_date""",
    "asof_join_macro": """
        SELECT p.price_date AS date, p.commodity, 'treasury_10y' AS series_id, round(m.treasury_10y, 6) AS value
        FROM prices p ASOF LEFT JOIN (SELECT * FROM macro WHERE treasury_10y IS NOT NULL) m ON p.price_date >= m.date
        UNION ALL
        SELECT p.price_date, p.commodity, 'usd_index', round(m.usd_index, 6)
        FROM prices p ASOF LEFT JOIN (SELECT * FROM macro WHERE usd_index IS NOT NULL) m ON p.price_date >= m.date""",
    "join_features_price": f"""
        SELECT event_date, chokepoint, {_ROUND_METRICS}, {_round(['return_5d', 'return_20d', 'volatility_20d'])},
               CAST(label AS INTEGER) AS label
        FROM oil_panel JOIN labelled ON event_date = price_date""",
    "join_features_macro": f"""
        SELECT event_date, chokepoint, {_ROUND_METRICS}, {_round(MACRO_SERIES)}
        FROM oil_panel LEFT JOIN macro_daily ON event_date = date""",
    "feature_table": f"SELECT {_FEATURE_COLUMNS} FROM features",
    "feature_table_all_boxes": f"SELECT {_FEATURE_COLUMNS} FROM complete",
    "feature_table_by_month": f"SELECT {_FEATURE_COLUMNS} FROM features",
    "label_histogram": "SELECT label, count(*) AS row_count FROM features GROUP BY 1 ORDER BY 1",
    "assembled_rows": f"SELECT event_date, chokepoint, CAST({len(MODEL_INPUTS)} AS INTEGER) AS vector_size, {_round(MODEL_INPUTS)} FROM features",
    "time_split": "SELECT event_date, chokepoint, split FROM splits",
    "confusion_matrix": "SELECT split, label, prediction, count(*) AS row_count FROM ruled GROUP BY 1, 2, 3 ORDER BY 1, 2, 3",
    "classification_metrics": """
        SELECT a.split, CAST(sum(a.n) AS BIGINT) AS row_count, round(CAST(sum(a.hits) AS DOUBLE) / sum(a.n), 6) AS accuracy,
               round(sum(2.0 * a.hits / (a.n + coalesce(p.n, 0)) * a.n) / sum(a.n), 6) AS f1
        FROM (SELECT split, label, count(*) AS n, count(CASE WHEN label = prediction THEN 1 END) AS hits
              FROM ruled GROUP BY 1, 2) a
        LEFT JOIN (SELECT split, prediction, count(*) AS n FROM ruled GROUP BY 1, 2) p
          ON a.split = p.split AND a.label = p.prediction
        GROUP BY 1""",
    "stream_replay_count": "SELECT event_type, count(*) AS event_count FROM events GROUP BY 1",
    "stream_dedup": "SELECT DISTINCT user_id, event_type, event_date FROM click",
    "stream_daily_panel": f"SELECT event_date, chokepoint, {_ROUND_METRICS} FROM panel_live",
    "stream_rolling_7d": f"""
        SELECT CAST(event_date + k AS DATE) AS last_date, chokepoint, count(*) AS event_count,
               CAST(sum(mentions) AS BIGINT) AS total_mentions
        FROM tagged_live, (SELECT CAST(unnest(range(7)) AS INTEGER) AS k)
        WHERE {_CLOSED_DAY.format('event_date + k + 1')} GROUP BY 1, 2""",
    "stream_enrich": f"""
        SELECT event_id, event_date, chokepoint, round(CAST(close AS DOUBLE), 6) AS close,
               {_round(['return_5d', 'volatility_20d'])}
        FROM tagged_live JOIN oil ON event_date = price_date""",
    "stream_alerts": f"""
        SELECT event_date, chokepoint, event_count, round(conflict_ratio, 6) AS conflict_ratio FROM panel_live
        WHERE event_count >= 2 AND conflict_ratio >= 0.75 AND {_CLOSED_DAY.format('event_date + 1')}""",
    "stream_rolling_30d": f"""
        SELECT CAST(event_date + k AS DATE) AS last_date, chokepoint, count(*) AS event_count,
               CAST(sum(mentions) AS BIGINT) AS total_mentions
        FROM tagged_live, (SELECT CAST(unnest(range(30)) AS INTEGER) AS k)
        WHERE {_CLOSED_DAY.format('event_date + k + 1')} GROUP BY 1, 2""",
    # The watermark of the first batch, a day behind its newest row, closes days for the third.
    "stream_late_data": f"""
        SELECT event_date, event_type, count(*) AS event_count FROM click
        WHERE {_CLOSED_CLICKS} AND (event_id % 10 <> 0 OR event_date + 1 >
              (SELECT max(ts) FROM events WHERE event_id % 10 > 1) - INTERVAL 1 DAY)
        GROUP BY 1, 2""",
    "stream_rolling_rows": f"SELECT event_date, chokepoint, {_ROUND_METRICS}, {_round([*_rolled(7), *_rolled(30)])} FROM rolled_live",
    "stream_asof_join": """
        SELECT date, commodity, series_id, value FROM (
            SELECT p.price_date AS date, p.commodity, 'treasury_10y' AS series_id, round(m.treasury_10y, 6) AS value
            FROM prices p ASOF LEFT JOIN (SELECT * FROM macro WHERE treasury_10y IS NOT NULL) m ON p.price_date >= m.date
            UNION ALL
            SELECT p.price_date, p.commodity, 'usd_index', round(m.usd_index, 6)
            FROM prices p ASOF LEFT JOIN (SELECT * FROM macro WHERE usd_index IS NOT NULL) m ON p.price_date >= m.date)
        WHERE date < greatest((SELECT max(price_date) FROM prices), (SELECT max(date) FROM macro)) - 30""",
    "return_terciles_approx": "SELECT true AS low_ok, true AS high_ok",
    "rf_predictions": """
        SELECT split, label, count(*) AS row_count, count(*) AS predicted_rows, true AS same_accuracy
        FROM splits WHERE split <> 'train' GROUP BY 1, 2""",
    "forest_matrix_totals": """
        SELECT split, label, CAST(count(*) AS BIGINT) AS row_count FROM splits WHERE split <> 'train' GROUP BY 1, 2""",
    "walk_forward_folds": """
        SELECT CAST(fold AS INTEGER) AS fold, role, event_date, chokepoint FROM (
            SELECT f.event_date, f.chokepoint, k AS fold,
                   CASE WHEN i >= n * k // 5 AND i < n * (k + 1) // 5 THEN 'validation' WHEN i < n * k // 5 - 5 THEN 'train' END AS role
            FROM features f
            JOIN (SELECT event_date, row_number() OVER (ORDER BY event_date) - 1 AS i, count(*) OVER () AS n
                  FROM (SELECT DISTINCT event_date FROM features)) d ON f.event_date = d.event_date,
                 (SELECT unnest(range(1, 5)) AS k))
        WHERE role IS NOT NULL""",
    "walk_forward_scores": """
        SELECT CAST(20 AS INTEGER) AS num_trees, CAST(max_depth AS INTEGER) AS max_depth, CAST(fold AS INTEGER) AS fold,
               count(CASE WHEN role = 'train' THEN 1 END) AS train_rows,
               count(CASE WHEN role = 'validation' THEN 1 END) AS validation_rows, true AS is_share
        FROM (SELECT k AS fold,
                     CASE WHEN i >= n * k // 4 AND i < n * (k + 1) // 4 THEN 'validation' WHEN i < n * k // 4 - 5 THEN 'train' END AS role
              FROM complete f
              JOIN (SELECT event_date, row_number() OVER (ORDER BY event_date) - 1 AS i, count(*) OVER () AS n
                    FROM (SELECT DISTINCT event_date FROM complete)) d ON f.event_date = d.event_date,
                   (SELECT unnest(range(1, 4)) AS k)), (VALUES (3), (5)) AS g(max_depth)
        GROUP BY 1, 2, 3""",
    "ingest_quarantine": """
        SELECT CASE mentions WHEN 7 THEN 'too few fields' WHEN 6 THEN 'too many fields' WHEN 5 THEN 'bad value' ELSE 'stored' END AS kind,
               CASE WHEN mentions < 5 THEN CAST(year(event_date) AS INTEGER) END AS year, count(*) AS row_count
        FROM incident GROUP BY 1, 2""",
    "stored_sketch_terciles": "SELECT range_id, commodity, count(*) AS n, true AS low_ok, true AS high_ok FROM changed JOIN (VALUES "
    + ", ".join(f"('{y}', DATE '{y}-01-01', DATE '{y}-12-31')" for y in range(1995, 2002)) + ", "
    + ", ".join(f"('{y} and on', DATE '{y}-07-01', DATE '{y + 2}-06-30')" for y in range(1995, 2000))
    + ", ('all', DATE '1995-01-01', DATE '2001-12-31')) AS r(range_id, mn, mx) ON price_date BETWEEN mn AND mx "
    "WHERE fwd_return_5d IS NOT NULL GROUP BY 1, 2",
    "geo_tag_quadtree": f"""
        SELECT name, count(*) AS event_count FROM incident e JOIN (
            SELECT concat('c', c_custkey) AS name, y - side / 4 AS lat_min, y + side / 4 AS lat_max,
                   x - side / 2 AS lon_min, x + side / 2 AS lon_max
            FROM (SELECT c_custkey, CAST(0.01 AS DOUBLE) * (1 << CAST(c_custkey % 15 AS INTEGER)) AS side,
                         CAST((CASE c_custkey % 12 WHEN 0 THEN 2656 WHEN 1 THEN 3046 WHEN 2 THEN 1400 WHEN 3 THEN 4460
                              WHEN 4 THEN 250 WHEN 5 THEN 908 WHEN 6 THEN 2450 WHEN 7 THEN -2350 ELSE 6000 END)
                              + (c_custkey * 7919) % 600 - 300 AS DOUBLE) / CAST(100 AS DOUBLE) AS y,
                         CAST((CASE c_custkey % 12 WHEN 0 THEN 5625 WHEN 1 THEN 3234 WHEN 2 THEN 4300 WHEN 3 THEN 3350
                              WHEN 4 THEN 10150 WHEN 5 THEN -7968 WHEN 6 THEN 11950 WHEN 7 THEN -6950 ELSE 1000 END)
                              + (c_custkey * 6131) % 600 - 300 AS DOUBLE) / CAST(100 AS DOUBLE) AS x
                  FROM customer)) b
          ON e.lat BETWEEN b.lat_min AND b.lat_max AND e.lon BETWEEN b.lon_min AND b.lon_max
        GROUP BY 1""",
    "graph_closeness": """
        WITH RECURSIVE pairs AS (
            SELECT n_name AS a, o_orderpriority AS b FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            UNION SELECT n_name, concat('region ', r_name) FROM nation JOIN region ON n_regionkey = r_regionkey
        ), hops AS (SELECT a AS src, b AS dst FROM pairs UNION SELECT b, a FROM pairs),
        walks AS (
            SELECT src, dst, 1 AS d FROM hops
            UNION SELECT w.src, h.dst, d + 1 FROM walks w JOIN hops h ON w.dst = h.src WHERE d < 8
        ), near AS (SELECT src, dst, min(d) AS d FROM walks WHERE src <> dst GROUP BY 1, 2)
        SELECT src AS node, count(*) AS reached, round(sum(1.0::DOUBLE / d), 6) AS closeness FROM near GROUP BY 1""",
    "feature_importances": "SELECT feature, true AS is_share, CAST(1 AS DOUBLE) AS total FROM (VALUES "
    + ", ".join(f"('{c}')" for c in MODEL_INPUTS)
    + ") AS inputs(feature)",
    "cv_grid": """
        SELECT num_trees, max_depth, CAST(3 AS INTEGER) AS folds, true AS is_score
        FROM (VALUES (50, 5), (50, 8), (100, 5), (100, 8)) AS grid(num_trees, max_depth)""",
    "model_roundtrip": """
        SELECT split, count(*) AS row_count, CAST(0 AS BIGINT) AS disagreements
        FROM splits WHERE split <> 'train' GROUP BY 1""",
    "stream_score": """
        SELECT split, count(*) AS row_count, CAST(0 AS BIGINT) AS disagreements FROM splits GROUP BY 1""",
    "ablation_metrics": """
        SELECT s.inputs, p.split, p.row_count, true AS is_share
        FROM (VALUES ('all'), ('events'), ('prices'), ('macro')) AS s(inputs),
             (SELECT split, CAST(count(*) AS BIGINT) AS row_count FROM splits WHERE split <> 'train' GROUP BY 1) p""",
    "graph_edges": """
        SELECT n_name AS src, o_orderpriority AS dst, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS weight
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    "graph_degree": """
        SELECT o.src AS node, o.n AS out_degree, i.n AS in_degree, o.w AS out_weight, i.w AS in_weight
        FROM (SELECT src, count(*) AS n, CAST(sum(weight) AS BIGINT) AS w FROM edges GROUP BY 1) o
        JOIN (SELECT dst, count(*) AS n, CAST(sum(weight) AS BIGINT) AS w FROM edges GROUP BY 1) i ON o.src = i.dst""",
    "graph_pagerank": "SELECT node, round(rank, 6) AS rank FROM rank10",
}

ORACLE = {name: _with(body) for name, body in _BODIES.items()}
