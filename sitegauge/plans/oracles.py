"""The queries of ``queries.py`` in plain SQL over the same tables, for a check by DuckDB."""

from __future__ import annotations

from sitegauge.plans.queries import EXTREME, GROUP, SINGLE

MONTHS = """
vs AS (
  SELECT c_custkey, c_name AS domain, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(sum(CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_totalprice < 60000 THEN 0
                       ELSE CAST(floor(o_totalprice) AS BIGINT) END) AS BIGINT) AS visits
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2, 3
),
rs AS (
  SELECT c_custkey, domain, month, visits,
         rank() OVER (PARTITION BY month ORDER BY visits DESC NULLS LAST) AS rank
  FROM vs
)"""

DOCS = (
    MONTHS
    + """,
latest AS (
  SELECT c_custkey, count(*) AS n_months, max(month) AS month,
         CAST(coalesce(sum(visits), 0) AS BIGINT) AS sum_visits
  FROM rs GROUP BY c_custkey
),
prices AS (
  SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS n_countries
  FROM orders GROUP BY o_custkey
),
doc AS (
  SELECT c.c_custkey, c.c_name AS domain, rs.rank AS global_rank, rs.visits AS total_visits,
         CASE WHEN c.c_custkey % 7 = 0 THEN ''
              ELSE concat(CAST(floor(abs(c_acctbal)) AS BIGINT) % 100, '.',
                          lpad(CAST(c.c_custkey % 100 AS VARCHAR), 2, '0'), '%') END AS bounce_rate_raw,
         c_acctbal / 1000 AS pages_per_visit,
         (c.c_custkey * 7919) % 86400 AS t,
         CASE WHEN c.c_custkey % 11 = 0 THEN ''
              WHEN c.c_custkey % 13 = 0 THEN '25:61:00'
              ELSE concat(lpad(CAST(t // 3600 AS VARCHAR), 2, '0'), ':',
                          lpad(CAST(t // 60 % 60 AS VARCHAR), 2, '0'), ':',
                          lpad(CAST(t % 60 AS VARCHAR), 2, '0')) END AS avg_visit_duration_raw,
         c_acctbal / 7 AS last_month_change,
         TRY_CAST(trim(bounce_rate_raw, '%') AS DOUBLE) AS bounce_rate_percent,
         CASE WHEN c.c_custkey % 11 = 0 OR c.c_custkey % 13 = 0 THEN NULL ELSE t END
           AS avg_visit_duration_seconds,
         latest.n_months, latest.sum_visits, coalesce(prices.n_countries, 0) AS n_countries,
         CAST(count(*) OVER (PARTITION BY c.c_custkey // 5) AS BIGINT) AS n_rivals
  FROM customer c
  LEFT JOIN latest ON latest.c_custkey = c.c_custkey
  LEFT JOIN rs ON rs.c_custkey = c.c_custkey AND rs.month = latest.month
  LEFT JOIN prices ON o_custkey = c.c_custkey
)"""
)

OUTCOME = """CASE WHEN page_id % 10 = 2 THEN 'invalid_utf8'
       WHEN page_id % 10 = 0 OR c_custkey IS NULL THEN 'no_object'
       WHEN page_id % 10 IN (1, 5) THEN 'bad_json' ELSE 'good' END"""

BRACKETS = """
brackets(i, low, high, label) AS (
  VALUES (0, 18, 24, '18-24'), (1, 25, 34, '25-34'), (2, 35, 44, '35-44'),
         (3, 45, 54, '45-54'), (4, 55, 64, '55-64'), (5, 65, NULL, '65+')
),
bands AS (
  SELECT o_custkey, CAST(floor(o_totalprice / 90000) AS BIGINT) AS i, count(*) AS n
  FROM orders GROUP BY 1, 2
),
totals AS (SELECT o_custkey, count(*) AS n_all FROM orders GROUP BY 1),
ages AS (
  SELECT c_name AS domain, low, high, label,
         CASE WHEN n_all IS NOT NULL THEN coalesce(n, 0) / n_all END AS share
  FROM customer CROSS JOIN brackets
  LEFT JOIN totals ON totals.o_custkey = c_custkey
  LEFT JOIN bands ON bands.o_custkey = c_custkey AND bands.i = brackets.i
)"""

NATION = """
vs AS (
  SELECT n_name AS domain, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         count(*) AS visits
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2
),
rs AS (
  SELECT domain, month, rank() OVER (PARTITION BY month ORDER BY visits DESC) AS rank FROM vs
)"""

# A row's predecessor is the row at the largest earlier month of its domain, found by a join.
VISIT_CHANGES = """
SELECT now.domain, CAST(now.month AS VARCHAR) AS month, now.visits, past.visits AS prev_month_visits,
       round((now.visits - past.visits) / nullif(past.visits, 0) * 100, 2) AS mom_growth_percent
FROM (SELECT a.domain, a.month, a.visits, max(b.month) AS earlier
      FROM vs a LEFT JOIN vs b ON b.domain = a.domain AND b.month < a.month GROUP BY ALL) now
LEFT JOIN vs past ON past.domain = now.domain AND past.month = now.earlier"""

RANK_CHANGES = """
SELECT now.domain, CAST(now.month AS VARCHAR) AS month, now.rank, past.rank AS prev_month_rank,
       past.rank - now.rank AS rank_change,
       round((now.rank - past.rank) / nullif(past.rank, 0) * 100, 2) AS rank_change_percent
FROM (SELECT a.domain, a.month, a.rank, max(b.month) AS earlier
      FROM rs a LEFT JOIN rs b ON b.domain = a.domain AND b.month < a.month GROUP BY ALL) now
LEFT JOIN rs past ON past.domain = now.domain AND past.month = now.earlier"""

METRICS = """
span AS (SELECT domain, min(month) AS a, max(month) AS z FROM vs GROUP BY domain),
vg AS (
  SELECT span.domain, va.visits AS first_month_visits, vz.visits AS last_month_visits,
         round((vz.visits - va.visits) * 100.0 / nullif(va.visits, 0), 2) AS visit_growth
  FROM span
  JOIN vs va ON va.domain = span.domain AND va.month = a
  JOIN vs vz ON vz.domain = span.domain AND vz.month = z
),
ranked AS (SELECT domain, min(month) AS a, max(month) AS z FROM rs GROUP BY domain),
rc AS (
  SELECT ranked.domain, ra.rank AS first_month_rank, rz.rank AS last_month_rank,
         ra.rank - rz.rank AS rank_change
  FROM ranked
  JOIN rs ra ON ra.domain = ranked.domain AND ra.month = a
  JOIN rs rz ON rz.domain = ranked.domain AND rz.month = z
),
metrics AS (SELECT domain, visit_growth, rank_change FROM vg JOIN rc USING (domain)),
placed AS (
  SELECT *, rank() OVER (ORDER BY visit_growth DESC NULLS LAST) AS visits_rank,
         rank() OVER (ORDER BY rank_change DESC NULLS LAST) AS rank_improvement_rank
  FROM metrics
),
ranking AS (SELECT *, visits_rank + rank_improvement_rank AS combined_rank FROM placed)"""

SIGN = "CAST(CASE WHEN {0} > 0 THEN 1 WHEN {0} < 0 THEN -1 ELSE 0 END AS INTEGER)"

LABELLED = """
docs AS (
  SELECT d.doc_id, source, lang, n_chars, quality, toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

GROUP_SQL = ", ".join(f"'{name}'" for name in GROUP)

ORACLES: dict[str, str] = {
    "script_token_extract": """
SELECT page_id, CAST(len(regexp_extract_all(html, '<script')) AS INTEGER) AS n_scripts,
       nullif(regexp_extract(html, 'track\\((\\d+)\\)', 1), '') AS token
FROM pages""",
    "embedded_json_extract": f"""
WITH {DOCS}
SELECT page_id, domain, global_rank, total_visits, bounce_rate_raw, pages_per_visit,
       avg_visit_duration_raw, last_month_change, bounce_rate_percent,
       avg_visit_duration_seconds, n_months, n_rivals, n_countries, CAST(6 AS BIGINT) AS n_brackets
FROM pages LEFT JOIN doc ON page_id = c_custkey
WHERE {OUTCOME} = 'good'""",
    "bad_record_split": f"""
SELECT page_id, {OUTCOME} AS outcome FROM pages LEFT JOIN customer ON page_id = c_custkey""",
    "project_paths": f"""
WITH {DOCS}
SELECT domain, global_rank, total_visits, bounce_rate_raw, pages_per_visit,
       avg_visit_duration_raw, last_month_change
FROM doc""",
    "projection_file": f"""
WITH {DOCS}
SELECT domain AS site, bounce_rate_raw AS bounce, pages_per_visit AS pages, last_month_change AS change,
       CAST(NULL AS VARCHAR) AS nothing, CAST(6 AS BIGINT) AS people
FROM doc""",
    "count_spellings": """
SELECT CAST(o_orderkey AS VARCHAR) AS domain, n AS global_rank, n AS total_visits
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN (o_orderkey % 1000) * 1000000000 + 500000000
                              ELSE CAST(floor(o_totalprice) AS BIGINT) END AS n
      FROM orders)""",
    "country_fields": """
SELECT c_name AS domain, o_orderpriority AS country, lower(o_orderpriority) AS url_code, n / n_all AS share,
       (CAST(left(o_orderpriority, 1) AS INTEGER) - 1) / 8 AS share_change
FROM (SELECT o_custkey, o_orderpriority, count(*) AS n,
             sum(count(*)) OVER (PARTITION BY o_custkey) AS n_all
      FROM orders GROUP BY 1, 2)
JOIN customer ON o_custkey = c_custkey""",
    "json_scalar": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       array_to_string(json_keys(props), ',') AS keys
FROM events""",
    "percent_clean": """
SELECT l_orderkey, l_partkey, l_linenumber, discount_raw,
       TRY_CAST(trim(discount_raw, '%') AS DOUBLE) AS discount_percent
FROM (SELECT l_orderkey, l_partkey, l_linenumber,
             CASE WHEN l_linenumber = 4 THEN ''
                  ELSE concat(CAST(round(l_discount * 100) AS INTEGER), '%') END AS discount_raw
      FROM lineitem)""",
    "duration_to_seconds": """
SELECT event_id, clock,
       CASE WHEN clock IN ('', '24:00:00', 'n/a') THEN NULL
            ELSE hour(ts) * 3600 + minute(ts) * 60 + second(ts) END AS seconds
FROM (SELECT event_id, ts,
             CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN '24:00:00'
                  WHEN event_id % 13 = 0 THEN 'n/a' ELSE strftime(ts, '%H:%M:%S') END AS clock
      FROM events)""",
    "abbrev_number": """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'P' THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
            WHEN 'F' THEN concat(tenths // 10, '.', tenths % 10, 'KM')
            ELSE concat(tenths // 10, '.', tenths % 10, 'K') END AS short_price,
       CASE o_orderstatus WHEN 'P' THEN CAST(floor(o_totalprice) AS BIGINT)
            WHEN 'O' THEN tenths * 100 END AS price
FROM (SELECT *, CAST(floor(o_totalprice / 100) AS BIGINT) AS tenths FROM orders)""",
    "nested_to_json": f"""
WITH {BRACKETS}
SELECT domain, CAST(low AS INTEGER) AS min_age, CAST(high AS INTEGER) AS max_age, share FROM ages""",
    "share_map": """
SELECT c_name AS domain, o_orderpriority AS country, round(n / n_all * 100, 2) AS share_percent
FROM (SELECT o_custkey, o_orderpriority, count(*) AS n,
             sum(count(*)) OVER (PARTITION BY o_custkey) AS n_all
      FROM orders GROUP BY 1, 2)
JOIN customer ON o_custkey = c_custkey""",
    "bracket_map": f"""
WITH {BRACKETS}
SELECT domain, label AS bracket, round(share * 100, 2) AS share_percent FROM ages""",
    "own_history": f"""
WITH {MONTHS}
SELECT domain, CAST(month AS VARCHAR) AS month, rank FROM rs""",
    "visits_history_explode": f"""
WITH {MONTHS}
SELECT domain, CAST(month AS VARCHAR) AS month, visits FROM vs""",
    "rank_history_explode": f"""
WITH {MONTHS}
SELECT domain, CAST(month AS VARCHAR) AS month, rank FROM rs""",
    "monthly_visit_changes": f"WITH {MONTHS} {VISIT_CHANGES}",
    "monthly_rank_changes": f"WITH {MONTHS} {RANK_CHANGES}",
    "nation_visit_changes": f"WITH {NATION} {VISIT_CHANGES}",
    "nation_rank_changes": f"WITH {NATION} {RANK_CHANGES}",
    "long_series_changes": """
SELECT domain, event_id, visits, prev_visits,
       round((visits - prev_visits) / nullif(prev_visits, 0) * 100, 2) AS mom_growth_percent
FROM (SELECT *, lag(visits, 1) OVER (PARTITION BY domain ORDER BY ts, event_id) AS prev_visits
      FROM (SELECT event_type AS domain, ts, event_id,
                   CAST(floor(value * 100) AS BIGINT) AS visits FROM events))""",
    "first_last_growth": f"WITH {MONTHS}, {METRICS} SELECT * FROM vg",
    "rank_delta": f"WITH {MONTHS}, {METRICS} SELECT * FROM rc",
    "metrics_join": f"WITH {MONTHS}, {METRICS} SELECT * FROM metrics",
    "rank_desc_nulls_last": f"""
WITH {MONTHS}, {METRICS}
SELECT domain, visit_growth, rank() OVER (ORDER BY visit_growth DESC NULLS LAST) AS visits_rank
FROM vg""",
    "rank_by_month": f"""
WITH {MONTHS}
SELECT domain, CAST(month AS VARCHAR) AS month, visits,
       rank() OVER (PARTITION BY month ORDER BY visits DESC NULLS LAST) AS visits_rank
FROM vs""",
    "rank_text": """
SELECT o_orderkey, o_orderpriority, o_totalprice > 100000 AS large,
       rank() OVER (ORDER BY o_orderpriority DESC NULLS LAST) AS priority_rank,
       rank() OVER (ORDER BY o_totalprice > 100000 DESC NULLS LAST) AS large_rank
FROM orders""",
    "rank_one_column": """
SELECT flag, rank() OVER (ORDER BY flag DESC NULLS LAST) AS flag_rank
FROM (SELECT nullif(l_returnflag, 'R') AS flag FROM lineitem)""",
    "relative_ranking": f"WITH {MONTHS}, {METRICS} SELECT * FROM ranking ORDER BY combined_rank",
    "nation_relative_ranking": f"""
WITH {NATION}, {METRICS} SELECT * FROM ranking ORDER BY combined_rank""",
    "feed_visits_group": f"""
WITH {MONTHS}
SELECT * FROM ({VISIT_CHANGES})
WHERE visits IS NOT NULL AND domain IN ({GROUP_SQL}) ORDER BY month, domain""",
    "feed_visits_single": f"""
WITH {MONTHS}
SELECT * FROM ({VISIT_CHANGES})
WHERE visits IS NOT NULL AND domain = '{SINGLE}' ORDER BY month""",
    "feed_rank_group": f"""
WITH {MONTHS}
SELECT * FROM ({RANK_CHANGES}) WHERE domain IN ({GROUP_SQL}) ORDER BY month, domain""",
    "feed_rank_single": f"""
WITH {MONTHS}
SELECT * FROM ({RANK_CHANGES}) WHERE domain = '{SINGLE}' ORDER BY month""",
    "feed_growth_sign": f"""
WITH {MONTHS}, {METRICS}
SELECT domain, visit_growth, {SIGN.format("visit_growth")} AS sign
FROM metrics WHERE visit_growth IS NOT NULL ORDER BY visit_growth DESC""",
    "feed_rank_split": f"""
WITH {MONTHS}, {METRICS}
SELECT domain, rank_change,
       CASE WHEN abs(rank_change) < {EXTREME} THEN 'normal' ELSE 'extreme' END AS band,
       {SIGN.format("rank_change")} AS sign
FROM metrics WHERE rank_change IS NOT NULL""",
    "feed_combined": f"""
WITH {MONTHS}, {METRICS}
SELECT domain, visit_growth, rank_change, combined_rank FROM ranking ORDER BY combined_rank""",
    "feeds_of_report": f"""
WITH {MONTHS}, {METRICS},
long(feed, domain, value) AS (
  SELECT 'growth', domain, visit_growth FROM metrics WHERE visit_growth IS NOT NULL
  UNION ALL SELECT 'rank_change', domain, rank_change FROM metrics WHERE rank_change IS NOT NULL
  UNION ALL SELECT 'combined', domain, combined_rank FROM ranking
  UNION ALL SELECT 'visits_group', domain, visits FROM vs WHERE visits IS NOT NULL AND domain IN ({GROUP_SQL})
  UNION ALL SELECT 'visits_single', domain, visits FROM vs WHERE visits IS NOT NULL AND domain = '{SINGLE}'
  UNION ALL SELECT 'rank_group', domain, rank FROM rs WHERE domain IN ({GROUP_SQL})
  UNION ALL SELECT 'rank_single', domain, rank FROM rs WHERE domain = '{SINGLE}')
SELECT feed, domain, CAST(value AS DOUBLE) AS value FROM long""",
    "csv_roundtrip": f"""
WITH {DOCS}
SELECT CASE WHEN ends_with(domain, '0') THEN concat(domain, chr(10), 'the "second", line', chr(13)) ELSE domain END AS domain,
       global_rank, total_visits, bounce_rate_raw, bounce_rate_percent, pages_per_visit,
       avg_visit_duration_raw, avg_visit_duration_seconds, last_month_change, n_months, n_rivals,
       n_countries, CAST(6 AS BIGINT) AS n_brackets, sum_visits
FROM doc""",
    "table_roundtrip": f"""
WITH {MONTHS} SELECT domain, CAST(month AS VARCHAR) AS month, visits FROM vs""",
    "view_registry": f"""
WITH {MONTHS},
outcomes AS (
  SELECT c_name, {OUTCOME} AS outcome FROM pages LEFT JOIN customer ON page_id = c_custkey
),
good AS (SELECT c_name FROM outcomes WHERE outcome = 'good'),
entries AS (SELECT domain FROM rs JOIN good ON domain = c_name)
SELECT 'rejects' AS view, count(*) AS n_rows FROM outcomes WHERE outcome <> 'good'
UNION ALL SELECT 'source_data', count(*) FROM good
UNION ALL SELECT 'transformed_data', count(*) FROM good
UNION ALL SELECT 'visits_series', count(*) FROM entries
UNION ALL SELECT 'rank_series', count(*) FROM entries
UNION ALL SELECT 'monthly_visit_changes', count(*) FROM entries
UNION ALL SELECT 'monthly_rank_changes', count(*) FROM entries
UNION ALL SELECT 'relative_ranking', count(DISTINCT domain) FROM entries""",
    "report_contents": f"""
WITH {MONTHS},
good AS (
  SELECT c_name FROM (SELECT c_name, {OUTCOME} AS outcome FROM pages LEFT JOIN customer ON page_id = c_custkey)
  WHERE outcome = 'good')
SELECT * FROM ({VISIT_CHANGES}) WHERE domain IN (SELECT c_name FROM good)""",
    "stream_outcomes": f"""
WITH {DOCS}
SELECT CAST(page_id AS VARCHAR) AS url, outcome, CASE WHEN outcome = 'good' THEN domain END AS domain,
       CASE WHEN outcome = 'good' THEN total_visits END AS total_visits
FROM (SELECT page_id, {OUTCOME} AS outcome, domain, total_visits FROM pages LEFT JOIN doc ON page_id = c_custkey)""",
    "completeness_report": f"""
WITH {LABELLED}
SELECT source, count(*) AS n_rows, count(lang) / count(*) AS lang_complete,
       count(quality) / count(*) AS quality_complete, count(toxic) / count(*) AS toxic_complete
FROM docs GROUP BY source""",
    "missing_class": f"""
WITH {LABELLED},
classed AS (
  SELECT source, 'lang' AS field,
         CASE WHEN lang IS NULL THEN 'truly_missing' WHEN lang = 'en' THEN 'implicitly_missing'
              ELSE 'present' END AS class
  FROM docs
  UNION ALL
  SELECT source, 'quality',
         CASE WHEN quality IS NULL AND n_chars < 500 THEN 'expectedly_missing'
              WHEN quality IS NULL THEN 'truly_missing' WHEN quality = 0 THEN 'implicitly_missing'
              ELSE 'present' END
  FROM docs
  UNION ALL
  SELECT source, 'toxic',
         CASE WHEN toxic IS NULL THEN 'truly_missing' WHEN toxic = 0 THEN 'implicitly_missing'
              ELSE 'present' END
  FROM docs
)
SELECT source, field, class, count(*) AS n_rows FROM classed GROUP BY ALL""",
    "volume_check": """
WITH split AS (
  SELECT user_id, event_type, count(*) FILTER (day(ts) > 15) AS n_actual,
         count(*) FILTER (day(ts) <= 15) AS n_expected
  FROM events GROUP BY ALL
)
SELECT user_id, event_type, n_actual, n_expected,
       round((n_actual - n_expected) / nullif(n_expected, 0), 4) AS deviation,
       coalesce(abs((n_actual - n_expected) / nullif(n_expected, 0)) > 0.5, true) AS alert
FROM split""",
    "latest_snapshot": """
SELECT event_id, user_id, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC, event_id DESC) AS nth
      FROM (SELECT event_id, CASE WHEN event_id % 20 <> 3 THEN user_id END AS user_id, event_type, value, props,
                   date_trunc('day', ts) AS day FROM events))
WHERE nth = 1 OR user_id IS NULL""",
    "variant_paths": """
WITH shares AS (
  SELECT o_custkey, o_orderpriority AS p, count(*) / sum(count(*)) OVER (PARTITION BY o_custkey) AS share,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS place
  FROM orders GROUP BY 1, 2)
SELECT c_name AS site, a.p AS first_country, a.share AS first_share, b.p AS third_country,
       c_acctbal / 1000 AS pages, CAST(65 AS INTEGER) AS oldest_from, CAST(NULL AS VARCHAR) AS nothing
FROM customer
LEFT JOIN shares a ON a.o_custkey = c_custkey AND a.place = 1
LEFT JOIN shares b ON b.o_custkey = c_custkey AND b.place = 3""",
    "variant_own_types": """
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING' WHEN 2 THEN 'ARRAY<VARIANT>' END AS kind,
       CASE WHEN event_id % 4 = 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 4 = 2 THEN CAST(7 AS BIGINT) END AS second
FROM events""",
    "page_file_scan": """
SELECT md5(html || chr(10)) AS digest, CAST(octet_length(encode(html)) + 1 AS BIGINT) AS n_bytes FROM pages""",
    "stream_repeats": f"""
SELECT CAST(page_id AS VARCHAR) AS url, {OUTCOME} AS outcome, CAST(1 AS BIGINT) AS n_parsed,
       CAST(count(*) OVER () AS BIGINT) AS n_counted
FROM pages LEFT JOIN customer ON page_id = c_custkey""",
    "weekly_release": f"WITH {MONTHS} {VISIT_CHANGES}",
    "missing_by_rules": f"""
WITH {LABELLED},
spelled AS (SELECT *, CASE lang WHEN 'en' THEN '' WHEN 'fr' THEN NULL ELSE lang END AS tongue FROM docs),
classed AS (
  SELECT source, 'lang' AS field,
         CASE WHEN tongue <> '' THEN 'present' WHEN n_chars >= 5000 THEN 'mixed'
              WHEN tongue IS NULL THEN 'expectedly_missing' ELSE 'implicitly_missing' END AS class
  FROM spelled
  UNION ALL
  SELECT source, 'quality',
         CASE WHEN quality IS NULL AND n_chars <= 499 THEN 'expectedly_missing'
              WHEN quality IS NULL AND source = 'src3' THEN 'not_asked'
              WHEN quality IS NULL THEN 'truly_missing' WHEN quality = 0 THEN 'implicitly_missing' ELSE 'present' END
  FROM docs
  UNION ALL
  SELECT source, 'toxic',
         CASE WHEN toxic IS NULL THEN 'truly_missing' WHEN toxic = 0 THEN 'implicitly_missing' ELSE 'present' END
  FROM docs)
SELECT source, field, class, count(*) AS n_rows FROM classed GROUP BY ALL""",
    "observed_volumes": """
WITH found AS (
  SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_totalprice < 60000) AS cheap,
         count(*) FILTER (o_custkey IS NULL) AS nobody, min(o_orderkey) AS first_key FROM orders)
SELECT metric, CAST(value AS DOUBLE) AS value, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high,
       CASE WHEN value IS NULL THEN low IS NOT NULL OR high IS NOT NULL
            ELSE coalesce(value < low, false) OR coalesce(value > high, false) END AS alert
FROM (SELECT 'rows' AS metric, n AS value, 1 AS low, NULL AS high FROM found
      UNION ALL SELECT 'finished', finished, NULL, 10 FROM found
      UNION ALL SELECT 'cheap', cheap, NULL, NULL FROM found
      UNION ALL SELECT 'without_customer', nobody, 0, 0 FROM found
      UNION ALL SELECT 'first_key', first_key, NULL, NULL FROM found
      UNION ALL SELECT 'unknown', NULL, 1, NULL)""",
    "completeness_batches": f"""
WITH {LABELLED}
SELECT source, field, count(*) AS n_rows, count(value) AS n_values, count(value) / count(*) AS complete
FROM (SELECT source, 'lang' AS field, lang AS value FROM docs
      UNION ALL SELECT source, 'quality', CAST(quality AS VARCHAR) FROM docs
      UNION ALL SELECT source, 'toxic', CAST(toxic AS VARCHAR) FROM docs)
GROUP BY source, field""",
    "merge_sources": """
WITH docs AS (
  SELECT CASE WHEN doc_id % 50 <> 7 THEN doc_id END AS k, doc_id, nullif(lang, 'fr') AS lang, n_chars
  FROM documents)
SELECT coalesce(k, l.doc_id) AS doc_id, coalesce(d.lang, CASE WHEN l.doc_id IS NOT NULL THEN 'labelled' END) AS lang,
       n_chars, d.doc_id AS tags, quality, toxic,
       concat_ws('+', CASE WHEN d.doc_id IS NOT NULL THEN 'documents' END,
                 CASE WHEN l.doc_id IS NOT NULL THEN 'labels' END) AS sources
FROM docs d FULL JOIN labels l ON d.k = l.doc_id""",
}
