"""The registered queries as plain SQL over the same tables, for the correctness check.

Written independently of the Spark code where there is a choice: windows are joined in as a
relation, groups are compared by a full outer join, the upsert is an anti join.
"""

from __future__ import annotations

# ---- fact rows ------------------------------------------------------------------------------

_RAW_PLATFORM = """CASE {n} % 6 WHEN 0 THEN ' Google Ads' WHEN 1 THEN 'fb' WHEN 2 THEN 'tik-tok ads'
    WHEN 3 THEN 'adwords' WHEN 4 THEN 'META' ELSE 'bing_ads' END"""

_ADS = f"""ads AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
    {_RAW_PLATFORM.format(n="l_suppkey")} AS platform,
    'acct-' || (l_suppkey % 10) AS account,
    'cmp-' || (l_partkey % 50) AS campaign,
    n_name AS country,
    l_linestatus AS device,
    l_extendedprice AS spend,
    CAST(l_quantity * 10 AS INTEGER) AS clicks,
    CAST(l_quantity * 100 AS INTEGER) AS impressions,
    CAST(l_quantity AS INTEGER) AS conversions,
    l_shipdate + to_days(l_linenumber) AS load_date,
    'lineitem_' || l_linestatus || '.csv' AS source_file_name,
    l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN nation ON n_nationkey = s_nationkey
)"""

_EVENT_ADS = f"""ads AS (
  SELECT CAST(ts AS DATE) AS date, value AS spend, CAST(event_type = 'purchase' AS INTEGER) AS conversions
  FROM events
)"""

_KEY = "date, platform, account, campaign, country, device"
_FACTS = f"{_KEY}, spend, clicks, impressions, conversions, load_date, source_file_name"
_POSITION = "l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, spend DESC, conversions DESC"

# ---- KPIs -----------------------------------------------------------------------------------


def _rolling(days: int) -> str:
    return f"""win AS (
  SELECT top - {days - 1} AS c0, top AS c1, top - {2 * days - 1} AS p0, top - {days} AS p1
  FROM (SELECT max(date) AS top FROM ads)
)"""


def _explicit(start: str, end: str) -> str:
    return f"""win AS (
  SELECT s AS c0, e AS c1, s - CAST(e - s + 1 AS INTEGER) AS p0, e - CAST(e - s + 1 AS INTEGER) AS p1
  FROM (SELECT {start} AS s, {end} AS e FROM (SELECT max(date) AS top FROM ads))
)"""


# Amounts are whole numbers of 0.0001, KPI values whole numbers of 10**-12, all HUGEINT.
_UNITS, _FIXED = 4, 12


def _exact(condition: str) -> str:
    units = f"CAST(CAST(spend AS DECIMAL(18, {_UNITS})) * {10**_UNITS} AS HUGEINT)"
    return f"CAST(sum({units}) FILTER ({condition}) AS HUGEINT)"


def _whole(condition: str) -> str:
    return f"CAST(sum(conversions) FILTER ({condition}) AS HUGEINT)"


def _half(n: str, d: str) -> str:
    """n / d as a whole number, half away from zero; NULL for d = 0."""
    return f"sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // nullif(2 * abs({d}), 0))"


_TOTALS = f"""tot AS (
  SELECT {_exact("date BETWEEN c0 AND c1")} AS s1, {_exact("date BETWEEN p0 AND p1")} AS s0,
         {_whole("date BETWEEN c0 AND c1")} AS n1, {_whole("date BETWEEN p0 AND p1")} AS n0
  FROM ads, win
  WHERE date BETWEEN p0 AND c1
)"""


def _cac(w: int) -> str:
    return _half(f"(s{w} * {10 ** (_FIXED - _UNITS)}::HUGEINT)", f"n{w}")


def _roas(w: int) -> str:
    return _half(f"(n{w} * {100 * 10 ** (_FIXED + _UNITS)}::HUGEINT)", f"s{w}")


_NONZERO = {
    "CAC": (_cac(1), _cac(0)),
    "Conversions": tuple(f"n{w} * {10**_FIXED}::HUGEINT" for w in (1, 0)),
    "ROAS": (_roas(1), _roas(0)),
    "Spend": tuple(f"s{w} * {10 ** (_FIXED - _UNITS)}::HUGEINT" for w in (1, 0)),
}
_POSITIVE = {
    "CAC": tuple(f"CASE WHEN n{w} > 0 THEN {_cac(w)} END" for w in (1, 0)),
    "ROAS": tuple(f"CASE WHEN s{w} > 0 THEN {_roas(w)} END" for w in (1, 0)),
}


def _report(formulas, names, scale, pct_digits, by=(), digits=None) -> str:
    """Cells of all metrics, then the rounded comparison."""
    now, before, change, pct = names
    dims = "".join(f"{c}, " for c in by)
    digits = digits or dict.fromkeys(formulas, 4)
    cells = "\n  UNION ALL ".join(
        f"SELECT {dims}'{m}' AS metric, {digits[m]} AS d, {a} AS x1, {b} AS x0 FROM tot"
        for m, (a, b) in formulas.items()
    )
    def rounded(x, alias):
        cases = " ".join(
            f"WHEN {k} THEN CAST({_half(x, f'{10 ** (_FIXED - k)}::HUGEINT')} AS DOUBLE) / CAST({10**k} AS DOUBLE)"
            for k in sorted(set(digits.values()))
        )
        return f"CASE d {cases} END AS {alias}"

    share = _half(f"((x1 - x0) * {scale * 10**pct_digits}::HUGEINT)", "x0")
    cells = cells.replace("\n", "")
    return f"""cells AS ({cells})
SELECT {dims}metric, {rounded("x1", now)}, {rounded("x0", before)}, {rounded("(x1 - x0)", change)},
  CAST({share} AS DOUBLE) / CAST({10**pct_digits} AS DOUBLE) AS {pct}
FROM cells ORDER BY ALL"""


_COMPACT_NAMES = ("value_current", "value_prior", "abs_delta", "pct_delta")
_METRIC_NAMES = ("value_current", "value_prior", "abs_delta", "delta_pct")
_THIRTY_NAMES = ("last_30_value", "prior_30_value", "delta_abs", "delta_pct")
_THIRTY_DIGITS = {"CAC": 2, "ROAS": 4}


def _metrics(start: str, end: str, names=_METRIC_NAMES) -> str:
    body = _report(_NONZERO, names, 100, 2)
    return f"WITH {_ADS}, {_explicit(start, end)}, {_TOTALS}, {body}"


def _by(dims: dict[str, str], ads: str = _ADS) -> str:
    keys = ", ".join(f"{expr} AS {name}" for name, expr in dims.items())
    half = """{w} AS (
  SELECT {names}, {s} AS s, {n} AS n
  FROM (SELECT {keys}, date, spend, conversions FROM ads), win
  WHERE date BETWEEN {lo} AND {hi} GROUP BY ALL
)"""
    names = ", ".join(dims)
    sums = {"s": _exact("true"), "n": _whole("true")}
    now = half.format(w="l", names=names, keys=keys, lo="c0", hi="c1", **sums)
    before = half.format(w="p", names=names, keys=keys, lo="p0", hi="p1", **sums)
    body = _report(_POSITIVE, _THIRTY_NAMES, 100, 2, by=tuple(dims), digits=_THIRTY_DIGITS)
    return f"""WITH {ads}, {_rolling(30)}, {now}, {before}, tot AS (
  SELECT {names}, l.s AS s1, l.n AS n1, p.s AS s0, p.n AS n0 FROM l FULL JOIN p USING ({names})
), {body}"""


# ---- text -----------------------------------------------------------------------------------


def _initcap(x: str) -> str:
    return (
        f"list_aggregate(list_transform(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '')"
    )


# Spellings, and the name they stand for.
_SPELLINGS = """spellings(spelling, name) AS (VALUES
  ('google', 'Google'), ('google ads', 'Google'), ('googleads', 'Google'), ('adwords', 'Google'),
  ('meta', 'Meta'), ('facebook', 'Meta'), ('fb', 'Meta'), ('facebook ads', 'Meta'), ('fb ads', 'Meta')
)"""
_NAMED_ADS = f"""{_ADS.replace("ads AS (", "raw_ads AS (", 1)}, {_SPELLINGS}, ads AS (
  SELECT raw_ads.* EXCLUDE (platform), platform AS raw, coalesce(name, {_initcap("trim(platform)")}) AS platform
  FROM raw_ads LEFT JOIN spellings ON spelling = lower(trim(platform))
)"""

# ---- ingest ---------------------------------------------------------------------------------

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _event_rows(load_date: str) -> str:
    return f"""SELECT CAST(ts AS DATE) AS date, {_RAW_PLATFORM.format(n="k")} AS platform,
  'user-' || user_id AS account, event_type || '-' || event_id AS campaign,
  CASE WHEN k % 2 = 0 THEN '' ELSE 'US' END AS country, 'Mobile' AS device,
  CAST(round(value * 100, 2) AS DOUBLE) AS spend, CAST(k AS INTEGER) AS clicks,
  CAST(k * 1000 AS INTEGER) AS impressions, CAST(k AS INTEGER) AS conversions,
  TIMESTAMP '{load_date}' AS load_date, 'ads_spend.csv' AS source_file_name
FROM (SELECT *, {_K} AS k FROM events)"""


_DIRTY = f"""dirty AS (
  SELECT event_id, CAST(ts AS DATE) AS date, event_type AS platform, value, k,
    CASE WHEN k < 5 THEN 'date' WHEN k <= 9 THEN 'spend' WHEN k <= 14 THEN 'clicks'
         WHEN k <= 19 THEN 'impressions' WHEN k <= 24 THEN 'conversions' END AS reason
  FROM (SELECT *, {_K} AS k FROM events)
)"""

_FIRST, _SECOND = "2025-07-01 08:00:00", "2025-07-02 08:00:00"

ORACLE: dict[str, str] = {
    "kpi_compact": f"WITH {_ADS}, {_rolling(30)}, {_TOTALS}, {_report(_NONZERO, _COMPACT_NAMES, 1, 4)}",
    "kpi_compact_events_15d": f"WITH {_EVENT_ADS}, {_rolling(15)}, {_TOTALS}, "
    + _report(_NONZERO, _COMPACT_NAMES, 1, 4),
    "kpi_30d_vs_prior": f"WITH {_ADS}, {_rolling(30)}, {_TOTALS}, "
    + _report(_POSITIVE, _THIRTY_NAMES, 100, 2, digits=_THIRTY_DIGITS),
    "kpi_by_platform": _by({"platform": "platform"}, _NAMED_ADS),
    "kpi_by_country_device": _by({"country": "country", "device": "device"}),
    "kpi_summary": f"WITH {_ADS}, {_rolling(30)}, {_TOTALS}, "
    + _report(
        {m: _NONZERO[m] for m in ("CAC", "ROAS")},
        ("last_30", "prior_30", "delta_abs", "delta_pct"),
        100,
        2,
    ),
    "metrics_window": _metrics("DATE '2001-06-01'", "DATE '2001-06-30'"),
    "metrics_window_renamed": _metrics("DATE '2000-01-01'", "DATE '2000-12-31'", _COMPACT_NAMES),
    "metrics_default": _metrics("top - 29", "top"),
    "metrics_start_only": _metrics("DATE '2001-09-01'", "top"),
    "metrics_end_only": _metrics("top - 29", "DATE '2001-03-31'"),
    "metrics_response": "SELECT '[' || string_agg("
    "'{\"metric\":\"' || metric || '\",' || "
    + " || ',' || ".join(
        f"'\"{c}\":' || coalesce(CAST(CAST({c} AS DECIMAL(38, 4)) AS VARCHAR), 'null')"
        for c in _METRIC_NAMES
    )
    + " || '}', ',' ORDER BY metric) || ']' AS response FROM ("
    + _metrics("DATE '2001-06-01'", "DATE '2001-06-30'")
    + ")",
    "ads_daily": f"""WITH {_ADS}
SELECT {_KEY}, spend, clicks, impressions, conversions,
  CASE WHEN conversions > 0 THEN spend / conversions END AS cac,
  CASE WHEN spend > 0 THEN conversions * CAST(100 AS DOUBLE) / spend END AS roas
FROM ads""",
    "ads_daily_view": f"""WITH {_ADS}
SELECT country, device, count(*) AS ads, count(*) FILTER (conversions > 0) AS ads_with_cac,
  round(max(spend / conversions) FILTER (conversions > 0), 4) AS worst_cac,
  round(max(conversions * CAST(100 AS DOUBLE) / spend) FILTER (spend > 0), 4) AS best_roas
FROM ads GROUP BY country, device""",
    "dedupe_latest": f"""WITH {_ADS}
SELECT {_FACTS} FROM ads
QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY load_date DESC NULLS LAST, {_POSITION}) = 1""",
    "duplicate_keys": f"""WITH {_ADS}
SELECT {_KEY}, count(*) AS count FROM ads GROUP BY {_KEY} HAVING count(*) > 1""",
    "upsert_batch": f"""WITH {_ADS}, target AS (
  SELECT * FROM ads WHERE date < DATE '2001-01-01'
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY load_date DESC NULLS LAST, {_POSITION}) = 1
), incoming AS (
  SELECT *, count(*) OVER (PARTITION BY {_KEY}) AS copies FROM ads WHERE date >= DATE '2000-07-01'
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY {_POSITION}) = 1
)
SELECT {_FACTS} FROM target ANTI JOIN incoming USING ({_KEY})
UNION ALL
SELECT {_KEY}, i.spend, i.clicks, i.impressions, i.conversions,
  CASE WHEN i.copies > 1 OR t.spend IS NOT NULL THEN TIMESTAMP '{_SECOND}' ELSE i.load_date END,
  i.source_file_name
FROM incoming i LEFT JOIN target t USING ({_KEY})""",
    "row_count": "SELECT count(*) AS count FROM lineitem",
    "load_batches": f"""WITH {_ADS}
SELECT date_trunc('second', load_date + INTERVAL 500 MILLISECOND) AS load_batch, count(*) AS count
FROM ads GROUP BY 1""",
    "load_batches_subsecond": """SELECT date_trunc('second', ts + INTERVAL 500 MILLISECOND) AS load_batch,
  count(*) AS count FROM events GROUP BY 1""",
    "file_provenance": f"""WITH {_ADS}
SELECT source_file_name AS file, min(load_date) AS first_load, max(load_date) AS last_load,
  count(*) AS rows FROM ads GROUP BY 1""",
    "clean_number_text": """SELECT l_orderkey, l_linenumber,
  CAST(round(l_extendedprice, 2) AS DOUBLE) AS spend,
  CASE WHEN l_quantity > 1 THEN l_quantity * 1000 ELSE CAST(0 AS DOUBLE) END AS clicks,
  CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS impressions,
  CASE WHEN l_linestatus <> 'F' THEN CAST(12 AS DOUBLE) END AS conversions
FROM lineitem""",
    "typed_rows": _event_rows(_FIRST),
    "rejected_rows": f"""WITH {_DIRTY}
SELECT reason, count(*) AS rejected, max(platform || '-' || printf('%010d', event_id)) AS last_campaign
FROM dirty WHERE reason IS NOT NULL GROUP BY reason""",
    "accepted_rows": f"""WITH {_DIRTY}
SELECT date, platform, count(*) AS accepted, round(sum(value), 2) AS spend,
  CAST(count(*) * 7 AS BIGINT) AS clicks, CAST(count(*) * 1000 AS BIGINT) AS impressions,
  CAST(0 AS BIGINT) AS with_conversions
FROM dirty WHERE reason IS NULL GROUP BY date, platform""",
    "period_tags": f"""WITH {_ADS}, {_rolling(30)}
SELECT CASE WHEN date BETWEEN c0 AND c1 THEN 'last' WHEN date BETWEEN p0 AND p1 THEN 'prev' END AS period,
  count(*) AS ads
FROM ads, win GROUP BY 1""",
    "canonical_platforms": f"""WITH {_NAMED_ADS}
SELECT raw, platform, count(*) AS ads FROM ads GROUP BY ALL""",
    "capitalised_text": f"SELECT o_orderkey, {_initcap('o_orderpriority')} AS priority FROM orders",
    "parsed_dates": """SELECT o_orderkey,
  CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END AS day
FROM orders""",
    "ingest_rerun": _event_rows(_SECOND),
    "ingest_metrics": f"WITH ads AS ({_event_rows(_FIRST)}), "
    + _explicit("DATE '2024-01-16'", "DATE '2024-01-30'")
    + f", {_TOTALS}, {_report(_NONZERO, _METRIC_NAMES, 100, 2)}",
    "ingest_streamed": f"SELECT * EXCLUDE (source_file_name) FROM ({_event_rows(_FIRST)})",
    "stored_metrics": f"""WITH {_ADS.replace("ads AS (", "every AS (", 1)}, ads AS (
  SELECT * FROM every
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY {_POSITION}) = 1
), {_explicit("top - 29", "top")}, {_TOTALS}, {_report(_NONZERO, _METRIC_NAMES, 100, 2)}""",
}
ORACLE["kpi_summary_view"] = ORACLE["kpi_summary"]

# ---- cases that the tables do not hold as they are -------------------------------------------

_TIES = """ads AS (
  SELECT CASE WHEN l_linenumber % 2 = 0 THEN DATE '2001-06-30' ELSE DATE '2001-05-31' END AS date,
    CAST(l_orderkey AS VARCHAR) AS campaign, l_extendedprice AS spend, 1 AS conversions
  FROM lineitem
)"""
ORACLE["kpi_by_rounding_ties"] = _by({"campaign": "campaign"}, _TIES)
# A NULL key column matches nothing in the full join, as in the comparison.
_GAPS = _NAMED_ADS.replace("AS platform\n", "AS platform_name\n") + """, gaps AS (
  SELECT ads.* REPLACE (CASE WHEN l_suppkey % 5 = 0 THEN -spend ELSE spend END AS spend),
    CASE WHEN l_partkey % 3 > 0 THEN platform_name END AS platform FROM ads
)"""
ORACLE["kpi_by_platform_gaps"] = _by({"platform": "platform"}, _GAPS).replace("FROM ads), win", "FROM gaps), win")
ORACLE["kpi_30d_refunds"] = (
    f"WITH {_ADS.replace('ads AS (', 'paid AS (', 1)}, ads AS (SELECT * REPLACE (-spend AS spend, "
    f"CASE WHEN l_suppkey % 2 = 0 THEN -conversions ELSE conversions END AS conversions) FROM paid), {_rolling(30)}, {_TOTALS}, "
    + _report(_POSITIVE, _THIRTY_NAMES, 100, 2, digits=_THIRTY_DIGITS)
)
ORACLE["file_provenance_unnamed"] = f"""WITH {_ADS}
SELECT CASE WHEN l_linenumber % 3 = 0 THEN '(null)' ELSE source_file_name END AS file,
  min(load_date) AS first_load, max(load_date) AS last_load, count(*) AS rows FROM ads GROUP BY 1"""
# The join does not match NULLs; of several rows with one key, the one in the table has to be found first.
ORACLE["upsert_null_keys"] = f"""WITH {_ADS.replace("ads AS (", "whole AS (", 1)}, ads AS (
  SELECT * REPLACE (CASE WHEN l_partkey % 4 > 0 THEN platform END AS platform,
    CASE WHEN l_partkey % 7 > 0 THEN date END AS date, CASE WHEN l_partkey % 2 = 0 THEN load_date END AS load_date) FROM whole
), complete AS (SELECT * FROM ads WHERE platform IS NOT NULL AND date IS NOT NULL),
incomplete AS (SELECT * FROM ads WHERE platform IS NULL OR date IS NULL),
target AS (
  SELECT * FROM complete WHERE l_linenumber <= 3
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY load_date DESC NULLS LAST, {_POSITION}) = 1
), incoming AS (
  SELECT *, count(*) OVER (PARTITION BY {_KEY}) AS copies FROM complete WHERE l_linenumber >= 3
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY {_POSITION}) = 1
)
SELECT {_FACTS} FROM target ANTI JOIN incoming USING ({_KEY})
UNION ALL
SELECT {_KEY}, i.spend, i.clicks, i.impressions, i.conversions,
  CASE WHEN i.copies > 1 OR t.spend IS NOT NULL THEN TIMESTAMP '{_SECOND}' ELSE coalesce(i.load_date, TIMESTAMP '{_SECOND}') END,
  i.source_file_name
FROM incoming i LEFT JOIN target t USING ({_KEY})
UNION ALL
SELECT {_FACTS} FROM incomplete WHERE l_linenumber <= 3
UNION ALL
SELECT {_FACTS.replace("load_date", f"coalesce(load_date, TIMESTAMP '{_SECOND}')")} FROM incomplete WHERE l_linenumber >= 3"""

# ---- many windows ----------------------------------------------------------------------------


def _many(windows: str, out: str) -> str:
    """``windows`` selects bounds c0 and c1 beside the columns of ``out``."""
    report = _report(_NONZERO, _METRIC_NAMES, 100, 2, by=("c0", "c1"))
    cells, report = report.replace("ORDER BY ALL", "").split("\n", 1)
    return f"""WITH {_ADS}, days AS (
  SELECT date, {_exact("true")} AS s, {_whole("true")} AS n FROM ads GROUP BY date
), asked AS ({windows}), win AS (
  SELECT *, c0 - CAST(c1 - c0 + 1 AS INTEGER) AS p0, c0 - 1 AS p1 FROM (SELECT DISTINCT c0, c1 FROM asked)
), tot AS (
  SELECT c0, c1, CAST(sum(s) FILTER (date BETWEEN c0 AND c1) AS HUGEINT) AS s1, CAST(sum(s) FILTER (date BETWEEN p0 AND p1) AS HUGEINT) AS s0,
    CAST(sum(n) FILTER (date BETWEEN c0 AND c1) AS HUGEINT) AS n1, CAST(sum(n) FILTER (date BETWEEN p0 AND p1) AS HUGEINT) AS n0
  FROM win LEFT JOIN days ON date BETWEEN p0 AND c1 GROUP BY c0, c1
), {cells}, report AS ({report})
SELECT {out}, metric, {", ".join(_METRIC_NAMES)} FROM asked JOIN report USING (c0, c1)"""


ORACLE["metrics_many"] = _many(
    "SELECT DISTINCT CAST(o_orderdate AS DATE) AS c0, CAST(o_orderdate AS DATE) + 6 AS c1 FROM orders", 'c0 AS "start", c1 AS "end"'
)
ORACLE["metrics_many_requests"] = _many(
    """SELECT o_orderkey AS request_id,
    CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderdate AS DATE) ELSE top - 29 END AS c0,
    CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 3 AS INTEGER)
      WHEN 2 THEN CAST(o_orderdate AS DATE) ELSE top END AS c1
  FROM orders, (SELECT max(date) AS top FROM ads)""",
    "request_id",
)
ORACLE["live_views"] = f"""WITH {_ADS.replace("ads AS (", "every AS (", 1)}, ads AS (
  SELECT * FROM every WHERE date < DATE '2000-07-01'
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY load_date DESC NULLS LAST, {_POSITION}) = 1
  UNION ALL
  SELECT * FROM every WHERE date >= DATE '2000-07-01'
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY {_POSITION}) = 1
), {_rolling(30)}, {_TOTALS}, {_report(_NONZERO, _COMPACT_NAMES, 1, 4).replace("ORDER BY ALL", "").replace("SELECT metric, CASE", "SELECT metric AS name, CASE", 1)}
UNION ALL
SELECT country, round(max(spend / conversions) FILTER (conversions > 0), 4), round(max(conversions * CAST(100 AS DOUBLE) / spend) FILTER (spend > 0), 4),
  CAST(count(*) AS DOUBLE), CAST(count(*) FILTER (conversions > 0) AS DOUBLE)
FROM ads GROUP BY country"""

# ---- stored tables ---------------------------------------------------------------------------

_STORED = """ads AS (
  SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {position}) = 1
)"""
ORACLE["stored_kpi_by_platform"] = _by(
    {"platform": "platform"},
    _NAMED_ADS.replace("raw_ads AS (", "every AS (", 1)
    .replace("FROM raw_ads", "FROM stored")
    .replace("raw_ads.*", "stored.*")
    .replace(f", {_SPELLINGS}", ", " + _STORED.format(key=_KEY, position=_POSITION).replace("ads AS", "stored AS", 1) + f", {_SPELLINGS}"),
)
ORACLE["stored_bounds"] = f"""WITH {_ADS.replace("ads AS (", "every AS (", 1)}, {_STORED.format(key=_KEY, position=_POSITION)}
SELECT count(*) AS rows, min(date) AS oldest, max(date) AS newest FROM ads"""
ORACLE["ingest_rejected"] = f"""WITH {_DIRTY}
SELECT coalesce(reason, 'stored') AS reason, count(*) AS rows, count(DISTINCT event_id) AS campaigns FROM dirty GROUP BY 1"""
ORACLE["ingest_mixed_headers"] = _event_rows(_FIRST)
