"""DuckDB SQL for each registered query, over the same whole tables."""

_COLUMNS = "lname, fname, time_of_arrival, appt_scheduled_time, meeting_location, info_comment"
_NAMES = _COLUMNS.split(", ")

_VISITS = """
visits AS (
  SELECT event_id,
    CASE WHEN event_id % 97 <> 0 THEN 'L' || (user_id % 40) END AS lname,
    CASE WHEN event_id % 89 = 0 THEN '  ' ELSE 'F' || (user_id % 7) END AS fname,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '   '
      ELSE strftime(ts, '%m/%d/%Y %H:%M') END AS time_of_arrival,
    CASE WHEN event_id % 17 <> 0 THEN
      strftime(date_trunc('hour', ts + INTERVAL 30 MINUTE), '%m/%d/%Y %H:%M')
      END AS appt_scheduled_time,
    CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 10 < 7 THEN 'WH'
      ELSE 'OEOB' END AS meeting_location,
    CASE event_type WHEN 'purchase' THEN 'POTUS' WHEN 'error' THEN 'potus'
      ELSE upper(event_type) END AS visitee,
    CASE event_id % 12 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'GEN RECEP'
      WHEN 3 THEN 'General Reception' WHEN 4 THEN 'gen. recep 2'
      WHEN 5 THEN 'GENERAL  RECEPTION/' WHEN 6 THEN 'OPERATIONS' WHEN 7 THEN '   '
      ELSE 'TOUR ' || (event_id % 23) END AS info_comment
  FROM events)"""

_REFINED = f"WITH {_VISITS}, refined AS (SELECT * FROM visits WHERE visitee = 'POTUS')"

_NO_NULL = " AND ".join(f"{c} IS NOT NULL" for c in _NAMES)
_CLEAN = f"""{_NO_NULL} AND trim(lname) <> '' AND trim(fname) <> ''
  AND trim(time_of_arrival) <> '' AND trim(info_comment) <> ''"""

_MATCHES = "regexp_matches(upper(info_comment), 'GEN.*RECEP|GENERAL.*RECEPTION')"


def _ts(column, clock="12h"):
    if clock == "12h":
        return f"try_strptime({column} || ' AM', '%m/%d/%Y %I:%M %p')"
    return f"try_strptime({column}, '%m/%d/%Y %H:%M')"


def _parts(clock="12h"):
    ts = _ts("time_of_arrival", clock)
    return ", ".join(
        f"CAST({part}({ts}) AS INTEGER) AS visit_{part}" for part in ("year", "month", "hour")
    )


def _export(clock="12h"):
    """Clean rows with time parts, as relation ``exported`` with ``event_id``."""
    return f"""{_REFINED}, exported AS (
      SELECT event_id, {_COLUMNS}, {_parts(clock)} FROM refined WHERE {_CLEAN})"""


def _gap(clock="12h"):
    start, end = _ts("appt_scheduled_time", clock), _ts("time_of_arrival", clock)
    return f"date_diff('minute', {start}, {end})"


def _percent(part, total):
    return f"round(CAST({part} AS DOUBLE) / nullif({total}, 0) * 100, 4)"


def _visitor(direction, clock="12h", extra=""):
    nulls = "ASC NULLS FIRST" if direction == "first" else "DESC NULLS LAST"
    return f"""{_REFINED} SELECT {_COLUMNS} FROM refined
      WHERE trim(time_of_arrival) <> '' {extra}
      ORDER BY {_ts("time_of_arrival", clock)} {nulls}, event_id LIMIT 1"""


def _published_visitor(direction):
    """Ties go to the smaller row, column by column."""
    nulls = "ASC NULLS FIRST" if direction == "first" else "DESC NULLS LAST"
    ties = ", ".join(f"{c} ASC NULLS FIRST" for c in _NAMES)
    return f"""{_REFINED} SELECT {_COLUMNS} FROM refined WHERE trim(time_of_arrival) <> ''
      ORDER BY {_ts("time_of_arrival")} {nulls}, {ties} LIMIT 1"""


def _share(source, head):
    return f"""{head} SELECT meeting_location, count(*) AS count,
      {_percent("count(*)", f"(SELECT count(*) FROM {source})")} AS percent
      FROM {source} GROUP BY meeting_location"""


def _frequent(source, column, k, order, where="TRUE", head=_REFINED):
    return f"""{head} SELECT {column}, count(*) AS count FROM {source}
      WHERE {where} GROUP BY {column}
      ORDER BY count(*) {order}, {column} ASC NULLS FIRST LIMIT {k}"""


def _named(source):
    return f"(SELECT fname || ' ' || lname AS visitor_full_name FROM {source})"


def _null_counts(columns, source):
    return ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in columns) + f" FROM {source}"


def _null_rows(columns, source):
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    nulls = f"count(*) FILTER (NOT ({complete}))"
    return f"""SELECT count(*) AS total_rows, count(*) FILTER ({complete}) AS clean_rows,
      {nulls} AS null_rows, {_percent(nulls, "count(*)")} AS percent_null FROM {source}"""


def _gap_hist(clock="12h", source="refined"):
    head = _REFINED if source == "refined" else _export(clock)
    return f"""{head}, gaps AS (SELECT {_gap(clock)} AS gap FROM {source})
      SELECT CAST(floor(gap / 15.0) * 15 AS BIGINT) AS gap_bin, count(*) AS count
      FROM gaps WHERE gap IS NOT NULL GROUP BY 1"""


def _kpis(clock="12h"):
    return f"""{_export(clock)}, peak AS (
        SELECT visit_year, visit_month, count(*) AS n FROM exported
        WHERE visit_month IS NOT NULL GROUP BY 1, 2
        ORDER BY n DESC, visit_year, visit_month LIMIT 1)
      SELECT count(*) AS total_visits,
        (SELECT visit_year FROM peak) AS peak_year,
        (SELECT visit_month FROM peak) AS peak_month,
        (SELECT n FROM peak) AS peak_visits,
        round(avg({_gap(clock)}), 4) AS avg_gap_minutes FROM exported"""


def _pages(columns, order):
    return f"""SELECT {columns}, r + 1 AS sheet_row, r // 1000 AS batch_id,
      r // 1000 * 1000 + 1 AS start_row
      FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS r FROM %s)"""


_CELLS = ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '') AS {c}"
    for c in [*_NAMES, "visit_year", "visit_month", "visit_hour"]
)
_REFINED_ROWS = f"{_REFINED} SELECT {_COLUMNS} FROM refined"
_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()
_SPLIT = """count(*) AS raw_rows, count(*) FILTER ({0}) AS kept_rows,
  count(*) - count(*) FILTER ({0}) AS filtered_out"""
_POTUS = "visitee = 'POTUS'"
_NOT_EMPTY = "info_comment <> ''"
_EMPTY = "info_comment IS NULL OR info_comment = ''"
_PART_MATCH = "regexp_matches(upper(p_name), 'RED|RING')"

_TOP_COMMENTS = _frequent("refined", "info_comment", 10, "DESC", _NOT_EMPTY)
_LEAST_COMMENTS = _frequent("refined", "info_comment", 10, "ASC", _NOT_EMPTY)
_TOP_VISITORS = _frequent(_named("refined"), "visitor_full_name", 20, "DESC")


def _published(name, sql):
    return f"""SELECT '{name}' AS analysis, count(*) AS row_count,
      CAST(sum(count) AS BIGINT) AS visit_count FROM ({sql})"""


ORACLE = {
    "visits_refined": _REFINED_ROWS,
    "refine_counts": f"WITH {_VISITS} SELECT {_SPLIT.format(_POTUS)} FROM visits",
    # An empty field of a CSV file is read as NULL.
    "stored_refined": f"""{_REFINED} SELECT * EXCLUDE (event_id, visitee)
      REPLACE (nullif(info_comment, '') AS info_comment) FROM refined""",
    "stored_refined_compact": _REFINED_ROWS,
    "refine_written_counts": f"""WITH {_VISITS} SELECT {_SPLIT.format(_POTUS)},
      count(*) FILTER ({_POTUS}) AS written_rows, TRUE AS complete FROM visits""",
    "written_check": f"""{_REFINED} SELECT count(*) AS written_rows, count(*) AS expected_rows,
      TRUE AS rows_match, TRUE AS schema_matches FROM refined""",
    "landed_log": f"WITH {_VISITS} SELECT * FROM visits",
    "landed_documents": "SELECT * FROM documents",
    "first_visitor": _visitor("first"),
    "first_visitor_24h": _visitor("first", "24h"),
    "first_visitor_parsed": _visitor(
        "first", extra=f"AND {_ts('time_of_arrival')} IS NOT NULL"
    ),
    "last_visitor": _visitor("last"),
    "last_visitor_24h": _visitor("last", "24h"),
    "top_comments": _TOP_COMMENTS,
    "least_comments": _LEAST_COMMENTS,
    "variation_rate": f"""{_REFINED} SELECT count(*) AS total_rows,
      count(*) FILTER ({_MATCHES}) AS matching_rows,
      {_percent(f"count(*) FILTER ({_MATCHES})", "count(*)")} AS percent FROM refined""",
    "variation_values": f"""{_REFINED} SELECT DISTINCT info_comment FROM refined
      WHERE {_MATCHES} ORDER BY info_comment LIMIT 30""",
    "top_visitors": _TOP_VISITORS,
    "top_visitors_named": _frequent(
        _named("refined"), "visitor_full_name", 20, "DESC", "visitor_full_name IS NOT NULL"
    ),
    "null_row_profile": f"{_REFINED} {_null_rows(_NAMES, 'refined')}",
    "null_counts": f"{_REFINED} SELECT {_null_counts(_NAMES, 'refined')}",
    "null_flags": f"{_REFINED} SELECT "
    + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in _NAMES)
    + " FROM refined",
    "missing_purpose_rate": f"""{_REFINED} SELECT count(*) FILTER ({_EMPTY}) AS missing_count,
      {_percent(f"count(*) FILTER ({_EMPTY})", "count(*)")} AS percent FROM refined""",
    "missing_purpose_sample": f"""{_REFINED} SELECT fname, lname, time_of_arrival,
      meeting_location FROM refined WHERE {_EMPTY} ORDER BY event_id LIMIT 10""",
    "visit_profile": f"""{_REFINED} SELECT count(*) AS total_rows,
      count(*) FILTER (NOT ({_NO_NULL})) AS null_rows,
      count(*) FILTER ({_EMPTY}) AS missing_purpose,
      count(*) FILTER ({_MATCHES}) AS variations,
      count(*) FILTER ({_CLEAN}) AS clean_rows, """
    + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in _NAMES)
    + " FROM refined",
    "cleaned_visits": f"{_REFINED} SELECT {_COLUMNS} FROM refined WHERE {_CLEAN}",
    "clean_counts": f"""{_REFINED} SELECT count(*) AS total_rows,
      count(*) FILTER ({_CLEAN}) AS clean_rows,
      count(*) - count(*) FILTER ({_CLEAN}) AS removed_rows FROM refined""",
    "visits_export": f"{_export()} SELECT * EXCLUDE (event_id) FROM exported",
    "visits_export_24h": f"{_export('24h')} SELECT * EXCLUDE (event_id) FROM exported",
    "export_cells": f"{_export()} SELECT {_CELLS} FROM exported",
    "export_batches": f"{_export()} "
    + _pages(f"event_id, {_CELLS}", "event_id") % "exported",
    "export_csv_roundtrip": f"{_export()} SELECT * EXCLUDE (event_id) FROM exported",
    "published_outputs": " UNION ALL ".join(
        [
            _published("least_comments", _LEAST_COMMENTS),
            _published("top_comments", _TOP_COMMENTS),
            _published("top_visitors", _TOP_VISITORS),
        ]
    ),
    "monthly_visits": f"""{_export()} SELECT visit_year, visit_month, count(*) AS count
      FROM exported GROUP BY ALL""",
    "hour_month_heat": f"""{_export()} SELECT visit_hour, visit_month, count(*) AS count
      FROM exported GROUP BY ALL""",
    "hour_month_heat_24h": f"""{_export('24h')} SELECT visit_hour, visit_month,
      count(*) AS count FROM exported GROUP BY ALL""",
    "export_top_visitors": _frequent(
        _named("exported"), "visitor_full_name", 20, "DESC", head=_export()
    ),
    "location_share": _share("refined", _REFINED),
    "export_location_share": _share("exported", _export()),
    "arrival_gap_hist": _gap_hist(),
    "arrival_gap_hist_24h": _gap_hist("24h"),
    "export_arrival_gap_hist": _gap_hist(source="exported"),
    "export_arrival_gap_hist_24h": _gap_hist("24h", "exported"),
    "export_top_comments": _frequent(
        "exported", "info_comment", 10, "DESC", _NOT_EMPTY, head=_export()
    ),
    "visit_kpis": _kpis(),
    "visit_kpis_24h": _kpis("24h"),
    "event_type_counts": f"""SELECT {_SPLIT.format("event_type = 'purchase'")} FROM events""",
    "event_type_share": f"""SELECT event_type, count(*) AS count,
      {_percent("count(*)", "(SELECT count(*) FROM events)")} AS percent
      FROM events GROUP BY event_type""",
    "first_order": "SELECT * FROM orders ORDER BY o_orderdate NULLS FIRST, o_orderkey LIMIT 1",
    "last_shipment": """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
      ORDER BY l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber LIMIT 1""",
    "top_part_names": _frequent("part", "p_name", 10, "DESC", head=""),
    "least_part_names": _frequent("part", "p_name", 10, "ASC", head=""),
    "part_variation_rate": f"""SELECT count(*) AS total_rows,
      count(*) FILTER ({_PART_MATCH}) AS matching_rows,
      {_percent(f"count(*) FILTER ({_PART_MATCH})", "count(*)")} AS percent FROM part""",
    "part_variation_values": f"""SELECT DISTINCT p_name FROM part WHERE {_PART_MATCH}
      ORDER BY p_name LIMIT 30""",
    "top_customer_groups": _frequent(
        "(SELECT c_mktsegment || ' ' || c_nationkey AS segment_nation FROM customer)",
        "segment_nation", 20, "DESC", head="",
    ),
    "monthly_orders": """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
      CAST(month(o_orderdate) AS INTEGER) AS order_month, count(*) AS count
      FROM orders GROUP BY ALL""",
    "document_source_counts": """SELECT lang, source, count(*) AS count
      FROM documents GROUP BY ALL""",
    "lineitem_null_rows": _null_rows(_LINEITEM, "lineitem"),
    "lineitem_null_counts": "SELECT " + _null_counts(_LINEITEM, "lineitem"),
    "order_batches": _pages("o_orderkey, o_orderdate", "o_orderdate, o_orderkey") % "orders",
    "shipment_numbers": """SELECT l_returnflag, l_linestatus, l_shipdate,
      row_number() OVER (ORDER BY l_returnflag, l_linestatus, l_shipdate) AS row_number
      FROM lineitem""",
    "documents_csv_roundtrip": "SELECT * FROM documents",
    # An empty cell is read as NULL.
    "comments_csv_roundtrip": f"""{_REFINED} SELECT nullif(info_comment, '') AS info_comment
      FROM refined""",
}
ORACLE["refine_compact_counts"] = ORACLE["refine_written_counts"]

# What the job publishes: shared forms of the same results.
_SAMPLE_TIES = ", ".join(f"{c} ASC NULLS FIRST" for c in _NAMES)
ORACLE |= {
    "published_first_visitor": _published_visitor("first"),
    "published_last_visitor": _published_visitor("last"),
    "published_missing_purpose_sample": f"""{_REFINED} SELECT fname, lname, time_of_arrival,
      meeting_location FROM refined WHERE {_EMPTY} ORDER BY {_SAMPLE_TIES} LIMIT 10""",
    "published_null_rows": ORACLE["null_row_profile"],
    "published_chart_top_visitors": ORACLE["export_top_visitors"],
    "published_chart_location_share": ORACLE["export_location_share"],
    "published_chart_arrival_gap_hist": ORACLE["export_arrival_gap_hist"],
    "published_chart_top_comments": ORACLE["export_top_comments"],
    **{
        f"published_{n}": ORACLE[n]
        for n in ("top_comments", "least_comments", "variation_rate", "variation_values",
                  "top_visitors", "null_counts", "missing_purpose_rate")
    },
    **{f"published_chart_{n}": ORACLE[n] for n in ("monthly_visits", "hour_month_heat", "visit_kpis")},
}
_CHECKSUM = " || ".join(
    f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    for c in ("fname", "lname", "time_of_arrival", "meeting_location", "event_id")
)
# The same by way of a sketch, and a sample by checksums.
ORACLE |= {
    "missing_purpose_uniform_sample": f"""{_REFINED} SELECT fname, lname, time_of_arrival,
      meeting_location, event_id FROM refined WHERE {_EMPTY} ORDER BY md5('0|' || {_CHECKSUM}) LIMIT 10""",
    "top_visitors_sketched": ORACLE["top_visitors"],
    "top_comments_sketched": ORACLE["top_comments"],
    "top_part_names_sketched": ORACLE["top_part_names"],
    "top_document_sources_sketched": """SELECT source, count(*) AS count FROM documents
      GROUP BY source ORDER BY count DESC, source NULLS FIRST LIMIT 5""",
}
# What is stored day by day must equal what one run over everything gives.
ORACLE |= {
    "content_check": f"""{_REFINED} SELECT count(*) AS written_rows, count(*) AS expected_rows,
      TRUE AS rows_match, TRUE AS schema_matches, TRUE AS content_matches FROM refined""",
    "replaced_refined": ORACLE["visits_refined"],
    "refine_two_batches": ORACLE["stored_refined"],
    "new_file_counts": f"""{_REFINED} SELECT count(*) FILTER (event_id % 2 = 1) AS new_rows,
      count(*) AS all_rows FROM refined""",
    **{
        f"merged_{n}": ORACLE[f"published_chart_{n}"]
        for n in ("monthly_visits", "top_visitors", "arrival_gap_hist", "visit_kpis")
    },
}
