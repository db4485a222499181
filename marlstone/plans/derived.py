"""Tables derived from the driver's ones, in SQL that both engines read.

The data hold no claims, facts, versions, files or captured queries of their own; these views give
timeline entries, pages and events the columns of such tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table

_ENTRY = "(SELECT DISTINCT id, page_id, date, source, summary, created_at FROM {timeline_entries})"
VIEWS = {
    "claims": f"""SELECT id, page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY id) AS INT) AS row_num, summary AS claim, coalesce(nullif(source, ''), 'note') AS kind,
concat('holder-', CAST(id % 7 AS STRING)) AS holder, CAST(id % 21 AS DOUBLE) / 20 AS weight, date AS since_date, id % 5 <> 0 AS active,
CASE id % 3 WHEN 0 THEN 'market' WHEN 1 THEN 'team' ELSE 'product' END AS domain,
CASE WHEN id % 4 < 3 THEN CASE id % 5 WHEN 0 THEN 'incorrect' WHEN 1 THEN 'partial' WHEN 2 THEN 'unresolvable' ELSE 'correct' END END AS quality, created_at FROM {_ENTRY} e""",
    "facts": f"""SELECT id, page_id AS entity_id, summary AS fact, coalesce(nullif(source, ''), 'note') AS kind, date AS valid_from, CASE WHEN id % 6 = 0 THEN CAST(date + INTERVAL 30 DAY AS DATE) END AS valid_until,
CASE WHEN id % 7 = 0 THEN created_at END AS expired_at, CASE WHEN id % 14 = 0 THEN id + 1 END AS superseded_by, 0.5 + CAST(id % 6 AS DOUBLE) / 10 AS confidence,
CASE id % 4 WHEN 0 THEN 'revenue' WHEN 1 THEN 'headcount' END AS metric, CASE WHEN id % 4 < 2 THEN CAST(length(summary) * 10 + id % 100 AS DOUBLE) END AS amount,
concat('session-', CAST(id % 50 AS STRING)) AS session, created_at FROM {_ENTRY} e""",
    "files": "SELECT DISTINCT id AS page_id, source_id, slug AS page_slug, import_filename AS filename, concat(source_id, '/', slug, '/', import_filename) AS storage_path, length(compiled_truth) AS size FROM {pages} WHERE import_filename IS NOT NULL",
    "captured": "SELECT event_id AS id, event_type AS tool, props AS query, ts AS created_at, user_id AS client, CAST(value AS DOUBLE) AS latency FROM {events}",
}


def _tables(text: str) -> list[str]:
    return [t for t in ("timeline_entries", "pages", "events") if f"{{{t}}}" in text]


def derived(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived table."""
    return spark.sql(VIEWS[name], **{t: table(spark, folder, t) for t in _tables(VIEWS[name])})


def sql(name: str) -> str:
    """Its SQL over the driver's tables, in brackets."""
    text = VIEWS[name]
    for t in _tables(text):
        text = text.replace(f"{{{t}}}", t)
    return f"({text})"
