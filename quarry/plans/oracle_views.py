"""DuckDB definitions of the adapters in :mod:`quarry.sources.adapters`, as
CTE text to prefix oracle queries with (``WITH <views> SELECT ...``)."""

from __future__ import annotations

DIRTY_DOCS = """dirty_docs AS (
  SELECT doc_id, lang, source,
    CASE WHEN doc_id % 7 = 0 THEN '　' || chr(9) || t4 ELSE t4 END AS text
  FROM (SELECT *, CASE WHEN doc_id % 17 = 0 THEN t3 || chr(10) || chr(10) || chr(10) || chr(10) || '  x' ELSE t3 END AS t4
  FROM (SELECT *, CASE WHEN doc_id % 13 = 0 THEN '<p>' || t2 || '</p>' ELSE t2 END AS t3
  FROM (SELECT *, CASE WHEN doc_id % 11 = 0 THEN substr(t1, 1, 10) || chr(1) || substr(t1, 11) ELSE t1 END AS t2
  FROM (SELECT doc_id, lang, source, CASE WHEN doc_id % 97 = 0 THEN '    ' ELSE text END AS t1 FROM documents)))))"""
