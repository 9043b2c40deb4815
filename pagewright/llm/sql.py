"""SQL that DuckDB runs over the same tables, for the queries of this subpackage that SQL can express."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    size = "CASE unit WHEN 'bytes' THEN strlen(t) ELSE length(t) END"
    texts = "(SELECT doc_id, 'ctext' AS field, ctext AS t FROM section_record UNION ALL SELECT doc_id, 'mtext', mtext FROM section_record)"
    return {
        "p5_found": f"SELECT DISTINCT profile, doc_id FROM {texts} JOIN split_profile USING (field) WHERE {size} > max_size",
        "p5_coverage": f"SELECT profile, doc_id, CAST(max(length(t)) AS INTEGER) AS covered, true AS within, true AS joined FROM {texts} JOIN split_profile USING (field) WHERE {size} > max_size GROUP BY ALL",
        "p6_assigned": """SELECT profile, count(DISTINCT doc_id) AS n_texts, 0 AS n_again, 0 AS n_wrong FROM pack_profile, documents WHERE length(text) > 0 GROUP BY profile""",
        "p8_totals": "SELECT source, count(DISTINCT doc_id) AS n_texts, true AS agrees FROM documents WHERE length(text) > 0 GROUP BY source",
    }
