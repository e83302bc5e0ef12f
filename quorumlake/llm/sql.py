"""DuckDB statements for those queries of this subpackage that SQL can express over whole tables."""

ORACLE = {
    "p2_found": """
        SELECT doc_id, CAST(CASE WHEN regexp_matches(text, '[^\\s\\x0b\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]{1000}[^\\s\\x0b\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]{401}') THEN 0 ELSE 1 END AS INTEGER) AS at_space
        FROM documents WHERE length(text) > 1400
    """,
}
