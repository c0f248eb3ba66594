"""The same results in SQL, where SQL can express them over whole tables."""

from __future__ import annotations

#: White space as Python splits it, and the characters of a word.
WS = r"\s\x{1c}-\x{1f}\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORDS = rf"len(regexp_extract_all(coalesce(content, ''), '[^{WS}]+'))"

ORACLE: dict[str, str] = {
    "p3_found": f"""
        SELECT DISTINCT document_id FROM (
            SELECT document_id, token_count, {WORDS} AS n FROM code_documents
            UNION ALL SELECT document_id, token_count, {WORDS} FROM synthetic_documents)
        WHERE token_count IS NULL OR token_count <> n""",
    "p5_found": r"""
        WITH d AS (SELECT DISTINCT document_id, regexp_extract_all(lower(content), '[\p{L}\p{N}_]+') AS w FROM code_documents),
             e AS (SELECT DISTINCT document_id AS item_id, regexp_extract_all(lower(content), '[\p{L}\p{N}_]+') AS w FROM evaluation_documents),
             dw AS (SELECT document_id, hash(list_slice(w, i, i + 39)) AS h, list_slice(w, i, i + 39) AS g
                    FROM (SELECT document_id, w, unnest(range(1, len(w) - 38)) AS i FROM d WHERE len(w) >= 40)),
             ew AS (SELECT item_id, hash(list_slice(w, i, i + 39)) AS h, list_slice(w, i, i + 39) AS g
                    FROM (SELECT item_id, w, unnest(range(1, len(w) - 38)) AS i FROM e WHERE len(w) >= 40))
        SELECT DISTINCT item_id, document_id FROM dw JOIN ew ON dw.h = ew.h AND dw.g = ew.g""",
    "p8_limits": """
        SELECT pack_name, (SELECT count(DISTINCT doc_id) FROM documents WHERE length(text) > 0) AS n_documents,
               0 AS overfull, 0 AS twice, 0 AS split_early, 0 AS missing
        FROM (SELECT DISTINCT pack_name FROM pack_capacities WHERE pack_name IS NOT NULL AND capacity_tokens > 0)
        WHERE (SELECT count(*) FROM documents WHERE length(text) > 0) > 0""",
    "p9_limits": r"""
        WITH t AS (SELECT mix_name, regexp_replace(lower(trim(source)), '[_\s]+', '-', 'g') AS source, max_repeats FROM mix_targets),
             k AS (SELECT mix_name, source, max(coalesce(max_repeats, 0)) AS max_repeats FROM t WHERE mix_name IS NOT NULL AND source <> '' GROUP BY ALL),
             d AS (SELECT regexp_replace(lower(trim(source)), '[_\s]+', '-', 'g') AS source, count(*) AS n FROM documents WHERE length(text) > 0 GROUP BY ALL)
        SELECT mix_name, source, max_repeats, coalesce(n, 0) AS source_docs, 0 AS over, 0 AS unasked FROM k LEFT JOIN d USING (source)""",
}
