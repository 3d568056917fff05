"""DuckDB SQL for the queries of this subpackage that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES = {
    "op1_exact_dedup": f"""
        WITH rows AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS content FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
        FROM rows WINDOW same AS (PARTITION BY content)
    """,
}
