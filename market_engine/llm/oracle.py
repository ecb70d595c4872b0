"""The same results in SQL, for DuckDB, where it can express them."""

from __future__ import annotations

from . import fixity, level_products, license_rules, mixing, runs

OP9 = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""

ORACLE: dict[str, str] = {
    "op6_fixity": fixity.ORACLE,
    "op7_license_rules": license_rules.oracle(),
    "op9_exact_dedup": OP9,
    "op10_mixing": mixing.ORACLE,
    "op11_level_products": level_products.ORACLE,
    "op12_runs": runs.ORACLE,
}
