"""The queries of this subpackage for the driver's entry module, and SQL for those that SQL can express."""

from __future__ import annotations

from . import ann, byte_bpe, license_scan, packing, quality_classifier, quality_rules, secret_scan, simhash_dedup, toxicity, url_filter

QUERIES = {f.__name__: f for f in (
    license_scan.op1_license_scan, packing.op2_packing, url_filter.op3_url_filter, simhash_dedup.op4_simhash_dedup, toxicity.op5_toxicity, secret_scan.op6_secret_scan,
    quality_rules.op7_quality_rules, byte_bpe.op8_byte_bpe, ann.op9_ann, quality_classifier.op10_quality_classifier,
)}
ORACLE_SQL: dict[str, str] = {"op3_url_filter": url_filter.OP3_SQL, "op7_quality_rules": quality_rules.OP7_SQL}
