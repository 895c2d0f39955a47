"""Registered queries of this package and their DuckDB statements."""

from encore.llm import (bpe, collocations, exact_dedup, html_text, licenses, near_dedup, packing, pii, quality_classifier,
                        quality_rules, runs, sharding, url_filter)

MODULES = [url_filter, quality_rules, exact_dedup, pii, packing, html_text, near_dedup, bpe, licenses,
           quality_classifier, sharding, runs, collocations]

QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in MODULES for k, v in m.ORACLE.items()}
