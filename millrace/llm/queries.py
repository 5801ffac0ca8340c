"""All queries of this subpackage; importing the operators registers them."""

from millrace.llm import brown_lm, dedup_exact, fill_middle, language, mixing, ngram_join, packing, page_text, pii, quality_rules, ranked_search, secret_scan, toxicity  # noqa: F401
from millrace.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
