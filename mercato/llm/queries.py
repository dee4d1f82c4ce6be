"""All registered queries; importing this module imports every operator."""

from mercato.llm import exact_dedup, importance, language_id, lexical_search, license_scan, line_labels, line_runs, mixing, ngram_join, ordinal_quality, packing, repeated_passages, simhash  # noqa: F401  registered on import
from mercato.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
