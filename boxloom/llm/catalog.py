"""All registered queries of this subpackage."""

from boxloom.llm import conversations, curriculum, embedding_dedup, fingerprints, hard_negatives, licenses, line_dedup, near_dedup, quality, secrets, sentence_pieces, token_counts, toxicity  # noqa: F401
from boxloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
