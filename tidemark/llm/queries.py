"""Importing this module registers the queries of all operators here."""

from tidemark.llm import (  # noqa: F401
    exact_dedup,
    jaccard_join,
    lexical_search,
    licenses,
    mixing,
    neighbours,
    sentence_pieces,
    simhash,
    substring_dedup,
    token_file,
    toxicity,
    url_rules,
    vector_codes,
)
from tidemark.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
