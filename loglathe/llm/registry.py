"""The queries of this folder."""

from loglathe.llm import (  # noqa: F401
    conversation_repair,
    decontaminate,
    hmm_scoring,
    language_id,
    mixing,
    near_dedup,
    pii,
    pu_quality,
    quality_lines,
    secrets_scan,
    sharding,
    spelling,
    token_files,
)
from loglathe.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
