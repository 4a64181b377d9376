"""Every query of the subpackage (importing the modules registers them)."""

from reportlake.llm import conversation_queries, duplicate_queries, native_queries, search_queries, text_queries, token_queries  # noqa: F401
from reportlake.llm.registry import ORACLES, QUERIES  # noqa: F401
