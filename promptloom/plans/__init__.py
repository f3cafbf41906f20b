"""The registered queries, each with its DuckDB counterpart where SQL can express it."""

from . import (  # noqa: F401
    batch, chats, index, instructions, media, models, moderation, responses, retrieval, streams, tables, vocabularies,
)
from .registry import QUERIES  # noqa: F401
