"""Operators of a training-data pipeline, and their queries."""

from __future__ import annotations

from fathomkit.llm import (  # noqa: F401
    divergence, hamming, jaccard, language, mixing, packing, personal, quality, secrets, spelling, tokencount, toxicity,
    warc,
)
from fathomkit.llm.jobs import ORACLES, QUERIES  # noqa: F401
