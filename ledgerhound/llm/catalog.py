"""All queries of this subpackage: importing the operators fills the registry."""

from __future__ import annotations

from . import align, bm25, bpe, collocations, decontaminate, exact_dedup, langid, mixing, quality, shards, simhash, suffix_dedup, url_filter  # noqa: F401
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
