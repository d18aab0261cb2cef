"""Hash column functions.

Lowercase hex digests of the UTF-8 text; empty or null input hashes to ''
(not to the digest of the empty string).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_or_empty(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("")).otherwise(F.md5(text))


def sha256_or_empty(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("")).otherwise(F.sha2(text, 256))


def link_hash(link: Column) -> Column:
    """MD5 of the link: the article de-duplication key."""
    return md5_or_empty(link)


def content_hash(content: Column) -> Column:
    """SHA-256 of the content."""
    return sha256_or_empty(content)


def article_id(link_hash_col: Column, fallback_key: Column) -> Column:
    """Deterministic id, stable across re-runs: the whole link hash, or - for
    rows without a link (never de-duplicated) - the digest of a unique fallback key."""
    return F.when(link_hash_col != "", link_hash_col).otherwise(F.md5(fallback_key))
