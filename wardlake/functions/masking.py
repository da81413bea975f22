"""Irreversible digests of identifying text. NULL stays NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: hex characters kept of a digest.
DIGEST_CHARS = 16


def mask_pii(value: Column | str) -> Column:
    """First 16 hex characters of the SHA-256 of the UTF-8 text."""
    text = F.col(value) if isinstance(value, str) else value
    return F.substring(F.sha2(text, 256), 1, DIGEST_CHARS)


def mrn_digest(value: Column | str) -> Column:
    """First 16 hex characters of the MD5, the key Silver and Gold publish."""
    return F.substring(F.md5(value), 1, DIGEST_CHARS)
