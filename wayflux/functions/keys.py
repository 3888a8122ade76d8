"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: Column, separator: str = "|") -> Column:
    """md5 over the parts as text.  One NULL part makes the key NULL, so concat_ws is no option."""
    texts = [part.cast("string") for part in parts]
    woven = [texts[0]]
    for text in texts[1:]:
        woven += [F.lit(separator), text]
    return F.md5(F.concat(*woven))
