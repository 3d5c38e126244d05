"""Text columns: slugs and partition values."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_PARTITION = "__unknown__"


@cache
def _ascii_folding() -> dict[str, str]:
    """ASCII text of every character outside ASCII that has one under NFKD."""
    folded = {}
    for code in range(0x80, sys.maxunicode + 1):
        form = unicodedata.normalize("NFKD", chr(code))
        text = form.encode("ascii", "ignore").decode("ascii")
        if text:
            folded[chr(code)] = text
    return folded


def fold_to_ascii(text: Column) -> Column:
    """Compatibility decomposition (NFKD) with everything outside ASCII removed.

    One ``translate`` covers the characters that fold to a single letter, accented
    letters above all.  Those that fold to several letters (ligatures, fractions) take a
    character-wise path, which only texts that still hold such a character enter.
    """
    single = {c: t for c, t in _ascii_folding().items() if len(t) == 1}
    several = {c: t for c, t in _ascii_folding().items() if len(t) > 1}
    translated = F.translate(text, "".join(single), "".join(single.values()))
    lookup = F.from_json(F.lit(json.dumps(several)), "map<string,string>")
    expanded = F.concat_ws(
        "",
        F.transform(
            F.split(translated, ""), lambda c: F.coalesce(F.try_element_at(lookup, c), c)
        ),
    )
    kept = F.when(translated.rlike(r"[^\x00-\x7F]"), expanded).otherwise(translated)
    return F.regexp_replace(kept, r"[^\x00-\x7F]", "")


def slugify(text: Column, separator: str = "_") -> Column:
    """Lower-case ASCII identifier: runs of other characters become one separator."""
    escaped = re.escape(separator)
    replacement = separator.replace("\\", "\\\\").replace("$", "\\$")
    words = F.regexp_replace(F.lower(fold_to_ascii(text)), "[^a-z0-9]+", replacement)
    if not separator:
        return words
    strip = set(separator)
    edge = "".join(re.escape(c) for c in sorted(strip))
    collapsed = F.regexp_replace(words, f"(?:{escaped})+", replacement)
    return F.regexp_replace(collapsed, f"^[{edge}]+|[{edge}]+$", "")


def partition_fallback(value: Column, fallback: str = UNKNOWN_PARTITION) -> Column:
    """Partition value with a fixed stand-in for null, empty and blank text."""
    text = value.cast("string")
    return F.coalesce(F.when(F.trim(text) != "", text), F.lit(fallback))
