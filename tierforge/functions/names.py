"""Expressions on names: sheet slugs and safe column references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) makes \s cover every Unicode blank; the four separators are blank for our purposes too.
_BLANK = r"[\s\x1c-\x1f]+"


def slug(name: Column) -> Column:
    """File-name-safe form: trim, blanks to ``_``, drop the rest outside ``[A-Za-z0-9_.-]``.

    Nothing left (or NULL) becomes ``sheet``.
    """
    # The characters kept, the joiner, and what stands for nothing.
    trimmed = F.regexp_replace(name, rf"(?U)^{_BLANK}|{_BLANK}$", "")
    joined = F.regexp_replace(trimmed, rf"(?U){_BLANK}", "_")
    kept = F.regexp_replace(joined, r"[^A-Za-z0-9_.-]+", "")
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("sheet"))


def quoted(name: str) -> Column:
    """Reference a top-level column whose name may hold dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")
