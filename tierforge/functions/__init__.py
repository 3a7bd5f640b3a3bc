"""Column expressions, all evaluated in the JVM."""

from tierforge.functions.casts import cast_leniently, whole_number
from tierforge.functions.cells import NA_TOKENS, csv_line, na_to_null
from tierforge.functions.names import quoted, slug

__all__ = ["NA_TOKENS", "cast_leniently", "csv_line", "na_to_null", "quoted", "slug", "whole_number"]
