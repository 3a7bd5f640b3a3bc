"""DataFrame-to-DataFrame operators."""

from tierforge.operators.conform import add_audit, conform
from tierforge.operators.dedupe import are_spread, dedupe_on_keys, require_unique
from tierforge.operators.merge import key_predicate, merge_rows, unique_rows
from tierforge.operators.quality import require_not_null, split_not_null
from tierforge.operators.summary import Sum, flag_orphans, summarise_with_lookup

__all__ = [
    "Sum",
    "add_audit",
    "are_spread",
    "conform",
    "dedupe_on_keys",
    "flag_orphans",
    "key_predicate",
    "merge_rows",
    "require_not_null",
    "require_unique",
    "split_not_null",
    "summarise_with_lookup",
    "unique_rows",
]
