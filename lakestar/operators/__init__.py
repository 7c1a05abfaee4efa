from lakestar.operators.bucketed import Bucketed, bucketed_join, open_bucketed, write_bucketed
from lakestar.operators.conform import (
    conform,
    copy_columns,
    drop_columns,
    filter_equal,
    filter_gt,
    rename,
    with_column,
)
from lakestar.operators.dedupe import collect_distinct, dedupe
from lakestar.operators.joins import join_members, lookup_join, profile_lookup
from lakestar.operators.keys import assert_unique_key, content_key, key_expression, surrogate_key
from lakestar.operators.layout import clustered, morton_code
from lakestar.operators.registry import registered_key
from lakestar.operators.star import (
    Computed,
    Lookup,
    build_fact,
    dimension,
    dimension_from_fact,
    link_dimension,
    resolve_fk,
)

__all__ = [
    "Bucketed",
    "Computed",
    "Lookup",
    "assert_unique_key",
    "bucketed_join",
    "build_fact",
    "clustered",
    "collect_distinct",
    "conform",
    "content_key",
    "copy_columns",
    "dedupe",
    "dimension",
    "dimension_from_fact",
    "drop_columns",
    "filter_equal",
    "filter_gt",
    "join_members",
    "key_expression",
    "link_dimension",
    "lookup_join",
    "morton_code",
    "open_bucketed",
    "profile_lookup",
    "registered_key",
    "rename",
    "resolve_fk",
    "surrogate_key",
    "with_column",
    "write_bucketed",
]
