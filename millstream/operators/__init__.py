from .cogroup import cogroup, cogroup_join, exclude, flatten
from .combine import CombineFn, combine_globally, combine_per_key
from .elements import (
    chain, filter_equals, filter_in, flat_map, key_value, labelled, map_columns, struct_key,
    tag_constant,
)
from .group_streams import per_group
from .grouping import count_per_key, count_values, fold_groups, group_by_key, having, sum_per_key
from .long_lists import exclude_long
from .pardo import (
    DoFn, Tagged, filter_rows, flat_map_rows, map_rows, par_do, par_do_tagged, tagged_output,
)
from .sessions import session_windows
from .panes import count_panes, pane_state
from .side_inputs import bounded_broadcast, side_list
from .table_functions import TableFn, apply_table, register_table_function
from .tags import output, tag_rows
from .typed import typed
from .windows import fixed_windows, sliding_windows, windowed

__all__ = [
    "CombineFn", "DoFn", "TableFn", "Tagged", "apply_table", "bounded_broadcast", "chain", "cogroup", "cogroup_join", "count_values",
    "combine_globally", "combine_per_key", "count_panes", "count_per_key", "exclude", "exclude_long",
    "filter_equals", "filter_in", "filter_rows", "flat_map_rows", "fixed_windows", "flat_map", "flatten", "fold_groups",
    "group_by_key", "having", "key_value", "labelled", "map_columns", "map_rows", "output", "pane_state",
    "par_do", "par_do_tagged", "per_group", "register_table_function", "session_windows", "side_list", "sliding_windows", "struct_key",
    "sum_per_key", "tag_constant", "tag_rows", "tagged_output", "typed", "windowed",
]
