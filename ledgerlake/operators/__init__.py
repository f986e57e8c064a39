"""Composable DataFrame operators."""
from .backlog import (missing_keys, block_spine, chain_head, head_delay, lookback_block, newest, number_spine,
                      pack_batches, split_backlog, top_n, update_ledger, with_batch_columns, work_backlog)
from .checks import (childless, counts_match, evaluate, fresh, matches, not_null, one_parent, orphans, scope,
                     sequence_gaps, store_failures, type_in, unique_on)
from .explode import explode_array, explode_json, posexplode_json
from .incremental import add_totals, heal, high_water, since, union_new_and_healed
from .joins import join_keys, lookup
from .latest import latest_per_key, parse_order, sort_columns, top_per_key
from .numbering import global_position, number_within, with_lag
from .setops import (anti, full_outer_norm, in_list, not_in, reemit_groups, run_if_any, spine_join, union_all,
                     union_distinct, with_constants)
from .sinks import add_buckets, key_bounds, upsert, write_table
from .stored import compact_table, read_table, replace_table, upsert_table, vacuum_table
from .tree import (address_text, ancestor_flag, child_counts, flatten_tree, has_error, parent_text,
                   preorder_index, strip_field)
