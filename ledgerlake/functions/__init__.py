"""Column functions (P1-P33, D1-D2 of the survey)."""
from .hexnum import (amount_cols, bucket1000, decimal_adjust, epoch_ts, hex_epoch_ts, hex_to_bigint,
                     hex_to_decimal, hex_to_int, hex_to_string, int_to_hex, to_gwei, tx_fee_precise)
from .json import as_variant, jabsent, jarray, jget, jnode, jpresent, jsize, jstr_at, json_text
from .keys import (batch_no, greatest_ts, json_array, json_obj, json_str, lit_ts, non_empty_hex, nullif_empty, path_partition_key, row_in_batch,
                   rpc_payload, selector, status_bool, surrogate_key)
from .sqlreg import register_sql_functions

__all__ = [n for n in dir() if not n.startswith("_")]
