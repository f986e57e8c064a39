"""SQL fragments shared by the oracle statements (DuckDB dialect).

They restate `chain.py` relationally: the same derivations, written as joins,
window functions and string arithmetic instead of documents and operators.
"""

# decimal string of a non-negative integer expression x shifted n places left
def shift_sql(x: str, n: int) -> str:
    p = "1" + "0" * n + "::HUGEINT"
    ip = f"(({x})::HUGEINT // {p})::VARCHAR"
    fp = f"rtrim(lpad(((({x})::HUGEINT % {p}))::VARCHAR, {n}, '0'), '0')"
    return f"(CASE WHEN {fp} = '' THEN {ip} ELSE {ip} || '.' || {fp} END)"


def hx(x: str) -> str:
    return f"('0x' || lower(hex({x})))"


def addr(x: str) -> str:
    return f"('0x' || lpad(lower(hex({x})), 40, '0'))"


def word(x: str) -> str:
    return f"('0x' || lpad(lower(hex({x})), 64, '0'))"


TX_CTE = f"""
li_n AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey),
tx AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice, o.o_orderdate,
    coalesce(li_n.n_lines, 0)::BIGINT AS n_lines,
    (o.o_orderkey // 20)::BIGINT AS block_number,
    (row_number() OVER (PARTITION BY o.o_orderkey // 20 ORDER BY o.o_orderkey) - 1)::BIGINT AS tx_position,
    '0x' || md5(o.o_orderkey::VARCHAR) AS tx_hash,
    {addr('o.o_custkey')} AS from_addr,
    CASE WHEN o.o_orderpriority = '5-LOW' THEN '' ELSE {addr('o.o_custkey + 1000000')} END AS to_addr,
    round(o.o_totalprice * 100)::BIGINT AS cents,
    ((o.o_custkey % 50) + 1) * 1000000000 AS gas_price_wei,
    (21000 + 5000 * coalesce(li_n.n_lines, 0))::BIGINT AS gas_used,
    '0x' || substr(md5(o.o_orderpriority), 1, 8) || lpad(lower(hex(o.o_orderkey)), 64, '0') AS input,
    CASE o.o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS tx_succeeded,
    TIMESTAMP '1995-01-01 00:00:00' + to_seconds(12 * (o.o_orderkey // 20)) AS block_timestamp
  FROM orders o LEFT JOIN li_n ON o.o_orderkey = li_n.l_orderkey)
"""

LINES_CTE = """
lines AS (
  SELECT l.*, t.tx_hash, t.tx_position, t.block_number, t.block_timestamp, t.input AS tx_input,
         t.from_addr, t.to_addr, t.tx_succeeded, t.o_orderpriority,
         (row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
              l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
              l.l_shipdate) - 1)::BIGINT AS log_index
  FROM lineitem l JOIN tx t ON l.l_orderkey = t.o_orderkey)
"""

# call-tree nodes of every order: root, supplier calls, line calls, in depth-first order
NODES_CTE = """
sup_calls AS (
  SELECT l_orderkey, l_suppkey,
         (dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey) - 1)::BIGINT AS sup_pos,
         count(*) AS n_lines_sup
  FROM lineitem GROUP BY l_orderkey, l_suppkey),
sup_calls2 AS (
  SELECT s.*, (1 + coalesce(sum(1 + n_lines_sup) OVER (PARTITION BY l_orderkey ORDER BY l_suppkey
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS sup_index,
         count(*) OVER (PARTITION BY l_orderkey) AS n_sup
  FROM sup_calls s),
line_calls AS (
  SELECT l.*, (row_number() OVER (PARTITION BY l.l_orderkey, l.l_suppkey ORDER BY l.l_linenumber, l.l_partkey,
               l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
               l.l_shipdate) - 1)::BIGINT AS line_pos
  FROM lineitem l),
nodes AS (
  SELECT t.o_orderkey, t.block_number, t.tx_position, 'ORIGIN' AS trace_address, NULL AS parent_trace_address,
         0::BIGINT AS depth, 0::BIGINT AS trace_index, coalesce(n.n_sup, 0)::BIGINT AS sub_traces,
         'CALL' AS type, t.from_addr AS from_address, t.to_addr AS to_address,
         (t.o_orderpriority = '1-URGENT') AS own_error, (t.o_orderpriority = '1-URGENT') AS path_error,
         t.cents::HUGEINT * 18446744073709551616 AS value_raw, t.input AS input,
         '0x' || lower(hex(t.cents)) || '0000000000000000' AS value_hex,
         (21000 + 1000 * (t.o_custkey % 100))::BIGINT AS gas, t.gas_used AS gas_used
  FROM tx t LEFT JOIN (SELECT DISTINCT l_orderkey, n_sup FROM sup_calls2) n ON n.l_orderkey = t.o_orderkey
  UNION ALL
  SELECT t.o_orderkey, t.block_number, t.tx_position, s.sup_pos::VARCHAR, 'ORIGIN', 1, s.sup_index,
         s.n_lines_sup, CASE WHEN sp.s_nationkey < 5 THEN 'CREATE' ELSE 'CALL' END, t.to_addr,
         '0x' || lpad(lower(hex(s.l_suppkey)), 40, '0'),
         coalesce(sp.s_acctbal < 0, false),
         (t.o_orderpriority = '1-URGENT') OR coalesce(sp.s_acctbal < 0, false),
         0::HUGEINT, '0x' || substr(md5(sp.s_name), 1, 8), '0x0', 21000, 21000
  FROM sup_calls2 s JOIN tx t ON t.o_orderkey = s.l_orderkey LEFT JOIN supplier sp ON sp.s_suppkey = s.l_suppkey
  UNION ALL
  SELECT t.o_orderkey, t.block_number, t.tx_position, s.sup_pos::VARCHAR || '_' || lc.line_pos::VARCHAR,
         s.sup_pos::VARCHAR, 2, s.sup_index + 1 + lc.line_pos, 0, 'STATICCALL',
         '0x' || lpad(lower(hex(lc.l_suppkey)), 40, '0'), '0x' || lpad(lower(hex(lc.l_partkey)), 40, '0'),
         lc.l_returnflag = 'R',
         (t.o_orderpriority = '1-URGENT') OR coalesce(sp.s_acctbal < 0, false) OR lc.l_returnflag = 'R',
         round(lc.l_extendedprice * 100)::HUGEINT, '0x' || md5(lc.l_partkey::VARCHAR),
         '0x' || lower(hex(round(lc.l_extendedprice * 100)::BIGINT)), lc.l_quantity::BIGINT * 1000, lc.l_linenumber::BIGINT * 100
  FROM line_calls lc JOIN sup_calls2 s ON s.l_orderkey = lc.l_orderkey AND s.l_suppkey = lc.l_suppkey
  JOIN tx t ON t.o_orderkey = lc.l_orderkey LEFT JOIN supplier sp ON sp.s_suppkey = lc.l_suppkey)
"""


# the facts, column by column
TRACE_SQL = f"""
WITH {TX_CTE}, {NODES_CTE}
SELECT n.block_number, t.block_timestamp, t.tx_hash, n.tx_position, n.trace_index, n.from_address,
       n.to_address, n.type, n.trace_address, n.sub_traces,
       CAST({shift_sql('n.value_raw', 18)} AS DOUBLE) AS value, n.value_raw::VARCHAR AS value_precise_raw,
       {shift_sql('n.value_raw', 18)} AS value_precise, n.value_hex, n.gas, n.gas_used, n.input, '0x' AS output,
       t.from_addr AS origin_from_address, nullif(t.to_addr, '') AS origin_to_address,
       left(t.input, 10) AS origin_function_signature, NOT n.path_error AS trace_succeeded,
       CASE WHEN n.own_error THEN CASE n.depth WHEN 0 THEN 'urgent' WHEN 1 THEN 'insolvent' ELSE 'returned' END
       END AS error_reason, NULL::VARCHAR AS revert_reason, t.tx_succeeded,
       md5(n.block_number::VARCHAR || '-' || n.tx_position::VARCHAR || '-' || n.trace_index::VARCHAR) AS fact_traces_id
FROM nodes n JOIN tx t ON t.o_orderkey = n.o_orderkey"""

BLOCK_SQL = f"""
WITH {TX_CTE}
SELECT block_number, {word('block_number')} AS block_hash, min(block_timestamp) AS block_timestamp, 'testnet' AS network,
       count(*)::BIGINT AS tx_count, (500 + 100 * count(*))::BIGINT AS size, {addr('block_number + 77')} AS miner,
       {word('block_number + 1')} AS mix_hash, {hx('block_number + 5')} AS extra_data,
       CASE WHEN block_number = 0 THEN '0x' || lpad(lower(hex(-1::BIGINT)), 64, '0')
            ELSE {word('block_number - 1')} END AS parent_hash,
       sum(gas_used)::BIGINT AS gas_used, 30000000::BIGINT AS gas_limit, (block_number + 7)::DECIMAL(38,0) AS base_fee_per_gas,
       0::DECIMAL(38,0) AS difficulty, (block_number * 3)::DECIMAL(38,0) AS total_difficulty,
       {word('block_number + 10')} AS sha3_uncles, '[]' AS uncle_blocks, 0::DECIMAL(38,0) AS nonce,
       {word('block_number + 11')} AS receipts_root, {word('block_number + 12')} AS state_root,
       {word('block_number + 13')} AS transactions_root, {hx('block_number + 20')} AS logs_bloom,
       md5(block_number::VARCHAR) AS fact_blocks_id
FROM tx GROUP BY block_number"""

TX_SQL = f"""
WITH {TX_CTE}
SELECT block_number, block_timestamp, tx_hash, from_addr AS from_address, nullif(to_addr, '') AS to_address,
       left(input, 10) AS origin_function_signature,
       CAST({shift_sql('cents::HUGEINT * 18446744073709551616', 18)} AS DOUBLE) AS value,
       (cents::HUGEINT * 18446744073709551616)::VARCHAR AS value_precise_raw,
       {shift_sql('cents::HUGEINT * 18446744073709551616', 18)} AS value_precise,
       CAST({shift_sql('gas_price_wei * gas_used', 18)} AS DOUBLE) AS tx_fee,
       {shift_sql('gas_price_wei * gas_used', 18)} AS tx_fee_precise,
       tx_succeeded, 2::BIGINT AS tx_type, o_orderkey::DECIMAL(38,0) AS nonce, tx_position, input AS input_data,
       gas_price_wei::DOUBLE / 1e9 AS gas_price, gas_used, (21000 + 1000 * (o_custkey % 100))::BIGINT AS gas_limit,
       gas_used AS cumulative_gas_used, gas_price_wei::DECIMAL(38,0) AS effective_gas_price,
       (o_custkey % 50 + 2)::DOUBLE AS max_fee_per_gas, 1.5::DOUBLE AS max_priority_fee_per_gas,
       '[{{"address":"' || from_addr || '"}}]' AS access_list, '0x' || md5('r' || o_orderkey::VARCHAR) AS r,
       '0x' || md5('s' || o_orderkey::VARCHAR) AS s, 1::BIGINT AS v, md5(tx_hash) AS fact_transactions_id
FROM tx"""

LOG_SQL = f"""
WITH {TX_CTE}, {LINES_CTE},
t AS (SELECT *, '0x' || md5(l_returnflag) AS topic_0, {word('l_partkey')} AS topic_1, {word('l_linenumber')} AS topic_2,
             CASE WHEN l_linestatus = 'O' THEN '0x' || md5(l_linestatus) END AS topic_3 FROM lines)
SELECT block_number, block_timestamp, tx_hash, tx_position, log_index AS event_index,
       '0x' || lpad(lower(hex(l_suppkey)), 40, '0') AS contract_address,
       '["' || concat_ws('","', topic_0, topic_1, topic_2, topic_3) || '"]' AS topics,
       topic_0, topic_1, topic_2, topic_3,
       '0x' || lower(hex(round(l_extendedprice * 100)::BIGINT)) AS data, false AS event_removed,
       from_addr AS origin_from_address, to_addr AS origin_to_address,
       left(tx_input, 10) AS origin_function_signature, tx_succeeded,
       md5(tx_hash || '-' || log_index::VARCHAR) AS fact_event_logs_id
FROM t"""
