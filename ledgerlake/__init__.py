"""ledgerlake: turn raw EVM node JSON into query-ready tables with PySpark.

Sub-packages
------------
functions   Column expressions (hex numbers, exact decimals, JSON access, keys).
sources     Raw envelope readers, seeds, a small catalog of declared sources.
operators   Composable DataFrame operators (latest per key, explode, call tree,
            upserts, incremental reads, backlogs, data-quality checks).
plans       Composite models: silver and gold tables, contracts, ingest spines.
streaming   Structured Streaming forms of the incremental operators.
queries     The registered queries over the driver tables and their SQL oracles.
"""

__version__ = "0.1.0"
