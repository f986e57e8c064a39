import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.plans import gold, silver
from ledgerlake.sources import bronze, envelope_from_text

RUN = dt.datetime(2024, 3, 1)
BLOCK_LINES = [
    '{"partition_key":3435000,"value":{"BLOCK_NUMBER":3435200},"data":{"hash":"0xaa","number":"0x346ac0",'
    '"timestamp":"0x65f0c0de","size":"0x2a","transactions":["0x01","0x02"],"uncles":[],"gasUsed":"0x5208",'
    '"nonce":"0x0"},"metadata":{"request":{"data":{"id":3435200}}}}',
    '{"partition_key":3435000,"value":{},"data":{"hash":"0xab","transactions":[]},'
    '"metadata":{"request":{"data":"{\\"id\\":3435201}"}}}',
    '{"partition_key":3435000,"value":{"BLOCK_NUMBER":3435202},"data":{"error":{"code":-32000}},"metadata":{}}',
    '{"partition_key":3435000,"value":{"BLOCK_NUMBER":3435203},"data":{"error":null,"hash":"0xac"},"metadata":{}}',
]


def test_raw_blocks_fixture(spark):
    txt = spark.createDataFrame([(l,) for l in BLOCK_LINES], "value string")
    env = envelope_from_text(txt, inserted=F.lit(RUN).cast("timestamp_ntz"))
    b = bronze(env, "blocks")
    assert sorted(r.block_number for r in b.collect()) == [3435200, 3435201]
    fb = gold.fact_blocks(silver.silver_blocks(b, RUN), RUN)
    r = {x.block_number: x for x in fb.collect()}
    assert r[3435200].tx_count == 2 and r[3435200].size == 42 and r[3435200].gas_used == 21000
    assert r[3435200].block_timestamp == dt.datetime(2024, 3, 12, 20, 53, 50)
    assert r[3435201].tx_count == 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_read_raw_files(spark, tmp_path):
    from ledgerlake.sources import read_raw
    d = tmp_path / "raw" / "blocks"
    d.mkdir(parents=True)
    (d / "3435000_1.json").write_text("\n".join(BLOCK_LINES) + "\n")
    b = read_raw(spark, str(tmp_path / "raw" / "blocks"), "blocks")
    rows = b.select("block_number", "partition_key", "file_name").collect()
    assert sorted(r.block_number for r in rows) == [3435200, 3435201]
    assert all(r.partition_key == 3435000 and r.file_name.endswith("3435000_1.json") for r in rows)
