"""Plan-shape guards: the scale properties found with ``explain()`` stay true."""

import re

from scarp.functions import parse as ps
from scarp.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_is_one_scan_one_exchange_hash_aggregate(spark):
    plan = _plan(catalog.QUERIES["alerts_by_cluster"](spark, SF))
    assert plan.count("FileScan parquet") == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1      # partial agg -> one shuffle -> final agg
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "BroadcastExchange" not in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "ts:" in schema and len(schema.split(",")) <= 6              # pruned to the used columns


def test_sensor_filter_reaches_the_scan(spark):
    plan = _plan(catalog.QUERIES["speed"](spark, SF))
    assert "EqualTo(event_type,click)" in plan


def test_each_message_is_parsed_once(spark):
    df = spark.createDataFrame([("1", "{}")], "key string, value string")
    good, rejected = ps.split_rejected(df, keep=("key",), ntz=False)
    assert _plan(good).count("from_json") == 1
    assert _plan(rejected).count("from_json") == 1


def test_no_broadcast_hints_in_library():
    import pathlib
    src = "\n".join(p.read_text() for p in pathlib.Path(catalog.__file__).parents[1].rglob("*.py"))
    assert "broadcast(" not in src and "localCheckpoint" not in src and "crossJoin" not in src
