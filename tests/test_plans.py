import re

import pytest
from test_sessions import CUT, busy_table

import __spark_entry__ as entry
from wiretide.operators import flows
from wiretide.operators.packets import capture
from wiretide.operators.split import with_split
from wiretide.plans.extract import extract_features
from wiretide.sources.tables import read_packets
from wiretide.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def packet_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("packets") / "p")
    busy_table(spark, 1000).write.parquet(path)
    return path


def test_per_flow_features_take_one_shuffle_and_one_sort(spark, packet_files):
    packets = read_packets(spark, packet_files)
    for df in (extract_features(packets, avg_flow_time=False), flows.flow_summary(packets)):
        text = plan(df)
        assert text.count("Exchange") == 1 and text.count("Sort [") == 1, text
        assert "Python" not in text


def test_capture_predicates_and_columns_reach_the_scan(spark, packet_files):
    text = plan(capture(read_packets(spark, packet_files)).select("packet_id", "src_port"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (.*)", text)
    assert "IsNotNull(src_ip)" in pushed[1] and "In(protocol" in pushed[1]
    assert "ttl" not in pushed[2] and "ts_us" not in pushed[2]
    recent = flows.active_flow_count(read_packets(spark, packet_files), 10**15)
    assert "GreaterThanOrEqual(ts_us" in plan(recent) and "length" not in re.search(r"ReadSchema: (.*)", plan(recent))[1]


def test_no_task_gets_all_packets_once_cut(spark, packet_files):
    packets = read_packets(spark, packet_files)
    text = plan(extract_features(packets, options=CUT))
    # The only rows that meet in one task are the slice totals.
    for single in re.finditer(r"Exchange SinglePartition.*\n(.*)", text):
        assert "HashAggregate(keys=[_slice" in single[1], single[1]
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_split_marks_rows_without_moving_them(spark):
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS y")
    assert "Exchange" not in plan(with_split(df, "y", "id"))


@pytest.mark.parametrize("name", ["packet_features", "full_features", "flow_summary", "active_flow_timeline"])
def test_generated_code_is_small_enough_to_be_compiled(spark, name):
    """The JVM leaves methods of more than 8000 bytes uncompiled, which costs a factor of five and more."""
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        executed = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    text = getattr(debug, "MODULE$").codegenString(executed)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000, sizes


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "avg_flow_time" in df.columns
