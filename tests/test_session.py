"""The shared folder and the plans that scale depends on."""

from unittest.mock import MagicMock

import pytest

from ledgerbrook.operators import dedupe, metrics
from ledgerbrook.plans.adapters import ARRIVAL, Entities
from ledgerbrook.session import CHECKPOINT_CONF, cut_lineage, shared_dir

SF = "/root/testdata/sf0.001"


def _plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


def test_shared_dir_is_kept(spark):
    assert shared_dir(spark) == shared_dir(spark) == spark.conf.get(CHECKPOINT_CONF)
    assert "ExistingRDD" in _plan(cut_lineage(spark.range(3)))


def _cluster(path):
    """What ``shared_dir`` asks of a session on several machines, with the machine's own default file system."""
    session = MagicMock()
    session.conf.get.return_value = path
    context = session.sparkContext
    context.master = "local-cluster[3,4,10240]"
    context.getConf().get.return_value = path
    context._jsc.sc().getCheckpointDir().isDefined.return_value = False
    context._jsc.sc().getCheckpointDir().isEmpty.return_value = True
    context._jsc.hadoopConfiguration().get.return_value = "file:///"
    return session


def test_cluster_takes_a_folder_without_file_system():
    session = _cluster("/mnt/shared")
    with pytest.warns(UserWarning, match="all machines must mount"):
        assert shared_dir(session) == "/mnt/shared"
    session.sparkContext.setCheckpointDir.assert_called_once_with("/mnt/shared")


def test_cluster_needs_a_folder():
    with pytest.raises(RuntimeError, match="all executors can reach"):
        shared_dir(_cluster(None))


def test_repeats_are_cut_before_the_shuffle(spark):
    plan = _plan(dedupe.once_per_event(Entities(spark, SF).envelopes(), ARRIVAL))
    assert "Partial" in plan and plan.count("Exchange") == 1


def test_columns_are_pruned(spark):
    plan = _plan(metrics.requests_total(Entities(spark, SF).request_log(), ("method", "status")))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_type", "props"}


def test_one_pass_for_all_groupings(spark):
    plan = _plan(metrics.red_grouping_sets(Entities(spark, SF).request_log()))
    assert plan.count("FileScan") == 1


def test_windows_are_counted_before_they_spread(spark):
    plan = _plan(metrics.request_rate(Entities(spark, SF).request_log()))
    generate = plan.index("Generate explode(transform")
    assert plan.index("HashAggregate", generate) > generate


def test_no_nested_loop_over_rows(spark):
    log = Entities(spark, SF).request_log()
    for df in (metrics.latency_histogram(log), metrics.error_rate_zero_filled(log)):
        assert "CartesianProduct" not in _plan(df) and "NestedLoop" not in _plan(df)
