"""Physical-plan assertions: broadcasts of checked dims, pushdown, no Python."""

from conftest import SF_SMALL

from quartermaster.operators import metrics as M
from quartermaster.operators.enrich import ORDER_DIMS
from quartermaster.plans import results as R
from quartermaster.sources.conform import load_star


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + \
        df._jdf.queryExecution().optimizedPlan().toString()


def test_spend_by_region_broadcasts_dims_and_has_no_python(spark):
    p = plan(R.spend_by_region(load_star(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_scan_is_pruned(spark):
    df = R.kpi_total_orders(load_star(spark, SF_SMALL))
    p = df._jdf.queryExecution().executedPlan().toString()
    # lineitem is read with the needed columns only
    assert "l_tax" not in p and "l_shipdate" not in p


def test_eager_plan_aggregates_before_join(spark):
    star = load_star(spark, SF_SMALL)
    df = M.star_metrics(star, star.purchase_orders, ORDER_DIMS, [M.total_spend()], ["region"],
                        strategy="eager")
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    # the first (innermost) aggregate is keyed by the foreign key
    assert opt.count("Aggregate") >= 2


def test_latest_snapshot_is_a_scalar_subquery(spark):
    df = R.kpi_low_stock(load_star(spark, SF_SMALL))
    assert "scalar-subquery" in df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_all_dataset_plans_are_python_free(spark):
    star = load_star(spark, SF_SMALL)
    for name, fn in R.RESULTS.items():
        p = fn(star)._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in p and "EvalPython" not in p, name


def test_many_measures_one_scan(spark):
    """Measures with different filters fold into one aggregation over one scan."""
    star = load_star(spark, SF_SMALL)
    df = M.metrics(star.purchase_orders, [M.order_count(), M.total_spend(), M.on_time_rate(),
                                          M.delayed_count(), M.avg_days_late()], ["status"])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan parquet") == 1


def test_aggregation_is_partial_before_every_shuffle(spark):
    star = load_star(spark, SF_SMALL)
    for strategy in ("broadcast", "eager"):
        df = M.star_metrics(star, star.purchase_orders, ORDER_DIMS,
                            [M.total_spend(), M.on_time_rate()], ["region"], strategy=strategy)
        p = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_sum" in p and "partial_count" in p, strategy


def test_spread_check_runs_no_job(spark):
    """The single-split check asks a plain file scan for its partitions: no job."""
    from quartermaster.sources.conform import _spread
    from quartermaster.sources.raw import Raw
    li = Raw(spark, SF_SMALL).lineitem
    sc = spark.sparkContext
    sc.setJobGroup("qm-spread-probe", "probe")
    try:
        _spread(li)
        assert sc.statusTracker().getJobIdsForGroup("qm-spread-probe") == []
    finally:
        sc.setJobGroup("", "")
