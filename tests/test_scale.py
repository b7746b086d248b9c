"""Hot keys, brute-force equality, and the plans that keep large inputs apart."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge import runtime
from panelforge.operators.joins import attach, hot_keys
from panelforge.operators.manifest import changed_ids, diff
from panelforge.operators.nearest import nearest_join
from panelforge.operators.rank import rank_rows
from panelforge.operators.stats import pearson, z_scores
from panelforge.operators.topk import first_per_key
from panelforge.plans import metrics
from panelforge.sources.gold import in_order
from panelforge.sources.state import path_exists
from panelforge.workload import tables as t

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 rows, a third with one group, one value and one key; some exact copies; NULLs."""
    i = F.col("id")
    third = i % 3 == 0
    return spark.range(30000).select(
        F.when(third, F.lit("hot")).when(i % 31 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("g"), (i % 50).cast("string"))
        ).alias("g"),
        F.when(third, F.lit(1.0)).when(i % 37 == 1, F.lit(None)).otherwise(
            (F.hash("id") % 100).cast("double")
        ).alias("v"),
        F.when(third, F.lit("k")).otherwise((i % 5000).cast("string")).alias("k"),
    )


def ranked(hot, slices):
    return rank_rows(
        hot, order=[F.col("v").asc_nulls_last(), F.col("k").asc()], order_columns=["v", "k"],
        rank_column="r", group=["g"], group_rank_column="gr", slices=slices,
    )


@pytest.mark.parametrize("slices", [1, 7, 16])
def test_rank_equals_window(hot, slices):
    order = [F.col("v").asc_nulls_last(), F.col("k").asc(), F.col("g").asc_nulls_last()]
    expected = hot.withColumns(
        {
            "r": F.row_number().over(Window.orderBy(*order)),
            "gr": F.row_number().over(Window.partitionBy("g").orderBy(*order)),
        }
    )
    assert rows(ranked(hot, slices)) == rows(expected)


def test_rank_spreads_copies_of_one_row(spark, hot, monkeypatch):
    kept = []
    freeze = runtime.freeze
    monkeypatch.setattr(
        "panelforge.operators.rank.freeze", lambda df: kept.append(freeze(df)) or kept[-1]
    )
    ranked(hot, 10).count()
    sizes = [r["count"] for r in kept[0].groupBy("_slice").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 3000


def test_rank_has_no_single_partition_of_rows(hot):
    shown = plan(ranked(hot, 4))
    # The only gathering exchange holds one counted row per slice.
    for part in shown.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[_slice" in part.split("Exchange", 1)[0]
    assert "RangePartitioning" not in shown


def test_empty_rank(spark, hot):
    assert ranked(hot.where("false"), 4).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_attach_both_ways(spark, hot, limit):
    side = hot.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"))
    window = Window.partitionBy("g")
    expected = hot.withColumns({"n": F.count(F.lit(1)).over(window), "m": F.avg("v").over(window)})
    got = attach(hot, side, ["g"], match_nulls=True, broadcast_bytes=limit)

    def rounded(df):
        return rows(df.withColumn("m", F.round("m", 9)))

    assert rounded(got) == rounded(expected)
    plain = attach(hot, side, ["g"], broadcast_bytes=limit)
    assert plain.where("g IS NULL AND n IS NOT NULL").count() == 0
    assert plain.count() == 30000
    inner = attach(hot, side.where("g = 'hot'"), ["g"], "inner", broadcast_bytes=limit)
    assert inner.count() == 10000


def test_hot_keys_never_reach_the_exchange(spark, hot):
    assert [r["_hot"]["g"] for r in hot_keys(hot, ["g"]).collect()] == ["hot"]
    side = hot.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        df = attach(hot, side, ["g"], match_nulls=True, broadcast_bytes=0)
        df.collect()
        shown = plan(df).split("Initial Plan")[0]
        assert "SortMergeJoin" in shown and "LeftAnti" in shown and "LeftSemi" in shown
        # The detail side of the shuffled join carries the cold two thirds only.
        cold = hot.join(F.broadcast(hot_keys(hot, ["g"])), F.struct("g") == F.col("_hot"), "left_anti")
        assert cold.count() == 20000
    finally:
        spark.conf.set(threshold, before)


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_attach_empty_inputs(spark, hot, limit):
    side = hot.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    nothing = attach(hot, side.where("n < 0"), ["g"], broadcast_bytes=limit)
    assert nothing.where("n IS NULL").count() == 30000
    assert attach(hot.where("false"), side, ["g"], broadcast_bytes=limit).count() == 0


def test_attach_with_a_hot_null_key(spark, hot):
    nulls = hot.withColumn("g", F.nullif("g", F.lit("hot")))
    side = nulls.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    for match in (True, False):
        wide = attach(nulls, side, ["g"], match_nulls=match, broadcast_bytes=0)
        narrow = attach(nulls, side, ["g"], match_nulls=match)
        assert rows(wide) == rows(narrow)


def test_first_per_key_limits_before_the_exchange(spark, hot):
    df = first_per_key(hot, ["k"], [F.col("v").desc_nulls_last()])
    shown = plan(df)
    assert "WindowGroupLimit" in shown and "Partial" in shown
    expected = {}
    for r in hot.collect():
        best = expected.get(r.k)
        key = (r.v is None, -(r.v or 0), r.g is None, r.g or "")
        if best is None or key < best:
            expected[r.k] = key
    assert {
        r.k: (r.v is None, -(r.v or 0), r.g is None, r.g or "") for r in df.collect()
    } == expected


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_nearest_against_brute_force(spark, limit):
    base = spark.range(6000)
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.hash("id") % 400).cast("int"))
    panel = base.select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200).alias("k"),
        F.when(F.col("id") % 41 != 1, day).alias("d"), (F.col("id") % 7).alias("v"),
    )
    anchors = spark.range(0, 200, 2).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 10 != 4, F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")))
        .alias("a"),
    )
    joined = nearest_join(panel, anchors, ["k"], "d", "a", broadcast_bytes=limit)
    got = {r.k: (r.d, r.v) for r in joined.collect()}
    if limit:
        shown = plan(nearest_join(panel, anchors, ["k"], "d", "a"))
        assert shown.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    targets = {r.k: r.a for r in anchors.collect()}
    best = {}
    for r in panel.collect():
        if r.k not in targets:
            continue
        a = targets[r.k]
        gap = abs((r.d - a).days) if r.d and a else None
        key = (gap is None, gap or 0, r.d is None, -(r.d.toordinal() if r.d else 0), r.v)
        if r.k not in best or key < best[r.k][0]:
            best[r.k] = (key, (r.d, r.v))
    assert got == {k: v for k, (_, v) in best.items()}


def test_pearson_ignores_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (None, 9.0), (7.0, None)], "x double, y double")
    assert df.agg(pearson(F.col("x"), F.col("y"))).first()[0] == pytest.approx(1.0)
    assert df.limit(1).agg(pearson(F.col("x"), F.col("y"))).first()[0] is None
    assert df.where("false").agg(pearson(F.col("x"), F.col("y"))).first()[0] is None


def test_z_scores_group_once(hot):
    means = hot.groupBy("g").agg(F.avg("v").alias("m"))
    df = z_scores(means, ["m"])
    df.collect()
    assert "ReusedExchange" in plan(df).split("Initial Plan")[0]


def test_sorted_write_spreads_copies(hot):
    one = hot.select(F.lit("same").alias("s"))
    sizes = in_order(one, ["s"]).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 1


def test_diff_is_one_exchange(spark):
    old, new, feed = t.manifest_versions(spark, SF)
    parts = [d.persist() for d in (old, new)]
    try:
        shown = plan(diff(*parts, changed_ids(feed)))
        assert "Join" not in shown.split("InMemoryTableScan")[0]
        assert shown.split("InMemoryTableScan")[0].count("Exchange hashpartitioning") == 1
    finally:
        for d in parts:
            d.unpersist()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "silver")
    t.measure_silver(spark, SF).withColumn("EXTRA", F.lit("x")).write.parquet(path)
    scores = metrics.latest_scores(metrics.measure_table(spark.read.parquet(path)))
    shown = plan(scores)
    assert f"EqualTo(MEASURE_CODE,{metrics.READMISSION_MEASURE})" in shown
    assert "EXTRA" not in shown


def test_date_partitions_are_pruned(spark, tmp_path):
    from panelforge.operators.panel import at_snapshot, latest_snapshot, lookback

    path = str(tmp_path / "silver")
    t.facility_silver(spark, SF).write.partitionBy("SNAPSHOT_DATE").parquet(path)
    panel = metrics.facility_panel(spark.read.parquet(path))
    latest = latest_snapshot(panel)
    for df in (at_snapshot(panel, latest), lookback(panel, latest)):
        shown = plan(df)
        assert "PartitionFilters: [isnotnull(SNAPSHOT_DATE" in shown


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.scratch_root(Session())
    Context.master = "local[2]"
    assert "panelforge-app" in runtime.scratch_root(Session())


def test_scratch_is_dropped(spark):
    frozen, count, size = runtime.freeze_measured(spark.range(10).toDF("x"))
    assert (frozen.count(), count) == (10, 10) and size > 0
    empty, count, size = runtime.freeze_measured(spark.range(0).toDF("x"))
    assert (empty.count(), count, size) == (0, 0, 0)


def test_scratch_scope(spark):
    with runtime.scratch_scope(spark):
        path = runtime.scratch_path(spark)
        spark.range(3).write.parquet(path)
        assert path_exists(spark, path)
    assert not path_exists(spark, path)
