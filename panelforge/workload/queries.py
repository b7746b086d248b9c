"""One query per operator or composite, over the star-schema tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions import clean
from panelforge.functions.dictionaries import MEASURES
from panelforge.functions.measures import (
    facility_label,
    number_text,
    percent_of,
    strength_text,
)
from panelforge.functions.names import snapshot_month
from panelforge.operators.contracts import (
    OCCUPANCY,
    RN_TURNOVER,
    STAFFING,
    STAFFING_SOURCE,
    TOTAL_TURNOVER,
    missing_columns,
)
from panelforge.operators.manifest import (
    actions,
    changed_ids,
    cleanup,
    crawl_counts,
    diff,
    manifest_rows,
    plan_counts,
    run_counts,
    shared_keys,
    tree_paths,
)
from panelforge.operators.nearest import nearest_join
from panelforge.operators.panel import latest_snapshot, lookback, lookback_start
from panelforge.operators.rank import rank_rows
from panelforge.operators.reshape import melt
from panelforge.operators.scope import in_scope
from panelforge.operators.stats import (
    correlate,
    histogram,
    linear_fit,
    trend_line,
)
from panelforge.operators.topk import first_per_key, top_n
from panelforge.operators.typing import apply_dictionary, union_drifting
from panelforge.plans import dashboard, metrics
from panelforge.plans.mirror import bootstrap_steps, mirror
from panelforge.runtime import freeze, scratch_path
from panelforge.sources.gold import load_dashboard, read_gold
from panelforge.sources.monthly import TURNOVER_SUMS, MonthlyMetrics, merged_turnover
from panelforge.sources.silver import RAW, SilverTable
from panelforge.sources.snapshots import build_silver, list_snapshots, read_silver, rejected_rows, write_silver
from panelforge.sources.state import (
    StateStore,
    read_manifest_json,
    write_manifest_json,
)
from panelforge.schemas import columns
from panelforge.streaming.feed import change_records
from panelforge.streaming.snapshots import refresh_silver, snapshot_stream
from panelforge.workload import tables as t
from panelforge.workload.tables import table

STATE = "NATION_7"
FACILITY_ID = "6"

# Columns each table is expected to have; some name one that is not there.
EXPECTED = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_phone"],
    "supplier": ["s_suppkey", "s_name"],
    "part": ["p_partkey", "p_container", "p_size"],
    "orders": ["o_orderkey", "o_clerk", "o_shippriority"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_shipmode"],
    "events": ["event_id", "session_id", "ts"],
    "documents": ["doc_id", "text"],
    "labels": ["doc_id", "severity"],
    "embeddings": ["vec_id", "embedding"],
    "pages": ["page_id", "html"],
    "benchmark": ["item_id", "answer", "text"],
    "conversations": ["conv_id", "turn", "model"],
}


def r6(column: Column | str) -> Column:
    """Six decimals, and no negative zero: summation order must not show."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def facility_panel(
    spark: SparkSession, sf: str, since: datetime.date | None = None
) -> DataFrame:
    return metrics.facility_panel(t.facility_silver(spark, sf, since))


def measure_table(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.measure_table(t.measure_silver(spark, sf))


def _latest(spark: SparkSession, sf: str) -> datetime.date:
    """The newest month, from the one column that holds it."""
    return latest_snapshot(table(spark, sf, "orders").select(t.order_month().alias("m")), "m")


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    latest = _latest(spark, sf)
    first = lookback_start(latest)
    return lookback(facility_panel(spark, sf, first), latest)


def _ranking(spark: SparkSession, sf: str) -> DataFrame:
    latest = _latest(spark, sf)
    return metrics.low_staffing(facility_panel(spark, sf, latest), latest)


def _readmissions(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.staffing_vs_readmissions(facility_panel(spark, sf), measure_table(spark, sf))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.readmission_pairs(facility_panel(spark, sf), measure_table(spark, sf))


# --- scans, schemas, cleaning ------------------------------------------------------------


def scan_parquet(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


_RELEASE_COLUMNS = [
    "CCN", "ORDER_NUMBER", "ABUSE_ICON", "PROCESSING_DATE", "TOTAL_AMOUNT_OF_FINES_IN_DOLLARS",
    "ORDER_STATUS", "SNAPSHOT_DATE",
]


def csv_roundtrip_clean(spark, sf):
    folder = t.land_releases(spark, table(spark, sf, "orders"), scratch_path(spark, "bronze"))
    return build_silver(spark, folder, t.RELEASES).select(*_RELEASE_COLUMNS)


def snapshot_discovery(spark, sf):
    folder = t.land_releases(spark, table(spark, sf, "orders"), scratch_path(spark, "bronze"))
    files = list_snapshots(spark, folder, t.RELEASES)
    rows = build_silver(spark, folder, t.RELEASES).groupBy("SNAPSHOT_DATE").count()
    months = files.where("length > 0").select("SNAPSHOT_DATE").distinct()
    return months.join(rows, "SNAPSHOT_DATE").select("SNAPSHOT_DATE", F.col("count").alias("ROWS"))


def name_month_parse(spark, sf):
    short = F.date_format("o_orderdate", "MMM")
    month = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "MMMM")).otherwise(
        F.when(F.col("o_orderstatus") == "O", F.upper(short)).otherwise(short)
    )
    name = F.concat(F.lit("NH_ProviderInfo_"), month, F.year("o_orderdate").cast("string"), F.lit(".csv"))
    return table(spark, sf, "orders").select("o_orderkey", snapshot_month(name).alias("month"))


def clean_text_yn(spark, sf):
    segment = F.col("c_mktsegment")
    padded = F.when(segment == "MACHINERY", F.lit("   ")).otherwise(
        F.concat(F.lit("  "), segment, F.lit(" "))
    )
    flag = (
        F.when(F.col("c_acctbal") > 5000, F.lit(" y "))
        .when(F.col("c_acctbal") > 0, F.lit("n"))
        .otherwise(F.lit(""))
    )
    return table(spark, sf, "customer").select(
        "c_custkey", clean.text(padded).alias("segment"), clean.yes_no(flag).alias("flag")
    )


def document_text_clean(spark, sf):
    """Text cleaning over whole document texts."""
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(clean.text(F.col("text")).cast("binary")).alias("text_md5"),
        clean.yes_no(F.col("lang")).alias("lang"),
    )


def clean_numeric(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", clean.number(t.decorated_price()).alias("price")
    )


def clean_date(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", clean.date(t.mixed_date_text(t.order_day())).alias("order_date")
    )


def dictionary_typing(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("CCN"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("PROVIDER_TYPE"),
        t.flag_text().alias("ABUSE_ICON"),
        t.mixed_date_text(t.order_day()).alias("PROCESSING_DATE"),
        t.decorated_price().alias("TOTAL_AMOUNT_OF_FINES_IN_DOLLARS"),
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("ORDER_NUMBER"),
        F.lit("orders").alias("SOURCE_FILE_NAME"),
        t.order_month().alias("SNAPSHOT_DATE"),
        F.current_timestamp().alias("SILVER_PROCESSED_AT"),
    )
    return apply_dictionary(raw, t.RELEASES).drop("SILVER_PROCESSED_AT")


def drift_union(spark, sf):
    orders = table(spark, sf, "orders")
    change = F.lit("1998-01-01").cast("timestamp_ntz")
    early = orders.where(F.col("o_orderdate") < change).select("o_orderkey", "o_orderstatus")
    late = orders.where(F.col("o_orderdate") >= change).select(
        "o_orderpriority", "o_orderstatus", "o_orderkey"
    )
    return union_drifting([early, late])


def contract_report(spark, sf):
    def report(name: str) -> DataFrame:
        df = table(spark, sf, name)
        missing = ",".join(missing_columns(df.columns, EXPECTED[name]))
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(missing).alias("missing")
        )

    return union_drifting([report(name) for name in EXPECTED])


# --- panel and metrics -------------------------------------------------------------------


def lookback_panel(spark, sf):
    return _recent(spark, sf).select("CCN", "SNAPSHOT_DATE", "MONTH", r6(STAFFING_SOURCE).alias("hours"))


def safe_ratio(spark, sf):
    ratio = percent_of(F.col("l_extendedprice"), F.col("l_quantity") - 1)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", r6(ratio).alias("ratio")
    )


def occupancy_trend(spark, sf):
    return rounded(metrics.occupancy_trends(_recent(spark, sf)), OCCUPANCY)


def staffing_vs_occupancy(spark, sf):
    return rounded(metrics.staffing_vs_occupancy(_recent(spark, sf)), OCCUPANCY, STAFFING)


def low_staffing_ranking(spark, sf):
    return _ranking(spark, sf)


def rank_national_state(spark, sf):
    """Every line item ranked by quantity (fifty values), overall and per return flag."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_returnflag",
    )
    return rank_rows(
        lines,
        order=[F.col("l_quantity").asc_nulls_last(), F.col("l_orderkey").asc()],
        order_columns=["l_quantity", "l_orderkey"],
        rank_column="national_rank",
        group=["l_returnflag"],
        group_rank_column="state_rank",
    )


def latest_per_key(spark, sf):
    orders = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    newest = [F.col("o_orderdate").desc_nulls_last()]
    rows = orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return first_per_key(rows, ["o_custkey"], newest).select(
        "o_custkey", "o_orderkey", t.order_day().alias("o_day"), "o_totalprice"
    )


def nearest_orders(spark, sf):
    """Per customer: the latest urgent order and the other order nearest to it in days."""
    orders = table(spark, sf, "orders")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        "o_custkey", t.order_day().alias("urgent_day"), F.col("o_orderkey").alias("urgent_key")
    )
    anchors = first_per_key(urgent, ["o_custkey"], [F.col("urgent_day").desc_nulls_last()])
    others = orders.where(F.col("o_orderpriority") != "1-URGENT").select(
        "o_custkey", t.order_day().alias("other_day"), F.col("o_orderkey").alias("other_key")
    )
    return nearest_join(others, anchors, ["o_custkey"], "other_day", "urgent_day")


def group_corr(spark, sf):
    """Correlation of price and quantity per part, line items counted."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    return rounded(
        correlate(lines, ["l_partkey"], "l_quantity", "l_extendedprice", "correlation", "rows"),
        "correlation",
    )


def global_corr(spark, sf):
    return rounded(
        correlate(
            table(spark, sf, "lineitem"), [], "l_quantity", "l_extendedprice", "correlation", "rows"
        ),
        "correlation",
    )


def readmission_correlation(spark, sf):
    return rounded(
        _readmissions(spark, sf), STAFFING, metrics.READMISSION, metrics.STATE_CORR,
        metrics.NATIONAL_CORR,
    )


def state_month_avg(spark, sf):
    return rounded(
        metrics.nurse_turnover(_recent(spark, sf)), TOTAL_TURNOVER, RN_TURNOVER,
        f"STATE_AVG_{TOTAL_TURNOVER}", f"STATE_AVG_{RN_TURNOVER}",
    )


# --- dashboard ---------------------------------------------------------------------------


def kpis(spark, sf):
    latest = _latest(spark, sf)
    recent = lookback(facility_panel(spark, sf, lookback_start(latest)), latest)
    lowest = metrics.staffed_facilities(facility_panel(spark, sf, latest), latest)
    row = dashboard.overview(metrics.staffing_vs_occupancy(recent), lowest, recent)
    return rounded(
        row.drop("LATEST_MONTH", "LATEST_TURNOVER_MONTH", "AVG_RN_TURNOVER_TEXT"),
        "AVG_OCCUPANCY", "AVG_STAFFING", "PAIRED_OCCUPANCY", "PAIRED_STAFFING", "LOWEST_STAFFING",
        "AVG_TURNOVER", "AVG_RN_TURNOVER",
    )


def kpi_cube(spark, sf):
    """The headline numbers of all facilities, every state and every facility in one aggregation."""
    latest = _latest(spark, sf)
    recent = lookback(facility_panel(spark, sf, lookback_start(latest)), latest)
    lowest = metrics.staffed_facilities(facility_panel(spark, sf, latest), latest)
    cube = dashboard.scope_cube(metrics.staffing_vs_occupancy(recent), lowest, recent)
    return rounded(
        cube.drop("LATEST_MONTH"),
        "AVG_OCCUPANCY", "AVG_STAFFING", "PAIRED_OCCUPANCY", "PAIRED_STAFFING", "LOWEST_STAFFING",
        "AVG_TURNOVER", "AVG_RN_TURNOVER",
    )


def state_zscore(spark, sf):
    table_ = dashboard.state_heatmap(metrics.staffing_vs_occupancy(_recent(spark, sf)))
    return rounded(table_, OCCUPANCY, "STAFFING_HOURS", f"{OCCUPANCY}_Z", "STAFFING_HOURS_Z")


def linear_fit_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    return rounded(linear_fit(lines, "l_quantity", "l_extendedprice"), "SLOPE", "INTERCEPT", digits=3)


def linear_fit_grid(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    return rounded(trend_line(lines, "l_quantity", "l_extendedprice"), "X", "Y", digits=3)


def staffing_points(spark, sf):
    points = dashboard.staffing_scatter(metrics.staffing_vs_occupancy(_recent(spark, sf)))
    return rounded(points, OCCUPANCY, STAFFING)


def staffing_trend(spark, sf):
    points = dashboard.staffing_scatter(metrics.staffing_vs_occupancy(_recent(spark, sf)))
    return rounded(dashboard.staffing_trend(points), "X", "Y")


def topn_lowest(spark, sf):
    return rounded(dashboard.lowest_staffing(_ranking(spark, sf), 25), "STAFFING_HOURS_PER_RESIDENT_DAY")


def topn_lowest_in_state(spark, sf):
    top = dashboard.lowest_staffing(_ranking(spark, sf), 10, state=STATE, by_state=True)
    return rounded(top, "STAFFING_HOURS_PER_RESIDENT_DAY")


def topn_customers(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return top_n(rows, 25, F.col("c_acctbal").asc_nulls_last(), F.col("c_custkey"))


def readmission_points(spark, sf):
    points = dashboard.readmission_scatter(_readmissions(spark, sf), STATE)
    return rounded(
        points, STAFFING, metrics.READMISSION, metrics.STATE_CORR, metrics.NATIONAL_CORR
    )


def readmission_trend(spark, sf):
    points = dashboard.readmission_scatter(_pairs_as_table(spark, sf))
    return rounded(dashboard.readmission_trend(points), "X", "Y")


def _pairs_as_table(spark, sf):
    none = F.lit(None).cast("double")
    return _pairs(spark, sf).withColumns({metrics.STATE_CORR: none, metrics.NATIONAL_CORR: none})


def strength_label(spark, sf):
    """National and per-state correlation with its sentence and number text."""
    table_ = _readmissions(spark, sf)
    national = dashboard.scope_correlation(table_)
    state = dashboard.scope_correlation(table_, STATE)
    facility = dashboard.scope_correlation(table_, STATE, FACILITY_ID)
    return rounded(national.unionByName(state).unionByName(facility), "CORRELATION")


def state_strengths(spark, sf):
    pairs = freeze(_pairs(spark, sf))
    by_state = correlate(pairs, ["STATE"], STAFFING, metrics.READMISSION, "R", "ROWS")
    return by_state.select(
        "STATE", "ROWS", r6("R").alias("R"), strength_text(r6("R")).alias("SENTENCE"),
        number_text(r6("R"), 3).alias("R_TEXT"),
    )


def turnover_trend(spark, sf):
    return rounded(dashboard.turnover_trend(_recent(spark, sf)), "TURNOVER")


def top_states(spark, sf):
    return rounded(dashboard.turnover_by_state(_recent(spark, sf)), "TURNOVER_RATE_PCT")


def turnover_distribution(spark, sf):
    return dashboard.turnover_distribution(_recent(spark, sf), STATE)


def histogram_quantity(spark, sf):
    """Line items by doubled quantity, whose largest value is the upper edge."""
    doubled = table(spark, sf, "lineitem").select(
        (F.col("l_quantity") * 2).alias("v"), "l_returnflag"
    )
    return histogram(doubled, "v", ["l_returnflag"])


def detail_unpivot(spark, sf):
    return rounded(
        dashboard.turnover_detail(_recent(spark, sf), FACILITY_ID), "ANNUAL_TURNOVER_RATE_PCT"
    )


def melt_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax"
    )
    return melt(
        lines, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_discount", "l_tax"], "measure", "value"
    )


def filter_lists(spark, sf):
    """State list and labelled facility list, one under the other."""
    staffing = metrics.staffing_vs_occupancy(_recent(spark, sf))
    states = dashboard.state_list(staffing).select(
        F.lit("state").alias("LIST"), F.col("STATE").alias("ENTRY")
    )
    facilities = dashboard.facility_list(staffing).select(
        F.lit("facility").alias("LIST"), F.col("DISPLAY").alias("ENTRY")
    )
    return states.unionByName(facilities)


def facility_labels(spark, sf):
    name = F.nullif("c_name", F.lit("Customer#000000001"))
    return table(spark, sf, "customer").select(
        "c_custkey", facility_label(name, F.col("c_custkey").cast("string")).alias("label")
    )


def scope_filter(spark, sf):
    rows = facility_panel(spark, sf).select("CCN", "STATE", "SNAPSHOT_DATE", STAFFING_SOURCE)
    return rounded(
        in_scope(rows, STATE).unionByName(in_scope(rows, ccn=FACILITY_ID)), STAFFING_SOURCE
    )


def gold_roundtrip(spark, sf):
    """All five tables written and one read back through the dashboard loader."""
    base = scratch_path(spark, "gold")
    panel, measures = facility_panel(spark, sf), measure_table(spark, sf)
    metrics.build_gold(panel, measures, base)
    loaded = load_dashboard(spark, base)
    keys = ["STATE", "MONTH"]
    first = read_gold(spark, base, "01_occupancy_trends").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_01")
    )
    second = loaded["staffing_vs_occupancy"].groupBy(*keys).agg(
        r6(F.avg(STAFFING)).alias("avg_staffing")
    )
    fifth = loaded["nurse_turnover"].groupBy(*keys).agg(
        r6(F.max(f"STATE_AVG_{TOTAL_TURNOVER}")).alias("state_avg")
    )
    joined = first.join(second, keys).join(fifth, keys)
    return joined.select(*keys, "rows_01", "avg_staffing", "state_avg")


# --- manifests and incremental runs ------------------------------------------------------


def manifest_diff(spark, sf):
    old, new, feed = t.manifest_versions(spark, sf)
    return diff(old, new, changed_ids(feed))


def manifest_plan(spark, sf):
    old, new, feed = t.manifest_versions(spark, sf)
    return plan_counts(diff(old, new, changed_ids(feed)))


def cleanup_plan(spark, sf):
    old, new, feed = t.manifest_versions(spark, sf)
    return cleanup(diff(old, new, changed_ids(feed)), new)


def mirror_actions(spark, sf):
    old, new, feed = t.manifest_versions(spark, sf)
    return actions(diff(old, new, changed_ids(feed)), new)


def mirror_swaps(spark, sf):
    """A plan in which keys change owner: moves read what other steps write."""
    old, new = t.swapped_manifests(spark, sf)
    return actions(diff(old, new, old.select("file_id").limit(0)), new)


def mirror_counts(spark, sf):
    return run_counts(mirror_actions(spark, sf))


def tree_paths_walk(spark, sf):
    return tree_paths(t.tree_listing(spark, sf), t.ROOT).select(
        "file_id", "kind", "depth", "relative_path"
    )


def crawl_summary(spark, sf):
    return crawl_counts(tree_paths(t.tree_listing(spark, sf), t.ROOT))


def bootstrap_plan(spark, sf):
    tree = freeze(tree_paths(t.tree_listing(spark, sf), t.ROOT))
    return bootstrap_steps(manifest_rows(tree, t.PREFIX))


def duplicate_keys(spark, sf):
    """(order, line) pairs that several different line items claim."""
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("line"),
        F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
        .alias("item"),
    )
    return shared_keys(lines, "line", "item")


def manifest_state(spark, sf):
    """Two committed manifest versions, the second read back through JSON lines."""
    old, new, _ = t.manifest_versions(spark, sf)
    store = StateStore(spark, scratch_path(spark, "state"))
    store.commit(t.ROOT, "first", old)
    store.commit(t.ROOT, "second", new)
    state = store.read()
    path = scratch_path(spark, "manifest-json")
    write_manifest_json(state.manifest, path)
    return read_manifest_json(spark, path).select(
        "file_id", "s3_key", "md5_checksum", F.lit(state.page_token).alias("token")
    )


def mirror_runs(spark, sf):
    """A first run, then a run with every file in the feed and no applicable change."""
    store = StateStore(spark, scratch_path(spark, "state"))
    listing = t.tree_listing(spark, sf)
    feed = table(spark, sf, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("fileId")
    )

    def run(token: str):
        return mirror(
            store, t.ROOT, t.PREFIX, lambda: listing, feed, lambda: token, lambda steps: None
        )

    first, second = run("one"), run("two")
    booted = first.counts.select(F.lit(first.mode).alias("mode"), "downloaded", "folder_markers_created")
    nothing = second.plan.select(
        F.lit(second.mode).alias("mode"), F.lit(0).cast("long").alias("downloaded"),
        F.lit(0).cast("long").alias("folder_markers_created"),
    ).distinct()
    return booted.unionByName(nothing)


def mirror_incremental(spark, sf):
    """A second run that finds a new subtree, new files and files that are gone."""
    store = StateStore(spark, scratch_path(spark, "state"))
    listing = t.tree_listing(spark, sf)
    number = F.try_to_number(F.substr("file_id", F.lit(2)), F.lit("999999999999")) % 4
    order = F.col("file_id").startswith("o")
    listings = (
        listing.where(~(order & (number == 0)) & (F.col("file_id") != "n3")),
        listing.where(~(order & (number == 1))),
    )
    feed = table(spark, sf, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("fileId")
    )
    for token, listed in enumerate(listings):
        done = mirror(
            store, t.ROOT, t.PREFIX, lambda: listed, feed, lambda: str(token), lambda steps: None
        )
    return done.counts.select(F.lit(done.mode).alias("mode"), *done.counts.columns)


def incremental_stream(spark, sf):
    """Two drops of release files, picked up by two runs of the stream."""
    folder, target, checkpoint = (
        scratch_path(spark, label) for label in ("bronze", "silver", "stream")
    )
    orders = table(spark, sf, "orders")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    for drop in (orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut)):
        t.land_releases(spark, drop, folder)
        snapshot_stream(spark, folder, t.RELEASES, target, checkpoint).awaitTermination()
    return read_silver(spark, target).select(*_RELEASE_COLUMNS)


def _refreshed(spark, drops, age_out=False):
    """Silver after one refresh per drop of release files into one folder."""
    folder, target = (scratch_path(spark, label) for label in ("bronze", "silver"))
    for k, drop in enumerate(drops):
        t.land_releases(spark, drop, folder)
        if age_out and k:
            t.make_old(spark, folder)
        refresh_silver(spark, folder, t.RELEASES, target)
    return read_silver(spark, target).select(*_RELEASE_COLUMNS)


def late_release(spark, sf):
    """Back-filled release files, years older than those already read."""
    orders = table(spark, sf, "orders")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return _refreshed(
        spark, (orders.where(F.col("o_orderdate") >= cut), orders.where(F.col("o_orderdate") < cut)), True
    )


def restated_release(spark, sf):
    """Release files written again under their names with more rows."""
    orders = table(spark, sf, "orders")
    return _refreshed(spark, (orders.where("o_orderkey % 3 > 0"), orders))


def removed_release(spark, sf):
    """Between two refreshes one release goes, one is renamed, and one comes back with fewer rows."""
    folder, target = (scratch_path(spark, label) for label in ("bronze", "silver"))
    orders = table(spark, sf, "orders")
    t.land_releases(spark, orders, folder)
    refresh_silver(spark, folder, t.RELEASES, target)
    t.remove_release(spark, folder, 1995)
    t.rename_release(spark, folder, 1993)
    t.remove_release(spark, folder, 1996)
    fewer = orders.where((F.year("o_orderdate") == 1996) & (F.col("o_orderkey") % 3 > 0))
    t.land_releases(spark, fewer, folder)
    refresh_silver(spark, folder, t.RELEASES, target)
    return read_silver(spark, target).select(*_RELEASE_COLUMNS)


def feed_replay(spark, sf):
    """Change records that are delivered twice in a file, in the next batch, and after a restart, each acted on once."""
    folder, checkpoint, acted = (scratch_path(spark, label) for label in ("feed", "checkpoint", "acted"))
    records = table(spark, sf, "orders").select(
        F.concat(F.lit("f"), "o_orderkey").alias("fileId"),
        (F.col("o_orderstatus") == "F").alias("removed"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("time"),
    )
    some = records.where(F.substring("fileId", -1, 1) < "4")
    for delivered in (some.unionByName(some), some, records):
        delivered.write.mode("append").json(folder)
        stream = change_records(spark, folder).writeStream.foreachBatch(
            lambda batch, _: batch.write.mode("append").parquet(acted)
        )
        stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(columns("fileId string, removed boolean, time string")).parquet(acted)


def _kept_up(spark, sf):
    """Metrics by month after two versions of silver: one month is restated, one comes and one goes."""
    silver = SilverTable(spark, scratch_path(spark, "silver"))
    kept = MonthlyMetrics(spark, scratch_path(spark, "gold"))
    rows = t.facility_silver(spark, sf).withColumns(
        {"SOURCE_FILE_NAME": F.date_format("SNAPSHOT_DATE", "yyyy-MM"), RAW: F.lit(None).cast("string")}
    )
    month, latest = F.col("SNAPSHOT_DATE"), _latest(spark, sf)
    restated, late = F.add_months(F.lit(latest), -2), F.lit(latest)
    extra = rows.where(month == restated).withColumn("SNAPSHOT_DATE", F.add_months(F.lit(latest), 1))
    first = rows.where((month != late) & ((month != restated) | (F.col("CCN").cast("long") % 3 > 0)))
    silver.replace_all(first.unionByName(extra))
    kept.refresh(silver)
    before = silver.version()
    gone = [str(spark.range(1).select(F.add_months(F.lit(latest), k)).first()[0]) for k in (1, -2)]
    silver.commit(before, rows.where((month == restated) | (month == late)), before.schema, gone, None)
    kept.refresh(silver)
    return kept


def monthly_metrics(spark, sf):
    """Nurse turnover of the lookback months from tables that were kept up by touched months."""
    return rounded(
        _kept_up(spark, sf).read("05_nurse_turnover_trends"), TOTAL_TURNOVER, RN_TURNOVER,
        f"STATE_AVG_{TOTAL_TURNOVER}", f"STATE_AVG_{RN_TURNOVER}",
    )


def merged_monthly_turnover(spark, sf):
    """Means by month merged from the kept-up sums of states."""
    sums = _kept_up(spark, sf).read(TURNOVER_SUMS)
    return rounded(merged_turnover(sums, ["MONTH"]), TOTAL_TURNOVER, RN_TURNOVER)


def _misfits(spark, sf):
    folder, target = (scratch_path(spark, label) for label in ("bronze", "silver"))
    t.land_misfits(spark, table(spark, sf, "orders"), folder)
    refresh_silver(spark, folder, t.RELEASES, target)
    return target


def rejected_records(spark, sf):
    """Records with a field too few or too many, as they stand in their files."""
    return rejected_rows(spark, _misfits(spark, sf)).select("SNAPSHOT_DATE", "RECORD")


def release_ledger(spark, sf):
    """What the ledger knows after a refresh and the removal of a release."""
    folder, target = (scratch_path(spark, label) for label in ("bronze", "silver"))
    t.land_misfits(spark, table(spark, sf, "orders"), folder)
    refresh_silver(spark, folder, t.RELEASES, target)
    t.remove_release(spark, folder, 1995)
    refresh_silver(spark, folder, t.RELEASES, target)
    by_month = SilverTable(spark, target).ledger().groupBy("SNAPSHOT_DATE")
    return by_month.agg(
        F.sum("rows").alias("n_rows"), F.sum("malformed").alias("n_malformed"), F.max("removed").alias("removed")
    )


def measure_silver_build(spark, sf):
    """The measure family from its files: typed, with the file each row came from."""
    folder = t.land_measures(spark, table(spark, sf, "orders"), scratch_path(spark, "bronze"))
    target = scratch_path(spark, "silver")
    write_silver(build_silver(spark, folder, MEASURES), target)
    return read_silver(spark, target).select(
        "CCN", "MEASURE_CODE", "SCORE", "FOOTNOTE", "START_DATE", "END_DATE", "SOURCE_FILE_NAME", "SNAPSHOT_DATE"
    )


# Queries named after the operator they run, whose name the function cannot take.
_NAMES = {
    nearest_orders: "nearest_join",
    linear_fit_lines: "linear_fit",
    histogram_quantity: "histogram",
    tree_paths_walk: "tree_paths",
    manifest_state: "manifest_state_json",
    rejected_records: "rejected_rows",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    _NAMES.get(q, q.__name__): q
    for q in (
        scan_parquet, csv_roundtrip_clean, snapshot_discovery, name_month_parse, clean_text_yn,
        document_text_clean, clean_numeric, clean_date, dictionary_typing, drift_union,
        contract_report, lookback_panel, safe_ratio, occupancy_trend, staffing_vs_occupancy,
        low_staffing_ranking, rank_national_state, kpi_cube, latest_per_key, nearest_orders, group_corr,
        global_corr, readmission_correlation, state_month_avg, kpis, state_zscore, linear_fit_lines,
        linear_fit_grid, staffing_points, staffing_trend, topn_lowest, topn_lowest_in_state,
        topn_customers, readmission_points, readmission_trend, strength_label, state_strengths,
        turnover_trend, top_states, turnover_distribution, histogram_quantity, detail_unpivot,
        melt_lines, filter_lists, facility_labels, scope_filter, gold_roundtrip, manifest_diff,
        manifest_plan, cleanup_plan, mirror_actions, mirror_swaps, mirror_counts, tree_paths_walk, crawl_summary,
        bootstrap_plan, duplicate_keys, manifest_state, mirror_runs, mirror_incremental, incremental_stream,
        late_release, restated_release, removed_release, rejected_records, release_ledger, measure_silver_build,
        monthly_metrics, merged_monthly_turnover, feed_replay,
    )
}
