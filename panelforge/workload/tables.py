"""The star-schema tables seen as snapshot data.

A customer is a facility, an order is one facility row of a monthly snapshot, an order of
top priority is one row of the measure table, and region / nation / customer / order form
a file tree. NULLs and dirty text, which the tables lack, are derived from their values.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.dictionaries import FACILITY, SnapshotFamily
from panelforge.operators.manifest import FOLDER_MIME, SHORTCUT_MIME
from panelforge.plans.metrics import READMISSION_MEASURE
from panelforge.runtime import scratch_path
from panelforge.sources.snapshots import CSV_OPTIONS
from panelforge.sources.state import hadoop_path

ROOT = "root"
PREFIX = "mirror"
NATIVE_DOCUMENT = "application/vnd.google-apps.document"


# Schemas already read, so that a table used several times opens its footers once.
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def order_month() -> Column:
    """Month of the day before the order, so that the last month is a whole one."""
    return F.trunc(F.date_sub(order_day(), 1), "month")


def facility_silver(
    spark: SparkSession, sf: str, since: datetime.date | None = None
) -> DataFrame:
    """The facility rows, all or those of month ``since`` and later.

    The month is computed from the order time, so a filter on it stops at the projection;
    ``since`` says the same about the stored column and reaches the scan.
    """
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    if since is not None:
        first_day = datetime.datetime.combine(since, datetime.time()) + datetime.timedelta(days=1)
        orders = orders.where(F.col("o_orderdate") >= F.lit(str(first_day)).cast("timestamp_ntz"))
    facilities = customer.join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    balance, price = F.col("c_acctbal"), F.col("o_totalprice")
    beds = F.when(balance > 0, F.floor(balance / 50)).otherwise(0).cast("double")
    priority = F.col("o_orderpriority")
    return orders.join(facilities, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").cast("string").alias("CCN"),
        F.col("c_name").alias("PROVIDER_NAME"),
        F.nullif("n_name", F.lit("NATION_0")).alias("STATE"),
        order_month().alias("SNAPSHOT_DATE"),
        F.when(F.col("c_mktsegment") != "MACHINERY", beds).alias("NUMBER_OF_CERTIFIED_BEDS"),
        (price / 2500.9).alias("AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY"),
        F.when(priority != "5-LOW", price / 97001.3).alias(
            "REPORTED_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY"
        ),
        F.when(F.col("o_orderstatus") != "P", price / 5101.3).alias(
            "TOTAL_NURSING_STAFF_TURNOVER"
        ),
        F.when(priority != "4-NOT SPECIFIED", 100.0 - price / 5101.3).alias(
            "REGISTERED_NURSE_TURNOVER"
        ),
    )


def measure_silver(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    score = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string"))
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("CCN"),
        F.when(priority == "1-URGENT", F.lit(READMISSION_MEASURE))
        .otherwise(priority)
        .alias("MEASURE_CODE"),
        F.coalesce(score, F.lit("Not Available")).alias("SCORE"),
        F.date_sub(order_day(), 365).alias("START_DATE"),
        order_day().alias("END_DATE"),
        order_month().alias("SNAPSHOT_DATE"),
    )


def mixed_date_text(d: Column) -> Column:
    """A date in the layout that goes with the order's priority; junk for one status."""
    priority = F.col("o_orderpriority")
    return (
        F.when(F.col("o_orderstatus") == "P", F.lit("13/45/2024"))
        .when(priority == "1-URGENT", F.date_format(d, "MM/dd/yyyy"))
        .when(priority == "2-HIGH", F.date_format(d, "M/d/yyyy"))
        .when(priority == "3-MEDIUM", F.date_format(d, "yyyy-MM-dd"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(d, "MM-dd-yyyy"))
        .otherwise(F.lit(" n/a "))
    )


def decorated_price() -> Column:
    """Prices with signs and separators, and two ways of saying there is none."""
    amount = F.format_number("o_totalprice", 2)
    priority = F.col("o_orderpriority")
    return (
        F.when(F.col("o_orderstatus") == "P", F.lit(" N/A "))
        .when(priority == "5-LOW", F.lit("Not Available"))
        .when(priority == "3-MEDIUM", F.concat(F.lit(" "), amount, F.lit("%")))
        .otherwise(F.concat(F.lit("$"), amount))
    )


def flag_text() -> Column:
    status = F.col("o_orderstatus")
    return F.when(status == "P", F.lit(" y ")).when(status == "O", F.lit("n")).otherwise(F.lit("  "))


# Yearly release files of orders, several parts per release.
RELEASES = SnapshotFamily(
    label="order releases",
    file_pattern=r"(?i)^orders_[0-9]+_[A-Za-z]+[0-9]{4}\.csv$",
    kinds=FACILITY.kinds,
    required=("CCN",),
)
LAYOUT_CHANGE = 1998


def land_releases(spark: SparkSession, orders: DataFrame, folder: str) -> str:
    """Write ``orders`` as release files named by month, with the layout changing once.

    The earlier layout has other column order and lacks one column.
    """
    year = F.year("o_orderdate")
    raw = orders.select(
        year.alias("_year"),
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("CMS Certification Number (CCN)"),
        F.col("o_orderkey").cast("string").alias("Order Number"),
        flag_text().alias("Abuse Icon"),
        mixed_date_text(order_day()).alias("Processing Date"),
        decorated_price().alias("Total Amount of Fines in Dollars"),
        F.col("o_orderstatus").alias("Order Status"),
        F.concat(F.lit("January"), year.cast("string")).alias("release"),
    )
    late = raw.where(F.col("_year") >= LAYOUT_CHANGE).drop("_year")
    early = raw.where(F.col("_year") < LAYOUT_CHANGE).select(
        *[c for c in reversed(raw.columns) if c not in ("_year", "Order Status")]
    )
    target, fs = hadoop_path(spark, folder)
    fs.mkdirs(target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for frame in (early, late):
        staged = scratch_path(spark, "landing")
        options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("inferSchema", "mode")}
        frame.write.partitionBy("release").options(**options).csv(staged)
        parts = fs.globStatus(path(f"{staged}/release=*/part-*.csv")) or []
        for number, part in enumerate(parts):
            release = part.getPath().getParent().getName().split("=")[1]
            named = path(f"{folder}/orders_{number}_{release}.csv")
            fs.delete(named, False)
            fs.rename(part.getPath(), named)
    return folder


def _release_files(spark: SparkSession, folder: str, year: int):
    """File system and paths of one release's files."""
    pattern, fs = hadoop_path(spark, f"{folder}/orders_*_January{year}.csv")
    return fs, [status.getPath() for status in fs.globStatus(pattern) or []]


def remove_release(spark: SparkSession, folder: str, year: int) -> None:
    fs, paths = _release_files(spark, folder, year)
    for path in paths:
        fs.delete(path, False)


def rename_release(spark: SparkSession, folder: str, year: int) -> None:
    """The same contents under other names of the family."""
    fs, paths = _release_files(spark, folder, year)
    for path in paths:
        fs.rename(path, hadoop_path(spark, f"{folder}/{path.getName().replace('orders_', 'orders_9')}")[0])


def land_misfits(spark: SparkSession, orders: DataFrame, folder: str) -> str:
    """Release files in which some records lack their last field and some have one too many."""
    key = F.col("o_orderkey")
    last = F.when(key % 10 == 0, F.lit(None)).when(key % 10 == 1, F.lit("O,x y")).otherwise(F.col("o_orderstatus"))
    record = F.concat_ws(",", F.lpad(F.col("o_custkey").cast("string"), 6, "0"), key.cast("string"), last)
    release = F.concat(F.lit("January"), F.year("o_orderdate").cast("string"))
    # The whole record is one column here, under a name that is the whole header.
    lines = orders.select(record.alias("CMS Certification Number (CCN),Order Number,Order Status"), release.alias("release"))
    staged = scratch_path(spark, "landing")
    lines.write.partitionBy("release").options(header="true", sep=";").csv(staged)
    return _named(spark, staged, folder, "orders_{number}_{release}.csv")


def land_measures(spark: SparkSession, orders: DataFrame, folder: str) -> str:
    """Orders as measure files, one a month."""
    frame = orders.select(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("CMS Certification Number (CCN)"),
        F.concat(F.lit("S_"), F.col("o_orderkey").cast("string")).alias("Measure Code"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Not Available"))
        .otherwise(F.concat(F.lit(" "), (F.col("o_custkey") % 100).cast("string"))).alias("Score"),
        F.substring("o_orderpriority", 1, 1).alias("Footnote"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Start Date"),
        F.date_format(F.date_add("o_orderdate", 30), "MM/dd/yyyy").alias("End Date"),
        F.date_format("o_orderdate", "MMMMyyyy").alias("release"),
    )
    staged = scratch_path(spark, "landing")
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("inferSchema", "mode")}
    frame.repartition("release").write.partitionBy("release").options(**options).csv(staged)
    return _named(spark, staged, folder, "Skilled_Nursing_Facility_Quality_Reporting_Program_Provider_Data_{release}.csv")


def _named(spark: SparkSession, staged: str, folder: str, pattern: str) -> str:
    """Move written parts to ``folder`` under the names of a family."""
    target, fs = hadoop_path(spark, folder)
    fs.mkdirs(target)
    found, _ = hadoop_path(spark, f"{staged}/release=*/part-*.csv")
    for number, part in enumerate(fs.globStatus(found) or []):
        release = part.getPath().getParent().getName().split("=")[1]
        fs.rename(part.getPath(), hadoop_path(spark, f"{folder}/{pattern.format(number=number, release=release)}")[0])
    return folder


def tree_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The tables as a listing of folders and files under one root."""
    folder, none = F.lit(FOLDER_MIME), F.lit(None)

    def folders(df: DataFrame, letter: str, key: str, name: Column, parent: Column) -> DataFrame:
        return df.select(
            F.concat(F.lit(letter), F.col(key).cast("string")).alias("file_id"),
            name.alias("name"),
            parent.alias("parent_id"),
            folder.alias("mime_type"),
            none.cast("string").alias("size"),
            none.cast("string").alias("modified_time"),
            none.cast("string").alias("md5_checksum"),
            none.cast("boolean").alias("can_download"),
        )

    def under(letter: str, key: str) -> Column:
        return F.concat(F.lit(letter), F.col(key).cast("string"))

    regions = folders(
        table(spark, sf, "region"), "r", "r_regionkey", F.col("r_name"), F.lit(ROOT)
    )
    # Slashes in names, which the mirror has to neutralise.
    nations = folders(
        table(spark, sf, "nation"), "n", "n_nationkey",
        F.translate("n_name", "_", "/"), under("r", "n_regionkey"),
    )
    customers = folders(
        table(spark, sf, "customer"), "c", "c_custkey", F.col("c_name"), under("n", "c_nationkey")
    )
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    files = table(spark, sf, "orders").select(
        under("o", "o_orderkey").alias("file_id"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("name"),
        under("c", "o_custkey").alias("parent_id"),
        F.when(status == "P", F.lit(NATIVE_DOCUMENT))
        .when(priority == "5-LOW", F.lit(SHORTCUT_MIME))
        .otherwise(F.lit("text/csv"))
        .alias("mime_type"),
        F.length("o_orderpriority").cast("string").alias("size"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("modified_time"),
        F.md5(F.col("o_orderkey").cast("string")).alias("md5_checksum"),
        F.when(status == "O", priority != "4-NOT SPECIFIED").alias("can_download"),
    )
    return regions.unionByName(nations).unionByName(customers).unionByName(files)


# Two versions of a manifest: each customer's last order per priority, as known at the
# cutoff, and as known at the end for what was ordered since the horizon.
CUTOFF = "2000-08-01"
HORIZON = "1999-01-01"


def manifest_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Old manifest, new manifest and the change feed between them."""
    orders = table(spark, sf, "orders").withColumn(
        "file_id", F.concat_ws("-", F.col("o_custkey").cast("string"), "o_orderpriority")
    )

    def version(rows: DataFrame) -> DataFrame:
        # Status and size class of the last order by (date, key), combined on the map side.
        last = rows.groupBy("file_id").agg(
            F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")).alias("l")
        )
        status = F.col("l.o_orderstatus")
        size = F.when(F.col("l.o_totalprice") > 250000, F.lit("big")).otherwise(F.lit("small"))
        path = F.concat_ws("/", status, F.col("file_id"))
        return last.select(
            "file_id",
            F.lit("file").alias("type"),
            F.col("file_id").alias("name"),
            path.alias("relative_path"),
            F.concat(F.lit(PREFIX + "/"), path).alias("s3_key"),
            F.lit(ROOT).alias("parent_id"),
            F.lit("text/csv").alias("mime_type"),
            size.alias("size"),
            F.date_format("l.o_orderdate", "yyyy-MM-dd").alias("modified_time"),
            F.when(status != "P", F.md5(size)).alias("md5_checksum"),
        )

    feed = orders.where(F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp_ntz")).select(
        F.col("file_id").alias("fileId"),
        F.lit(False).alias("removed"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("time"),
    )
    old = version(orders.where(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")))
    new = version(orders.where(F.col("o_orderdate") >= F.lit(HORIZON).cast("timestamp_ntz")))
    return old, new, feed


def swapped_manifests(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Each customer's orders numbered from the first, and later from the last: the numbered
    places stay and change owner."""
    orders = table(spark, sf, "orders")

    def version(rows: DataFrame, order) -> DataFrame:
        number = F.row_number().over(Window.partitionBy("o_custkey").orderBy(order))
        path = F.concat_ws("/", F.col("o_custkey").cast("string"), number.cast("string"))
        return rows.select(
            F.col("o_orderkey").cast("string").alias("file_id"),
            F.lit("file").alias("type"),
            path.alias("relative_path"),
            F.concat(F.lit(PREFIX + "/"), path).alias("s3_key"),
            F.lit("m").alias("md5_checksum"),
        )

    date = F.col("o_orderdate")
    old = version(orders.where(date < F.lit(CUTOFF).cast("timestamp_ntz")), F.col("o_orderkey"))
    new = version(
        orders.where(date >= F.lit("1995-01-01").cast("timestamp_ntz")), F.col("o_orderkey").desc()
    )
    return old, new


def make_old(spark: SparkSession, folder: str, days: int = 400) -> None:
    """Set back the modification times of all files directly in ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)
