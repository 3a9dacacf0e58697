"""Sources and sinks (IO): stored marts, views, refresh, layout."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfwise.operators.features import LAGS, history_features
from shelfwise.operators.report import metric_rows, shown
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.star import mart_weekly_store_category, reaggregate_mart
from shelfwise.plans.context import Context, query
from shelfwise.plans.views import create_views, mv_weekly_portfolio
from shelfwise.schema import RAW_TABLES
from shelfwise.session import shared_dir
from shelfwise.sources import crosswalk
from shelfwise.sources.marts import cut_lineage, refresh_mart
from shelfwise.sources.panel import bucketed, read_raw, write_table


@query("io1_csv_round_trip")
def csv_round_trip(cx: Context):
    """Raw stores exported as CSV with a header and read with the declared schema."""
    path = f"{shared_dir(cx.spark)}/raw-stores-{uuid.uuid4().hex}"
    stores = crosswalk.raw_stores(cx.spark, cx.sf_dir).select(*RAW_TABLES["stores"].fieldNames())
    stores.write.option("header", "true").csv(path)
    return read_raw(cx.spark, path, "stores", "csv").select(
        "store_num", "store_name", "city", "state", "msa_code", "seg_value_name", "sales_area_size_num"
    )


@query("io2_declared_schema")
def declared_schema(cx: Context):
    """The raw panel read back under its declared schema, per year."""
    path = f"{shared_dir(cx.spark)}/raw-transactions-{uuid.uuid4().hex}"
    schema = RAW_TABLES["transactions"]
    rows = crosswalk.raw_transactions(cx.spark, cx.sf_dir)
    write_table(rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]), path)
    year = F.year("week_end_date").alias("year")
    return read_raw(cx.spark, path, "transactions").groupBy(year).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("units").alias("units"), F.sum("spend").alias("spend")
    )


@query("io3_clustered_layer")
def clustered_layer(cx: Context):
    """The fact written by year and range of its key, read back per year and month."""
    path = f"{shared_dir(cx.spark)}/fact-layer-{uuid.uuid4().hex}"
    write_table(cx.star.fact, path, partition_by=("year",), cluster_by=("date_key", "store_num", "upc"))
    month = F.floor(F.col("date_key") % 10000 / 100).alias("month")
    return cx.spark.read.schema(cx.star.fact.schema).parquet(path).groupBy("year", month).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("units").alias("units")
    )


@query("io7_metric_report")
def metric_report(cx: Context):
    """Totals of the fact as one metric a row, text beside the number."""
    totals = cx.star.fact.agg(F.sum("units").alias("units"), F.sum("visits").alias("visits"), F.count(F.lit(1)).alias("rows"))
    lines = [(F.lit(name), F.col(name).cast("bigint"), shown(name)) for name in ("units", "visits", "rows")]
    return metric_rows(totals, lines, ("metric", "value", "shown"))


@query("io4_mart_read_back")
def mart_read_back(cx: Context):
    """Store revenue answered from the stored weekly mart, not from the fact."""
    mart = cut_lineage(mart_weekly_store_category(cx.star), "weekly_store_category")
    return reaggregate_mart(mart, "store_num")


@query("io5_view_query")
def view_query(cx: Context):
    create_views(cx.star)
    return cx.spark.sql(
        "SELECT state, sum(total_revenue) AS total_revenue, max(store_count) AS stores FROM vw_category_state GROUP BY state"
    )


@query("io6_refreshed_mart")
def refreshed_mart(cx: Context):
    """Weekly mart written by year, then its last year rewritten in place."""
    mart = mv_weekly_portfolio(cx.star)
    path = f"{shared_dir(cx.spark)}/mv_weekly_portfolio-{uuid.uuid4().hex}"
    refresh_mart(mart, path, ("year",))
    last = cx.star.calendar.agg(F.max("year")).scalar()
    return refresh_mart(mart.filter(F.col("year") == last), path, ("year",))


@query("io8_one_year")
def one_year(cx: Context):
    """Category totals of one year: only that year's folder is read."""
    sales = cx.sales("product").filter("year = 1998")
    return kpi_rollup(sales, ["category"], ["total_revenue", "total_units", "row_count"])


BUCKETS = 16


def bucketed_panel(cx: Context):
    """Key and units of the fact, bucketed by store and product, weeks in order."""
    rows = cx.transactions.select("week_end_date", "store_num", "upc", "units")
    name = f"panel_{uuid.uuid4().hex}"
    return bucketed(rows, name, f"{shared_dir(cx.spark)}/{name}", ["store_num", "upc"], BUCKETS, ["week_end_date"])


@query("io8_bucketed_lags")
def bucketed_lags(cx: Context):
    """Lags per store and product over the bucketed panel: the window needs no exchange."""
    out = history_features(bucketed_panel(cx), fill=False)
    return out.select("week_end_date", "store_num", "upc", *[f"sales_last_{n}_week" for n in LAGS])


@query("io3_interleaved_store_filter")
def interleaved_store_filter(cx: Context):
    """Units per product of one store, from a layer whose files are ranges of store and product."""
    path = f"{shared_dir(cx.spark)}/by_store-{uuid.uuid4().hex}"
    write_table(cx.star.fact.select("store_num", "upc", "units"), path, cluster_by=("store_num", "upc"))
    return cx.spark.read.parquet(path).filter("store_num = 7").groupBy("upc").agg(F.sum("units").alias("units"))
