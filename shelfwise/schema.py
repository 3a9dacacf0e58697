"""Declared schemas of the retail panel: raw lookups, staging and marts."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


RAW_TRANSACTIONS = _struct(
    week_end_date=T.DateType(),
    store_num=T.IntegerType(),
    upc=T.LongType(),
    units=T.LongType(),
    visits=T.LongType(),
    hhs=T.LongType(),
    spend=MONEY,
    price=MONEY,
    base_price=MONEY,
    feature=T.IntegerType(),
    display=T.IntegerType(),
    tpr_only=T.IntegerType(),
)
RAW_PRODUCTS = _struct(
    upc=T.LongType(),
    category=T.StringType(),
    description=T.StringType(),
    manufacturer=T.StringType(),
    sub_category=T.StringType(),
    product_size=T.StringType(),
)
RAW_STORES = _struct(
    store_num=T.IntegerType(),
    store_name=T.StringType(),
    city=T.StringType(),
    state=T.StringType(),
    msa_code=T.IntegerType(),
    seg_value_name=T.StringType(),
    parking_space_qty=T.DecimalType(8, 2),
    sales_area_size_num=T.IntegerType(),
    avg_weekly_baskets=T.DecimalType(12, 2),
)

TRANSACTION_KEY = ("week_end_date", "store_num", "upc")
RAW_TABLES = {
    "transactions": RAW_TRANSACTIONS,
    "products": RAW_PRODUCTS,
    "stores": RAW_STORES,
}
