"""The ledger's columns and the values that are fixed by the data it comes from."""

from __future__ import annotations

from pyspark.sql import types as T

# CSV header name -> ledger column.
SOURCE_COLUMNS = {
    "物业地址楼栋单元门牌号房间号": "property_id",
    "金蝶房源类型": "house_type",
    "最早托管开始时间": "lease_start",
    "最晚托管到期时间": "lease_end",
    "组织": "org",
    "店面": "shop",
    "大类": "category",
    "年份": "year",
    "月份": "month",
    "金额": "amount",
    "日期": "date",
}

# Texts that mean "no value" in a CSV cell, beside the blank cell.
NULL_TOKENS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fields a pivot may use, and its defaults.
ROW_FIELDS = ["property_id", "house_type", "lease_start", "lease_end", "org", "shop"]
COLUMN_FIELDS = ["category", "year", "month", "org", "shop"]
VALUE_FIELDS = ["amount"]
AGGREGATES = ["sum", "mean", "count", "max", "min"]
DEFAULT_ROWS = ["property_id", "house_type"]
DEFAULT_COLUMNS = ["category"]

# Label of totals, and the unit amounts are reported in.
TOTAL = "合计"
UNIT = 10_000

TEXT_COLUMNS = ["property_id", "house_type", "lease_start", "lease_end", "org", "shop", "category"]
DETAIL_COLUMNS = ["property_id", "org", "shop", "category", "month", "amount"]

AMOUNT_TYPE = T.DecimalType(18, 2)

LEDGER_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in TEXT_COLUMNS]
    + [
        T.StructField("year", T.IntegerType(), False),
        T.StructField("month", T.IntegerType(), False),
        T.StructField("amount", AMOUNT_TYPE, False),
        T.StructField("date", T.DateType(), False),
    ]
)
