"""Typed schemas of the four declared entities and of the alert row.
Required fields are non-nullable."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, StringType, StructField, StructType,
    TimestampType,
)

from ledgerlens import config as C

MONEY = DecimalType(18, 4)

# declared type per field (STRING unless listed)
_TYPES = {
    "transaction_date": DateType(), "transaction_time": TimestampType(), "quantity": MONEY,
    "unit_price": MONEY, "cost_price": MONEY, "total_amount": MONEY, "discount_amount": MONEY,
    "tax_amount": MONEY, "final_amount": MONEY, "payment_due_date": DateType(),
    "payment_received_date": DateType(), "amount_paid": MONEY, "snapshot_date": DateType(),
    "quantity_on_hand": MONEY, "last_sale_date": DateType(), "last_purchase_date": DateType(),
    "reorder_level": MONEY, "credit_limit": MONEY, "credit_period_days": IntegerType(),
    "registration_date": DateType(), "standard_cost": MONEY, "standard_price": MONEY,
    "is_active": BooleanType(),
}


def entity_schema(entity: str) -> StructType:
    return StructType([StructField(name, _TYPES.get(name, StringType()), not required)
                       for name, required in C.ENTITY_FIELDS[entity]])


SALES = entity_schema("sales_transactions")
INVENTORY = entity_schema("inventory")
CUSTOMERS = entity_schema("customers")
PRODUCTS = entity_schema("products")

ALERT = StructType([
    StructField("alert_type", StringType(), False), StructField("severity", StringType(), True),
    StructField("entity", StringType(), True), StructField("metric_value", DoubleType(), True),
    StructField("threshold", DoubleType(), True), StructField("message", StringType(), True),
    StructField("action", StringType(), True), StructField("timestamp", TimestampType(), True),
])

