"""Column defaults of new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: defaults per table
DEFAULTS = {
    "orders": {"status": "PENDING", "total_amount": 0.0},
    "users": {"role": "customer"},
    "inventory": {"quantity": 0, "reserved_quantity": 0},
    "payments": {"status": "PENDING"},
    "inventory_reservations": {"status": "RESERVED"},
}


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Fill the nulls, and add the missing columns, that the table has defaults for."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
            for name, value in DEFAULTS[table].items()
        }
    )
