"""Column layouts of every layer. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw event's fields, in the order they are written.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("contract_symbol", T.StringType()),
        T.StructField("expiration_date", T.StringType()),
        T.StructField("strike", T.DoubleType()),
        T.StructField("option_type", T.StringType()),
        T.StructField("bid", T.DoubleType()),
        T.StructField("ask", T.DoubleType()),
        T.StructField("last_price", T.DoubleType()),
        T.StructField("volume", T.IntegerType()),
        T.StructField("open_interest", T.IntegerType()),
        T.StructField("implied_volatility", T.DoubleType()),
        T.StructField("delta", T.DoubleType()),
        T.StructField("underlying_price", T.DoubleType()),
        T.StructField("event_timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

RAW_FIELDS: list[str] = RAW_SCHEMA.names

DERIVED_FIELDS = [
    "unusual_activity_flags",
    "unusual_activity_score",
    "volume_open_interest_ratio",
]

ENRICHED_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [
        T.StructField("unusual_activity_flags", T.ArrayType(T.StringType())),
        T.StructField("unusual_activity_score", T.IntegerType()),
        T.StructField("volume_open_interest_ratio", T.DoubleType()),
    ]
)

ENRICHED_FIELDS: list[str] = ENRICHED_SCHEMA.names


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT = T.StringType()
_MONEY = T.DecimalType(12, 4)

# Warehouse tables: natural columns. Audit columns and the directory partition `load_id`
# come on top, see `warehouse_schema`.
WAREHOUSE_COLUMNS: dict[str, T.StructType] = {
    "dim_symbol": _struct(symbol=_TEXT),
    "dim_option_contract": _struct(
        contract_symbol=_TEXT,
        symbol=_TEXT,
        option_type=_TEXT,
        strike=T.DecimalType(12, 2),
        expiration_date=T.DateType(),
    ),
    "fact_options_event": _struct(
        event_id=_TEXT,
        contract_symbol=_TEXT,
        symbol=_TEXT,
        option_type=_TEXT,
        strike=T.DecimalType(12, 2),
        expiration_date=T.DateType(),
        bid=_MONEY,
        ask=_MONEY,
        last_price=_MONEY,
        volume=T.IntegerType(),
        open_interest=T.IntegerType(),
        volume_open_interest_ratio=_MONEY,
        implied_volatility=_MONEY,
        delta=_MONEY,
        underlying_price=_MONEY,
        unusual_activity_score=T.IntegerType(),
        event_timestamp=T.TimestampNTZType(),
        source=_TEXT,
    ),
    "fact_unusual_activity": _struct(
        event_id=_TEXT,
        contract_symbol=_TEXT,
        symbol=_TEXT,
        flag=_TEXT,
        event_timestamp=T.TimestampNTZType(),
    ),
}

WAREHOUSE_KEYS: dict[str, list[str]] = {
    "dim_symbol": ["symbol"],
    "dim_option_contract": ["contract_symbol"],
    "fact_options_event": ["event_id"],
    "fact_unusual_activity": ["event_id", "flag"],
}

# Columns that may be null in a loaded row; every other natural column may not.
WAREHOUSE_NULLABLE: dict[str, set[str]] = {
    "dim_symbol": set(),
    "dim_option_contract": set(),
    "fact_options_event": {"volume_open_interest_ratio"},
    "fact_unusual_activity": set(),
}

# table -> (surrogate id column or None, audit timestamp column)
WAREHOUSE_AUDIT: dict[str, tuple[str | None, str]] = {
    "dim_symbol": ("symbol_id", "created_at"),
    "dim_option_contract": ("contract_id", "created_at"),
    "fact_options_event": (None, "loaded_at"),
    "fact_unusual_activity": ("activity_id", "loaded_at"),
}


def warehouse_schema(table: str) -> T.StructType:
    """Stored layout of a warehouse table, audit columns and `load_id` included."""
    id_column, time_column = WAREHOUSE_AUDIT[table]
    fields = list(WAREHOUSE_COLUMNS[table].fields)
    if id_column:
        fields.insert(0, T.StructField(id_column, T.StringType()))
    fields.append(T.StructField(time_column, T.TimestampNTZType()))
    fields.append(T.StructField("load_id", T.StringType()))
    return T.StructType(fields)
