"""Column contracts of the tables read and written."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE, TIME, BOOL = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.TimestampType(),
    T.BooleanType(),
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


POINTS = _schema(
    courierid=STRING, acc=DOUBLE, status=INT, createdat=TIME, lat=DOUBLE, lon=DOUBLE,
    orderid=STRING, foodorder=STRING, artisanorder=STRING, dt=STRING,
)
ROUTE_DOCS = T.StructType(
    [
        T.StructField("_id", STRING),
        T.StructField("route", T.ArrayType(_schema(coordinates=T.ArrayType(DOUBLE), time=TIME, acc=DOUBLE))),
    ]
)
TIME_ZONES = _schema(country_id=STRING, time_zone=STRING)
STATUS_LOG = _schema(
    data_foodorder=STRING, data_method=STRING, location__coordinates_lat=DOUBLE,
    location__coordinates_lon=DOUBLE, createdatl=TIME,
)
COURIER_DOMAINS = _schema(_p_id_oid=STRING, domaintypes=INT)

# The date columns of the four prediction shapes.
EVENT_SHAPES = {
    "reach": ("predicted_reach_date", "predicted_reach_dateL"),
    "depart": ("predicted_depart_date", "predicted_depart_dateL"),
    "depart_from_client": ("predicted_depart_from_client_date", "predicted_depart_from_client_dateL"),
    "delivery": ("predicted_delivery_date", "predicted_delivery_dateL"),
}

# Table of each (event, business line) and the shape it has.
PREDICTION_TABLES = {
    ("reach", 1): ("reach_date_prediction", "reach"),
    ("reach", 2): ("food_reach_date_prediction", "reach"),
    ("reach", 4): ("water_reach_date_prediction", "reach"),
    ("reach", 6): ("artisan_reach_date_prediction", "reach"),
    ("reach_to_merchant", 2): ("reach_to_restaurant_date_prediction", "reach"),
    ("reach_to_merchant", 6): ("reach_to_shop_date_prediction", "reach"),
    ("depart", 1): ("depart_date_prediction", "depart"),
    ("depart", 4): ("water_depart_date_prediction", "depart"),
    ("depart_from_courier_warehouse", 2): ("food_depart_date_prediction", "depart"),
    ("depart_from_courier_warehouse", 6): ("artisan_depart_date_prediction", "depart"),
    ("depart_from_merchant", 2): ("food_depart_from_merchant_date_prediction", "depart"),
    ("depart_from_merchant", 6): ("artisan_depart_from_merchant_date_prediction", "depart"),
    ("depart_from_client", 1): ("depart_from_client_date_prediction", "depart_from_client"),
    ("depart_from_client", 4): ("water_depart_from_client_date_prediction", "depart_from_client"),
    ("deliver", 1): ("delivery_date_prediction", "delivery"),
    ("deliver", 4): ("water_delivery_date_prediction", "delivery"),
}
# The tables that are cleared of older rows after each run.
DEDUPLICATED_TABLES = (
    "reach_date_prediction",
    "depart_date_prediction",
    "depart_from_client_date_prediction",
    "reach_to_shop_date_prediction",
    "reach_to_restaurant_date_prediction",
    "delivery_date_prediction",
    "food_depart_date_prediction",
    "artisan_depart_date_prediction",
    "water_reach_date_prediction",
    "water_depart_date_prediction",
    "water_depart_from_client_date_prediction",
    "water_delivery_date_prediction",
)


def staged_columns(shape: str) -> list[str]:
    """Columns a prediction file carries, in file order."""
    return ["order_id", *EVENT_SHAPES[shape], "latitude", "longitude"]


def staged_schema(shape: str) -> T.StructType:
    kinds = [STRING, TIME, TIME, DOUBLE, DOUBLE]
    return T.StructType([T.StructField(n, k) for n, k in zip(staged_columns(shape), kinds, strict=True)])


def prediction_schema(shape: str) -> T.StructType:
    """A prediction table: what the file carries between an id and the load time."""
    return T.StructType(
        [T.StructField("prediction_id", LONG, False), *staged_schema(shape).fields, T.StructField("predictedat", TIME)]
    )


def table_of(event: str, domain_type: int) -> tuple[str, str]:
    """(table name, shape) for an event of a business line; 3 is market like 1."""
    return PREDICTION_TABLES[(event, 1 if domain_type == 3 else domain_type)]


# Plain column types by inferred kind, never narrower than the data.
KIND_TO_TYPE = {
    "object": STRING,
    "float64": DOUBLE,
    "int64": LONG,
    "datetime64[ns]": TIME,
    "bool": BOOL,
}


def schema_from_kinds(kinds: dict[str, str], overrides: dict[str, T.DataType] | None = None) -> T.StructType:
    """Table schema for columns given by inferred kind, with chosen types taking precedence."""
    chosen = overrides or {}
    return T.StructType([T.StructField(n, chosen.get(n, KIND_TO_TYPE[k])) for n, k in kinds.items()])
