"""Table shapes and fixed names shared by the whole package."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Variable names of the hourly source and the column each becomes.
SOURCE_VARIABLES = {
    "TMP_2maboveground": "tmp_k",
    "SPFH_2maboveground": "spfh",
    "PRES_surface": "pres_pa",
    "UGRD_10maboveground": "u10",
    "VGRD_10maboveground": "v10",
}

VARIABLES = tuple(SOURCE_VARIABLES.values())

CELL = ("lat_idx", "lon_idx")
TILE = ("tile_row", "tile_col")
TILE_ID = "tile"

# Statistics kept per day, hours in a day, and the default tile
# (cells along latitude, cells along longitude).
STATISTICS = ("min", "mean", "max")
HOURS_PER_DAY = 24
TILE_SHAPE = (128, 256)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


HOURLY = _struct(
    ("year", T.IntegerType()),
    ("ts", T.TimestampNTZType()),
    ("lat_idx", T.IntegerType()),
    ("lon_idx", T.IntegerType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    *((name, T.DoubleType()) for name in VARIABLES),
)

# The stored form, partitioned by year and tile.
TILED_HOURLY = T.StructType(
    [*HOURLY.fields, T.StructField(TILE_ID, T.LongType())]
)

POLYGONS = _struct(
    ("poly_id", T.IntegerType()),
    ("rings", T.ArrayType(T.ArrayType(_struct(("x", T.DoubleType()), ("y", T.DoubleType()))))),
)

VERTICES = _struct(
    ("poly_id", T.IntegerType()),
    ("ring_id", T.IntegerType()),
    ("pos", T.IntegerType()),
    ("x", T.DoubleType()),
    ("y", T.DoubleType()),
)

REGION_CELLS = _struct(
    ("lat_idx", T.IntegerType()),
    ("lon_idx", T.IntegerType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("inside", T.BooleanType()),
)

DAILY = _struct(
    ("metric", T.StringType()),
    ("year", T.IntegerType()),
    (TILE_ID, T.LongType()),
    ("day", T.DateType()),
    ("lat_idx", T.IntegerType()),
    ("lon_idx", T.IntegerType()),
    ("min", T.FloatType()),
    ("mean", T.FloatType()),
    ("max", T.FloatType()),
    ("valid_hours", T.ByteType()),
)

# The stored form: partitioned by attempt, metric, year, block and tile.
STORED_DAILY = T.StructType(
    [*DAILY.fields, T.StructField("attempt", T.StringType()), T.StructField("block", T.IntegerType())]
)

MANIFEST = _struct(("metric", T.StringType()), ("year", T.IntegerType()))

RECORDS = _struct(
    ("metric", T.StringType()),
    ("year", T.IntegerType()),
    ("block", T.IntegerType()),
    ("attempt", T.StringType()),
    ("complete", T.LongType()),
    ("covered", T.LongType()),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema, in its order and types; others are left out."""
    return df.select(*(F.col(field.name).cast(field.dataType) for field in schema))
