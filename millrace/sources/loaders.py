"""Dataset loaders: a CSV scan and the shaping each table needs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from millrace.operators.encode import index_table
from millrace.plans.features import fit_mixed_features
from millrace.sources.tables import scan_csv

# The column names of two headerless tables, in file order.
COVER_MEASURES = [
    "Elevation",
    "Aspect",
    "Slope",
    "Horizontal_Distance_To_Hydrology",
    "Vertical_Distance_To_Hydrology",
    "Horizontal_Distance_To_Roadways",
    "Hillshade_9am",
    "Hillshade_Noon",
    "Hillshade_3pm",
    "Horizontal_Distance_To_Fire_Points",
]
COVER_GROUPS = {"Wilderness_Area": 4, "Soil_Type": 40}
COVER_LABEL = "Cover_Type"
CONNECTION_COLUMNS = [
    "duration",
    "protocol_type",
    "service",
    "flag",
    "src_bytes",
    "dst_bytes",
    "land",
    "wrong_fragment",
    "urgent",
    "hot",
    "num_failed_logins",
    "logged_in",
    "num_compromised",
    "root_shell",
    "su_attempted",
    "num_root",
    "num_file_creations",
    "num_shells",
    "num_access_files",
    "num_outbound_cmds",
    "is_host_login",
    "is_guest_login",
    "count",
    "srv_count",
    "serror_rate",
    "srv_serror_rate",
    "rerror_rate",
    "srv_rerror_rate",
    "same_srv_rate",
    "diff_srv_rate",
    "srv_diff_host_rate",
    "dst_host_count",
    "dst_host_srv_count",
    "dst_host_same_srv_rate",
    "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate",
    "dst_host_srv_diff_host_rate",
    "dst_host_serror_rate",
    "dst_host_srv_serror_rate",
    "dst_host_rerror_rate",
    "dst_host_srv_rerror_rate",
    "label",
]


# The columns that hold text.
CONNECTION_TEXTS = ("protocol_type", "service", "flag", "label")


def group_columns(groups: Mapping[str, int]) -> dict[str, list[str]]:
    """The 0/1 columns of each group: name_0, name_1, ..."""
    return {name: [f"{name}_{i}" for i in range(n)] for name, n in groups.items()}


def cover_columns(
    measures: Sequence[str] = COVER_MEASURES, groups: Mapping[str, int] = COVER_GROUPS, label: str = COVER_LABEL
) -> list[str]:
    """Measures, then the 0/1 columns of each group, then the label."""
    return [*measures, *[c for columns in group_columns(groups).values() for c in columns], label]


def load_cover(
    spark: SparkSession,
    path: str,
    measures: Sequence[str] = COVER_MEASURES,
    groups: Mapping[str, int] = COVER_GROUPS,
    label: str = COVER_LABEL,
    schema: StructType | str | None = None,
) -> DataFrame:
    """A headerless table of measures and 0/1 groups; the label becomes a double.

    Measures are read as doubles, all else as integers, in one pass, unless a
    schema says otherwise.
    """
    names = cover_columns(measures, groups, label)
    schema = schema or StructType([StructField(n, DoubleType() if n in measures else IntegerType()) for n in names])
    df = scan_csv(spark, path, header=False, schema=schema, names=names)
    return df.withColumn(label, F.col(label).cast("double"))


def load_binary_numeric(
    spark: SparkSession, path: str, schema: StructType | str | None = None, sampling_ratio: float = 1.0
) -> DataFrame:
    """A numeric table with a header, taken as it is."""
    return scan_csv(spark, path, schema=schema, sampling_ratio=sampling_ratio)


def index_all(df: DataFrame) -> DataFrame:
    """Every column by its frequency index, and nothing else; rows with a null are skipped."""
    return index_table(df, df.columns).select(*[f"{c}_index" for c in df.columns])


def load_categories(
    spark: SparkSession, path: str, schema: StructType | str | None = None, sampling_ratio: float = 1.0
) -> DataFrame:
    return index_all(scan_csv(spark, path, schema=schema, sampling_ratio=sampling_ratio))


def load_mixed(
    spark: SparkSession,
    path: str,
    label: str = "SalePrice",
    drop: Sequence[str] = ("Id",),
    max_categories: int = 20,
    schema: StructType | str | None = None,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """String and number columns as `features` and `indexedFeatures` next to the label."""
    df = scan_csv(spark, path, schema=schema, sampling_ratio=sampling_ratio)
    return fit_mixed_features(df, label, drop, max_categories, invalid="skip").transform(df)


def index_target(df: DataFrame, target: str, drop: Sequence[str] = ()) -> DataFrame:
    """The target by its frequency index; the raw target and the dropped columns go."""
    return index_table(df, [target]).drop(target, *drop)


def load_targets(
    spark: SparkSession,
    path: str,
    target: str = "target",
    drop: Sequence[str] = ("id",),
    schema: StructType | str | None = None,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    return index_target(scan_csv(spark, path, schema=schema, sampling_ratio=sampling_ratio), target, drop)


def load_connections(
    spark: SparkSession,
    path: str,
    names: Sequence[str] = CONNECTION_COLUMNS,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Headerless connection records; the caller holds them if they are read more than once.

    The three categories and the label are text, all else is read as doubles, in
    one pass, unless a schema says otherwise.
    """
    schema = schema or StructType([StructField(n, StringType() if n in CONNECTION_TEXTS else DoubleType()) for n in names])
    return scan_csv(spark, path, header=False, schema=schema, names=names)
