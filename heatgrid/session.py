"""Session settings the package is made for, and folders."""

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

RECOMMENDED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # The JVM interprets methods beyond this size. A stage that large runs faster
    # operator by operator, which is what Spark falls back to at this limit.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the call site of every column expression slows plan building down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Years of a run share the executors instead of queueing.
    "spark.scheduler.mode": "FAIR",
}


def build_session(app_name: str = "heatgrid", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings above; ``settings`` use ``__`` for the dots in a key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = dict(RECOMMENDED_SETTINGS)
    chosen.update({key.replace("__", "."): value for key, value in settings.items()})
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in spark.checkpoint.dir.

    Without that setting, a session whose executors share this machine may use its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def few_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Rows that the driver knows, as part of the plan: reading them takes no Python worker."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), to_arrow_schema(schema))]
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names)).to(schema)


def folders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths below ``root`` that match a glob pattern of as many parts."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{pattern}")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    depth = pattern.count("/") + 1
    return ["/".join(status.getPath().toString().split("/")[-depth:]) for status in found]


def in_parallel(spark: SparkSession, tasks: Sequence[Callable[[], object]], at_once: int) -> list:
    """Results of the tasks in their order, with up to ``at_once`` of them sending jobs at the same time.

    Each runs in a pool of its own of the fair scheduler and inherits job group and other properties of the
    caller. After an error no further task begins; the error of the earliest task that failed is raised
    once those under way have ended.
    """
    context = spark.sparkContext

    def pooled(number: int, task: Callable[[], object]) -> Callable[[], object]:
        def run() -> object:
            context.setLocalProperty("spark.scheduler.pool", f"heatgrid-{number % at_once}")
            return task()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        futures = [pool.submit(pooled(number, task)) for number, task in enumerate(tasks)]
        results, failed = [], None
        for future in futures:
            if failed is not None and future.cancel():
                continue
            error = future.exception()
            failed = failed or error
            results.append(None if error else future.result())
    if failed is not None:
        raise failed
    return results
