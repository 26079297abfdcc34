"""Session settings the jobs are designed for.

Only settings that suit any size are fixed here.  The number of shuffle
partitions is an upper bound that adaptive execution coalesces at run time, so
it is set by the caller: high on a cluster, near the core count in tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: The JVM never compiles a method of more bytes than this.  Wide plans whose generated method is longer
#: run as separate operators, whose code is cut into small methods; as one method it is interpreted.
METHOD_BYTES = ("spark.sql.codegen.hugeMethodLimit", "8000")

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call-site capture for every column expression is costly on wide plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    METHOD_BYTES[0]: METHOD_BYTES[1],
}


def prefer_compiled(spark: SparkSession) -> None:
    """Set ``METHOD_BYTES`` in a session that was built elsewhere and does not set it."""
    if spark.conf.get(METHOD_BYTES[0], None) is None:
        spark.conf.set(*METHOD_BYTES)


def build_session(master: str | None = None, app: str = "churnpanel", **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
