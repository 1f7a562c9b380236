"""Session and table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Settings for sessions made here. A session given by the caller keeps its own, but for the one setting of ``tune``.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
#: The JVM compiles no method beyond this many bytes of bytecode. A stage whose fused method is larger runs interpreted, many times slower
#: than its operators one by one.
_HUGE_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")


def tune(spark: SparkSession) -> SparkSession:
    """Lower the codegen limit of a session that has Spark's default: results are lazy, so it must hold when the caller runs them. Nothing else is set."""
    key, value = _HUGE_METHOD
    if spark.conf.get(key, None) in (None, "65535"):
        spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` overrides them (dots as ``__``)."""
    given = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    return SparkSession.builder.master(master).appName("axonframe").config(map=given).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")
