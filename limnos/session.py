"""Sessions with the settings that the engine's results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",  # day buckets and bounds are days of UTC
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(name: str = "limnos", **settings: str) -> SparkSession:
    """A session with the engine's settings; further ones as keywords, "__" for each dot."""
    builder = SparkSession.builder.appName(name)
    for k, v in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def object_store(region: str, endpoint: str | None = None) -> dict[str, str]:
    """Hadoop settings to read an object store with the instance's own credentials; no secrets are passed here."""
    out = {"spark.hadoop.fs.s3a.endpoint.region": region}
    if endpoint:
        out["spark.hadoop.fs.s3a.endpoint"] = endpoint
    return out
