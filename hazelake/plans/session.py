"""Session settings of the jobs; every other function runs on whatever session the caller owns."""

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}

_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_BYTES_PER_PARTITION = 256 * 1024 * 1024


def create_session(app_name: str = "hazelake", **settings: str) -> SparkSession:
    """Get or create a session: adaptive execution, dynamic partition overwrite, UTC.

    Dates derive from the session time zone, hence UTC. Further settings are passed through.
    """
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Let shuffles of this session start with about one partition per 256 MB of input; returns that number.

    Adaptive execution joins small shuffle partitions but never cuts those of an aggregate, so the
    default of two hundred would be too coarse for a large dump. A value that is set already stays. For whoever owns
    the session, as the command line does; no other function of the library changes a session's settings.
    """
    given = spark.conf.get(_INITIAL_PARTITIONS, None)
    if given:
        return int(given)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(least, -(-input_bytes // _BYTES_PER_PARTITION))
    spark.conf.set(_INITIAL_PARTITIONS, str(wanted))
    return wanted
