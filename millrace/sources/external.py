"""Options for sources that live outside Spark.  Every value comes from the caller."""

from __future__ import annotations


def kafka_options(
    topics: str, servers: str, starting: str = "latest", **extra: str
) -> dict[str, str]:
    """Reader options for one topic or a comma-separated list of topics."""
    names = [t.strip() for t in (topics or "").split(",") if t.strip()]
    if not names:
        raise ValueError("topics must name at least one topic")
    if not servers or not servers.strip():
        raise ValueError("servers must name at least one broker")
    if starting not in ("latest", "earliest") and not starting.lstrip().startswith("{"):
        raise ValueError("starting must be latest, earliest or a JSON offset map")
    return {
        "kafka.bootstrap.servers": servers.strip(),
        "subscribe": ",".join(names),
        "startingOffsets": starting,
        **extra,
    }


def kafka_lines(spark, options: dict[str, str]):
    """Record values as text lines, shaped like every other line source."""
    return spark.readStream.format("kafka").options(**options).load().selectExpr(
        "cast(value as string) as value"
    )


def jdbc_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options for a database table, split over tasks when a column is given."""
    if not url.startswith("jdbc:"):
        raise ValueError("url must start with jdbc:")
    options = {"url": url, "dbtable": table, **extra}
    if partition_column:
        if bounds is None or partitions is None:
            raise ValueError("a partition column needs bounds and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options
