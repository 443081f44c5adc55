"""Content routing: choose a topic per record from its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions.text import as_col


def route_topic(body, marker: str = config.ROUTE_MARKER, match: str = config.ROUTE_TOPIC_MATCH,
                other: str = config.ROUTE_TOPIC_OTHER) -> Column:
    """``match`` when the body contains ``marker``, else ``other``.

    Used as the ``topic`` column of a Kafka write, so one write fans records
    out to two topics.
    """
    return F.when(as_col(body).contains(marker), F.lit(match)).otherwise(F.lit(other))
