"""Windows of two datasets side by side, on a stream.

The batch form (:func:`tidewatch.operators.serving.temp_humi_by_window`) pivots a
finished table.  On a stream, each dataset's windows close when the watermark passes
their end; a full outer join on the window pairs them, and gives a null for a side
that had no reading once no such window can come any more.  Both sides keep only
windows that are not yet closed, so the state is bounded by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.config import READING_COLS, Cols
from tidewatch.functions.timefmt import format_winstart
from tidewatch.operators.windows import window_column


def stream_temp_humi(readings: DataFrame, temperature: str = config.TEMPERATURE, humidity: str = config.HUMIDITY,
                     size: str = config.WINDOW_SIZE, slide: str = config.WINDOW_SLIDE, cols: Cols = READING_COLS) -> DataFrame:
    """Watermarked readings -> closed windows with both maxima (append mode):
    ``win_start, winstart, temp_max, humi_max``."""
    def side(dataset: str, name: str) -> DataFrame:
        return (
            readings.where(F.col(cols.dataset) == F.lit(dataset)).groupBy(window_column(cols.ts, size, slide).alias("w"))
            .agg(F.max(cols.value).alias(name))
        )

    joined = side(temperature, "temp_max").join(side(humidity, "humi_max"), "w", "full_outer")
    return joined.select(F.col("w.start").alias("win_start"), format_winstart(F.col("w.start")).alias("winstart"), "temp_max", "humi_max")
