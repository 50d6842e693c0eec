"""Rows a keyed table cannot hold, and repeated deliveries."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickmill.schema import KEYS


def has_key() -> Column:
    """Whether a row has the product and the event time its key is made of.

    On rows just decoded from JSON use it as a column: as a filter it would be moved below
    the decoding, and each payload parsed again for it.
    """
    product, hour = KEYS
    return F.col(product).isNotNull() & F.col(hour).isNotNull()


#: Name of the counts that streams report with their progress.
DELIVERED = "delivered"


def counted(activity: DataFrame, observation: Observation | str = DELIVERED, time: str = "timestamp_hour") -> DataFrame:
    """The same rows, counted on their way: `received`, and of these `rejected` for want of a product or time.

    Spark adds the counts up in the pass that is made anyway. A batch reads them from its
    Observation, a stream reports them under the name with each micro-batch.
    """
    keyed = F.col("product").isNotNull() & F.col(time).isNotNull()
    return activity.observe(observation, F.count(F.lit(1)).alias("received"), F.count_if(~keyed).alias("rejected"))


def split_malformed(activity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of stored activity; only accepted ones can be keyed."""
    return activity.where(has_key()), activity.where(~has_key())


def drop_duplicate_events(events: DataFrame, id_columns: list[str]) -> DataFrame:
    """One row per event id, such as Kafka's topic, partition and offset.

    Copies are dropped before the shuffle too, so a much-repeated event stays cheap. On a
    stream with a watermark the ids are forgotten once the watermark has passed; there the
    copies of a micro-batch meet in one task, which keeps one id and no rows.
    """
    if events.isStreaming:
        return events.dropDuplicatesWithinWatermark(id_columns)
    return events.dropDuplicates(id_columns)
