"""Messages that a producer delivers more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTENT, PLACE = "content", "place"
_ARRIVED, _DIGEST = "_arrived", "_digest"


def without_redelivered(messages: DataFrame, within: str, by: str = CONTENT) -> DataFrame:
    """A stream of messages (columns of a message log) without those that arrived before, ``within`` an interval such as
    ``2 hours``.

    ``by`` content compares topic and message: a producer that sends again gives the message another offset. ``by`` place
    compares topic, partition and offset: for a source that reads twice. Messages are remembered in the query's state store,
    by their digest and not by their text, for the interval after they first arrived, so the state is bounded by what
    arrives meanwhile.

    The clock is the arrival of the micro-batch, which Spark keeps with the batch and uses again when it is repeated. By this
    clock no message is late, so none is lost, however old the time in it is.
    """
    if by == CONTENT:
        keys, seen = ["topic", _DIGEST], messages.withColumn(_DIGEST, F.sha2(F.col("value").cast("binary"), 256))
    elif by == PLACE:
        keys, seen = ["topic", "partition", "offset"], messages
    else:
        raise ValueError(f"by {CONTENT} or {PLACE}, not {by}")
    arrived = seen.withColumn(_ARRIVED, F.current_timestamp()).withWatermark(_ARRIVED, within)
    return arrived.dropDuplicatesWithinWatermark(keys).drop(_ARRIVED, _DIGEST)
