"""Numbers of messages and of their elements, as texts that sort in the order of arrival.

Nothing is packed into bits, so no offset, partition or position can run into another field.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def message_number(received: Column, partition: Column, offset: Column) -> Column:
    """A message by the instant it was received, then partition and offset."""
    return F.concat_ws("-", _padded(F.unix_millis(received), 15), _padded(partition, 10), _padded(offset, 19))


def element_number(msg_id: Column, is_text: bool, pos: Column) -> Column:
    """An element by its message, a number or a text of :func:`message_number`, and its position."""
    return F.concat_ws("-", msg_id if is_text else _padded(msg_id, 19), _padded(F.coalesce(pos, F.lit(0)), 10))
