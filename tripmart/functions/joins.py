"""Which join sides are small by construction."""

from __future__ import annotations

#: Dimensions that cannot grow with the data: fixed lookups and the minutes of a day. Every other side
#: is left to Spark, which broadcasts by bytes (``autoBroadcastJoinThreshold``, AQE).
FIXED_DIMENSIONS = {"payment", "vendor", "rate", "time"}
