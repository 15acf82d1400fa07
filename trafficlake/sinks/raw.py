from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.operators.enrich import with_partition_keys
from trafficlake.schema import EVENT_COLUMNS, PARTITION_KEYS
from trafficlake.sources.codec import written_readings


def write_raw(df: DataFrame, out: str, mode: str = "append", compression: str = "none") -> None:
    """Events as JSON Lines in directories by year, month, day and zone.

    Rows are rebalanced by directory: small directories share a task and large ones are split
    into several tasks of the advisory partition size, so neither many tiny files nor one task
    per busy zone results. Keep this root apart from that of a stream, whose file log hides
    other files from readers.
    """
    keyed = with_partition_keys(df.select(*EVENT_COLUMNS)).select(*written_readings(), *PARTITION_KEYS)
    balanced = keyed.hint("rebalance", *[F.col(k) for k in PARTITION_KEYS])
    balanced.write.mode(mode).partitionBy(*PARTITION_KEYS).json(out, compression=compression)
