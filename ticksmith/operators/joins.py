"""Join helpers.  The engine leaves the join form to adaptive execution (a
side small by its measured size is broadcast, a skewed shuffle join is split);
``bounded_broadcast`` stays for callers that want the choice made up front."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Byte budget of one broadcast.  Lookups here are per match or per round
# (tick rate, round clock, match dimension, artefact keys): at ~300k matches
# the round clock is ~7M rows of ~64 bytes, well inside 1 GiB, while the
# event tables it is joined to are terabytes -- shuffling those would cost
# far more than shipping the lookup.  The driver must hold the broadcast
# while building it, so size the driver accordingly.
DEFAULT_MAX_BROADCAST_BYTES = 1 << 30
BYTES_KEY = "ticksmith.broadcast.maxBytes"
ROWS_KEY = "ticksmith.broadcast.maxRows"       # optional hard row cap (overrides the byte budget)

_WIDTH = {T.StringType: 48, T.DecimalType: 16, T.TimestampType: 8, T.TimestampNTZType: 8, T.DateType: 4,
          T.BooleanType: 1, T.IntegerType: 4, T.LongType: 8, T.DoubleType: 8, T.FloatType: 4}


def row_bytes(schema: T.StructType) -> int:
    """Rough in-memory width of one row (hash-relation overhead included)."""
    return 16 + sum(next((w for t, w in _WIDTH.items() if isinstance(f.dataType, t)), 64) for f in schema.fields)


def max_broadcast_rows(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    try:
        rows = conf.get(ROWS_KEY, None)
        if rows:
            return int(rows)
        budget = int(conf.get(BYTES_KEY, str(DEFAULT_MAX_BROADCAST_BYTES)))
    except Exception:
        budget = DEFAULT_MAX_BROADCAST_BYTES
    return max(1, budget // row_bytes(df.schema))


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only if it provably has at most ``max_rows``
    rows (default: the byte budget over the row width).  The check reads at
    most ``max_rows + 1`` rows, so its cost is bounded too.  Above the bound
    the frame is returned unchanged and the planner keeps a shuffle join
    (with AQE skew splitting)."""
    limit = max_rows if max_rows is not None else max_broadcast_rows(df)
    memo = getattr(df, "_ticksmith_bounded", None)
    if memo is not None and memo[0] == limit:
        return memo[1]
    n = df.limit(limit + 1).count()
    out = F.broadcast(df) if n <= limit else df
    try:
        df._ticksmith_bounded = (limit, out)   # decided once per frame
    except AttributeError:
        pass
    return out


MAX_INLIST = 2_000     # matches per batch pruned with a literal IN-list (partition / row-group pruning)


class MatchBatch:
    """A batch of match ids, read once.  Up to MAX_INLIST ids are kept as a
    literal list: ``restrict`` then becomes an IN filter that prunes
    partition folders (bronze) or skips Parquet row groups (silver / gold,
    files sorted by match).  Larger batches use a semi-join."""

    def __init__(self, ids: DataFrame):
        self.ids = ids.select("match_id")
        few = self.ids.limit(MAX_INLIST + 1).collect()     # bounded by MAX_INLIST
        self.empty = not few
        self.values = [r.match_id for r in few] if len(few) <= MAX_INLIST else None

    def restrict_or_null(self, df: DataFrame) -> DataFrame:
        """Rows of the batch's matches, and rows without a match id."""
        if self.values is not None:
            return df.where(F.col("match_id").isin(self.values) | F.col("match_id").isNull())
        return df.where("match_id is null").unionByName(df.join(self.ids, "match_id", "left_semi").select(df.columns))

    def restrict(self, df: DataFrame) -> DataFrame:
        if self.values is not None:
            return df.where(F.col("match_id").isin(self.values))
        return df.join(self.ids, "match_id", "left_semi")


def restrict(df: DataFrame, ids: DataFrame | MatchBatch) -> DataFrame:
    """Rows of the given matches only (see :class:`MatchBatch`)."""
    batch = ids if isinstance(ids, MatchBatch) else MatchBatch(ids)
    return batch.restrict(df)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int | None = None) -> DataFrame:
    """Join a large frame with a lookup frame, broadcasting the lookup when
    its size is proven small."""
    return big.join(bounded_broadcast(small, max_rows), on, how)
