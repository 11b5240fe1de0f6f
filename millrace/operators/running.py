"""Running values per key that never put a whole key into one task.

A window over one key sorts all of its rows in a single task. Here the rows of a
key are cut into chunks along the order axis. The detail rows are shuffled once, by key
and chunk. A window runs inside each chunk; an aggregate of the same shuffled rows gives
one row per chunk, and a second window, over those rows only, gives every chunk what
came before it. Both read one exchange, so the input is scanned once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from pyspark.sql.window import WindowSpec

# Offsets are dense, so a chunk holds at most this many rows per log partition.
OFFSETS_PER_CHUNK = 1_000_000
SECONDS_PER_CHUNK = 6 * 3600


def offset_chunk(offset: Column, width: int = OFFSETS_PER_CHUNK) -> Column:
    return F.floor(offset / width)


def time_chunk(ts: Column, seconds: int = SECONDS_PER_CHUNK) -> Column:
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds)


@dataclass(frozen=True)
class Running:
    """What to compute, as ``{output name: input expression}``.

    ``sums``: total up to and including the row. ``lasts``: latest non-null value up
    to and including the row. ``lags``: value of the previous row, null for the first.
    """

    sums: dict[str, Column] = field(default_factory=dict)
    lasts: dict[str, Column] = field(default_factory=dict)
    lags: dict[str, Column] = field(default_factory=dict)


def running(
    df: DataFrame, keys: list[str], order: list[str], chunk: Column, spec: Running
) -> DataFrame:
    """``df`` with the running columns added.

    ``order`` must be unique within a key and ``chunk`` must not decrease along it.
    Rows without a key or chunk have no place and are left out. All columns of ``df`` are
    shuffled, whatever is used later, so select what is needed first.
    """
    columns = df.columns
    inputs = {
        f"_{kind}_{name}": value
        for kind, values in (("s", spec.sums), ("l", spec.lasts), ("g", spec.lags))
        for name, value in values.items()
    }
    prepared = df.withColumns({"_chunk": chunk, **inputs})
    for name in (*keys, "_chunk"):
        prepared = prepared.filter(F.col(name).isNotNull())
    prepared = prepared.repartition(*keys, "_chunk")
    # An exchange is used twice only if both uses ask for the same columns. These values
    # ask for all of them, and the filters on them, always true, keep the optimiser from
    # taking columns away on one side.
    everything = _hash_of_all(prepared)
    place = F.struct(*order)

    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = prepared.withColumns(
        {
            **{f"_cs_{n}": F.sum(f"_s_{n}").over(so_far) for n in spec.sums},
            **{
                f"_cl_{n}": F.last(f"_l_{n}", ignorenulls=True).over(so_far)
                for n in spec.lasts
            },
            **{
                f"_cg_{n}": F.lag(F.struct(F.col(f"_g_{n}").alias("v"))).over(inside)
                for n in spec.lags
            },
        }
    ).filter(everything.bitwiseAND(F.lit(0)) == 0)

    per_chunk = prepared.groupBy(*keys, "_chunk").agg(
        F.max(everything).alias("_every"),
        *[F.sum(f"_s_{n}").alias(f"_t_{n}") for n in spec.sums],
        *[
            F.max_by(f"_l_{n}", F.when(F.col(f"_l_{n}").isNotNull(), place)).alias(f"_t_{n}")
            for n in spec.lasts
        ],
        *[
            F.max_by(F.struct(F.col(f"_g_{n}").alias("v")), place).alias(f"_t_{n}")
            for n in spec.lags
        ],
    )
    chunks: WindowSpec = Window.partitionBy(*keys).orderBy("_chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_kc"),
        "_every",
        *[F.sum(f"_t_{n}").over(before).alias(f"_b_{n}") for n in spec.sums],
        *[
            F.last(f"_t_{n}", ignorenulls=True).over(before).alias(f"_b_{n}")
            for n in spec.lasts
        ],
        *[F.lag(f"_t_{n}").over(chunks).alias(f"_b_{n}") for n in spec.lags],
    ).filter(F.col("_every").isNotNull())

    same = F.col("_chunk") == F.col("_kc")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    return local.join(carried, same, "left").select(
        *columns,
        *[
            F.when(
                F.col(f"_cs_{n}").isNotNull() | F.col(f"_b_{n}").isNotNull(),
                _zero_if_null(f"_cs_{n}") + _zero_if_null(f"_b_{n}"),
            ).alias(n)
            for n in spec.sums
        ],
        *[F.coalesce(f"_cl_{n}", f"_b_{n}").alias(n) for n in spec.lasts],
        *[F.coalesce(f"_cg_{n}", f"_b_{n}")["v"].alias(n) for n in spec.lags],
    )


def _hash_of_all(df: DataFrame) -> Column:
    """A hash that reads every column; maps, which have no hash, count by their size."""
    return F.xxhash64(
        *[
            F.size(f.name) if isinstance(f.dataType, MapType) else F.col(f.name)
            for f in df.schema
            if isinstance(f.dataType, MapType) or "map<" not in f.dataType.simpleString()
        ]
    )


def _zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def numbered(
    df: DataFrame, keys: list[str], order: list[str], chunk: Column, name: str = "version"
) -> DataFrame:
    """``row_number`` within each key, by chunks."""
    return running(df, keys, order, chunk, Running(sums={name: F.lit(1).cast("bigint")}))
