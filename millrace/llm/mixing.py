"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The words of a source, document after document, are cut into blocks of equal size; a
block is the unit of the mix. Targets give each source an exact quota of blocks. The
quotas are dealt to output shards by a tree: a node halves its shards and gives one half
as many blocks as it has room for, drawn without replacement from all sources at once,
so every shard gets its exact size and a random share of each source, and each source
its exact quota. Each draw has a seed of its own node, so any task can redo a path alone.

The n-th block that a source gives is the n-th of a keyed permutation of its blocks
(another one for each pass over the source), and a shard takes a range of n. Draws are
therefore disjoint, and each document finds its own draws from its place in the source
alone, with no join. ``order_key`` shuffles the blocks of a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
#: A source is used at most so many times.
MOST = 3
BLOCK_WORDS = 512
#: A small source has at least about so many blocks, so that it comes near its target.
BLOCKS_AT_LEAST = 1024
SHARDS = 64
SEED = 7
#: Documents of a source whose places one task counts.
CHUNK_DOCS = 10_000
#: numpy draws from up to this many blocks at a node; larger ones are drawn by inversion.
NUMPY_UP_TO = 500_000_000

_PIECE = "shard int, order_key bigint, epoch int, block bigint, first_word bigint, words bigint"
_PIECE_TYPE = pa.struct(
    [
        ("shard", pa.int32()),
        ("order_key", pa.int64()),
        ("epoch", pa.int32()),
        ("block", pa.int64()),
        ("first_word", pa.int64()),
        ("words", pa.int64()),
    ]
)


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """``(source, source_no, source_size, target, block_words, blocks, quota)``.

    ``sizes`` has ``source`` and ``size``. Sources are numbered by code point, null last,
    and get the weights in turn. Targets share the words of all sources by weight and
    stop at ``most`` times the words of their source; what is over is shared again.

    Sources reach their limit in the order of limit by weight. With all sources before
    one at their limit, the rest per weight is ``level``; it rises while limits are
    reached and falls after, so its maximum is the level that settles all.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    no = F.row_number().over(every) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("source_no", F.lit(len(weights))).cast("int") + 1)
    limit = (F.col("source_size") * most).cast("double")
    before = Window.orderBy(limit / F.col("weight"), "source_no").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(F.lit(0))
    taken = F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(whole) - taken) / (F.sum("weight").over(whole) - used)
    aimed = (
        totals.withColumn("source_no", no)
        .withColumn("weight", weight)
        .withColumn("level", level)
        .withColumn("target", F.least(limit, F.col("weight") * F.max("level").over(whole)))
    )
    block_words = F.greatest(
        F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("source_size") / BLOCKS_AT_LEAST))
    ).cast("bigint")
    blocks = F.ceil(F.col("source_size") / F.col("block_words")).cast("bigint")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        aimed.withColumn("block_words", block_words)
        .withColumn("blocks", blocks)
        .withColumn(
            "quota", F.least(F.round(share * F.col("blocks")).cast("bigint"), F.col("blocks") * most)
        )
        .select("source", "source_no", "source_size", "target", "block_words", "blocks", "quota")
    )


def by_inversion(rng: np.random.Generator, count: int, others: int, n: int) -> int:
    """One hypergeometric draw of ``n`` from ``count`` and ``others``, however many they are.

    The probabilities come from their exact ratios to that of the mode, for all values
    within 14 standard deviations of it; what lies beyond has a share below 1e-40, less than
    64-bit numbers tell from nothing. Takes memory as the standard deviation, some MB for
    10^11 blocks.
    """
    total = count + others
    low, high = max(0, n - others), min(count, n)
    mode = min(high, max(low, (n + 1) * (count + 1) // (total + 2)))
    spread = (n * (count / total) * (others / total) * ((total - n) / max(1, total - 1))) ** 0.5
    reach = int(14 * spread) + 30
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    # From k to k + 1, and from k to k - 1.
    rise = np.cumprod((count - up) * (n - up) / ((up + 1) * (others - n + up + 1)))
    fall = np.cumprod(down * (others - n + down) / ((count - down + 1) * (n - down + 1)))
    weights = np.concatenate([fall[::-1], [1.0], rise])
    ends = np.cumsum(weights)
    at = int(np.searchsorted(ends, rng.random() * ends[-1], side="right"))
    return mode - len(fall) + min(at, len(weights) - 1)


def draw(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` things drawn without replacement are of each kind."""
    out = np.zeros_like(counts)
    rest = int(counts.sum())
    for i, count in enumerate(counts.tolist()):
        others = rest - count
        low, high = max(0, n - others), min(count, n)
        if low == high:
            got = low
        elif rest <= NUMPY_UP_TO:
            got = int(rng.hypergeometric(count, others, n))
        else:
            got = by_inversion(rng, count, others, n)
        out[i] = got
        n, rest = n - got, others
    return out


def shard_counts(quotas: np.ndarray, shards: int, shard: int, seed: int) -> np.ndarray:
    """Blocks of each source in one shard: the path from the root of the tree to it."""
    low, high = 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        total = int(quotas.sum())
        left = total * (middle - low) // (high - low)
        part = draw(np.random.default_rng([seed, low, high]), quotas, left)
        if shard < middle:
            quotas, high = part, middle
        else:
            quotas, low = quotas - part, middle
    return quotas


def shard_ends(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(source_no, ends)``: how many blocks of the source are in the first k shards."""
    root = plan.agg(
        F.sort_array(F.collect_list(F.struct("source_no", "quota"))).alias("quotas")
    )  # one entry for each source
    each = root.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for quotas, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.array([q["quota"] for q in quotas], np.int64)
                got = shard_counts(counts, shards, shard, seed)
                yield pa.record_batch(
                    [
                        pa.array([q["source_no"] for q in quotas], pa.int32()),
                        pa.array(np.full(len(got), shard), pa.int32()),
                        pa.array(got),
                    ],
                    ["source_no", "shard", "n"],
                )

    counts = each.repartition("shard").mapInArrow(run, "source_no int, shard int, n bigint")
    listed = F.sort_array(F.collect_list(F.struct("shard", "n")))
    return counts.groupBy("source_no").agg(
        F.transform(
            F.sequence(F.lit(1), F.lit(shards)),
            lambda k: F.aggregate(F.slice(listed, 1, k), F.lit(0).cast("bigint"), lambda s, x: s + x["n"]),
        ).alias("ends")
    )


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    z = x.astype(np.uint64) + np.uint64(key & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of ``range(n)``: four Feistel rounds, walked until in range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = x.astype(np.uint64)
    rest = np.arange(len(out))
    while len(rest):
        left, right = out[rest] >> np.uint64(half), out[rest] & mask
        for r in range(4):
            left, right = right, left ^ (_mixed(right, key * 31 + r * 0x9E3779B97F4A7C15) & mask)
        out[rest] = (left << np.uint64(half)) | right
        rest = rest[out[rest] >= n]
    return out.astype(np.int64)


def pieces(
    start: int, size: int, block_words: int, blocks: int, quota: int, ends: np.ndarray, no: int, seed: int
) -> dict[str, np.ndarray]:
    """The draws that fall on one document, which has the words ``start ...`` of its source."""
    names = [f.name for f in _PIECE_TYPE]
    if not size or not quota:
        return {n: np.empty(0, np.int64) for n in names}
    own = np.arange(start // block_words, (start + size - 1) // block_words + 1)
    parts = []
    for epoch in range(-(-quota // blocks)):
        place = permuted(own, blocks, seed * 1_000_003 + no * 101 + epoch) + epoch * blocks
        drawn, place = own[place < quota], place[place < quota]
        first = np.maximum(drawn * block_words, start)
        last = np.minimum((drawn + 1) * block_words, start + size)
        parts.append(
            {
                "shard": np.searchsorted(ends, place, side="right"),
                "order_key": _mixed(place, seed + (no << 20)).view(np.int64),
                "epoch": np.full(len(drawn), epoch),
                "block": drawn,
                "first_word": first - start,
                "words": last - first,
            }
        )
    return {n: np.concatenate([p[n] for p in parts]) for n in names}


def mixed(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, words: Column | None = None
) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken`` and ``pieces`` added.

    ``words`` counts the words of a row, by default those of its ``text``.
    ``pieces`` lists the draws of a document: shard, order within it, pass over the
    source, block, first word and number of words. ``taken`` is their number of words.
    A null text has size 0; null is a source like any other. Rows without doc_id take
    part; repeated rows are documents of their own. Columns of those names are replaced.
    Empty tables and texts give no pieces.
    """
    added = ["size", "source_size", "target", "taken", "pieces"]
    plain = docs.drop(*added)
    names = plain.columns
    count = word_count(F.col("text")) if words is None else words.cast("bigint")
    sized = plain.withColumn("size", count)
    sizes = stored(sized.select("doc_id", "source", "size"), "sizes")
    plan = stored(targets(sizes), "plan")
    chunks = max(1, -(-sizes.count() // CHUNK_DOCS))
    chunk = F.pmod(F.xxhash64("doc_id", "size"), F.lit(chunks)).cast("int")

    totals = sizes.groupBy("source", chunk.alias("_chunk")).agg(F.sum("size").alias("_words"))
    order = Window.partitionBy("source").orderBy("_chunk")
    before = F.sum("_words").over(order.rowsBetween(Window.unboundedPreceding, -1))
    bases = (
        totals.withColumn("_base", F.coalesce(before, F.lit(0)))
        .join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .join(shard_ends(plan, shards, seed), "source_no")
        .select(
            F.col("source").alias("_source"),
            F.col("_chunk").alias("_no"),
            "_base",
            *[F.col(c).alias(f"_{c}") for c in ("source_no", "source_size", "target", "block_words", "blocks", "quota", "ends")],
        )
    )
    within = Window.partitionBy("source", "_chunk").orderBy("doc_id", "size")
    sofar = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        sized.withColumn("_chunk", chunk)
        .withColumn("_start", F.coalesce(sofar, F.lit(0)))
        .join(bases, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_chunk") == F.col("_no")))
        .withColumn("_start", F.col("_start") + F.col("_base"))
        .drop("_source", "_no", "_base", "_chunk")
    )
    schema = sized.withColumns(
        {
            "source_size": F.lit(0).cast("bigint"),
            "target": F.lit(0.0),
            "taken": F.lit(0).cast("bigint"),
            "pieces": F.lit(None).cast(f"array<struct<{_PIECE.replace(' ', ':').replace(',:', ',')}>>"),
        }
    ).schema
    inputs = ["_start", "size", "_block_words", "_blocks", "_quota", "_ends", "_source_no"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            found = [
                pieces(*row[:5], np.array(row[5], np.int64), row[6], seed)
                for row in zip(*(columns[c].to_pylist() for c in inputs))
            ]
            flat = [
                pa.array(np.concatenate([x[f.name] for x in found] or [np.empty(0)])).cast(f.type)
                for f in _PIECE_TYPE
            ]
            ends = np.cumsum([0] + [len(x["words"]) for x in found])
            yield pa.record_batch(
                [columns[n] for n in names]
                + [
                    columns["size"],
                    columns["_source_size"],
                    columns["_target"],
                    pa.array([int(x["words"].sum()) for x in found], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()),
                        pa.StructArray.from_arrays(flat, fields=list(_PIECE_TYPE)),
                    ),
                ],
                [*names, *added],
            )

    return placed.mapInArrow(run, schema)


def shard_rows(mix: DataFrame) -> DataFrame:
    """One row for each piece, shards apart and each in its shuffled order."""
    rows = mix.select(
        "doc_id", "source", F.explode("pieces").alias("piece")
    ).select("doc_id", "source", "piece.*")
    return rows.repartition("shard").sortWithinPartitions("shard", "order_key", "first_word")
