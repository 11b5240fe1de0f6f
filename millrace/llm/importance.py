"""Importance resampling towards the word distribution of a target corpus.

1. One pass over each corpus counts hashed runs of one to three words. A task keeps one
   array of counts, whatever it reads, and sends one row for each bucket.
2. The log ratio of the smoothed bucket shares is an array of ``BUCKETS`` gains, the only
   thing that is broadcast; a second pass adds up the gains of every document's features
   and the scores are stored.
3. Exact draws without replacement: the highest sums of weight and Gumbel noise. The
   cutoff is found by bisection, each step an exact count over the stored scores; a job
   counts at all midpoints of ``LEVELS`` steps at once. A second bisection over doc_id
   settles ties at the cutoff.
4. Only the drawn rows are sorted, by range partitions; a rank is the number of rows in
   the partitions before plus the place in its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

BUCKETS = 10_000
#: Words of a feature at most.
RUN = 3
#: Steps of bisection that one counting job does.
LEVELS = 5
#: Words whose features are made at a time, which bounds the memory a long text takes.
WORDS_AT_ONCE = 1 << 18

#: A word after lower-casing A-Z, in UTF-8: digits, letters and everything beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def features(text: bytes | None) -> Iterator[tuple[int, np.ndarray]]:
    """``(words, buckets)`` of a text, a bounded number of words at a time.

    The checksum of a longer run goes on from that of the run without its last word.
    """
    words = _WORD.findall((text or b"").lower())
    for i in range(0, len(words), WORDS_AT_ONCE):
        part = words[i : i + WORDS_AT_ONCE + RUN - 1]
        n = min(WORDS_AT_ONCE, len(words) - i)
        sums = list(map(crc32, part[:n]))
        every = list(sums)
        spaced = [b" " + w for w in part]
        for more in range(1, RUN):
            sums = list(map(crc32, spaced[more:], sums))
            every += sums
        yield n, np.fromiter(every, np.uint32, len(every)) % BUCKETS


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts in each bucket; ``texts`` has one column of strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                for _, found in features(text.as_py()):
                    total += np.bincount(found, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows.collect():  # BUCKETS rows at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target share to source share, rounded down, with
    one feature added to every bucket of either."""
    all_s, all_t = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [
            floor(1000 * log((float(t) + 1) * all_s / ((float(s) + 1) * all_t)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)``: the sum of the gains of the features."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((batch.num_rows, 3), np.int64)
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                for words, found in features(text.as_py()):
                    rows[i] += words, len(found), shared.value[found].sum()
            columns = [pa.array(rows[:, j]) for j in range(3)]
            yield pa.record_batch([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def with_noise(rows: DataFrame, seed: int) -> DataFrame:
    """Adds ``score``: the weight plus Gumbel noise in thousandths, fixed by seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return rows.withColumn("score", (F.col("weight") + noise).cast("bigint"))


def cutoff(rows: DataFrame, value: Column, wanted: int) -> int:
    """The largest x with ``wanted`` rows or more of ``value >= x``; there are as many rows."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        width = high - low + 1
        steps = min(width, 2**LEVELS)
        points = [low + width * i // steps for i in range(1, steps)]
        counts = rows.agg(*[F.count(F.when(value >= F.lit(p), 1)) for p in points]).first()
        for point, n in zip(points, counts):
            if n < wanted:
                high = point - 1
                break
            low = point
    return low


def ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank``: 1 for the highest score, ties by smaller doc_id, then fewer features."""
    order = [F.col("score").desc(), F.col("doc_id"), F.col("n_features")]
    dealt = stored(
        rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "drawn"
    )
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row for each range partition.
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        dealt.withColumn("_place", place)
        .join(starts, "_part")
        .withColumn("rank", (F.col("_place") + F.col("_before")).cast("bigint"))
        .drop("_part", "_place", "_before")
    )


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs``.

    ``docs`` has doc_id and text, ``target`` text; other columns are not read. Of the N
    rows with ``least_words`` words or more, ``percent * N div 100`` are drawn and ranked;
    the others have a null rank. Null and empty texts have no features and weight 0. A
    row without doc_id counts in the corpus, has no score and is never drawn. Repeated rows
    stay repeated: each counts, and as many of them as there is room for are drawn. An
    empty target or table of documents is a corpus without features.
    """
    gain = gains(bucket_counts(docs.select("text")), bucket_counts(target.select("text")))
    rows = stored(with_noise(weighted(docs, gain), seed), "scores")
    able = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    candidates = rows.filter(able)
    wanted = percent * candidates.count() // 100
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if not wanted:
        return rows.select(*out, none)
    score, small_id = F.col("score"), F.bitwise_not("doc_id")
    least = cutoff(candidates, score, wanted)
    tied = candidates.filter(score == least)
    room = wanted - candidates.filter(score > least).count()
    last = cutoff(tied, small_id, room)
    drawn = able & ((score > least) | ((score == least) & (small_id >= last)))
    # Rows of the last doc_id may repeat beyond the number wanted.
    places = ranked(rows.filter(drawn)).select(
        *out, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")
    )
    return rows.filter(~F.coalesce(drawn, F.lit(False))).select(*out, none).union(places)


def oracle(percent: int = 5, least_words: int = 20, seed: int = 42) -> str:
    """The same in SQL, with checksums four bits at a time."""
    table = list(range(16))
    for _ in range(4):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    half = "instr('0123456789ABCDEF', substr(x, CAST(j + 2 - 2 * (j % 2) AS BIGINT), 1)) - 1"
    step = "xor(c >> 4, t[(xor(c, h) & 15) + 1])"
    return f"""WITH w AS (SELECT 'd' AS kind, row_number() OVER () AS rid, doc_id, {words} AS w FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), NULL, {words} FROM benchmark),
f AS (SELECT kind, rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM w),
n AS (SELECT kind, rid, f, count(*) AS n FROM f GROUP BY ALL),
halves AS (SELECT f, {table} AS t, list_transform(range(0, len(x)), lambda j: {half}) AS h
    FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM n))),
u AS (SELECT f, xor(list_reduce(list_prepend(4294967295, h), lambda c, h: {step}), 4294967295) % {BUCKETS} AS bucket FROM halves),
counts AS (SELECT bucket, sum(n) FILTER (WHERE kind = 'd') AS s, sum(n) FILTER (WHERE kind = 'b') AS t
    FROM n JOIN u USING (f) GROUP BY ALL),
sums AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) + {BUCKETS} AS s, CAST(coalesce(sum(t), 0) AS DOUBLE) + {BUCKETS} AS t FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(c.t, 0) AS DOUBLE) + 1) * sums.s
    / ((CAST(coalesce(c.s, 0) AS DOUBLE) + 1) * sums.t))) AS BIGINT) AS gain FROM counts AS c, sums),
weights AS (SELECT rid, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
    FROM n JOIN u USING (f) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY ALL),
docs AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || sha256('{seed}:' || doc_id)[1:8] AS BIGINT) AS h
    FROM (SELECT * FROM w WHERE kind = 'd') LEFT JOIN weights USING (rid)),
scored AS (SELECT doc_id, n_features, weight, n_words >= {least_words} AND doc_id IS NOT NULL AS able,
    weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM docs),
places AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id, n_features) AS place,
    count(*) OVER (PARTITION BY able) AS able_rows FROM scored)
SELECT doc_id, n_features, weight, score,
    CASE WHEN able AND place <= {percent} * able_rows // 100 THEN place END AS rank FROM places"""
