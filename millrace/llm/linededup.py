"""Repeated and nearly repeated lines, by a deletion-neighbourhood join.

A line is its words, ASCII letters in lower case. Two lines are the same if their words
are equal, and near if one word replaced, inserted or left out makes them equal and
both have ``NEAR_WORDS`` words or more. Lines of fewer than ``MIN_WORDS`` words are left
alone. A line's place is (doc_id, line number); a line goes if a same or near line has
an earlier place, whether that one stays or goes itself.

Near lines of n and m words share their first or their last ``min(n, m) // 2`` words, so
only lines that share such a half with another one (a few per cent of them) emit their
variants: the line itself and the line without each one of its words, as 128-bit hashes
tagged with the place of the missing word. Lines with one variant at one place differ
by a replaced word; a line equal to a variant of another one differs by an inserted
word. So the earliest member of each bucket is an aggregate, pairs are never listed, and
one witness for each line that goes is verified by its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

MIN_WORDS = 3
NEAR_WORDS = 8
LINE = ["h1", "h2"]
#: Bits of the map that tells which lines may be wanted: 8 MB, whatever the input. Where
#: it fills up, more lines than needed are shuffled; the join that follows is exact.
MAP_BITS = 1 << 26
_MARKS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def words_of(line: bytes) -> list[bytes]:
    return line.lower().split()


def _halves(words: list[bytes]) -> list[int | None]:
    """Hashes of the first and last halves: equal for near lines on one side at least."""
    n = len(words)
    if n < NEAR_WORDS:
        return [None] * 4
    out: list[int | None] = []
    for q in dict.fromkeys((n // 2, (n - 1) // 2)):
        for kind, half in enumerate((words[:q], words[n - q :])):
            out.append(xxhash.xxh3_64_intdigest(b" ".join(half), 2 * q + kind) - (1 << 63))
    return out + [None] * (4 - len(out))


def _hashed(line: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_digest(line)
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def bit_map(rows: DataFrame, name: str) -> bytearray:
    """A bit for the low bits of each hash in a column."""
    low = F.col(name).bitwiseAND(F.lit(MAP_BITS - 1))
    bit = F.expr(f"shiftleft(1L, int({name} & 31))")
    rows = (
        rows.select(F.shiftright(low, 5).alias("cell"), bit.alias("bit"))
        .groupBy("cell")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    cells = np.zeros(MAP_BITS // 32, "<u4")
    cells[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy()
    return bytearray(cells.tobytes())


def _scan(docs: DataFrame, wanted=None) -> DataFrame:
    """One row for each line that counts, with its halves, or with its words for those
    lines only that the broadcast map ``wanted`` may hold."""
    with_text = wanted is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places, hashes, halves, texts = [], [], [], [], []
            size = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for place, raw in enumerate((text.as_py() or "").encode().split(b"\n")):
                    words = words_of(raw)
                    if len(words) < MIN_WORDS:
                        continue
                    line = b" ".join(words)
                    pair = _hashed(line)
                    if with_text:
                        bit = pair[0] & (MAP_BITS - 1)
                        if not wanted.value[bit >> 3] >> (bit & 7) & 1:
                            continue
                    ids.append(doc_id)
                    places.append(place)
                    hashes.append(pair)
                    if with_text:
                        texts.append(line)
                        size += len(line)
                    else:
                        halves.append(_halves(words))
                if size > 1 << 24 or len(ids) > 1 << 16:
                    yield rows(ids, places, hashes, halves, texts)
                    ids, places, hashes, halves, texts, size = [], [], [], [], [], 0
            if ids:
                yield rows(ids, places, hashes, halves, texts)

    def rows(ids, places, hashes, halves, texts) -> pa.RecordBatch:
        pair = np.array(hashes, np.int64)
        columns = {"h1": pair[:, 0], "h2": pair[:, 1]}
        if with_text:
            columns["line"] = pa.array(texts, pa.binary())
        else:
            columns |= {"doc_id": pa.array(ids, pa.int64()), "place": pa.array(places, pa.int32())}
            columns |= {f"k{i}": pa.array([x[i] for x in halves], pa.int64()) for i in range(4)}
        return pa.record_batch(columns)

    schema = "h1 bigint, h2 bigint, line binary"
    if not with_text:
        schema = "h1 bigint, h2 bigint, doc_id bigint, place int, " + ", ".join(
            f"k{i} bigint" for i in range(4)
        )
    chosen = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    return chosen.mapInArrow(run, schema)


def variants(words: list[bytes]) -> np.ndarray:
    """Two hashes of the words, and below them of the words without each one of them."""
    w = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in words), np.uint64, len(words))
    out = np.empty((2, len(w) + 1), np.uint64)
    for row, mark in zip(out, _MARKS):
        back = np.uint64(pow(int(mark), -1, 1 << 64))
        powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(w), mark))), dtype=np.uint64)
        so_far = np.concatenate(([np.uint64(0)], np.cumsum(w * powers[:-1], dtype=np.uint64)))
        row[0] = so_far[-1]
        row[1:] = so_far[:-1] + (so_far[-1] - so_far[1:]) * back
    return out.view(np.int64)


def _with_variants(lines: DataFrame, wanted=None) -> DataFrame:
    """``(v1, v2, missing)`` for each line and each missing word; -1 for the whole line.

    With the broadcast map ``wanted``, only variants whose ``v1`` it may hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, at = [], []
            for i, line in enumerate(batch.column("line")):
                found.append(variants(line.as_py().split(b" ")))
                at.append(i)
                if sum(x.shape[1] for x in found[-1000:]) > 1 << 18 or len(found) >= 1000:
                    yield block(batch, found, at)
                    found, at = [], []
            if found:
                yield block(batch, found, at)

    def block(batch: pa.RecordBatch, found: list[np.ndarray], at: list[int]) -> pa.RecordBatch:
        sizes = [x.shape[1] for x in found]
        line = np.repeat(at, sizes)
        both = np.concatenate(found, axis=1)
        missing = np.concatenate([np.arange(-1, n - 1, dtype=np.int32) for n in sizes])
        if wanted is not None:
            bit = both[0] & (MAP_BITS - 1)
            cells = np.frombuffer(wanted.value, np.uint8)
            kept = cells[bit >> 3] >> (bit & 7) & 1 == 1
            line, both, missing = line[kept], both[:, kept], missing[kept]
        taken = batch.select(["h1", "h2", "first"]).take(pa.array(line))
        return pa.record_batch(
            [both[0], both[1], missing, *taken.columns], ["v1", "v2", "missing", "h1", "h2", "first"]
        )

    first = "first struct<doc_id:bigint,place:int>"
    return lines.mapInArrow(
        run, f"v1 bigint, v2 bigint, missing int, h1 bigint, h2 bigint, {first}"
    )


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Whether replacing, inserting or leaving out one word at most makes them equal."""
    if abs(len(a) - len(b)) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[same + 1 :] == b[same + 1 :]
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return long[same + 1 :] == short[same:]


def _verified(pairs: DataFrame) -> DataFrame:
    """The rows whose two lines are within one edit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("line").to_pylist(), batch.column("near_line").to_pylist())
            yield batch.filter(
                pa.array([within_one_edit(a.split(b" "), b.split(b" ")) for a, b in both], pa.bool_())
            )

    return pairs.mapInArrow(run, pairs.schema)


def _member(first: str = "first") -> Column:
    return F.struct(F.col(first).alias("first"), "h1", "h2")


def _near(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``(h1, h2, near)``: lines with an earlier near line, and the first place of that."""
    keys = lines.select(*LINE, F.explode(F.array("k0", "k1", "k2", "k3")).alias("key")).filter(
        "key IS NOT NULL"
    )
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    chosen = stored(keys.join(shared, "key", "left_semi").select(*LINE).distinct(), "candidates")
    wanted = docs.sparkSession.sparkContext.broadcast(bit_map(chosen, "h1"))
    texts = stored(
        _scan(docs, wanted)
        .join(chosen, LINE, "left_semi")
        .dropDuplicates(LINE)
        .join(lines.select(*LINE, "first"), LINE),
        "lines",
    )
    # Most variants occur once. They are counted as bare hashes first, and only those
    # that may be shared become rows.
    shared = _with_variants(texts).groupBy("v1").agg(F.count("*").alias("n")).filter("n > 1")
    common = docs.sparkSession.sparkContext.broadcast(bit_map(shared, "v1"))
    rows = stored(_with_variants(texts, common), "variants")

    place = ["v1", "v2", "missing"]
    replaced = (
        rows.filter("missing >= 0")
        .groupBy(*place)
        .agg(F.count("*").alias("n"), F.min(_member()).alias("other"))
        .filter("n > 1")
    )
    whole, lacking = F.col("missing") < 0, F.col("missing") >= 0
    inserted = (
        rows.groupBy("v1", "v2")
        .agg(
            F.min(F.when(whole, _member())).alias("whole"),
            F.min(F.when(lacking, _member())).alias("lacking"),
        )
        .filter("whole IS NOT NULL AND lacking IS NOT NULL")
    )
    earlier = F.col("other.first") < F.col("first")
    pairs = (
        rows.join(replaced, place)
        .filter(earlier)
        .select(*LINE, "other")
        .union(
            rows.join(inserted, ["v1", "v2"])
            .withColumn("other", F.when(whole, F.col("lacking")).otherwise(F.col("whole")))
            .filter(earlier)
            .select(*LINE, "other")
        )
        .groupBy(*LINE)
        .agg(F.min("other").alias("other"))
    )
    words = texts.select(*LINE, "line")
    others = words.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("line").alias("near_line"))
    both = (
        pairs.join(words, LINE)
        .join(others, (F.col("o1") == F.col("other.h1")) & (F.col("o2") == F.col("other.h2")))
        .select(*LINE, F.col("other.first").alias("near"), "line", "near_line")
    )
    return _verified(both).select(*LINE, "near")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, kept_doc_id, kept_line_no, edits)`` for every line that goes.

    ``line_no`` counts from 0. For a repeated line (``edits`` 0) the kept place is its
    first one, which goes too where a near line is earlier; for a near one (``edits``
    1) it is the first place of the earliest near line. Null and empty texts have no
    lines. Rows without doc_id take no part; rows that repeat a doc_id and a line are
    one place. Other columns are not read. An empty table gives an empty table.
    """
    scanned = _scan(docs)
    occurrences = stored(scanned.select(*LINE, "doc_id", "place"), "places")
    halves = [f"k{i}" for i in range(4)]
    lines = stored(
        scanned.groupBy(*LINE, *halves).agg(
            F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n")
        ),
        "first-places",
    )
    here = F.struct("doc_id", "place")
    again = (
        occurrences.join(lines.filter("n > 1").select(*LINE, "first"), LINE)
        .filter(here > F.col("first"))
        .select("doc_id", "place", F.col("first").alias("kept"), F.lit(0).alias("edits"))
    )
    near = (
        _near(docs, lines)
        .join(lines.select(*LINE, "first"), LINE)
        .select("first.doc_id", "first.place", F.col("near").alias("kept"), F.lit(1).alias("edits"))
    )
    return again.union(near).distinct().select(
        "doc_id",
        F.col("place").alias("line_no"),
        F.col("kept.doc_id").alias("kept_doc_id"),
        F.col("kept.place").alias("kept_line_no"),
        "edits",
    )


def without_repeated_lines(docs: DataFrame, least_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the lines of ``repeated_lines`` taken out of their texts.

    A document goes if it loses lines and no line of ``least_words`` words is left; with 1,
    only if nothing but white space is. One that loses none stays as it is. ``n_chars``, where there is such a column, follows the text.
    Rows without doc_id stay unchanged.
    """
    left_over = rf"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){{{least_words - 1}}}[^\x20\x09-\x0D]"
    gone = (
        repeated_lines(docs)
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg(F.collect_set("line_no").alias("_gone"))
    )
    lines = F.split("text", "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.array_contains("_gone", i))
    joined = docs.join(gone, F.col("doc_id") == F.col("_doc"), "left").withColumn("_left", left)
    kept = joined.filter(
        F.col("_gone").isNull() | F.exists("_left", lambda x: x.rlike(left_over))
    ).withColumn(
        "_text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join("_left", "\n"))
    )
    columns = {c: F.col(c) for c in docs.columns} | {"text": F.col("_text").alias("text")}
    if "n_chars" in columns:
        size = F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length("_text"))
        columns["n_chars"] = size.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return kept.select(*columns.values())
