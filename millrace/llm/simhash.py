"""SimHash near-duplicates by the generalised pigeonhole principle.

1. One pass over the texts gives each document its fingerprint. Equal fingerprints
   are one node from then on, so exact copies cost nothing further.
2. The 64 x 64 table of joint bit counts over all nodes is summed in Spark. From it,
   correlated bits are grouped into m partitions, and a dynamic programme gives each
   partition the threshold t that makes estimated candidates plus probe rows least.
   The thresholds add up to ``max_bits - m + 1``: two fingerprints within ``max_bits``
   differ by at most t bits in one partition at least, so no link is lost. A threshold
   may be -1, which means that its partition is not probed.
3. Every node goes to the bucket of its own partition value and, as a probe, to those
   of all values within t bits.
4. Buckets are sorted runs, read as a stream. Fingerprints are compared in numpy and
   each bucket gives a spanning forest of its true links, not all pairs, so a dense
   group of near copies gives as many rows as it has members. A bucket of more than
   ``BLOCK`` members is cut into blocks by hash, and each pair of blocks is a run of
   its own.
5. Components come from star rounds over those links.

``similar_groups`` takes such links, and common bands of least hashes, for proposals only:
it compares the shingle sets of the documents that proposals connect, in a large group first
with its smallest member, so that copies near to that one need no comparison with each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.components import components
from millrace.llm.minhash import compared, sets_within, shingle_sets

BITS = 64
#: Members of a bucket that are compared in one run; larger buckets are cut.
BLOCK = 4096
#: Rows of a node at most, its own buckets and probes; and in the pipeline, where the bound
#: of eight bits needs more of them to keep the buckets small, exactly as many for any input.
PROBE_ROWS, PIPELINE_ROWS = 128, 64
#: Shingles hashed at a time, which bounds the memory a long text takes.
HASHES_AT_ONCE = 1 << 16

#: Bands of least hashes, and hashes in a band: two sets with a Jaccard similarity of 0.8
#: have no band in common with a probability of 0.0004.
BANDS, IN_BAND = 20, 5
#: Documents and shingles of a group in one block; larger groups are cut.
GROUP_BLOCK, SHINGLE_BLOCK = 1024, 1 << 19

_SET = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * IN_BAND, np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _RANDOM.integers(0, 1 << 63, BANDS * IN_BAND, np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    """A second, independent 64-bit hash of each hash."""
    z = h + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _ones(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    columns = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(h) < 200:
        return np.unpackbits(columns, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.concatenate(
        [np.bincount(columns[:, j], minlength=256) @ _SET for j in range(8)]
    )


def _packed(ones: np.ndarray, total: int) -> int:
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<i8")[0])


def _shingles(text: str | None, words: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a text, a bounded number at a time; none without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    for i in range(0, total, HASHES_AT_ONCE):
        j = min(total, i + HASHES_AT_ONCE)
        last = ends[np.minimum(np.arange(i, j) + words, len(tokens)) - 1]
        yield np.fromiter(
            (digest(line[s:e], 42) for s, e in zip(starts[i:j].tolist(), last.tolist())),
            np.uint64,
            j - i,
        )


def _prints(blocks: Iterable[np.ndarray], wide: bool) -> tuple[int, int]:
    total, ones, more = 0, np.zeros(BITS, np.int64), np.zeros(BITS, np.int64)
    for h in blocks:
        total += len(h)
        ones += _ones(h)
        if wide:
            more += _ones(_mix(h))
    return _packed(ones, total), _packed(more, total) if wide else 0


def fingerprint(text: str | None, words: int, wide: bool) -> tuple[int, int]:
    """The two signed fingerprints of a text; the second is 0 unless ``wide``."""
    return _prints(_shingles(text, words), wide)


def fingerprints(docs: DataFrame, words: int = 4, wide: bool = False) -> DataFrame:
    """``(doc_id, fp, fp2)`` for every row of ``docs``; other columns are not read.

    Letters A-Z count as lower case; shingles of ``words`` words with repeats. A null
    or empty text has fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [fingerprint(t.as_py(), words, wide) for t in batch.column(1)]
            yield pa.record_batch(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([p[0] for p in pairs], pa.int64()),
                    pa.array([p[1] for p in pairs], pa.int64()),
                ],
                ["doc_id", "fp", "fp2"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, fp bigint, fp2 bigint")


def joint_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of nodes, and how many of them have both bits set, for each pair of bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fp), 8192):
                columns = fp[i : i + 8192].astype("<i8").view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(columns, axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
                n += len(bits)
        yield pa.record_batch(
            [
                pa.array(np.arange(BITS * BITS + 1), pa.int32()),
                pa.array(np.append(total.ravel(), n).astype(np.int64)),
            ],
            ["cell", "n"],
        )

    cells = nodes.select("fp").mapInArrow(run, "cell int, n bigint")
    sums = dict(cells.groupBy("cell").agg(F.sum("n")).collect())
    counts = np.array([sums.get(i, 0) for i in range(BITS * BITS)], float)
    return sums.get(BITS * BITS, 0), counts.reshape(BITS, BITS)


@dataclass(frozen=True)
class Partition:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    def variants(self) -> list[int]:
        """Bit patterns to flip for the probes, the empty one first."""
        return [
            sum(1 << b for b in flipped)
            for k in range(self.threshold + 1)
            for flipped in combinations(self.bits, k)
        ]


def grouped_bits(correlation: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """``m`` groups of nearly equal size; each grows by the bit most correlated with it."""
    left, groups = set(range(BITS)), []
    strength = np.abs(correlation)
    for k in range(m):
        size = -(-len(left) // (m - k))
        rest = sorted(left)
        group = [max(rest, key=lambda b: (strength[b, rest].sum(), -b))]
        left.discard(group[0])
        while len(group) < size:
            pick = max(sorted(left), key=lambda b: (strength[b, group].sum(), -b))
            group.append(pick)
            left.discard(pick)
        groups.append(tuple(sorted(group)))
    return groups


def plan(n: int, counts: np.ndarray, max_bits: int, rows: int | None = None) -> list[Partition]:
    """Partitions and thresholds with the least estimated cost.

    Cost of a partition at threshold t: its probe rows, plus candidate pairs at a
    hundredth of a row each, as they are only compared in numpy. Pairs are estimated from
    the share of set bits, as if the bits of a partition were independent. A node has
    ``PROBE_ROWS`` rows at most. With ``rows`` it has so many at most, and the candidates
    alone count, so the rows of a node are as many for any number of nodes.
    """
    n = max(n, 1)
    p = np.diag(counts) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = (counts / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    differ = 2 * p * (1 - p)
    most, per_row = (PROBE_ROWS, n) if rows is None else (rows, 0)
    best: tuple[float, list[Partition]] = (float("inf"), [])
    for m in range(1, max_bits + 2):
        groups = grouped_bits(correlation, m)
        # least[s, r]: cheapest thresholds of the groups so far whose t + 1 add up to s and
        # which take r rows a node
        least: dict[tuple[int, int], tuple[float, list[int]]] = {(0, 0): (0.0, [])}
        for group in groups:
            within = np.zeros(max_bits + 1)
            within[0] = 1
            for b in group:
                within[1:] = within[1:] * (1 - differ[b]) + within[:-1] * differ[b]
                within[0] *= 1 - differ[b]
            pairs = 0.01 * n * n * np.cumsum(within)
            probes = np.cumsum([comb(len(group), k) for k in range(max_bits + 1)])
            found: dict[tuple[int, int], tuple[float, list[int]]] = {}
            for (s, r), (cost, chosen) in least.items():
                for t in range(-1, max_bits - s + 1):
                    more = int(probes[t]) if t >= 0 else 0
                    if r + more > most:
                        break
                    total = cost + (float(pairs[t]) + per_row * more if t >= 0 else 0.0)
                    at = (s + t + 1, r + more)
                    if at not in found or total < found[at][0]:
                        found[at] = (total, [*chosen, t])
            least = found
        for (s, _), (cost, chosen) in least.items():
            if s == max_bits + 1 and cost < best[0]:
                best = (cost, [Partition(g, t) for g, t in zip(groups, chosen) if t >= 0])
    return best[1]


def _forest(
    nodes: np.ndarray, fp: np.ndarray, fp2: np.ndarray, max_bits: int, max_wide: int
) -> list[tuple[int, int]]:
    """A spanning forest of the links among some members: each one found takes its
    neighbours among those not yet found."""
    links: list[tuple[int, int]] = []
    rest = np.arange(len(nodes))
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            near = np.bitwise_count(fp[rest] ^ fp[x])
            hit = near <= max_bits
            if max_wide:
                hit &= near + np.bitwise_count(fp2[rest] ^ fp2[x]) <= max_wide
            found = rest[hit]
            if len(found):
                links += [(int(nodes[x]), int(nodes[y])) for y in found if nodes[x] != nodes[y]]
                frontier.extend(found.tolist())
                rest = rest[~hit]
    return links


def _bucket_links(max_bits: int, max_wide: int):
    """Reads sorted bucket rows and gives the links of each run of equal buckets."""

    def links_of(run: np.ndarray) -> Iterator[pa.RecordBatch]:
        same = np.ones(len(run), bool)
        for name in ("part", "key", "block"):
            same[1:] &= run[name][1:] == run[name][:-1]
        same[0] = False
        starts = np.flatnonzero(~same)
        ends = np.append(starts[1:], len(run))
        owners = np.add.reduceat(~run["probe"], starts)
        out_a, out_b = [], []
        # pairs of neighbours cover the runs of two, by far the most frequent
        two = starts[(ends - starts == 2) & (owners > 0)]
        near = np.bitwise_count(run["fp"][two] ^ run["fp"][two + 1])
        hit = near <= max_bits
        if max_wide:
            hit &= near + np.bitwise_count(run["fp2"][two] ^ run["fp2"][two + 1]) <= max_wide
        out_a.append(run["node"][two[hit]])
        out_b.append(run["node"][two[hit] + 1])
        for s, e in zip(*(x[(ends - starts > 2) & (owners > 0)].tolist() for x in (starts, ends))):
            part = run[s:e]
            found = _forest(part["node"], part["fp"], part["fp2"], max_bits, max_wide)
            if found:
                pairs = np.array(found, np.int64)
                out_a.append(pairs[:, 0])
                out_b.append(pairs[:, 1])
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        if len(a):
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    kinds = [("part", "i4"), ("key", "i8"), ("block", "i8"), ("probe", "?")]
    kinds += [("node", "i8"), ("fp", "u8"), ("fp2", "u8")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, kinds)
        for batch in batches:
            rows = np.empty(batch.num_rows, kinds)
            for name, _ in kinds:
                rows[name] = batch.column(name).to_numpy(zero_copy_only=False)
            rows = np.concatenate([held, rows])
            if not len(rows):
                continue
            last = rows[["part", "key", "block"]]
            cut = len(rows)
            while cut and last[cut - 1] == last[-1]:
                cut -= 1
            held = rows[cut:]
            if cut:
                yield from links_of(rows[:cut])
        if len(held):
            yield from links_of(held)

    return run


def links(nodes: DataFrame, max_bits: int, max_wide: int = 0, rows: int | None = None) -> DataFrame:
    """``(a, b)``: links that connect all nodes within ``max_bits``, by node id.

    ``nodes``: ``(node, fp, fp2)`` with distinct fingerprints. With ``max_wide``, the
    two fingerprints together may differ by so many bits at most. ``rows``: see ``plan``.
    """
    parts = plan(*joint_counts(nodes), max_bits, rows)

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    flips = None
    for i, part in enumerate(parts):
        own = F.col("fp").bitwiseAND(F.lit(signed(part.mask)))
        chosen = nodes.select(
            F.lit(i).alias("part"),
            own.alias("own"),
            "node",
            "fp",
            "fp2",
            F.explode(F.array(*[F.lit(signed(v)) for v in part.variants()])).alias("flip"),
        )
        flips = chosen if flips is None else flips.union(chosen)
    rows = flips.select(
        "part",
        F.col("own").bitwiseXOR(F.col("flip")).alias("key"),
        (F.col("flip") != 0).alias("probe"),
        "node",
        "fp",
        "fp2",
    )
    hot = (
        rows.groupBy("part", "key")
        .agg(F.count("*").alias("size"))
        .filter(F.col("size") > BLOCK)
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("bigint"))
        .drop("size")
    )
    n = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("fp", "fp2"), n)
    spread = F.transform(
        F.sequence(F.lit(0).cast("bigint"), n - 1),
        lambda other: F.least(mine, other) * n + F.greatest(mine, other),
    )
    dealt = (
        rows.join(hot, ["part", "key"], "left")
        .withColumn("block", F.explode(spread))
        .select("part", "key", "block", "probe", "node", "fp", "fp2")
        .repartition("part", "key", "block")
        .sortWithinPartitions("part", "key", "block")
    )
    return dealt.mapInArrow(_bucket_links(max_bits, max_wide), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, words: int = 4, max_bits: int = 4, max_wide: int = 0
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    Two documents are linked if their fingerprints differ by at most ``max_bits`` bits
    (and, with ``max_wide``, two independent fingerprints by so many together). The
    component is the smallest doc_id that links reach. Null and empty texts have
    fingerprint 0 and are linked with each other like any others. A row without
    doc_id keeps its fingerprint, takes no part in linking and has a null component.
    Repeated rows stay repeated. An empty table gives an empty table.
    """
    prints = stored(fingerprints(docs, words, max_wide > 0), "fingerprints")
    nodes = stored(
        prints.filter("doc_id IS NOT NULL")
        .groupBy("fp", "fp2")
        .agg(F.min("doc_id").alias("node")),
        "nodes",
    )
    grouped = components(links(nodes, max_bits, max_wide))
    named = nodes.join(grouped, "node", "left").select(
        "fp", "fp2", F.coalesce("component", "node").alias("component_id")
    )
    joined = prints.join(named, ["fp", "fp2"], "left")
    return joined.select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The different shingle hashes of a text, sorted."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *_shingles(text, words)]))


def bands(shingles: np.ndarray) -> np.ndarray:
    """A signed key for each band: equal for two sets if all least hashes of the band are."""
    least = np.full(BANDS * IN_BAND, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        h = _mix(shingles[i : i + 1024])[:, None]
        np.minimum(least, (h * _FACTORS + _ADDED).min(axis=0), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, IN_BAND).T:
        keys = _mix(keys ^ column)
    return keys.view(np.int64)


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, fp, fp2, s1, s2, size, bands)``: two fingerprints, a 128-bit hash of the
    shingle set, its size, and the keys of its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for text in batch.column(1):
                blocks = list(_shingles(text.as_py(), words))
                shingles = np.unique(np.concatenate([np.empty(0, np.uint64), *blocks]))
                digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), "<i8")
                rows.append((*_prints(blocks, True), *digest.tolist(), len(shingles)))
                keys.append(bands(shingles) if len(shingles) else [])
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 5
            yield pa.record_batch(
                [batch.column(0).cast(pa.int64()), *columns, pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "fp", "fp2", "s1", "s2", "size", "bands"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(
        run, "doc_id bigint, fp bigint, fp2 bigint, s1 bigint, s2 bigint, size bigint, bands array<bigint>"
    )


def _proposed(nodes: DataFrame, max_bits: int, max_wide: int) -> DataFrame:
    """``(a, b)``: links that connect all nodes with close fingerprints or a common band."""
    prints = nodes.groupBy("fp", "fp2").agg(F.min("node").alias("node"), F.count("*").alias("n"))
    prints = stored(prints, "prints")
    same = (
        nodes.join(prints.filter("n > 1").select("fp", "fp2", F.col("node").alias("b")), ["fp", "fp2"])
        .select(F.col("node").alias("a"), "b")
    )
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1")
    banded = keys.join(shared, "key").select(F.col("node").alias("a"), "b")
    return links(prints.drop("n"), max_bits, max_wide, PIPELINE_ROWS).union(same).union(banded).filter("a <> b")


def similar_groups(
    docs: DataFrame, words: int = 5, max_bits: int = 8, max_wide: int = 19, similarity: float = 0.8
) -> DataFrame:
    """``(doc_id, component_id)`` for every row of ``docs`` with a doc_id.

    Two documents are linked if the Jaccard similarity of their sets of shingles is
    ``similarity`` or more; the component is the smallest doc_id that links reach. Which
    pairs to compare is proposed by fingerprints within the bounds of ``near_duplicates``
    and by common bands of least hashes; what a chain of proposals connects is compared by
    the sets themselves. Texts without words are alike, and like no other. Rows that share
    a doc_id are one document.
    """
    sketches = stored(_sketches(docs.filter("doc_id IS NOT NULL"), words), "sketches")
    nodes = stored(
        sketches.groupBy("s1", "s2").agg(
            F.min("doc_id").alias("node"),
            *[F.first(c).alias(c) for c in ("fp", "fp2", "size", "bands")],
        ),
        "nodes",
    )
    groups = stored(components(_proposed(nodes, max_bits, max_wide)), "proposed-groups")
    placed = nodes.select("node", "size").join(groups, "node")
    totals = placed.groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    first = F.col("component").alias("first")
    members = placed.join(totals, "component").select(F.col("component").alias("g"), "node", first, "n", "total", "size")
    members = stored(members, "proposed-members")
    values = stored(shingle_sets(docs, members.select("node"), words), "shingle-sets")
    kind = sets_within(round(100 * similarity))
    grouped = components(compared(members, values, kind, GROUP_BLOCK, SHINGLE_BLOCK))
    named = nodes.join(grouped, "node", "left").select(
        "s1", "s2", F.coalesce("component", "node").alias("component_id")
    )
    return sketches.join(named, ["s1", "s2"]).select("doc_id", "component_id")


def keep_one_of_each_group(
    docs: DataFrame, words: int = 5, max_bits: int = 8, max_wide: int = 19, similarity: float = 0.8
) -> DataFrame:
    """``docs`` without the documents whose group has a member of smaller doc_id.

    Groups are those of ``similar_groups``. Rows without doc_id stay. Of rows that repeat
    a doc_id, those of the kept document stay, as the id is what is kept.
    """
    found = similar_groups(docs, words, max_bits, max_wide, similarity)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
