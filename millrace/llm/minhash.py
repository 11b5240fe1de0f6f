"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

1. One pass over the texts gives each document the set of its shingle hashes, a digest of
   that set and a signature: for each of ``POSITIONS`` hash functions, ``BITS`` bits of the
   least value. Documents with equal sets are one node from then on.
2. Two sets with a Jaccard similarity of 0.85 differ in more than ``DISTANCE`` positions
   with a probability below 0.000001. The signature is split into chunks which each
   allow one error; by the pigeonhole principle, signatures within ``DISTANCE`` positions
   differ in one position at most in some chunk. The errors are enumerated: each chunk
   gives a key for each position left out. So no pair within the distance is lost.
3. Keys that several nodes have are buckets. Signatures are compared within them and give
   a spanning forest of the pairs within the distance; its components are groups.
4. The shingle sets of the members of a group are compared in full and give a spanning forest
   of the true links.

Both comparisons deal large groups out alike: every member is first compared with the
group's smallest one. Those near to it need no comparison with each other, as they are
connected already; they are cut into blocks that meet the blocks of all others only. So a
group of copies costs what it has rows, and no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.components import components
from millrace.llm.linededup import MAP_BITS, bit_map

POSITIONS, BITS, DISTANCE = 64, 16, 25
#: Errors that a chunk allows.
ERRORS = 1
#: Members of a bucket, members of a group and shingles of a group in one block.
BUCKET_BLOCK, GROUP_BLOCK, SHINGLE_BLOCK = 4096, 1024, 1 << 19
#: Shingles hashed at a time, which bounds the memory a long text takes.
HASHES_AT_ONCE = 1 << 16
SEED = 11

_RANDOM = np.random.default_rng(11)
_FACTORS = _RANDOM.integers(0, 1 << 63, POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _RANDOM.integers(0, 1 << 63, POSITIONS, np.uint64)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """The different shingle hashes of a text, sorted; all words as one if they are fewer."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = max(1, len(tokens) - words + 1)
    last = ends[np.minimum(np.arange(total) + words, len(tokens)) - 1]
    digest = xxhash.xxh3_64_intdigest
    made = []
    for i in range(0, total, HASHES_AT_ONCE):
        places = zip(starts[i : i + HASHES_AT_ONCE].tolist(), last[i : i + HASHES_AT_ONCE].tolist())
        n = min(HASHES_AT_ONCE, total - i)
        made.append(np.unique(np.fromiter((digest(line[s:e], SEED) for s, e in places), np.uint64, n)))
    return made[0] if len(made) == 1 else np.unique(np.concatenate(made))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``BITS`` bits of the least value of each hash function."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        h = shingles[i : i + 1024, None]
        np.minimum(least, (h * _FACTORS + _ADDED).min(axis=0), out=least)
    # The least values have small leading bits, so the bits come from a further product.
    return ((least ^ least >> np.uint64(29)) * _SPREAD >> np.uint64(64 - BITS)).astype("<u2")


def chunk_variants() -> list[tuple[int, tuple[int, ...]]]:
    """``(chunk, positions)`` of each key: a chunk without ``ERRORS`` of its positions.

    Chunks of which each allows e errors rule out e + 1 errors each, so that
    ``DISTANCE + 1`` over e + 1 chunks, rounded up, are needed.
    """
    chunks = np.array_split(np.arange(POSITIONS), -(-(DISTANCE + 1) // (ERRORS + 1)))
    return [
        (i, kept)
        for i, chunk in enumerate(chunks)
        for kept in combinations(chunk.tolist(), len(chunk) - ERRORS)
    ]


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, s1, s2, size, sig)``: a 128-bit digest of the shingle set, its size, and
    the signature, null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = np.zeros((batch.num_rows, 3), np.int64), []
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                found = shingle_set(text.as_py(), words)
                rows[i, :2] = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8")
                rows[i, 2] = len(found)
                made.append(signature(found).tobytes() if len(found) else None)
            columns = [pa.array(rows[:, j]) for j in range(3)]
            yield pa.record_batch(
                [batch.column(0), *columns, pa.array(made, pa.binary())], ["doc_id", "s1", "s2", "size", "sig"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, s1 bigint, s2 bigint, size bigint, sig binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, POSITIONS)


def keys(nodes: DataFrame) -> DataFrame:
    """``(key, node)``: the keys of all chunks with all allowed errors."""
    variants = chunk_variants()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                sig = _matrix(part.column("sig")).astype(np.uint64)
                out = np.empty((len(variants), len(sig)), np.uint64)
                for j, (chunk, kept) in enumerate(variants):
                    # Which position is left out is part of the key, as is the chunk.
                    key = np.full(len(sig), xxhash.xxh3_64_intdigest(repr((chunk, kept)).encode()), np.uint64)
                    for p in kept:
                        key = (key ^ sig[:, p]) * _SPREAD
                        key ^= key >> np.uint64(32)
                    out[j] = key
                node = np.tile(part.column("node").to_numpy(), len(variants))
                yield pa.record_batch([pa.array(out.ravel().view(np.int64)), pa.array(node)], ["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key bigint, node bigint")


class Signatures:
    """Signatures of some members, compared by the positions in which they differ."""

    def __init__(self, values: list[bytes]):
        self.rows = np.frombuffer(b"".join(values), "<u2").reshape(-1, POSITIONS)

    def near(self, x: int, others: np.ndarray) -> np.ndarray:
        return (self.rows[others] != self.rows[x]).sum(axis=1) <= DISTANCE

    @staticmethod
    def pair(a: bytes, b: bytes) -> bool:
        return int((np.frombuffer(a, "<u2") != np.frombuffer(b, "<u2")).sum()) <= DISTANCE


def sets_within(percent: int) -> type:
    """Shingle sets of some members, compared by their Jaccard similarity in per cent."""

    class Sets:
        def __init__(self, values: list[bytes]):
            sets = [np.frombuffer(v, np.uint64) for v in values]
            self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            self.ends = np.cumsum(self.sizes)
            self.ids = np.unique(np.concatenate(sets), return_inverse=True)[1].reshape(-1)
            # The members that have a shingle, one list after the other.
            self.owners = np.repeat(np.arange(len(sets)), self.sizes)[np.argsort(self.ids, kind="stable")]
            self.length = np.bincount(self.ids)
            self.start = np.cumsum(self.length) - self.length

        def near(self, x: int, others: np.ndarray) -> np.ndarray:
            mine = self.ids[self.ends[x] - self.sizes[x] : self.ends[x]]
            n = self.length[mine]
            at = np.repeat(self.start[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            overlap = np.bincount(self.owners[at], minlength=len(self.sizes))[others]
            return 100 * overlap >= percent * (self.sizes[x] + self.sizes[others] - overlap)

        @staticmethod
        def pair(a: bytes, b: bytes) -> bool:
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * both >= percent * (len(x) + len(y) - both)

    return Sets


def forest(core: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect all near members, given that those of the core are connected.

    Each member found takes its neighbours among those not yet found; one link of a tree
    to the core is enough.
    """
    links: list[tuple[int, int]] = []
    middle, rest = np.flatnonzero(core), np.flatnonzero(~core)
    while len(rest):
        frontier, rest = [int(rest[0])], rest[1:]
        free = len(middle) > 0
        while frontier and (free or len(rest)):
            x = frontier.pop()
            others = np.concatenate([middle, rest]) if free else rest
            hit = near(x, others)
            if free:
                found, hit = np.flatnonzero(hit[: len(middle)]), hit[len(middle) :]
                if len(found):
                    links.append((x, int(middle[found[0]])))
                    free = False
            more = rest[hit]
            links += [(x, int(y)) for y in more]
            frontier += more.tolist()
            rest = rest[~hit]
    return links


def _near_first(kind: type) -> Callable:
    """Keeps each row's group and node and tells whether its value is near the first one's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("value").to_pylist(), batch.column("first_value").to_pylist())
            core = pa.array([kind.pair(a, b) for a, b in pairs], pa.bool_())
            yield batch.drop_columns(["value", "first_value"]).append_column("core", core)

    return run


def _forests(kind: type) -> Callable:
    """Reads rows sorted by run and gives the links of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, cores, values = None, [], [], []

        def links() -> list[tuple[int, int]]:
            if len(nodes) < 2 or all(cores):
                return []
            found = forest(np.array(cores, bool), kind(values).near)
            return [(nodes[x], nodes[y]) for x, y in found if nodes[x] != nodes[y]]

        def rows(out: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("g", "i", "j", "node", "core", "value")]
            for *key, node, core, value in zip(*columns):
                if key != now:
                    out += links()
                    now, nodes, cores, values = key, [], [], []
                nodes.append(node)
                cores.append(core)
                values.append(value)
            if out:
                yield rows(out)
        if out := links():
            yield rows(out)

    return run


def compared(members: DataFrame, values: DataFrame, kind: type, block_rows: int, block_size: int) -> DataFrame:
    """``(a, b)``: links that connect all near members of each group.

    ``members``: ``(g, node, first, n, total, size)``, with the group's first node, its number
    of members and the sum of their sizes; ``values``: ``(node, value)``.
    """

    def blocks(n, total):
        by_size = F.greatest(F.ceil(n / block_rows), F.ceil(total / block_size))
        return F.least(by_size, n).cast("bigint")

    members = members.withColumn("large", blocks(F.col("n"), F.col("total")) > 1)
    firsts = values.select(F.col("node").alias("first"), F.col("value").alias("first_value"))
    flagged = stored(
        members.filter("large")
        .select("g", "node", "first", "size")
        .join(values, "node")
        .join(firsts, "first")
        .select("g", "node", "first", "size", "value", "first_value")
        .mapInArrow(_near_first(kind), "g bigint, node bigint, first bigint, size bigint, core boolean"),
        "near-first",
    )
    star = flagged.filter("core AND node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))

    def counted(core: str):
        return blocks(F.count(F.when(F.expr(core), 1)), F.coalesce(F.sum(F.when(F.expr(core), F.col("size"))), F.lit(0)))

    cuts = flagged.groupBy("g").agg(counted("core").alias("inner"), counted("NOT core").alias("outer"))
    cuts = cuts.filter(F.col("outer") > 0)
    dealt = flagged.join(cuts, "g").select("g", "node", "core", "inner", "outer")

    def numbers(n):
        zero = F.lit(0).cast("bigint")
        return F.when(n > 0, F.sequence(zero, n - 1)).otherwise(F.array().cast("array<bigint>"))

    inner, outer = F.col("inner"), F.col("outer")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("core"), inner).otherwise(outer))

    def run(i, j):
        return F.struct(i.cast("bigint").alias("i"), j.cast("bigint").alias("j"))

    with_outer = F.transform(
        numbers(outer),
        lambda o: F.when(F.col("core"), run(o, outer + own)).otherwise(run(F.least(own, o), F.greatest(own, o))),
    )
    with_inner = F.when(F.col("core"), F.array().cast("array<struct<i:bigint,j:bigint>>")).otherwise(
        F.transform(numbers(inner), lambda c: run(own, outer + c))
    )
    many = dealt.select("g", "node", "core", F.explode(F.concat(with_outer, with_inner)).alias("r"))
    zero = F.lit(0).cast("bigint")
    one = members.filter("NOT large").select("g", "node", F.lit(False).alias("core"), run(zero, zero).alias("r"))
    rows = (
        one.union(many)
        .join(values, "node")
        .select("g", "r.i", "r.j", "node", "core", "value")
        .repartition("g", "i", "j")
        .sortWithinPartitions("g", "i", "j")
    )
    return rows.mapInArrow(_forests(kind), "a bigint, b bigint").union(star)


def signature_links(nodes: DataFrame) -> DataFrame:
    """``(a, b)``: links that connect all nodes whose signatures are within ``DISTANCE``."""
    placed = keys(nodes)
    shared = placed.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1")
    one = F.lit(1).cast("bigint")
    members = stored(
        placed.join(shared, "key").select(F.col("key").alias("g"), "node", "first", "n"), "bucket-members"
    )
    members = members.select("*", F.col("n").alias("total"), one.alias("size"))
    values = nodes.select("node", F.col("sig").alias("value"))
    return compared(members, values, Signatures, BUCKET_BLOCK, BUCKET_BLOCK)


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``(node, value)``: the shingle sets of the documents that ``wanted`` names."""
    marks = docs.sparkSession.sparkContext.broadcast(bit_map(wanted.select(F.xxhash64("node").alias("h")), "h"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.frombuffer(marks.value, np.uint8)
        for batch in batches:
            bit = batch.column("h").to_numpy(zero_copy_only=False) & (MAP_BITS - 1)
            yield batch.filter(pa.array(cells[bit >> 3] >> (bit & 7) & 1 == 1)).drop_columns(["h"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                sets = [shingle_set(t.as_py(), words).tobytes() for t in part.column("text").cast(pa.binary())]
                yield part.drop_columns(["text"]).append_column("value", pa.array(sets, pa.binary()))

    ids = F.col("doc_id").cast("bigint")
    texts = docs.filter("doc_id IS NOT NULL").select(ids.alias("node"), F.xxhash64(ids).alias("h"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(chosen, "node bigint, text string").join(wanted, "node", "left_semi").mapInArrow(
        made, "node bigint, value binary"
    )


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Two documents are linked if ``100 * intersection >= percent * union`` for their sets of
    shingles of ``words`` words, letters A-Z as lower case; a text of fewer words is one
    shingle. The component is the smallest doc_id that links reach; ``kept`` tells whether
    it is the document's own. Null texts and texts without words have no shingles and no
    links. Repeated rows stay repeated. Rows that share a doc_id but not the text link
    for themselves, and groups that have the same smallest doc_id are one. A row without
    doc_id has its number of shingles only. An empty table gives an empty table. Signatures
    are made for 85 per cent: for less, ``DISTANCE`` has to be larger.
    """
    sketch = stored(sketches(docs, words), "minhash-sketches")
    nodes = stored(
        sketch.filter("doc_id IS NOT NULL AND size > 0")
        .groupBy("s1", "s2")
        .agg(F.min("doc_id").alias("node"), F.first("size").alias("size"), F.first("sig").alias("sig")),
        "minhash-nodes",
    )
    groups = stored(components(signature_links(nodes)), "minhash-groups")
    placed = nodes.select("node", "size").join(groups, "node")
    totals = placed.groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    members = stored(
        placed.join(totals, "component").select(
            F.col("component").alias("g"), "node", F.col("component").alias("first"), "n", "total", "size"
        ),
        "minhash-members",
    )
    values = stored(shingle_sets(docs, members.select("node"), words), "minhash-sets")
    grouped = components(compared(members, values, sets_within(percent), GROUP_BLOCK, SHINGLE_BLOCK))
    named = nodes.join(grouped, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("class"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id"))
    return sketch.join(named, ["s1", "s2"], "left").select(
        "doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"), (F.col("doc_id") == own).alias("kept")
    )


def oracle(words: int = 3, percent: int = 85) -> str:
    """The same in SQL, all pairs that share a shingle."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    run = " || ' ' || ".join(f"w[i + {j}]" for j in range(words))
    return rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words} + 2), lambda i: {run}) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * shared >= {percent} * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY ALL)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
    doc_id = coalesce(component_id, doc_id) AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""
