"""Exact ranked lexical search, by grouping documents under their mask of matched terms.

1. One pass over the texts stores, for each document, its length and its counts of the
   terms that the queries have. The corpus figures (documents, length, documents of each
   term) are aggregates of that table.
2. A task reads blocks of those rows. Per block, a term's part of the score is worked out
   once for each posting, whatever the number of queries. For each query, bit operations
   give every document the mask of the query's terms that it holds, and documents of one
   mask are a group. A group's highest possible score follows from its mask, the most
   frequent use of each term and the group's shortest document. Groups are scored exactly
   in descending order of that bound until it falls below the ``k``-th best score so far,
   which the task carries from block to block: no document left can enter, ties included.
3. Every task sends ``k`` rows a query at most; two windows, the first one salted, merge them.

Queries are broadcast in blocks of bounded size, one scan of the documents each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

#: Queries, and terms of queries, that one scan of the documents looks for.
QUERIES_AT_ONCE, TERMS_AT_ONCE = 4096, 1_000_000
#: Postings of a block of documents.
POSTINGS_AT_ONCE = 1 << 20
#: Documents of the best groups that are scored before the bound is looked at again.
SCORED_AT_ONCE = 64

# Scale of the parts, length share in per cent, saturation in thousandths.
SCALE, LENGTH_SHARE, SATURATION = 1_000_000_000, 90, 1000
LENGTH_FACTOR = 8
# End of fixed values.

#: A term in UTF-8 after lower-casing A-Z: digits, letters and everything beyond ASCII.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: bytes | None) -> list[bytes]:
    return _TERM.findall((text or b"").lower())


def query_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, the different terms of all rows of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                mine = sorted(set(terms(text.as_py())))
                ids += [item_id] * len(mine)
                found += mine
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["item_id", "term"])

    rows = items.filter("item_id IS NOT NULL").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "item_id bigint, term binary").distinct()


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, counts)`` of every document with a term at all: its length,
    and the numbers and counts of the terms that the vocabulary has."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                sizes, found = [], []
                for text in part.column(1).cast(pa.binary()):
                    held = terms(text.as_py())
                    sizes.append(len(held))
                    found.append([(number[t], c) for t, c in Counter(held).items() if t in number])
                ends = np.cumsum([0, *map(len, found)])
                flat = np.array([x for pairs in found for x in pairs], np.int64).reshape(-1, 2)
                columns = [
                    part.column(0),
                    pa.array(sizes, pa.int64()),
                    *[pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[:, j])) for j in (0, 1)],
                ]
                rows = pa.record_batch(columns, ["doc_id", "n", "terms", "counts"])
                yield rows.filter(pa.array(np.array(sizes) > 0))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<bigint>, counts array<bigint>")


class Block:
    """Postings of some documents, sorted by term, with each one's part of a score."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, term: np.ndarray, owner: np.ndarray, count: np.ndarray, corpus):
        every, length = corpus
        # In exact integers for the different lengths, which products may carry past 64 bits.
        sizes, place = np.unique(n, return_inverse=True)
        share = [100 - LENGTH_SHARE + LENGTH_SHARE * x * every // length for x in sizes.tolist()]
        self.ids, self.m = ids, np.array(share, np.int64)[place.reshape(-1)]
        order = np.argsort(term, kind="stable")
        self.owner, count = owner[order], count[order]
        self.part = SCALE * count // (SATURATION * count + LENGTH_FACTOR * self.m[self.owner])
        held, start = np.unique(term[order], return_index=True)
        self.at = dict(zip(held.tolist(), zip(start.tolist(), [*start[1:].tolist(), len(order)])))
        self.most = dict(zip(held.tolist(), zip(*(np.maximum.reduceat(x, start).tolist() for x in (self.part, count))))) if len(order) else {}

    def groups(self, mine: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents with any of the terms, ordered by their mask; where each mask starts;
        the masks as bits."""
        words = np.zeros(((len(mine) + 63) // 64, len(self.ids)), np.uint64)
        for i, t in enumerate(mine):
            start, end = self.at[t]
            words[i // 64, self.owner[start:end]] |= np.uint64(1 << i % 64)
        docs = np.flatnonzero(words.any(axis=0))
        words = words[:, docs]
        order = np.lexsort(words)
        docs, words = docs[order], words[:, order]
        first = np.flatnonzero(np.append(True, (words[:, 1:] != words[:, :-1]).any(axis=0))[: len(docs)])
        bits = np.array([words[i // 64, first] >> np.uint64(i % 64) & np.uint64(1) for i in range(len(mine))], bool)
        return docs, first, bits

    def scores(self, docs: np.ndarray, mine: list[int], weight: np.ndarray) -> np.ndarray:
        out = np.zeros(len(docs), np.int64)
        for t, w in zip(mine, weight.tolist()):
            start, end = self.at[t]
            owner = self.owner[start:end]
            at = np.minimum(np.searchsorted(owner, docs), end - start - 1)
            out += np.where(owner[at] == docs, w * self.part[start + at], 0)
        return out

    def best(self, item: np.ndarray, weights: np.ndarray, k: int, held: tuple) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best of those held and those of this block, as (scores, ids)."""
        mine = [t for t in item.tolist() if t in self.at]
        if not mine:
            return held
        weight = weights[mine]
        docs, first, bits = self.groups(mine)
        most, used = np.array([self.most[t] for t in mine], np.int64).T
        shortest = np.minimum.reduceat(self.m[docs], first)
        ceiling = np.minimum(most[:, None], SCALE * used[:, None] // (SATURATION * used[:, None] + LENGTH_FACTOR * shortest))
        bound = (bits * ceiling * weight[:, None]).sum(axis=0)
        end = np.append(first[1:], len(docs))
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        size = np.cumsum((end - first)[order])
        done = 0
        while done < len(order):
            enough = held[0][-1] if len(held[0]) == k else 1
            left = np.searchsorted(-bound[order], -enough, side="right")
            if left <= done:
                break
            before = size[done - 1] if done else 0
            upto = min(left, max(done + 1, np.searchsorted(size, before + SCORED_AT_ONCE)))
            some = np.concatenate([docs[first[g] : end[g]] for g in order[done:upto]])
            score = self.scores(some, mine, weight)
            hit = score >= enough
            held = top(np.concatenate([held[0], score[hit]]), np.concatenate([held[1], self.ids[some[hit]]]), k)
            done = upto
        return held


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _best_of_tasks(rows: DataFrame, items: list[tuple[int, np.ndarray]], weights: np.ndarray, corpus, k: int) -> DataFrame:
    """``(item_id, doc_id, score)``: the best of every task's rows for each item."""
    shared = rows.sparkSession.sparkContext.broadcast((items, weights))
    none = np.empty(0, np.int64)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        for batch in batches:
            ends = batch.column("terms").offsets.to_numpy().astype(np.int64)
            flat = [batch.column(c).flatten().to_numpy() for c in ("terms", "counts")]
            ids, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "n"))
            ends = ends - ends[0]
            i = 0
            while i < len(ids):
                j = max(i + 1, int(np.searchsorted(ends, ends[i] + POSTINGS_AT_ONCE, side="right")) - 1)
                owner = np.repeat(np.arange(j - i), np.diff(ends[i : j + 1]))
                term, count = (x[ends[i] : ends[j]] for x in flat)
                yield Block(ids[i:j], n[i:j], term, owner, count, corpus)
                i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, w = shared.value
        held = [(none, none)] * len(wanted)
        for block in blocks(batches):
            held = [block.best(item, w, k, now) for (_, item), now in zip(wanted, held)]
        for i in range(0, len(held), 1024):
            some = held[i : i + 1024]
            ids = np.repeat([item_id for item_id, _ in wanted[i : i + 1024]], [len(s) for s, _ in some])
            columns = [ids.astype(np.int64), *(np.concatenate([x[j] for x in some]) for j in (1, 0))]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return rows.filter("doc_id IS NOT NULL").mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents for each item.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read.
    Equal scores go by doc_id; documents with score 0 are left out, so an item has fewer
    rows, or none, where few documents have its terms. Null and empty texts have no
    terms. Rows without doc_id count in the corpus and are never found; rows without
    item_id take no part. Rows that repeat an item_id are one item with the terms of all;
    repeated rows of ``docs`` are documents of their own. Empty tables give no rows.
    """
    wanted = stored(query_terms(items), "query-terms")
    n_terms, n_items = wanted.agg(F.count("*"), F.countDistinct("item_id")).first()
    blocks = max(1, -(-n_items // QUERIES_AT_ONCE), -(-n_terms // TERMS_AT_ONCE))
    found = None
    for block in range(blocks):
        chosen = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in chosen}))}
        by_item: dict[int, list[int]] = {}
        for r in chosen:
            by_item.setdefault(r.item_id, []).append(vocabulary[bytes(r.term)])
        rows = stored(postings(docs, vocabulary), "postings")
        corpus = tuple(int(x or 0) for x in rows.agg(F.count("*"), F.sum("n")).first())
        held_by = rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
        weights = np.zeros(len(vocabulary), np.int64)
        for t, df in held_by.collect():  # a row a term of this block of queries
            weights[t] = floor(1000 * log((2 * corpus[0] + 2) / (2 * df + 1)))
        queries = [(i, np.array(t, np.int64)) for i, t in sorted(by_item.items())]
        part = _best_of_tasks(rows, queries, weights, corpus, k)
        found = part if found is None else found.union(part)
    best = [F.col("score").desc(), F.col("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    for keys in (["item_id", "_salt"], ["item_id"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        found = found.withColumn("_salt", salt).withColumn("rank", place).filter(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


def oracle(k: int = 10) -> str:
    """The same in SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = r"regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""WITH d AS (SELECT row_number() OVER () AS no, doc_id, list_transform({found}, lambda x: translate(x, '{upper}', '{upper.lower()}')) AS w FROM documents),
c AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS length FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, translate(unnest({found}), '{upper}', '{upper.lower()}') AS t FROM benchmark WHERE item_id IS NOT NULL),
tf AS (SELECT no, t, count(*) AS tf FROM (SELECT no, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
df AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * n + 1))) AS BIGINT) AS w
    FROM (SELECT t, count(*) AS n FROM tf GROUP BY ALL), c),
m AS (SELECT no, doc_id, 10 + (90 * len(w) * docs) // length AS m FROM d, c WHERE len(w) > 0),
s AS (SELECT item_id, no, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM q JOIN tf USING (t) JOIN df USING (t) JOIN m USING (no) WHERE doc_id IS NOT NULL GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {k}"""
