"""Ranked lexical search of many queries with shared subexpressions.

All documents are ranked for every query item by an integer sum over the
item's terms. The items come in blocks; per block

1. the shared work is mined: terms of the same items form one set, then the
   pair of sets that most items share becomes a node of its own, and so on,
   until no pair is shared. The result is a DAG: leaves are terms, inner nodes
   sums of nodes, items sums of what is left (``mine``);
2. one pass over the texts writes each document's occurrences of the block's
   terms to the shared folder (``postings``), from which Spark counts in how
   many documents each term is;
3. a pass over these postings gives, for blocks of documents, each term's
   partial scores; every node of the DAG is added up once for all items that
   use it (``Plan.evaluate``), and each task keeps the best documents of each
   item, which a window per item reduces to the best of all.

A block of items is bounded in items and bytes, so what is sent to the tasks
(its terms and its DAG) is bounded too, however many items there are.

Results for odd input: a null text has no terms and never scores; an item
without terms (null, empty) has no rows; repeated documents and repeated items
are ranked as rows of their own; among equal scores a document without an id
comes after those with one; an empty table on either side gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlens.llm.common import arrow_map, id_text
from demandlens.session import scratch_path

#: Items and bytes of item texts of a block.
BLOCK_ITEMS, BLOCK_BYTES = 1024, 4 << 20
#: Sets of one item among which pairs are sought (longer items in segments).
SEGMENT = 64
#: Bytes of the accumulators of a block of documents in a task.
ACCUMULATOR_BYTES = 64 << 20
#: Bytes of a text that are split into terms at a time.
TEXT_BYTES = 4 << 20

# The term alphabet (ASCII letters and digits and everything
# beyond ASCII) and the constants of the score.
_ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TO_TERMS = bytes(b if b > 0x7F or b in _ALNUM else 0x20 for b in range(256)).lower()
WEIGHT_SCALE, SCORE_SCALE, TF_SCALE, LENGTH_SCALE = 1000, 1_000_000_000, 1000, 12
LENGTH_BASE, LENGTH_SHARE = 100, 25


# --------------------------------------------------------------------------
# terms
# --------------------------------------------------------------------------


def term_slices(text: str, size: int = TEXT_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces of bounded size; only A-Z change case."""
    data = text.encode().translate(_TO_TERMS)
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + size)
        stop = len(data) if stop < 0 else stop
        yield data[at:stop].split()
        at = stop


def term_counts(text: str) -> Counter:
    counts: Counter = Counter()
    for terms in term_slices(text):
        counts.update(terms)
    return counts


# --------------------------------------------------------------------------
# mining shared term sets
# --------------------------------------------------------------------------


class Plan:
    """The query-sharing DAG of a block of items.

    Nodes are numbered: leaf k is ``leaves[k]`` = (term number, repeats); node
    ``len(leaves) + k`` is the sum of the nodes ``sums[k]``, all of lower
    number. ``items[i]`` are the nodes whose sum is the score of item i."""

    def __init__(self, leaves, sums, items):
        self.leaves: list[tuple[int, int]] = leaves
        self.sums: list[tuple[int, ...]] = sums
        self.items: list[tuple[int, ...]] = items

    @property
    def nodes(self) -> int:
        return len(self.leaves) + len(self.sums)

    def additions(self) -> int:
        return sum(max(0, len(n) - 1) for n in [*self.sums, *self.items])

    def evaluate(self, documents: int, leaf_rows: Iterable[tuple[int, np.ndarray, np.ndarray]]):
        """(item, scores of all documents) of the items; ``leaf_rows`` are (term,
        document numbers, partial scores). Every node is added up once."""
        repeats = defaultdict(list)
        for node, (term, times) in enumerate(self.leaves):
            repeats[term].append((node, times))
        acc = np.zeros((self.nodes, documents), np.int64)
        live = np.zeros(self.nodes, bool)  # nodes that any document here has
        for term, docs, partial in leaf_rows:
            for node, times in repeats[term]:
                acc[node, docs] = partial * times
                live[node] = True
        base = len(self.leaves)
        for k, parts in enumerate(self.sums):
            here = [p for p in parts if live[p]]
            for p in here:
                acc[base + k] += acc[p]
            live[base + k] = bool(here)
        for i, parts in enumerate(self.items):
            here = [p for p in parts if live[p]]
            if here:
                yield i, acc[here[0]] if len(here) == 1 else acc[here].sum(axis=0)


def mine(items: list[dict[int, int]], segment: int = SEGMENT) -> Plan:
    """The DAG of items given as {term number: repeats}.

    Terms that the same items have (equally often) become one set. Of an
    item's shared sets, in the order of how many items have them, pairs are
    counted within segments; the pair in most items becomes a node, replaces
    its two parts there, and may pair up again. A set of one item only is
    added up within that item."""
    holders: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, terms in enumerate(items):
        for leaf in terms.items():
            holders[leaf].append(i)
    leaves = sorted(holders)
    sets: dict[tuple[int, ...], list[int]] = defaultdict(list)
    for node, leaf in enumerate(leaves):
        sets[tuple(holders[leaf])].append(node)
    sums: list[tuple[int, ...]] = []
    parts: list[list[int]] = [[] for _ in items]
    shared: list[list[int]] = [[] for _ in items]

    def new_node(children: Iterable[int]) -> int:
        sums.append(tuple(children))
        return len(leaves) + len(sums) - 1

    for owners, nodes in sorted(sets.items(), key=lambda s: (-len(s[0]), s[1])):
        if len(owners) == 1:
            parts[owners[0]] += nodes
            continue
        node = nodes[0] if len(nodes) == 1 else new_node(nodes)
        for i in owners:
            shared[i].append(node)

    groups: list[tuple[int, set[int]]] = []  # (item, its sets of one segment)
    for i, nodes in enumerate(shared):
        for at in range(0, len(nodes), segment):
            groups.append((i, set(nodes[at : at + segment])))
    both: dict[tuple[int, int], set[int]] = defaultdict(set)
    for g, (_, nodes) in enumerate(groups):
        order = sorted(nodes)
        for x, a in enumerate(order):
            for b in order[x + 1 :]:
                both[a, b].add(g)
    heap = [(-len(h), pair) for pair, h in both.items() if len(h) > 1]
    heapq.heapify(heap)
    while heap:
        count, pair = heapq.heappop(heap)
        where = both.get(pair, set())
        if len(where) < 2:
            continue
        if len(where) != -count:  # shrunk meanwhile
            heapq.heappush(heap, (-len(where), pair))
            continue
        a, b = pair
        node = new_node(pair)
        where = sorted(both.pop(pair))
        grown: set[tuple[int, int]] = set()
        for g in where:
            nodes = groups[g][1]
            nodes -= {a, b}
            for other in nodes:
                for gone in (a, b):
                    both[min(gone, other), max(gone, other)].discard(g)
                both[other, node].add(g)
                grown.add((other, node))
            nodes.add(node)
        for new in grown:
            if len(both[new]) > 1:
                heapq.heappush(heap, (-len(both[new]), new))
    for i, nodes in groups:
        parts[i] += sorted(nodes)
    return Plan(leaves, sums, [tuple(p) for p in parts])


class Block:
    """A block of items: ids, terms and DAG."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in rows]
        self.terms: dict[bytes, int] = {}
        items = []
        for _, text in rows:
            items.append(
                {self.terms.setdefault(t, len(self.terms)): n for t, n in term_counts(text or "").items()}
            )
        self.plan = mine(items)


def blocks(items: DataFrame, id_col: str, text_col: str, most: int, size: int) -> Iterator[Block]:
    """Blocks of items, drawn one partition at a time."""
    rows, used = [], 0
    for item, text in items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        length = len((text or "").encode())
        if rows and (len(rows) >= most or used + length > size):
            yield Block(rows)
            rows, used = [], 0
        rows.append((item, text))
        used += length
    if rows:
        yield Block(rows)


# --------------------------------------------------------------------------
# documents
# --------------------------------------------------------------------------


def postings(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): a document's number of terms and its counts of
    the given ones; documents without any term are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, ends, numbers, counts = [], [], [0], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = term_counts(text)
                n = found.total()
                if not n:
                    continue
                ids.append(doc)
                sizes.append(n)
                for t in found.keys() & terms.keys():
                    numbers.append(terms[t])
                    counts.append(found[t])
                ends.append(len(numbers))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return arrow_map(docs, run, "doc_id long, n long, terms array<int>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, total: int) -> int:
    return LENGTH_BASE - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // total


class Best:
    """The highest-scoring documents of one item in one task."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 0

    def offer(self, scores: np.ndarray, docs: list) -> None:
        full = len(self.rows) == self.k
        at = np.flatnonzero(scores >= self.least if full else scores > 0)
        if len(at) > self.k:  # those below the k-th score can't be among the best
            cut = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
            at = at[scores[at] >= cut]
        if len(at):
            rows = self.rows + [(int(scores[i]), docs[i]) for i in at.tolist()]
            self.rows = heapq.nsmallest(self.k, rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
            self.least = self.rows[-1][0]


def best_of_tasks(
    found: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, total: int, k: int
) -> DataFrame:
    """(item, doc_id, score): each task's best documents of each item."""
    height = max(1, ACCUMULATOR_BYTES // (8 * max(1, plan.nodes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in plan.items]
        for whole in batches:
            for at in range(0, whole.num_rows, height):
                batch = whole.slice(at, height)
                docs = batch.column("doc_id").to_pylist()
                norm = np.array(
                    [length_norm(n, n_docs, total) for n in batch.column("n").to_pylist()], np.int64
                )
                terms = batch.column("terms").flatten().to_numpy()
                tf = batch.column("tfs").flatten().to_numpy()
                sizes = np.diff(batch.column("terms").offsets.to_numpy())
                row = np.repeat(np.arange(len(docs)), sizes)
                partial = weights[terms] * (
                    (SCORE_SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * norm[row])
                )
                order = np.argsort(terms, kind="stable")
                terms, row, partial = terms[order], row[order], partial[order]
                cuts = np.flatnonzero(np.diff(terms, prepend=-1, append=-1)).tolist()
                leaf_rows = ((int(terms[a]), row[a:b], partial[a:b]) for a, b in zip(cuts, cuts[1:]))
                for i, scores in plan.evaluate(len(docs), leaf_rows):
                    best[i].offer(scores, docs)
        out = [(i, doc, score) for i, b in enumerate(best) for score, doc in b.rows]
        columns = list(zip(*out)) if out else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))],
            ["item", "doc_id", "score"],
        )

    return arrow_map(found, run, "item int, doc_id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 20,
    block_items: int = BLOCK_ITEMS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of each item."""
    spark, source = docs.sparkSession, id_text(docs, id_col, text_col)
    results = []
    for block in blocks(items, item_col, item_text_col, block_items, block_bytes):
        path = scratch_path(spark, "postings")
        postings(source, block.terms).write.parquet(path)
        found = spark.read.parquet(path)
        size = found.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not size["docs"]:
            continue
        holding = found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(block.terms), np.int64)
        for term, df in holding:  # at most the terms of the block
            weights[term] = weight(size["docs"], df)
        tops = best_of_tasks(found, block.plan, weights, size["docs"], size["terms"], k)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
        ids = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id long")
        ranked = tops.withColumn("rank", rank).filter(F.col("rank") <= k)
        results.append(ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
