"""Ranked lexical search over a length-stratified index.

Terms are runs of digits, A-Z (lower-cased) and all characters from U+0080 on, told apart by 64-bit hashes. A score
is whole numbers only: a term's weight w falls with the documents that hold it, and a document adds
``w * ((10**9 * tf) div (1000 * tf + 20 * m))`` for each term of the item, where its normaliser m grows with its length.

Documents of equal m form a stratum. The index keeps, for every document, its stratum and its postings, and is
dealt by ranges of (m, hash), so strata lie together and a stratum of any size is cut into several tasks. In a task
the postings of a stratum are ordered by tf; as m is fixed there, what a tf adds is computed once for all
postings that share it. The greatest tf of each term bounds what any document of the stratum can score for an
item. Strata are visited by falling bounds and passed over for items whose bound is below the k-th
best score so far; that loses nothing. The k best of each task meet in one ranking per item.

Two passes over the texts would be one too many: one pass writes each document's length and its postings of
the items' terms, from which the counts N, L and df come, and then the index. Items are searched in groups of at
most ``PAIRS`` (item, term) pairs, so what is broadcast, a group's terms and weights, is bounded however many
items there are; inside a task a group is scored in blocks of items against blocks of documents.

Edge cases: a null or empty text, or one without terms, counts nowhere and is never returned; an item without terms
or without matches gets no rows; items equal in id and text are one item, items that share only the id are
ranked each by itself; rows of documents with equal ids are separate documents; ids are whole numbers, equal scores go by rising
id, null ids first; an empty table on either side gives an empty result; further columns are ignored, whatever
their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import LOWER, SpanHashes, slices, span_edges, stage, text_bytes, with_text

PAIRS = 200_000  # (item, term) pairs of a group, some thousand items
CELLS = 2_000_000  # numbers of a dense block
RUN = 1_000_000  # postings that a task orders at a time
EXACT = 1 << 53  # whole numbers below it are exact as doubles

# Term bytes: 0-9, A-Z, a-z and all of UTF-8 beyond ASCII.
TERM = np.zeros(256, bool)
TERM[0x30:0x3A] = TERM[0x41:0x5B] = TERM[0x61:0x7B] = TERM[0x80:] = True


def terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the text number of every term."""
    starts, ends, text = span_edges(TERM[data], bounds)
    return SpanHashes(LOWER[data]).of(starts, ends), text


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def gain(tf: np.ndarray, m: int) -> np.ndarray:
    """What a term of weight 1 adds by its ``tf``."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


# --- items ---------------------------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """``(item, terms)`` with each item's distinct term hashes; items without terms are left out."""

    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            hashes, text = terms(data, bounds)
            cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
            found = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["item", "terms"])

    return items.select("item", "text").mapInArrow(run, "item long, terms array<long>").where("size(terms) > 0")


@dataclass(frozen=True)
class Block:
    """Some items with the terms they use: which term is in which item."""

    items: np.ndarray
    column: np.ndarray  # of each term of the group; -1 for terms of other blocks
    holds: np.ndarray  # column by item, one or zero


@dataclass(frozen=True)
class Group:
    """Items searched together. ``vocabulary`` is sorted; a term's place in it is its number."""

    items: np.ndarray
    vocabulary: np.ndarray
    first: np.ndarray  # bounds of each item's terms
    numbers: np.ndarray

    def edges(self) -> list[tuple[int, int]]:
        """Ranges of items whose blocks have at most ``CELLS`` numbers; a single item may have more."""
        out, at = [], 0
        while at < len(self.items):
            end = at + 1
            used = np.unique(self.numbers[self.first[at] : self.first[end]])
            while end < len(self.items):
                more = np.union1d(used, self.numbers[self.first[end] : self.first[end + 1]])
                if len(more) * (end + 1 - at) > CELLS:
                    break
                used, end = more, end + 1
            out.append((at, end))
            at = end
        return out

    def block(self, at: int, end: int, kind) -> Block:
        used = np.unique(self.numbers[self.first[at] : self.first[end]])
        column = np.full(len(self.vocabulary), -1, np.int32)
        column[used] = np.arange(len(used))
        holds = np.zeros((len(used), end - at), kind)
        for i in range(at, end):
            holds[column[self.numbers[self.first[i] : self.first[i + 1]]], i - at] = 1
        return Block(self.items[at:end], column, holds)


def _group(rows) -> Group:
    rows = sorted(rows, key=lambda r: r["item"])
    hashes = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
    vocabulary, numbers = np.unique(np.concatenate(hashes), return_inverse=True)
    first = np.concatenate(([0], np.cumsum([len(h) for h in hashes])))
    return Group(np.array([r["item"] for r in rows], np.int64), vocabulary, first, numbers.astype(np.int32))


# --- the index -----------------------------------------------------------------------------------


def term_vectors(documents: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: every document with a term, its length, and its postings of the vocabulary."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for a, b in slices(bounds):
                hashes, text = terms(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                n = np.bincount(text, minlength=b - a)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                place, tf = np.unique(text[hit] * len(known) + at[hit], return_counts=True)
                first = np.concatenate(([0], np.cumsum(np.bincount(place // len(known), minlength=b - a))))
                first = pa.array(first.astype(np.int32))
                lists = [pa.ListArray.from_arrays(first, pa.array(x.astype(np.int32))) for x in (place % len(known), tf)]
                kept = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])
                yield kept.filter(pa.array(n > 0))

    return documents.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def stratified(vectors: DataFrame, n: int, total: int) -> DataFrame:
    """The index: documents with their normaliser m, dealt by ranges of it and in its order."""
    share = F.expr(f"(CAST(50 * n AS DECIMAL(20,0)) * CAST({n} AS DECIMAL(18,0))) div CAST({total} AS DECIMAL(20,0))")
    index = vectors.where("size(terms) > 0").select("doc_id", (share + 50).alias("m"), "terms", "tfs")
    # The hash cuts a stratum that is too large for one task.
    return index.repartitionByRange("m", F.xxhash64("doc_id", "terms")).sortWithinPartitions("m")


# --- the search ----------------------------------------------------------------------------------


class Best:
    """The k best (score, id) of each item of a block so far, and the score that is still to be reached."""

    def __init__(self, items: int, k: int):
        self.k, self.reach = k, np.ones(items, np.int64)
        self.kept = [np.zeros(0, np.int64)] * 4  # item, score, id, whether there is an id
        self.waiting: list[list[np.ndarray]] = []
        self.size = 0

    def offer(self, item, score, ids, there) -> None:
        self.waiting.append([item, score, ids, there])
        self.size += len(item)
        if self.size > 4 * self.k * len(self.reach):
            self.settle()

    def settle(self) -> None:
        item, score, ids, there = (np.concatenate(x) for x in zip(self.kept, *self.waiting))
        order = np.lexsort((ids, there, -score, item))
        item = item[order]
        starts = np.searchsorted(item, np.arange(len(self.reach)))
        rank = np.arange(len(item)) - starts[item]
        kept = order[rank < self.k]
        self.kept, self.waiting, self.size = [x[kept] for x in (item_of(item, order), score, ids, there)], [], 0
        last = np.flatnonzero(rank == self.k - 1)
        self.reach[item[last]] = np.maximum(self.reach[item[last]], score[order[last]])


def item_of(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The item column in its first order."""
    out = np.empty_like(ordered)
    out[order] = ordered
    return out


class Stratum:
    """Documents of one normaliser, their postings ordered by tf, and what each posting adds."""

    def __init__(self, m: int, ids, there, document, term, tf, weights):
        order = np.argsort(tf, kind="stable")
        self.ids, self.there = ids, there
        self.document, self.term = document[order], term[order]
        values, which = np.unique(tf[order], return_inverse=True)
        self.adds = gain(values, m)[which] * weights[self.term]

    def bound(self, block: Block) -> np.ndarray:
        """The most that a document can score for each item."""
        most = np.zeros(len(block.holds), block.holds.dtype)
        column = block.column[self.term]
        used = column >= 0
        most[column[used]] = self.adds[used]  # by rising tf: the last one stays
        return most @ block.holds

    def search(self, block: Block, chosen: np.ndarray, best: Best) -> None:
        column = block.column[self.term]
        used = column >= 0
        document, column, adds = self.document[used], column[used], self.adds[used]
        step = max(1, CELLS // max(1, len(block.holds)))
        holds = block.holds if chosen.all() else block.holds[:, chosen]
        numbers = np.flatnonzero(chosen)
        for a in range(0, len(self.ids), step):
            here = (document >= a) & (document < a + step) if len(self.ids) > step else slice(None)
            dense = np.zeros((min(step, len(self.ids) - a), len(block.holds)), holds.dtype)
            dense[document[here] - a, column[here]] = adds[here]
            score = dense @ holds
            found, item = np.nonzero(score >= best.reach[numbers])
            best.offer(numbers[item], score[found, item].astype(np.int64), self.ids[a + found], self.there[a + found])


def _strata(batches, weights):
    """The strata of a task, in runs of about ``RUN`` postings."""

    def cut(held):
        column = {c: pa.concat_arrays([b.column(c) for b in held]) for c in ("doc_id", "m", "terms", "tfs")}
        there = np.asarray(column["doc_id"].is_valid())
        ids = column["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
        m = column["m"].to_numpy()
        sizes = column["terms"].value_lengths().to_numpy()
        first = np.concatenate(([0], np.cumsum(sizes)))
        term, tf = (column[c].flatten().to_numpy() for c in ("terms", "tfs"))
        edges = np.concatenate(([0], np.flatnonzero(np.diff(m)) + 1, [len(m)]))
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            part = slice(first[a], first[b])
            out.append(Stratum(int(m[a]), ids[a:b], there[a:b], np.repeat(np.arange(b - a), sizes[a:b]), term[part],
                               tf[part].astype(np.int64), weights))
        return out

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column("terms").flatten())
        if size >= RUN:
            yield cut(held)
            held, size = [], 0
    if held:
        yield cut(held)


def best_of(runs, group: Group, weights: np.ndarray, k: int):
    """The k best documents of each item over runs of strata, as arrays of item, score, id and whether there is one."""
    longest = int(np.max(np.diff(group.first)))
    exact = longest * int(max(1, np.max(weights))) * 1_000_000 < EXACT
    kind = np.float64 if exact else np.int64
    edges = group.edges()
    bests = [Best(end - at, k) for at, end in edges]
    for strata in runs:
        for (at, end), best in zip(edges, bests):
            block = group.block(at, end, kind)  # one at a time
            bounds = [stratum.bound(block) for stratum in strata]
            for n in sorted(range(len(strata)), key=lambda i: -float(bounds[i].max())):
                chosen = bounds[n] >= best.reach
                if chosen.any():
                    strata[n].search(block, chosen, best)
    for (at, end), best in zip(edges, bests):
        best.settle()
        item, score, ids, there = best.kept
        yield group.items[at:end][item], score, ids, there.astype(bool)


def _searched(index: DataFrame, group: Group, weights: np.ndarray, k: int) -> DataFrame:
    """``(item, doc_id, score)``: each task's k best."""
    shared = index.sparkSession.sparkContext.broadcast((group, weights))

    def run(batches):
        group, weights = shared.value
        for item, score, ids, there in best_of(_strata(batches, weights), group, weights, k):
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(ids, mask=~there), pa.array(score)], ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item long, doc_id long, score long")


def search(documents: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each item's ``k`` highest-scoring documents: ``item_col, rank, id_col, score``."""
    spark = documents.sparkSession
    rows = with_text(documents, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct()
    # Numbers depend on how rows are dealt, so they are written down.
    wanted = stage(wanted.withColumn("item", F.monotonically_increasing_id()), "items")
    found = stage(item_terms(wanted), "item_terms")
    pairs = found.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = -(-pairs // PAIRS)
    out = None
    for g in range(groups):
        chosen = found.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).collect()
        if not chosen:
            continue
        group = _group(chosen)
        vectors = stage(term_vectors(rows, group.vocabulary), "term_vectors")
        n, total = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n:
            break
        held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
        df = np.zeros(len(group.vocabulary), np.int64)
        df[held["term"].to_numpy()] = held["df"].to_numpy()
        weights = np.array([weight(n, int(x)) for x in df], np.int64)
        part = _searched(stratified(vectors, n, total), group, weights, k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "item long, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(wanted.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score"
    )


# The same ranking, plainly: every posting of every term, joined with the items' terms.
ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS d,
         regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents WHERE text IS NOT NULL),
tokens AS (
  SELECT d, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT d, unnest(ws) AS w FROM words)),
docs AS (
  SELECT words.d, any_value(doc_id) AS doc_id, count(*) AS n FROM words JOIN tokens ON words.d = tokens.d GROUP BY words.d),
whole AS (SELECT count(*) AS cn, CAST(sum(n) AS BIGINT) AS cl FROM docs),
postings AS (SELECT d, term, count(*) AS tf FROM tokens GROUP BY d, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * cn + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, whole GROUP BY term, cn),
items AS (
  SELECT DISTINCT item_id, text, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT item_id, text, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)),
scores AS (
  SELECT i.item_id, i.text, docs.doc_id, docs.d,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * cn) // cl)))) AS BIGINT) AS score
  FROM items i JOIN postings p ON i.term = p.term JOIN weights ON p.term = weights.term JOIN docs ON p.d = docs.d, whole
  GROUP BY i.item_id, i.text, docs.doc_id, docs.d),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST) AS r, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 50
"""
