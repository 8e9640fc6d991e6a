"""Near-duplicate documents by SetSketch registers, banding, a likelihood test, and full sets.

A document's set is its distinct word shingles. Register ``i`` of its sketch holds the truncated
logarithm, to a base just above one, of the least of the exponentially distributed values that hash
``i`` gives to the set's members: ``floor(1 - log_b(minimum))``. Sketches of parts merge by the larger register, and two
sketches agree in a register with a probability near their sets' similarity. Steps:

1. Equal sets form one class; the rest works on classes. Classes that share a document id are linked.
2. Four registers make a band. Classes with an equal band share a bucket; of buckets with the same
   members one is kept.
3. Leaders: the members of each bucket are paired with a few leaders, those that come first by ``LEADERS`` hashes. That
   makes at most so many pairs for each seat, however large a bucket is. Buckets of a group of copies have nearly the
   same members and so the same leaders: the group takes a few pairs for each member and is mostly one component then.
4. A pair counts if the set sizes allow the similarity and its joint likelihood, given the two sketches and
   sizes, is not greatest more than ``DOUBT`` below it. Pairs that count are confirmed on the full
   sets, and confirmed links joined to components.
5. In buckets that still hold several components all members outside the largest one are compared with all
   others of other components, by likelihood first and on the full sets then, in the same task: what leaves it are links
   that join components. So all pairs of a bucket are either confirmed, refuted or joined by confirmed links.

In the last step the largest component of a bucket is dealt in blocks of ``BLOCK`` members, each once for
every block of the rest, and the rest as pairs of blocks, so no task sees more than two blocks. Two sets of similarity 0.8
miss each other in all 28 bands once in 2.5 million times.

Edge cases: a text without words has an empty set and is linked with nothing; fewer words than the
width make one shingle; rows without an id are returned unlinked, with a null component, and kept;
rows that share an id are one node, however many they are and whatever their texts; equal rows and ties give the
least id; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import SMALL_IDS, lean, shingle_sets, slices, stage, text_bytes, with_text
from tidewell.llm.components import components
from tidewell.operators.keyed import combined

REGISTERS = 448
BANDS, BAND = 28, 4  # bands take the first registers, the estimate all of them
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 2  # published settings for 16-bit registers
DOUBT = 0.08  # how far below the wanted similarity a likely one may lie: over four standard errors
LEADERS = 4  # of a bucket
BLOCK = 1_000  # members of a bucket in one block
BLOCK_BYTES = 32 << 20  # of their full sets, if that is fewer members

_RANDOM = np.random.default_rng(7_331)
_FACTOR = _RANDOM.integers(0, 2**31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _RANDOM.integers(0, 2**32, REGISTERS, dtype=np.uint32)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of each set, one row for each; an empty set has zeros."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    members = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
    heads = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
    least = np.empty((len(full), REGISTERS), np.uint32)
    value = np.empty_like(members)
    for r in range(REGISTERS):
        np.multiply(members, _FACTOR[r], out=value)
        np.add(value, _SHIFT[r], out=value)
        value ^= value >> np.uint32(15)
        np.multiply(value, np.uint32(0x2C1B3C6D), out=value)
        least[:, r] = np.minimum.reduceat(value, heads)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)
    return out


def plausible(greater, equal, less, size_a, size_b, wanted: float) -> np.ndarray:
    """Whether the sizes allow the similarity ``wanted`` and the likeliest one is not more than
    ``DOUBT`` below it, given how many registers of a are greater than, equal to and less than those
    of b.

    The log likelihood is concave, so its slope at a point tells on which side the maximum lies.
    """
    at = max(wanted - DOUBT, 0.0)
    size_a, size_b = np.asarray(size_a, float), np.asarray(size_b, float)
    share = size_a / (size_a + size_b)
    rest = 1 - share
    possible = wanted * np.maximum(size_a, size_b) <= np.minimum(size_a, size_b) * (1 + 1e-9)
    step = (BASE - 1) / BASE

    def part(x):  # probability of a strict order, and its slope
        x = np.clip(x, 1e-12, 1)
        return -np.log1p(-x * step) / np.log(BASE), step / (1 - x * step) / np.log(BASE)

    over, d_over = part(share - rest * at)
    under, d_under = part(rest - share * at)
    tie = np.maximum(1 - over - under, 1e-12)
    slope = (
        -greater * rest * d_over / over - less * share * d_under / under
        + equal * (rest * d_over + share * d_under) / tie
    )
    return possible & (slope >= 0)


def _name(members: bytes) -> bytes:
    return hashlib.blake2b(members, digest_size=16).digest()


def _set_rows(df: DataFrame, width: int) -> DataFrame:
    """Per row: set size, a 128-bit name of the set, and the registers."""

    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for lo, hi in slices(bounds):
                part = data[bounds[lo] : bounds[hi]]
                sets = shingle_sets(part, bounds[lo : hi + 1] - bounds[lo], width)
                names = [_name(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(map(len, sets), pa.int64()),
                     pa.array(names, pa.binary()), pa.array([r.tobytes() for r in sketch(sets)], pa.binary())],
                    ["doc_id", "n_shingles", "name", "registers"],
                )

    return df.mapInArrow(lean(run), "doc_id long, n_shingles long, name binary, registers binary")


def _bands(rows, band):
    """The bands before ``band`` of each member."""
    return np.ascontiguousarray(rows[:, : BANDS * BAND]).view(np.uint64)[:, :band]


def _links_across(sizes, rows, wanted, allowed, groups, band, percent, members):
    """Pairs that join groups: members of different groups, likely and confirmed on the full sets.

    Pairs that share a band before this one are left to its bucket. Groups that a link has joined count as one from
    then on, so there are fewer links than members.
    """
    bands = _bands(rows, band)
    groups = groups.copy()
    for node in range(len(sizes) - 1):
        some = allowed(node) & (groups != groups[node])
        some[: node + 1] = False
        some &= ~(bands == bands[node]).any(axis=1)
        likeness = _likeness(rows, sizes, node, wanted, some)
        likely = np.flatnonzero(likeness >= 0)
        for other in likely[np.argsort(-likeness[likely], kind="stable")].tolist():
            if groups[other] != groups[node] and _similar(members(node), members(other), percent):
                groups[groups == groups[other]] = groups[node]
                yield node, other


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether ``100 * intersection >= percent * union`` for two sorted sets."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _likeness(rows, sizes, node, wanted, some):
    """Equal registers of a member with each of ``some``; -1 where they cannot be similar."""
    fits = some & (wanted * np.maximum(sizes, sizes[node]) <= np.minimum(sizes, sizes[node]) * (1 + 1e-9))
    fits[node] = False
    out = np.full(len(sizes), -1)
    some = np.flatnonzero(fits)
    if len(some):
        equal = (rows[node] == rows[some]).sum(axis=1)
        greater = (rows[node] > rows[some]).sum(axis=1)
        good = plausible(greater, equal, REGISTERS - equal - greater, sizes[node], sizes[some], wanted)
        out[some[good]] = equal[good]
    return out


def _links_of_blocks(members: DataFrame, wanted: float, percent: int) -> DataFrame:
    """Links ``(a, b)`` across the components of each bucket, one pair of blocks at a time.

    Where the blocks differ, only pairs between them count.
    """
    keys = ["bucket", "i", "j"]
    dealt = members.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        kept, key = [], None

        def solve(key, rows):
            if len(rows) < 2:
                return
            rows.sort(key=lambda r: r[0])
            ids, sizes, blocks, groups = (np.array([r[k] for r in rows]) for k in (0, 1, 2, 5))
            registers = np.frombuffer(b"".join(r[4] for r in rows), np.uint16).reshape(len(ids), -1)
            every = np.ones(len(ids), bool)
            allowed = (lambda node: every.copy()) if key[1] == key[2] else (lambda node: blocks != blocks[node])
            found = list(_links_across(sizes, registers, wanted, allowed, groups, rows[0][3], percent,
                                       lambda k: np.frombuffer(rows[k][6], np.uint64)))
            if found:
                a, b = ids[np.array(found)].T
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != key:
                    yield from solve(key, kept)
                    kept, key = [], row[:3]
                kept.append(row[3:])
        yield from solve(key, kept)

    columns = [*keys, "id", "n_shingles", "own", "band", "registers", "component", "members"]
    return dealt.select(*columns).mapInArrow(lean(run), "a long, b long")


def _placed(seats: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Seats with the component of their member so far."""
    if parts is None:
        return seats.withColumn("component", F.col("id"))
    return seats.join(parts, F.col("id") == F.col("node"), "left").drop("node").withColumn(
        "component", F.coalesce("component", "id")
    )


def _pairs_of_leaders(seats: DataFrame) -> DataFrame:
    """Distinct pairs of each bucket's leaders with its other members."""
    first = [F.min(F.struct(F.xxhash64(F.lit(k), "id").alias("draw"), "id")).alias(f"l{k}") for k in range(LEADERS)]
    of_bucket = combined(seats, "bucket", *first)
    leaders = F.array_distinct(F.array(*[f"l{k}.id" for k in range(LEADERS)]))
    met = seats.join(of_bucket.select("bucket", leaders.alias("leaders")), "bucket")
    met = met.select("id", F.explode("leaders").alias("leader")).where("id <> leader")
    return met.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()


def _likely(pairs: DataFrame, classes: DataFrame, wanted: float) -> DataFrame:
    """The pairs whose sketches and sizes allow the similarity."""

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}")
        )

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (4, 5))
            equal, greater = (a == b).sum(axis=1), (a > b).sum(axis=1)
            sizes = (batch.column(k).to_numpy() for k in (2, 3))
            good = plausible(greater, equal, REGISTERS - equal - greater, *sizes, wanted)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good))

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(lean(run), "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have ``100 * intersection >= percent * union``."""
    of_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("members").alias("mb")), "b")
    both = of_b.join(sets.select(F.col("id").alias("a"), F.col("members").alias("ma")), "a")

    def run(batches):
        for batch in batches:
            hits = [
                _similar(*(np.frombuffer(v.as_py(), np.uint64) for v in pair), percent)
                for pair in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(hits))

    return both.select("a", "b", "ma", "mb").mapInArrow(lean(run), "a long, b long")


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: the size of its set, its component's least id, and whether it is that document."""
    texts = with_text(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    wanted = percent / 100
    rows = stage(_set_rows(texts, width), "sketches")
    with_sets = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = with_sets.groupBy("name").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
    )
    # Numbers depend on how rows are dealt, so they are written down.
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    bands = classes.select(
        "id",
        F.posexplode(F.array(*(
            F.xxhash64(F.lit(k), F.substring("registers", 2 * BAND * k + 1, 2 * BAND)) for k in range(BANDS)
        ))).alias("band", "bucket"),
    )
    same = bands.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("band").alias("band"), F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y"),
    ).where("n > 1")
    # Buckets with the same members are one, that of the first band.
    buckets = same.groupBy("n", "x", "y").agg(F.min(F.struct("band", "bucket")).alias("first"))
    seats = stage(bands.select("id", "bucket").join(buckets.select("first.bucket", "first.band"), "bucket"), "seats")

    pairs = stage(_likely(_pairs_of_leaders(seats), classes, wanted), "pairs")
    paired = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "paired")
    sets = stage(_sets_of(paired, classes, texts, width), "sets")
    links = _links_by_id(with_sets, classes).unionByName(_confirmed(pairs, sets, percent))
    links = stage(links, "links")
    parts = stage(components(links), "parts")
    open_ = stage(_open_seats(_placed(seats, parts)), "open")
    if not open_.isEmpty():
        more = open_.select("id").distinct().join(paired, "id", "left_anti")
        sets = sets.unionByName(stage(_sets_of(more, classes, texts, width), "more-sets"))
        more = stage(_links_of_blocks(_open_members(open_, classes, sets), wanted, percent), "more-links")
        if not more.isEmpty():
            parts = stage(components(links.unionByName(more)), "all-parts")

    classed = _placed(classes.select("name", "id", "least"), parts)
    # A component may hold most of all classes: combined before the shuffle, and split in the join.
    least = combined(classed, "component", F.min("least").alias("component_id"))
    named = classed.join(least, "component").select("name", "component_id")
    labelled = rows.drop("registers").join(named, "name", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return labelled.select(
        F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _links_by_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of one document id; there are none where ids are unique."""
    named = F.xxhash64("name")
    several = rows.groupBy("doc_id").agg(F.min(named).alias("u"), F.max(named).alias("v")).where("u < v")
    shared = rows.select("doc_id", "name").join(several.select("doc_id"), "doc_id").distinct()
    numbered = shared.join(classes.select("id", "name"), "name").select("doc_id", "id")
    least = combined(numbered, "doc_id", F.min("id").alias("a"))
    return numbered.join(least, "doc_id").where("a < id").select("a", F.col("id").alias("b"))


def _open_seats(placed: DataFrame) -> DataFrame:
    """The seats of buckets that hold several components, with ``main``, the bucket's largest one, and the numbers of members in
    it and beside it."""
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    of_bucket = combined(sizes, "bucket", F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("most"))
    of_bucket = of_bucket.where(F.col("all") > F.col("most.n")).select(
        "bucket", F.col("most.component").alias("main"), F.col("most.n").alias("n_main"), (F.col("all") - F.col("most.n")).alias("n_rest")
    )
    return placed.join(of_bucket, "bucket")


def _open_members(open_: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Open seats with sketches and full sets, for each pair of blocks that theirs is part of.

    The rest has the first blocks, the largest component those behind; of each pair one is of the rest.
    """
    # Blocks hold fewer members where full sets are large. Sketches and sets join last, so they are moved once by bucket.
    slim = open_.join(sets.select("id", F.octet_length("members").alias("bytes")), "id")
    rest = F.col("component") != F.col("main")
    sized = combined(
        slim, "bucket", F.sum(F.when(rest, F.col("bytes"))).alias("b_rest"), F.sum(F.when(~rest, F.col("bytes"))).alias("b_main")
    )

    def blocks(name):
        size = F.coalesce(F.col(f"b_{name}"), F.lit(0))
        return F.greatest(F.ceil(F.col(f"n_{name}") / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")

    slim = slim.join(sized, "bucket").withColumn("q", blocks("rest")).withColumn("p", blocks("main"))
    draw = F.xxhash64(F.lit(-1), "id")
    own = F.when(rest, F.pmod(draw, F.col("q"))).otherwise(F.col("q") + F.pmod(draw, F.col("p"))).cast("int")
    others = F.sequence(F.lit(0), F.when(rest, F.col("q") + F.col("p") - 1).otherwise(F.col("q") - 1))
    dealt = slim.withColumn("own", own).withColumn("other", F.explode(others)).select(
        "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "own", "band", "component",
    )
    return dealt.join(classes.select("id", "n_shingles", "registers"), "id").join(sets, "id")


def _sets_of(ids: DataFrame, classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``(id, members)``: the full set of each class, from the rows of its least document id."""
    wanted = stage(classes.select("id", "name", "least").join(ids, "id"), "wanted")
    few = wanted.count() <= SMALL_IDS  # otherwise both sides are shuffled by id
    least = wanted.select(F.col("least").alias("_least")).distinct()
    chosen = texts.join(F.broadcast(least) if few else least, F.col("doc_id") == F.col("_least"), "left_semi")

    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for lo, hi in slices(bounds):
                part = data[bounds[lo] : bounds[hi]]
                sets = [s.tobytes() for s in shingle_sets(part, bounds[lo : hi + 1] - bounds[lo], width)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(_name, sets), pa.binary()), pa.array(sets, pa.binary())], ["name", "members"]
                )

    # Rows of one id may be many and may differ: the name tells which of them is the class.
    sets = chosen.mapInArrow(lean(run), "name binary, members binary").groupBy("name").agg(F.first("members").alias("members"))
    return sets.join(wanted.select("id", "name"), "name").select("id", "members")
