"""Removal of repeated byte strings, by suffix arrays over shards of the corpus.

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes; strings
are judged on the input, so all places of a repeated string go. Steps:

1. **Shards by content.** Each window of ``length`` bytes belongs to the least hash among its
   ``ANCHOR``-byte substrings, its anchor: equal windows share their anchor wherever they stand. A run of
   windows with one anchor is a segment. Anchors are counted over the corpus; a segment whose anchor
   stands at one place only holds no repeated window.
2. **Hot anchors.** An anchor with more than ``HOT`` segments, or one beyond ``LONG`` bytes, is cut again,
   one window to a segment and that window's hash as its anchor, so no shard grows with a common
   passage or a text that repeats itself.
3. **Distinct segments.** Segments with equal bytes are one with a count; only one place of each is
   read again, and none of those that are alone with their anchor.
4. **Suffix arrays.** Each task strings its anchors' distinct segments together, some megabytes at a time, and
   sorts all suffixes by induced sorting: suffixes are classified as larger or smaller than the next;
   the leftmost-smaller substrings are sorted and named; where names repeat, the string of names is sorted in turn,
   by recursion if it has many places to a name, else by doubling the names it compares; from their
   order two linear passes induce the whole array. Permuted common prefixes follow from the irreducible ones.
   Neighbours that share ``length`` bytes are one repeated string, and its count is the sum of
   the segments' counts.
5. The repeated windows of each segment go back to all its places; their union is cut out.

Only step 5 and the reading of distinct segments move texts, once each. Anchors, segments and
windows are compared by 64-bit hashes to be brought together; whether windows are equal is decided
by the suffix array, byte by byte, except for segments of one hash, length and anchor, which count
as equal.

Edge cases: a null text is empty; a text shorter than ``length`` stays whole; equal rows repeat each
other, however many they are; rows that share an id but not their text are separate documents; ids may be null; an empty
table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import SMALL_IDS, SpanHashes, lean, mix, slices, stage, text_bytes

LENGTH = 200
ANCHOR = 32  # bytes of an anchor
HOT = 20_000  # segments of one anchor that one shard may hold, about 6 MB
LONG = 1 << 20  # bytes of one segment, as in a text that repeats a short pattern all along
SHARD_BYTES = 2 << 20  # text of one suffix array
SLICE_BYTES = 1 << 18  # text whose anchors are found at a time: the arrays over it fit a core's cache
BY_BUCKET = 64  # places to a name from which names are sorted by recursion, bucket by bucket


# --- suffix arrays -----------------------------------------------------------------------------


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one, a lone least letter, is."""
    n = len(s)
    differs = np.flatnonzero(s[:-1] != s[1:])
    # Within a run of one letter all suffixes are like the run's last one.
    run_end = np.repeat(differs, np.diff(differs, prepend=-1))
    out = np.ones(n, bool)
    out[:-1] = s[run_end] < s[run_end + 1]
    return out


def _induced(s, smaller, lms, size):
    """Whole suffix array from sorted ``lms`` suffixes, one bucket of equal first letters at a time."""
    n = len(s)
    counts = np.bincount(s, minlength=size)
    tail = np.cumsum(counts)
    head = tail - counts
    out = np.full(n, -1, np.int64)
    letters = s[lms]
    held = np.bincount(letters, minlength=size)
    order = np.argsort(letters, kind="stable")
    first = np.cumsum(held) - held
    out[tail[letters[order]] - held[letters[order]] + np.arange(len(lms)) - first[letters[order]]] = lms[order]

    def put(places, at, forward):
        """The suffixes before ``places`` that belong to this pass, appended to their buckets."""
        places = places[places > 0] - 1
        places = places[smaller[places] != forward]
        if not len(places):
            return
        letters = s[places]
        order = np.argsort(letters, kind="stable")
        sorted_letters = letters[order]
        new = np.flatnonzero(np.concatenate(([True], sorted_letters[1:] != sorted_letters[:-1])))
        sizes = np.diff(np.concatenate((new, [len(places)])))
        rank = np.arange(len(places)) - np.repeat(new, sizes)
        if forward:
            out[at[sorted_letters] + rank] = places[order]
            at[sorted_letters[new]] += sizes
        else:
            out[at[sorted_letters] - 1 - rank] = places[order]
            at[sorted_letters[new]] -= sizes

    at = head.copy()
    for c in np.flatnonzero(counts).tolist():
        done = head[c]
        while done < at[c]:
            end = at[c]
            put(out[done:end], at, True)
            done = end
        if held[c]:
            put(out[tail[c] - held[c] : tail[c]], at, True)
    larger_end = at
    at = tail.copy()
    for c in np.flatnonzero(counts).tolist()[::-1]:
        done = tail[c]
        while done > at[c]:
            end = at[c]
            put(out[end:done][::-1], at, False)
            done = end
        put(out[head[c] : larger_end[c]][::-1], at, False)
    return out


def _by_doubling(s, size):
    """Suffix array of a string of many letters, ranked by 1, 2, 4, ... times as many first letters as fit a word.

    Only suffixes that are tied so far are sorted again. The lone last 0 unties them before they end.
    """
    n = len(s)
    bits = int(size).bit_length()
    step = min(n, 62 // bits)
    padded = np.concatenate((s, np.zeros(step, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(step):
        key = key << bits | padded[k : k + n]
    order = np.argsort(key)
    key, places, live = key[order], order, np.arange(n)
    rank = np.empty(n, np.int64)
    while True:
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(new, append=len(key))
        rank[places] = np.repeat(live[new], sizes)
        tied = np.repeat(sizes > 1, sizes)
        live, places = live[tied], places[tied]
        if not len(live):
            return order
        key = rank[places] * n + rank[places + step]
        by = np.argsort(key)
        key, places = key[by], places[by]
        order[live] = places
        step *= 2


def suffix_array(s: np.ndarray, size: int) -> np.ndarray:
    """Suffixes of ``s`` in order; its letters are below ``size``, the last one is 0 and the only 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = _smaller(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    # Any order of the leftmost-smaller suffixes that respects first letters sorts their substrings.
    rough = _induced(s, smaller, lms, size)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    rough = rough[is_lms[rough]]
    names = _named(s, lms, rough)
    if names[-1] + 1 < len(lms):
        in_order = np.empty(n, np.int64)
        in_order[rough] = names
        # The last letter's own substring is the least and stands once: the recursion's last letter.
        n_names = int(names[-1]) + 1
        sort = suffix_array if len(lms) >= BY_BUCKET * n_names else _by_doubling
        lms_sorted = lms[sort(in_order[lms], n_names)]
    else:
        lms_sorted = rough
    return _induced(s, smaller, lms_sorted, size)


def _named(s, lms, rough):
    """Number of each substring between leftmost-smaller places, in sorted order; equal ones share it."""
    end_of = np.empty(len(s), np.int64)
    end_of[lms] = np.concatenate((lms[1:], [len(s) - 1]))
    a, b = rough[:-1], rough[1:]
    lengths = end_of[a] - a
    equal = lengths == end_of[b] - b
    live = np.flatnonzero(equal)
    step = 0
    while len(live):
        same = s[a[live] + step] == s[b[live] + step]
        equal[live[~same]] = False
        live = live[same & (step < lengths[live])]
        step += 1
    return np.concatenate(([0], np.cumsum(~equal)))


def common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Letters each suffix, in text order, shares with the one before it in sorted order.

    Where the letter before a suffix equals the letter before its neighbour, the value is one less
    than the value at the place before; only at the other, irreducible places are letters compared.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    own = np.flatnonzero(before >= 0)
    other = before[own]
    irreducible = (own == 0) | (other == 0) | (s[own - 1] != s[other - 1])
    out = np.zeros(n, np.int64)
    at, to = own[irreducible], other[irreducible]
    # Four 16-bit letters to a word; beyond the end nothing equals anything.
    padded = np.concatenate((s.astype(np.uint64) + np.uint64(1), np.zeros(4, np.uint64)))
    words = padded[:n].copy()
    for k in range(1, 4):
        words |= padded[k : k + n] << np.uint64(16 * k)
    live, shared = np.arange(len(at)), np.zeros(len(at), np.int64)
    while len(live):
        x, y = at[live] + shared[live], to[live] + shared[live]
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        odd = words[x] ^ words[y]
        gain = np.where(odd == 0, 4, 0)
        for k in range(1, 4):
            gain[(odd != 0) & (odd & np.uint64((1 << 16 * k) - 1) == 0)] = k
        shared[live] += gain
        live = live[odd == 0]
    out[at] = shared
    # Between irreducible places values fall by one from place to place.
    base = np.full(n, -1, np.int64)
    base[at] = at
    base[order[0]] = order[0]
    base = np.maximum.accumulate(base)
    return np.where(base >= 0, out[base] - (np.arange(n) - base), 0)


def repeated_windows(segments: list[bytes], counts: list[int], length: int) -> list[list[int]]:
    """For each segment the runs ``[first, last + 1, ...]`` of windows that occur twice or more.

    A segment stands for as many places as its count says.
    """
    data = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.int64) + 2
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    data[first[1:] - 1] = 1  # between segments
    s = np.concatenate((data, [0]))
    order = suffix_array(s, 258)
    shared = common_prefixes(s, order)[order]
    segment = np.repeat(np.arange(len(segments)), sizes + 1)
    window = np.zeros(len(s), bool)
    window[:-1] = np.arange(len(data)) + length <= (first[1:] - 1)[segment]
    # Neighbours with a long enough common prefix are one group of equal windows; a suffix that is
    # no window ends too soon to share so much with any window.
    group = np.cumsum(shared < length) - 1
    weight = np.zeros(len(s), np.int64)
    weight[:-1] = np.array(counts, np.int64)[segment]
    inside = window[order]
    total = np.bincount(group[inside], weights=weight[order[inside]], minlength=int(group[-1]) + 1)
    hit = np.zeros(len(s) + 1, bool)
    hit[order[inside]] = total[group[inside]] > 1
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit)).astype(np.int8)))
    owner = segment[edges[::2]] if len(edges) else np.zeros(0, np.int64)
    out: list[list[int]] = [[] for _ in segments]
    for k, a, b in zip(owner.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
        out[k] += [a - int(first[k]), b - int(first[k])]
    return out


# --- segments ----------------------------------------------------------------------------------


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, hashed: SpanHashes | None = None):
    """Segments ``(text number, start, end, anchor, places)`` that cover every window of every text.

    ``places`` is 2 where the segment's windows take their anchor from several places: only such a
    segment can hold one window twice.
    """
    n, span = len(data), min(ANCHOR, length)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    starts = np.arange(n - span + 1)
    hashes = (hashed or SpanHashes(data)).windows(span)
    # Least hash over each window by doubling; low bits hold the place, so the leftmost one wins. As many bits of the
    # hash are compared whatever the batch's length is: equal windows of different batches choose alike.
    bits = np.uint64(32)
    least = hashes >> bits
    least <<= bits
    least |= starts.view(np.uint64)
    reach, wanted = 1, length - span + 1
    while reach < wanted:
        step = min(reach, wanted - reach)
        # Each value is taken before the one it is compared with changes.
        least = np.minimum(least[: len(least) - step], least[step:], out=least[: len(least) - step])
        reach += step
    place = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    value = hashes[place]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(value)]
    valid = starts[: len(value)] + length <= bounds[1:][text]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new & valid)
    edge = np.flatnonzero(new | ~valid)
    last = np.concatenate((edge, [len(value)]))[np.searchsorted(edge, heads, "right")] - 1
    return text[heads], heads, last + length, value[heads], 1 + (place[heads] != place[last])


_SEGMENT = "key_a long, key_b long, start int, len int, anchor long, name long, places int"
_KEYS = ["key_a", "key_b"]


def _texts(df: DataFrame, id_col: str, text_col: str, others: tuple[str, ...] = ()) -> DataFrame:
    """Id, text and the key that stands for both: rows equal in id and text share it, others do not.

    The key has 128 bits, two hashes of id and text from different seeds.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key_a, key_b = (F.xxhash64(F.lit(seed), F.isnull(id_col), F.col(id_col), text) for seed in (1, 2))
    return df.select(
        key_a.alias("key_a"), key_b.alias("key_b"), F.col(id_col).alias("doc_id"),
        text.alias("text"), *others,
    )


def _segments(texts: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            for lo, hi in slices(bounds, SLICE_BYTES):
                part, edge = data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
                hashed = SpanHashes(part)
                text, start, end, anchor, places = anchors(part, edge, length, hashed)
                name = mix(hashed.of(start, end) ^ anchor)
                keys = pa.array(text + lo, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(keys), batch.column(1).take(keys),
                     pa.array((start - edge[text]).astype(np.int32)), pa.array((end - start).astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(name.view(np.int64)), pa.array(places.astype(np.int32))],
                    [*_KEYS, "start", "len", "anchor", "name", "places"],
                )

    return texts.select(*_KEYS, "text").mapInArrow(lean(run), _SEGMENT)


def _single_windows(hot: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Each window of the hot segments as a segment of its own, under its own hash."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                hashed = SpanHashes(text_bytes(batch.column(2).slice(row, 1))[0])
                for piece in batch.column(3)[row].as_py():
                    last = piece["start"] + piece["len"] - length + 1
                    for first in range(piece["start"], last, 1 << 16):
                        starts = np.arange(first, min(last, first + (1 << 16)))
                        name = hashed.of(starts, starts + length).view(np.int64)
                        keys = pa.array(np.full(len(starts), row), pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(keys), batch.column(1).take(keys), pa.array(starts.astype(np.int32)),
                             pa.array(np.full(len(starts), length, np.int32)), pa.array(name), pa.array(name)],
                            [*_KEYS, "start", "len", "anchor", "name"],
                        )

    return _at_texts(hot, texts, F.struct("start", "len")).mapInArrow(lean(run), _SEGMENT.removesuffix(", places int"))


def _at_texts(pieces: DataFrame, texts: DataFrame, what) -> DataFrame:
    """Texts beside the list of ``what`` of their pieces; a text has a bounded number of them.

    Every join with the texts has this one form, so Spark shuffles them once for all.
    """
    listed = pieces.groupBy(*_KEYS).agg(F.collect_list(what).alias("pieces"))
    return texts.join(listed, _KEYS).select(*_KEYS, "text", "pieces")


def _shards(bodies: DataFrame, length: int) -> DataFrame:
    """Repeated windows of each distinct segment, by suffix arrays over some megabytes of anchors."""

    def run(batches):
        names, counts, bodies, size, last = [], [], [], 0, None

        def solve():
            found = repeated_windows(bodies, counts, length)
            hits = [k for k, runs in enumerate(found) if runs]
            return pa.RecordBatch.from_arrays(
                [pa.array([names[k][0] for k in hits], pa.int64()), pa.array([names[k][1] for k in hits], pa.int64()),
                 pa.array([found[k] for k in hits], pa.list_(pa.int32()))],
                ["anchor", "name", "runs"],
            )

        for batch in batches:
            for anchor, name, count, body in zip(*(c.to_pylist() for c in batch.columns)):
                if size > SHARD_BYTES and anchor != last:
                    yield solve()
                    names, counts, bodies, size = [], [], [], 0
                names.append((anchor, name))
                counts.append(count)
                bodies.append(body)
                size += len(body)
                last = anchor
        if bodies:
            yield solve()

    dealt = bodies.repartition("anchor").sortWithinPartitions("anchor", "name")
    return dealt.select("anchor", "name", "n", "body").mapInArrow(lean(run), "anchor long, name long, runs array<int>")


def _bodies(first: DataFrame, texts: DataFrame) -> DataFrame:
    """The bytes of distinct segments, read at one place of each."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                data, _ = text_bytes(batch.column(2).slice(row, 1))
                pieces = batch.column(3)[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["anchor"] for p in pieces], pa.int64()), pa.array([p["name"] for p in pieces], pa.int64()),
                     pa.array([p["n"] for p in pieces], pa.int64()),
                     pa.array([data[p["start"] : p["start"] + p["len"]].tobytes() for p in pieces], pa.binary())],
                    ["anchor", "name", "n", "body"],
                )

    at = _at_texts(first, texts, F.struct("anchor", "name", "n", "start", "len"))
    return at.mapInArrow(lean(run), "anchor long, name long, n long, body binary")


def _repeated_keys(texts: DataFrame) -> DataFrame:
    """Keys of rows that are equal in id and text."""
    return stage(texts.select(*_KEYS).groupBy(*_KEYS).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")


def _whole_rows(rows: DataFrame, length: int, as_text: bool) -> DataFrame:
    """What is left of rows that have an equal row: all their strings of ``length`` bytes stand elsewhere too."""
    size = F.octet_length("text").cast("long")
    gone = size >= length
    span = F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("end")))
    kept = F.when(gone, F.lit("")).otherwise(F.col("text"))
    columns = [c for c in rows.columns if c not in (*_KEYS, "text")]
    return rows.select(
        *columns, size.alias("n_bytes"), (kept if as_text else kept.cast("binary")).alias("kept"),
        F.when(gone, span).otherwise(F.slice(span, 1, 0)).alias("spans"),
    )


def remove_repeats(
    df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
    carry: tuple[str, ...] = (), as_text: bool = False,
) -> DataFrame:
    """Per row: bytes before, bytes left (``kept``) and the removed ``spans`` as ``(start, end)``.

    ``carry`` names columns to hand on. ``as_text`` gives ``kept`` as a string: characters of which
    only some bytes are left go as well.

    Rows equal in id and text share a key. They are told by a count of keys, without their texts; one
    row of each such key, combined before the shuffle, is judged against all other texts, and the verdict on
    the equal rows themselves needs no search. So every key stands once in what is joined.
    """
    texts = _texts(df, id_col, text_col)
    output = texts
    if carry:
        others = F.struct(*(F.col(c) for c in carry)).alias("carried")
        output = _texts(df.withColumn("carried", others), id_col, text_col, ("carried",))
    repeated = _repeated_keys(texts)
    n = repeated.count()
    if n:
        keys = F.broadcast(repeated) if n <= SMALL_IDS // 2 else repeated
        equal = output.join(keys, _KEYS, "left_semi")
        once = equal.groupBy(*_KEYS).agg(F.first("text").alias("text"))
        output = output.join(keys, _KEYS, "left_anti")
        texts = output.select(*_KEYS, "text").unionByName(stage(once, "once"))
    done = _cut(texts, output, length, as_text)
    if n:
        done = done.unionByName(_whole_rows(equal, length, as_text))
    return done.select(
        F.col("doc_id").alias(id_col), "n_bytes", "kept", "spans", *(F.col("carried")[c].alias(c) for c in carry)
    )


def _cut(texts: DataFrame, output: DataFrame, length: int, as_text: bool) -> DataFrame:
    """The rows of ``output`` without what repeats among ``texts``; both have each key once."""
    parts = _segments(texts, length)
    seen = parts.groupBy(F.col("anchor").alias("a")).agg(
        F.count("*").alias("count"), F.sum("places").alias("p"), F.min("name").alias("u"), F.max("name").alias("v"),
        F.max("len").alias("longest"),
    ).where("p > 1")
    # The only segment of its anchor, whose windows all differ, has no order to be found: each of
    # its windows stands in as many places as it does.
    recut = ((F.col("count") > HOT) | (F.col("longest") > LONG)).alias("recut")
    seen = seen.select("a", recut, ((F.col("u") == F.col("v")) & (F.col("p") == F.col("count"))).alias("alone"))
    found = stage(parts.join(seen, F.col("anchor") == F.col("a")).drop("a", "places"), "segments")
    whole = found.where("alone").select(*_KEYS, "start", F.array(F.lit(0), F.col("len") - (length - 1)).alias("runs"))
    usual = found.where("NOT alone AND NOT recut").drop("alone", "recut")
    hot = found.where("NOT alone AND recut")
    if hot.limit(1).count():
        usual = stage(usual.unionByName(_single_windows(hot, texts, length)), "recut")
    distinct = usual.groupBy("anchor", "name", "len").agg(
        F.count("*").alias("n"), F.min(F.struct(*_KEYS, "start")).alias("at")
    )
    bodies = _bodies(distinct.select("anchor", "name", "len", "n", "at.*"), texts)
    runs = _shards(bodies, length).select(F.col("anchor").alias("a"), F.col("name").alias("b"), "runs")
    hits = usual.join(runs, (F.col("anchor") == F.col("a")) & (F.col("name") == F.col("b")))
    listed = whole.unionByName(hits.select(*_KEYS, "start", "runs")).groupBy(*_KEYS).agg(
        F.collect_list(F.struct("start", "runs")).alias("pieces")
    )
    cut = output.join(listed, _KEYS, "left").drop(*_KEYS)
    columns = [c for c in cut.columns if c not in ("text", "pieces")]

    def run(batches):
        for batch in batches:
            out = ([], [], [])
            for row in range(batch.num_rows):
                data, _ = text_bytes(batch.column(0).slice(row, 1))
                pieces = batch.column(1)[row].values
                gone = np.zeros(len(data) + 1, np.int32)
                if pieces is not None and len(pieces):
                    # Each piece's runs, as places in the text.
                    runs = pieces.field("runs")
                    counts = np.diff(np.asarray(runs.offsets))
                    edges = np.asarray(runs.flatten()) + np.repeat(np.asarray(pieces.field("start")), counts)
                    gone += np.bincount(edges[::2], minlength=len(gone)).astype(np.int32)
                    gone -= np.bincount(edges[1::2] - 1 + length, minlength=len(gone)).astype(np.int32)
                covered = np.cumsum(gone[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
                kept = data[~covered].tobytes()
                out[0].append(len(data))
                out[1].append(kept.decode("utf-8", "ignore") if as_text else kept)
                out[2].append([{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(out[0], pa.int64()), pa.array(out[1], pa.string() if as_text else pa.binary()),
                 pa.array(out[2], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                [*columns, "n_bytes", "kept", "spans"],
            )

    kinds = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in columns)
    return cut.select("text", "pieces", *columns).mapInArrow(
        lean(run), f"{kinds}, n_bytes long, kept {'string' if as_text else 'binary'}, spans array<struct<start:long,end:long>>"
    )


def digest(cut: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and a checksum of the result of ``remove_repeats``."""
    return cut.select(
        id_col, "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
