"""Benchmark decontamination by templates, so that re-parameterised questions are found too.

Numbers, names and units become typed placeholders: ``3.5`` is a number, a known unit right behind a
number is a unit, a capitalised word is a name. Other words are lower-cased; in both, capitals are those of ASCII and of
the alphabets that UTF-8 writes in two bytes (Latin, Greek, Cyrillic, Armenian). Texts and items are read
four ways: no placeholders; numbers and units; names inside a sentence as well; and names at a
sentence's start as well. So a copy in another case is found, one with sparse literal words, and one whose
sentences begin with an exchanged name. A window belongs to the first reading that gives its tokens.

Windows of ``WINDOW`` tokens are joined with the benchmark's by their hash. On one diagonal, that is, one
offset between text and item, matching windows line up. Diagonals at most ``SHIFT`` apart are chained,
as when a copy has a word more or a longer name; a chain goes forward in text and item. Slots must be
consistent: every value of the item stands for one value of the text and the other way round, as
when a question was copied with other numbers, and not when unlike texts happen to share a
template. A text is contaminated by an item when one of these holds:

* the slots of a diagonal or chain are at least half consistent, and its literal words and consistent
  slots cover at least ``COVERAGE`` per cent of the item;
* a stretch of it without a contradiction covers as much and has ``RUN`` literal words;
* ``RUN`` tokens in a row are the item's own, however long the item is.

The benchmark's window hashes are sent to the tasks when there are at most ``FEW`` of them, 32 MB, so
that only matching windows are shuffled; otherwise all windows are shuffled to the join. Matches are
judged in overlapping stretches of the text, each bounded by the item's length, so no long text is
gathered. Items of equal template whose slots are equal in the same places are one, under the least id. An
item with fewer tokens is one window of its own width. With placeholders, windows with less than half
literal words match nothing, as they say nothing.

Edge cases: null or empty texts and items match nothing; rows equal in id and text are reported
once, rows that share an id but not their text are judged apart; so are rows without an id, which are
reported with a null id; empty tables give an empty result; very long texts
are read in one piece each; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import LOWER, lean, mix, row_key, slices, span_hashes, text_bytes

WINDOW = 8
COVERAGE = 50  # per cent of an item's tokens
RUN = 13  # tokens of an item that are a hit by themselves
SHIFT = 4  # tokens put in or left out between two chained diagonals
FEW = 4_000_000

# Units of measure that may follow a number.
UNITS = (
    "kg g mg t lb lbs oz km m cm mm mi ft in l ml cl h hr hrs hour hours min mins minute minutes s sec secs second "
    "seconds day days week weeks month months year years percent dollar dollars euro euros cent cents pound pounds "
    "mile miles meter meters metre metres foot feet inch inches yard yards liter liters litre litres gram grams "
    "kilogram kilograms degree degrees watt watts volt volts kb mb gb tb hz khz mhz ghz mph kmh"
).split()

NUMBER, NAME, UNIT = (np.uint64(k) for k in (0x6E756D, 0x6E616D, 0x756E69))

# Lower-case form of the characters that UTF-8 writes in two bytes: Latin, Greek, Cyrillic, Armenian.
_LOWER_OF = np.arange(0x800)
for _c in range(0x80, 0x800):
    if len(chr(_c).lower()) == 1 and 0x80 <= ord(chr(_c).lower()) < 0x800:
        _LOWER_OF[_c] = ord(chr(_c).lower())

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;\n\"()"]] = True


def _units() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), np.uint8)
    ends = np.cumsum([len(u) for u in UNITS])
    return np.sort(span_hashes(data, np.concatenate(([0], ends[:-1])), ends))


_UNIT_HASHES = _units()


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in lower case, as many as before, and where a capital begins."""
    low = LOWER[data]
    capital = low != data
    at = np.flatnonzero((data >= 0xC2) & (data <= 0xDF))
    at = at[at < len(data) - 1]
    code = ((data[at] & 0x1F).astype(np.int64) << 6) | (data[at + 1] & 0x3F)
    lower = _LOWER_OF[code]
    changed = lower != code
    at, lower = at[changed], lower[changed]
    low[at], low[at + 1] = 0xC0 | (lower >> 6), 0x80 | (lower & 0x3F)
    capital[at] = True
    return low, capital


def template(data: np.ndarray, bounds: np.ndarray):
    """Value, mark (0: always literal), least reading that has it as a slot, and text number of each token."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    digit, word = _DIGIT[data], _WORD[data]
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[bounds[:-1][bounds[:-1] < n]] = True
    last[bounds[1:][bounds[1:] > 0] - 1] = True
    before = np.concatenate(([False], digit[:-1])) & ~first
    after = np.concatenate((digit[1:], [False])) & ~last
    # A point or comma between digits belongs to the number.
    digit = digit | (((data == 46) | (data == 44)) & before & after)
    kind = np.where(digit, 2, np.where(word, 1, 0)).astype(np.int8)
    new = np.ones(n, bool)
    new[1:] = kind[1:] != kind[:-1]
    new |= first
    starts = np.flatnonzero(new)
    ends = np.concatenate((starts[1:], [n]))
    keep = kind[starts] > 0
    starts, ends = starts[keep], ends[keep]
    text = np.searchsorted(bounds, starts, "right") - 1
    low, capital = folded(data)
    value = span_hashes(low, starts, ends)
    number = kind[starts] == 2
    follows = np.zeros(len(starts), bool)
    follows[1:] = text[1:] == text[:-1]
    # A unit stands at most one byte behind a number.
    unit = np.zeros(len(starts), bool)
    unit[1:] = follows[1:] & number[:-1] & (starts[1:] - ends[:-1] <= 1)
    unit &= ~number & _among(value, _UNIT_HASHES)
    upper = capital[starts]
    stops = np.concatenate(([0], np.cumsum(_STOP[data])))
    inside = np.zeros(len(starts), bool)
    inside[1:] = follows[1:] & (stops[starts[1:]] == stops[ends[:-1]])
    name = upper & ~number & ~unit
    mark, reading = np.zeros(len(starts), np.uint64), np.full(len(starts), 4)
    for which, kind_of, least in ((number, NUMBER, 1), (unit, UNIT, 1), (name & inside, NAME, 2), (name & ~inside, NAME, 3)):
        mark[which] = kind_of
        reading[which] = least
    return value, mark, reading, text


READINGS = range(4)  # no slots; numbers and units; names inside a sentence; all names


def windows(value, mark, reading, text, width: int):
    """Hash and place of each window that says something, in all readings."""
    n = len(value) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, places, before = [], [], np.full(n, -1)
    within = text[:n] == text[width - 1 :]
    for k in READINGS:
        slot = reading <= k
        slots = np.concatenate(([0], np.cumsum(slot)))
        slots = slots[width:] - slots[:n]
        # Readings grow, so a window with as many slots as in the reading before is the same window.
        at = np.flatnonzero(within & (slots > before) & ((2 * slots <= width) | (slots == 0)))
        before = slots
        if not len(at):
            continue
        token = np.where(slot, mark, value)
        out = np.full(len(at), width, np.uint64)
        for j in range(width):
            out = mix(out * np.uint64(0x2545F4914F6CDD1D) + token[at + j])
        hashes.append(out)
        places.append(at)
    if not places:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def _item_rows(benchmark: DataFrame) -> DataFrame:
    """Per class of items: its tokens, their number, and the windows of all its members.

    A window's ``slots`` are 0 at words that are literal, the slot's number (equal values, equal number) at
    slots, and less than 0 at names at a sentence's start, whose value is the same in all members;
    ``own`` has these values. ``exact`` says that equal windows have equal words.
    """

    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            value, mark, reading, text = template(data, bounds)
            first = np.searchsorted(text, np.arange(batch.num_rows + 1))
            keep, out = [], ([], [], [], [])
            for i in range(batch.num_rows):
                lo, hi = first[i], first[i + 1]
                width = min(WINDOW, int(hi - lo))
                if not width:
                    continue
                v, m, r = value[lo:hi], mark[lo:hi], reading[lo:hi]
                numbers: dict[int, int] = {}
                slot = np.array([numbers.setdefault(x, len(numbers) + 1) if k <= READINGS[-1] else 0
                                 for x, k in zip(v.tolist(), r.tolist())])
                slot[r == 3] *= -1
                token = np.where(r <= 2, m, v)
                own = np.where(r <= 2, np.uint64(0), v).view(np.int64)
                found, at = windows(v, m, r, text[lo:hi], width)
                plain = np.full(len(v) - width + 1, width, np.uint64)
                for j in range(width):
                    plain = mix(plain * np.uint64(0x2545F4914F6CDD1D) + v[j : j + len(plain)])
                keep.append(i)
                out[0].append(token.tobytes() + slot.tobytes())
                out[1].append(int(hi - lo))
                out[2].append(width)
                out[3].append([
                    {"hash": h, "pos": p, "slots": slot[p : p + width].tolist(), "own": own[p : p + width].tolist(), "exact": e}
                    for h, p, e in zip(found.view(np.int64).tolist(), at.tolist(), (found == plain[at]).tolist())
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()),
                 pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.struct([
                     ("hash", pa.int64()), ("pos", pa.int32()), ("slots", pa.list_(pa.int64())),
                     ("own", pa.list_(pa.int64())), ("exact", pa.bool_())])))],
                ["item_id", "name", "n_tokens", "width", "windows"],
            )

    window = "struct<hash:long,pos:int,slots:array<long>,own:array<long>,exact:boolean>"
    return benchmark.mapInArrow(lean(run), f"item_id long, name binary, n_tokens int, width int, windows array<{window}>")


def _text_windows(texts: DataFrame, widths: list[int], known) -> DataFrame:
    """Windows of the texts, all of them or those whose hash is among ``known``."""

    def run(batches):
        wanted = None if known is None else known.value
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for lo, hi in slices(bounds):
                part, edge = data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
                value, mark, reading, text = template(part, edge)
                first = np.searchsorted(text, np.arange(hi - lo))
                for width in widths:
                    found, at = windows(value, mark, reading, text, width)
                    if wanted is not None:
                        hit = _among(found, wanted)
                        found, at = found[hit], at[hit]
                    if not len(at):
                        continue
                    rows = text[at]
                    values = value[at[:, None] + np.arange(width)].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows + lo)), batch.column(2).take(pa.array(rows + lo)), pa.array(found.view(np.int64)),
                         pa.array((at - first[rows]).astype(np.int32)),
                         pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * width), pa.array(values.ravel()))],
                        ["doc_id", "key", "hash", "at", "values"],
                    )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(lean(run), f"doc_id {kind}, key struct<a:long,b:long>, hash long, at int, values array<long>")


def _chains(runs, n_tokens: int):
    """Chains of runs ``(offset, first, end)`` of item places, longest first, each with trimmed runs.

    A run follows another one at most ``SHIFT`` offsets away, behind it in text and item.
    """
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    offset, first, end = runs.T
    best, by = end - first, np.full(len(runs), -1)
    starts = first.copy()
    for r in range(1, len(runs)):
        begin = np.maximum(first[r], end[:r] + np.maximum(0, offset[:r] - offset[r]))
        gain = np.where((np.abs(offset[:r] - offset[r]) <= SHIFT) & (begin < end[r]), best[:r] + end[r] - begin, -1)
        q = int(gain.argmax())
        if gain[q] > best[r]:
            best[r], by[r], starts[r] = gain[q], q, begin[q]
    used = np.zeros(len(runs), bool)
    for r in np.argsort(-best, kind="stable").tolist():
        chain, k = [], r
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append((int(offset[k]), int(starts[k]) if by[k] >= 0 else int(first[k]), int(end[k])))
            k = int(by[k])
        if len(chain) > 1:
            yield chain[::-1]


def _judged(slot, value, exact, n_tokens: int, coverage: int):
    """``(covered, verbatim, number of slots)`` of the item's places in order, or None if no hit."""
    slots = np.flatnonzero(slot)
    pairs = list(zip(slot[slots].tolist(), value[slots].tolist()))
    most, one, other = {}, {}, {}
    for pair in pairs:
        most[pair] = most.get(pair, 0) + 1
    for i, t in sorted(most, key=lambda p: -most[p]):  # by count, then as they come
        if i not in one and t not in other:
            one[i], other[t] = t, i
    agree = sum(one.get(i) == t for i, t in pairs)
    covered = len(slot) - len(pairs) + agree
    if 2 * agree >= len(pairs) and 100 * covered >= coverage * n_tokens:
        return covered, bool(exact.all()), len(one)
    if 100 * len(slot) < coverage * n_tokens:
        return None
    # The longest stretch without a contradiction.
    best, lo, one, other = (0, 0), 0, {}, {}
    for k in range(len(slot)):
        i, t = int(slot[k]), int(value[k])
        if i:
            if one.get(i, (t,))[0] != t:
                lo = max(lo, one[i][1] + 1)
            if other.get(t, (i,))[0] != i:
                lo = max(lo, other[t][1] + 1)
            one[i], other[t] = (t, k), (i, k)
        if k + 1 - lo > best[1] - best[0]:
            best = lo, k + 1
    lo, hi = best
    if 100 * (hi - lo) >= coverage * n_tokens and (slot[lo:hi] == 0).sum() >= RUN:
        return hi - lo, bool(exact[lo:hi].all()), len({*slot[lo:hi].tolist()} - {0})
    return None


def _best_hit(found, n_tokens: int, width: int, coverage: int):
    """The best judgement over the matched windows ``(at, pos, slots, own, exact, values)`` of one stretch."""
    at, pos, exact = (np.array([w[k] for w in found]) for k in ("at", "pos", "exact"))
    slots, own, values = (np.array([w[k] for w in found], np.int64) for k in ("slots", "own", "values"))
    place = (pos[:, None] + np.arange(width)).ravel()
    offset = np.repeat(at - pos, width)
    slots, own, values, exact = slots.ravel(), own.ravel(), values.ravel(), np.repeat(exact, width)
    # A word that is its own, as at a sentence's start, is a literal.
    same = (slots == 0) | ((slots < 0) & (own == values)) | exact
    slots = np.where((slots < 0) & (own == values), 0, np.abs(slots))
    order = np.lexsort((~same, place, offset))
    place, offset, slots, values, same = (x[order] for x in (place, offset, slots, values, same))
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (offset[1:] != offset[:-1])
    place, offset, slots, values, same = (x[new] for x in (place, offset, slots, values, same))
    heads = np.flatnonzero(np.concatenate(([True], (np.diff(offset) != 0) | (np.diff(place) != 1))))
    tails = np.concatenate((heads[1:], [len(place)]))
    runs = np.stack((offset[heads], place[heads], place[tails - 1] + 1), axis=1)
    hits = []
    # Tokens in a row that are the item's own.
    edges = np.ones(len(place), bool)
    edges[1:] = ~same[1:] | ~same[:-1]
    edges[heads] = True
    sizes = np.diff(np.concatenate((np.flatnonzero(edges), [len(place)])))
    longest = int(sizes.argmax())
    if sizes[longest] >= RUN:
        lo = int(np.flatnonzero(edges)[longest])
        part = slots[lo : lo + sizes[longest]]
        hits.append((int(sizes[longest]), True, len({*part.tolist()} - {0})))
    borders = np.flatnonzero(np.concatenate(([True], np.diff(offset) != 0, [True])))
    for lo, hi in zip(borders[:-1].tolist(), borders[1:].tolist()):
        if 100 * (hi - lo) >= coverage * n_tokens:
            hits.append(_judged(slots[lo:hi], values[lo:hi], same[lo:hi], n_tokens, coverage))
    if len(borders) > 2:
        where = {(int(o), int(p)): k for k, (o, p) in enumerate(zip(offset[heads], place[heads]))}
        head_of = {(int(o), int(e)): int(heads[where[int(o), int(a)]]) - int(a) for o, a, e in runs}
        for chain in _chains(runs, n_tokens):
            if 100 * sum(e - a for _, a, e in chain) >= coverage * n_tokens:
                cells = np.concatenate([np.arange(a, e) + head_of[o, e] for o, a, e in chain])
                hits.append(_judged(slots[cells], values[cells], same[cells], n_tokens, coverage))
    return max((h for h in hits if h), default=None)


def contaminated(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", coverage: int = COVERAGE,
) -> DataFrame:
    """One row for each text and item class that contaminates it: the best diagonal, chain or run."""
    from tidewell.llm.common import stage

    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    items = stage(_item_rows(items), "items")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most WINDOW
    classes = items.groupBy("name").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items"))
    window = ["hash", "pos", "slots", "own", "exact"]
    pieces = stage(
        items.select("name", "n_tokens", "width", F.explode("windows").alias("w"))
        .select("name", "n_tokens", "width", *(F.col("w")[c].alias(c) for c in window)).distinct()
        .join(classes, "name").drop("name").withColumnRenamed("hash", "h"),
        "pieces",
    )
    hashes = pieces.select("h").distinct()
    known = None
    if hashes.count() <= FEW:
        found = np.sort(hashes.toPandas()["h"].to_numpy(np.int64).view(np.uint64))
        known = df.sparkSession.sparkContext.broadcast(found)
    matched = _text_windows(texts, widths or [WINDOW], known)
    # A stretch is two strides long, so whatever is no longer than one stride lies in a stretch as a whole.
    stride = 2 * F.col("n_tokens") + 64
    block = F.floor(F.col("at") / stride)
    lined = matched.join(pieces, (F.col("hash") == F.col("h")) & (F.size("values") == F.col("width"))).select(
        "key", "doc_id", "item_id", "n_items", "n_tokens", "width",
        F.explode(F.when(block > 0, F.array(block - 1, block)).otherwise(F.array(block))).alias("block"),
        F.struct("at", "pos", "slots", "own", "exact", "values").alias("w"),
    )
    per_item = ["key", "doc_id", "item_id", "n_items", "n_tokens"]
    stretches = lined.groupBy(*per_item, "width", "block").agg(F.collect_set("w").alias("found"))

    def run(batches):
        for batch in batches:
            keep, out = [], []
            sizes, widths, found = (batch.column(k) for k in (4, 5, 6))
            for row in range(batch.num_rows):
                hit = _best_hit(found[row].as_py(), sizes[row].as_py(), widths[row].as_py(), coverage)
                if hit:
                    keep.append(row)
                    out.append({"covered": hit[0], "verbatim": hit[1], "n_slots": hit[2]})
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(pa.array(keep, pa.int64())) for k in range(5)),
                 pa.array(out, pa.struct([("covered", pa.int32()), ("verbatim", pa.bool_()), ("n_slots", pa.int32())]))],
                [*per_item, "hit"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    judged = stretches.select(*per_item, "width", "found").mapInArrow(
        lean(run), f"key struct<a:long,b:long>, doc_id {kind}, item_id long, n_items long, n_tokens int, "
        "hit struct<covered:int,verbatim:boolean,n_slots:int>",
    )
    return judged.groupBy(*per_item).agg(F.max("hit").alias("b")).select(
        F.col("doc_id").alias(id_col), F.col("item_id").alias(item_col), "n_items", "n_tokens", "b.covered", "b.n_slots",
        "b.verbatim",
    )
