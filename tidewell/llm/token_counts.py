"""Token counts at every prefix, by dynamic programming over the last token.

A merge vocabulary has one encoding for every text, and the encoding of a prefix that ends at a
token border is that border's part of the whole. So every prefix has one last token: the piece that
ends there and stands beside the last token of the rest as a stable pair, that is, a pair that
merging its joined text gives back. ``count[i] = count[i - len(last)] + 1``. The counts answer how
many tokens any prefix has, and how much text fits a budget, without encoding anything again.

Chunks that no piece can cross (see ``pieces``) are solved once and remembered; a chunk's counts
add to what stands before it. Memory is bounded by the largest text and the two memories.

Edge cases: a null or empty text has no tokens; a very long chunk (one letter a million times) takes
time in proportion to its length; equal rows give equal rows; ids may be null; an empty table gives
an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import with_text
from tidewell.llm.pieces import SPACE_MARK, Memory, model_path, pieces

CHUNKS = 400_000  # remembered chunks in each generation
PAIRS = 400_000  # remembered pairs
SHORT = 64  # longer chunks are not remembered


def merge(text: str, score: dict[str, float]) -> list[str]:
    """Merges neighbours, best score first and leftmost among equals, until nothing merges."""
    part = list(text)
    right = list(range(1, len(part))) + [-1]
    left = list(range(-1, len(part) - 1))
    queue = [(-score[a + b], i, a + b) for i, (a, b) in enumerate(zip(part, part[1:])) if a + b in score]
    heapify(queue)
    while queue:
        _, i, joined = heappop(queue)
        j = right[i]
        if not part[i] or j < 0 or part[i] + part[j] != joined:
            continue
        part[i], part[j] = joined, ""
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b >= 0 and part[a] + part[b] in score:
                heappush(queue, (-score[part[a] + part[b]], a, part[a] + part[b]))
    return [p for p in part if p]


class _Stable(Memory):
    """Whether two tokens stay two when their joined text is merged."""

    def __init__(self, score):
        super().__init__(PAIRS)
        self.score = score

    def solve(self, pair):
        return merge(pair[0] + pair[1], self.score) == [*pair]


class PrefixCounter(Memory):
    """Counts at each prefix of a chunk, remembered by chunk."""

    def __init__(self, vocabulary):
        super().__init__(CHUNKS)
        self.pieces = vocabulary
        self.stable = _Stable(vocabulary.score)
        # Every end of a token, and whether it is a token itself. Pieces that merging their own
        # letters does not give back are never tokens.
        self.ends: dict[str, bool] = {}
        for piece in vocabulary.id:
            if len(piece) == 1 or merge(piece, vocabulary.score) == [piece]:
                self.ends[piece] = True
                for k in range(1, len(piece)):
                    self.ends.setdefault(piece[k:], False)
        for letter in {c for piece in vocabulary.id for c in piece} - set(vocabulary.id):
            self.ends[letter] = True
        self.bytes_of = lambda c: 1 if c in vocabulary.id else len(c.encode("utf-8", "surrogatepass"))

    def __missing__(self, chunk):
        return super().__missing__(chunk) if len(chunk) <= SHORT else self.solve(chunk)

    def solve(self, chunk: str) -> bytes:
        """32-bit counts of the prefixes of 1, 2, ... characters."""
        ends, stable = self.ends.get, self.stable
        counts, last = [self.bytes_of(chunk[0])], [chunk[0]]
        for i in range(2, len(chunk) + 1):
            j = i - 1
            token = chunk[j:i]
            found = None
            fits = ends(token, True)
            while fits is not None:
                if fits:
                    if not j:
                        found = token, 1
                        break
                    if stable[last[j - 1], token]:
                        found = token, counts[j - 1] + (1 if i - j > 1 else self.bytes_of(token))
                        break
                j -= 1
                if j < 0:
                    break
                token = chunk[j:i]
                fits = ends(token)
            last.append(found[0])
            counts.append(found[1])
        return array("i", counts).tobytes()

    def counts(self, text: str) -> np.ndarray:
        """Tokens of every prefix of ``text``; entry ``i`` counts the first ``i + 1`` characters."""
        if not text:
            return np.zeros(0, np.int32)
        # The library puts one blank before the text; the mark itself counts as a blank.
        text = SPACE_MARK + text.replace(" ", SPACE_MARK)
        cuts = self.pieces.cuts(text)
        edges = cuts.tolist()
        chunks = [text[a:b] for a, b in zip(edges, edges[1:])]
        inner = np.frombuffer(b"".join(map(self.__getitem__, chunks)), np.int32)
        totals = inner[cuts[1:] - 1]
        before = np.zeros(len(totals), np.int64)
        np.cumsum(totals[:-1], out=before[1:])
        return (inner + np.repeat(before, np.diff(cuts))).astype(np.int32)[1:]


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter for each Python process, so its memories serve every task."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(pieces(path))
    return _COUNTERS[path]


def _texts(batches, path):
    """Ids, texts and their prefix counts, one row at a time."""
    count = counter(path).counts
    for batch in batches:
        ids = batch.column(0)
        for i, text in enumerate(batch.column(1)):
            text = text.as_py() or ""
            yield ids[i], text, count(text)


def prefix_counts(df: DataFrame, path: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Each text's ``prefix_tokens``: the token count of its first 1, 2, ... characters."""
    path = path or model_path()
    rows = with_text(df, id_col, text_col)
    schema = pa.schema([("doc_id", _id_type(rows)), ("prefix_tokens", pa.list_(pa.int32()))])

    def run(batches):
        for key, _, counts in _texts(batches, path):
            yield pa.RecordBatch.from_arrays(
                [pa.array([key.as_py()], schema.field(0).type), pa.array([counts], schema.field(1).type)],
                schema=schema,
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, prefix_tokens array<int>").withColumnRenamed("doc_id", id_col)


def _id_type(df):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["doc_id"].dataType)


def token_budget(df: DataFrame, budget: int, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Each text's tokens, and its longest prefix, in characters, of at most ``budget`` tokens.

    Both are read off the prefix counts. The count may fall where a longer prefix merges better, so
    the longest fitting prefix is the last entry within the budget, not the first one beyond it.
    """
    path = path or model_path()
    rows = with_text(df, id_col, text_col)
    id_type = _id_type(rows)
    names = ["doc_id", "n_bytes", "n_tokens", "fit_chars"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            out = ([], [], [])
            count = counter(path).counts
            for text in batch.column(1):
                text = text.as_py() or ""
                counts = count(text)
                fits = np.flatnonzero(counts <= budget)
                out[0].append(len(text.encode("utf-8", "surrogatepass")))
                out[1].append(int(counts[-1]) if len(counts) else 0)
                out[2].append(int(fits[-1]) + 1 if len(fits) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), *(pa.array(x, pa.int64()) for x in out)], names
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, fit_chars long")
    return counted.withColumn("over_limit", F.col("n_tokens") > budget).withColumnRenamed("doc_id", id_col)
