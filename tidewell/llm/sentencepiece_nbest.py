"""SentencePiece encoding and decoding: the N best segmentations of a text, exactly.

Pieces and their scores come from a model file; a segmentation's score is the sum of its pieces'.
Characters without a piece become byte pieces. Forward Viterbi gives the best score of every prefix.
That score is the exact cost of the way back to the start, so A-star from the end of the lattice
pops complete segmentations in order of their score.

A text is cut into chunks that no piece can cross (see ``pieces``). Chunks are solved many at a
time, by one Viterbi over all their lattices, and remembered with their loss of the second best
path. Of a text's ``n`` best segmentations each but the best one deviates from it in some of the
``n - 1`` chunks with the least loss: those alone go through A-star, and their lists are merged.

Decoding joins pieces and bytes and takes the leading blank away: it gives back every text exactly.
The mark itself, where a text holds it, is written as bytes, so it does not come back as a blank.

Edge cases: a null or empty text has one segmentation, the empty one, of score 0; ties are broken by
the place nearest the start, then the order in which A-star meets them, the same on every run; very long texts are encoded in blocks
of chunks; equal rows give equal rows; ids may be null; an empty table gives an empty result;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import lean, with_text
from tidewell.llm.pieces import SPACE_MARK, Memory, Pieces, model_path, pieces

REMEMBERED = 200_000  # chunks in each generation
SHORT = 64  # longer chunks are solved alone and not remembered
BLOCK = 1 << 18  # chunks handled at a time
TEXT_BLOCK = 1 << 20  # characters of texts handled at a time


class Trie:
    """The pieces as arrays: ``(node, letter)`` pairs in order, the node behind each, its piece."""

    def __init__(self, vocabulary: Pieces):
        letters = sorted({c for piece in vocabulary.id for c in piece})
        self.letter = np.zeros(max(map(ord, letters), default=0) + 2, np.int64)
        for k, c in enumerate(letters):
            self.letter[ord(c)] = k + 1
        self.width = len(letters) + 1
        steps: dict[int, int] = {}
        at: dict[str, int] = {"": 0}
        for piece in vocabulary.id:
            for k in range(1, len(piece) + 1):
                if piece[:k] not in at:
                    at[piece[:k]] = len(at)
                    steps[at[piece[: k - 1]] * self.width + int(self.letter[ord(piece[k - 1])])] = at[piece[:k]]
        self.steps = np.array(sorted(steps), np.int64)
        self.child = np.array([steps[s] for s in self.steps.tolist()], np.int64)
        self.piece = np.full(len(at), -1, np.int32)
        self.score = np.zeros(len(at))
        for piece, i in vocabulary.id.items():
            self.piece[at[piece]] = i
            self.score[at[piece]] = vocabulary.score[piece]

    def lattice(self, codes: np.ndarray, limit: np.ndarray, unknown: float):
        """Start, end, piece (-1: bytes) and score of every edge; ``limit`` ends each letter's chunk."""
        letters = self.letter[np.minimum(codes, len(self.letter) - 1)]
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        edges, depth = [], 0
        while len(at):
            key = node * self.width + letters[at + depth]
            found = np.searchsorted(self.steps, key)
            found[found == len(self.steps)] = 0
            ok = self.steps[found] == key
            depth += 1
            if depth == 1:
                lone = ~ok | (self.piece[self.child[found]] < 0)
                bare = at[lone]
                edges.append((bare, bare + 1, np.full(len(bare), -1, np.int32), np.full(len(bare), unknown)))
            at, node = at[ok], self.child[found[ok]]
            ends = self.piece[node] >= 0
            edges.append((at[ends], at[ends] + depth, self.piece[node[ends]], self.score[node[ends]]))
            on = at + depth < limit[at]
            at, node = at[on], node[on]
        return tuple(np.concatenate(x) for x in zip(*edges))


def solve_chunks(chunks: list[str], trie: Trie, unknown: float):
    """Best pieces, best score and loss of the second best path of each chunk, all chunks at once."""
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    first = np.concatenate(([0], np.cumsum(sizes)))
    codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
    chunk_of = np.repeat(np.arange(len(chunks)), sizes)
    start, end, piece, score = trie.lattice(codes, first[1:][chunk_of], unknown)
    chunk = chunk_of[start]
    # Every chunk has one state more than letters.
    a, b = start + chunk, end + chunk
    origin, goal = first[:-1] + np.arange(len(chunks)), first[1:] + np.arange(len(chunks))

    def sweep(source, target, base, sign):
        """Best score of each state, and the edge that gives it, from one end of the lattices."""
        best, by = np.full(len(codes) + len(chunks), -np.inf), np.zeros(len(codes) + len(chunks), np.int64)
        best[base] = 0.0
        rank = (target - base[chunk]) * sign
        order = np.lexsort((source * sign, target, rank))
        steps = np.searchsorted(rank[order], np.arange(1, int(rank.max()) + 2))
        for lo, hi in zip(steps[:-1].tolist(), steps[1:].tolist()):
            edges = order[lo:hi]
            value, states = best[source[edges]] + score[edges], target[edges]
            heads = np.flatnonzero(np.concatenate(([True], states[1:] != states[:-1])))
            most = np.maximum.reduceat(value, heads)
            counts = np.diff(np.concatenate((heads, [len(states)])))
            hit = np.where(value == np.repeat(most, counts), np.arange(len(states)), len(states))
            best[states[heads]] = most
            by[states[heads]] = edges[np.minimum.reduceat(hit, heads)]
        return best, by

    forward, by = sweep(a, b, origin, 1)
    backward, _ = sweep(b, a, goal, -1)
    on_path = np.zeros(len(start), bool)
    state, live = goal.copy(), np.arange(len(chunks))
    while len(live):
        edges = by[state[live]]
        on_path[edges] = True
        state[live] = a[edges]
        live = live[state[live] != origin[live]]
    total = forward[goal]
    off = np.flatnonzero(~on_path)
    second = np.full(len(chunks), -np.inf)
    np.maximum.at(second, chunk[off], forward[a[off]] + score[off] + backward[b[off]])
    path = np.flatnonzero(on_path)
    path = path[np.argsort(start[path], kind="stable")]
    bounds = np.searchsorted(chunk[path], np.arange(len(chunks) + 1))
    return piece[path], bounds, total, total - second


def n_best(chunk: str, vocabulary: Pieces, n: int) -> list[tuple[float, list[str]]]:
    """The ``n`` best segmentations of one chunk, best first, as ``(score, pieces)``.

    Forward Viterbi, then A-star from the end with the forward scores as its exact heuristic. Among
    equal scores the way nearest the start goes first, and ways beyond the ``n`` first ones from the
    end to a place are passed over, as none of the ``n`` best needs them: steps are linear in the chunk.
    """
    score, longest = vocabulary.score, vocabulary.longest
    ends: list[list[tuple[int, float]]] = [[] for _ in range(len(chunk) + 1)]
    best = [0.0] + [float("-inf")] * len(chunk)
    for i in range(len(chunk)):
        for j in range(i + 1, min(len(chunk), i + longest) + 1):
            value = score.get(chunk[i:j])
            if value is None and j == i + 1:
                value = vocabulary.unknown_score
            if value is not None:
                ends[j].append((i, value))
                best[j] = max(best[j], best[i] + value)
    # Ways from the end: (-(score so far + best way to the start), state, number, score, path so far).
    queue, number, found = [(-best[-1], len(chunk), 0, 0.0, None)], 0, []
    taken = [0] * (len(chunk) + 1)
    while queue and len(found) < n:
        _, state, _, done, path = heappop(queue)
        taken[state] += 1
        if taken[state] > n:
            continue
        if not state:
            cuts = []
            while path:
                cuts.append(path[0])
                path = path[1]
            cuts.append(len(chunk))
            found.append((done, [chunk[x:y] for x, y in zip(cuts, cuts[1:])]))
            continue
        for i, value in ends[state]:
            if taken[i] < n:
                number += 1
                heappush(queue, (-(best[i] + done + value), i, number, done + value, (i, path)))
    return found


class Encoder(Memory):
    """Encodes texts with one model; remembers ``(ids, score, loss)`` of chunks."""

    def __init__(self, path: str):
        super().__init__(REMEMBERED)
        self.pieces = pieces(path)
        self.trie = Trie(self.pieces)
        self.lists = _Lists(self.pieces)
        # What a piece adds to the decoded text.
        self.bytes_of = [
            bytes([self.pieces.byte_of[i]]) if i in self.pieces.byte_of
            else p.replace(SPACE_MARK, " ").encode() if p in self.pieces.id else b""
            for i, p in enumerate(self.pieces.text)
        ]

    def ids(self, parts: list[str]) -> list[int]:
        out = []
        for part in parts:
            if part in self.pieces.id:
                out.append(self.pieces.id[part])
            else:
                out += [self.pieces.byte_id[b] for b in part.encode()]
        return out

    def solve(self, chunk):
        """One chunk alone: a long one, a lone letter, or the mark as such, ``(mark,)``."""
        if isinstance(chunk, tuple):
            return np.array(self.ids_of_bytes(chunk[0]), np.int32).tobytes(), self.pieces.unknown_score, np.inf
        found = n_best(chunk, self.pieces, 2)
        loss = found[0][0] - found[1][0] if len(found) > 1 else np.inf
        return np.array(self.ids(found[0][1]), np.int32).tobytes(), found[0][0], loss

    def ids_of_bytes(self, text: str) -> list[int]:
        return [self.pieces.byte_id[b] for b in text.encode()]

    def __missing__(self, chunk):
        return super().__missing__(chunk) if len(chunk) <= SHORT else self.solve(chunk)

    def learn(self, chunks) -> None:
        """Solves at once what is not remembered yet."""
        new = [c for c in {*chunks}.difference(self) if 1 < len(c) <= SHORT and c not in self.old]
        if not new:
            return
        new.sort()
        piece, bounds, total, loss = solve_chunks(new, self.trie, self.pieces.unknown_score)
        known = np.ones(len(new), bool)
        known[np.searchsorted(bounds, np.flatnonzero(piece < 0), "right") - 1] = False
        if len(self) + len(new) > self.most:
            self.old = dict(self)
            self.clear()
        rows = zip(new, bounds.tolist(), bounds[1:].tolist(), total.tolist(), loss.tolist(), known.tolist())
        for chunk, lo, hi, best, lost, easy in rows:
            self[chunk] = (piece[lo:hi].tobytes(), best, lost) if easy else self.solve(chunk)

    def chunks(self, text: str) -> list:
        """Chunks of the text with its leading blank; the mark itself stands alone as a tuple."""
        if SPACE_MARK not in text:
            return self.pieces.chunks(SPACE_MARK + text.replace(" ", SPACE_MARK)) if text else []
        out: list = self.pieces.chunks(SPACE_MARK)
        for k, part in enumerate(text.split(SPACE_MARK)):
            out += [(SPACE_MARK,)] * (k > 0) + self.pieces.chunks(part.replace(" ", SPACE_MARK))
        return out

    def encode(self, chunks: list, n: int) -> tuple[np.ndarray, list[tuple[float, dict[tuple[int, int], list[int]]]]]:
        """Best ids, and the ``n`` best as ``(score, {(first, length): other ids})``, the best one first: what stands in place of
        some of the best ids."""
        ids, scores, losses, sizes = [], [], [], []
        for lo in range(0, len(chunks), BLOCK):
            block = chunks[lo : lo + BLOCK]
            if len(chunks) > BLOCK:
                self.learn(block)
            rows = list(map(self.__getitem__, block))
            parts = [r[0] for r in rows]
            ids.append(b"".join(parts))
            sizes.append(np.fromiter(map(len, parts), np.int64, len(parts)) // 4)
            scores.append(np.array([r[1] for r in rows]))
            losses.append(np.array([r[2] for r in rows]))
        best = np.frombuffer(b"".join(ids), np.int32)
        score = float(np.concatenate(scores).sum()) if scores else 0.0
        ways: list[tuple[float, dict[int, list[int]]]] = [(0.0, {})]
        if n > 1 and losses:
            loss = np.concatenate(losses)
            k = min(n - 1, len(loss))
            least = np.argpartition(loss, k - 1)[:k] if k < len(loss) else np.arange(len(loss))
            for c in sorted(least[np.isfinite(loss[least])].tolist()):
                others = self.lists.best(chunks[c], n)
                ways = sorted(
                    ((lost + others[0][0] - value, way | ({c: parts} if rank else {}))
                     for lost, way in ways for rank, (value, parts) in enumerate(others)),
                    key=lambda w: w[0],
                )[:n]
        if len(ways) == 1:
            return best, [(score, {})]
        size = np.concatenate(sizes)
        first = np.cumsum(size) - size
        return best, [
            (score - lost, {(int(first[c]), int(size[c])): self.ids(parts) for c, parts in sorted(way.items())})
            for lost, way in ways
        ]

    def alternatives(self, chunks: list, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations in full: ``(score, ids)``, best first."""
        best, ways = self.encode(chunks, n)
        return [(score, replaced(best.tolist(), way.items())) for score, way in ways]

    def decode(self, ids) -> str:
        """The text of any of its segmentations."""
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode("utf-8", "replace")


def replaced(ids: list[int], places) -> list[int]:
    """``ids`` with other ones at some places, ``((first, length), ids)`` by rising ``first``."""
    out, at = [], 0
    for (first, length), others in places:
        out += [*ids[at:first], *others]
        at = first + length
    return out + ids[at:]


class _Lists(Memory):
    """Lists of the best segmentations of chunks."""

    def __init__(self, vocabulary: Pieces):
        super().__init__(20_000)
        self.pieces = vocabulary

    def solve(self, key):
        return n_best(key[0], self.pieces, key[1])

    def best(self, chunk: str, n: int):
        return self[chunk, n] if len(chunk) <= SHORT else self.solve((chunk, n))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python process, so its memories serve every task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _groups(texts):
    """Texts in groups of about ``TEXT_BLOCK`` characters."""
    group, size = [], 0
    for text in texts:
        group.append(text.as_py() or "")
        size += len(group[-1])
        if size >= TEXT_BLOCK:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_texts(df: DataFrame, n: int = 1, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per text: ids of the best segmentation, the scores of the ``n`` best, whether the ids decode to the text again, and
    ``others``: for each further segmentation, in order, what it has in place of some of the best ids.

    ``segmentations`` makes rows of all of them.
    """
    path = path or model_path()
    rows = with_text(df, id_col, text_col).withColumn("_id", F.col("doc_id").cast("string"))
    names = ["_id", "n_bytes", "n_pieces", "piece_ids", "best_scores", "round_trip", "others"]
    places = pa.list_(pa.list_(pa.struct([("first", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])))

    def run(batches):
        from tidewell.llm.sentencepiece_nbest import encoder

        engine = encoder(path)
        for batch in batches:
            at = 0
            for group in _groups(batch.column(1)):
                cut = [engine.chunks(text) for text in group]
                if sum(map(len, cut)) <= 2 * BLOCK:
                    engine.learn(c for chunks in cut for c in chunks)
                ids, bounds, out = [], [0], ([], [], [], [])
                for text, chunks in zip(group, cut):
                    best, ways = engine.encode(chunks, n)
                    ids.append(best)
                    bounds.append(bounds[-1] + len(best))
                    out[0].append(len(text.encode()))
                    out[1].append([score for score, _ in ways])
                    out[2].append(engine.decode(best.tolist()) == text if text else True)
                    out[3].append([[{"first": a, "length": b, "ids": x} for (a, b), x in way.items()] for _, way in ways[1:]])
                arrays = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(np.concatenate(ids), pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(at, len(group)), pa.array(out[0], pa.int64()),
                     pa.array(np.diff(bounds), pa.int64()), arrays,
                     pa.array(out[1], pa.list_(pa.float64())), pa.array(out[2], pa.bool_()), pa.array(out[3], places)],
                    names,
                )
                at += len(group)

    schema = ("_id string, n_bytes long, n_pieces long, piece_ids array<int>, best_scores array<double>, "
              "round_trip boolean, others array<array<struct<first:int,length:int,ids:array<int>>>>")
    encoded = rows.mapInArrow(lean(run), schema)
    return encoded.select(F.col("_id").cast(rows.schema["doc_id"].dataType).alias(id_col), *names[1:])


def segmentations(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each of a text's best segmentations: id, ``rank`` from 1, ``score`` and ``piece_ids``, from the rows of
    ``encode_texts``. Each of them decodes to the text."""
    rows = encoded.select(F.col(id_col).cast("string").alias("_id"), "piece_ids", "best_scores", "others")

    def run(batches):
        for batch in batches:
            for key, ids, scores, others in zip(*(batch.column(k) for k in range(4))):
                ids = ids.as_py()
                ways = [[], *others.as_py()]
                full = [replaced(ids, [((p["first"], p["length"]), p["ids"]) for p in way]) for way in ways]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()] * len(full), pa.string()), pa.array(range(1, len(full) + 1), pa.int32()),
                     pa.array(scores.as_py(), pa.float64()), pa.array(full, pa.list_(pa.int32()))],
                    ["_id", "rank", "score", "piece_ids"])

    found = rows.mapInArrow(lean(run), "_id string, rank int, score double, piece_ids array<int>")
    return found.select(F.col("_id").cast(encoded.schema[id_col].dataType).alias(id_col), "rank", "score", "piece_ids")


def decode_ids(df: DataFrame, path: str | None = None, id_col: str = "doc_id",
               ids_col: str = "piece_ids") -> DataFrame:
    """The texts of encoded rows; null ids are an empty text."""
    path = path or model_path()
    rows = df.select(F.col(id_col).cast("string").alias("_id"), F.col(ids_col).alias("piece_ids"))

    def run(batches):
        from tidewell.llm.sentencepiece_nbest import encoder

        engine = encoder(path)
        for batch in batches:
            texts = [engine.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["_id", "text"])

    decoded = rows.mapInArrow(lean(run), "_id string, text string")
    return decoded.select(F.col("_id").cast(df.schema[id_col].dataType).alias(id_col), "text")
