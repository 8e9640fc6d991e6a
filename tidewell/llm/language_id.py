"""Language identification with bit-sliced Bloom filters over character n-grams.

Training counts the n-grams of labelled texts for each language and keeps, for each language, its most frequent
ones among those that are about as frequent there as in the language that uses them most. All
languages share one table of slots; a slot holds one bit for each language. An n-gram sets its
language's bit in ``HASHES`` slots, and the bitwise AND of its slots is the set of all languages
whose filter holds it, read at once. For a text the hits of each language are counted over all its
n-grams. A filter with a share ``f`` of its bits set reports a strange n-gram with probability
``f ** HASHES``; the count is corrected for that before languages are compared.

Training reads a bounded sample, ``SAMPLE`` texts for each language chosen by a hash of the id, a threshold
that works alike at every size; what reaches the driver is at most ``GRAMS`` n-grams for each language.
Prediction reads every text whole, without a shuffle.

Edge cases: a null text or one without letters is ``und`` with score 0, as is every text where
nothing was learned; a text whose n-grams are all unknown gets the commonest learned language with
score 0; ties go to the language that is first by name; equal rows are judged alike; ids may be
null; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import mix, with_text

GRAM = 4  # characters
SAMPLE = 4_000  # labelled texts of one language
GRAMS = 20_000  # n-grams of one language
SLOT_BITS = 18
HASHES = 3
SHARE = 0.5  # of the frequency in the language that uses the n-gram most
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(text: str) -> tuple[np.ndarray, bool]:
    """Hashes of the n-grams of lower-cased letters, each gap one blank; whether there is a letter."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32).astype(np.uint64)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    codes = codes[keep]
    if len(codes) < GRAM:
        codes = np.concatenate((codes, np.full(GRAM - len(codes), 32, np.uint64)))
    n = len(codes) - GRAM + 1
    out = codes[:n].copy()
    for k in range(1, GRAM):
        out = out * np.uint64(0x110001) + codes[k : k + n]
    return mix(out), bool(letter.any())


@dataclass(frozen=True)
class Filters:
    """Languages in order of name, their slots as rows of 64-bit words, and false-positive rates."""

    languages: tuple[str, ...]
    slots: np.ndarray
    rates: np.ndarray
    fallback: int

    def masks(self, found: np.ndarray) -> np.ndarray:
        """For each n-gram the words that hold one bit for each language whose filter has it."""
        out = self.slots[_slot(found, 0)]
        for k in range(1, HASHES):
            out &= self.slots[_slot(found, k)]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        found, has_letter = grams(text)
        if not has_letter:
            return UNKNOWN, 0.0
        masks = self.masks(found)
        hits = np.array([
            np.count_nonzero(masks[:, k >> 6] & np.uint64(1 << (k & 63))) for k in range(len(self.languages))
        ])
        true = np.maximum((hits / len(found) - self.rates) / (1 - self.rates), 0.0)
        total = true.sum()
        if total <= 0:
            return self.languages[self.fallback], 0.0
        best = int(np.argmax(true))
        return self.languages[best], float(true[best] / total)


def _slot(found: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th slot: another part of the hash each time."""
    return ((found >> np.uint64(SLOT_BITS * k)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _counts(labelled: DataFrame) -> DataFrame:
    """N-gram counts by language, combined for each batch before they are shuffled."""

    def run(batches):
        for batch in batches:
            by_language: dict[str, list[np.ndarray]] = {}
            for language, text in zip(*(c.to_pylist() for c in batch.columns)):
                by_language.setdefault(language, []).append(grams(text)[0])
            for language, found in by_language.items():
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(values)), pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    counted = labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters of all languages in ``df``; rows without text or language teach nothing."""
    labelled = df.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Filters((), np.zeros((0, 0), np.uint64), np.zeros(0), 0)
    languages = tuple(sorted(sizes))
    # A hash of the id below the language's threshold takes about SAMPLE texts of it.
    unit = 1 << 20
    least = F.create_map(*(
        F.lit(x) for name in languages for x in (name, min(unit, -(-SAMPLE * unit // sizes[name])))
    ))
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("text"))), F.lit(unit))
    sample = labelled.where(draw < least[F.col("lang")])
    counts = _counts(sample)
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    shares = counts.withColumn("share", share)
    top = F.max("share").over(Window.partitionBy("gram"))
    usual = shares.withColumn("top", top).where(F.col("share") >= SHARE * F.col("top"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = usual.withColumn("rank", rank).where(F.col("rank") <= GRAMS).select("lang", "gram").toPandas()
    slots = np.zeros((1 << SLOT_BITS, -(-len(languages) // 64)), np.uint64)
    rates = np.zeros(len(languages))
    for k, name in enumerate(languages):
        found = kept["gram"][kept["lang"] == name].to_numpy(np.int64).view(np.uint64)
        bit = np.uint64(1 << (k & 63))
        for h in range(HASHES):
            slots[_slot(found, h), k >> 6] |= bit
        rates[k] = (np.count_nonzero(slots[:, k >> 6] & bit) / len(slots)) ** HASHES
    return Filters(languages, slots, rates, languages.index(max(languages, key=lambda x: (sizes[x], x))))


def identify(df: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the predicted language and its share of the corrected hits."""
    rows = with_text(df, id_col, text_col).withColumn("_id", F.col("doc_id").cast("string"))
    # The table's size is fixed by SLOT_BITS and the number of languages.
    shared = df.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        model = shared.value
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["_id", "lang_pred", "score"],
            )

    out = rows.select("_id", "text").mapInArrow(run, "_id string, lang_pred string, score double")
    return out.select(F.col("_id").cast(rows.schema["doc_id"].dataType).alias(id_col), "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: the checksum of its id as text leaves 2 modulo 4."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2
