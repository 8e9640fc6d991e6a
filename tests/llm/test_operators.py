"""Each operator against a plain version, and on the awkward tables."""

import heapq
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidewell.llm import (
    chat_format, components, decontaminate, language_id, near_dedup, quality_rules, sentencepiece_nbest, sharding,
    suffix_dedup, token_counts, url_filter,
)
from tidewell.llm.pieces import model_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.select("doc_id", *columns).collect()}


# --- quality rules -------------------------------------------------------------------------------

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_counts(docs, doc_rows):
    got = by_id(quality_rules.quality_report(docs), *COUNTS)
    assert got == {r[0]: brute.quality(r[1]) for r in doc_rows}


def test_quality_verdicts(spark):
    good = "the cat of the house and the dog in a garden to be there with it for long."
    rows = [(1, good), (2, good.replace(" ", " ### ")), (3, "zxqw " * 3 + "qqq www eee rrr ttt yyy uuu iii"), (None, None)]
    got = {r["doc_id"]: (r["kept"], r["broken_rule"]) for r in quality_rules.quality_report(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (True, None) and got[2][1] == "symbols" and got[3][1] == "stop_words" and not got[None][0]


def test_keep_good_keeps_all_columns(clashing):
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns
    wanted = {r["doc_id"] for r in quality_rules.quality_report(clashing).where("kept").collect()}
    assert wanted and {r["doc_id"] for r in kept.collect()} == wanted


def test_quality_uses_no_python_and_no_shuffle(docs):
    plan = quality_rules.quality_report(docs.sparkSession.range(0).selectExpr("id doc_id", "'' text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


# --- near duplicates -----------------------------------------------------------------------------


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, doc_rows, width):
    got = by_id(near_dedup.near_duplicates(docs, width), "n_shingles", "component_id", "kept")
    wanted = brute.components([r[:2] for r in doc_rows], width)
    assert got == {k: (n, c, c == k) for k, (n, c) in wanted.items()}


def test_near_duplicates_in_blocks(docs, doc_rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "SMALL_IDS", 0)
    got = by_id(near_dedup.near_duplicates(docs, 2), "component_id")
    assert got == {k: (c,) for k, (_, c) in brute.components([r[:2] for r in doc_rows], 2).items()}


def test_near_duplicates_odd_rows(spark, empty):
    assert near_dedup.near_duplicates(empty).count() == 0
    text = "one two three four five six seven"
    rows = [(4, text), (4, text), (2, text.upper()), (None, text), (9, "alone")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got.collect()) == [
        (-1, -1, True), (2, 2, True), (4, 2, False), (4, 2, False), (9, 9, True)]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    members = rng.integers(0, 2**63, 3_000, dtype=np.uint64)
    a, b = members[:2_000], members[500:]
    whole, left, right = near_dedup.sketch([members, a, b])
    assert (np.maximum(left, right) == whole).all()
    assert abs((left == right).mean() - 0.5) < 0.1


def test_likelihood_separates():
    rng = np.random.default_rng(1)
    for similarity, wanted in ((0.5, 0), (0.85, 20)):
        found = 0
        for _ in range(20):
            pool = rng.integers(0, 2**63, 2_000, dtype=np.uint64)
            same = int(2_000 * similarity / (1 + similarity))
            x, y = near_dedup.sketch([pool[:1_000], pool[1_000 - same : 2_000 - same]])
            equal, more = (x == y).sum(), (x > y).sum()
            args = np.array([more]), np.array([equal]), np.array([near_dedup.REGISTERS - equal - more])
            found += int(near_dedup.plausible(*args, 1_000, np.array([1_000]), 0.8)[0])
        assert found == wanted


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(200, 260)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)]
    links += [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {x: root(x) for x in list(parent)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- suffix arrays -------------------------------------------------------------------------------


@pytest.mark.parametrize("by_bucket", [0, 64, 10**9])
def test_suffix_array(monkeypatch, by_bucket):
    monkeypatch.setattr(suffix_dedup, "BY_BUCKET", by_bucket)
    rng = np.random.default_rng(by_bucket % 97)
    for _ in range(120):
        size = int(rng.integers(2, 6))
        s = np.concatenate((rng.integers(1, size, rng.integers(1, 50)), [0])).astype(np.int64)
        order = suffix_dedup.suffix_array(s, size)
        text = s.tolist()
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        shared = suffix_dedup.common_prefixes(s, order)
        for x, y in zip(order, order[1:]):
            n = 0
            while max(x, y) + n < len(text) and text[x + n] == text[y + n]:
                n += 1
            assert shared[y] == n


def test_suffix_array_takes_no_step_per_letter():
    """Lines that Python runs for a shard of text whose substrings repeat, with long repeats in it."""
    import sys

    rng = np.random.default_rng(5)
    text = rng.integers(1, 27, 300_000)
    text[200_000:250_000] = text[:50_000]
    s = np.concatenate((text, [0]))
    steps = 0

    def trace(frame, event, _):
        nonlocal steps
        if frame.f_code.co_filename != suffix_dedup.__file__:
            return None
        steps += event == "line"
        return trace

    before = sys.gettrace()
    sys.settrace(trace)
    try:
        order = suffix_dedup.suffix_array(s, 27)
    finally:
        sys.settrace(before)
    rank = np.empty(len(s), np.int64)
    rank[order] = np.arange(len(s))
    a, b = order[:-1], order[1:]  # a suffix before another: by the first letter, then by what follows
    assert ((s[a] < s[b]) | (s[a] == s[b]) & (rank[a + 1 - (s[a] == 0)] < rank[b + 1])).all()
    assert steps < 30_000


@pytest.mark.parametrize("hot,shard,long", [(20_000, 3 << 20, 1 << 20), (3, 500, 1 << 20), (20_000, 3 << 20, 400)])
def test_remove_repeats(docs, doc_rows, monkeypatch, hot, shard, long):
    monkeypatch.setattr(suffix_dedup, "LONG", long)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    got = by_id(suffix_dedup.digest(suffix_dedup.remove_repeats(docs)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    texts = brute.unrepeated([r[1] for r in doc_rows], 200)
    assert got == {r[0]: brute.digest(*t) for r, t in zip(doc_rows, texts)}


def test_remove_repeats_short_length(docs, doc_rows):
    cut = suffix_dedup.remove_repeats(docs, length=20)
    got = by_id(suffix_dedup.digest(cut), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    texts = brute.unrepeated([r[1] for r in doc_rows], 20)
    assert got == {r[0]: brute.digest(*t) for r, t in zip(doc_rows, texts)}


def test_remove_repeats_odd_rows(spark, empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    own = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(600))
    rows = [(1, own), (1, own), (2, own[:250] + "#"), (2, "short"), (None, own[300:]), (None, None)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = brute.unrepeated([r[1] for r in rows], 200)
    wanted = sorted((str(r[0]), *brute.digest(*t)) for r, t in zip(rows, texts))
    assert sorted((str(r[0]), *r[1:]) for r in suffix_dedup.digest(got).collect()) == wanted


def test_rows_of_one_id_with_equal_checksums(spark):
    """Two texts of one CRC-32 and unequal length, both under the null id, one with a repeat."""
    import zlib

    shared = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(300))
    long, wanted = "only here: " + shared, zlib.crc32(("only here: " + shared).encode())
    own = "".join(chr(65 + (i * i * i + i // 5) % 26) for i in range(210))
    short = _with_checksum(own, wanted)
    assert zlib.crc32(short.encode()) == wanted and len(short) != len(long)
    rows = [(None, long), (None, short), (5, shared + " and its end")]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    wanted = sorted((str(r[0]), *brute.digest(*t)) for r, t in zip(rows, brute.unrepeated([r[1] for r in rows], 200)))
    assert sorted((str(r[0]), *r[1:]) for r in suffix_dedup.digest(got).collect()) == wanted


def _with_checksum(text, wanted):
    """The text with 40 letters behind it, of two kinds, that give it this CRC-32: 32 linear equations."""
    import zlib

    base = zlib.crc32((text + "a" * 40).encode())
    rows = []
    for k in range(40):
        rows.append((zlib.crc32((text + "a" * k + "c" + "a" * (39 - k)).encode()) ^ base, 1 << k))
    left, chosen, goal = rows, 0, base ^ wanted
    for bit in range(32):
        pivot = next((r for r in left if r[0] >> bit & 1), None)
        if pivot is None:
            assert not goal >> bit & 1
            continue
        left = [(a ^ pivot[0], b ^ pivot[1]) if a >> bit & 1 else (a, b) for a, b in left if (a, b) != pivot]
        if goal >> bit & 1:
            goal, chosen = goal ^ pivot[0], chosen ^ pivot[1]
    return text + "".join("c" if chosen >> k & 1 else "a" for k in range(40))


def test_remove_repeats_from_a_very_long_text(spark):
    text = "all work and no play. " * 130_000
    row = suffix_dedup.digest(suffix_dedup.remove_repeats(spark.createDataFrame([(1, text)], "doc_id int, text string")))
    assert row.first()[:4] == (1, len(text), len(text), 1)


def test_remove_repeats_as_text(docs, doc_rows):
    cut = suffix_dedup.remove_repeats(docs, length=31, carry=("lang", "n_chars"), as_text=True)
    got = by_id(cut, "kept", "lang", "n_chars")
    for row, (data, gone) in zip(doc_rows, brute.unrepeated([r[1] for r in doc_rows], 31)):
        kept = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
        assert got[row[0]] == (kept, row[2], row[4])


# --- tokens --------------------------------------------------------------------------------------

TEXTS = ["", " ", "  a", "a  b\n c", "<s>x</s>", "<0x0A>", "ﬁ ½ é 日本 🙂", "a\x00b", "▁a b", " " * 37, "the " * 300,
         "in" * 200, "١٢٣ 1234567 !!! ... \t\r\n", "Onthsh thonn,\nthre éa"]


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def test_counts_of_every_prefix():
    model, count = library(), token_counts.counter(model_path()).counts
    for text in TEXTS:
        wanted = [len(model.encode(text[: i + 1])) for i in range(min(len(text), 120))]
        assert count(text)[: len(wanted)].tolist() == wanted
        assert len(count(text)) == len(text)


def test_counts_of_random_texts():
    model, count = library(), token_counts.counter(model_path()).counts
    rng = random.Random(2)
    parts = ["a", "b", " ", "  ", "    ", "the", "é", "日", "🙂", "\n", "!!", "tion", "ing", "12", "Ж", "<s>"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        assert count(text)[-1] == len(model.encode(text)), text


def test_token_budget(spark, docs, doc_rows, empty):
    model = library()
    got = by_id(token_counts.token_budget(docs, budget=40), "n_bytes", "n_tokens", "fit_chars", "over_limit")
    for key, text, *_ in doc_rows:
        text = text or ""
        tokens = len(model.encode(text))
        n_bytes, n_tokens, fit, over = got[key]
        assert (n_bytes, n_tokens, over) == (len(text.encode()), tokens, tokens > 40)
        assert len(model.encode(text[:fit])) <= 40
        assert fit == len(text) or all(len(model.encode(text[:i])) > 40 for i in range(fit + 1, min(len(text), fit + 30)))
    assert token_counts.token_budget(empty, 5).count() == 0
    rows = token_counts.prefix_counts(spark.createDataFrame([(None, "ab c"), (1, None)], "doc_id int, text string"))
    assert {r["doc_id"]: r["prefix_tokens"] for r in rows.collect()} == {
        None: [len(model.encode("ab c"[: i + 1])) for i in range(4)], 1: []}


def test_memory_is_bounded(monkeypatch):
    memory = token_counts.PrefixCounter(sentencepiece_nbest.pieces(model_path()))
    memory.most = 50
    model = library()
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choices("abcdefgh", k=7))
        assert memory.counts(text)[-1] == len(model.encode(text))
    assert len(memory) <= 51 and len(memory.old) <= 51


def test_n_best_is_exact():
    engine = sentencepiece_nbest.encoder(model_path())
    rng = random.Random(4)
    parts = ["a", "b", " ", "  ", "the", "é", "日", "🙂", "\n", "!!", "on", "ing", "st"]
    for _ in range(150):
        text = "".join(rng.choices(parts, k=rng.randint(1, 6)))
        chunks = engine.chunks(text)
        engine.learn(chunks)
        got = engine.alternatives(chunks, 5)
        wanted = brute.segmentations(
            "▁" + text.replace(" ", "▁"), engine.pieces.score, engine.pieces.unknown_score)[:5]
        assert [s for s, _ in got] == pytest.approx([s for s, _ in wanted])
        assert len({tuple(ids) for _, ids in got}) == len(got)
        assert all(engine.decode(ids) == text for _, ids in got)


@pytest.mark.parametrize("letter", [" ", "-"])
def test_tied_paths_are_not_all_explored(monkeypatch, letter):
    pushed = []

    def push(queue, way):
        pushed.append(1)
        assert len(pushed) < 200_000
        heapq.heappush(queue, way)

    monkeypatch.setattr(sentencepiece_nbest, "heappush", push)
    engine = sentencepiece_nbest.encoder(model_path())
    for n in (2, 4):
        pushed.clear()
        chunk = sentencepiece_nbest.SPACE_MARK * 501 if letter == " " else letter * 501
        found = sentencepiece_nbest.n_best(chunk, engine.pieces, n)
        assert len({tuple(parts) for _, parts in found}) == n and all("".join(parts) == chunk for _, parts in found)
        assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)


def test_encode_decode_round_trip(spark, docs, doc_rows, empty):
    rows = [*doc_rows, *((1_000 + k, t, None, None, None) for k, t in enumerate(TEXTS)), (5_000, "ab" * 4_000, "", "", 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    encoded = sentencepiece_nbest.encode_texts(frame, n=3)
    back = by_id(sentencepiece_nbest.decode_ids(encoded), "text")
    assert back == {r[0]: (r[1] or "",) for r in rows}
    for r in encoded.collect():
        assert r["round_trip"] and r["n_pieces"] == len(r["piece_ids"])
        assert r["best_scores"] == sorted(r["best_scores"], reverse=True)
    assert sentencepiece_nbest.encode_texts(empty).count() == 0


def test_all_segmentations_decode(spark, doc_rows):
    """The n best as rows: scores as listed, the first one the best, all different, each decodes to the text."""
    rows = [(r[0], r[1]) for r in doc_rows] + [(2_000 + k, t) for k, t in enumerate(TEXTS)]
    encoded = sentencepiece_nbest.encode_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), n=4)
    listed = {r["doc_id"]: r for r in encoded.collect()}
    engine = sentencepiece_nbest.encoder(model_path())
    ways = {}
    for r in sentencepiece_nbest.segmentations(encoded).orderBy("doc_id", "rank").collect():
        ways.setdefault(r["doc_id"], []).append(r)
    texts = dict(rows)
    assert set(ways) == set(texts) and any(len(w) == 4 for w in ways.values())
    for key, found in ways.items():
        assert [w["rank"] for w in found] == list(range(1, len(found) + 1))
        assert [w["score"] for w in found] == listed[key]["best_scores"] and found[0]["piece_ids"] == listed[key]["piece_ids"]
        assert len({tuple(w["piece_ids"]) for w in found}) == len(found)
        assert all(engine.decode(w["piece_ids"]) == (texts[key] or "") for w in found)
        if texts[key] and len(texts[key]) < 300:
            wanted = engine.alternatives(engine.chunks(texts[key]), 4)
            assert [w["piece_ids"] for w in found] == [ids for _, ids in wanted]


# --- shards --------------------------------------------------------------------------------------


def check_shards(rows, shards):
    sizes, slots, texts = {}, {}, {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        texts.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) <= set(range(shards))
    return sizes, texts


def test_shards(spark, vocabulary):
    import zlib

    rng = random.Random(6)
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 30))) for _ in range(3_000)] + [None, "", ""]
    texts += ["hot copy of words " * 5] * 1_500
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = sharding.shard_rows(frame, 16).collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {
        (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in enumerate(texts)}
    sizes, places = check_shards(rows, 16)
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(sizes.values()) < 1.05 * mean and min(sizes.values()) > 0.95 * mean
    # Only the hot group, far above the tolerance, is split.
    split = [k for k, s in places.items() if len(s) > 1]
    assert split == [zlib.crc32(("hot copy of words " * 5).encode())]


def test_shards_of_odd_rows(spark, empty, clashing, tmp_path):
    assert sharding.shard_rows(empty).count() == 0
    rows = [(None, "a"), (None, "a"), (3, "b"), (3, "b"), (4, None)]
    got = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    assert len(got) == 5
    check_shards(got, 3)
    check_shards(sharding.shard_rows(clashing).collect(), 16)
    path = str(tmp_path / "shards")
    sharding.write_shards(clashing, path, shards=4, files_per_shard=2)
    back = spark.read.parquet(path)
    assert back.count() == clashing.count() and set(back.columns) == {*clashing.columns, "shard_number"}


# --- languages -----------------------------------------------------------------------------------

LANGUAGES = {
    "aa": "the thing that he was on and with her of in", "bb": "der und die nicht eine wir sind für über das",
    "cc": "le la les qui dans être où sont une elle", "dd": "これ は 日本 語 です その ため の 文",
}


def language_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice([*LANGUAGES])
        stems = LANGUAGES[lang].split()
        out.append((i, " ".join(rng.choice(stems) + rng.choice(["", rng.choice(stems)]) for _ in range(rng.randint(3, 40))), lang))
    return out


def test_language_on_held_out_rows(spark):
    rows = language_rows(400, 1) + [(900, None, "aa"), (901, "12 .!", "aa"), (902, "text", None), (None, "the thing", "aa")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = language_id.held_out()
    filters = language_id.learn(frame.where(~held))
    got = {r["doc_id"]: r for r in language_id.identify(frame, filters).join(frame.select("doc_id", held.alias("h")), "doc_id").collect()}
    tested = [(got[k]["lang_pred"], lang) for k, _, lang in rows[:400] if got[k]["h"]]
    assert len(tested) > 60 and sum(a == b for a, b in tested) >= 0.97 * len(tested)
    assert (got[900]["lang_pred"], got[901]["lang_pred"]) == ("und", "und")
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["lang_pred"] in {*LANGUAGES, "und"} for r in got.values())


def test_language_of_empty_tables(empty, docs):
    nothing = language_id.learn(empty)
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    some = language_id.learn(docs)
    assert language_id.identify(empty, some).count() == 0


def test_more_languages_than_bits(spark):
    rows = [(i * 10 + k, f"{chr(0x4E00 + 7 * i)}{chr(0x4E01 + 7 * i)}{chr(0x4E02 + 7 * i)} " * 5, f"l{i:03d}")
            for i in range(70) for k in range(2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language_id.learn(frame)
    assert filters.slots.shape[1] == 2
    assert by_id(language_id.identify(frame, filters), "lang_pred") == {k: (lang,) for k, _, lang in rows}


# --- decontamination -----------------------------------------------------------------------------

ITEMS = [
    (1, "A train leaves the old station with 120 people and drives 45 km in 30 minutes before Anna gets off. How many are left when 12 go?"),
    (2, "Which of the following words describes the colour of the sky on a clear summer day near the sea?"),
    (3, "short item here"), (4, None), (5, ""),
    (6, "A train leaves the old station with 99 people and drives 10 km in 20 minutes before Bob gets off. How many are left when 3 go?"),
]


def test_templates_are_found(spark):
    again = ITEMS[0][1].replace("120", "77").replace("45 km", "9 miles").replace("Anna", "Peter").replace("12", "5")
    twisted = ITEMS[0][1]
    docs = [
        (10, f"Some words before. {ITEMS[0][1]} Some words after."),
        (11, f"Some words before. {again} And words after."),
        (12, "Nothing of that kind is in this text, which speaks of trains and stations in general terms only."),
        (13, "so they asked: " + ITEMS[1][1].lower()),
        (14, None), (15, ""), (16, "We saw a short item here once."), (None, ITEMS[1][1]),
        (17, twisted[:40] + " and so on about something else entirely."),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contaminated(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(10, 1), (11, 1), (13, 2), (16, 3), (None, 2)}
    found = {r["doc_id"]: r for r in got}
    # Items 1 and 6 share a template: one class.
    assert found[10]["n_items"] == 2 and found[10]["verbatim"] and not found[11]["verbatim"]


def test_slots_must_be_consistent(spark):
    bench = [(1, "add 5 apples to 5 pears and take 7 plums from the table then count 5 again and 7 again")]
    docs = [(1, "add 8 apples to 8 pears and take 2 plums from the table then count 8 again and 2 again"),
            (2, "add 8 apples to 9 pears and take 2 plums from the table then count 6 again and 1 again")]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(bench, "item_id long, text string"))
    assert [r["doc_id"] for r in got.collect()] == [1]


def test_rows_without_an_id_are_judged_apart(spark):
    """Two copies with other values under one null id contradict each other if they share a diagonal."""
    bench = [(1, "add 5 apples to 5 pears and take 7 plums from the table then count 5 again and 7 again")]
    docs = [(None, bench[0][1]), (None, bench[0][1].replace("5", "8")), (None, bench[0][1].replace("7", "3")), (None, bench[0][1])]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(bench, "item_id long, text string"))
    assert [(r["doc_id"], r["item_id"], r["covered"]) for r in got.collect()] == [(None, 1, 20)] * 3


def _hits(spark, pairs):
    """For each ``(item, text)``, whether the text is contaminated by its item."""
    bench = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(pairs)], "item_id long, text string")
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(pairs)], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    return [(k, k) in found for k in range(len(pairs))]


def _made_up(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices("bcdfglmnprst", k=3)) + rng.choice("aeiou") for _ in range(n)]


def test_parts_and_changed_copies_are_found(spark):
    long, other, third, fourth, fifth = (_made_up(k, 250 if k == 2 else 36 if k in (3, 4) else 59) for k in (1, 2, 3, 4, 5))
    put_in = [*third[:12], "extra", *third[12:24], "more", *third[24:]]
    left_out = [w for k, w in enumerate(fourth) if k not in (12, 24)]
    trip = "a clerk from Paris sends one letter to his sister near Paris and she sends two of them back to Paris before he calls"
    asked = "yesterday a boy called Tim from the village of Ham asked his aunt for a bag of plums and got two of them each day"
    walk = "the guide led from Paris over the hill and along the river then home to Paris again for the night"
    got = _hits(spark, [
        (" ".join(long), "we read " + " ".join(long[10:38]) + " and so on"),
        (" ".join(other), "we read " + " ".join(other[100:200]) + " and so on"),
        (" ".join(third), " ".join(put_in)), (" ".join(fourth), " ".join(left_out)),
        (trip, trip.replace("Paris", "New York")), (asked, asked.replace("Tim", "Jan Erik").replace("Ham", "Ba Be")),
        (walk, walk.replace("to Paris", "to Rome")), (" ".join(fifth), " ".join(fifth[30:42]) + " and nothing more of it"),
    ])
    assert got == [True] * 7 + [False]


def test_all_readings_are_found(spark):
    tom = "Tom has 3 red pens. Tom buys 4 more pens. Tom gives 2 pens away. How many pens has Tom?"
    anna = "when Anna met Bert and Carl near Dover they gave Emma the key of Fred and the hat of Gina"
    sums = "Compute 12 + 45 - 7 * 3 + 9."
    assert _hits(spark, [
        (sums, f"The task was: {sums} Then it ended."), (tom, tom.replace("Tom", "Ann").replace("3", "8")),
        (anna, anna.lower()), (tom.replace("red", "blue"), tom.replace("red", "blue").lower()),
        ("Compute 31 + 62 - 8 * 5 + 4.", "Compute 77 + 1 - 16 * 2 + 6."),
    ]) == [True] * 4 + [False]


def test_both_joins_agree(spark, docs, doc_rows, monkeypatch, empty):
    items = [(k, " ".join(r[1].split(" ")[3:25])) for k, r in enumerate(doc_rows[:20])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    small = {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "FEW", -1)
    assert {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()} == small
    assert {(k, k) for k in range(20) if len(items[k][1].split()) >= 8} <= {r[:2] for r in small}
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


# --- chats ---------------------------------------------------------------------------------------


def cheapest(roles, costs):
    """Least cost over all labels and merges, with the fewest empty turns that make them legal."""
    import heapq
    import itertools

    legal, best = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}, 10**9
    for labels in itertools.product((1, 2, 3), repeat=len(roles)):
        for merges in itertools.product((0, 1), repeat=len(roles)):
            cost, turns, fine = 0, [], True
            for role, label, merged in zip(roles, labels, merges):
                cost += 0 if role in (None, label) else costs.relabel
                if merged:
                    fine &= bool(turns) and turns[-1] == label
                    cost += costs.merge
                else:
                    turns.append(label)
            if not fine:
                continue
            done, queue = {(0, 0): 0}, [(0, 0, 0)]
            while queue:
                n, i, state = heapq.heappop(queue)
                if i == len(turns) and state == 3:
                    best = min(best, cost + costs.insert * n)
                    break
                for nxt in legal[state]:
                    for j, more in ([(i + 1, 0)] if i < len(turns) and turns[i] == nxt else []) + [(i, 1)]:
                        if done.get((j, nxt), 99) > n + more:
                            done[j, nxt] = n + more
                            heapq.heappush(queue, (n + more, j, nxt))
    return best


@pytest.mark.parametrize("costs", [chat_format.Costs(), chat_format.Costs(2, 1, 1)])
def test_repairs_are_cheapest(costs):
    rng = random.Random(9)
    for _ in range(60):
        roles = [rng.choice([1, 2, 3, None, 2, 3]) for _ in range(rng.randint(1, 4))]
        path = chat_format.repair(roles, costs)
        cost = sum(s.cost for s in path) + costs.insert * len(chat_format._TO_END[path[-1].target])
        assert cost == cheapest(roles, costs)
        assert (chat_format.matrix(roles, costs)[0] + chat_format.end_cost(costs)).min() == cost


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "assistant", "first"), (2, 1, "user", "<|im_end|> trick"),
    (3, 0, "user", "one"), (3, 1, "user", "two"), (3, 2, "assistant", None), (3, 2, "assistant", None), (4, 5, "tool", "x"),
    (5, None, "assistant", "late"), (5, 1, "user", "q"), (None, 0, "user", "gone"), (6, 0, "system", "rules"),
]


def test_chats(spark, monkeypatch):
    frame = spark.createDataFrame(CHATS, "conv_id long, turn int, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.format_chats(frame).collect() if r["conv_id"] not in (5,)}
    assert got[1]["rendered"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
    assert got[1]["cost"] == 0 and got[3]["n_turns"] == 3 and got[3]["n_merged"] == 1
    assert "<|im_end|> trick" not in got[2]["rendered"]
    assert all(r["rendered"].count("<|im_start|>") == r["rendered"].count("<|im_end|>") == r["n_opened"] for r in got.values())
    assert chat_format.format_chats(frame.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 3])
def test_long_conversations_in_blocks(spark, monkeypatch, block):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "?"]), f"t{t}")
            for c in range(12) for t in range(rng.randint(1, 14))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    whole = {r["conv_id"]: r for r in chat_format.format_chats(frame).collect()}
    monkeypatch.setattr(chat_format, "BLOCK", block)
    parts = {}
    for r in chat_format.format_chats(frame).orderBy("conv_id", "block").collect():
        parts.setdefault(r["conv_id"], []).append(r)
    for conv, rows in parts.items():
        assert sum(r["cost"] for r in rows) == whole[conv]["cost"]
        text = "".join(r["rendered"] for r in rows)
        assert text.count("<|im_start|>") == text.count("<|im_end|>") == sum(r["n_opened"] for r in rows)


# --- URL filters ---------------------------------------------------------------------------------


def test_list_entries_hold_in_their_time(spark):
    at = lambda d: f"2024-01-{d:02d} 00:00:00"
    entries = [
        ("bad.example.com", "spam", "add", at(5)), ("bad.example.com", "spam", "remove", at(10)),
        ("bad.example.com", "spam", "add", at(20)), ("bad.example.com", "spam", "add", at(20)),
        ("WWW.Example.org/ads/", "ads", "add", at(1)), ("x.net", "spam", "add", at(3)), ("x.net", "spam", "remove", at(3)),
        (None, "spam", "add", at(1)), ("y.net", "spam", "add", None),
    ]
    captures = [
        (1, "http://bad.example.com/a", at(4)), (2, "http://bad.example.com/a", at(5)), (3, "https://sub.BAD.example.com.:80/", at(9)),
        (4, "http://bad.example.com/a", at(10)), (5, "http://u@bad.example.com?q", at(25)), (6, "http://example.org/ads/1.html?x=1", at(2)),
        (7, "http://example.org/adsense", at(2)), (8, "http://x.net", at(4)), (9, None, at(4)), (10, "not a url", at(4)),
        (11, "http://bad.example.com/a", None), (12, "http://y.net", at(9)), (2, "http://bad.example.com/a", at(5)), (None, "http://bad.example.com", at(6)),
    ]
    entries = spark.createDataFrame(entries, "pattern string, list string, action string, at string").selectExpr(
        "pattern", "list", "action", "cast(at as timestamp_ntz) at")
    captures = spark.createDataFrame(captures, "page_id long, url string, fetched_at string").selectExpr(
        "page_id", "url", "cast(fetched_at as timestamp_ntz) fetched_at", "'clash' pattern", "1 kept", "2 list", "3 v")
    got = url_filter.filter_captures(captures, entries).collect()
    assert sorted(r["page_id"] or 0 for r in got if not r["kept"]) == [0, 2, 2, 3, 5, 6]
    assert len(got) == 14
    assert {r["patterns"] for r in got if r["page_id"] == 6} == {"example.org/ads"}
    assert url_filter.filter_captures(captures, entries.limit(0)).where("NOT kept").count() == 0
    assert url_filter.filter_captures(captures.limit(0), entries).count() == 0


def test_folders_keep_their_case(spark):
    entries = spark.createDataFrame([("Example.ORG/Ads/", "ads"), ("example.org/a./B", "dot"), ("x.net./c", "end")], "pattern string, list string")
    captures = spark.createDataFrame(
        [(1, "http://EXAMPLE.org/Ads/x"), (2, "http://example.org/ads/x"), (3, "http://example.org/a./B"),
         (4, "http://x.net/c/d")], "page_id long, url string")
    at = "timestamp_ntz '2024-01-05 00:00:00'"
    got = url_filter.filter_captures(
        captures.selectExpr("*", f"{at} fetched_at"), entries.selectExpr("*", "'add' action", f"{at} at")).collect()
    assert {r["page_id"]: r["patterns"] for r in got} == {1: "example.org/Ads", 2: "", 3: "example.org/a./B", 4: "x.net/c"}


def test_url_filter_runs_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/d")], "page_id long, url string")
    plan = url_filter.filter_captures(url_filter.page_captures(pages), url_filter.page_list(pages))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


# --- columns with the operators' own names -------------------------------------------------------


def test_clashing_columns_change_nothing(docs, clashing):
    for function, columns in (
        (quality_rules.quality_report, ["n_words", "kept"]),
        (near_dedup.near_duplicates, ["component_id"]),
        (lambda d: suffix_dedup.digest(suffix_dedup.remove_repeats(d)), ["kept_sha256"]),
        (lambda d: token_counts.token_budget(d, 20), ["n_tokens", "fit_chars"]),
        (lambda d: sentencepiece_nbest.encode_texts(d, 2), ["n_pieces"]),
        (lambda d: language_id.identify(d, language_id.learn(d)), ["lang_pred"]),
    ):
        assert by_id(function(clashing), *columns) == by_id(function(docs), *columns)


def test_results_are_stable(docs):
    one = json.dumps(sorted(by_id(near_dedup.near_duplicates(docs), "component_id").items()))
    assert one == json.dumps(sorted(by_id(near_dedup.near_duplicates(docs.repartition(7)), "component_id").items()))


def test_many_equal_rows(spark):
    """Rows equal in id and text, in number: one judgement, no row times row."""
    import time

    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ", k=1500))
    base = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    more = [(1, text[:700] + "x" * 30), (2, "y" * 150 + text[900:1100]), (3, "short"), (3, "short"), (4, "z" + text[3:150])]
    frame = base.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    start = time.time()
    got = suffix_dedup.remove_repeats(frame).groupBy("doc_id", "n_bytes", F.octet_length("kept").alias("left")).count()
    found = {tuple(r) for r in got.collect()}
    assert found == {(None, 1500, 0, 100_000), (1, 730, 30, 1), (2, 350, 150, 1), (3, 5, 5, 2), (4, 148, 148, 1)}
    assert time.time() - start < 60


def test_repeated_ids_link_once(spark):
    """Two near texts under two ids, each row a thousand times; and one id with several unlike texts."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    a = " ".join(rng.choices(words, k=100))
    b = a + " tail"
    rows = [(7, a)] * 1000 + [(5, b)] * 1000 + [(9, "quite another text here"), (9, "and one more that is not like it"), (8, "and one more that is not like it")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 2)
    found = {tuple(r) for r in got.groupBy("doc_id", "component_id", "kept").count().collect()}
    assert found == {(5, 5, True, 1000), (7, 5, False, 1000), (9, 8, False, 2), (8, 8, True, 1)}


def test_leaders_join_a_large_group(spark):
    """A chain of near copies and one large group: components as by brute force, few pairs for each seat."""
    rng = random.Random(8)
    words = [f"v{i}" for i in range(500)]
    base = rng.choices(words, k=120)
    rows = []
    for k in range(150):
        copy = list(base)
        for _ in range(rng.randrange(8)):
            copy[rng.randrange(120)] = rng.choice(words)
        rows.append((k, " ".join(copy)))
    for k in range(40):
        base = list(base)
        base[rng.randrange(120)] = rng.choice(words)
        base[rng.randrange(120)] = rng.choice(words)
        rows.append((1000 + k, " ".join(base)))
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2), "component_id")
    assert got == {k: (c,) for k, (_, c) in brute.components(rows, 2).items()}


def test_a_hot_host_is_split(spark):
    """A third of all captures on one listed host, and as many without a URL: no task reads most of either."""
    n = 200_000
    url = F.when(F.col("id") % 3 == 0, F.concat(F.lit("http://hot.example.org/p"), F.col("id"))).when(
        F.col("id") % 3 == 1, F.concat(F.lit("http://h"), F.col("id"), F.lit(".net/x")))
    captures = spark.range(n).select(
        F.col("id").alias("page_id"), url.alias("url"), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("fetched_at"))
    entries = spark.range(40_000).select(
        F.when(F.col("id") == 0, "example.org").otherwise(F.concat(F.lit("h"), F.col("id"), F.lit(".net"))).alias("pattern"),
        F.lit("ads").alias("list"), F.lit(url_filter.ADD).alias("action"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("at"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = url_filter.filter_captures(captures, entries)
        sizes = found.select(F.spark_partition_id().alias("p"), "page_id", "kept").groupBy("p").agg(
            F.count("*").alias("n"), F.max("page_id"), F.count_if(~F.col("kept")).alias("gone")).collect()
        assert sum(r["n"] for r in sizes) == n and max(r["n"] for r in sizes) < 0.2 * n
        assert sum(r["gone"] for r in sizes) == sum(k % 3 == 0 or (k % 3 == 1 and 0 < k < 40_000) for k in range(n))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_unnumbered_turns_in_number(spark, monkeypatch):
    """Conversations whose turns have no number, or one: blocks by rank, the same repair as in one block."""
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool", None]
    rows = [(1, None, rng.choice(roles), f"t{k:04d}") for k in range(300)] + [(2, 7, rng.choice(roles), f"s{k:04d}") for k in range(90)]
    rows += [(3, k, rng.choice(roles), f"u{k}") for k in range(9)] + [(1, 5, "user", "first"), (None, 1, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    whole = {}  # two blocks where some turns have a number
    for r in chat_format.format_chats(frame).collect():
        cost, n = whole.get(r["conv_id"], (0, 0))
        whole[r["conv_id"]] = (cost + r["cost"], n + r["n_turns"])
    monkeypatch.setattr(chat_format, "BLOCK", 8)
    parts = {}
    for r in chat_format.format_chats(frame).orderBy("conv_id", "block").collect():
        parts.setdefault(r["conv_id"], []).append(r)
    assert set(parts) == set(whole) == {1, 2, 3}
    for key, found in parts.items():
        assert max(r["n_turns"] for r in found) <= 16
        assert (sum(r["cost"] for r in found), sum(r["n_turns"] for r in found)) == whole[key]
    assert len(parts[1]) == 38 and parts[1][0]["rendered"].startswith("<|im_start|>user\nfirst")


def test_a_hundred_thousand_unnumbered_turns(spark):
    frame = spark.range(100_000).select(
        F.lit(1).alias("conv_id"), F.lit(None).cast("long").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.format_string("%06d", "id").alias("text"))
    got = chat_format.format_chats(frame).collect()
    assert sum(r["n_turns"] for r in got) == 100_000 and max(r["n_turns"] for r in got) <= 2 * chat_format.BLOCK and len(got) > 20


def test_capitals_of_other_alphabets(spark):
    """Lower case byte by byte as Python has it; a Cyrillic and a Greek copy in other case, and one with another name."""
    text = "ÀÉß Straße ŁÓDŹ Čapek ΑΒΓ Ωμέγα МОСКВА Ёлка Ђ × ÷ Ÿ plain ĲĳŸ Ա ա ſ"
    data = np.frombuffer(text.encode(), np.uint8)
    low, capital = decontaminate.folded(data)
    wanted = "".join(c.lower() if len(c.lower()) == 1 and len(c.lower().encode()) == len(c.encode()) <= 2 else c for c in text)
    assert low.tobytes().decode() == wanted and capital.any()
    item = "поезд выехал из города Москва в 9 часов и прошёл 300 километров до города Тверь без остановки в пути"
    greek = "το τρένο έφυγε από την Αθήνα στις 9 και έφτασε στη Πάτρα μετά από τρεις ώρες χωρίς στάση στο δρόμο"
    docs = [(1, item.upper()), (2, item.replace("Москва", "Казань").replace("Тверь", "Пермь")), (3, greek.upper().replace("Σ ", "Σ ")),
            (4, "совсем другой текст о погоде и о море который ни с чем здесь не совпадает и остаётся"), (5, greek.replace("Αθήνα", "Λάρισα"))]
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item), (2, greek)], "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} >= {(1, 1), (2, 1), (5, 2)}
    assert 4 not in {r["doc_id"] for r in found.collect()}
