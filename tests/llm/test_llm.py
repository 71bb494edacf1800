"""Text operators: SQL and brute force on the smallest tables, and the odd cases on tiny ones."""

from __future__ import annotations

import base64
import hashlib
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from editpulse.llm import batches, bpe, chat, columns, decontaminate, line_dedup, minhash, quality, suffixes, syncmers, toxicity, url_filter
from editpulse.llm.components import connected_components
from editpulse.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, kept string, component_id int, words string"
LONG = " ".join(f"w{i}" for i in range(60))
ODD = [
    (1, LONG, "en", "s", "x", 1, "y"),
    (2, LONG, None, None, None, None, None),
    (3, None, "en", "s", None, None, None),
    (4, "", "en", "s", None, None, None),
    (5, LONG + " more", "en", "s", None, None, None),
    (5, LONG + " more", "en", "s", None, None, None),
    (None, "short é text", "de", "t", None, None, None),
    (7, "x" * 300_000, "en", "s", None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF), QUERIES[name], ORACLE[name], SF) is None


def _documents(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())


def test_repeats_match_brute_force(spark):
    seen, expected = set(), {}
    for doc_id, text in _documents(spark):
        raw = text.encode()
        own = [raw[i : i + 50] for i in range(len(raw) - 49)]
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i, string in enumerate(own):
            if string in seen:
                gone[i : i + 50] = True
        seen.update(own)
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        runs = int((gone & ~np.append(False, gone[:-1])).sum())
        expected[doc_id] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    rows = QUERIES["op3_suffix_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == expected


def test_edited_texts_and_prints(spark):
    docs = _documents(spark)[::-1]
    rows = {r.doc_id: r for r in QUERIES["op4_fingerprints"](spark, SF).collect()}
    prints = {}
    for i, (doc_id, text) in enumerate(docs):
        half, following = len(text) // 2, docs[(i + 1) % len(docs)][1]
        edited = text[: len(text) - half] + following[:half]
        assert rows[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, rows[doc_id].fingerprint) == rows[doc_id].fingerprint
    assert np.mean([r.near_edited for r in rows.values()]) > 0.2 > np.mean([r.near_next for r in rows.values()])
    assert sum(len(r.fingerprint) for r in rows.values()) < sum(len(t) for _, t in docs)

    def hashes(shown):
        raw = base64.b64decode(shown)
        return {raw[i : i + 3] for i in range(0, len(raw), 3)}

    def likeness(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, (doc_id, _) in enumerate(docs):
        own, after = rows[doc_id], rows[docs[(i + 1) % len(docs)][0]]
        assert own.near_edited == likeness(hashes(own.fingerprint), hashes(own.edited_fingerprint))
        assert own.near_next == likeness(hashes(own.fingerprint), hashes(after.fingerprint))


@pytest.mark.parametrize("spread", ["far", "clustered", "hashed", "repeated", "one", "none"])
def test_next_texts_whatever_the_ids(spark, spread):
    rng = np.random.default_rng(5)
    n = 3000
    ids = {
        "far": [1, 10**18, -(2**63), 2**63 - 1],
        "clustered": [*range(n), 10**15],
        "hashed": rng.integers(-(2**63), 2**63 - 1, n).tolist(),
        "repeated": [None, None, *range(50), *[7] * n],
        "one": [3],
        "none": [],
    }[spread]
    texts = [f"text {i % 40}" if spread != "repeated" or i < 52 else "copy" for i in range(len(ids))]
    rows = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    rows = rows.withColumn("hash", F.xxhash64("text"))
    ordered = [(r.doc_id, r.text) for r in rows.orderBy(F.desc_nulls_last("doc_id"), F.desc("hash")).collect()]
    expected = sorted((str(i), t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered))
    found = syncmers.with_next(rows, size=64).collect()
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in found) == expected


def test_cells_hold_few_texts_whatever_the_ids(spark):
    ids = spark.range(20_000).select(F.when(F.col("id") == 0, 10**15).otherwise(F.col("id")).alias("doc_id"))
    docs = ids.withColumns({"text": F.col("doc_id").cast("string"), "hash": F.xxhash64("doc_id")})
    cells = syncmers.in_cells(docs, 256).groupBy("_ll_cell").count().agg(F.max("count")).first()[0]
    assert cells == 257


def _near_edits(spark, rows):
    """Likeness of each text to itself with its second half replaced by other words."""
    pairs = [(i, t, t[: len(t) - len(t) // 2] + ("other words of no relation " * len(t))[: len(t) // 2]) for i, t in rows]
    both = spark.createDataFrame(pairs, "doc_id long, text string, edited string")
    both = syncmers.with_print(syncmers.with_print(both, "text", "a"), "edited", "b")
    return {r.doc_id: r.near for r in both.select("doc_id", syncmers.likeness("a", "b").alias("near")).collect()}


def test_units_are_as_defined_and_cheap_to_find():
    letters = "B-DF-HJ-NP-Zb-df-hj-np-z"
    plain = rf"[{letters}]{{0,7}}[^\x09-\x0D\x20{letters}]|[{letters}]{{1,8}}"
    rng = np.random.default_rng(3)
    ascii_signs, consonants = [chr(c) for c in range(128)], list("bcDfgHjklmnpqrStuUvwxyz a0")
    for size in range(200):
        text = "".join(rng.choice([*ascii_signs, *"é中😀"] if size % 2 else consonants, size=size))
        assert re.findall(syncmers.UNITS, text) == re.findall(plain, text)
    # Java walks through every range of a class, and gives letters back unless told not to
    assert not re.search(r"\w-\w|\\x..-", syncmers.UNITS) and "}+" in syncmers.UNITS


def test_every_half_kept_text_is_near(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").where("text is not null")
    rows = [(r.doc_id, r.text) for r in docs.where(F.size(F.split("text", r"\s+")).between(8, 40)).collect()]
    rng = np.random.default_rng(1)
    letters = "".join(chr(97 + i) for i in rng.integers(0, 26, 3000))
    rows += [(-1, letters), (-2, "".join(chr(0x4E00 + i) for i in rng.integers(0, 5000, 300))), (-3, "q" * 3000)]
    rows += [(-4, rng.bytes(2000).hex())]
    near = _near_edits(spark, rows)
    far = {i: x for i, x in near.items() if x == 0}
    assert len(near) > 200 and not far, (len(far), len(near), [t for i, t in rows if i in far][:3])
    cut = spark.createDataFrame([(1, letters, "x" + letters[:1500] + "y" + letters[1500:])], "doc_id long, a string, b string")
    cut = syncmers.with_print(syncmers.with_print(cut, "a", "p"), "b", "q")
    assert cut.select(syncmers.likeness("p", "q")).first()[0] > 0.9


def test_anchors_match_brute_force(spark):
    texts = [t for _, t in _documents(spark)][:30] + ["", "a", "ab cd", " \t x ", "naïve café 42!", "bcdfghjklmnp", "日本語のテキスト"]
    marked = syncmers.with_anchors(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "text", "anchors").collect()
    k, s, enders = syncmers.K, syncmers.S, set("aeioAEIO")
    runs = {}
    for r in marked:
        units = []
        for word in re.split(r"[\x09-\x0D\x20]+", r.text):
            unit = ""
            for c in word:
                if len(unit) == 8:
                    units.append(unit)
                    unit = ""
                unit += c
                if not (c.isascii() and c.isalpha()) or c in enders:
                    units.append(unit)
                    unit = ""
            units += [unit] * bool(unit)
        padded = units + [""] * (k - 1) * bool(units)
        pairs = [tuple(padded[i : i + s]) for i in range(len(padded) - s + 1)]
        runs[r.doc_id] = (padded, pairs, [a.at for a in r.anchors], [a.hash for a in r.anchors])
    pairs = sorted({p for x in runs.values() for p in x[1]})
    held = spark.createDataFrame(list(enumerate(pairs)), "i long, p array<string>")
    hashed = {tuple(r.p): r.h for r in held.select("p", F.xxhash64(F.xxhash64(F.col("p")[0]), F.xxhash64(F.col("p")[1])).alias("h")).collect()}
    seen = {}
    for padded, own, places, names in runs.values():
        expected = []
        for i in range(len(padded) - k + 1):
            inner = [hashed[p] for p in own[i : i + k - s + 1]]
            if min(inner) in (inner[0], inner[-1]):
                expected.append(i)
        assert places == expected
        for i, name in zip(places, names, strict=True):
            assert seen.setdefault(name, padded[i : i + k]) == padded[i : i + k]


def test_tokens_match_rank_merging(spark):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(path), special_tokens={})
    rows = {r.doc_id: r for r in QUERIES["op7_byte_bpe"](spark, SF).collect()}
    for doc_id, text in _documents(spark):
        ids = np.array(plain.encode_ordinary(text), dtype="<u4").tobytes()
        assert rows[doc_id].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert rows[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_long_texts_with_old_and_new_pieces(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    encoder = bpe.PieceEncoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = ["one two three four five", "one six seven eight nine ten two", "six one"]
    fresh = [bpe.PieceEncoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).encode(t) for t in texts]
    assert [encoder.encode(t) for t in texts] == fresh


def test_token_offsets_share_split_characters(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.createDataFrame([(1, "a 😀 é"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path, offsets=True).collect()}
    pairs = np.array(rows[1].offsets).reshape(-1, 2)
    assert pairs[0][0] == 0 and pairs[-1][1] == 5 and (pairs[:, 0] < pairs[:, 1]).all()
    assert rows[2].ids == b"" and rows[2].offsets == []


def test_round_trip_takes_one_worker_and_equals_both_steps(spark, odd):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    plan = bpe.digests(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # each takes a worker of its own for every core
    one = bpe.round_trip(odd, path, public_tokenizers.PATTERN, offsets=True)
    two = bpe.decode(bpe.encode(odd, path, public_tokenizers.PATTERN), path, offsets=True)
    assert one.schema == two.schema and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic")
    scored = {r.doc_id: r for r in QUERIES["op6_toxicity"](spark, sf).collect()}
    held = [(scored[r.doc_id].score, r.toxic) for r in labels.collect() if scored[r.doc_id].held_out]
    assert np.mean([s for s, t in held if t]) > 2 * np.mean([s for s, t in held if not t])
    kept = {r.doc_id: r.kept for r in QUERIES["op8_quality_classifier"](spark, sf).collect()}
    right = [kept[r.doc_id] == bool(r.quality) for r in labels.collect()]
    assert np.mean(right) > 0.95 and len(kept) == 1000


def test_toxic_rows_of_each_language_are_found(spark):
    sf = "/root/testdata/sf0.1"
    scored = QUERIES["op6_toxicity"](spark, sf).where("held_out")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = scored.join(labels, "doc_id").join(docs, "doc_id").groupBy("lang").agg(
        F.sum("toxic").alias("n"), F.sum(F.col("toxic") * F.col("predicted")).alias("found"),
        F.sum((1 - F.col("toxic")) * F.col("predicted")).alias("alarms"),
    ).collect()
    print(rows)
    share = {r.lang: r.found / r.n for r in rows}
    assert len(share) == 4 and min(share.values()) >= 0.5 and sum(r.found for r in rows) >= 80 and sum(r.alarms for r in rows) <= 4


def test_prefixes_of_words_and_terms(spark):
    texts = ["Schulhaus schulbuch", "Müllers müll", "women womenfolk muslims muslim", "", "ab, cd", "xy schulhof"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("toxic", F.lit(0))
    own = {r.doc_id: set(r.words) for r in toxicity.word_buckets(docs.select("doc_id", "toxic", "text")).collect()}
    assert {i: len(own[i]) for i in own} == {0: 3, 1: 3, 2: 4, 3: 0, 4: 2, 5: 3}
    assert len(own[0] & own[5]) == 1  # the prefix, also next to the end of a row
    assert set(toxicity.identity_buckets()) & own[2] and not own[0] & own[1]


def test_swapped_terms_get_near_equal_weights():
    terms = np.array([0, 1])
    x = np.array([[1, 0, 1], [0, 1, 0], [1, 0, 1], [0, 1, 0]], dtype=float)
    planted, swapped = toxicity._swap(x, terms)
    y = np.array([1.0, 0, 1, 0])
    free = toxicity._fit(planted, swapped, y, 0.0)
    tied = toxicity._fit(planted, swapped, y, 10.0)
    assert abs(tied[0] - tied[1]) < 0.1 * abs(free[0] - free[1])


def test_fold_of_deltas_edits_and_regenerations(spark):
    one, two = (0, "a"), (1, "b")
    log = [
        (1, one, 0, "message", "user", "hi <turn:x> \\b"), (1, two, 1, "message", "assistant", None),
        (1, two, 2, "delta", None, "wrong"), (1, two, 3, "regenerate", None, None), (1, two, 4, "delta", None, "go"),
        (1, two, 5, "delta", None, "od"), (1, one, 6, "edit", None, "hello </turn>"), (1, two, 7, "delta", None, "!"),
    ]
    events = spark.createDataFrame(log, "conv_id long, message_id struct<turn:long,k:string>, seq long, kind string, role string, text string")
    parts = chat.rendered(chat.folded(events))
    row = parts.select(chat.parsed_turns(F.col("formatted")).alias("t"), chat.masked_texts(F.col("formatted"), F.col("loss")).alias("m")).first()
    assert [tuple(t) for t in row.t] == [("user", "hello </turn>"), ("assistant", "good!")] and row.m == ["good!"]
    assert chat.rendered(chat.folded(events.limit(0))).count() == 0


def test_repeated_turns_and_long_conversations(spark):
    turns = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(300)] + [(1, 5, "assistant", "t5"), (None, None, None, None)]
    parts = chat.rendered(chat.folded(chat.turn_log(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))))
    rows = {r.conv_id: r.n for r in parts.groupBy("conv_id").agg(F.sum("n_turns").alias("n")).collect()}
    assert rows == {1: 301, None: 1} and parts.where("conv_id = 1").count() > 4


def test_odd_rows_of_line_dedup(spark):
    block = "a\nb\nc"
    rows = [(1, block + "\nd", "z"), (2, "x\n" + block, None), (3, None, None), (4, "", None), (5, "a\na\na\na\na", None), (5, "a\na\na\na\na", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 string")
    left = line_dedup.dedup_lines(docs)
    assert sorted((r.doc_id, r.text) for r in left.collect() if r.doc_id != 5) == [(1, "a\nb\nc\nd"), (2, "x"), (3, None), (4, "")]
    assert [r.text for r in left.where("doc_id = 5").collect()] == ["a", "a"]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_odd_rows_of_minhash(odd):
    rows = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert rows[(2, 56)] == (1, False) and rows[(5, 57)] == (1, False) and rows[(1, 56)] == (1, True)
    assert rows[(3, 0)] == (3, True) and rows[(4, 0)] == (4, True) and rows[(None, 1)] == (None, True)
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_star_of_copies_around_a_later_original(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(100, " ".join(words))]
    for i in range(30):  # each copy is close to the original, less so to other copies
        own = list(words)
        for k in range(4):
            own[(i * 6 + k * 47) % 200] = f"edit{i}x{k}"
        rows.append((i, " ".join(own)))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in found} == {0}


def _jaccard_percent(one, other):
    both = len(np.intersect1d(one, other))
    return 100 * both, len(one) + len(other) - both


@pytest.mark.parametrize("percent", [50, 75, 100])
def test_prefixes_lose_no_pair(spark, percent):
    rng = np.random.default_rng(3)
    full = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(rng.choice(full[: rng.integers(4, 60)], rng.integers(1, 80))) for _ in range(60)]
    sets += [full[:150], full[:140], np.append(full[:150], full[300:350]), full[:1], full[399:]]
    for size, common in ((137, 104), (100, 75), (100, 86)):  # around the limit, equal sizes
        for _ in range(4):
            sets.append(np.append(full[:common], rng.integers(0, 1 << 63, size - common, dtype=np.uint64)))
    held = spark.createDataFrame([(i, bytearray(np.sort(x).tobytes())) for i, x in enumerate(sets)], "doc_id long, shingles binary")
    component = [i % 7 for i in range(len(sets))]
    members = spark.createDataFrame(list(enumerate(component)), "id long, component long")
    found = {(r.a, r.b) for r in minhash.prefix_pairs(held, members, percent).collect()}
    assert all(component[a] != component[b] and a < b for a, b in found)
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            both, union = _jaccard_percent(sets[a], sets[b])
            if component[a] != component[b] and both >= percent * union:
                assert (a, b) in found


def test_shared_boilerplate_brings_no_pairs_together(spark):
    common = np.arange(1, 105, dtype=np.uint64)
    sets = [np.append(common, np.arange(1000 + 33 * i, 1033 + 33 * i, dtype=np.uint64)) for i in range(3000)]
    held = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "doc_id long, shingles binary")
    assert minhash.prefix_pairs(held, held.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("component")), 75).count() == 0


def _long_text(seed, n):
    words = ["women", "café", "漢字" * 9, "a", "the", "longerword", "x" * 40, "\n", "MEN", "12", "old-young", *map(str, range(3000))]
    return " ".join(np.random.default_rng(seed).choice(words, n)) + "漢字" * 50_000 + "y" * 300_000


def test_pieces_of_long_texts_equal_the_whole(monkeypatch):
    raw = np.frombuffer(_long_text(1, 200_000).encode(), np.uint8)
    bounds = np.array([0, len(raw)])

    def results():
        return [minhash.shingle_sets(bounds, raw)[0], *quality._shares(bounds, raw), np.unique(toxicity._buckets(bounds, raw)[0])]

    pieces = results()
    small = raw[:3000]
    whole = batches.word_hashes(np.array([0, 3000]), small)[0]
    for size in (1, 2, 3, 7, 64):
        assert np.array_equal(np.concatenate(list(batches.streamed_word_hashes(batches.cut(small, size)))), whole)
    for module in (minhash, quality, toxicity):
        monkeypatch.setattr(module, "CHUNK_BYTES", 1 << 40)
    assert all(np.array_equal(a, b) for a, b in zip(pieces, results(), strict=True))


def test_memory_of_a_text_of_50_mb():
    text = _long_text(2, 300_000)
    raw = np.frombuffer((text * (50_000_000 // len(text.encode()) + 1)).encode(), np.uint8)
    bounds, column = np.array([0, len(raw)]), pa.array([raw.tobytes().decode()])

    def names():
        for _, base, offsets, part in batches.text_pieces(column, suffixes.LENGTH - 1):
            suffixes.Names(offsets, part, base)

    steps = [lambda: minhash.shingle_sets(bounds, raw), lambda: quality._shares(bounds, raw), lambda: toxicity._buckets(bounds, raw), names]
    for step in steps:
        tracemalloc.start()
        step()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 8 * len(raw)


def test_repeats_across_pieces_match_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, n).astype(np.uint8) for n in (700_000, 900_000, 120_000)]
    for at in (262_100, 262_144, 524_200, 524_288 - 49, 650_000):  # at and across the ends of pieces
        texts[1][at + 90 : at + 290] = texts[0][at : at + 200]
    texts[1][786_400 - 20 : 786_400 + 40] = texts[0][5_000:5_060]
    texts[2][1_000:61_000] = texts[1][240_000:300_000]
    expected, seen = {}, set()
    for i, raw in enumerate(texts):
        data = raw.tobytes()
        own = [data[k : k + 50] for k in range(len(data) - 49)]
        gone = np.zeros(len(data), dtype=bool)
        for k, string in enumerate(own):
            if string in seen:
                gone[k : k + 50] = True
        seen.update(own)
        expected[i] = (int(gone.sum()), raw[~gone].tobytes())
    docs = spark.createDataFrame([(i, raw.tobytes().decode()) for i, raw in enumerate(texts)], "doc_id long, text string")
    assert expected[1][0] >= 700 and expected[2][0] >= 60_000
    assert {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffixes.without_repeats(docs).collect()} == expected


def test_filters_of_repeats_grow_with_their_names(spark, monkeypatch):
    names = batches.mixed(np.arange(60_000, dtype=np.uint64))
    others = batches.mixed(np.arange(1 << 40, (1 << 40) + 60_000, dtype=np.uint64))
    for n in (0, 60_000):
        table = spark.createDataFrame([(int(x),) for x in names[:n].view(np.int64)], "name long")
        for most in (5, 1 << 15):  # blocks a slice
            monkeypatch.setattr(suffixes, "SLICE_BLOCKS", most)
            filters = suffixes._filters_of(table)
            held = np.sum([x.holds(names[:n]) for x in filters], axis=0)
            total = max(1, -(-n * suffixes.BITS_A_NAME // suffixes.BLOCK_BITS))
            assert len(filters) == -(-total // most) and all(len(x.bits.value) <= most * 4096 for x in filters)
            assert (held == 1).all() and sum(x.holds(others).mean() for x in filters) < 0.02


def test_slices_of_filters_find_the_same_repeats(spark, monkeypatch):
    rng = np.random.default_rng(6)
    shared = ["".join(map(chr, rng.integers(97, 123, int(n)))) for n in rng.integers(20, 160, 12)]
    texts = [" ".join(shared[j] for j in rng.integers(0, 12, 6)) for _ in range(30)]
    expected, seen = {}, set()
    for i, text in enumerate(texts):
        own, gone = [text[k : k + 50] for k in range(len(text) - 49)], np.zeros(len(text), dtype=bool)
        for k, string in enumerate(own):
            if string in seen:
                gone[k : k + 50] = True
        seen.update(own)
        expected[i] = (int(gone.sum()), "".join(c for c, g in zip(text, gone, strict=True) if not g).encode())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(suffixes, "BITS_A_NAME", 200)  # several blocks
    monkeypatch.setattr(suffixes, "SLICE_BLOCKS", 2)
    assert {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffixes.without_repeats(docs).collect()} == expected


def test_repeats_leave_no_shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = blocks.getAllFiles()
        names = (found.apply(i).getName() for i in range(found.size()))
        return {name.split("_")[1] for name in names if name.startswith("shuffle_")}

    docs = spark.createDataFrame([(i, f"{LONG} {i // 2} {LONG[i:]}") for i in range(40)], "doc_id long, text string")
    before = files()
    left = suffixes.without_repeats(docs)
    until = time.time() + 30
    while len(files() - before) > 1 and time.time() < until:
        time.sleep(0.2)
    assert len(files() - before) <= 1 and left.count() == 40  # Spark may still hold the last one


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91)], "a long, b long")
    assert {(r.node, r.component) for r in connected_components(links).collect()} == {(i, 0) for i in range(1, 41)} | {(91, 90)}


def test_spans_of_many_rows_merge_at_once():
    rng = np.random.default_rng(4)
    row = np.sort(rng.integers(0, 40, size=500))
    start = rng.integers(0, 300, size=500)
    end = start + rng.integers(1, 9, size=500)
    rows, runs = suffixes._merged(row, start, end)
    for one in range(41):
        covered = np.zeros(400, dtype=bool)
        for a, b in zip(start[row == one], end[row == one], strict=True):
            covered[a:b] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]])))
        assert runs[rows == one].ravel().tolist() == edges.tolist()


def test_names_in_rows_of_all_sizes_match_plain_windows():
    rng = np.random.default_rng(5)
    sizes = np.array([0, 49, 50, 51, 0, 200, 3, 120, 0])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    raw = rng.integers(97, 99, size=offsets[-1]).astype(np.uint8)
    names = suffixes.Names(offsets, raw)
    windows = [(r, s) for r, n in enumerate(sizes) for s in range(offsets[r], offsets[r] + n - suffixes.LENGTH + 1)]
    assert [(r, s) for r, a, b in zip(names.row, names.low, names.high, strict=True) for s in range(a, b + 1)] == windows
    assert names.back.base is suffixes.Names(offsets[:3], raw[: offsets[2]]).back.base  # powers are made once


def test_odd_rows_of_suffix_dedup(odd):
    rows = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffixes.without_repeats(odd).collect())
    n = len(LONG)
    assert (2, n, n) in rows and (3, 0, 0) in rows and (4, 0, 0) in rows and (7, 300_000, 0) in rows and (5, n + 5, n) in rows
    assert suffixes.without_repeats(odd.limit(0)).count() == 0


def test_anchors_of_texts_beyond_the_place_bits(monkeypatch):
    raw = np.random.default_rng(2).integers(97, 123, 5000).astype(np.uint8)
    raw[3000:3600] = raw[100:700]
    bounds = np.array([0, len(raw)])
    whole = suffixes.Names(bounds, raw)
    monkeypatch.setattr(suffixes, "_PLACE", np.uint64(127))
    names = suffixes.Names(bounds, raw)
    starts = np.arange(len(raw) - suffixes.LENGTH + 1)
    anchors = names._anchors(len(raw))
    assert len(anchors) == len(starts) and ((anchors >= starts) & (anchors < starts + suffixes.SPAN)).all()
    hashes = names.of(np.arange(len(raw) - suffixes.CORE + 1), suffixes.CORE) >> np.uint64(7)
    assert [int(np.argmin(hashes[i : i + suffixes.SPAN])) + i for i in starts] == anchors.tolist()
    assert np.array_equal(whole._anchors(len(raw)), anchors)


def test_odd_rows_of_fingerprints(odd):
    docs = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    rows = syncmers.with_next(docs, size=2).orderBy(F.desc_nulls_last("doc_id"), F.desc("hash")).collect()
    follows = sorted((a.text, b.text) for a, b in zip(rows, rows[1:] + rows[:1], strict=True))
    assert sorted((r.text, r.next_text) for r in rows) == follows  # equal rows may swap places
    marked = syncmers.with_anchors(docs, "text", "anchors")
    assert marked.where("text = ''").first().anchors == [] and marked.limit(0).count() == 0


def test_odd_rows_of_decontamination(spark, odd):
    items = spark.createDataFrame([("b", " ".join(f"w{i}" for i in range(10, 22))), ("a", "Short É"), ("n", None), ("c", LONG)], "item_id string, text string")
    rows = {(r.doc_id, r.text): (r._ll_n_hit, r._ll_items) for r in decontaminate.decontaminate(odd, items).collect()}
    assert rows[(1, LONG)] == (60, ["b", "c"]) and rows[(3, None)] == (0, []) and rows[(None, "short é text")] == (0, [])
    assert decontaminate.decontaminate(odd, items.limit(0)).where("_ll_n_hit > 0").count() == 0
    assert decontaminate.decontaminate(odd.limit(0), items).count() == 0


def test_near_passages_match_brute_force(spark):
    rng = np.random.default_rng(5)
    item = [f"b{i}" for i in range(30)]
    changed = [w if i % 10 != 4 else "other" for i, w in enumerate(item)]
    dropped = [w for i, w in enumerate(item) if i % 10 != 4]
    inserted = [x for i, w in enumerate(item) for x in ([w, "more"] if i % 9 == 4 else [w])]
    texts = [["x", "y"] * 5 + t + ["z"] * 5 for t in (item, changed, dropped, inserted)] + [dropped, item[::-1], item[:9], item[:8], item[11:20]]
    short = [["one", "two", "three"], list("abcde"), ["one"]]
    texts += [["one", "q", "two", "three"], list("abqde"), ["two", "three"], ["a", "b", "c", "q", "q"]]
    texts += [[f"b{k}" for k in rng.integers(0, 6, 40)] for _ in range(20)]
    items = [item, *short, *([f"b{k}" for k in rng.integers(0, 6, 12)] for _ in range(4))]
    held = spark.createDataFrame([(str(i), " ".join(w)) for i, w in enumerate(items)], "item_id string, text string")
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)] + [(-1, None)], "doc_id long, text string")
    expected = {-1: (0, [])}
    for i, words in enumerate(texts):
        hits, found = set(), set()
        for k, own in enumerate(items):
            for a in range(max(1, len(own) - 9)):
                window = own[a : a + 10]
                for start in range(-len(window) - 2, len(words) + 3):
                    at = [[p for p in range(max(0, start + o - 2), min(len(words), start + o + 3)) if words[p] == w] for o, w in enumerate(window)]
                    if sum(map(bool, at)) >= len(window) - (len(window) >= 5):
                        hits.update(p for x in at for p in x)
                        found.add(str(k))
        expected[i] = (len(hits), sorted(found))
    rows = {r.doc_id: r for r in decontaminate.decontaminate(docs, held).collect()}
    assert {i: (r._ll_n_near, r._ll_near_items) for i, r in rows.items()} == expected
    assert [rows[i]._ll_n_hit for i in (1, 2, 3)] == [0, 0, 0] and all("0" in rows[i]._ll_near_items for i in (0, 1, 2, 3, 4))
    assert all(set(r._ll_items) <= set(r._ll_near_items) for r in rows.values())


def test_odd_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.example.ORG/en/12?q"), (1, None), (2, "no scheme"), (3, "x://org"), (4, "x://EXAMPLE.org/es/")], "page_id long, url string")
    rules = spark.createDataFrame(url_filter.RULES, "verdict string, host string, path string")
    rows = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect() if r.host)
    assert rows == [(1, "a.example.org", "/en/12", "example.org/en/1", "block"), (3, "org", "", None, "allow"), (4, "example.org", "/es/", "example.org/es/", "block")]
    assert url_filter.judge_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == 5


def test_samples_by_hash_are_the_lowest_and_sorted_few(spark):
    rows = spark.range(50_000).withColumnRenamed("id", "doc_id")
    hashed = rows.select("doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).collect()
    lowest = {r.doc_id for r in sorted(hashed, key=lambda r: (r.h, r.doc_id))[:500]}
    sample = columns.lowest_by_hash(rows, 500)
    assert {r.doc_id for r in sample.collect()} == lowest
    assert "Filter" in sample._jdf.queryExecution().optimizedPlan().toString()
    assert columns.lowest_by_hash(rows, 50_000).count() == 50_000 and columns.lowest_by_hash(rows.limit(0), 5).count() == 0


def test_odd_rows_of_classifiers(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score_quality(odd, none).where("_ll_keep").count() == len(ODD)
    scored = toxicity.score(odd.select("doc_id", "text"), toxicity.train(odd.select("doc_id", "text"), none.select("doc_id", "toxic")))
    assert {r.score for r in scored.collect()} == {0.5}
    both = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    assert quality.score_quality(odd, both).count() == len(ODD)


def test_pipeline_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == names, name
        out = out.checkpoint() if spark.sparkContext.getCheckpointDir() else out
        assert 0 < out.count() <= docs.count()
        docs = out
    assert minhash.near_duplicates(docs).where("not kept").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and corpus_pipeline.run(spark, SF).count() == last.count()
