"""Document operators against brute force on awkward rows and on a whole small table."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import types
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

from indicator_engine.llm import common
from indicator_engine.llm.common import piece_bytes
from indicator_engine.llm.components import components
from indicator_engine.llm.exact_dedup import exact_dedup
from indicator_engine.llm.language_id import Model, features, fit_svm, has_letter, identify, learn
from indicator_engine.llm.mixing import bucket_digits, mix, mixed_documents
from indicator_engine.llm.near_dedup import near_groups
from indicator_engine.llm.queries import ORACLE, QUERIES
from indicator_engine.llm.sentence_pieces import MEMO_WORDS, Pieces, decode, segment, words_of
from indicator_engine.llm.substring_dedup import remove_repeats
from indicator_engine.llm.token_counts import Memo, Tokenizer, count_tokens, pieces, text_groups
from indicator_engine.llm.token_output import Coder, read_token_files, scaled, token_files, write_token_files
from indicator_engine.session import shared_folder
from tests.oracle_compare import connect, spark_rows, sql_rows

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole(medium):
    rows = duckdb.execute(f"SELECT doc_id, text, lang FROM '{medium}/documents.parquet'").fetchall()
    return rows


def rows_of(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*columns).collect())


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, medium, name):
    columns, rows, _ = spark_rows(QUERIES[name](spark, medium))
    sql_columns, expected, _ = sql_rows(connect(medium), ORACLE[name])
    assert columns == sql_columns
    assert rows == expected and sum(rows.values()) > 0


# ---- token counts and files --------------------------------------------------


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_counts_are_the_library_s(spark, awkward, awkward_rows, nothing, medium, whole):
    expected = Counter(
        (i, len((t or "").encode()), len(ids), len(ids) > 1024)
        for (i, t, *_), ids in zip(awkward_rows, library_ids(r[1] for r in awkward_rows))
    )
    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert rows_of(count_tokens(awkward, BPE), *columns) == expected
    assert count_tokens(nothing, BPE).count() == 0
    expected = {i: len(ids) for (i, *_), ids in zip(whole, library_ids(r[1] for r in whole))}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op1_token_counts"](spark, medium).collect()} == expected


def test_token_counts_of_a_sentencepiece_model(awkward, awkward_rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = Counter((i, len(model.encode(t or ""))) for i, t, *_ in awkward_rows)
    assert rows_of(count_tokens(awkward, PIECES), "doc_id", "n_tokens") == expected


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b", "a \n b", "a\n b", " a", "a ", "it's a  don't　x \x1c y"])
def test_pieces_are_tokenized_alone(text):
    parts = pieces(text)
    assert "".join(parts) == text
    assert sum(map(len, library_ids(parts))) == len(library_ids([text])[0])


def expected_files(rows):
    start, out = 0, {}
    for (i, *_), ids in sorted(zip(rows, library_ids(r[1] for r in rows)), key=lambda x: x[0][0]):
        ids = np.array([*ids, 2], "<u4")
        out[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, awkward, awkward_rows, nothing, medium, whole):
    got = QUERIES["op8_token_output"](spark, medium).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == expected_files(whole)
    folder = shared_folder(spark, "files")
    write_token_files(spark, awkward, folder, BPE)
    rows = sorted(read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in awkward_rows), key=lambda i: (i is not None, i))
    assert [r.start for r in rows] == list(np.cumsum([0, *(r.n_tokens for r in rows)])[:-1])
    expected = Counter(tuple([*ids, 2]) for ids in library_ids(r[1] for r in awkward_rows))
    assert Counter(tuple(r.ids) for r in rows) == expected
    assert token_files(spark, nothing, BPE).count() == 0


def test_damaged_block_is_noticed(spark, awkward):
    folder, broken = shared_folder(spark, "files"), shared_folder(spark, "broken")
    write_token_files(spark, awkward, folder, BPE)
    spark.read.parquet(f"{folder}/symbols").write.parquet(f"{broken}/symbols")
    blocks = spark.read.parquet(f"{folder}/blocks").withColumn("crc32", F.col("crc32") + 1)
    blocks.write.parquet(f"{broken}/blocks")
    with pytest.raises(Exception, match="checksum"):
        read_token_files(spark, broken).collect()


@pytest.mark.parametrize("lengths", [[1], [31, 32, 33], [70_000, 5], [1, 1, 400]])
def test_coder_round_trip(lengths):
    rng = np.random.default_rng(5)
    segments = [rng.zipf(1.3, n).clip(0, 60_000).astype(np.int64) for n in lengths]
    coder = Coder(scaled(np.bincount(np.concatenate(segments))))
    states, words = zip(*coder.encode(segments))
    for ids, back in zip(segments, coder.decode(lengths, list(states), list(words))):
        assert (ids == back).all()


# ---- exact dedup -------------------------------------------------------------


def test_exact_dedup(spark, awkward, awkward_rows, nothing):
    groups = defaultdict(list)
    for i, t, *_ in awkward_rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    expected = Counter()
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[i, keep, len(ids), keep is None or i == keep, hashlib.sha256(norm.encode()).hexdigest()] += 1
    got = exact_dedup(spark, awkward)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected
    assert got.columns.count("kept") == 1
    assert exact_dedup(spark, nothing).count() == 0


def test_ascii_pieces_are_cut_as_the_library_cuts_them():
    """All 128 characters, contractions, runs of white space, words met with and without a space."""
    library, own = tokenizers.Tokenizer.from_file(BPE), Tokenizer(BPE)
    signs = [*map(chr, range(128)), *("  \n'srvdltem" * 4)]
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))
        expected = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert b"".join(own.pieces(pieces(text))) == expected, text


# ---- mixing ------------------------------------------------------------------


def test_pieces_cut_by_bytes_are_those_of_the_library():
    tokenizer, library = Tokenizer(BPE), tokenizers.Tokenizer.from_file(BPE)
    memo = Memo(tokenizer.pieces)
    parts = ["a", "é", "ß", "×", "ɏ", "ɐ", "中", "1", "²", " ", " ", "\n", "\t", "\x1c", "\xa0", "\u2009", "—", "\u0301"]
    parts += [".", ",", ";", "'s", "'", " the", ", ", ".\n", "The", "\uffff", "😀", *tokenizer.special]
    draw = random.Random(5)
    texts = [None, "", *("".join(draw.choices(parts, k=draw.randint(1, 12))) for _ in range(5000))]
    column = pa.array(texts)
    groups = list(text_groups(column, 3000))
    assert len(groups) > 10 and pa.chunked_array(groups).to_pylist() == texts
    got = [ids.tolist() for group in groups for ids in tokenizer.ids_of(group, memo)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in tokenizer.ids_of(pa.array([], pa.string()), memo)] == []


def test_words_before_marks_are_looked_up_once():
    tokenizer = Tokenizer(BPE)
    asked = []
    memo = Memo(lambda words: asked.extend(words) or tokenizer.pieces(words))
    list(tokenizer.ids_of(pa.array(["été the été, the.\nété; the été"]), memo))
    assert Counter(asked) == Counter(["été", " été", " the", ",", ".", "\n", ";"])


def test_mix_meets_targets(awkward, awkward_rows, nothing):
    rows = mix(awkward).collect()
    size = Counter()
    for _, t, _, s in awkward_rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_id = {i: s for i, _, _, s in awkward_rows}
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == size[by_id[r.doc_id]]
        assert (r.position is None) == (r.taken == 0) and 0 <= (r.position or 0) <= 1
        taken[by_id[r.doc_id]] += r.taken
        target[by_id[r.doc_id]] = r.target
    assert all(0 <= target[s] - taken[s] < 1 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert rows_of(mix(awkward), "doc_id", "taken") == rows_of(mix(awkward.repartition(5)), "doc_id", "taken")
    assert mix(nothing).count() == 0


def test_mixed_documents_come_once_per_pass(awkward):
    times = Counter()
    for r in mix(awkward.dropDuplicates(["doc_id"])).collect():
        times[r.doc_id] += -(-r.taken // r["size"]) if r["size"] else 0
    mixed = mixed_documents(awkward.dropDuplicates(["doc_id"]))
    assert mixed.columns == awkward.columns
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == +times


def test_mixtures_are_range_sorted_and_come_again(spark):
    """Two sources of one size tie at all times, and rows with one id have several texts."""
    rows = [(i % 40, " ".join(f"v{i}"[: 2 + i % 2] for _ in range(3)), s) for i in range(60) for s in ("a", "b")]
    rows += [(100 + i, " ", "a") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    told = [r.position for r in mix(frame.repartition(3)).collect()]
    assert told[:60] == [None] * 60 and told[60:] == sorted(told[60:])
    once = [tuple(r) for r in mixed_documents(frame.repartition(3), ramps=(0.0,)).collect()]
    assert once == [tuple(r) for r in mixed_documents(frame.repartition(7), ramps=(0.0,)).collect()]
    plan = mix(frame)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(_at" in plan and "Python" not in plan and "Arrow" not in plan


def test_buckets_of_a_source_grow_with_the_input(spark, monkeypatch, awkward):
    assert [bucket_digits(s) for s in (None, 0, 10**12, 2 * 10**12, 10**14)] == [3, 3, 3, 4, 5]
    plain = rows_of(mix(awkward), "doc_id", "taken", "position")
    monkeypatch.setattr("indicator_engine.llm.mixing.bucket_digits", lambda size: 1)
    assert rows_of(mix(awkward), "doc_id", "taken", "position") == plain


# ---- language ----------------------------------------------------------------


def test_language_accuracy_on_held_out_rows(spark, medium, whole):
    lang = {i: x for i, _, x in whole}
    rows = QUERIES["op2_language_id"](spark, medium).collect()
    assert len(rows) == len(whole)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_rows(awkward, nothing):
    model = learn(awkward)
    got = identify(awkward, model)
    assert set(got.columns) == {*awkward.columns, "lang_pred"}
    for r in got.collect():
        assert (r.lang_pred == "und") == (not has_letter(r.text))
        assert 0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0)
    assert learn(nothing) is None
    assert {r.lang_pred for r in identify(awkward, None).collect()} == {"und"}
    assert identify(nothing, model).count() == 0


def test_one_language_needs_no_machine():
    model = Model(np.eye(3), ["en"] * 3)
    assert model.predict(np.eye(3))[0] == ["en"] * 3


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(1, 0.3, (40, 5)), rng.normal(-1, 0.3, (20, 5))])
    y = np.array([1.0] * 40 + [-1.0] * 20)
    w = fit_svm(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).all()


def test_features_do_not_depend_on_the_batch():
    texts = [b"hello there", b"", b"x", "éü the".encode()]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    together = np.vstack(list(features(data, ends)))
    alone = [next(features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))) for t in texts]
    assert np.allclose(together, np.vstack(alone))


# ---- near duplicates ---------------------------------------------------------


def brute_components(rows, words, threshold):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        own = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
        sets.append((i, own))
    root = {k: k for k in range(len(sets))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            small, large = sorted((len(x), len(y)))
            if i is not None and j is not None and small and 100 * small >= threshold * large:
                common = len(x & y)
                if 100 * common >= threshold * (len(x) + len(y) - common):
                    root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter(
        (i, len(s), c := least.get(find(k)) if i is not None else None, i is None or i == c) for k, (i, s) in enumerate(sets)
    )


NEAR = ("doc_id", "n_shingles", "component_id", "kept")


def test_near_groups_of_awkward_rows(spark, awkward, awkward_rows, nothing):
    rows = [(i, t) for i, t, *_ in awkward_rows]
    assert rows_of(near_groups(spark, awkward, words=3, threshold=85), *NEAR) == brute_components(rows, 3, 85)
    assert near_groups(spark, nothing).count() == 0


def test_near_groups_of_a_whole_table(spark, medium, whole):
    got = QUERIES["op7_near_dedup"](spark, medium)
    expected = brute_components([(i, t) for i, t, _ in whole], 3, 85)
    assert rows_of(got, *NEAR) == expected
    assert 0 < sum(n for (_, _, _, kept), n in expected.items() if not kept) < len(whole)


def test_large_class_in_blocks(spark, monkeypatch):
    """Copies of a text, each with edits of its own, in a class cut into many blocks."""
    import random

    from indicator_engine.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = base[:]
        for at in rng.sample(range(150), rng.choice([1, 2, 3, 6])):
            words[at] = f"e{i}x{at}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near_groups(spark, frame, 3, 85), *NEAR) == brute_components(rows, 3, 85)


def short_pairs(threshold, n_pairs, least=6, most=150):
    """Pairs of sets at the threshold or just above it."""
    rng = np.random.default_rng(5)
    while n_pairs:
        a, b = rng.integers(least, most + 1, 2).tolist()
        # common elements at which a pair of these sizes is linked
        common = -(-threshold * (a + b) // (100 + threshold))
        if common <= min(a, b):
            n_pairs -= 1
            every = rng.integers(0, 2**64 - 1, a + b - common, dtype=np.uint64)
            yield np.sort(every[:a]), np.sort(every[a - common :])


@pytest.mark.parametrize("threshold", [85, 80])
def test_short_sets_at_the_threshold_meet_in_a_band(threshold):
    from indicator_engine.llm import near_dedup as nd

    n_bands = nd.bands(threshold)
    seed = nd.seeds(n_bands * nd.ROWS)
    for a, b in short_pairs(threshold, 2000):
        one, two = nd.sketch(a, seed), nd.sketch(b, seed)
        assert (nd.band_keys(one, n_bands) == nd.band_keys(two, n_bands)).any()


@pytest.mark.parametrize("threshold", [85, 80])
def test_sketches_keep_short_sets_at_the_threshold(threshold):
    from indicator_engine.llm import near_dedup as nd

    size = nd.bands(threshold) * nd.ROWS
    seed, floor = nd.seeds(size), nd.least_agreeing(threshold, size)
    for a, b in short_pairs(threshold, 2000):
        assert (nd.sketch(a, seed) == nd.sketch(b, seed)).sum() >= floor
    need, chances = threshold / 100, 1.0
    for agree in range(floor):
        chances -= math.comb(size, agree) * need**agree * (1 - need) ** (size - agree)
    assert 1 - chances <= nd.MISS / 10 + 1e-12


@pytest.mark.parametrize("threshold", [85, 80])
def test_near_groups_of_short_texts(spark, threshold):
    """Pairs of texts of 6 to 150 shingles at the threshold, against brute force."""
    rows = []
    for a, b in short_pairs(threshold, 600):
        # one-word shingles, so that the sets are what the pair says
        for own in (a, b):
            rows.append((len(rows), " ".join(f"w{x}" for x in own.tolist())))
    expected = brute_components(rows, 1, threshold)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(near_groups(spark, frame, 1, threshold), *NEAR) == expected
    assert sum(n for (_, _, _, kept), n in expected.items() if not kept) == 600


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# ---- repeated passages -------------------------------------------------------


def brute_removal(rows, length=50):
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        if i is not None:
            for p in range(len(data) - length + 1):
                w = data[p : p + length]
                first[w] = min(first.get(w, i), i)
    out = Counter()
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        if i is not None:
            for p in range(len(data) - length + 1):
                if first[data[p : p + length]] < i:
                    gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


REMOVED = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeats_of_awkward_rows(spark, awkward, awkward_rows, nothing):
    rows = [(i, t) for i, t, *_ in awkward_rows]
    assert rows_of(remove_repeats(spark, awkward), *REMOVED) == brute_removal(rows)
    assert remove_repeats(spark, nothing).count() == 0
    kept = remove_repeats(spark, awkward, with_bytes=True)
    assert all(hashlib.sha256(r.kept_bytes).hexdigest() == r.kept_sha256 for r in kept.collect())


def test_repeats_of_a_whole_table(spark, medium, whole):
    expected = brute_removal([(i, t) for i, t, _ in whole])
    assert rows_of(QUERIES["op9_substring_dedup"](spark, medium), *REMOVED) == expected


def test_repeats_in_periodic_and_overlapping_texts(spark, monkeypatch):
    import random

    from indicator_engine.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 500)
    monkeypatch.setattr(substring_dedup, "_SORTED", 300)
    rng = random.Random(9)
    parts = ["".join(rng.choice("ab") for _ in range(rng.choice([30, 49, 50, 51, 80]))) for _ in range(12)]
    rows = [(i, "".join(rng.choice([*parts, "xy" * 40]) for _ in range(4))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(remove_repeats(spark, frame), *REMOVED) == brute_removal(rows)


def test_frequent_line_is_not_sorted_in_one_task(spark, monkeypatch):
    """A line shorter than a window in every document: each place is a phrase of its own under one trigger."""
    import random

    from indicator_engine.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 20_000, raising=False)
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 30_000)
    lowest = substring_dedup._lowest

    def bounded(texts, sizes, least, length):
        if sizes.sum() > 40_000:
            raise ValueError("one trigger's phrases at once")
        return lowest(texts, sizes, least, length)

    monkeypatch.setattr(substring_dedup, "_SORTED", 20_000)
    monkeypatch.setattr(substring_dedup, "_lowest", bounded)
    rng = random.Random(3)
    line = "subscribe to our letter, it is free today"
    passage = "".join(rng.choice("abcdefghij ") for _ in range(200))
    own = lambda n: "".join(rng.choice("klmnopqrst ") for _ in range(n))
    rows = []
    for i in range(2000):
        edge = own(12) if i % 3 else "the same edge"
        rows.append((i, own(60) + edge + (line if i % 2 else passage) + edge + own(60) + "xy" * (i % 40)))
    rows += [(i, t) for i, t in rows[:20]] + [(None, rows[5][1]), (3000, rows[7][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(remove_repeats(spark, frame), *REMOVED) == brute_removal(rows)


# ---- pieces ------------------------------------------------------------------


def brute_segmentations(model, word):
    ids = {t: i for i, t in enumerate(model.text) if i not in model.of_byte and i > 2}
    out = []

    def walk(at, score, path):
        if at == len(word):
            out.append((score, path))
            return
        for end in range(at + 1, min(len(word), at + model.longest) + 1):
            if (p := ids.get(word[at:end])) is not None:
                walk(end, score + model.score[p], [*path, p])
        if word[at] not in ids:
            walk(at + 1, score + model.unknown, path + model.unknown_ids(ord(word[at])))

    walk(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("word", ["▁the", "▁thé😀x", "▁▁▁ab", "▁retitio", "▁ß\n", "▁", "q."])
def test_n_best_of_a_word(word):
    model = Pieces(PIECES)
    every = brute_segmentations(model, word)
    ids, score, gap = model.solve([word])[0]
    assert score == every[0][0]
    assert gap == (every[0][0] - every[1][0] if len(every) > 1 else np.inf)
    assert [s for s, _ in model.n_best(word, 4)] == [s for s, _ in every[:4]]
    assert np.frombuffer(ids, "<i4").tolist() in [p for s, p in every if s == score]


def test_n_best_of_texts(spark):
    model = Pieces(PIECES)
    texts = ["ab the", "to a é", "on  it"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in segment(frame, PIECES, n_best=5, alternatives=True).collect():
        sums = [(0.0, [])]
        for word in words_of(r.text):
            sums = [(s + w, p + q) for s, p in sums for w, q in brute_segmentations(model, word)]
        best = sorted((s for s, _ in sums), reverse=True)[:5]
        assert r.piece_scores == pytest.approx(best)
        every = {tuple(p): s for s, p in sums}
        assert [every[tuple(a)] for a in r.piece_alternatives] == pytest.approx(best)
        assert r.piece_alternatives[0] == r.piece_ids and len({*map(tuple, r.piece_alternatives)}) == len(best)


def test_pieces_decode_to_the_text(spark, awkward, nothing, medium):
    got = decode(segment(awkward, PIECES), PIECES)
    assert {*got.columns} == {*awkward.columns, "piece_scores", "decoded"}
    for r in got.collect():
        assert r.decoded == (r.text or "")
        assert r.piece_scores == sorted(r.piece_scores, reverse=True)
    assert segment(nothing, PIECES).count() == 0
    rows = QUERIES["op5_sentence_pieces"](spark, medium).collect()
    assert len(rows) == 1000 and all(r.round_trip and r.second_score <= r.score for r in rows)


def test_encoding_is_the_library_s(spark, awkward, awkward_rows, medium, whole):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t for _, t, *_ in awkward_rows] + ["  a", "a  ", " ", "   ", "a \u2581 b", "x\u2581y ", "\u2581", "\u4e00 \U0001f600\n"]
    frame = spark.createDataFrame(list(enumerate(texts)), "n long, text string")
    got = {r.n: r.encoded_ids for r in segment(frame, PIECES, encoded=True).collect()}
    assert got == {n: model.encode(t or "") for n, t in enumerate(texts)}
    expected = {i: len(model.encode(t or "")) for i, t, _ in whole}
    assert {r.doc_id: r.n_pieces for r in QUERIES["op5_sentence_pieces"](spark, medium).collect()} == expected


def test_slabs_of_words_stay_small(monkeypatch):
    model, sizes = Pieces(PIECES), []
    lattices = model.lattices
    monkeypatch.setattr(model, "lattices", lambda words: sizes.append(len(words) * max(map(len, words))) or lattices(words))
    words = [f"▁{i:05d}" for i in range(20_000)]
    solved = model.solve(words)
    assert max(sizes) <= 1 << 14 and len(solved) == len(words)


def test_words_met_before_are_kept():
    asked = Counter()
    memo = Memo(lambda words: asked.update(words) or words, MEMO_WORDS)
    words = [str(i) for i in range(140_000)]
    for _ in range(2):
        for at in range(0, len(words), 10_000):
            memo.of(set(words[at : at + 10_000]))
    assert max(asked.values()) == 1


def test_decoding_of_bytes_and_signs():
    model = Pieces(PIECES)
    assert [model.as_bytes[i] for b, i in sorted(model.byte.items())] == [bytes([b]) for b in sorted(model.byte)]
    for text in ["a\nb", " x  y\n", "中文 é\x00", "😀\n the"]:
        assert model.decode(np.array(model.library.encode(text))) == model.library.decode(model.library.encode(text))
    broken = np.array([model.byte[0xE2], model.library.piece_to_id("▁the")])
    assert model.decode(broken) == "\ufffd the"


def test_memory_goes_back_with_the_values_of_a_stage(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    monkeypatch.setitem(sys.modules, "corpus_worker_values", types.ModuleType("corpus_worker_values"))
    for group in ("a", "a", "b", "a"):
        common.worker_wide("value", list, group)
    assert len(calls) == 3


def test_all_segmentations_are_returned(spark, small):
    rows = QUERIES["op5_sentence_pieces"](spark, small).collect()
    for r in rows:
        assert len(r.n_best_scores) == len({*r.n_best_hashes}) == r.n_segmentations
        assert r.n_best_scores[0] == r.score and r.n_best_scores == sorted(r.n_best_scores, reverse=True)
    assert max(r.n_segmentations for r in rows) == 4


def test_pieces_of_sorted_inputs_grow_with_the_input():
    mb, gb = 1 << 20, 1 << 30
    assert [piece_bytes(n, 8, 16) for n in (0, gb, 4 * gb, 16 * gb, 10**5 * gb)] == [8 * mb, 8 * mb, 8 * mb, 16 * mb, 128 * mb]
    assert piece_bytes(10**5 * gb, 6) == 6 * mb
