"""Mixing, packing, quality rules, scoring, shards, archives and chat formats."""

import collections
import json
import pickle
import zlib

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cabwise.llm import chat, fertility, mixing, packing, ppm, token_shards, tokens, warc
from cabwise.llm.common import Words
from cabwise.llm.template import Const, Print, Template, TemplateError
from conftest_paths import SF_SMOKE, documents_of
from oracle_harness import compare


def test_op1_against_sql(spark):
    got = compare(spark, SF_SMOKE, "op1", mixing.op1_mixing, mixing.OP1_SQL)
    assert got["cols_match"] and got["types_match"] and got["hash_match"], got


def test_mix_comes_near_its_targets(spark):
    rows = mixing.op1_mixing(spark, SF_SMOKE.replace("0.001", "0.1")).collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert r.taken <= 3 * r.size
        by[r.source_size, r.target].append(r)
    assert abs(sum(t for _, t in by) - sum(r.size for r in rows)) < 1
    for (_, target), own in by.items():
        assert abs(sum(r.taken for r in own) - target) <= 2 * max(r.size for r in own)


def test_mix_edge_rows(spark):
    docs = plain.edge_docs(spark)
    mixed = mixing.copies_of(docs)
    got = mixed.select("doc_id", "source", "mix.*").collect()
    assert len(got) == len(plain.EDGE) and mixed.columns == docs.columns + ["mix"]
    sizes = [r.size for r in got if r.doc_id in (1, 2, 3)]
    assert sizes == [0, 0, 0] and all(0 <= r.copies <= 3 for r in got)
    assert {r.source for r in got} == {"a", "b", "c", "", "é", None}
    emitted = mixing.emit(mixed)
    assert emitted.columns == docs.columns and emitted.count() == sum(r.copies for r in got)
    assert mixing.copies_of(plain.no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.copies_of(docs, out="size")


def test_targets_share_the_excess(spark):
    sources = spark.createDataFrame([("a", 1, 5.0), ("b", 100, 2.0), ("c", 100, 1.0)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.target_words(sources).collect()}
    assert got == {"a": 3.0, "b": pytest.approx(132.0), "c": pytest.approx(66.0)}


def test_packing_of_documents(spark):
    docs = documents_of(spark, "sf0.001")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    packed = packing.pack_documents(docs, with_ids=True).cache()
    got = packed.collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(plain.pieces(rows))
    n = plain.check_packing([(r.length, r.sequence_id, r.offset) for r in got])
    assert n <= -(-sum(r.length for r in got) // 2048) + 1
    whole = {r.sequence_id: np.frombuffer(bytes(r.ids), "<u4") for r in packing.sequences(packed).collect()}
    assert len(whole) == n
    assert all(zlib.crc32(whole[r.sequence_id][r.offset:r.offset + r.length].tobytes()) == r.ids_crc32 for r in got)


def test_packing_edge_rows(spark):
    key = lambda x: (x[0] is None, *x)
    got = packing.pack_documents(plain.edge_docs(spark)).collect()
    want = plain.pieces([(d, t) for d, t, _, _ in plain.EDGE])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    plain.check_packing([(r.length, r.sequence_id, r.offset) for r in got])
    assert packing.pack_documents(plain.no_docs(spark)).count() == 0


def fewest(lengths, capacity):
    """The least number of bins, by trying all."""
    best = len(lengths)

    def put(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity and bins[k] not in bins[:k]:
                put(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1:])
        put(i + 1, bins + [lengths[i]])

    put(0, [])
    return best


def test_bin_completion_finds_the_least():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = sorted(rng.integers(1, 60, rng.integers(1, 11)).tolist(), reverse=True)
        patterns = packing.bin_completion(dict(collections.Counter(lengths)), 100)
        used = collections.Counter()
        for filling, times in patterns:
            assert sum(a * n for a, n in filling) <= 100
            for a, n in filling:
                used[a] += n * times
        assert used == collections.Counter(lengths)
        assert sum(n for _, n in patterns) == fewest(lengths, 100)


def test_the_lower_bound_holds():
    rng = np.random.default_rng(6)
    for _ in range(100):
        lengths = sorted(rng.integers(1, 101, rng.integers(1, 9)).tolist(), reverse=True)
        bound = packing.least_sequences(dict(collections.Counter(lengths)), 100)
        assert -(-sum(lengths) // 100) <= bound <= fewest(lengths, 100)


def test_fillings_are_the_fullest():
    rng = np.random.default_rng(7)
    for _ in range(100):
        counts = dict(collections.Counter(rng.integers(2, 60, rng.integers(1, 9)).tolist()))
        reach = {0}
        for a, n in counts.items():
            reach = {r + a * k for r in reach for k in range(n + 1) if r + a * k <= 80}
        found = packing.fillings(counts, 80)
        assert found[0][0] == 80 - max(reach)
        for waste, held in found:
            assert all(0 < n <= counts[a] for a, n in held.items())
            assert waste == 80 - sum(a * n for a, n in held.items())


def test_subset_sums_beat_best_fit():
    rng = np.random.default_rng(8)
    counts = dict(collections.Counter((300 + rng.exponential(500, 4000)).astype(int).clip(1, 2047).tolist()))
    n = sum(k for _, k in packing.bin_completion(counts, 2048))
    assert n < sum(k for _, k in packing.best_fit(counts, 2048))
    assert n <= 1.003 * packing.least_sequences(counts, 2048)


def test_the_search_grows_with_the_number_of_lengths(monkeypatch):
    rng = np.random.default_rng(3)
    counts = dict(collections.Counter(rng.integers(690, 1000, 400).tolist()))  # best fit is over the bound, and stays
    tried, own = [], packing.fillings
    monkeypatch.setattr(packing, "fillings", lambda *x: tried.append(1) or own(*x))
    monkeypatch.setattr(packing, "NODES", 40)
    packing.bin_completion(counts, 2048)
    most = len(tried)
    tried.clear()
    packing.bin_completion(counts, 2048, 40)
    assert len(tried) <= 41 < most
    assert packing.steps(dict.fromkeys(range(1, 2048), 1)) >= 20_000


def test_word_cache_equals_the_tokenizer():
    words = ["The", "the,", "don't", "DON'T.", "a's", "x.y", "<|endoftext|>", "<|ENDOFTEXT|>", "é", "E\u0301t\u00c9,", "J\u030c", "１２",
             "a1b2", "--", "'", "İ", "ΑΣ", "ß!", "\u00a0x", "\x85", "日本語", "l'été.", "A'", "x\u200b.", "it's,"]
    got, ends = tokens.text_ids(pa.array([" ".join(words), None, *words]), tokens.vocabulary_path("word_bpe_49k.json"))
    want = [x[:-1] for x in plain.token_ids([" ".join(words), None, *words])]
    assert [got[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want


def test_quality_metrics_against_plain(spark):
    docs = documents_of(spark, "sf0.001").unionByName(plain.edge_docs(spark).select("doc_id", "text", "lang", "source"), allowMissingColumns=True)
    texts = collections.Counter((r.doc_id, *plain.base_rules(r.text)) for r in docs.collect())
    got = fertility.quality_metrics(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == texts
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = fertility.keep_clean(docs)
    assert kept.columns == docs.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(r.doc_id for r in got if r.kept)
    assert fertility.quality_metrics(plain.no_docs(spark)).count() == 0 and fertility.keep_clean(plain.no_docs(spark)).count() == 0


def test_fertility_against_the_vocabulary_itself():
    path = tokens.vocabulary_path(fertility.VOCABULARY)
    model, _ = tokens.sentence_piece(path)
    texts = ["the quick brown fox " * 20, "🜁🜂 𒀀𒀁 x", "Привет мир", ""]
    got = fertility.measure(pa.array(texts), pa.array(["en", None, None, None], pa.string()), path)
    for i, text in enumerate(texts):
        ids = [t for w in text.split() for t in model.encode(w)]
        n = collections.Counter(ids)
        entropy = -sum(c / len(ids) * np.log2(c / len(ids)) for c in n.values()) if ids else 0.0
        assert got["n_tokens"][i] == len(ids) and got["token_entropy"][i] == pytest.approx(entropy, abs=1e-9)
        assert got["byte_share"][i] == pytest.approx(sum(map(model.is_byte, ids)) / max(1, len(ids)))


def test_bands_reject_noise_and_keep_prose(spark):
    rng = np.random.default_rng(2)
    noise = " ".join("".join(chr(x) for x in rng.integers(0x12000, 0x12300, 6)) for _ in range(80))
    things = ["house", "river", "city", "garden", "road", "winter", "morning", "valley", "people", "water", "stone"]
    prose = " ".join(f"{things[i * 3 % 11]} near {things[i * 7 % 11]}{'s' * (i % 2)} {'under' if i % 3 else 'over'} number {i}" for i in range(30))
    cyrillic = "В начале было слово и люди шли по дороге к большому городу где стоял старый дом у реки " * 1
    more = " ".join(f"слово{i} дорога{i * 7 % 13}" for i in range(40))
    docs = spark.createDataFrame([(1, noise, "en", "a"), (2, prose, "en", "a"), (3, cyrillic + more, "ru", "a")], plain.SCHEMA)
    assert {r.doc_id for r in fertility.keep_clean(docs).collect()} == {2, 3}


def test_bands_reject_letters_at_random_and_dense_mojibake(spark):
    rng = np.random.default_rng(4)
    noise = [" ".join("".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(3, 9))) for _ in range(200)) for _ in range(20)]
    langs = ["en", "de", "fr", "es"]
    rows = [(i, text, langs[i % 4], "a") for i, text in enumerate(noise)]
    accents = " ".join(f"été{i} forêt à côté où déjà élève{i % 7} père" for i in range(30))
    rows.append((20, accents.encode().decode("latin-1"), "fr", "a"))
    assert fertility.keep_clean(spark.createDataFrame(rows, plain.SCHEMA)).count() == 0


def test_bands_keep_the_documents_of_known_languages(spark):
    got = fertility.quality_metrics(documents_of(spark, "sf0.001")).join(documents_of(spark, "sf0.001").select("doc_id", "lang"), "doc_id")
    assert got.where("lang IN ('en', 'de', 'fr', 'es') AND NOT base_failed AND NOT kept").count() == 0


@pytest.mark.parametrize("order", [0, 1, 3, 5])
def test_ppm_against_its_definition(order):
    rng = np.random.default_rng(order)
    train = ["".join(rng.choice(list("abAc é"), rng.integers(0, 50))) for _ in range(30)]
    texts = [*train[:3], "", "zzz", "éé aa", "q" * 40, *("".join(rng.choice(list("abAdcé"), 30)) for _ in range(8))]
    keys = ppm.context_keys(pa.array(train), order)[0]
    edges = [np.unique(keys & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True) for k in range(order + 1)]
    keys, starts = ppm.context_keys(pa.array(texts), order)
    got = ppm.row_sums(ppm.log_probabilities(ppm.build_levels(edges), keys), starts)
    assert got == pytest.approx([plain.ppm_log10(train, order, t) for t in texts])


def scored(spark, docs):
    own = docs.select("doc_id", ppm.is_held_out().alias("held_out"), "text")
    model, rare, n = ppm.train(own.where("not held_out"))
    return ppm.score(own, model, rare, n)


def base_scores(rows):
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    words = [(t or "").encode().lower().split() + [None] for _, t in rows]
    counts = collections.Counter(w for (d, _), own in zip(rows, words) if not held(d) for w in own)
    n, v = sum(counts.values()), len(counts)
    return [(d, held(d), len(own), sum(counts[w] > 0 for w in own), n,
             round(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), 5)) for (d, _), own in zip(rows, words)]


@pytest.mark.parametrize("most_words", [1 << 22, 100])
def test_scores_of_documents(spark, monkeypatch, most_words):
    monkeypatch.setattr(ppm, "MAX_WORDS", most_words)  # few: rare words are joined
    docs = documents_of(spark, "sf0.001")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = scored(spark, docs).collect()
    key = lambda x: (x[0] is None, x)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=key) == sorted(base_scores(rows), key=key)
    train = [t for (d, t), r in zip(rows, base_scores(rows)) if not r[1]]
    some = dict(rows[:6])
    by = {r.doc_id: r.score for r in got}
    for doc, text in list(some.items())[:2]:
        assert by[doc] == pytest.approx(plain.ppm_log10(train, ppm.ORDER, text))


def test_scores_edge_rows(spark):
    got = scored(spark, plain.edge_docs(spark)).collect()
    rows = [(d, t) for d, t, _, _ in plain.EDGE]
    key = lambda x: (x[0] is None, x)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=key) == sorted(base_scores(rows), key=key)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert scored(spark, plain.no_docs(spark)).count() == 0


def test_bounded_models_still_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(ppm, "MAX_EDGES", 60)
    docs = documents_of(spark, "sf0.001").select("text")
    model, _, _ = ppm.train(docs)
    assert all(len(level.edges.keys) <= 256 ** 2 for level in model.levels[:1])
    for context in (b"\xff" * 5, b"the a", b"zqzqz"):
        base = sum(b << 8 * (5 - i) for i, b in enumerate(context))
        keys = np.arange(256, dtype=np.uint64) + np.uint64(base)
        assert (10.0 ** ppm.log_probabilities(model.levels, keys)).sum() == pytest.approx(1.0)


@pytest.mark.parametrize(("most", "part"), [(60, 1 << 18), (3000, 50), (0, 1 << 18)])
def test_scores_beyond_the_bound_are_those_of_the_whole_model(spark, monkeypatch, most, part):
    docs = documents_of(spark, "sf0.001")
    want = {r.doc_id: r.score for r in scored(spark, docs).collect()}  # checked against the definition above
    monkeypatch.setattr(ppm, "MAX_EDGES", most)
    monkeypatch.setattr(ppm, "PART_ROWS", part)
    got = {r.doc_id: r.score for r in scored(spark, docs).collect()}
    assert got == pytest.approx(want)


def test_rare_bytes_keep_their_counts_in_short_contexts(spark, monkeypatch):
    monkeypatch.setattr(ppm, "MAX_EDGES", 40)  # the longest order's threshold is far above the rare bytes' counts
    rows = [(i, "the old road " * 30) for i in range(40)] + [(100 + i, f"ж{i} ß é ж") for i in range(10)]
    got = {r.doc_id: (r.held_out, r.score) for r in scored(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    train = [t for d, t in rows if not got[d][0]]
    assert {got[d][0] for d in range(100, 110)} == {False, True}
    for doc, text in rows[-10:]:
        assert got[doc][1] == pytest.approx(plain.ppm_log10(train, ppm.ORDER, text))


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        slots = token_shards.feistel(np.arange(n), n)
        assert sorted(slots.tolist()) == list(range(n))
        assert n < 64 or slots.tolist() != token_shards.feistel(np.arange(n), n, key=1).tolist()


def test_token_shards_round_trip(spark):
    docs = documents_of(spark, "sf0.001").coalesce(1)
    rows = docs.collect()
    flat = np.concatenate([np.array(x, "<u2") for x in plain.token_ids([r.text for r in rows])])
    ends = np.cumsum([len(x) for x in plain.token_ids([r.text for r in rows])])
    shards, own = token_shards.materialise(docs, per_shard=16)
    n = -(-len(flat) // 2048)
    slots = token_shards.feistel(np.arange(n), n).tolist()
    got = {r.slot: bytes(r.ids) for r in shards.read().collect()}
    assert got == {s: flat[k * 2048:(k + 1) * 2048].tobytes() for k, s in enumerate(slots)}
    assert {r.slot for r in shards.read(from_slot=37).collect()} == set(range(37, n))
    held = {r.slot: r.doc_ids for r in own.collect()}
    for k, s in enumerate(slots):
        a, b = (np.searchsorted(ends, x, side="right") for x in (k * 2048, min((k + 1) * 2048, len(flat)) - 1))
        assert held[s] == [r.doc_id for r in rows[a:b + 1]]


def test_token_shards_edge_rows(spark):
    shards, own = token_shards.materialise(plain.edge_docs(spark), per_shard=4)
    lengths = sum(len(x) for x in plain.token_ids([t for _, t, _, _ in plain.EDGE]))
    got = shards.read().collect()
    assert sum(r.n_tokens for r in got) == lengths and sorted(r.slot for r in got) == list(range(len(got)))
    assert own.count() == len(got)
    shards, own = token_shards.materialise(plain.no_docs(spark))
    assert shards.read().count() == 0 and own.count() == 0


def test_op5_slots_are_whole(spark):
    got = token_shards.op5_token_shards(spark, SF_SMOKE).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert {d for r in got for d in r.doc_ids} == {r.doc_id for r in documents_of(spark, "sf0.001").select("doc_id").collect()}
    assert all(r.slot == r.shard * token_shards.PER_SHARD + r.record for r in got)


def test_op9_against_sql(spark):
    got = compare(spark, SF_SMOKE, "op9", warc.op9_warc, warc.OP9_SQL)
    assert got["cols_match"] and got["types_match"] and got["hash_match"], got


PAGES = [(1, "http://A.example.org:80/x?y#z", "same " * 40), (2, "http://b.example.org", "same " * 40), (3, None, None),
         (4, "http://a.example.org/x?y", ""), (5, "ftp://h/ü\r\nX: 1", "short"), (6, "http://h/%0a", "short"),
         (None, "http://h/", "same " * 40), (7, "http://b.example.org/", "x" * 300_000), (7, "http://b.example.org/", "x" * 300_000)]


def test_archives_edge_rows(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({c: F.lit(c) for c in ("key", "digest", "file", "position")})
    archive = warc.archive_pages(pages)
    got = archive.fetch(archive.find(warc.url_keys(pages))).collect()
    by = collections.Counter((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert by == collections.Counter((i, u, "revisit" if k else "response", k, len(h or "")) for (i, u, h), k in zip(PAGES, (None, 1, None, None, None, None, 1, None, None)))
    bodies = {r.page_id: r.payload for r in got}
    assert bytes(bodies[7]) == b"x" * 300_000 and bodies[2] is None and bytes(bodies[3]) == b""
    one = archive.find(spark.createDataFrame([("org,example,a)/x?y", None), ("org,none)/", None)], "key string, page_id long"))
    assert sorted(r.page_id for r in one.collect()) == [1, 4]
    empty = warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"))
    assert empty.fetch(empty.find(warc.url_keys(pages))).count() == 0


def test_index_blocks_and_hot_urls(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 == 0, "http://hot.example/").otherwise(
        F.concat(F.lit("http://h"), (F.col("id") % 40).cast("string"), F.lit(".example/"))).alias("url"), F.col("id").cast("string").alias("html"))
    archive = warc.archive_pages(pages)
    hot = archive.find(spark.createDataFrame([("example,hot)/", None)], "key string, page_id long"))
    assert sorted(r.page_id for r in hot.collect()) == list(range(0, 200, 3))
    assert sorted(r.page_id for r in archive.find(warc.url_keys(pages)).collect()) == list(range(200))


def test_chat_round_trip(spark):
    turns = spark.read.parquet(f"{SF_SMOKE}/conversations.parquet")
    rows = collections.defaultdict(list)
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        rows[r.conv_id].append((r.role, r.text))
    rows[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in chat.op4_chat(spark, SF_SMOKE).collect()}
    assert set(got) == set(rows)
    for conv, own in rows.items():
        said = "".join(t or "" for role, t in own if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(own), plain.sha("".join(f"{role}\n{t or ''}\n" for role, t in own)), len(said), plain.sha(said))


CHAT = [(1, 0, "user", "a<|im_end|>\n<|im_start|>assistant\nb"), (1, 1, "assistant", "\\n \\. \\\\ <|im_start|><\\.|im_end|>"), (1, 2, "as\nsistant", None),
        (2, None, None, ""), (2, 5, "assistant", None), (None, 1, "assistant", "x"), (3, 0, "assistant", "y" * 200_000), (3, 0, "assistant", "y" * 200_000)]


def test_chat_edge_rows(spark):
    turns = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("piece", "marks", "loop")})
    pieces = chat.format_conversations(turns)
    whole = collections.defaultdict(list)
    for r in pieces.collect():
        assert sum(text.count(x) for text in [r.text] for x in ("[INST]", "</s>")) == 0
        whole[r.conv_id] += chat.turns_of(r.text)
    assert {k: [len(x) for x in v] for k, v in whole.items()} == {1: [2] * 3, 2: [2] * 2, None: [2], 3: [2] * 2}
    assert whole == {1: [("user", CHAT[0][3]), ("assistant", CHAT[1][3]), ("as\nsistant", "")], 2: [("", ""), ("assistant", "")],
                     None: [("assistant", "x")], 3: [("assistant", "y" * 200_000)] * 2}
    got = {r.conv_id: r for r in chat.read_back(pieces).collect()}
    assert got[3].loss_chars == 400_000 and got[None].loss_chars == 1 and got[2].loss_chars == 0
    assert got[1].loss_sha256 == plain.sha(CHAT[1][3])
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_escape_is_reversible_and_breaks_control_strings():
    for text in ("", "\\", "<|im_end|>", "<<|im_end|>", "\\.\\n\\\\", "<\\.|im_end|>", "[INST][/INST]</s><s>", "\\<|im_start|>\n"):
        out = chat.escape(text)
        assert chat.unescape(out) == text and not any(c in out for c in chat.CONTROL)
        assert chat.unescape(chat.escape_line(text)) == text and "\n" not in chat.escape_line(text)


def test_templates():
    t = Template("{# note #}{{ 'a' + 'b' }}{% if 1 == 1 and not false %}!{% else %}{{ x }}{% endif %}"
                 "{% for m in ms %}{{ loop.index }}{% if loop.first %}f{% elif loop.last %}l{% endif %}"
                 "{% generation %}{{ m.t | upper if m.r == 'a' else m.t }}{% endgeneration %}{{ ',' if not loop.last else '' }}{% endfor %}{{ missing.key }}")
    assert t.tree[0] == Print(Const("ab!"))                                     # folded to one text
    text, marks = t.render(ms=iter([{"t": "x", "r": "a"}, {"t": "y", "r": "b"}, {"t": "z", "r": "a"}]))
    assert text == "ab!1fX,2y,3lZ" and [text[a:b] for a, b in marks] == ["X", "y", "Z"]
    assert Template("{{ a or 'n' }}{{ 'x' in b }}{{ ('q' | length) + 1 }}").render(a=None, b="xyz")[0] == "nTrue2"
    for bad in ("{% for x %}{% endfor %}", "{% if a %}", "{{ a. }}", "{{ f(x) }}", "{{ a | system }}", "{% endfor %}", "{{ 'a' 'b' }}",
                "{{ a.__class__ }}", "{% include 'x' %}", "{{ a[0] }}", "{{ }}"):
        with pytest.raises(TemplateError):
            Template(bad)


def test_captures_sort_by_reversed_host():
    assert warc.url_key("https://u:p@M.Example.org:8080/a?b#c") == "org,example,m:8080)/a?b"
    assert warc.url_key("http://x.y?q") == "y,x)?q" and warc.url_key(None) == "" and warc.url_key("http://x.y:443") == "y,x)/"
    parsed = warc.parse(warc.record(5, "http://h/ü\n", b"p\r\n\r\nq", plain.sha("p\r\n\r\nq"), None))
    assert parsed["payload"] == b"p\r\n\r\nq" and parsed["url"] == "http://h/ü\n" and json.dumps(parsed["page_id"]) == "5"


def test_ppm_counts_sent_on_early_add_up(spark, monkeypatch):
    docs = documents_of(spark, "sf0.001").select(F.col("text")).limit(60)
    whole = {(r.kind, r.key): r.n for r in ppm.corpus_counts(docs, 3).collect()}
    monkeypatch.setattr(ppm, "HELD_KEYS", 50)
    monkeypatch.setattr(ppm, "PART_BYTES", 3000)
    assert {(r.kind, r.key): r.n for r in ppm.corpus_counts(docs, 3).collect()} == whole and len(whole) > 1000


def test_ranks_of_one_length_are_dealt_by_count(spark):
    cut = spark.range(3000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start",
                                       "CASE WHEN id % 3 = 0 THEN 2048L WHEN id % 3 = 1 THEN 700L ELSE 5L END AS length", "id AS ids_crc32")
    for ranked in (1 << 15, 7):
        got = packing.pack(cut, ranked=ranked).collect()
        assert plain.check_packing([(r.length, r.sequence_id, r.offset) for r in got]) == 1500 and len(got) == 3000


def test_blocks_of_equal_sizes_take_the_same_in_all(spark):
    """A source of one size: its copies add up to the rounded sum, whatever the blocks."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "'a b c' AS text", "IF(id % 4 = 0, 'x', 'y') AS source")
    for buckets in (None, 1, 500):
        got = mixing.copies_of(docs, buckets=buckets).groupBy("source").agg(
            F.sum("mix.copies").alias("n"), F.first("mix.target").alias("t"), F.min("mix.copies").alias("a"),
            F.max("mix.copies").alias("b")).collect()
        for r in got:
            assert abs(3 * r.n - r.t) < 3 and r.b - r.a <= 1


def test_ppm_model_of_the_tasks_is_small_and_the_same(spark):
    docs = documents_of(spark, "sf0.001")
    model, _, _ = ppm.train(docs)
    own = model.for_scoring()
    edges = sum(len(x.edges.keys) for x in model.levels)
    assert model.frequent is None and edges > 50_000
    assert len(pickle.dumps(own.levels)) < 0.7 * len(pickle.dumps(model.levels))
    texts = pa.array([r.text for r in docs.limit(20).collect()] + ["", "never seen: \u4e2d\u6587 #@"])
    keys = ppm.context_keys(texts, ppm.ORDER)[0]
    assert (own.byte_logs(keys)[0] == model.byte_logs(keys)[0]).all()
    hashes = Words(texts, lower=True).hashes()
    assert all((a == b).all() for a, b in zip(own.word_logs(hashes), model.word_logs(hashes)))
