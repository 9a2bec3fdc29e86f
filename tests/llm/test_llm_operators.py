"""The operators' own parts: data structures, models, formats, and the pipeline's stages."""

import collections
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from odd_tables import SF_SMALL, documents, empty, odd  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from fleetsight.llm import (
    common,
    components,
    context_mixing,
    conv_classifier,
    forest,
    host_rules,
    id_store,
    minhash,
    mixture,
    packing,
    secret_scan,
    tokens,
    warc,
)

TEXTS = [t or "" for _, t, _ in documents()]


# ---- common -------------------------------------------------------------------------------------
def test_word_hashes_follow_words():
    raw, offsets = common.text_buffer(pa.array(TEXTS))
    hashes, counts = common.word_hashes(raw, offsets)
    words = [brute.lower_words(t) for t in TEXTS]
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    of = dict(zip(flat, hashes.tolist()))
    assert len(of) == len(set(hashes.tolist())) == len(set(flat))
    assert [of[w] for w in flat] == hashes.tolist()


@pytest.mark.parametrize("seed", range(4))
def test_components_equal_a_plain_search(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(120)]
    found = components.components(spark.createDataFrame(links, "a long, b long"), "test").collect()
    want = brute.components(sorted({x for a, b in links if a != b for x in (a, b)}), links)
    assert {r.node for r in found} == set(want)
    classes = collections.defaultdict(set)
    for r in found:
        classes[r.root].add(want[r.node])
    assert all(len(c) == 1 for c in classes.values()) and len(classes) == len(set(want.values()))


# ---- 1 language model ---------------------------------------------------------------------------
def test_model_is_a_distribution_over_the_next_byte():
    rng = np.random.default_rng(0)
    table = [context_mixing.entries(*rng.integers(0, 9, (2, 1 << context_mixing.SLOT_BITS))) for _ in range(context_mixing.ORDERS)]
    model = context_mixing.blank(table)
    context = int.from_bytes(b"tihw ", "big")
    grams = np.sort(np.array([(b << 40) | context for b in range(256)], np.uint64))
    assert (10.0 ** context_mixing.costs(model, grams)).sum() == pytest.approx(1.0, abs=1e-6)


def test_texts_are_scored_alone_and_learning_helps():
    texts = ["the cat sat on the mat. " * 20, "", "the dog sat on the log. " * 15, "ä" * 50]
    raw, offsets = common.text_buffer(pa.array(texts))
    buffer, places, _ = context_mixing.padded(raw, offsets)
    grams, counts = context_mixing.distinct(context_mixing.gram_keys(buffer, places))
    assert counts.sum() == len(raw) + len(texts)
    seen = np.zeros((context_mixing.ORDERS, 2, 1 << context_mixing.SLOT_BITS))
    for order in range(1, context_mixing.ORDERS + 1):
        chunk, at, bits = context_mixing.slots(context_mixing._prefix(grams, order), order)
        np.add.at(seen[order - 1], (bits.ravel(), ((chunk[:, None] << context_mixing._IN_CHUNK) | at).ravel()), np.repeat(counts, 8))
    empty_table = [context_mixing.entries(np.zeros(1 << context_mixing.SLOT_BITS), np.zeros(1 << context_mixing.SLOT_BITS))] * context_mixing.ORDERS
    model = context_mixing.blank([context_mixing.entries(*s) for s in seen])
    together = context_mixing.text_scores(model, raw, offsets)
    alone = [context_mixing.text_scores(model, *common.text_buffer(pa.array([t])))[0] for t in texts]
    assert np.allclose(together, alone)
    assert together.sum() > context_mixing.text_scores(context_mixing.blank(empty_table), raw, offsets).sum() * 0.5
    n = context_mixing.GATES * context_mixing.BUCKETS
    hits, tries, before = np.zeros(n), np.zeros(n), together.sum()
    for _ in range(20):
        context_mixing.learn_block(model, hits, tries, grams, counts)
    assert context_mixing.text_scores(model, raw, offsets).sum() > before


def test_key_codes_agree_with_the_general_way():
    rng = np.random.default_rng(1)
    for top in (3, 40, 256):
        buffer = rng.integers(0, top, 5000).astype(np.uint8)
        keys = context_mixing.gram_keys(buffer, np.arange(context_mixing.ORDERS, len(buffer)))
        distinct, code = context_mixing._by_key(keys)
        assert (distinct[code] == keys).all() and len(np.unique(keys)) == len(distinct)
        for order in range(1, context_mixing.ORDERS + 1):  # runs of each order's prefix are whole
            short = context_mixing._prefix(distinct, order)
            assert (np.diff(short.astype(np.int64)) >= 0).all()


def test_entries_are_exact_however_many_contexts_there_are():
    rng = np.random.default_rng(3)
    grams, counts = context_mixing.distinct(rng.integers(0, 1 << 48, 400_000).astype(np.uint64))
    known = grams[::2]
    for number, at in context_mixing._by_part(known, 64):
        tables = context_mixing.part_tables(known[at], counts[::2][at])
        others = grams[1::2][context_mixing._parts_of(grams[1::2], 64) == number]
        contexts = known[at] & np.uint64((1 << 40) - 1)
        strange = others[~np.isin(others & np.uint64((1 << 40) - 1), contexts)]
        assert len(strange) and (context_mixing.high_entries(tables, strange)[:, :, -1] & 15 == 0).all()
        found = context_mixing.high_entries(tables, known[at])[:, :, -1]
        assert (found & 15 > 0).all()
        logit, bits = (found[:, 7] >> 4).astype(int) - 2048, context_mixing.nodes(known[at], 5)[1][:, 7]
        assert (np.sign(logit) == 2 * bits - 1).mean() > 0.99


def test_held_out_texts_cost_less_than_eight_bits(spark):
    rows = context_mixing.score(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), common.crc_remainder(F.col("doc_id"), 5) == 1)
    held = rows.filter("held_out").agg(F.avg("bits_per_byte")).first()[0]
    assert held < 3.5


# ---- 2 mixture ----------------------------------------------------------------------------------
@pytest.mark.parametrize("whole", [1, 2, 3, 7, 16, 97, 1000])
def test_scatter_is_a_permutation(spark, whole):
    places = spark.range(whole).select(
        F.col("id").alias("place"), F.lit(whole).cast("long").alias("whole"), F.lit("s").alias("source"), F.lit(2).cast("long").alias("pass")
    )
    moved = [r.moved for r in mixture._scattered(places, 5).orderBy("place").collect()]
    assert sorted(moved) == list(range(whole))
    assert whole < 50 or moved != sorted(moved)


def test_mixed_documents_are_parts_of_their_documents(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    out = mixture.mixed_documents(docs, block=8).collect()
    assert docs.columns == mixture.mixed_documents(docs, block=8).columns
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text or "")
    assert out and all(any(r.text in t for t in texts[r.doc_id]) and r.n_chars == len(r.text) for r in out)


def test_shards_draw_their_slots_and_get_no_others(spark):
    sizes = spark.createDataFrame([("a", 40_000), ("b", 9_001), ("c", 100), (None, 300_000)], "source string, source_size long")
    targets = mixture.source_targets(sizes)
    counts = mixture.shard_counts(targets, block=16, shard_words=20_000)
    drawn = collections.Counter({(r.source, r.shard): r.n for r in counts.collect()})
    slots = mixture.slots(counts, block=16).collect()
    assert collections.Counter((r.source, r.shard) for r in slots) == drawn
    due = {r.source: round(r.target) for r in targets.collect()}
    got = collections.Counter()
    for r in slots:
        got[r.source] += r.words
    assert max(r.shard for r in slots) == 17  # 349,101 words make 18 shards
    # the last block of a source is shorter than its slot
    assert all(due[s] <= got[s] <= due[s] + 16 * 3 for s in due)
    n = sum(c for (s, _), c in drawn.items() if s is None)
    spread = sum((drawn[None, shard] - n / 18) ** 2 / (n / 18) for shard in range(18))
    assert 4 < spread < 45  # chi-square with 17 degrees of freedom: neither equal shares nor a skewed draw


def test_the_mix_is_written_by_shard(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(40)), "ab"[i % 2]) for i in range(200)], "doc_id long, text string, source string")
    options = {"block": 8, "shard_words": 1000}
    mixed = mixture.mix(docs, **options)
    place = {(r.doc_id, r.at, r["from"], r["pass"]): (r.shard, r.seat) for r in mixed.filter("words > 0").collect()}
    assert len({shard for shard, _ in place.values()}) == 8
    taken = {r.doc_id: r for r in mixture.taken_words(mixed).collect()}
    for d, row in taken.items():
        shards = [v[0] for k, v in place.items() if k[0] == d]
        assert (row.n_slots, row.first_shard) == (len(shards), min(shards, default=None))
    parts = mixture.mixed_documents(docs, **options).collect()
    words = sum(len(r.text.split()) for r in parts)
    assert words == sum(r.taken for r in taken.values())


# ---- 3 packing ----------------------------------------------------------------------------------
def test_differencing_gives_near_equal_windows():
    rng = random.Random(3)
    for n, k in ((1, 1), (5, 3), (200, 16), (700, 64)):
        lengths = [rng.randint(1, 512) for _ in range(n)]
        window, sums = packing.difference(lengths, k)
        held = collections.Counter()
        for w, size in zip(window.tolist(), lengths):
            held[w] += size
        assert sorted(held.values()) == sorted(s for s in sums.tolist() if s)
        if n >= 10 * k:
            assert sums.max() - sums.min() <= 0.01 * sums.mean()
    assert packing.difference([], 4)[1].tolist() == [0, 0, 0, 0]


def test_the_window_count_rises_until_all_fit():
    window, k = packing.windows([1500] * 5, 2048)
    assert k == 5 and len(set(window.tolist())) == 5


def test_little_padding(spark):
    got = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), with_ids=False).agg(
        F.sum("length").alias("n"), F.countDistinct("sequence_id").alias("s")
    ).first()
    assert 1 - got.n / (2048 * got.s) < 0.01


# ---- tokens -------------------------------------------------------------------------------------
def test_cached_ids_equal_whole_ids():
    encoder = tokens.Encoder(tokens.default_tokenizer(), cache_entries=50)
    texts = [*TEXTS, "a \n b", "x\n\ny", " lead", "trail ", "a\tb c", "a　 b", "\n", "日本 語\nü", "it's we'll 'S 'll", "1 2 33a a33", "a\u0085b c"]
    for _ in range(2):  # with an empty and a filled cache
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


# ---- 4 secrets ----------------------------------------------------------------------------------
def test_incompressible_strings_near_sensitive_words_are_found():
    scan = secret_scan.Scanner()
    key = "Zk9qLx2vTn8RwY4hBp7sDf3mGc6j"
    named = f"Authorization: Bearer {key} and more"
    assert (named.index(key), 3, named.index(key) + len(key)) in scan.spans(named)
    assert scan.spans(f"an order {key} of things") == []
    assert scan.spans("the auth default_connection_string_2020_settings is set") == []
    repeated = f"{key} {key} auth {key}"
    assert all(k != 3 for _, k, _ in scan.spans(repeated))


@pytest.mark.parametrize("name", ["AWS_SECRET_ACCESS_KEY", "PRIVATE_KEY", "DB_PWD", "CLIENT_CREDENTIAL", "SECRET_KEY"])
@pytest.mark.parametrize("line", ["{}={}\n", "export {}={}\n", "env {}={} ./run\n", "{}={}==\n"])
def test_values_joined_to_a_sensitive_name_are_found(name, line):
    key = "wJalrXUtnFEMI/K7MDENGbPxRfiCYzQ3pLk9"
    text = "PORT=8080\n" + line.format(name, key)
    spans = secret_scan.Scanner().spans(text)
    assert key not in secret_scan.redacted(text, spans) and f"{name}=[SECRET]" in secret_scan.redacted(text, spans)
    assert secret_scan.Scanner().spans("DB_PWD=default_connection_string_2020_settings\n") == []


def test_copies_of_a_secret_do_not_hide_it():
    scan = secret_scan.Scanner()
    key = "Zk9qLx2vTn8RwY4hBp7sDf3mGc6j"
    line = f"retry: Authorization: Bearer {key} sent\n"
    for text in (line * 2, line * 30, f"bearer {key}\n{'y ' * 250}bearer {key}\n", f"{key} {key} auth {key}", f"DB_PWD={key}\nPRIVATE_KEY={key}\n"):
        spans = scan.spans(text)
        assert [text[s:e] for s, _, e in spans] == [key] * text.count(key)
        assert key not in secret_scan.redacted(text, spans)
    name = "auth default_connection_string_2020_settings "
    assert scan.spans(name * 3) == []


@pytest.mark.parametrize(
    "key",
    ["qZkXwPvLmTrYbNcDfGhJ", "qzkxwpvlmtrybncdfghjvbxw", "QZKXWPVLMTRYBNCDFGHJVBXW", "Xk9!mQ2#vL7@pR4$wT", "Xk9:mQ2=vL7,pR4;wT", "zq.Xw~9-vK*7^pL&2%rT", "Zk9ßLx2vTn8ñwY4h"],
)
def test_any_incompressible_run_is_found(key):
    for text in (f"Authorization: Bearer {key} and more", f"passphrase: {key}\n", f"DB_PWD={key}\n", f"credential:{key}, next", f"(the pwd {key})."):
        spans = secret_scan.Scanner().spans(text)
        assert [text[s:e] for s, k, e in spans if k == 3] == [key]
    words = "the constitutionnellement responsibilities, Geschwindigkeitsbegrenzung and /usr/share/python3/dist-packages/numpy/core of org.apache.spark.sql.SparkSession"
    assert secret_scan.Scanner().spans(f"auth: {words}") == []
    assert secret_scan.Scanner().spans("token: ひらがなとカタカナの文章がここにありますね") == []


@pytest.mark.parametrize("key", ["Xk9!mQ2#vL7@pR", "k7#Qz!9vRm2x", "9vRm2xKq", "Tr0ub4dor&3x", "qZkXwPvLmTrY"])
def test_short_values_of_sensitive_names_are_found(key):
    scan = secret_scan.Scanner()
    for text in (f"passphrase: {key}\n", f"pwd: {key}", f"DB_PWD={key}\nPORT=80", f"credential = '{key}', next", f"(my pwd: {key}).", f"Authorization: Basic {key}"):
        spans = scan.spans(text)
        assert [text[s:e] for s, k, e in spans if k == 3] == [key], text
        assert key not in secret_scan.redacted(text, spans)
    text = f"pwd: {key}\nthen {key}, and again pwd: {key}\n"
    assert [(text[s:e], k) for s, k, e in scan.spans(text)] == [(key, 3), (key, 4), (key, 3)]
    assert scan.spans(f"the order {key} of things: a token was given") == []


def test_short_words_and_numbers_near_sensitive_names_are_left():
    scan = secret_scan.Scanner()
    for value in ("something", "Wiedersehen", "changeme12", "os.getenv(", "10.0.0.12:8080", "2024-05-17", "e-mail/post", "get_user()", "Überraschung", "self.name_2", "<see-below>", "abc", "k7#Qz!9"):
        for name in ("password", "token", "The secret", "pwd", "auth"):
            assert scan.spans(f"{name}: {value} and so on\n") == [], (name, value)


def test_only_whole_sensitive_words_are_context():
    scan, key = secret_scan.Scanner(), "qZkXwPvLmTrYbNcDfGhJ"
    for clean in (
        "The author Friedrich-Wilhelm Donaudampfschifffahrtsgesellschaft",
        "Authors: Przybyszewski-Wolszczan and others",
        "the local authorities of Llanfairpwllgwyngyllgogerych met",
        "the secretary Donaudampfschifffahrtskapitaen",
        "a tokenizer for floccinaucinihilipilification",
    ):
        assert scan.spans(clean) == []
    for word in ("auth", "OAUTH", "basicauth", "auth_code", "proxy-auth", "my_auth", "authKey", "authentication", "authorisation", "tokens", "secrets", "auth2"):
        text = f"{word}: {key} and more"
        assert [text[a:b] for a, k, b in scan.spans(text) if k == 3] == [key], word


def test_a_base_span_inside_a_key_does_not_hide_the_rest():
    key = "Zk9qLx2vTn8R0123456789abcdef01wY4hBp7sDf3m"
    for text in (f"Authorization: Bearer {key} and more", f"DB_PWD={key}\n", f"password: {key[:20]}!{key[20:]}#wY4hBp\n"):
        spans = secret_scan.Scanner().spans(text)
        assert {k for _, k, _ in spans} >= {3} and any(k < 3 for _, k, _ in spans)
        left = secret_scan.redacted(text, spans)
        assert not any(key[i : i + 6] in left for i in range(len(key) - 5)) and "wY4hBp" not in left
    covered = "token: 0123456789abcdef0123456789abcdef"
    assert all(k != 3 for _, k, _ in secret_scan.Scanner().spans(covered))


def test_redaction_masks_values_and_keeps_the_rest(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = out.filter("doc_id = 7").first()
    assert text.text == 'x password = "[SECRET]" y [SECRET] z [SECRET] end' and text.n_chars == len(text.text)
    unchanged = out.join(docs.select(F.col("doc_id").alias("i"), F.col("text").alias("t")), F.col("doc_id") == F.col("i"))
    assert unchanged.filter("doc_id not in (7, 12, 18) and not (text <=> t)").count() == 0


# ---- 5 forest -----------------------------------------------------------------------------------
def test_a_tight_group_is_not_doubled_by_spill():
    rng = np.random.default_rng(0)
    group = rng.normal(size=32) + rng.normal(scale=0.01, size=(3000, 32))
    units = np.concatenate([group, rng.normal(size=(3000, 32))])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    spill = forest.margin(32, 0.95)
    tree = forest.grow(units, 200, spill, np.random.default_rng(1))
    rows, leaves = forest.route(tree, units, spill)
    assert set(rows.tolist()) == set(range(len(units)))
    assert len(rows) < 4 * len(units)


def test_recall_on_random_close_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(3000, 24))
    near = base + rng.normal(scale=0.3, size=base.shape) * np.linalg.norm(base, axis=1, keepdims=True) / np.sqrt(24)
    vectors = np.concatenate([base, near])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = forest.near_duplicates(frame, leaf=200).agg(F.sum("n_links")).first()[0]
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = int((units @ units.T >= 0.95).sum()) - len(units)
    assert links > 1000 and found / links >= 0.99


def test_vectors_of_every_length_are_compared(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=n) for n in [16] * 400 + [24] * 300 + [3] * 2 + [1] * 2]
    vectors += [v + rng.normal(scale=0.02, size=len(v)) for v in vectors[:350]] + vectors[400:650] + vectors[700:702]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    links = []
    for n in {len(v) for v in vectors}:
        at = np.array([i for i, v in enumerate(vectors) if len(v) == n])
        units = np.stack([vectors[i] / np.linalg.norm(vectors[i]) for i in at])
        i, j = np.nonzero(np.triu(units @ units.T >= 0.95, 1))
        links += list(zip(at[i].tolist(), at[j].tolist(), strict=True))
    degree, component = collections.Counter(x for pair in links for x in pair), brute.components(list(range(len(vectors))), links)
    for sample in (20_000, 60):  # with the small one, the rare lengths have no trees
        monkeypatch.setattr(forest, "SAMPLE", sample)
        got = forest.near_duplicates(frame, leaf=100).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (degree[i], component[i]) for i in range(len(vectors))}


# ---- 6 MinHash ----------------------------------------------------------------------------------
def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    for n in (20, 200, 2000):
        pool = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        a, b = np.unique(pool[: n + n // 2]), np.unique(pool[n // 2 :])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        agree = (minhash.signature(a) == minhash.signature(b)).mean()
        assert abs(agree - true) < 0.25 if n < 100 else abs(agree - true) < 0.12
    single = minhash.signature(np.array([5], np.uint64))
    assert len(set(single.tolist())) == 1


def test_full_comparison_finds_links_that_stars_miss():
    import pandas as pd

    sign = bytes(minhash.BINS)
    sets = [np.arange(n, dtype=np.uint64).tobytes() for n in (100, 90, 50, 95)]
    frame = pd.DataFrame(
        {"node": [1, 2, 3, 4], "root": [1, 2, 3, 3], "n_shingles": [100, 90, 50, 95], "signature": [sign, sign, sign, b"\1" * minhash.BINS],
         "bands": [[7, 8], [6, 8], [6, 8], [7, 8]], "shingles": sets, "band": 8, "block": 0, "lo": 0, "hi": 0}
    )
    # 3 is too small for any other; 4 agrees in no bin, and with 1 it would be another band's pair
    assert sorted(minhash._to_compare(80)(frame)["node"]) == [1, 2]
    assert [tuple(r) for r in minhash._compared_in_full(80)(frame).itertuples(index=False)] == [(1, 2)]
    assert len(minhash._compared_in_full(95)(frame)) == 0


def test_blocks_of_a_large_component_never_meet(spark, monkeypatch):
    """Rows grow with a component, not with its square, and every pair across components shares a pair of blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    per_member = {}
    for large in (40, 160):
        rows = [(n, 1, 0) for n in range(large)] + [(1000 + n, 1, 1000 + n) for n in range(7)]
        rows += [(n, 2, n) for n in range(5)] + [(n, 3, 0) for n in range(large)]  # a small bucket, one of one component
        dealt = minhash.dealt_to_blocks(spark.createDataFrame(rows, "node long, band long, root long")).collect()
        per_member[large] = len([r for r in dealt if r.band == 1 and r.root == 0]) / large
        assert {(r.lo, r.hi) for r in dealt if r.band == 2} == {(0, 0)} and not [r for r in dealt if r.band == 3]
        groups = {}
        for r in dealt:
            groups.setdefault((r.band, r.lo, r.hi), {}).setdefault(r.node, []).append(r.block)
        for n in range(large):
            for other in range(1000, 1007):
                assert sum(b == 1 and n in g and other in g for (b, *_), g in groups.items()) == 1
        assert all(len(set(g)) == len(g) for g in groups.values())
    assert per_member == {40: 1, 160: 1}


def test_deduplicate_judges_texts_not_ids(spark):
    def text(seed, n=60):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    a, b, c, d = text(1), text(2), text(3), text(4)
    rows = [
        (5, a, "x"), (5, b, "x"),  # one id, two texts: both stay
        (9, a + " more", "x"), (None, a, "x"),  # near copies of 5's first text, one without id
        (None, c, "x"), (None, c, "y"), (None, c + " tail", "x"),  # copies without ids: one stays
        (7, d, "x"), (7, d, "x"), (3, d + " end", "x"),  # the smallest id stays, once
        (1, None, "x"), (1, None, "x"), (None, " ", "x"),  # no words: all stay
    ]
    got = minhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, component string")).collect()
    found = sorted(((r.doc_id or 0, r.text or "") for r in got if (r.text or "").strip()))
    assert [f for f in found if f[0]] == sorted([(5, a), (5, b), (3, d + " end")])
    assert len([f for f in found if not f[0]]) == 1 and [f for f in found if not f[0]][0][1] in (c, c + " tail")
    assert len(got) - len(found) == 3
    repeated = spark.createDataFrame([(7, d, "x"), (7, d, "x"), (8, d, "x")], "doc_id long, text string, component string")
    assert [(r.doc_id, r.text) for r in minhash.deduplicate(repeated).collect()] == [(7, d)]


def test_chains_join_one_component(spark):
    """Each text is similar to the next one only; the smallest id isn't at an end."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(12):
        words = base[:]
        for j in range(12 * k):
            words[j % 200] = f"x{j}"
        rows.append(((k * 5) % 12, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    sets = [brute.shingles(t, 1) for _, t in rows]
    want = brute.components([d for d, _ in rows], [(rows[i][0], rows[j][0]) for i, j in brute.similar(sets)])
    assert {r.doc_id: r.component_id for r in got} == want


# ---- 7 WARC -------------------------------------------------------------------------------------
def test_loser_tree_merges_runs():
    rng = random.Random(6)
    for k in (0, 1, 2, 3, 8, 13):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(k)]
        assert list(warc.merge_runs(runs, key=lambda x: x)) == sorted(x for r in runs for x in r)


def test_index_is_in_global_order(spark, odd, scratch):
    warc.write_archive(spark.read.parquet(f"{odd}/pages.parquet"), f"{scratch}/archive")
    runs = warc.capture_runs(spark, f"{scratch}/archive")
    rows = sorted(warc.merged_index(runs, range_captures=3).collect(), key=lambda r: (r.range, r.rank))
    keys = [(r.url_key, r.timestamp, r.page_id is not None, r.page_id or 0) for r in rows]
    assert keys == sorted(keys) and len({r.range for r in rows}) > 1 and len(rows) == runs.count()


def test_damaged_archives_raise():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert [p for _, _, p in warc.parse_records(record * 2)] == [b"hello", b"hello"]
    for bad in (record[:-3], b"nonsense" + record):
        with pytest.raises(ValueError):
            list(warc.parse_records(bad))


def test_url_keys():
    assert warc.url_key("http://www.B.example.com/A?x=1#f") == "com,example,b)/a?x=1"
    assert warc.url_key("") == ")/" and warc.url_key("http://[bad")


# ---- 8 classifier -------------------------------------------------------------------------------
def test_documents_are_scored_alone():
    rng = np.random.default_rng(0)
    net = conv_classifier.Network(
        rng.normal(size=(256, conv_classifier.VECTOR)).astype(np.float32),
        rng.normal(size=(conv_classifier.WIDTH * conv_classifier.CHANNELS, conv_classifier.FILTERS)).astype(np.float32),
        rng.normal(size=conv_classifier.FILTERS).astype(np.float32),
        rng.normal(size=conv_classifier.FILTERS).astype(np.float32),
        0.1,
        np.array([1.0, 0.2, 0.3, 0.1]),
    )
    texts = [*TEXTS, "b" * 256, "c" * 248, "d" * 249, "e" * 512]
    together = conv_classifier.document_figures(net, *common.text_buffer(pa.array(texts)))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], conv_classifier.document_figures(net, *common.text_buffer(pa.array([t])))[0], atol=1e-3)


def test_repeats_see_what_stands_before():
    data = np.frombuffer(b"abcdefghij klm " + b"word " * 8 + b"x" * 40, np.uint8)
    found = conv_classifier.repeats(data)
    assert found[:20].sum() == 0 and found[35:50].all()


def test_without_labels_the_score_is_the_share(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text")
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, label int")
    net = conv_classifier.train(docs, labels, F.lit(True))
    assert conv_classifier.score(docs, net).filter("score < 0.99").count() == 0


# ---- 9 host rules -------------------------------------------------------------------------------
def test_host_verdicts_follow_shrunk_rates(spark):
    rows = [(h, i < bad) for h, n, bad in (("good", 400, 8), ("bad", 400, 390), ("tiny", 1, 1), (None, 100, 5)) for i in range(n)]
    got = {r.host: r for r in host_rules.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert got["good"].host_kept and not got["bad"].host_kept and got[None].host_kept
    assert 8 / 400 <= got["good"].host_rate < 0.1 and got["tiny"].host_rate < 1
    n, f = 901, 404
    s = sum(m * (b / m) ** 2 for m, b in ((400, 8), (400, 390), (1, 1), (100, 5)))
    mean, strength = host_rules._prior(n, f, s, 4)
    assert got["tiny"].host_rate == pytest.approx((1 + mean * strength) / (1 + strength))


# ---- 10 id store --------------------------------------------------------------------------------
def test_one_document_is_read_by_the_index(spark, odd, scratch):
    docs = spark.read.parquet(f"{odd}/documents.parquet").filter("doc_id is not null")
    id_store.write_ids(docs, f"{scratch}/store")
    dictionary = bytes(spark.read.parquet(f"{scratch}/store/dictionary").first().content)
    encoder = tokens.encoder(tokens.default_tokenizer())
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(encoder.encode([r.text or ""])[0] + b"\2\0\0\0")
    for s in spark.read.parquet(f"{scratch}/store/segments").collect():
        index, _ = id_store.parse_index(bytes(s.content), dictionary)
        for i, entry in enumerate(index):
            assert id_store.read_document(bytes(s.content), dictionary, i).tobytes() in texts[int(entry["id"])]
        with pytest.raises(ValueError):
            id_store.parse_index(bytes(s.content), dictionary + b"x")


# ---- the pipeline -------------------------------------------------------------------------------
@pytest.mark.parametrize("which", ["odd", "empty"])
def test_pipeline_stages(spark, request, which):
    folder = request.getfixturevalue(which)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixture", "packing"]
    for name in list(stages)[:-1]:
        out = stages[name](spark, docs, folder)
        assert set(corpus_pipeline.COLUMNS) == set(out.columns)
    kept = stages["near_duplicates"](spark, docs, folder).collect()
    rows = docs.collect()
    sets = [brute.shingles(r.text, 5) for r in rows]
    component = brute.components(list(range(len(rows))), brute.similar(sets))
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):  # one row of each group stays, that with the smallest id, none last
        groups[component[i]].append((r.doc_id is None, r.doc_id or 0))
    assert collections.Counter((r.doc_id is None, r.doc_id or 0) for r in kept) == collections.Counter(min(g) for g in groups.values())


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    rows = out.collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
        assert len(r.ids) == 4 * r.length
    assert rows and max(sizes.values()) <= 2048
    docs = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} <= docs
