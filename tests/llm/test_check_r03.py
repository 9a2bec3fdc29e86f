"""What the check tool's figures of round 3 asked for, on rows made here."""

import os
import pickle
import tempfile
import tracemalloc
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetsight.llm import common, context_mixing, language_codes, minhash, secret_scan, tokens


# ---- op3: new chunks ------------------------------------------------------------------------------
@pytest.mark.parametrize("cache_entries", [4, 1000])
def test_words_of_letters_do_not_take_the_general_way(cache_entries):
    encoder = tokens.Encoder(tokens.default_tokenizer(), cache_entries)
    general = []
    usual = encoder._chunk_ids
    encoder._chunk_ids = lambda chunks: general.extend(chunks) or usual(chunks)
    texts = ["First plainword, Wörter. 日本 x. ª. a.b 12 é, end.", "First . , ... été. ÉTÉ plainword plainword,", "", "x"]
    for _ in range(2):
        want = [np.asarray(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert encoder.encode(texts) == want
    assert {c for c in general if c[0] == " "} == {" a.b", " 12", " .", " ,", " ..."}


# ---- op1: what every machine keeps ----------------------------------------------------------------
def _letters(n, size, seed):
    rng = np.random.default_rng(seed)
    return [" ".join("".join(w) for w in rng.choice(list("abcdefgh"), (size, 5))) for _ in range(n)]


def test_broadcasts_of_few_texts_are_small(spark, monkeypatch):
    sizes = []
    usual = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sizes.append(len(pickle.dumps(value))) or usual(self, value))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(_letters(40, 30, 1))], "doc_id long, text string")
    assert context_mixing.score(docs, F.col("doc_id") % 5 == 1).count() == 40
    assert sizes and max(sizes) < 4_000_000


def test_counts_travel_packed_and_are_whole(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "BLOCK", 1 << 10)  # several slices a task
    texts = [*_letters(60, 40, 2), "", "é日 x", *_letters(3, 40, 2)]
    docs = spark.createDataFrame([(t, i % 7 == 0) for i, t in enumerate(texts)], "text string, mixer boolean").repartition(3)
    counts = context_mixing.corpus_counts(docs)
    assert "HashAggregate" not in counts._jdf.queryExecution().executedPlan().toString()
    grams, words = Counter(), Counter()
    for i, t in enumerate(texts):
        raw, offsets = common.text_buffer(pa.array([t]))
        words.update(context_mixing._words(raw, offsets)[0].tolist())
        if i % 7:
            buffer, places, _ = context_mixing.padded(raw, offsets)
            grams.update(context_mixing.gram_keys(buffer, places).astype(np.int64).tolist())
    got = counts.collect()
    assert len(got) == len({(r.kind, r.key) for r in got})
    assert {r.key: r.n for r in got if r.kind == 0} == grams
    assert {r.key: r.n for r in got if r.kind == 1} == words


# ---- pipeline, op6: what a task of near duplicates holds -------------------------------------------
def test_full_sets_go_to_python_in_bounded_batches(spark, monkeypatch):
    seen = tempfile.mkdtemp(prefix="fleetsight-test-")
    usual = minhash._confirm

    def watched(percent):
        run = usual(percent)

        def inner(batches):
            def each():
                for batch in batches:
                    with open(f"{seen}/{uuid.uuid4().hex}", "w") as f:
                        f.write(str(batch.nbytes))
                    yield batch

            yield from run(each())

        return inner

    monkeypatch.setattr(minhash, "_confirm", watched)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        words = rng.integers(0, 1 << 40, 25_000).astype(str).tolist()
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:-5], *"abcde"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get(common.BATCH_CONF)
    got = minhash.near_duplicates(docs).select("doc_id", "component_id").collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i // 2 * 2 for i in range(80)}
    sizes = [int(open(f"{seen}/{name}").read()) for name in os.listdir(seen)]
    assert sum(sizes) > 15_000_000 and max(sizes) < 2 * minhash.BATCH_BYTES
    assert spark.conf.get(common.BATCH_CONF) == before


# ---- op13: what scoring holds ----------------------------------------------------------------------
def test_log_odds_of_a_long_text_are_looked_up_in_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    odds = rng.integers(-8, 9, (language_codes.BUCKETS, 40)).astype(np.float32)
    texts = ["", "a", "".join(rng.choice(list("abcdefg "), 600_000)), "b c", "", "word " * 9]
    raw, offsets = common.text_buffer(pa.array(texts))
    tracemalloc.start()
    got = language_codes.evidence(raw, offsets, odds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 70_000_000  # 600,000 places of 40 numbers are 96 MB
    want = np.stack([sum(odds[k].astype(float).sum(axis=0) for k, _ in language_codes.grams(*common.text_buffer(pa.array([t])))) for t in texts])
    assert np.allclose(got, np.sign(want) * np.log1p(np.abs(want)))
    monkeypatch.setattr(language_codes, "BLOCK_BYTES", 40 * 4 * 7)  # blocks that begin and end within texts
    few = common.text_buffer(pa.array([texts[i] for i in (0, 1, 3, 4, 5)]))
    assert np.allclose(language_codes.evidence(*few, odds), got[[0, 1, 3, 4, 5]])


def test_counts_of_many_languages_are_whole(spark, monkeypatch):
    monkeypatch.setattr(language_codes, "HELD_LANGUAGES", 3)
    words = {f"l{i}": "".join(chr(97 + (7 * i + 3 * j * j) % 26) for j in range(9)) for i in range(12)}
    docs = spark.createDataFrame([(40 * i + k, f"{w} " * (k % 5 + 3), lang) for i, (lang, w) in enumerate(words.items()) for k in range(40)], "doc_id long, text string, lang string")
    codes = language_codes.train(docs, F.lit(True))
    assert codes.languages == sorted(words)
    got = language_codes.predict(docs, codes).select("lang", "lang_pred").collect()
    assert all(r.lang == r.lang_pred for r in got)


# ---- pipeline: Arrow batches of stages that end in a Python function --------------------------------
def test_last_functions_of_stages_get_bounded_batches(spark, monkeypatch):
    seen = tempfile.mkdtemp(prefix="fleetsight-test-")
    usual = secret_scan.slices

    def watched(batch, text, limit=1 << 22):
        with open(f"{seen}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(batch.nbytes))
        yield from usual(batch, text, limit)

    monkeypatch.setattr(secret_scan, "slices", watched)
    docs = spark.createDataFrame([(i, f"{i} " * 30_000, "en", "a", None) for i in range(120)], "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get(common.BATCH_CONF)
    try:
        assert corpus_pipeline.secrets(spark, docs, "").filter(F.length("text") > 0).count() == 120
        spark.conf.set(common.BATCH_CONF, "1000000")
        common.bound_batches(spark)
        assert spark.conf.get(common.BATCH_CONF) == "1000000"
    finally:
        spark.conf.set(common.BATCH_CONF, before)
    sizes = [int(open(f"{seen}/{name}").read()) for name in os.listdir(seen)]
    assert sum(sizes) > 10_000_000 and max(sizes) < 6_000_000
