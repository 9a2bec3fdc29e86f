"""The lexical search, the alignment and the language codes beyond their registered queries."""

import collections

import brute
import numpy as np
import pyarrow as pa
import pytest

from fleetsight.llm import alignment, language_codes, lexical_search
from fleetsight.llm.common import text_buffer

TEXT = "doc_id long, text string"


# ---- lexical search -----------------------------------------------------------------------------
@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    share = 1 / np.arange(1, 120)
    words = [f"t{i}" for i in range(119)]
    docs = [(i, " ".join(rng.choice(words, size=int(rng.integers(0, 60)), p=share / share.sum()))) for i in range(700)]
    items = [(i, " ".join(rng.choice(words, size=int(rng.integers(1, 12)), p=share / share.sum()))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("k", [1, 10, 1000])
@pytest.mark.parametrize("block_terms", [20, 1 << 20])
def test_search_by_blocks_and_segments(spark, corpus, monkeypatch, k, block_terms):
    docs, items = corpus
    monkeypatch.setattr(lexical_search, "SEGMENT_DOCS", 128)
    frames = spark.createDataFrame(docs, TEXT).repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.search(*frames, k=k, block_terms=block_terms).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute.ranked(docs, items, k))


def test_short_lists_and_long_lists_meet(corpus):
    """Every mix of accumulators and long lists gives the same documents, in runs of any length."""
    docs, items = corpus
    vocabulary = np.unique(lexical_search.term_hashes(*text_buffer(pa.array([" ".join(t for _, t in docs)])))[0])
    held = [(d, brute.terms(t)) for d, t in docs]
    n_all, length = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    for share, run in ((0, 7), (1 / 32, 4096), (1 / 4, 50), (1, 64)):
        lexical_search.SHORT, lexical_search.RUN = share, run
        try:
            postings = collections.defaultdict(list)
            for i, (_, t) in enumerate(held):
                at = np.searchsorted(vocabulary, lexical_search.term_hashes(*text_buffer(pa.array([b" ".join(t).decode()])))[0])
                for term, n in collections.Counter(at.tolist()).items():
                    postings[term].append((i, n))
            terms = sorted(postings)
            row = {
                "ids": [d for d, _ in held], "lengths": [len(t) for _, t in held], "terms": terms, "found": [len(postings[t]) for t in terms],
                "places": [i for t in terms for i, _ in postings[t]], "times": [n for t in terms for _, n in postings[t]],
            }
            kinds = {"ids": pa.int64(), "lengths": pa.int64()}
            batch = pa.RecordBatch.from_arrays([pa.array([v], pa.list_(kinds.get(c, pa.int32()))) for c, v in row.items()], names=list(row))
            df = np.array([len(postings[t]) for t in terms])
            weights = np.floor(1000 * np.log((2 * n_all + 2) / (2 * df + 1))).astype(np.int64)
            segment = lexical_search.Segment(batch, 0, weights, n_all, length)
            got = []
            for item, text in items:
                best = lexical_search.Best(10)
                at = np.searchsorted(vocabulary, lexical_search.term_hashes(*text_buffer(pa.array([text])))[0])
                lexical_search.evaluate(segment, list(collections.Counter(at.tolist()).items()), best)
                got += [(item, r + 1, int(d), int(s)) for r, (d, s) in enumerate(zip(best.ids, best.scores))]
            assert got == brute.ranked(docs, items)
        finally:
            lexical_search.SHORT, lexical_search.RUN = 1 / 32, 4_096


def test_bounds_spare_documents(spark):
    """A common term that can't lift a document into the best gives no candidates."""
    docs = [(i, "common" if i >= 20 else "common rare") for i in range(5_000)]
    best = lexical_search.Best(10)
    calls = []
    add = best.add
    best.add = lambda s, i, n: (calls.append(len(s)), add(s, i, n))
    vocabulary = np.unique(lexical_search.term_hashes(*text_buffer(pa.array(["common rare"])))[0])
    index = lexical_search.build_index(spark.createDataFrame(docs, TEXT).coalesce(1), vocabulary).toArrow()
    batch = index.combine_chunks().to_batches()[0]
    weights = np.array([1, 1], np.int64)
    rare = int(np.argmin([len(batch.column("places")[0].values)] * 2))
    found = dict(zip(batch.column("terms")[0].as_py(), batch.column("found")[0].as_py()))
    rare = min(found, key=found.get)
    weights[rare] = 100
    segment = lexical_search.Segment(batch, 0, weights, 5_000, 5_020)
    best.add(np.full(10, 10_000_000), np.arange(10), np.zeros(10, bool))
    calls.clear()
    lexical_search.evaluate(segment, [(0, 1), (1, 1)], best)
    assert sum(calls) <= 20


# ---- alignment ------------------------------------------------------------------------------------
ODD_TEXTS = [
    "a", "two words", "line\nline two", " lead", "trail ", "two  spaces", "tab\there", "end\n", "\nstart", "a\n\nb", "a\r\nb", "it's don't 's",
    "x▁y", "<s> </s> <unk> <|endoftext|>", "nul\x00l", "ﬁ é ＡＢ", "a b", "😀 smile😀", "123 4567.89, (x)", "$$$%%%", "\x85 next",
    "zero​width", "é combining", "日本語 テキスト", "▁", " ", "\n", "a \nb", "a\n b", "word" * 500,
]


def test_alignment_of_odd_texts(spark):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(i, t) for i, t in enumerate([*ODD_TEXTS, *ODD_TEXTS[:9], None, ""])]
    got = alignment.align(spark.createDataFrame(rows, TEXT)).collect()
    want = [(i, *a) for (i, _), a in zip(rows, brute.aligned([t for _, t in rows], plain, pieces))]
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


def test_chunks_equal_whole_texts():
    """Cut texts and whole texts align alike, whatever the cache has dropped."""
    own = alignment.Aligner(*alignment.default_tokenizers(), cache_entries=3)
    text = "Some plain text, it's cut\nat spaces and at lines. " + "tail"
    cut = own.numbers([text])[0]
    assert len(cut) > 5
    whole = own.align([text], whole=True)[0]
    assert b";".join(own.chunks.groups[i] for i in cut) == own.chunks.groups[whole]
    assert sum(own.chunks.n_b[i] for i in cut) == own.chunks.n_b[whole]
    assert [x for i in cut for x in own.chunks.links[i].tolist()] == own.chunks.links[whole].tolist()


def test_equal_texts_are_aligned_once(spark, monkeypatch):
    rows = [(i, "the same text") for i in range(300)] + [(300, "another")]
    measures = alignment.text_measures(spark.createDataFrame(rows, TEXT)).collect()
    assert len(measures) == 2
    assert max(r.count_sum for r in measures) == 300 * max(r.n_links for r in measures)


# ---- language codes ---------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 20])
def test_codewords_are_apart(n):
    words = language_codes.codewords(n)
    distance = (words[:, None, :] != words[None, :, :]).sum(axis=2)[np.triu_indices(n, 1)]
    assert distance.min() >= (2 ** (n - 2) if n <= 5 else words.shape[1] // 5)
    assert ((words > 0).any(axis=0) & (words < 0).any(axis=0)).all()


def test_decoding_corrects_a_wrong_bit():
    words = language_codes.codewords(4)
    bits = words.shape[1]
    codes = language_codes.Codes(list("abcd"), words, np.zeros((4, bits)), np.ones(bits), np.zeros(bits), np.ones(bits))
    z = 5 * words.copy()
    z[:, 0] *= -1  # one classifier is wrong about every language
    place, share, close = language_codes.decode(codes, z)
    assert place.tolist() == [0, 1, 2, 3] and not close.any() and (share > 0.9).all()
    place, share, close = language_codes.decode(codes, np.zeros((1, bits)))
    assert close.all() and share[0] == pytest.approx(0.25)


def test_grams_stay_inside_texts():
    raw, offsets = text_buffer(pa.array(["ab", "", "xyz", None]))
    alone = [list(language_codes.grams(*text_buffer(pa.array([t])))) for t in ("ab", "", "xyz", "")]
    for n, (keys, starts) in enumerate(language_codes.grams(raw, offsets)):
        parts = np.split(keys, starts[1:])
        assert [p.tolist() for p in parts] == [a[n][0].tolist() for a in alone]


def test_many_languages_and_case(spark):
    """Seven invented languages of separate syllables; capitals and punctuation don't matter."""
    rng = np.random.default_rng(1)
    syllables = {f"l{i}": [f"{a}{b}" for a in "bdfgklmnprstvz"[2 * i : 2 * i + 2] for b in "aeiouäé"] for i in range(7)}
    text = lambda lang: " ".join("".join(rng.choice(syllables[lang], 3)) for _ in range(30))
    rows = [(i, text(f"l{i % 7}"), f"l{i % 7}") for i in range(280)]
    rows += [(1000 + i, t.upper() + " !!! 123", lang) for i, t, lang in rows[:70]]
    rows += [(2000, "123 !?", "l0"), (2001, None, "l1"), (2002, "baba dede", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    codes = language_codes.train(docs, docs.doc_id < 210, limit=140)
    assert codes.languages == [f"l{i}" for i in range(7)]
    got = {r.doc_id: r for r in language_codes.predict(docs, codes).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if i < 2000)
    assert got[2000].lang_pred == got[2001].lang_pred == "und" and got[2002].lang_pred in codes.languages


def test_one_language_and_none(spark):
    docs = spark.createDataFrame([(1, "ein Text", "de"), (2, "noch einer", "de"), (3, "7", "de"), (4, None, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_codes.predict(docs, language_codes.train(docs, docs.doc_id > 0)).collect()}
    assert got == {1: ("de", 1.0), 2: ("de", 1.0), 3: ("und", 0.0), 4: ("und", 0.0)}
    got = language_codes.predict(docs, language_codes.train(docs, docs.doc_id < 0)).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got)


def test_training_is_bounded(spark):
    rows = [(i, f"text number {i}", "en" if i % 3 else "de") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language_codes._sample(docs, docs.doc_id >= 0, "doc_id", "text", "lang", 50)
    counts = {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert counts == {"en": 25, "de": 25}


# ---- token ids ----------------------------------------------------------------------------------------
@pytest.mark.parametrize("cache_entries", [3, 40, 100_000])
def test_cut_and_cached_ids_equal_plain_ones(cache_entries):
    from tokenizers import Tokenizer

    from fleetsight.llm import tokens

    plain = Tokenizer.from_file(tokens.default_tokenizer())
    own = tokens.Encoder(tokens.default_tokenizer(), cache_entries)
    rng = np.random.default_rng(4)
    words = ["word", "Words,", "été.", "ÉTÉ", "ß,", "x2", "it's", "日本語", "a.b", "...", "$$$", "ʰ", "ª.", "١٢", "é", "ǅ", "end."]
    texts = [*ODD_TEXTS, "", "a.\n.b", "\n\n", "q <|endoftext|> r"]
    texts += [" ".join(rng.choice(words, 30)).replace(" word", "\nword") for _ in range(40)]
    for at in range(0, len(texts), 7):
        run = texts[at : at + 7]
        want = [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in run]
        assert own.encode(run) == want
    assert own.encode([]) == []
