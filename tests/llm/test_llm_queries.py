"""The registered queries against plain versions, on tables with odd rows and on the smallest real ones."""

import collections
import hashlib
import zlib

import brute
import numpy as np
import pytest
from odd_tables import SF_SMALL, empty, odd  # noqa: F401

from fleetsight.llm import queries as llm

Q = llm.queries()


def rows_of(spark, folder, table="documents"):
    return spark.read.parquet(f"{folder}/{table}.parquet").collect()


def by(rows, *names):
    """Counts of rows as tuples, so that repeated rows count."""
    return collections.Counter(tuple(r[n] for n in names) for r in rows)


@pytest.fixture(scope="module", params=["odd", "small"])
def folder(request):
    return request.getfixturevalue("odd") if request.param == "odd" else SF_SMALL


@pytest.mark.parametrize("name", sorted(Q))
def test_empty_tables(spark, empty, name):
    assert Q[name](spark, empty).collect() == []


def test_op1(spark, folder):
    docs = [(r.doc_id, r.text) for r in rows_of(spark, folder)]
    got = Q["op1_context_mixing"](spark, folder).collect()
    want = collections.Counter((d, brute.crc(d) % 5 == 1, *u[:3], round(u[3], 5)) for (d, _), u in zip(docs, brute.unigram(docs)))
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 and np.isfinite(r.score) for r in got)
    sizes = collections.Counter((d, len((t or "").encode())) for d, t in docs)
    assert by(got, "doc_id", "n_bytes") == sizes


def test_op2(spark, folder):
    docs = [(r.doc_id, len(brute.words(r.text)), r.source) for r in rows_of(spark, folder)]
    got = Q["op2_source_mixture"](spark, folder).collect()
    sizes = collections.Counter()
    for _, n, s in docs:
        sizes[s] += n
    want = brute.targets(dict(sizes))
    assert collections.Counter((r.doc_id, r.size, r.source_size, round(r.target, 4)) for r in got) == collections.Counter(
        (d, n, sizes[s], round(want[s], 4)) for d, n, s in docs
    )
    assert all(r.taken <= 3 * r.size for r in got)
    taken = collections.Counter()
    for r in got:
        taken[(r.source_size, round(r.target, 4))] += r.taken
    due = collections.Counter()
    for s, n in sizes.items():
        due[(n, round(want[s], 4))] += want[s]
    assert all(abs(taken[k] - v) <= 1 + len(sizes) for k, v in due.items())
    again = Q["op2_source_mixture"](spark, folder).collect()
    assert by(got, "doc_id", "size", "taken") == by(again, "doc_id", "size", "taken")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    from fleetsight.llm import tokens

    return Tokenizer.from_file(tokens.default_tokenizer())


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_op3(spark, folder, tokenizer):
    docs = [(r.doc_id, ids_of(tokenizer, r.text, 1)) for r in rows_of(spark, folder)]
    got = Q["op3_window_packing"](spark, folder).collect()
    pieces = collections.defaultdict(list)
    for r in got:
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, r.length, r.ids_crc32))
    whole = collections.defaultdict(list)
    for d, ids in docs:
        whole[(d, len(ids))].append(ids)
    assert set(pieces) == set(whole)
    for key, found in pieces.items():
        copies = whole[key]
        assert sum(n for _, n, _ in found) == key[1] * len(copies)
        possible = {(s, n, zlib.crc32(ids[s : s + n].tobytes())) for ids in copies for s, n, _ in found}
        assert set(found) <= possible
        if len(copies) == 1:
            at = 0
            for s, n, _ in sorted(found):
                assert s == at
                at += n
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048


def test_op4(spark, folder):
    docs = rows_of(spark, folder)
    got = Q["op4_secret_scan"](spark, folder).collect()
    want = collections.Counter()
    for r in docs:
        spans = brute.base_spans(r.text)
        kinds = collections.Counter(s.split(":")[0] for s in spans)
        want[(r.doc_id, kinds["assign"], kinds["access"], kinds["hex"], brute.sha(spans))] += 1
    assert by(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want
    for r in got:
        base = [s for s in r.spans.split(",") if s and not s.startswith("novel")]
        assert brute.sha(base) == r.base_sha256


def test_op5(spark, folder):
    rows = rows_of(spark, folder, "embeddings")
    got = Q["op5_projection_forest"](spark, folder).collect()
    links = brute.cosine_links([list(r.embedding) if r.embedding is not None else None for r in rows])
    n = collections.Counter(x for pair in links for x in pair)
    least = {}
    component = brute.components(list(range(len(rows))), links)
    for i, r in enumerate(rows):
        if r.vec_id is not None:
            least[component[i]] = min(least.get(component[i], r.vec_id), r.vec_id)
    want = collections.Counter()
    for i, r in enumerate(rows):
        c = least.get(component[i])
        want[(r.vec_id, n[i], c, c == r.vec_id)] += 1
    assert by(got, "vec_id", "n_links", "component_id", "kept") == want


def test_op6(spark, folder):
    docs = rows_of(spark, folder)
    got = Q["op6_minhash"](spark, folder).collect()
    sets = [brute.shingles(r.text, 2) for r in docs]
    fit = [i for i, r in enumerate(docs) if r.doc_id is not None]
    component = brute.components(fit, [(fit[i], fit[j]) for i, j in brute.similar([sets[i] for i in fit])])
    least = {}
    for i in fit:
        least[component[i]] = min(least.get(component[i], docs[i].doc_id), docs[i].doc_id)
    want = collections.Counter()
    for i, r in enumerate(docs):
        c = least[component[i]] if r.doc_id is not None else None
        want[(r.doc_id, len(sets[i]), c, c == r.doc_id)] += 1
    assert by(got, "doc_id", "n_shingles", "component_id", "kept") == want


def test_op7(spark, folder):
    pages = rows_of(spark, folder, "pages")
    got = Q["op7_warc_archive"](spark, folder).collect()
    first = {}
    for r in pages:
        if r.page_id is not None and len((r.html or "").encode()) >= 100:
            first[r.html] = min(first.get(r.html, r.page_id), r.page_id)
    want = collections.Counter()
    for r in pages:
        payload = (r.html or "").encode()
        refers = first.get(r.html) if len(payload) >= 100 else None
        copy = refers is not None and refers != r.page_id
        want[(r.page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if copy else "response", refers if copy else None)] += 1
    assert by(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == want


def test_op8_rows(spark, folder):
    docs = rows_of(spark, folder)
    got = Q["op8_quality_scores"](spark, folder).collect()
    assert by(got, "doc_id", "held_out") == collections.Counter((r.doc_id, brute.crc(r.doc_id) % 4 == 2) for r in docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_op8_held_out(spark):
    got = {r.doc_id: r for r in Q["op8_quality_scores"](spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.quality for r in rows_of(spark, "/root/testdata/sf0.01", "labels")}
    held = [d for d in labels if d in got and got[d].held_out]
    right = sum(got[d].predicted == labels[d] for d in held)
    assert len(held) > 50 and right / len(held) >= 0.95


def test_op9(spark, folder):
    docs = rows_of(spark, folder)
    got = Q["op9_host_rules"](spark, folder).collect()
    want = collections.Counter()
    for r in docs:
        f = brute.rules(r.text)
        want[(r.doc_id, *f, f[0] < 50 or 100 * f[4] > 50 * f[0])] += 1
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert by(got, *names) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_op10(spark, folder, tokenizer):
    docs = [(r.doc_id, ids_of(tokenizer, r.text, 2)) for r in rows_of(spark, folder)]
    got = sorted(Q["op10_id_store"](spark, folder).collect(), key=lambda r: r.start)
    assert by(got, "doc_id", "n_tokens", "ids_crc32") == collections.Counter((d, len(i), zlib.crc32(i.tobytes())) for d, i in docs)
    at, before = 0, None
    for r in got:
        assert r.start == at
        assert before is None or r.doc_id is None or before <= r.doc_id
        assert before is None or r.doc_id is not None
        at, before = at + r.n_tokens, r.doc_id


def test_op11(spark, folder):
    docs = [(r.doc_id, r.text) for r in rows_of(spark, folder)]
    items = [(r.item_id, r.text) for r in rows_of(spark, folder, "benchmark")]
    got = Q["op11_lexical_search"](spark, folder).collect()
    assert by(got, "item_id", "rank", "doc_id", "score") == collections.Counter(brute.ranked(docs, items))


def test_op12(spark, folder):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = rows_of(spark, folder)
    got = Q["op12_token_alignment"](spark, folder).collect()
    want = [(d.doc_id, *a) for d, a in zip(docs, brute.aligned([d.text for d in docs], plain, pieces))]
    assert by(got, "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256") == collections.Counter(want)


def test_op13_rows(spark, folder):
    docs = rows_of(spark, folder)
    got = Q["op13_language_codes"](spark, folder).collect()
    assert by(got, "doc_id", "held_out") == collections.Counter((r.doc_id, brute.crc(r.doc_id) % 4 == 2) for r in docs)
    learned = {r.lang for r in docs if r.lang is not None and brute.crc(r.doc_id) % 4 != 2}
    without = collections.Counter(r.doc_id for r in docs if not any(c.isalpha() for c in r.text or ""))
    assert collections.Counter(r.doc_id for r in got if r.lang_pred == "und") == without
    assert all(r.lang_pred in learned | {"und"} and 0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 and not r.ambiguous for r in got if r.lang_pred == "und")


def test_op13_held_out(spark):
    got = {r.doc_id: r for r in Q["op13_language_codes"](spark, "/root/testdata/sf0.01").collect()}
    docs = rows_of(spark, "/root/testdata/sf0.01")
    held = [r for r in docs if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in held)
    assert len(held) > 200 and right / len(held) >= 0.99
