"""Token counts and packed ids against the public libraries."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shroud.llm import catalog, packing, token_counts
from shroud.llm.common import small_batches

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
PIECES, WORDS = catalog.tokenizer("piece_bpe_32k.model"), catalog.tokenizer("word_bpe_49k.json")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
TOKENIZER = tokenizers.Tokenizer.from_file(WORDS)
COUNTER, ENCODER = token_counts.PieceCounter(PIECES, memory=50), packing.WordEncoder(WORDS, memory=50)
#: Null, empty, special strings, rare scripts, runs of spaces, a very long text, and repeats.
TEXTS = [None, "", " ", "\n\n", "a", "Hello  world\n\n<s> </s> <|endoftext|> <|STARTOFTEXT|>", "É ñ ß ΣΑΣ İ ǅ ½ ª 日本語 😀 e\u0301 \u200b\x1c\x85\xa0x", "don't I'LL 12345 foo.bar,baz!! ### ▁▁x ▁", "word " * 30_000, "x" * 20_000, "same", "same"]
text = st.lists(st.sampled_from(list("abeEÉñß .,!'#<|>\n\t▁12日\u0301İΣ\x1f\xa0") + ["the", "<s>", "<|endoftext|>", "  ", "'s"]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(text)
def test_counts_are_the_librarys(t):
    assert COUNTER.count(t) == len(LIBRARY.encode(t))
    COUNTER.forget()


@settings(max_examples=300, deadline=None)
@given(st.lists(text, max_size=4))
def test_ids_are_the_librarys(texts):
    want = [np.array(e.ids, "<u4").tobytes() for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert ENCODER.encode(texts) == want


def frame(spark):
    rows = [(None if i == 3 else i, t, i, "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, sequence_id string").repartition(3)


def test_count_query(spark):
    got = sorted(map(tuple, token_counts.count_tokens(frame(spark), PIECES).collect()), key=str)
    want = [(None if i == 3 else i, len((t or "").encode()), n := len(LIBRARY.encode(t or "")), n > 4096) for i, t in enumerate(TEXTS)]
    assert got == sorted(want, key=str)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=6), st.integers(5, 60))
def test_closest_fill(counts, capacity):
    sums = {0}
    for length, many in counts.items():
        sums = {s + k * length for s in sums for k in range(many + 1) if s + k * length <= capacity}
    chosen = packing.closest_fill(counts, capacity)
    assert all(0 < k <= counts[n] for n, k in chosen.items())
    assert sum(n * k for n, k in chosen.items()) == max(sums)


@pytest.mark.parametrize(("pool", "keep"), [(4, True), (4096, False)])
def test_packing_keeps_every_id_once(spark, pool, keep):
    rows = packing.pack_documents(frame(spark), WORDS, pool=pool, keep=keep).collect()
    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert len(documents) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = np.array([*TOKENIZER.encode(t or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        pieces = sorted(documents[None if i == 3 else i, len(ids)], key=lambda r: r.start)
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.CAPACITY and at & (at - 1) == 0  # full, or a power of two: nothing is padded
    assert sum(r.length for r in rows) == sum(n for _, n in documents)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none, PIECES).collect() == packing.pack_documents(none, WORDS).collect() == []


def test_small_batches_leave_a_setting_as_it_is(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        small_batches(spark, 1000)
        small_batches(spark, 2000)
        assert spark.conf.get(name) == "1000"
        assert packing.pack_documents(frame(spark), WORDS).count() >= len(TEXTS)
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def test_memories_hold_no_long_words():
    """A hundred megabytes of words of 5 KB: none is remembered."""
    from shroud.llm import decontamination, ngrams

    counter, encoder, scores = token_counts.PieceCounter(PIECES), packing.WordEncoder(WORDS), ngrams.WordScores(np.zeros((1 << 10, 1), np.float32), 3, 5)
    decontamination._hashes.clear()
    rng = np.random.default_rng(2)
    base = "".join(chr(c) for c in rng.integers(97, 123, 5000))
    for k in range(40):
        texts = [f"{base[i:]}{k}x{i}{base[:i]}" for i in range(500)]
        if k % 20 == 0:
            assert counter.count(texts[0]) == len(LIBRARY.encode(texts[0]))
            assert encoder.encode(texts[:3]) == [np.array(TOKENIZER.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts[:3]]
            assert len(scores.of(texts[:20])) == 20
        decontamination.seed_hashes(texts, [1])
    held = [counter.chunks, counter.stretches, encoder.chunks, encoder.words, scores.index, decontamination._hashes]
    assert sum(len(w) for memory in held for w in memory) < 100_000


def test_lengths_that_fill_a_sequence_are_paired_without_a_search(monkeypatch):
    monkeypatch.setattr(packing, "closest_fill", None)
    packer = packing.Packer(0, capacity=64)
    for i, length in enumerate([40, 24, 24, 40, 32, 32, 1, 63]):
        packer.add(i, bytes(4 * length))
    packer.finish()
    assert sorted(r[5] for r in packer.out) == [0, 0, 1, 1, 2, 2, 3, 3] and not packer.waiting


def test_each_distinct_chunk_of_a_call_is_looked_up_once(monkeypatch):
    encoder, asked = packing.WordEncoder(WORDS), []
    monkeypatch.setattr(encoder, "_ids_of", lambda chunks, f=encoder._ids_of: asked.append(chunks) or f(chunks))
    texts = [" one two,  two,", "ONE\x0bone two, \x85", ""]
    assert encoder.encode(texts) == [np.array(TOKENIZER.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert sorted(c for c in asked[0] if c) == ["one", "two,"]


def test_an_encoder_is_made_without_a_copy_of_its_file():
    import tracemalloc

    tracemalloc.start()
    try:
        packing.WordEncoder(WORDS)
        assert tracemalloc.get_traced_memory()[1] < 15 << 20
    finally:
        tracemalloc.stop()
