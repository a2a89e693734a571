"""BPE (3) and separator scan (7) against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import edge_docs, edge_rows, no_docs, sorted_rows
from tokenizers import Tokenizer

from cartwise.llm import bpe, separators

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    return bpe.Bpe.from_json(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


TRICKY = "aab cde  \n\t\r\x0b\x1c\x85  'sdtreÉñ漢字\U0001f6420123²½Ⅷ!?.,<|endoftext|>́\0\x7f"


@settings(max_examples=200, deadline=None)
@given(text=st.one_of(st.text(alphabet=TRICKY, max_size=60), st.text(max_size=40), st.sampled_from(
    ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "a" * 3000, "the" * 700, "I'll don't 'S"])))
def test_ids_and_round_trip(model, library, text):
    text = text.encode("utf-8", "replace").decode()
    ids, at = bpe.Encoder(model).encode([text, "", text])
    want = library.encode(text, add_special_tokens=False).ids
    assert ids[:at[1]].tolist() == want and at[2] == at[1] and ids[at[2]:].tolist() == want
    data, ends = model.decode(ids, at)
    assert data.tobytes()[ends[0]:ends[1]].decode() == text == library.decode(want, skip_special_tokens=False)


def test_only_failing_words_are_merged_exactly(model):
    words = [w.encode() for w in "the tiontion thereer reentst ingthe a".split()]
    proposed = [model.speculate(w) for w in words]
    exact = [model._merge(w)[0] for w in words]
    fine = [all(model.compatible(np.array(p[:-1], int), np.array(p[1:], int))) for p in proposed]
    assert [p == e for p, e in zip(proposed, exact)] == fine and not all(fine) and any(fine)
    assert model.encode_words(words) == exact
    long = bytes(random.Random(1).choice(b"theinr") for _ in range(400))
    assert model._merge_long(long[:40])[0] == model._merge(long[:40])[0]


def test_digest_of_edge_cases(spark, model, library):
    docs = edge_docs(spark, [(20, "x<|endoftext|>y", None)]).select("doc_id", "text", "n", "n_words")
    got = sorted_rows(bpe.digest(docs, model), "doc_id", "n", "n_tokens", "ids_sha256", "decoded_sha256")

    def want(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return (i, "own n", len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())

    assert got == sorted((want(r[0], r[1]) for r in [*edge_rows(), (20, "x<|endoftext|>y")]), key=repr)
    assert bpe.digest(no_docs(spark), model).collect() == []


def test_bytes_that_are_no_text(model):
    ids = np.array([model.vocab[b"\xc3"], model.vocab[b"a"]], np.int32)
    data, ends = model.decode(ids, np.array([0, 2]))
    assert data.tobytes().decode() == "�a" and ends.tolist() == [0, 4]


def test_separator_scan_counts_documents(spark, model, library):
    library.encode_special_tokens = True
    docs = edge_docs(spark, [(21, "x<|endoftext|>y", None)])
    stream = separators.write_stream(docs, model, 50256, block=64)
    counted = separators.count_tokens(stream.where("tokens is not null"), 50256)
    got = separators.document_tokens(docs, model, 50256)
    want = sorted(((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in [*edge_rows(), (21, "x<|endoftext|>y")]), key=repr)
    library.encode_special_tokens = False
    assert sorted_rows(got, "doc_id", "n_tokens") == want
    assert sorted(r[0] for r in counted.select("n_tokens").collect()) == sorted(n for _, n in want)
    assert separators.document_tokens(no_docs(spark), model, 50256).collect() == []


@pytest.mark.parametrize("run", [2, 1024])
def test_separator_scan_against_brute_force(spark, tmp_path, monkeypatch, run):
    monkeypatch.setattr(separators, "RUN", run)
    rng, want = np.random.default_rng(4), []
    for f in range(3):
        tokens = rng.integers(0, 50_000, 700).astype("<u2")
        tokens[rng.random(700) < (0.2, 0.004, 0.0)[f]] = 50_256
        tokens[[5, 6, 7]] = 50_256 if f < 2 else 1
        tokens.tofile(tmp_path / f"{f}.bin")
        start = 0
        for i, end in enumerate([*np.flatnonzero(tokens == 50_256).tolist(), 700]):
            if end < 700 or start < 700:
                want.append((f, i, start, end - start, end < 700))
            start = end + 1
    blocks = separators.read_files(spark, str(tmp_path), 50_256, block=32)
    assert blocks.count() == 3 * 22
    assert sorted_rows(separators.count_tokens(blocks, 50_256), "file", "ordinal", "start", "n_tokens", "ended") == sorted(want, key=repr)


def test_streams_wider_than_the_separator(spark, model, tmp_path):
    """Ids beyond 16 bits with a separator below them: the stream's width is the vocabulary's, not the separator's."""
    wide = bpe.Bpe(model.vocab, [tuple(model.vocab[t] for t in (b"t", b"h", b"th"))], {"<far>": 70_000})
    end = model.vocab[b"~"]
    texts = ["abc", "", "h\u00e9llo", "x" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = separators.document_tokens(docs, wide, end)
    assert sorted_rows(got, "doc_id", "n_tokens") == [(i, len(t.encode())) for i, t in enumerate(texts)]
    tokens = np.array([70_000, 5, end, 66_000, end + (1 << 16), end, 7], "<u4")
    tokens.tofile(tmp_path / "0.bin")
    blocks = separators.read_files(spark, str(tmp_path), end, block=2, kind="<u4")
    assert sorted_rows(separators.count_tokens(blocks, end, "<u4"), "start", "n_tokens", "ended") == [(0, 2, True), (3, 2, True), (6, 1, False)]


def test_digests_hold_little_at_a_time(model):
    """What a worker holds while it digests a batch does not grow with the batch; frequent resets of the table of words change nothing."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(2)
    texts = [" ".join(rng.choice(("the", "of", "and", f"w{rng.randrange(3000)}")) for _ in range(400)).encode() for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([*texts[:-1], None], pa.binary())], ["doc_id", "_text"])
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    peaks, rows = [], []
    for part in (batch.slice(0, 1000), batch):
        tracemalloc.start()
        rows.append([r for b in bpe.digests(iter([part]), model, names) for r in b.to_pylist()])
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
    assert len(rows[1]) == 4000 and rows[1][:1000] == rows[0] and rows[1][-1]["n_tokens"] == 0
    assert peaks[1] < peaks[0] + 15 and peaks[1] < 80, peaks
    bpe.MAX_WORDS, most = 500, bpe.MAX_WORDS
    try:
        assert [r for b in bpe.digests(iter([batch]), model, names) for r in b.to_pylist()] == rows[1]
    finally:
        bpe.MAX_WORDS = most
