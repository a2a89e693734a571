"""SimHash near-dedup (4) and the pipeline, against brute force."""

import random
import re

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import edge_docs, edge_rows, frame, no_docs, sorted_rows, words
from pyspark.sql import functions as F

from cartwise.llm import simhash


def brute_fingerprint(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB cÉ\t\n\x1c漢", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % (1 << 64) == brute_fingerprint(text)


def brute_groups(fps, distance=4):
    """For each fingerprint, the place of one that stands for its component."""
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                label[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def least_ids(ids, groups):
    """The smallest id of each group."""
    return {g: min((x for x, h in zip(ids, groups) if h == g and x is not None), default=None) for g in set(groups)}


def brute_components(ids, fps):
    groups = brute_groups(fps)
    least = least_ids(ids, groups)
    return [least[g] for g in groups]


def near(rng, base, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def linked(spark, fps, monkeypatch, crowd=1024, distance=4):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    nodes = spark.createDataFrame([(simhash._signed(x),) for x in sorted(set(fps))], "fp long")
    first = simhash.stored(simhash.components(nodes, simhash.chain_links(nodes, distance)), "t")
    heads = first.select(F.col("comp").alias("fp")).distinct()
    second = simhash.components(heads, simhash.cross_links(first, distance)).toDF("comp", "top")
    return {r["fp"] % (1 << 64): r["top"] for r in first.join(second, "comp").collect()}


def test_links_of_planted_groups(spark, monkeypatch):
    rng = random.Random(1)
    fps = []
    for _ in range(30):
        x = rng.getrandbits(64)
        fps += [x, near(rng, x, 4), near(rng, x, 5), near(rng, near(rng, x, 4), 4)]
    x = rng.getrandbits(64)
    fps += [near(rng, x, rng.randint(0, 2)) for _ in range(150)]  # one large group
    fps = sorted(set(fps))
    want = brute_components(fps, fps)
    for crowd in (1024, 2):
        got = linked(spark, fps, monkeypatch, crowd)
        same = {}
        for f, w in zip(fps, want):
            assert same.setdefault(w, got[f]) == got[f]
        assert len(set(got.values())) == len(set(want))


def test_variants_of_other_distances():
    for distance in range(1, 9):
        cuts = simhash.segments(distance)
        assert sum(n for _, n in cuts) == 64 and len(cuts) == distance // 2 + 1


def test_cluster_and_representatives(spark):
    rng = random.Random(3)
    long = words(rng, 400)
    extra = [(80, long, "en"), (79, long + " more", "en"), (81, long.upper(), "en")]
    docs = edge_docs(spark, extra)
    rows = edge_rows(extra)
    fps = [brute_fingerprint(r[1]) for r in rows]
    comps = brute_components([r[0] for r in rows], fps)
    got = simhash.cluster(docs)
    assert got.first()["slot"] == "own slot"
    assert sorted_rows(got, "doc_id", "fingerprint", "component_id") == sorted(((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, comps)), key=repr)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns and kept.first()["fingerprint"] == "own fingerprint"
    ids = [r[0] for r in kept.select("doc_id").collect()]
    least = least_ids([r[0] for r in rows], brute_groups(fps))
    assert sorted(ids, key=repr) == sorted(least.values(), key=repr)
    assert simhash.cluster(no_docs(spark)).collect() == [] and simhash.representatives(no_docs(spark)).collect() == []


def test_pipeline_against_its_operators(spark):
    """Each stage works on what the one before kept; the result is what plain Python says of the last texts."""
    import hashlib

    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline
    from cartwise.llm import surrogates
    from conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, texts = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = simhash.stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= before.keys()
        if name == "near_duplicates":
            order = sorted(before)
            assert sorted(ids) == sorted(set(brute_components(order, [brute_fingerprint(before[i]) for i in order])))
        if name == "quality":
            assert 0.8 * len(before) < len(ids) < len(before)
        if name == "surrogates":
            assert out.where(F.col("n_chars") != F.char_length("text")).count() == 0
            assert surrogates.entities(docs).count() > 0
        if name != "tokens":
            assert out.columns == columns
            docs, texts = out, None
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        ids = library.encode(texts.pop(r["doc_id"]), add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert not texts


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 11)) and "pipeline" in names


def test_frames_with_only_the_needed_columns(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e")]
    got = simhash.cluster(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted_rows(got, "doc_id", "component_id") == [(1, 1), (2, 1)]
    assert frame(spark, []).count() == 0
