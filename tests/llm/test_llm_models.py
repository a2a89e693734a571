"""Pitman-Yor scoring (1) and the Kneser-Ney classifier (2)."""

import math
import random
import zlib
from collections import Counter
from itertools import product
from pathlib import Path

import numpy as np
import pytest
from llm_fixtures import edge_docs, edge_rows, frame, no_docs, sorted_rows, words
from pyspark.sql import functions as F

from cartwise.llm import hpyp, kneser_ney



def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1


QUICK = hpyp.Settings(burn_in=1, samples=2, head=20)


def test_stirling_numbers_and_block_draws():
    d, strength, parent = 0.4, 1.5, 0.2

    def weight(tables):  # of one seating of c customers, by table sizes
        out = 1.0
        for j, size in enumerate(tables):
            out *= (strength + d * j) * parent * math.prod(k - d for k in range(1, size))
        return out

    def seatings(c):  # all ways to seat c customers in order
        for choice in product(range(c), repeat=c):
            if all(x <= max(choice[:i], default=-1) + 1 for i, x in enumerate(choice)):
                yield list(Counter(choice).values())

    want = Counter()
    for tables in seatings(5):
        want[len(tables)] += weight(tables)
    total = sum(want.values())
    n = 40_000
    got = Counter(hpyp.seat(np.full(n, 5), np.zeros(n), np.full(n, parent), d, strength, np.random.default_rng(1)).tolist())
    assert all(abs(got[t] / n - want[t] / total) < 0.01 for t in range(1, 6))


@pytest.mark.parametrize("total, parent, d, strength", [(0, 0.3, 0.5, 2.0), (1000, 0.001, 0.7, 1.0), (50_000, 0.001, 0.8, 1.0)])
def test_large_counts_continue_small_ones(total, parent, d, strength):
    """The limit used beyond EXACT customers agrees with the exact draws at EXACT."""
    n = 20_000
    draw = lambda c: hpyp.seat(np.full(n, c), np.full(n, float(total)), np.full(n, parent), d, strength, np.random.default_rng(c))
    exact, limit = draw(hpyp.EXACT), draw(hpyp.EXACT + 1)
    assert abs(limit.mean() / exact.mean() - 1) < 0.03 and abs(limit.std() / exact.std() - 1) < 0.05
    edge = hpyp.seat(np.array([0, 1, 2, 10**12]), np.zeros(4), np.full(4, 0.3), 0.5, 2.0, np.random.default_rng(1))
    assert edge[:2].tolist() == [0, 1] and 1 <= edge[3] < 1000


def test_probabilities_of_a_restaurant_add_up_to_one():
    rng = np.random.default_rng(3)
    every = np.arange(65_536)
    c = np.where(rng.random(65_536) < 0.05, rng.integers(1, 9, 65_536), 0)
    p, _ = hpyp.sample_tree(every, c, np.full(256, 1 / 256), range(1, -1, -1), 0.5, QUICK, rng)
    assert np.allclose(p.reshape(256, 256).sum(axis=1), 1)


def _brute_base(rows, held):
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for _, t, *_ in rows]
    c = Counter(w for r, ws in zip(rows, tokens) if not held(r[0]) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(r[0], held(r[0]), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4))
            for r, ws in zip(rows, tokens)]


def test_scores_edge_cases(spark):
    got = hpyp.score(edge_docs(spark), held_out=held_out(), settings=QUICK)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    base = got.withColumn("base_score", F.round("base_score", 4))
    assert sorted_rows(base, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score") == sorted(_brute_base(edge_rows(), held), key=repr)
    scores = [r["score"] for r in got.collect()]
    assert all(math.isfinite(s) and s <= 0 for s in scores)
    assert hpyp.score(no_docs(spark), settings=QUICK).collect() == []


def test_words_and_the_unknown_one_add_up_and_beat_the_base(spark, monkeypatch):
    rng = random.Random(5)
    docs = frame(spark, [(i, words(rng, 80), "en", "s", 0) for i in range(120)])
    kept = {}
    model = hpyp.word_model
    monkeypatch.setattr(hpyp, "word_model", lambda *a: kept.setdefault("lm", model(*a)))
    got = hpyp.score(docs, held_out=held_out(), settings=QUICK).toPandas()
    lm, unknown = kept["lm"]
    assert abs(lm.agg(F.sum(F.pow(F.lit(10.0), "score"))).first()[0] + 10**unknown - 1) < 1e-6
    held = got[got.held_out]
    assert len(held) and held.score.sum() > held.base_score.sum()
    again = hpyp.score(docs, held_out=held_out(), settings=QUICK).toPandas()
    assert np.allclose(got.sort_values("doc_id").score, again.sort_values("doc_id").score)


def test_unknown_words_are_spelled_and_any_column_holds_out(spark):
    """A new word of known syllables is likelier than one of none; hold-outs may come from a column that the result lacks."""
    rng = random.Random(25)
    known = [(i, words(rng, 60), "en", "train", 0) for i in range(60)]
    asked = [(100, "therention", "en", "ask", 0), (101, "xqzvkwjbpg", "en", "ask", 0), (102, "therentiontherention", "en", "ask", 0)]
    docs = frame(spark, [*known, *asked])
    rows = {r["doc_id"]: r for r in hpyp.score(docs, held_out=F.col("source") == "ask", settings=QUICK).collect()}
    assert {i for i, r in rows.items() if r["held_out"]} == {100, 101, 102}
    assert rows[100]["n_known"] == rows[101]["n_known"] == 1  # the end
    assert rows[100]["base_score"] == rows[101]["base_score"] and rows[100]["score"] == rows[101]["score"]
    assert rows[100]["spelled_score"] > rows[101]["spelled_score"] + 2 and rows[102]["spelled_score"] < rows[100]["spelled_score"] < rows[100]["score"]


def test_sampled_tables_reach_the_spelling(spark):
    """In the second pass words with more tables send more customers to their spelling."""
    vocabulary = hpyp.stored(spark.createDataFrame([(bytearray(b"often"), 5000), (bytearray(b"rare"), 1), (bytearray(b"never"), 0)], "word binary, c long"), "t")
    counts = hpyp.stored(hpyp.spelling_counts(vocabulary), "t")
    keys = {w: set(hpyp.spell_keys([w])[0].tolist()) for w in (b"often", b"rare", b"never")}
    first = {r["key"]: r["c"] for r in counts.collect()}
    assert all(first[k] == 1 for k in keys[b"often"] | keys[b"rare"]) and all(first[k] == 0 for k in keys[b"never"])
    model = hpyp.stored(hpyp.spelling_model(counts, 0.5, QUICK), "t")
    spelled = hpyp.stored(hpyp.spell(vocabulary, model), "t")
    assert all(math.isfinite(r["spelled"]) and r["spelled"] < 0 for r in spelled.collect())
    t = {r["h"]: r["t"] for r in hpyp.word_tables(spelled, 2, 0, 0.9, QUICK).collect()}
    assert t[hpyp.word_hash(b"often")] > 1 == t[hpyp.word_hash(b"rare")] and t[hpyp.word_hash(b"never")] == 0
    sent = vocabulary.withColumn("t", F.when(F.col("c") > 100, 7).otherwise(1))
    again = {r["key"]: r["c"] for r in hpyp.spelling_counts(sent, "t").collect()}
    assert all(again[k] == 7 for k in keys[b"often"]) and all(again[k] == 1 for k in keys[b"rare"])


def test_word_order_counts(spark):
    """A held-out text in the order of the training texts is likelier than the same words reversed or shuffled."""
    rng = random.Random(11)
    line = "the old grey cat sat on a warm mat by our front door".split()
    train = [(i, " ".join(rng.choice([line, line[:7], line[5:]])), "en", "train", 0) for i in range(80)]
    mixed = random.Random(3).sample(line, len(line))
    asked = [(100 + i, " ".join(w), "en", "ask", 0) for i, w in enumerate((line, line[::-1], mixed))]
    got = {r["doc_id"]: r for r in hpyp.score(frame(spark, [*train, *asked]), held_out=F.col("source") == "ask", settings=QUICK).collect()}
    assert len({round(got[i]["base_score"], 6) for i in (100, 101, 102)}) == 1
    assert got[100]["score"] > max(got[101]["score"], got[102]["score"]) + 3


def test_scores_follow_from_the_restaurants(spark, monkeypatch):
    """The probabilities after a context add up to one, plain Python over the tables gives the scores, and neither depends on
    how many words and pairs are looked up before the joins."""
    rng = random.Random(8)
    rows = [(i, words(rng, 30), "en", "s", 0) for i in range(60)] + [(60, "", "en", "s", 0), (61, None, "en", "s", 0)]
    docs, kept = frame(spark, rows), {}
    model, seat = hpyp.word_model, hpyp.seat_pairs

    def word_model(*a):
        kept["d"], kept["lm"] = a[3], model(*a)
        return kept["lm"]

    def seat_pairs(pairs, lm, turn, d, s):
        kept["pairs"], kept["pair_d"] = pairs, d
        kept["seated"] = seat(pairs, lm, turn, d, s)
        return kept["seated"]

    monkeypatch.setattr(hpyp, "word_model", word_model)
    monkeypatch.setattr(hpyp, "seat_pairs", seat_pairs)
    got = {r["doc_id"]: r for r in hpyp.score(docs, held_out=held_out(), settings=QUICK).collect()}
    lm, unknown = {r["h"]: 10 ** r["score"] for r in kept["lm"][0].collect()}, 10 ** kept["lm"][1]
    d, strength = kept["pair_d"], QUICK.strength
    pairs = {(r["u"], r["w"]): r["c"] for r in kept["pairs"].collect()}
    seated = kept["seated"].collect()
    tables = {(r["u"], r["w"]): r["t"] for r in seated if r["w"] is not None}
    assert tables.keys() == {k for k, c in pairs.items() if c > 1} and all(1 <= t <= pairs[k] for k, t in tables.items())
    every, customers = {r["u"]: r["t"] for r in seated if r["w"] is None}, Counter()
    for (u, _), c in pairs.items():
        customers[u] += c
    for u, t in every.items():
        assert abs(t - sum(tables.get(k, 1) for k in pairs if k[0] == u)) < 1e-9

    def p(u, w):
        c, n = pairs.get((u, w), 0), customers[u]
        return ((c - d * tables.get((u, w), 1) if c else 0) + (strength + d * every.get(u, 0)) * lm.get(w, unknown)) / (strength + n)

    for u in list(every)[:5]:
        assert abs(sum(p(u, w) for w in lm) + p(u, None) - 1) < 1e-6
    for i, text, *_ in rows:
        hashes = [hpyp.word_hash(w) for w in hpyp.words_of((text or "").encode())]
        before = [hpyp.word_hash(hpyp.END), *hashes[:-1]]
        assert abs(got[i]["score"] - sum(math.log10(p(u, w)) for u, w in zip(before, hashes))) < 1e-6
    for head, head_pairs in ((0, 0), (300, 50), (10**6, 10**6)):
        other = hpyp.score(docs, held_out=held_out(), settings=hpyp.Settings(burn_in=1, samples=2, head=head, head_pairs=head_pairs))
        for r in other.collect():
            assert all(abs(r[c] - got[r["doc_id"]][c]) < 1e-6 for c in ("n_tokens", "n_known", "base_score", "score", "spelled_score"))


def test_scoring_keeps_few_tables(spark, monkeypatch):
    """Texts do not store what they ask for, a pass's tables go when the next has what it needs of them, and the shares make up the whole."""
    rng, made, kept = random.Random(9), [], hpyp.stored

    def stored(df, name):
        made.append((name, kept(df, name)))
        return made[-1][1]

    monkeypatch.setattr(hpyp, "stored", stored)
    rows = [(i, words(rng, 40), "en", "s", 0) for i in range(50)] + [(7, None, "en", "s", 0), (7, None, "en", "s", 0)]
    got = hpyp.score(frame(spark, rows), held_out=held_out(), settings=hpyp.Settings(burn_in=1, samples=1, head=20, head_pairs=20))
    there = [name for name, df in made if Path(df.inputFiles()[0].removeprefix("file:")).exists()]
    most = {"lm-pairs": 1, "lm-known": 2, "lm-known-words": 1, "lm-seated": 1, "lm-model": 1, "lm-gains": 1, "lm-scores": hpyp.SHARES}
    assert all(n <= most.get(name, 0) for name, n in Counter(there).items())
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r[0] for r in rows)


def test_the_model_goes_before_texts_are_scored(spark, monkeypatch):
    """Disk: while the shares are scored what answers is there, packed once for all of them, but no longer what it was made from but the counts."""
    made, kept, there = [], hpyp.stored, []

    def stored(df, name):
        if name == "lm-scores":
            there.append({n for n, x in made if Path(x.inputFiles()[0].removeprefix("file:")).exists()} - {"lm-scores"})
        made.append((name, kept(df, name)))
        return made[-1][1]

    def scores():
        docs = frame(spark, [(i, words(random.Random(i), 40), "en", "s", 0) for i in range(30)])
        return sorted_rows(hpyp.score(docs, held_out=held_out(), settings=hpyp.Settings(burn_in=1, samples=1, head=20, head_pairs=20)),
                           "doc_id", "n_tokens", "n_known", "base_score", "score", "spelled_score")

    monkeypatch.setattr(hpyp, "stored", stored)
    whole = scores()
    assert there == [{"lm-answers", "lm-pairs", "lm-known", "lm-known-words"}] * hpyp.SHARES and [n for n, _ in made].count("lm-answers") == 1
    assert list(hpyp._joined(iter([]))) == []
    monkeypatch.setattr(hpyp, "FLUSH_GIVEN", 3)
    parts = [(np.arange(2), np.ones(2)), (np.arange(4), np.zeros(4)), (np.arange(1), np.ones(1))]
    assert [x.tolist() for x, _ in hpyp._joined(iter(parts))] == [[0, 1, 0, 1, 2, 3], [0]]
    assert len(whole) == 30


def test_little_is_stored_and_joined_for_scores(spark, monkeypatch):
    """Disk: stored tables are packed by Zstandard, and only pairs of two words that the head lacks go through two joins."""
    made, kept, codec = [], hpyp.stored, spark.conf.get("spark.sql.parquet.compression.codec")

    def stored(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString() if name == "lm-gains" else ""
        made.append((name, kept(df, name), plan))
        return made[-1][1]

    monkeypatch.setattr(hpyp, "stored", stored)
    docs = frame(spark, [(i, words(random.Random(i), 40), "en", "s", 0) for i in range(30)])
    hpyp.score(docs, held_out=held_out(), settings=hpyp.Settings(burn_in=1, samples=1, head=20, head_pairs=20))
    files = [f for name, df, _ in made if name in ("lm-pairs", "lm-scores") for f in df.inputFiles()]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    plan = next(p for name, _, p in made if name == "lm-gains")
    assert "Union" in plan and "xxhash64" not in plan
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec


def test_lists_hold_what_was_dealt():
    part, (x, y) = hpyp.dealt(np.array([2, 0, 2, 70_000]), np.array([1, 2, 3, 4]), np.array([5, 6, 7, 8]))
    assert part.tolist() == [0, 2, 70_000] and x.to_pylist() == [[2], [1, 3], [4]] and y.to_pylist() == [[6], [5, 7], [8]]
    assert hpyp.dealt(np.zeros(0, np.int64), np.zeros(0))[0].tolist() == []


def test_head_words_are_the_most_frequent(spark):
    lm = hpyp.stored(spark.range(5000).selectExpr("id as h", "cast(5000 / (id + 1) as long) as c", "0.0D as score"), "t")
    assert hpyp.head_words(lm, 40).column("h").to_pylist() == list(range(40))
    assert hpyp.head_words(lm, 9000).num_rows == 5000


def test_spelling_by_join_equals_broadcast(spark, monkeypatch):
    vocabulary = spark.createDataFrame([(bytearray(w.encode()), 1) for w in "the there then and ander".split()], "word binary, c long")
    counts = hpyp.spelling_counts(vocabulary)
    model = hpyp.stored(hpyp.spelling_model(counts, 0.5, QUICK), "t")
    near = {r["h"]: r["spelled"] for r in hpyp.spell(vocabulary, model).collect()}
    monkeypatch.setattr(hpyp, "MAX_BROADCAST_KEYS", 1)
    far = {r["h"]: r["spelled"] for r in hpyp.spell(vocabulary, model).collect()}
    assert near.keys() == far.keys() and all(abs(near[h] - far[h]) < 1e-9 for h in near)


def _brute_kneser_ney(counts, ask, order=4):
    """Interpolated modified Kneser-Ney over (context bytes, byte) by the textbook."""
    orders = [counts]
    for _ in range(order):
        orders.append(Counter(k[1:] for k in orders[-1]))
    orders = orders[::-1]

    def discounts(c):
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
        raw = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else i * y for i in (1, 2, 3)]
        return [min(max(x, 0.1 * i), 0.95 * i) for i, x in enumerate(raw, 1)]

    cuts = [discounts(c) for c in orders]

    def p(key, level):
        if level < 0:
            return 1 / 256
        k = key[order - level:]
        room = {x: v for x, v in orders[level].items() if x[:-1] == k[:-1]}
        low = p(key, level - 1)
        if not room:
            return low
        cut = lambda v: cuts[level][min(v, 3) - 1]
        own = room.get(k, 0)
        return ((own - cut(own) if own else 0) + sum(map(cut, room.values())) * low) / sum(room.values())

    return {k: math.log(p(k, order)) for k in ask}


def _grams(text):
    out = Counter()
    for w in text.encode().split():
        s = b"    " + w + b"\n"
        out.update(s[i - 4:i + 1] for i in range(4, len(s)))
    return out


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(6)
    good = [(i, words(rng, 90), "en", "s", 0) for i in range(60)]
    bad = [(100 + i, " ".join(w.upper() + "$$" for w in words(rng, 90).split()), "en", "s", 0) for i in range(6)]
    docs = frame(spark, [*good, *bad, *((200 + i, *rest) for i, *rest in edge_rows()[2:8])])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)] + [(100, 0, 0), (0, None, None), (None, 1, 0), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int").withColumn("good", F.lit(1))
    return good, docs, labels


def test_probabilities_by_the_textbook(spark, judged):
    good, _, _ = judged
    text = " ".join(t for _, t, *_ in good[:5])
    train = frame(spark, [(1, text, "en", "s", 0)])
    ask = frame(spark, [(2, text[:300] + " zebra Qx", "en", "s", 0)])
    got = kneser_ney.probabilities(kneser_ney.ngrams_asked(ask), kneser_ney.ngram_counts(train))
    want = _brute_kneser_ney(_grams(text), _grams(text[:300] + " zebra Qx"))
    rows = {int(r["key"]).to_bytes(5, "big"): r["logp"] for r in got.collect()}
    assert rows.keys() == want.keys() and all(abs(rows[k] - want[k]) < 1e-9 for k in want)


def test_classifier_keeps_good_and_rejects_bad(spark, judged):
    good, docs, labels = judged
    s = kneser_ney.Settings(min_rows=5)
    rows = {r["doc_id"]: r for r in kneser_ney.classify(docs, labels, s).collect()}
    assert len(rows) == docs.select("doc_id").distinct().count()
    assert sum(rows[i]["kept"] for i, *_ in good) >= 58 and not any(rows[100 + i]["kept"] for i in range(6))
    assert not rows[204]["kept"] and not rows[205]["kept"] and not rows[206]["kept"]  # no words
    out = kneser_ney.kept(docs, labels, s)
    assert out.columns == docs.columns and out.first()["kept"] == "own kept"
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == sorted(i for i, r in rows.items() if r["kept"])


def test_classifier_without_labels_or_documents(spark, judged):
    _, docs, labels = judged
    none = labels.where("false")
    assert kneser_ney.kept(docs, none).count() == docs.where(F.col("text").rlike("[^ \\n\\t]")).count()
    assert kneser_ney.classify(no_docs(spark), labels).collect() == []


def test_perplexities_by_join_equal_broadcast(spark, judged, monkeypatch):
    _, docs, _ = judged
    model = kneser_ney.stored(kneser_ney.probabilities(kneser_ney.ngrams_asked(docs), kneser_ney.ngram_counts(docs.limit(5))), "t")
    columns = ("doc_id", "n_words", "n_symbols", F.round("perplexity", 6))
    near = sorted_rows(kneser_ney.perplexities(docs.select("doc_id", "text"), model), *columns)
    monkeypatch.setattr(kneser_ney, "MAX_BROADCAST_KEYS", 1)
    assert sorted_rows(kneser_ney.perplexities(docs.select("doc_id", "text"), model), *columns) == near


def _running(raw):
    """(text, n-gram) over all texts by the definition, and their counts."""
    out = []
    for i, x in enumerate(raw):
        s = b"\n" * 5 + b"\n".join(x.split()) + b"\n" if x.split() else b""
        out += [(i, s[k - 5:k + 1]) for k in range(5, len(s))]
    return out


@pytest.mark.parametrize("piece", [1, 3, 7, 1 << 19])
def test_running_ngrams_by_the_textbook(monkeypatch, piece):
    monkeypatch.setattr(kneser_ney, "PIECE", piece)
    raw = [b" ab  c\n", b"", b"\xc3\xa9", b"\t\x0b\x0c\r ", b"a\r\n\r\nbc def\x0bg " * 3]
    got = [(o, k) for keys, owner in kneser_ney.RUNNING.pieces(raw) for o, k in zip(owner.tolist(), keys.tolist())]
    assert got == [(i, int.from_bytes(k, "big")) for i, k in _running(raw)]


def test_running_probabilities_by_the_textbook(spark, judged):
    """The registered model's n-grams, five bytes of context across words."""
    good, _, _ = judged
    text = " ".join(t for _, t, *_ in good[:3])
    grams = lambda x: Counter(k for _, k in _running([x.encode()]))
    train, ask = (frame(spark, [(1, t, "en", "s", 0)]) for t in (text, text[:200] + " zebra Qx"))
    got = kneser_ney.probabilities(kneser_ney.ngrams_asked(ask, "text", kneser_ney.RUNNING),
                                   kneser_ney.ngram_counts(train, "text", kneser_ney.RUNNING), kneser_ney.RUNNING)
    want = _brute_kneser_ney(grams(text), grams(text[:200] + " zebra Qx"), 5)
    rows = {int(r["key"]).to_bytes(6, "big"): r["logp"] for r in got.collect()}
    assert rows.keys() == want.keys() and all(abs(rows[k] - want[k]) < 1e-9 for k in want)


def test_pieces_and_flushes_change_nothing(spark, judged, monkeypatch):
    """Texts longer than a piece, and n-grams passed on whenever a few are pending, give the same counts and scores."""
    _, docs, _ = judged
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(900, "long text " * 3000)], "doc_id long, text string"))
    columns = ("doc_id", "n_words", "n_symbols", F.round("perplexity", 6))

    def results():
        counts = kneser_ney.ngram_counts(docs, "text", kneser_ney.RUNNING)
        model = kneser_ney.stored(kneser_ney.probabilities(kneser_ney.ngrams_asked(docs, "text", kneser_ney.RUNNING), counts, kneser_ney.RUNNING), "t")
        return sorted_rows(counts, "key", "c"), sorted_rows(kneser_ney.perplexities(docs, model, grams=kneser_ney.RUNNING), *columns)

    whole = results()
    monkeypatch.setattr(kneser_ney, "PIECE", 1000)
    monkeypatch.setattr(kneser_ney, "MAX_PENDING", 50)
    assert results() == whole


def test_texts_go_to_workers_once_and_few_at_a_time(spark, judged, monkeypatch):
    """Memory: neither a second copy of the texts nor 10,000 of them at a time, and none comes back."""
    _, docs, labels = judged
    rows, keep, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", kneser_ney.stored, {}

    def spy(df, name):
        seen[name] = int(spark.conf.get(rows)), df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, name)

    before = spark.conf.get(rows)
    monkeypatch.setattr(kneser_ney, "stored", spy)
    near = sorted_rows(kneser_ney.classify(docs, labels), "doc_id", "n_symbols", "kept")
    assert spark.conf.get(rows) == before and all(seen[n][0] <= 1000 for n in ("kn-counts", "kn-asked", "kn-scored"))
    sent = next(x for x in seen["kn-scored"][1].splitlines() if "MapInArrow" in x)
    assert "_text" in sent and "_body" not in sent
    monkeypatch.setattr(kneser_ney, "MAX_BROADCAST_KEYS", 1)
    assert sorted_rows(kneser_ney.classify(docs, labels), "doc_id", "n_symbols", "kept") == near and "_body" not in kneser_ney.classify(docs, labels).columns


def test_short_texts_are_judged_by_short_ones(spark):
    rng = random.Random(14)
    good = [(i, words(rng, 12 if i % 2 else 90), "en", "s", 0) for i in range(400)]
    bad = [(500 + i, "§%$ " * 8, "en", "s", 0) for i in range(3)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in kneser_ney.classify(frame(spark, [*good, *bad]), labels, kneser_ney.Settings(min_rows=20)).collect()}
    assert rows[1]["threshold"] != rows[2]["threshold"] and rows[500]["threshold"] == rows[1]["threshold"]
    assert sum(rows[i]["kept"] for i in range(400)) >= 398 and not any(rows[i]["kept"] for i in range(500, 503))


def test_repeated_and_shuffled_words_are_less_likely(spark, judged):
    rng = random.Random(12)
    starts, ends = "Die Der Das Ein".split(), "Haus Baum Kind Tier".split()

    def sentences(n):
        return " ".join(f"{rng.choice(starts)} {rng.choice(ends)} {rng.choice(['steht', 'liegt'])} {rng.choice(['hier', 'dort'])}." for _ in range(n))

    good = [(i, sentences(40), "de", "s", 0) for i in range(200)]
    mixed = []
    for i in range(5):
        w = sentences(40).split()
        rng.shuffle(w)
        mixed.append((300 + i, " ".join(w), "de", "s", 0))
    same = [(400 + i, " ".join([w] * 60), "de", "s", 0) for i, w in enumerate(["Der", "Haus", "hier."])]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)] + [(i, 0, 0) for i in range(400, 403)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [*good, *mixed, *same])
    rows = {r["doc_id"]: r for r in kneser_ney.classify(docs, labels).collect()}
    assert sum(rows[i]["kept"] for i in range(200)) == 200
    assert not any(rows[i]["kept"] for i in (*range(300, 305), *range(400, 403)))


def test_all_trusted_rows_are_used(spark, monkeypatch):
    """However many there are, one half trains the model and the other sets the thresholds."""
    rng = random.Random(41)
    docs = frame(spark, [(i, words(rng, 2), "en", "s", 0) for i in range(45_000)])
    labels = spark.range(44_900).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    seen, keep = {}, kneser_ney.stored
    monkeypatch.setattr(kneser_ney, "stored", lambda df, name: seen.setdefault(name, keep(df, name)))
    _, scored = kneser_ney.fit(docs, labels)
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    taught = scored.where(half & (F.col("doc_id") < 44_900))
    assert seen["kn-sample"].count() == taught.count() > 20_000
    assert seen["kn-counts"].agg(F.sum("c")).first()[0] == taught.agg(F.sum("n_symbols")).first()[0]
    held = scored.where(~half & (F.col("doc_id") < 44_900))
    band = held.groupBy((F.col("n_symbols") < 120).alias("short")).agg((F.percentile_approx("perplexity", 0.99, 10_000) * 1.5).alias("t"))
    assert sorted_rows(seen["kn-limits"].where("lang is null and short is not null").select("short", "threshold")) == sorted_rows(band)


def test_counts_and_questions_come_from_one_scan(spark, judged):
    """The same model as from two scans; NULL texts, repeated and NULL ids included."""
    good, docs, _ = judged
    docs = docs.union(docs.limit(7)).select("doc_id", "text")
    sample = spark.createDataFrame([(i,) for i in range(20)], "id long")
    got = kneser_ney.train(docs, kneser_ney.stored(sample, "t"))
    g = kneser_ney.RUNNING
    want = kneser_ney.probabilities(kneser_ney.ngrams_asked(docs, "text", g), kneser_ney.ngram_counts(docs.where("doc_id < 20"), "text", g), g)
    columns = ("key", F.round("logp", 9))
    assert sorted_rows(got, *columns) == sorted_rows(want, *columns)


def test_large_models_are_looked_up_part_by_part(spark, judged, monkeypatch):
    """A model over the bound of a broadcast gives the same scores, and no (document, n-gram) rows are shuffled for it."""
    _, docs, labels = judged
    docs = docs.union(docs.limit(5).withColumn("text", F.repeat("text", 40)))
    columns = ("doc_id", "n_words", "n_symbols", "perplexity", "kept")
    whole = sorted_rows(kneser_ney.classify(docs, labels), *columns)
    counts = kneser_ney.ngram_counts(docs, "text", kneser_ney.RUNNING)
    model = kneser_ney.stored(kneser_ney.probabilities(counts.select("key"), counts, kneser_ney.RUNNING), "t")
    monkeypatch.setattr(kneser_ney, "MAX_BROADCAST_KEYS", -(-model.count() // 7))
    monkeypatch.setattr(kneser_ney, "GROUP", 3000)
    monkeypatch.setattr(kneser_ney, "PIECE", 1000)
    parts, edges = kneser_ney._parts(model)
    assert len(parts) == 7 == len(edges) + 1 and sum(len(p.value[0]) for p in parts) == model.count()
    assert max(len(p.value[0]) for p in parts) <= kneser_ney.MAX_BROADCAST_KEYS + 1
    plan = kneser_ney.perplexities(docs, model, grams=kneser_ney.RUNNING)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    got = sorted_rows(kneser_ney.classify(docs, labels), *columns)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in whole]
    assert all(a[3] == b[3] or abs(a[3] - b[3]) < 1e-9 * abs(b[3]) for a, b in zip(got, whole))


def test_pipeline_quality_never_joins_a_row_per_byte(spark, judged, monkeypatch, tmp_path):
    """Disk: the first stage over a model of several parts keeps the same rows without (document, n-gram) rows."""
    import corpus_pipeline

    _, docs, labels = judged
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = lambda: sorted_rows(corpus_pipeline.quality(spark, docs, str(tmp_path)), "doc_id", "text")
    whole = kept()
    monkeypatch.setattr(kneser_ney, "MAX_BROADCAST_KEYS", 500)
    monkeypatch.setattr(kneser_ney, "_perplexities_joined", lambda *a: pytest.fail("joined"))
    assert kept() == whole and whole
