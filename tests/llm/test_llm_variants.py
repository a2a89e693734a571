"""Multiset hashes (11), spelling variants (12) and the source audit (13)."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import edge_docs, edge_rows, frame, no_docs, sorted_rows, words
from pyspark.sql import functions as F

from cartwise.llm import multiset_hash, source_audit, spelling_variants
from cartwise.llm.queries import ORACLES

# ---------------------------------------------------------------- 11


def _xxh(data: bytes, salt: int) -> int:
    """Spark's xxhash64(text, salt): XXH64 of the salt's four bytes, seeded by that of the text."""
    return xxhash.xxh64_intdigest(salt.to_bytes(4, "little"), xxhash.xxh64_intdigest(data, 42))


def _vector(text):
    text = text or ""
    lines = text.split("\n") if text else []
    exact = [len(lines)] + [sum(_xxh(p.encode(), k) & 0xFFFFFFFF for p in lines) % 2**32 for k in range(1, 17)]
    units = [u for u in re.split(r"[\n.!?;|]+ *", text) if u]
    lanes = []
    for k in (0, 1):
        hashes = [_xxh(u.encode(), k) for u in units]
        for j in range(32):
            for bit in (j, j + 32):
                x = sum(1 if h >> bit & 1 else -1 for h in hashes)
                lanes.append((x + 2**15) % 2**16 - 2**15)
    return exact, lanes


def _digits(v):
    return "".join(f"{x:08x}" for x in v[0]) + "".join(f"{x % 2**16:04x}" for x in v[1])


def _alike(a, b):
    if a[0] == b[0]:
        return 1.0
    dot = lambda x, y: float(np.dot(np.array(x[1], float), np.array(y[1], float)))
    size = (dot(a, a) * dot(b, b)) ** 0.5
    return min(max(dot(a, b) / size, 0.0), 1.0) if size else 0.0


def _brute_edits(rows):
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42))))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        v, e, n = _vector(text), _vector(edited), _vector(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), _digits(v), _digits(e), round(_alike(v, e), 9), round(_alike(v, n), 9)))
    return sorted(out, key=repr)


EDITS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "round(near_edited, 9)", "round(near_next, 9)")


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 20_000, 300])
def test_edits_equal_brute_force(spark, bucket_bytes):
    rng = random.Random(31)
    many = [(7, words(rng, 8), "en") for _ in range(40)] + [(None, words(rng, 5), "en") for _ in range(30)]  # an id that fills cells
    far = [(10**15 + i * i, words(rng, 20) + "\n" + words(rng, 9) + ".\n\n", "en") for i in range(30)]
    rows = edge_rows([*many, *far, (-5, "a\nb", "en"), (-6, "b\na", "en"), (12, "\n\n", "en")])
    got = multiset_hash.edits(frame(spark, rows).repartition(3), bucket_bytes=bucket_bytes)
    assert got.columns[:5] == ["doc_id", "lang", "source", "rid", "h"] and got.columns[-6:] == list(multiset_hash.OUT)
    assert sorted_rows(got.selectExpr(*EDITS), "*") == _brute_edits([(r[0], r[1]) for r in rows])


def test_edits_of_few_and_no_documents(spark):
    assert multiset_hash.edits(no_docs(spark)).collect() == []
    one = multiset_hash.edits(frame(spark, [(3, "abcd", "en", None, 4)])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    assert multiset_hash.edits(frame(spark, [(None, None, None, None, None)])).first()["n_chars"] == 0


def test_fingerprints_add_up_in_any_order(spark):
    rng = random.Random(32)
    lines = [words(rng, rng.randint(1, 30)) + rng.choice(["", ".", ". Oh! No"]) for _ in range(60)]
    mixed = lines[:]
    rng.shuffle(mixed)
    texts = {"whole": lines, "mixed": mixed, "head": lines[:25], "tail": lines[25:], "twice": lines + lines[:1]}
    rows = spark.createDataFrame([(k, "\n".join(v)) for k, v in texts.items()], "name string, text string")
    v = multiset_hash.with_vector(rows, "text", "v").groupBy().pivot("name", list(texts)).agg(F.first("v"))
    hexed = multiset_hash.digits
    got = v.select(*[hexed(F.col(k)).alias(k) for k in texts], hexed(multiset_hash.plus(F.col("head"), F.col("tail"))).alias("sum"),
                   hexed(multiset_hash.minus(F.col("whole"), F.col("tail"))).alias("less")).first()
    assert got["whole"] == got["mixed"] == got["sum"] and got["less"] == got["head"] and got["twice"] != got["whole"]


def test_edited_texts_are_nearer_than_next_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = multiset_hash.edits(docs).where("n_chars > 1000").select("near_edited", "near_next").collect()
    assert np.mean([r[0] > r[1] for r in rows]) > 0.95 and np.mean([r[0] for r in rows]) > 0.4 and np.median([r[1] for r in rows]) < 0.15


def test_edits_have_no_python_and_one_window_of_texts(spark):
    plan = multiset_hash.edits(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.count("Window [") == 1


# ---------------------------------------------------------------- 12


def _brute_words(rows, min_length, min_count, thin):
    c = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if thin and h % thin == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= min_length and n >= min_count}


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute_groups(n, ratio=5):
    near = {w: [v for v in n if _one_edit(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= ratio * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n), key=repr)


GROUPS = ("word", "form", "root", "n", "n_near", "form_n")


def _variants(rng, base):
    out = {base}
    for _ in range(rng.randint(0, 6)):
        w = rng.choice(sorted(out))
        i, c = rng.randrange(len(w) + 1), rng.choice("abé÷")
        out.add(rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]]))
    return out


def test_groups_equal_brute_force(spark):
    rng = random.Random(41)
    vocabulary = set()
    for _ in range(40):
        vocabulary |= _variants(rng, "".join(rng.choice("abé") for _ in range(rng.randint(4, 9))))
    vocabulary |= {"a" * k for k in range(4, 40)} | {"ab" * 3000, "ab" * 3000 + "a", "b" + "ab" * 3000, "ab" * 1500 + "é" + "ab" * 1500}
    rows = [(i, " ".join(rng.choice([w, w.upper()]) + rng.choice([".", "_1", ""]) for w in rng.sample(sorted(vocabulary), 60)), "en", "s", 0) for i in range(40)]
    rows += [(100 + i, " ".join([w] * rng.choice([1, 4, 40, 250])), None, None, None) for i, w in enumerate(sorted(vocabulary)[::3])]
    rows = edge_rows([r[:3] for r in rows])
    for thin in (0, 3):
        got = spelling_variants.group(frame(spark, rows).repartition(5), min_length=4, min_count=2, thin=thin)
        assert got.columns == list(GROUPS)
        assert sorted_rows(got, *GROUPS) == _brute_groups(_brute_words(rows, 4, 2, thin))


def test_groups_with_crowded_and_hot_nodes(spark, monkeypatch):
    monkeypatch.setattr(spelling_variants, "CROWD", 2)
    monkeypatch.setattr(spelling_variants, "MAX_HOT", 200)
    monkeypatch.setattr(spelling_variants, "MAX_PARTS", 2)
    rng = random.Random(42)
    vocabulary = ["commonstem" + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 4))) for _ in range(150)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=80)), "en", "s", 0) for i in range(30)]
    got = spelling_variants.group(frame(spark, rows), thin=0)
    assert sorted_rows(got, *GROUPS) == _brute_groups(_brute_words(rows, 6, 5, 0))


def test_groups_of_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = spelling_variants.group(spark.createDataFrame(rows, "doc_id long, text string"))
    n = _brute_words(rows, 6, 5, 199)
    by_hole = defaultdict(set)  # words that share a deletion variant are the only ones that can be near
    for w in n:
        for x in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_hole[x].add(w)
    near = defaultdict(set)
    for ws in by_hole.values():
        for a in ws:
            near[a] |= {b for b in ws if _one_edit(a, b)}
    got = {r["word"]: r for r in got.collect()}
    assert {w: r["n"] for w, r in got.items()} == n and {w: r["n_near"] for w, r in got.items()} == {w: len(near[w]) for w in n}


def test_groups_of_nothing(spark):
    assert spelling_variants.group(no_docs(spark)).collect() == []
    assert spelling_variants.group(frame(spark, [(1, None, "en", "s", 0), (2, "short", "en", "s", 0)])).collect() == []


# ---------------------------------------------------------------- 13


def _brute_audit(rows, top=200):
    docs = [(lang or "", source or "", re.findall("[a-z\u0080-\U0010ffff]+", "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")))
            for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = [t for t, k in df.items() if k >= 3]
        count = {s: Counter(t for d in docs if d[:2] == (lang, s) for t in d[2] if df[t] >= 3) for s in {d[1] for d in docs if d[0] == lang}}
        total = sum(count.values(), Counter())

        def p(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for s, c in count.items():
            f = lambda a, b: (a - b) ** 2 // b
            pairs = [(sum(f(p(c, t), p(o, t)) for t in kept), other) for other, o in count.items() if other != s]
            terms = [(f(p(c, t), p(total, t)), t) for t in kept if c[t] and p(c, t) > p(total, t)]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(ranked, 1) if part == "pair" or i <= top]
    return sorted(out, key=repr)


AUDIT = ("lang", "source", "part", "item", "value", "rank")


def _audit_rows():
    rng = random.Random(51)
    pool = words(rng, 60).split() + ["Ab", "aB", "naïve", "x" * 7, "x" * 8, "x" * 9, "x" * 15, "x" * 16, "x" * 17, "x" * 40, "é" * 8, "é" * 9, "漢字" * 30, "b" * 16 + "a", "b" * 16 + "z"]
    rows = [(i, rng.choice([" ", "1", "-"]).join(rng.choices(pool, k=rng.randint(0, 40))), rng.choice(["en", "de", None]), rng.choice([None, "", "s1", "s2", "s3", "Ä"])) for i in range(120)]
    rows += [(500, "rare words only", "xx", "s1"), (501, None, "xx", "s2"), (502, "", "yy", None), (503, "same " * 50, "en", "s1"), (503, "same " * 50, "en", "s1")]
    return [(i, t, lang, s, 0) for i, t, lang, s in rows]


@pytest.mark.parametrize("sizes", [None, (300, 7, 2)])
def test_audit_equals_brute_force(spark, monkeypatch, sizes):
    if sizes:  # many slices, blocks and tiles
        for name, n in zip(("SLICE", "BLOCK", "TILE"), sizes):
            monkeypatch.setattr(source_audit, name, n)
    rows = _audit_rows()
    got = source_audit.audit(frame(spark, rows).repartition(4), top=5)
    assert got.columns == list(AUDIT)
    assert sorted_rows(got, *AUDIT) == _brute_audit(rows, 5)


def test_audit_of_nothing(spark):
    assert source_audit.audit(no_docs(spark)).collect() == []
    none = source_audit.audit(frame(spark, [(1, None, None, "b", 0), (2, "x y", None, None, 0)]))
    assert sorted_rows(none, *AUDIT) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_audit_oracle_is_the_definition(tmp_path):
    rows = _audit_rows()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    got = con.execute(f"SELECT {', '.join(AUDIT)} FROM ({ORACLES['op13_source_audit']})").fetchall()
    assert sorted(got, key=repr) == _brute_audit(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.text(alphabet="aAbéz漢 1\n", max_size=60)), min_size=1, max_size=12))
def test_packed_counts_equal_counter(docs):
    texts, group = [t.encode() for _, t in docs], np.array([g for g, _ in docs])
    got = {}
    for owner, a, b, long, n, d in source_audit.count_terms(texts, group):
        for i in range(len(n)):
            key = long[i] if long else (int(a[i]) % 2**64).to_bytes(8, "big").rstrip(b"\0") + (int(b[i]) % 2**64).to_bytes(8, "big").rstrip(b"\0")
            assert (int(owner[i]), key) not in got
            got[int(owner[i]), key] = (int(n[i]), int(d[i]))
    want = defaultdict(lambda: [0, 0])
    for g, t in zip(group.tolist(), texts):
        c = Counter(re.findall(rb"[a-z\x80-\xff]+", t.lower()))
        for term, k in c.items():
            want[g, term][0] += k
            want[g, term][1] += 1
    assert got == {k: tuple(v) for k, v in want.items()}


def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 4, 500).astype(np.uint64) << np.uint64(s) for s in (60, 17))
    assert source_audit.radix_order([a, b]).tolist() == np.lexsort([np.arange(500), b, a]).tolist()
