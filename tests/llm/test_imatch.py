import hashlib
import math
import random
import struct

import regex
import xxhash

from contrail.llm import imatch


def h(data, seed=42):
    x = xxhash.xxh64_intdigest(data, seed)
    return x - (1 << 64) if x >> 63 else x


def term_set(text):
    return {h(w.encode()) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}


def signed(hashes):
    seed = 42
    for x in sorted(hashes):
        seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
    return f"{seed:016x}"[-8:]


def fingerprints(texts, band):
    """Lexicon and fingerprints by the rules, with Spark's hash chaining."""
    n, counts = len(texts), {}
    for t in texts:
        for x in term_set(t):
            counts[x] = counts.get(x, 0) + 1
    words = {x for x, c in counts.items() if n * math.exp(-band[1]) <= c <= n * math.exp(-band[0])}
    subset = {}
    for x in words:
        for k in range(imatch.SUBSETS):
            seed = xxhash.xxh64_intdigest(struct.pack("<i", k), 42)
            if h(struct.pack("<q", x), seed) % (1 << imatch.SIZES[k // imatch.EACH]) == 0:
                subset.setdefault(k, set()).add(x)

    def one(text):
        mine = term_set(text)
        parts = [signed(mine & subset.get(k, set())) if mine & subset.get(k, set()) else imatch.BLANK
                 for k in range(imatch.SUBSETS)]
        return "".join([*parts, signed(mine)])

    return one


def likeness(a, b):
    cut = [(a[k:k + 8], b[k:k + 8]) for k in range(0, len(a), 8)]
    told = [(x, y) for x, y in cut if (x, y) != (imatch.BLANK, imatch.BLANK)]
    return sum(x == y for x, y in told) / len(told)


def corpus():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)] + ["Été", "ŁÓDŹ", "10", "a"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    return texts + ["", " .. ", "same words", "same words", "x" * 50_000]


def test_matches_brute_force(spark):
    texts, band = corpus(), (1.0, 4.0)
    rows = [(3 * i, t, "x", i) for i, t in enumerate(texts)] + [(1, None, "x", 1)]
    got = imatch.fingerprint_edits(spark.createDataFrame(
        rows, "doc_id long, text string, part string, row int").repartition(5), band=band).collect()
    assert len(got) == len(rows)
    plain = {d: t or "" for d, t, *_ in rows}
    one = fingerprints(list(plain.values()), band)
    order = sorted(plain, reverse=True)
    for r in got:
        text, after = plain[r.doc_id], plain[order[(order.index(r.doc_id) + 1) % len(order)]]
        half = len(text) // 2
        edit = text[:len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert r.fingerprint == one(text) and r.edited_fingerprint == one(edit)
        assert abs(r.near_edited - likeness(one(text), one(edit))) < 1e-12
        assert abs(r.near_next - likeness(one(text), one(after))) < 1e-12


def test_ties_nulls_and_single_rows(spark):
    schema = "doc_id long, text string"
    rows = [(None, "last of all"), (7, "b twin"), (7, "a twin"), (7, "a twin"), (9, "first one here")]
    got = imatch.followed(spark.createDataFrame(rows, schema)).collect()
    order = ["first one here", "a twin", "a twin", "b twin", "last of all"]
    assert sorted((r.text, r.next) for r in got) == sorted(zip(order, [*order[1:], order[0]]))
    assert [r.doc_id for r in got if r.text == "last of all"] == [None]
    alone = imatch.fingerprint_edits(spark.createDataFrame([(1, "one two three four")], schema)).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"one two tone two t").hexdigest()
    assert alone[0].near_next == 1.0
    assert imatch.fingerprint_edits(spark.createDataFrame([], schema)).collect() == []


def test_near_copies_that_a_third_of_rows_are(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    hot = [f"hot{k}" for k in range(150)]

    def copy():
        mine = list(hot)
        for k in rng.sample(range(len(mine)), 3):
            mine[k] = rng.choice(words)
        return " ".join(mine)

    plain = [(2 * k, " ".join(rng.sample(words, 100))) for k in range(200)]
    copies = [(1000 + k, copy()) for k in range(100)]
    got = {r.doc_id: r for r in imatch.fingerprint_edits(spark.createDataFrame(
        plain + copies, "doc_id long, text string").repartition(5)).collect()}
    near = [got[d].near_next for d, _ in copies[1:]]
    assert min(near) > 0.2 and sum(near) / len(near) > 0.5
    assert min(got[d].near_edited for d, _ in copies[1:]) > 0.1
    assert got[1000].near_next < 0.1 and max(got[d].near_next for d, _ in plain[1:]) < 0.1
    # without the group nothing lies above the band: the others' signatures are of the band only
    band = math.exp(-2) * 300
    assert max(sum(w in t.split() for _, t in plain) for w in words) < band
    assert any(imatch.BLANK in got[d].fingerprint for d, _ in plain)
    assert got[1001].fingerprint.count(imatch.BLANK) < 30


def test_filled_signatures_by_the_rule(spark):
    texts = ["a b c d e f g h"] * 5 + ["a b c d e f g x1", "y1 y2 y3 y4 y5", "y1 y2 y3 y4 a", ""]
    got = imatch.fingerprint_edits(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string"), band=(0.7, 1.6)).collect()
    n, sets = len(texts), [term_set(t) for t in texts]
    df = {x: sum(x in s for s in sets) for s in sets for x in s}
    band = {x for x in df if n * math.exp(-1.6) <= df[x] <= n * math.exp(-0.7)}
    above = {x for x in df if df[x] > n * math.exp(-0.7)}

    def inside(k, x):
        seed = xxhash.xxh64_intdigest(struct.pack("<i", k), 42)
        return h(struct.pack("<q", x), seed) % (1 << imatch.SIZES[k // imatch.EACH]) == 0

    for r in got:
        mine = sets[r.doc_id]
        parts = [{x for x in mine & band if inside(k, x)} for k in range(imatch.SUBSETS)]
        if len(mine & above) > sum(map(len, parts)):
            parts = [p or {x for x in mine & above if inside(k, x)} for k, p in enumerate(parts)]
        assert r.fingerprint == "".join(signed(p) if p else imatch.BLANK for p in parts) + signed(mine)
