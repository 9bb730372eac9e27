import math
import random
import zlib

import numpy as np
import pytest

from contrail.llm import quality

SF = "/root/testdata/sf0.01"


def clean(rng, n):
    return " ".join(rng.choice("the ore than inse rthe and ing of to a with from ereth".split()) + rng.choice(["", "", "", "."])
                    for _ in range(n))


def test_learns_that_one_bad_passage_spoils_a_text():
    rng = random.Random(3)
    good = [clean(rng, rng.randint(5, 900)) for _ in range(300)]
    bad = [clean(rng, rng.randint(5, 500)) + " " + " ".join([rng.choice(["XQ!!", "buy$$$"])] * 60) + " "
           + clean(rng, rng.randint(5, 300)) for _ in range(120)]
    bags, labels = [quality.passages(t) for t in good + bad], np.array([1.0] * 300 + [0.0] * 120)
    order = np.random.default_rng(0).permutation(420)
    model = quality.fit_bags([bags[k] for k in order[:300]], labels[order[:300]])
    scores = model.scores([bags[k] for k in order[300:]])
    assert ((scores > 0.5) == (labels[order[300:]] == 1)).mean() > 0.95
    assert scores.min() >= 0 and scores.max() <= 1


def test_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality.FIGURES)) for n in (1, 4, 2)]
    labels = np.array([1.0, 0.0, 0.4])

    def loss(p):
        s = quality._forward(p, np.concatenate(bags), np.array([1, 4, 2]))["score"]
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).mean()

    start = quality.fit_bags(bags, labels, rounds=0).weights
    fitted = quality.fit_bags(bags, labels, rounds=60).weights
    assert loss(fitted) < loss(start)


def test_gradient_by_central_differences():
    rng = np.random.default_rng(4)
    sizes, labels = np.array([1, 5, 2, 3]), np.array([1.0, 0.0, 0.4, 1.0])
    bags = [rng.normal(size=(n, quality.FIGURES)) for n in sizes]
    p = {k: v + rng.normal(0, 0.2, v.shape) for k, v in quality.fit_bags(bags, labels, rounds=0).weights.items()}
    x = np.concatenate(bags)

    def loss():
        s = quality._forward(p, x, sizes)["score"]
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).mean()

    slopes, step = quality._gradient(p, x, sizes, labels), 1e-5
    for name, values in p.items():
        flat = values.reshape(-1)
        for k in rng.integers(0, len(flat), min(12, len(flat))):
            kept = flat[k]
            flat[k] = kept + step
            above = loss()
            flat[k] = kept - step
            below = loss()
            flat[k] = kept
            assert abs((above - below) / (2 * step) - slopes[name].reshape(-1)[k]) < 1e-7, name


def test_scores_are_the_formula_passage_by_passage():
    rng = np.random.default_rng(5)
    bags = [rng.normal(size=(n, quality.FIGURES)) for n in (1, 7, 2, 40)]
    model = quality.fit_bags(bags, np.array([1.0, 0.0, 1.0, 0.0]), rounds=5)
    p = model.weights
    for bag, got in zip(bags, model.scores(bags)):
        codes, gates = [], []
        for passage in bag:
            x = [min(8, max(-8, (v - m) / s)) for v, m, s in zip(passage, model.mean, model.scale)]
            h = [math.tanh(sum(a * b for a, b in zip(x, col)) + bias) for col, bias in zip(p["A"].T, p["a"])]
            gate = 0.0
            for v, u, w in zip(p["V"].T, p["U"].T, p["w"]):
                opened = 1 / (1 + math.exp(-sum(a * b for a, b in zip(h, u))))
                gate += w * math.tanh(sum(a * b for a, b in zip(h, v))) * opened
            codes.append(h)
            gates.append(math.exp(gate))
        z = [sum(g * h[k] for g, h in zip(gates, codes)) / sum(gates) for k in range(len(codes[0]))]
        want = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(z, p["c"])) + p["d"][0])))
        assert abs(got - want) < 1e-12


def test_fit_reads_every_passage_of_a_sampled_text(spark):
    """One bad passage among 200, where evenly spaced ones would miss it."""
    rng = random.Random(8)
    rows = []
    for k in range(60):
        words = clean(rng, 64 * 200).split()
        if k % 2:
            at = 64 * rng.randrange(200)
            words[at:at + 64] = ["XQ!!"] * 64
        rows.append((k, " ".join(words), 1 - k % 2))
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(frame.drop("quality"), frame.drop("text"))
    learnt = sorted((r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2), key=lambda r: place(spark, r[0]))
    whole = quality.fit_bags([quality.passages(t) for _, t, _ in learnt], np.array([float(q) for _, _, q in learnt]))
    for k in whole.weights:
        assert np.allclose(model.weights[k], whole.weights[k])
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    scores = model.scores([quality.passages(t) for _, t, _ in held])
    assert [s > 0.5 for s in scores] == [bool(q) for _, _, q in held]


def place(spark, doc_id):
    return spark.range(1).selectExpr(f"xxhash64({doc_id}L) AS h").first().h


def test_sample_ends_at_a_whole_document(spark):
    """Bounds count whole documents in hash order; repeated ids are one document."""
    docs = spark.createDataFrame([(k, "a b c. " * 64 * (k % 3 + 1)) for k in range(40)] + [(5, "zzz"), (5, "zzz")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    texts = {k: "a b c. " * 64 * (k % 3 + 1) for k in range(40)}
    order = sorted((k for k in texts if zlib.crc32(str(k).encode()) % 4 != 2), key=lambda k: place(spark, k))
    for most in (1, 20, 10_000):
        total, chosen = 0, []
        for k in order:
            total += len(quality.passages(texts[k]))
            if chosen and total > most:
                break
            chosen.append(k)
        want = quality.fit_bags([quality.passages(texts[k]) for k in chosen], np.array([k % 2 * 1.0 for k in chosen]))
        got = quality.fit(docs, labels, most=most)
        assert all(np.allclose(got.weights[k], want.weights[k]) for k in want.weights)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).select("doc_id", "score").collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    kept = [d for d in known if zlib.crc32(str(d).encode()) % 4 == 2]
    assert len(kept) > 50
    assert np.mean([(got[d] >= 0.7) == bool(known[d]) for d in kept]) > 0.97


def test_held_out_documents_are_never_learnt_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    a, b = quality.fit(docs, labels, sample=200), quality.fit(docs, flipped, sample=200)
    assert all((a.weights[k] == b.weights[k]).all() for k in a.weights)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5.0, "r"), (2, "", None, "r"), (None, "word " * 50_000, 1.0, None),
                                  (4, "ok then", 2.0, "r"), (4, "ok then", 2.0, "r")],
                                 "doc_id long, text string, score double, row string")
    labels = spark.createDataFrame([(4, 1), (4, None), (None, 0), (77, 0)], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, labels))
    assert got.columns == ["doc_id", "text", "row", "score"]
    scores = got.collect()
    assert len(scores) == 5 and all(0 <= r.score <= 1 for r in scores)
    none = quality.fit(docs, labels.where("doc_id < 0"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.where("doc_id > 9"), none).collect() == []


@pytest.mark.parametrize("text,rows", [("", 1), ("a", 1), ("a " * 64, 1), ("a " * 65, 2)])
def test_passages(text, rows):
    assert quality.passages(text).shape == (rows, quality.FIGURES)
