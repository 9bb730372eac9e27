import hashlib
import random
import re

from contrail.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def base(text):
    found = [(m.start(), n, m.end(), kind) for n, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text) if holds(kind, m.group(0))]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


def odd_texts(n):
    rng = random.Random(2)
    some = list("0123456789") * 2 + list("..--  ++()@@ab_%é\U0001F600\n") + \
        ["4111 1111 1111 1111", "a@b.co", "1.2.3.4", "+1 (555) 123-4567", "256.1.1.1"]
    return ["".join(rng.choice(some) for _ in range(rng.randint(0, 60))) for _ in range(n)] + [
        None, "", "1" * 30_000, "a" * 30_000 + "@", "1 " * 20_000, "a@" + "b." * 20_000 + "c",
        "+" + "1" * 20_000, "1.2.3.4.5.6.7.8", "a@b.co_x@y.z", "no data here"]


def test_base_spans_match_brute_force(spark):
    texts = odd_texts(1500)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "x@y.zz", "x", 1)] * 2,
                               "doc_id long, text string, t string, base int").repartition(6)
    got = pii.find(df, pii.Model()).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = base("x@y.zz" if r.doc_id is None else texts[r.doc_id] or "")
        assert r.spans == ",".join(want)
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in PATTERNS]


def test_model_adds_but_never_removes(spark):
    rng = random.Random(7)

    def card():
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    def wrong():
        digits = "".join(rng.choice("0123456789") for _ in range(16))
        return digits if not luhn(digits) else digits[:-1] + str((int(digits[-1]) + 1) % 10)

    rows = []
    for k in range(400):
        rows.append((k, f"pay with {card()} or order {wrong()} now, call +1 (555) {rng.randint(100, 999)}-1234"))
    dotted = card()
    dotted = ".".join(dotted[i:i + 4] for i in range(0, 16, 4))
    rows += [(900, f"pay with {dotted} now"), (901, f"pay with {wrong()[:4]} now"), (902, "plain words only")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    assert 2 in model.thresholds
    got = {r.doc_id: r for r in pii.find(df, model).collect()}
    for doc, text in rows:
        assert set(base(text)) <= set(got[doc].spans.split(",")) | {""}
        assert got[doc].base_sha256 == hashlib.sha256(",".join(base(text)).encode()).hexdigest()
    assert got[900].spans == f"card:9:{9 + len(dotted)}"
    assert got[901].spans == "" and got[902].spans == ""


def test_redaction(spark):
    rows = [(1, "mail é a@b.co, call +1 (555) 123-4567!"), (2, "nothing"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df, pii.find(df, pii.Model())).collect()}
    assert got == {1: "mail é [email], call [phone]!", 2: "nothing", 3: ""}


def test_redaction_of_repeated_and_null_ids(spark):
    rows = [(7, "write a@b.co now"), (7, "plain, then call +1 (555) 123-4567"), (7, "write a@b.co now"),
            (None, "c@d.org"), (None, "at 10.0.0.1"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.redact(df, pii.find(df, pii.Model())).collect()
    want = [(7, "write [email] now"), (7, "plain, then call [phone]"), (7, "write [email] now"),
            (None, "[email]"), (None, "at [ip]"), (None, "")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, want))


def test_without_examples_nothing_is_added(spark):
    df = spark.createDataFrame([(1, "no numbers"), (2, None)], "doc_id long, text string")
    assert pii.fit(df).thresholds == {}
    empty = df.where("doc_id > 5")
    assert pii.find(empty, pii.fit(empty)).collect() == []


def test_every_example_teaches(spark):
    """Of many copies a sample in hash order held one place only, so one class."""
    text = "call +1 (555) 123-4567, +1 (555) 223-9567 or +1 (555) 777-4567, not 1234567 nor 7654321 nor 2345678"
    docs = spark.range(25_000).selectExpr("id doc_id", f"'{text}' text")
    known = pii.examples(docs)
    assert known.groupBy("label").sum("n").orderBy("label").collect()[:] == [(0.0, 75_000), (1.0, 75_000)]
    model = pii.fit(docs)
    assert model.margin != "0.0"
    figures = [[r.f, r.label] for r in known.collect()]
    scores = spark.createDataFrame(figures, "f array<double>, label double").selectExpr(
        f"{model.margin.replace('@', 'f')} > 0 yes", "label").collect()
    assert all(r.yes == (r.label == 1) for r in scores)


def test_cuts_part_the_examples_evenly(spark):
    rows = [([float(v), float(v % 3)], 1 + v % 2) for v in range(300)]
    seen = spark.createDataFrame([(f + [0.0] * (pii.FIGURES - 2), n) for f, n in rows], "f array<double>, n long")
    cuts = pii._cuts(seen, 9)
    assert cuts[1] == [0.0, 1.0] and cuts[2:] == [[]] * (pii.FIGURES - 2)
    assert len(cuts[0]) == 9
    edges = [-1.0, *cuts[0], 300.0]
    held = [sum(n for f, n in rows if a < f[0] <= b) for a, b in zip(edges, edges[1:])]
    assert max(held) - min(held) <= 4
