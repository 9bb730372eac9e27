"""Personal data by candidate gradient boosting.

Base spans are defined by patterns and checks and always stay.  Beside them, wide
generators propose candidates that may overlap: obfuscated or spaced addresses,
numbers with other separators, numbers that could be a card or a phone.  Format and
context figures of a candidate go to boosted trees.  Base spans are the trees'
positive examples, candidates that break a kind's own rules (check digit, parts,
number of digits, no domain) the negative ones; thresholds per kind are calibrated
on examples kept apart, for a wanted precision.  Candidates that score as much and
overlap no base span are added.

Matching, checking and scoring are expressions of one projection: every text is
read where it lies.  The trees are fitted and the thresholds calibrated on every
example of every text; equal examples are counted before anything shuffles, and
count as one of that weight.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import column, stored, text_of

#: The kinds in order.
KINDS = ("email", "ip", "card", "phone")

_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: The contract's patterns for Java, without needless retries: a run is entered at its
#: start or where the last match ended, and possessive loops need no stack.  A card
#: pattern with fewer than 12 digits would be dropped, so 12 are asked for at once.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "instr(t, '@') > 0", "ip": "t rlike '[0-9][.][0-9]'", "card": "t rlike '[0-9][ -]?[0-9]'",
         "phone": "t rlike '[+][0-9]'"}

_AT, _DOT = r"(?:@|\(at\)|\[at\]|\{at\})", r"(?:\.|\(dot\)|\[dot\]|\{dot\})"
#: Generators: name -> (pattern, kinds it proposes, what a text must hold).
GENERATORS = {
    "address": (rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+ ?{_AT} ?[{_HOST}]{{1,63}}+(?: ?{_DOT} ?[{_HOST}]{{1,63}}+){{0,8}}+",
                ("email",), r"t rlike '@|[(\\[{]at[)\\]}]'"),
    "quad": (r"(?<![0-9.,:])[0-9]{1,4}+(?:[.,:][0-9]{1,4}+){3}+(?![.,:]?[0-9])", ("ip",), "t rlike '[0-9][.,:][0-9]'"),
    "number": (r"(?<![0-9])\+?\(?[0-9](?:[ ()./-]{0,2}[0-9]){6,24}+(?![0-9])", ("card", "phone"),
               r"t rlike '[0-9][ ()./-]{0,2}[0-9][ ()./-]{0,2}[0-9]'"),
}
#: Words that announce a kind.
CUES = {"email": "mail|contact|write", "ip": r"\\bip\\b|host|server|address", "card": "card|visa|pay|credit",
        "phone": "phone|tel|call|fax|mobile"}
FIGURES = 15
#: At most this many cuts a figure; the trees' own bins, more than the
#: cuts, so that they take each cut (they would look for cuts in a sample only where
#: more than the square of it, a million, sets of figures differ after cutting).
MOST_CUTS, BINS = 31, 1024


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(pattern: str, needs: str) -> str:
    """SQL: the leftmost non-overlapping matches in ``t`` as structs (s, e, x): code
    points, end exclusive, and the text.  Starts add up the pieces between matches."""
    p = _quoted(pattern)
    return f"""CASE WHEN {needs} THEN aggregate(
        arrays_zip(regexp_extract_all(t, {p}, 0), slice(split(t, {p}, -1), 1, size(split(t, {p}, -1)) - 1)),
        named_struct('at', 0, 'out', cast(array() AS array<struct<s:int,e:int,x:string>>)),
        (a, m) -> named_struct(
            'at', a.at + char_length(m.`1`) + char_length(m.`0`),
            'out', array_append(a.out, named_struct(
                's', a.at + char_length(m.`1`),
                'e', a.at + char_length(m.`1`) + char_length(m.`0`), 'x', m.`0`))),
        a -> a.out) ELSE cast(array() AS array<struct<s:int,e:int,x:string>>) END"""


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(x: str) -> str:
    """SQL: the digits of ``x`` pass the Luhn check."""
    digit = "coalesce(try_cast(d AS int), 0)"
    return f"""aggregate(transform(split(reverse({_digits(x)}), ''), (d, i) -> CASE
        WHEN i % 2 = 0 THEN {digit} ELSE {digit} * 2 - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END END),
        0, (n, v) -> n + v) % 10 = 0"""


def _octets(x: str) -> str:
    return rf"""forall(split({x}, '[^0-9]+'), p -> char_length(ltrim('0', p)) <= 3
        AND coalesce(try_cast(p AS int), 0) <= 255)"""


def _count(x: str) -> str:
    return f"char_length({_digits(x)})"


#: SQL: what a match must pass.
CHECKS = {"email": "true", "ip": _octets("m.x"),
          "card": f"({_count('m.x')} BETWEEN 12 AND 19 AND {_luhn('m.x')})",
          "phone": f"{_count('m.x')} BETWEEN 9 AND 15"}
#: SQL: a candidate ``m`` of the kind that breaks the kind's rules.
BREAKS = {"email": r"NOT m.x rlike '[.)\\]}] ?[A-Za-z-]{2,}$'", "ip": f"NOT {_octets('m.x')}",
          "card": f"({_count('m.x')} BETWEEN 12 AND 19 AND NOT {_luhn('m.x')})",
          "phone": f"({_count('m.x')} < 9 OR {_count('m.x')} > 15)"}
#: SQL: a candidate that could be of the kind at all.
FITS = {"email": "true", "ip": "true", "card": f"{_count('m.x')} BETWEEN 12 AND 19",
        "phone": f"{_count('m.x')} BETWEEN 7 AND 17"}


def _figures(kind: str) -> str:
    """SQL: format and context figures of a candidate ``m`` in the text ``t``."""
    before, after = "substring(t, greatest(m.s - 23, 1), least(m.s, 24))", "substring(t, m.e + 1, 4)"
    groups = "filter(split(m.x, '[^0-9]+'), g -> g != '')"
    sizes = f"transform({groups}, g -> char_length(g))"
    flag = "CASE WHEN {} THEN 1 ELSE 0 END"
    figures = [
        str(KINDS.index(kind)), _count("m.x"), "char_length(m.x)",
        "char_length(regexp_replace(m.x, '[A-Za-z0-9]', ''))", "char_length(regexp_replace(m.x, '[^A-Za-z]', ''))",
        f"size({groups})", f"coalesce(array_max({sizes}), 0)", f"coalesce(array_min({sizes}), 0)",
        "char_length(regexp_replace(m.x, '[^ ]', ''))", "char_length(regexp_replace(m.x, '[^.]', ''))",
        flag.format(f"{before} rlike '[A-Za-z0-9]$'"), flag.format(f"{after} rlike '^[A-Za-z0-9]'"),
        flag.format(f"lower({before}) rlike '{CUES[kind]}'"),
        flag.format(_luhn("m.x")), flag.format(_octets("m.x")),
    ]
    return f"array({', '.join(f'cast({f} AS double)' for f in figures)})"


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its base spans and its candidates: ``doc_id``, ``text_sha256``,
    ``base`` (structs s, k, e) and ``candidates`` (structs s, k, e, clash, breaks, f)."""
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"),
                       F.sha2(text_of(text_col), 256).alias("text_sha256"))
    rows = rows.select("*", F.struct(*[
        F.expr(f"transform(filter({_spans(BASE[k], NEEDS[k])}, m -> {CHECKS[k]}), "
               f"m -> named_struct('s', m.s, 'k', {n}, 'e', m.e))").alias(k)
        for n, k in enumerate(KINDS)]).alias("b"),
        F.struct(*[F.expr(_spans(p, needs)).alias(g) for g, (p, _, needs) in GENERATORS.items()]).alias("g"))
    rows = rows.withColumn("base", F.expr("array_sort(concat(b.email, b.ip, b.card, b.phone))"))
    proposed = [F.expr(f"""transform(filter(g.{g}, m -> {FITS[k]}), m -> named_struct(
            's', m.s, 'k', {KINDS.index(k)}, 'e', m.e,
            'clash', exists(base, b -> b.s < m.e AND m.s < b.e AND b.k != {KINDS.index(k)}),
            'same', exists(base, b -> b.s < m.e AND m.s < b.e AND b.k = {KINDS.index(k)}),
            'breaks', {BREAKS[k]}, 'f', {_figures(k)}))""")
        for g, (_, kinds, _) in GENERATORS.items() for k in kinds]
    return rows.select("doc_id", "text_sha256", "base", F.concat(*proposed).alias("candidates"))


class Model:
    """Boosted trees as a SQL expression of a candidate, and a threshold per kind."""

    def __init__(self, margin: str = "0.0", thresholds: dict[int, float] | None = None):
        self.margin, self.thresholds = margin, thresholds or {}

    def chosen(self, c: str = "c") -> str:
        """SQL: candidate ``c`` is to be redacted."""
        some = [f"({c}.k = {k} AND {self.margin.replace('@', f'{c}.f')} >= {t!r}D)"
                for k, t in sorted(self.thresholds.items())]
        return " OR ".join(some) or "false"


def _tree(node, cuts: list[list[float]]) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return f"{node.prediction()!r}D"
    split = node.split()
    cut = cuts[split.featureIndex()][int(split.threshold())]
    return (f"CASE WHEN @[{split.featureIndex()}] <= {cut!r}D "
            f"THEN {_tree(node.leftChild(), cuts)} ELSE {_tree(node.rightChild(), cuts)} END")


def examples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All candidates that teach: figures ``f``, ``kind``, ``label``, whether they are
    kept ``apart`` (a quarter, by a hash of text and place) and their number ``n``."""
    rows = found(docs.withColumn("__id", F.xxhash64(text_of(text_col))), "__id", text_col)
    each = rows.select("doc_id", F.explode("candidates").alias("c"))
    label = F.when(F.col("c.same"), 1.0).when(F.col("c.clash") | F.col("c.breaks"), 0.0)
    spot = F.xxhash64("doc_id", "c.s", "c.k")
    return each.select("c.f", F.col("c.k").alias("kind"), label.alias("label"),
                       (F.pmod(F.shiftright(spot, 8), F.lit(4)) == 0).alias("apart")) \
        .where("label IS NOT NULL").groupBy("f", "kind", "label", "apart").agg(F.count("*").alias("n"))


def _cuts(seen: DataFrame, most: int) -> list[list[float]]:
    """Per figure the values between which trees may part: all it has but the last, or
    where it has more than ``most``, that many which part the examples about evenly."""
    values = seen.select(F.posexplode("f").alias("figure", "v"), "n").groupBy("figure", "v").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("figure")
    up_to = F.sum("n").over(by.orderBy("v")) * (most + 1) / F.sum("n").over(by)
    few = F.count("*").over(by) <= most + 1
    bins = values.select("figure", "v", F.when(few, F.col("v")).otherwise(F.ceil(up_to)).alias("bin"))
    ends = bins.groupBy("figure", "bin").agg(F.max("v").alias("v")).collect()
    return [sorted(r["v"] for r in ends if r["figure"] == i)[:-1] for i in range(FIGURES)]


def fit(docs: DataFrame, text_col: str = "text", trees: int = 20, precision: float = 0.99, seed: int = 5) -> Model:
    """Fit on every example of ``docs``; a quarter of them is kept apart to calibrate.

    A threshold is the least margin from which on the examples kept apart reach
    ``precision``; a kind without such a margin adds nothing.  Without examples of
    both classes no candidate is ever added.
    """
    known = stored(examples(docs, text_col))
    taught = known.where("NOT apart")
    seen = {r["label"] for r in taught.select("label").distinct().collect()}
    if len(seen) < 2:
        return Model()
    # figures as the number of cuts below them: the library finds cuts in a sample of its own
    cuts = _cuts(taught, MOST_CUTS)
    place = F.array(*[sum((F.when(F.col("f")[i] > c, 1.0).otherwise(0.0) for c in figure), F.lit(0.0))
                      for i, figure in enumerate(cuts)])
    placed = taught.groupBy(place.alias("place"), "label").agg(F.sum("n").cast("double").alias("n"))
    boosted = GBTClassifier(maxIter=trees, maxDepth=3, maxBins=BINS, seed=seed, labelCol="label", featuresCol="v",
                            weightCol="n").fit(placed.select(array_to_vector("place").alias("v"), "label", "n"))
    margin = " + ".join(f"{w!r}D * ({_tree(t._java_obj.rootNode(), cuts)})"
                        for w, t in zip(boosted.treeWeights, boosted.trees))
    scores = known.where("apart").select("kind", "label", "n", F.expr(
        f"floor(({margin.replace('@', 'f')}) * 20) / 20").alias("low"))
    bins = scores.groupBy("kind", "low").agg(
        F.sum(F.col("label") * F.col("n")).alias("yes"), F.sum("n").alias("n")).collect()
    thresholds = {}
    for kind in range(len(KINDS)):
        yes = n = 0
        for row in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["low"]):
            yes, n = yes + row["yes"], n + row["n"]
            if yes < precision * n or row["low"] < 0:
                break
            thresholds[kind] = float(row["low"])
    return Model(f"({margin})", thresholds)


def _joined(spans: str) -> str:
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, m -> concat({kinds}[m.k], ':', m.s, ':', m.e)), ',')"


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``
    (base spans), ``base_sha256``, ``spans`` (base and added, ``kind:start:end`` by
    start, then kind, in code points, end exclusive) and ``text_sha256``.

    A null text counts as empty; a text without personal data has no spans, and the
    SHA-256 of the empty string.  Repeated rows each get their row.  An empty table
    gives an empty result; other columns are ignored.
    """
    rows = found(docs, id_col, text_col)
    added = f"""transform(filter(candidates, c -> NOT c.same AND NOT c.clash AND NOT c.breaks
        AND ({model.chosen()})), c -> named_struct('s', c.s, 'k', c.k, 'e', c.e))"""
    rows = rows.select("doc_id", "text_sha256", "base", F.expr(f"array_sort(concat(base, {added}))").alias("every"))
    return rows.select(
        "doc_id", *[F.expr(f"cast(size(filter(base, b -> b.k = {n})) AS bigint)").alias(f"n_{k}")
                    for n, k in enumerate(KINDS)],
        F.sha2(F.expr(_joined("base")), 256).alias("base_sha256"),
        F.expr(_joined("every")).alias("spans"), "text_sha256")


def redact(docs: DataFrame, spans: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every span of :func:`find` replaced by its kind in brackets.

    Overlapping spans are cut at the end of the one that starts first.  Rows without
    a row in ``spans`` keep their text.  Rows are told by id and text, so each row gets
    its own text's spans, however many rows share an id or have none.
    """
    names = [c for c in docs.columns if c != text_col]
    each = spans.groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")) \
        .agg(F.min("spans").alias("__spans"))
    joined = docs.join(each, (F.sha2(text_of(text_col), 256) == F.col("__sha")) &
                       column(id_col).cast("long").eqNullSafe(F.col("__id")), "left")
    parts = F.expr("""transform(filter(split(coalesce(__spans, ''), ','), p -> p != ''), p -> named_struct(
        'k', split_part(p, ':', 1), 's', cast(split_part(p, ':', 2) AS int), 'e', cast(split_part(p, ':', 3) AS int)))""")
    masked = f"""aggregate(__parts, named_struct('at', 0, 'out', ''), (a, p) -> CASE WHEN p.s < a.at
        THEN named_struct('at', greatest(a.at, p.e), 'out', a.out)
        ELSE named_struct('at', p.e, 'out', concat(a.out, substring(__t, a.at + 1, p.s - a.at), '[', p.k, ']')) END,
        a -> concat(a.out, substring(__t, a.at + 1)))"""
    return joined.withColumn("__parts", parts).withColumn("__t", text_of(text_col)).select(
        *[column(c) for c in names], F.expr(masked).alias(text_col))
