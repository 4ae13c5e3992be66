import hashlib
import math
import random
import re
from collections import Counter

import corpus
from pyspark.sql import functions as F

from haulmetric.llm import privacy

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]


def texts():
    rng = random.Random(4)
    fixed = [
        "a@b.cu@d.ef", "a@b.com_x@y.z", "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.4 1.2.3.4.", "a@@b.c x@y..z",
        "+1 (988) 555-2485 ++1 22 333 44", "4041894974608795 4041-8949 7460-8795 1", "é4111 1111 1111 1111é",
        "5" * 3000, "a." * 3000 + "@x.y", "x@" + "a." * 3000 + "b", "+" + "1(" * 3000, None, "",
    ]
    alphabet = "a1@.+- 4(é\n"
    return fixed + ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 40))) for _ in range(800)]


def test_fixed_spans_equal_the_plain_patterns(spark, tmp_path):
    rows = [(k, text, "en", "a") for k, text in enumerate(texts())]
    sf = corpus.stored(corpus.frame(spark, rows).repartition(3), tmp_path)
    found = {r.doc_id: r for r in privacy.op2_personal_data(spark, sf).collect()}
    for k, text, *_ in rows:
        want = brute(text)
        assert found[k].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        counts = Counter(span.split(":")[0] for span in want)
        assert all(found[k][f"n_{kind}"] == counts[kind] for kind in PATTERNS)
        assert set(want) <= set(found[k].spans.split(",")) | {""}


def plain_em(table):
    """Expectation-maximisation in plain Python."""
    count = len(privacy.LABELERS)
    prior, hit, right = 0.5, [0.8] * count, [0.8] * count
    for _ in range(privacy.ROUNDS):
        chances = {}
        for votes in table:
            s = math.log(prior) - math.log(1 - prior)
            for j, v in enumerate(votes):
                if v == 1:
                    s += math.log(hit[j]) - math.log(1 - right[j])
                elif v == 0:
                    s += math.log(1 - hit[j]) - math.log(right[j])
            chances[votes] = 1 / (1 + math.exp(-s))
        total = sum(table.values())
        yes = {v: n * chances[v] for v, n in table.items()}
        no = {v: n * (1 - chances[v]) for v, n in table.items()}
        prior = (1 + sum(yes.values())) / (2 + total)
        share = lambda w, j, value: (1.6 + sum(x for v, x in w.items() if v[j] == value)) / (
            2 + sum(x for v, x in w.items() if v[j] >= 0)
        )
        hit, right = [share(yes, j, 1) for j in range(count)], [share(no, j, 0) for j in range(count)]
    return prior, hit, right


def test_reliabilities_equal_plain_expectation_maximisation(spark):
    rng = random.Random(9)
    table = Counter()
    for _ in range(3000):
        personal = rng.random() < 0.4
        votes = []
        for accuracy in (0.95, 0.8, 0.7, 0.9, 0.6):
            vote = int(personal) if rng.random() < accuracy else int(not personal)
            votes.append(-1 if rng.random() < 0.3 else vote)
        table[tuple(votes)] += 1
    rows = [(list(v),) for v, n in table.items() for _ in range(n)]
    p = privacy.reliabilities(spark.createDataFrame(rows, "votes array<int>")).first().p
    prior, hit, right = plain_em(table)
    assert abs(p.prior - prior) < 1e-9
    assert all(abs(a - b) < 1e-9 for a, b in zip([*p.hit, *p.right], [*hit, *right]))
    # And they are close to the truth: good labelers are told from poor ones.
    assert abs(prior - 0.4) < 0.05 and p.hit[0] > p.hit[4]


def test_further_kinds_are_added_where_context_speaks_for_them(spark):
    rng = random.Random(6)
    rows = []
    for k in range(400):
        body = corpus.prose(rng, 40)
        spoken = [" please call (212) 555-0134 today", " my ssn 123-45-6789 is", " write to jo (at) mail (dot) com now", ""]
        rows.append((k, body + spoken[k % 4], "en", "a"))
        rows.append((1000 + k, body + " invoice no. 212-555-01340 order 999-00-0000x", "en", "a"))
    found = {r.doc_id: r for r in privacy.personal_spans(corpus.frame(spark, rows), ["doc_id"]).collect()}
    assert all({s.kind for s in found[k].added} & {"local_phone", "ssn", "masked_email"} for k in range(400) if k % 4 != 3)
    assert all(not found[k].added for k in range(3, 400, 4))
    assert all(not found[1000 + k].added for k in range(400))


def test_all_spans_stand_by_kind_then_start(spark):
    """Exact text over a whole table, with further spans of the base kinds among them."""
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    spans = {r.doc_id: (r.base, r.added) for r in privacy.personal_spans(docs, ["doc_id"]).collect()}
    assert sum(any(s.kind in privacy.BASE for s in added) for _, added in spans.values()) > 0
    for r in privacy.op2_personal_data(spark, path).collect():
        every = sorted((privacy.ORDER.index(s.kind), s.start, s.end, s.kind) for part in spans[r.doc_id] for s in part)
        assert r.spans == ",".join(f"{kind}:{start}:{end}" for _, start, end, kind in every)


def test_extra_columns_with_clashing_names(spark):
    docs = corpus.odd(spark)
    clashing = docs.select("*", *(F.lit("x").alias(n) for n in ("base", "added", "span", "score", "kind", "start")))
    found = privacy.personal_spans(clashing, ["doc_id", "kind", "start", "row", "score"])
    assert found.count() == docs.count() and found.columns[:5] == ["doc_id", "kind", "start", "row", "score"]


def test_odd_rows_and_empty_tables(spark, tmp_path):
    docs = corpus.odd(spark)
    found = privacy.personal_spans(docs, docs.columns)
    assert found.columns == [*docs.columns, "base", "added"]
    assert found.count() == docs.count()
    assert found.filter(F.size("base") + F.size("added") > 0).count() == 0
    assert privacy.op2_personal_data(spark, corpus.stored(docs.limit(0), tmp_path)).count() == 0


def test_plan_is_native(spark, tmp_path):
    from helpers import plan_of

    plan = plan_of(privacy.op2_personal_data(spark, corpus.stored(corpus.odd(spark), tmp_path)))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
