"""Personal data by weak supervision, in DataFrame and SQL functions only (operator 2).

Fixed rules find e-mail addresses, IP addresses, card and phone numbers; these spans always stay.
Beyond them, wider patterns propose candidates. Labelers (shape, gazetteer, context words,
counter-words, borders) vote on every candidate or abstain. Expectation-maximisation over the
counts of vote patterns estimates how reliable each labeler is, without any labels, and the
probabilities that follow train a naive Bayes classifier over features of spans. Candidates that
it finds personal become further spans where they do not overlap a fixed one.

Texts are searched once. Patterns are possessive and anchored so that each needs linear time and
no recursion. The vote table has at most 3 ** 5 rows and the classifier a fixed number of
features; only these reach the driver. Sums of probabilities are taken in millionths, so they do
not depend on the order of rows.

Defined results: a null text is an empty one and has no spans; rows are told apart by position,
so ids may be null or repeated; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from haulmetric.llm.common import quoted, read, saved

# Fixed patterns. Possessive where that changes no match: what follows cannot start inside.
_LOCAL = "A-Za-z0-9._%+-"


@dataclass(frozen=True)
class Kind:
    """A pattern, and a cheap condition without which it matches nowhere."""

    name: str
    pattern: str
    hint: str


KINDS = (
    Kind(
        "email",
        # A local part starts where its letters do, or where the match before ended.
        rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
    ),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", "[0-9][ -]?[0-9]"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]"),
    Kind("local_phone", r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", "[0-9]{4}"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
    ),
    Kind("masked_email", rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]++)++", r"[\[(]at[\])]"),
    Kind(
        "person",
        r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra)\.? \p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)?",
        "Mr|Ms|Dr|Prof|Herr|Frau|Mme|Sra",
    ),
)
BASE = ("email", "ip", "card", "phone")
ORDER = tuple(k.name for k in KINDS)

# The gazetteers.
TLDS = "com org net edu gov info biz io eu de fr es it uk us ca au at ch nl be pl se no dk fi br mx jp cn in ru".split()
CALLING = "1 7 20 27 30 31 32 33 34 39 41 43 44 45 46 47 48 49 52 55 61 81 82 86 90 91 351 352 353 358".split()
IBAN_COUNTRIES = "AT BE CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LT LU LV MT NL NO PL PT RO SE SI SK".split()

# Words before a span that speak for it, by kind, and against any.
FOR = {
    "email": "mail|contact|write|reach",
    "masked_email": "mail|contact|write|reach",
    "ip": "ip|address|host|login|server",
    "card": "card|visa|master|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|cell|anruf",
    "local_phone": "phone|tel|call|mobile|fax|cell|anruf",
    "ssn": "ssn|social|security",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "person": "dear|from|signed|by|with|lieber?|cher|estimad[oa]",
}
AGAINST = "order|invoice|version|isbn|issn|page|chapter|ref|no\\.|figure|table|serial|model|part"

LABELERS = ("shape", "gazetteer", "context", "counter", "border")
#: Rounds of expectation-maximisation.
ROUNDS = 25


def extracted(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """One row per document: row, `keep`, and per kind the matches with the gaps before them.

    A gap is the text between two matches: its length gives places, its ends the context.
    """
    body = F.coalesce(quoted(text).cast("string"), F.lit(""))
    columns = []
    for kind in KINDS:
        hits = F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))
        gaps = F.split(body, kind.pattern, -1)
        found = F.zip_with(
            hits, gaps,
            lambda h, g: F.struct(
                F.length(g).alias("gap"), F.length(h).alias("size"), h.alias("hit"),
                F.left(g, F.lit(8)).alias("head"), F.right(g, F.lit(40)).alias("tail"),
            ),
        )
        hinted = body.contains(kind.hint) if kind.name == "email" else body.rlike(kind.hint)
        columns.append(F.when(hinted, found).alias(kind.name))
    return docs.select(F.monotonically_increasing_id().alias("row"), *keep, *columns)


def _parts_small(hit: Column) -> Column:
    """Every part of an IP address is at most 255; leading zeros count for nothing."""
    return F.forall(
        F.split(hit, r"\."), lambda p: p.rlike("^0*(?:[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])?$")
    )


def _valid() -> Column:
    """Whether a match passes the test of its kind."""
    digits = F.length("digits")
    of = F.col("kind")
    return (
        F.when(of == "ip", _parts_small(F.col("hit")))
        .when(of == "card", digits.between(16, 19) & F.expr("luhn_check(digits)"))
        .when(of == "phone", digits.between(8, 15))
        .when(of == "ssn", ~F.col("hit").rlike("^(?:000|666|9[0-9]{2})|-00-|-0000$"))
        .when(of == "iban", F.length(F.replace("hit", F.lit(" "))).between(15, 34))
        .otherwise(True)
    )


def candidates(found: DataFrame) -> DataFrame:
    """One row per match: row, kind, start, end (code points), hit, context, `base` and votes."""
    tagged = F.concat(
        *(
            F.when(
                F.size(k.name) > 1,
                F.array(F.struct(F.lit(k.name).alias("kind"), F.col(k.name).alias("found"))),
            ).otherwise(F.array().cast("array<struct<kind:string,found:array<struct<gap:int,size:int,hit:string,head:string,tail:string>>>>"))
            for k in KINDS
        )
    )
    each = found.select("row", F.inline(tagged)).select(
        "row", "kind", F.posexplode("found").alias("k", "m")
    ).select("row", "kind", "k", "m.*")
    order = W.partitionBy("row", "kind").orderBy("k")
    before = order.rowsBetween(W.unboundedPreceding, 0)
    placed = (
        each.withColumn("end", F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(before))
        .withColumn("after", F.lead("head").over(order))
        .filter("hit IS NOT NULL")
        .withColumn("start", F.col("end") - F.col("size"))
        .withColumn("digits", F.regexp_replace("hit", "[^0-9]", ""))
        .withColumn("context", F.lower("tail"))
    )
    valid = placed.withColumn("valid", _valid())
    vote = lambda yes, no: F.when(yes, 1).when(no, 0).otherwise(-1)
    of = F.col("kind")
    known = (
        F.when(of.isin("email", "masked_email"), F.lower(F.regexp_extract("hit", "([A-Za-z0-9-]+)[^A-Za-z0-9]*$", 1)).isin(TLDS))
        .when(of == "phone", F.exists(F.array(*map(F.lit, CALLING)), lambda c: F.startswith("digits", c)))
        .when(of == "card", F.substring("digits", 1, 1).isin("3", "4", "5", "6"))
        .when(of == "iban", F.substring("hit", 1, 2).isin(IBAN_COUNTRIES))
        .when(of == "ip", ~F.col("hit").rlike(r"^(?:0|127|255)\."))
    )
    speaks = F.lit(False)
    for kind, pattern in FOR.items():
        speaks |= (of == kind) & F.col("context").rlike(rf"(?<!\p{{L}})(?:{pattern})")
    number = F.when(of == "card", F.length("digits") >= 13).otherwise(True)
    voted = valid.select(
        "row", "kind", F.col("start").cast("long"), F.col("end").cast("long"), "hit", "digits", "context", "after",
        (of.isin(*BASE) & F.col("valid")).alias("base"),
        vote(F.col("valid"), ~F.col("valid")).alias("shape"),
        vote(F.coalesce(known, F.lit(False)) & number, known.isNotNull() & ~(known & number)).alias("gazetteer"),
        vote(speaks, F.lit(False)).alias("context_vote"),
        vote(F.lit(False), F.col("context").rlike(rf"(?<!\p{{L}})(?:{AGAINST})[^\p{{L}}]*$")).alias("counter"),
        vote(
            F.col("context").rlike(r"(?:^|[\s(:;,<\"'])$") & F.coalesce(F.col("after").rlike(r"^(?:$|[\s).,;:!?>\"'])"), F.lit(True)),
            F.col("context").rlike(r"[\p{L}0-9]$") | F.col("after").rlike(r"^[\p{L}0-9]"),
        ).alias("border"),
    )
    votes = F.array("shape", "gazetteer", "context_vote", "counter", "border")
    return voted.withColumn("votes", votes).drop("shape", "gazetteer", "context_vote", "counter", "border")


def _chance(votes: str, p: str) -> str:
    """SQL: probability that a candidate with these votes is personal, under parameters p."""
    one = f"aggregate(sequence(0, {len(LABELERS) - 1}), ln({p}.prior) - ln(1 - {p}.prior), (s, j) -> s + CASE {votes}[j] WHEN 1 THEN ln({p}.hit[j]) - ln(1 - {p}.right[j]) WHEN 0 THEN ln(1 - {p}.hit[j]) - ln({p}.right[j]) ELSE 0D END)"
    return f"(1 / (1 + exp(-({one}))))"


def reliabilities(found: DataFrame) -> DataFrame:
    """One row of parameters: prior, hit (votes 1 on personal spans) and right (0 on others).

    Expectation-maximisation over the table of vote patterns, as one SQL expression: each
    round gives every pattern its probability and every labeler its shares. Two imagined votes
    per labeler and class keep shares off 0 and 1.
    """
    table = found.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("t")
    )
    shape = "struct<prior: double, hit: array<double>, right: array<double>>"
    start = f"CAST(named_struct('prior', 0.5D, 'hit', array_repeat(0.8D, {len(LABELERS)}), 'right', array_repeat(0.8D, {len(LABELERS)})) AS {shape})"
    total = lambda what, seed: f"aggregate(w, {seed}, (s, x) -> s + {what})"
    share = lambda weight, value: (
        f"transform(sequence(0, {len(LABELERS) - 1}), j -> "
        f"aggregate(w, 1.6D, (s, x) -> s + IF(x.votes[j] = {value}, {weight}, 0D)) / "
        f"aggregate(w, 2D, (s, x) -> s + IF(x.votes[j] >= 0, {weight}, 0D)))"
    )
    step = (
        f"transform(array(transform(t, y -> named_struct('votes', y.votes, 'n', y.n, 'r', {_chance('y.votes', 'p')}))), "
        f"w -> CAST(named_struct('prior', {total('x.n * x.r', '1D')} / {total('x.n', '2D')}, "
        f"'hit', {share('x.n * x.r', 1)}, 'right', {share('x.n * (1 - x.r)', 0)}) AS {shape}))[0]"
    )
    return table.select(F.expr(f"aggregate(sequence(1, {ROUNDS}), {start}, (p, i) -> {step})").alias("p"))


def features(frame: DataFrame) -> DataFrame:
    """Add `features`: an array of strings out of a fixed, small set."""
    last = F.right("context", F.lit(1))
    side = lambda c: (
        F.when(F.coalesce(F.length(c), F.lit(0)) == 0, "edge").when(c.rlike(r"^\s"), "blank")
        .when(c.rlike(r"^\p{L}"), "letter").when(c.rlike("^[0-9]"), "digit").otherwise("mark")
    )
    word = F.regexp_extract("context", r"(\p{L}+)[^\p{L}]*$", 1)
    return frame.withColumn(
        "features",
        F.array(
            F.concat(F.lit("kind:"), "kind"),
            F.concat(F.lit("digits:"), F.col("kind"), F.lit(":"), F.least(F.length("digits"), F.lit(20)).cast("string")),
            F.concat(F.lit("before:"), side(last)),
            F.concat(F.lit("after:"), side(F.col("after"))),
            F.concat(F.lit("spaced:"), F.col("hit").rlike("[ ()-]").cast("string")),
            F.concat(F.lit("word:"), F.pmod(F.xxhash64(word), F.lit(64)).cast("string")),
        ),
    )


def classifier(found: DataFrame, chance: Column) -> dict[str, int]:
    """Log odds in millionths by feature, and of the prior under the empty name."""
    soft = F.round(chance * 1_000_000).cast("long")
    rows = (
        features(found)
        .select(soft.alias("yes"), F.explode(F.array_append("features", F.lit(""))).alias("feature"))
        .groupBy("feature")
        .agg(F.sum("yes").alias("yes"), F.count(F.lit(1)).alias("n"))
    )
    whole = rows.filter("feature = ''").select(F.col("yes").alias("all_yes"), F.col("n").alias("all_n")).first()
    if whole is None:
        return {}
    yes, no = whole.all_yes / 1e6, whole.all_n - whole.all_yes / 1e6
    # Share of a feature among personal spans against its share among the others, one added to each.
    own = F.ln((F.col("yes") / 1e6 + 1) / (yes + 2)) - F.ln((F.col("n") - F.col("yes") / 1e6 + 1) / (no + 2))
    prior = F.ln(F.lit((yes + 1) / (no + 1)))
    weight = F.round(F.when(F.col("feature") == "", prior).otherwise(own) * 1_000_000).cast("long")
    return {r.feature: r.weight for r in rows.select("feature", weight.alias("weight")).collect()}


def judged(found: DataFrame) -> DataFrame:
    """Add `score`, the log odds of the trained classifier in millionths."""
    p = reliabilities(found).first()
    if p is None or p.p is None:
        return features(found).withColumn("score", F.lit(0).cast("long"))
    p = p.p
    numbers = lambda xs: F.array(*(F.lit(float(x)) for x in xs))
    at = found.withColumn(
        "p", F.struct(F.lit(float(p.prior)).alias("prior"), numbers(p.hit).alias("hit"), numbers(p.right).alias("right"))
    )
    weights = classifier(at, F.expr(_chance("votes", "p")))
    table = F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair)).cast("map<string,bigint>")
    score = F.aggregate(
        "features", F.lit(weights.get("", 0)).cast("long"),
        lambda s, f: s + F.coalesce(F.try_element_at(table, f), F.lit(0)),
    )
    return features(found).withColumn("score", score)


def personal_spans(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """One row per document: the columns of `keep`, `base` and `added`.

    Both are arrays of (kind, start, end), by kind in the order of KINDS, then by start.
    """
    names = [f"keep{k}" for k in range(len(keep))]
    kept = [quoted(c).alias(n) for c, n in zip(keep, names, strict=True)]
    found = saved(extracted(docs, text, kept), "matches")
    spans = saved(candidates(found), "candidates")
    place = F.struct(
        F.array_position(F.array(*map(F.lit, ORDER)), F.col("kind")).alias("rank"), "start", "end", "kind"
    )
    scored = judged(spans).select("row", "base", "score", place.alias("span"))
    per_row = scored.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base"),
        F.sort_array(F.collect_list(F.when(~F.col("base") & (F.col("score") > 0), F.col("span")))).alias("more"),
    )
    free = F.filter(
        "more",
        lambda m: ~F.exists("base", lambda b: (m["start"] < b["end"]) & (b["start"] < m["end"])),
    )
    empty = F.array().cast("array<struct<rank:bigint,start:bigint,end:bigint,kind:string>>")
    bare = lambda c: F.transform(F.coalesce(c, empty), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))  # noqa: E731, E501
    return found.select("row", *names).join(per_row.withColumn("more", free), "row", "left").select(
        *(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)),
        bare(F.col("base")).alias("base"), bare(F.col("more")).alias("added"),
    )


def in_order(spans: Column) -> Column:
    """Spans by kind as listed, then start."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, ORDER)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))  # noqa: E501
    return F.sort_array(keyed)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(read(spark, sf_dir, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(in_order(F.concat("base", "added"))).alias("spans"),
    )
