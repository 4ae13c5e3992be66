import random

import corpus

from haulmetric.llm import decontaminate as dc
from haulmetric.llm.decontaminate import Leaks, template

QUESTION = (
    "A farmer named Alice Brown sold 25 kg of apples to her neighbour Bob for 40 dollars and then "
    "gave Alice another 12 kg so how many kg did Bob get in the end"
)


def found(spark, texts, items, leaks=Leaks()):
    rows = [(k, text, "en", "a") for k, text in enumerate(texts)]
    docs = corpus.frame(spark, rows).repartition(3)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return dc.find_leaks(docs, benchmark, leaks, "doc_id", "doc_id", "text").collect()


def test_slots_of_a_template():
    t = template('In Paris, Anna paid 25 euros for 3.5kg of APPLES.\nBob said "Hi". The 7 dogs')
    kinds = [(t.data[a:b].decode(), int(k)) for a, b, k in zip(t.starts, t.ends, t.kinds)]
    assert [w for w, k in kinds if k == dc.NAME] == ["Paris", "Anna", "Hi"]
    assert [w for w, k in kinds if k == dc.NUMBER] == ["25", "3.5kg", "7"]
    assert [w for w, k in kinds if k == dc.UNIT] == ["euros"]
    assert template("The cat, sat.").codes.tolist() == template("the CAT sat").codes.tolist()


def test_exact_and_reparameterised_questions_are_caught(spark):
    rng = random.Random(1)
    around = lambda x: corpus.prose(rng, 60) + " " + x + " " + corpus.prose(rng, 60)
    changed = QUESTION.replace("25", "31").replace("12", "9").replace("40", "77").replace("Alice", "Carla").replace("Bob", "Dan").replace("31 kg", "31 lb").replace("9 kg", "9 lb")
    broken = QUESTION.replace("gave Alice", "gave Zoe").replace("did Bob", "did Mia")
    rows = found(spark, [around(QUESTION), around(changed), around(broken), corpus.prose(rng, 200), None, ""], [QUESTION, None, ""])
    by_doc = {r.id: r for r in rows}
    assert by_doc[0].same_values and not by_doc[1].same_values
    assert by_doc[0].n_words >= 30 and by_doc[1].n_words >= 30
    # Slots that contradict each other end a run, so no run covers the whole question.
    assert all(r.n_words < 30 for r in rows if r.id == 2)
    assert set(by_doc) <= {0, 1, 2}


def test_plain_passages_equal_brute_force(spark):
    rng = random.Random(2)
    items = [corpus.prose(rng, rng.choice([6, 14, 40])) for _ in range(20)]
    texts, leaked = [], set()
    for k in range(60):
        text = corpus.prose(rng, 80)
        if k % 3 == 0:
            text += "\n" + items[k % 20] + "\n" + corpus.prose(rng, 30)
            leaked.add((k, k % 20))
        texts.append(text)
    assert {(r.id, r.item) for r in found(spark, texts, items)} == leaked


def test_large_benchmarks_are_joined_by_shuffle(spark):
    rng = random.Random(3)
    items = [corpus.prose(rng, 30) for _ in range(10)]
    texts = [corpus.prose(rng, 50) + "\n" + items[k % 10] for k in range(20)]
    few = found(spark, texts, items)
    many = found(spark, texts, items, Leaks(broadcast_windows=3))
    assert sorted(map(tuple, few)) == sorted(map(tuple, many)) and len({r.id for r in few}) == 20


def test_slot_maps():
    assert dc.consistent([("a", "x"), ("b", "y"), ("a", "x"), (None, None)])
    assert not dc.consistent([("a", "x"), ("a", "y")])
    assert not dc.consistent([("a", "x"), ("b", "x")])
    assert not dc.consistent([("a", None)])


def test_clean_documents_stay_with_their_columns(spark):
    docs = corpus.odd(spark)
    benchmark = spark.createDataFrame([(1, corpus.odd_rows()[0][1])], "item_id long, text string")
    kept = dc.decontaminated(docs, benchmark)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 5, 6, 7, 8, 9]
    assert dc.decontaminated(docs, benchmark.limit(0)).count() == docs.count()
    assert dc.decontaminated(docs.limit(0), benchmark).count() == 0


def test_dense_and_short_items_are_caught(spark):
    rng = random.Random(6)
    around = lambda x: corpus.prose(rng, 60) + ".\n" + x + "\n" + corpus.prose(rng, 60)
    sums = "12 + 35 * 4 - 7 = 145 and 18 / 3 + 9 = 15"
    table = " ".join(str(k) for k in range(101, 113))
    half = f"we first add up all of the values here {table} and then we halve what we got from it"
    other = half
    for k in range(101, 113):
        other = other.replace(str(k), str(k + 400))
    short = "Two and 2?"
    texts = [around(sums), around(half), around(other), around(short), around("one two and 2? three"),
             around("13 + 36 * 5 - 8 = 146 and 19 / 4 + 10 = 16")]
    for leaks in (Leaks(), Leaks(broadcast_windows=3)):
        rows = found(spark, texts, [sums, half, short], leaks)
        assert {(r.id, r.item) for r in rows} == {(0, 0), (1, 1), (2, 1), (3, 2), (5, 0)}
        by_doc = {r.id: r for r in rows}
        assert by_doc[1].n_words == by_doc[2].n_words == len(half.split())
        assert by_doc[1].same_values and not by_doc[2].same_values


FORMS = (
    "{} + {} * {} - {} = {} and {} / {} + {} = {}",
    "Add {} apples {} pears {} plums {} figs {} limes {} dates",
    "what is {} plus {} minus {} times {} over {} less {} if {} is {} more than {}",
    "the ratio {} : {} equals {} : {} where {} and {} are both below {} or {}",
)


def filled(rng, form):
    return form.format(*(rng.randrange(2, 99_999) for _ in range(form.count("{}"))))


def test_dense_questions_with_new_values_are_caught_and_arithmetic_is_not(spark):
    """Recall over planted questions with new numbers, and clean texts of the same kind."""
    rng = random.Random(12)
    items = [filled(rng, f) for f in FORMS]
    texts, planted = [], set()
    for k in range(120):
        text = corpus.prose(rng, 40) + ".\n"
        if k % 2:
            form = k // 2 % len(FORMS)
            text += filled(rng, FORMS[form]) + ".\n"
            planted.add((k, form))
        else:
            # Lists and sums that share pieces with the items, but no whole template.
            text += " ".join(f"{rng.randrange(99)} {rng.choice('+-*/=')}" for _ in range(40)) + ".\n"
            text += filled(rng, "Add {} apples {} pears {} plums {} figs and {} dates") + ".\n"
            text += " ".join(str(rng.randrange(999)) for _ in range(60)) + ".\n"
        texts.append(text + corpus.prose(rng, 40))
    for leaks in (Leaks(), Leaks(broadcast_windows=3)):
        got = {(r.id, r.item) for r in found(spark, texts, items, leaks)}
        assert got <= planted and len(got) >= 0.95 * len(planted)


def test_slots_of_a_dense_question_must_map_one_to_one(spark):
    item = "Add 12 apples 7 pears 12 plums 4 figs 7 limes 8 dates"
    good = "add 5 apples 6 pears 5 plums 1 figs 6 limes 9 dates"
    bad = [good.replace("5 plums", "3 plums"), good.replace("9 dates", "6 dates"), good.replace("figs", "nuts")]
    rows = found(spark, [f"x y z.\n{t}.\nx y" for t in [good, *bad]], [item])
    assert [(r.id, r.n_words, r.same_values) for r in rows] == [(0, 13, False)]


def test_a_form_that_many_texts_fill_in_is_no_leak(spark):
    rng = random.Random(7)
    texts = [f"a b c.\n{filled(rng, FORMS[1])}.\nd e f" for _ in range(30)]
    items = [filled(rng, FORMS[1])]
    assert len({r.id for r in found(spark, texts, items)}) == 30
    assert found(spark, texts, items, Leaks(common=20)) == []
    # A verbatim copy is a leak however common its form is.
    assert {r.id for r in found(spark, [*texts, f"q.\n{items[0]}"], items, Leaks(common=20))} == {30}


def test_a_dense_question_is_caught_in_every_text_that_fills_it_in(spark, tmp_path):
    """250 sets of values, by the operator and by the query: none is lost for being one of many."""
    rng = random.Random(8)
    item = filled(rng, FORMS[1])
    texts = [f"a b c.\n{filled(rng, FORMS[1])}.\nd e f" for _ in range(250)] + [f"a b c.\n{corpus.prose(rng, 40)}"]
    for leaks in (Leaks(), Leaks(broadcast_windows=3)):
        assert sorted(r.id for r in found(spark, texts, [item], leaks)) == list(range(250))
    sf = corpus.stored(corpus.frame(spark, [(k, t, "en", "a") for k, t in enumerate(texts)]), tmp_path)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = dc.op7_decontaminate(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == list(range(250))
    assert {(r.item_id, r.n_words, r.item_words, r.same_values) for r in rows} == {(1, 13, 13, False)}


def plain_templates(text):
    """Words of a text as (slot kind or letters, letters), by regular expressions."""
    import re

    out, opens = [], True
    for line in text.split("\n"):
        opens = True
        for word in line.split():
            core = word.strip("\"'()[]{}.,;:!?") or word
            kind = 0
            if re.fullmatch(r"[-+$]*[0-9][0-9.,:/]*%?", core):
                kind = dc.NUMBER
            elif out and out[-1][0] == dc.NUMBER and core.lower() in dc.UNITS:
                kind = dc.UNIT
            elif not opens and re.fullmatch(r"[A-Z][a-z]+", core):
                kind = dc.NAME
            out.append((kind, core.lower(), core))
            opens = word[-1] in ".!?"
    return out


def test_whole_templates_equal_brute_force(spark):
    """Every item against every place of every text, by plain templates and slot maps."""
    rng = random.Random(21)
    names = ["Anna", "Bert", "Cleo"]
    forms = [*FORMS, "then {n} gave {} kg and {n} took {} kg from {n} for {} dollars or {} euros"]

    def made(form):
        while "{n}" in form:
            form = form.replace("{n}", rng.choice(names), 1)
        return form.format(*(rng.randrange(1, 60) for _ in range(form.count("{}"))))

    items = [made(f) for f in forms for _ in range(2)]
    texts = [f"so it is.\n{made(rng.choice(forms))}.\nand so on" for _ in range(80)]
    want = set()
    for i, item in enumerate(items):
        shape = plain_templates(item)
        for k, text in enumerate(texts):
            words = plain_templates(text)
            for at in range(len(words) - len(shape) + 1):
                part = words[at : at + len(shape)]
                if all(a[0] == b[0] and (a[0] or a[1] == b[1]) for a, b in zip(shape, part)) and dc.consistent(
                    [(a[2], b[2]) for a, b in zip(shape, part) if a[0]]
                ):
                    want.add((k, i))
    got = {(r.id, r.item) for r in found(spark, texts, items) if r.n_words == r.item_words}
    assert got == want and len(want) > 20
