from __future__ import annotations

import random

from encore.llm import decontamination as d
from encore.llm.common import table

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def test_whole_tables_against_plain_windows(spark):
    """Plain texts have no slots to speak of: template windows find what word windows find."""
    folder = "/root/testdata/sf0.001"
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    words = lambda t: "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
    grams = lambda t: {tuple(w[i:i + 5]) for w in [words(t)] for i in range(len(w) - 4)}
    items = {r.item_id: grams(r.text) for r in benchmark.collect()}
    held = {r.doc_id: grams(r.text) for r in documents.collect()}
    share = {(i, k): len(g & h) / len(g) for i, h in held.items() for k, g in items.items() if g}
    found = {(r.doc_id, r.item_id) for r in d.contaminated(documents, benchmark).collect()}
    assert found and found == {k for k, v in share.items() if v >= 0.8}


QUESTION = "A farmer named Bob Stone has 12 apples and gives 5 apples to Mary Hill every day, how many of the 12 apples has he left after walking 3.5 km home"


def test_reparameterised_questions(spark):
    other = QUESTION.replace("Bob Stone", "Carl").replace("Mary Hill", "Jo Ann Wu").replace("12", "31").replace("5 apples", "8 apples").replace("3.5", "7")
    mixed = QUESTION.replace("has 12", "has 40").replace("the 12", "the 77").replace("gives 5", "gives 6").replace("3.5", "9")
    docs = [(1, "Intro text. " + QUESTION + ". More text"), (2, "so then, " + other + " and on"), (3, QUESTION.lower().replace("apples", "pears")),
            (4, "nothing of the kind"), (5, None), (None, QUESTION), (2, "again")]
    rows = d.contaminated(spark.createDataFrame([(*r, 1) for r in docs], DOCS + ", found int"),
                          spark.createDataFrame([(7, QUESTION), (8, None), (9, "too short"), (None, QUESTION), (7, QUESTION)], ITEMS)).collect()
    found = {(r.doc_id, r.item_id): (r.n_slots, r.same_slots) for r in rows}
    assert set(found) == {(1, 7), (2, 7)}
    assert found[2, 7][0] == found[2, 7][1] >= 5
    # one value of the item became two of the document
    loose = d.contaminated(spark.createDataFrame([(3, mixed)], DOCS), spark.createDataFrame([(7, QUESTION)], ITEMS)).collect()
    assert all(r.same_slots < r.n_slots for r in loose)


def test_repeating_windows_are_compared_where_they_align(spark):
    series = "The numbers of the series 12, 15, 18, 21, 24, 27, 30 and 33 grow by the same step, which number follows after them"
    fruit = "so Tom has 3 apples and 4 pears and Ann has 5 apples and 6 pears in a basket, how many pieces of fruit do they have"
    again = fruit.replace("3", "13").replace("4", "14").replace("5", "15").replace("6", "16").replace("Tom", "Eve").replace("Ann", "Lee")
    torn = fruit.replace("in a basket", "in a wide basket")
    two = fruit.replace("Tom has 3", "Tom has 8").replace("Ann has 5", "Ann has 9")
    docs = [(1, "a text before, " + series + ". And more"), (2, fruit), (3, "first " + fruit + ". then " + again), (4, again), (5, torn)]
    mixed = "how has Tom 3 apples and then 3 pears and 3 plums and 3 nuts left over"
    other = "how has Tom 4 apples and then 5 pears and 6 plums and 7 nuts left over"
    rows = d.contaminated(spark.createDataFrame([*docs, (6, other), (7, two)], DOCS),
                          spark.createDataFrame([(1, series), (2, fruit), (3, mixed)], ITEMS)).collect()
    assert {(1, 1), (2, 2), (3, 2), (4, 2), (5, 2), (7, 2)} == {(r.doc_id, r.item_id) for r in rows}
    assert {(r.doc_id, r.n_slots == r.same_slots) for r in rows} == {(i, True) for i in (1, 2, 3, 4, 5, 7)}


PROBLEM = ("Natalia sold 48 clips in April. Natalia then sold half as many clips in May. Natalia gave 10 clips away: "
           "Natalia's sister took 3 clips. How many clips did Natalia sell altogether?")


def test_names_at_the_start_of_sentences(spark):
    weng = PROBLEM.replace("Natalia", "Weng").replace("48", "96").replace("10", "7").replace("April", "June")
    quoted = "Intro.\n\"" + PROBLEM.replace("Natalia", "Mary Ann") + "\" (so it was asked)"
    lines = PROBLEM.replace(". ", ".\n").replace("Natalia", "Wu").replace(": ", ":\t")
    docs = [(1, weng), (2, quoted), (3, lines), (4, PROBLEM), (5, "Weng sold all of it. How many were sold in April is not known.")]
    rows = d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, PROBLEM)], ITEMS)).collect()
    assert {r.doc_id: (r.share >= 0.9, r.n_slots == r.same_slots) for r in rows} == {i: (True, True) for i in (1, 2, 3, 4)}


def test_short_items_and_scripts_without_blanks(spark):
    chinese = "小明有三个苹果，小红有五个梨，他们一共有多少水果？"
    items = [(1, "What is 7 + 5?"), (2, chinese), (3, "12 / 30"), (4, "..."), (5, None), (6, "ผมมีหนังสือ")]
    docs = [(1, "so he asked: what is 8 + 9? and left"), (2, "前文" + chinese + "后文"), (3, "a share of 12 30 in all"), (4, "a share of 12 31"),
            (5, "what was 7 + 5"), (6, "และผมมีหนังสือมาก"), (7, None)]
    rows = d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (2, 2), (3, 3), (6, 6)}


def test_shuffled_beyond_the_broadcast_bound(spark, monkeypatch):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(n))
    items = [(i, text(20)) for i in range(10)]
    docs = [(i, text(30) + " " + items[i % 10][1] + " " + text(30)) for i in range(30)]
    a, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    key = lambda f: sorted(map(tuple, f.collect()))
    wanted = key(d.contaminated(a, b))
    monkeypatch.setattr(d, "BROADCAST_WINDOWS", 0)
    assert key(d.contaminated(a, b)) == wanted and {(i, i % 10) for i in range(30)} <= {r[:2] for r in wanted}


def test_no_rows(spark):
    docs, items = spark.createDataFrame([(1, QUESTION)], DOCS), spark.createDataFrame([(1, QUESTION)], ITEMS)
    assert d.contaminated(docs.limit(0), items).count() == 0 and d.contaminated(docs, items.limit(0)).count() == 0


def test_copies_in_another_case(spark):
    docs = [(1, "so: " + QUESTION.upper() + " ..."), (2, "x " + QUESTION.lower()), (3, PROBLEM.upper()), (4, PROBLEM.lower().replace("48", "47")),
            (5, QUESTION.lower().replace("12", "13").replace("5", "6"))]
    rows = d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, QUESTION), (2, PROBLEM)], ITEMS)).collect()
    assert {(1, 1), (2, 1), (3, 2)} <= {(r.doc_id, r.item_id) for r in rows} and not any(r.doc_id == 5 and r.n_slots == 0 for r in rows)


def test_first_pass_leaves_nothing_out(spark, monkeypatch):
    """The same pairs as with all items looked for in all documents."""
    rng = random.Random(5)
    words = "the of and to in is was for on that with as by at from Tom Ann Berlin 3 14 7.5 kg apples is has".split()
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(5, 40)))) for i in range(25)]
    docs = []
    for i in range(120):
        text = items[i % 25][1].split()
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        docs.append((i, " ".join([*rng.choices(words, k=10), *text, *rng.choices(words, k=10)])))
    a, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = sorted(map(tuple, d.contaminated(a, b).collect()))
    first_pass = d.first_pass

    def nothing(items, width, similarity):
        runs, _ = first_pass(items, width, similarity)
        return runs.limit(0), items.select("item").distinct()

    assert first_pass(b.selectExpr("item_id AS item", "text", "text AS marked"), 5, 0.8)[0].count() > 0
    monkeypatch.setattr(d, "first_pass", nothing)
    assert found == sorted(map(tuple, d.contaminated(a, b).collect())) and len(found) > 20


def test_many_numbers_in_one_text(spark):
    """Values are taken with their tokens, not looked up by their place."""
    docs = [(1, " ".join(map(str, range(100_000)))), (2, QUESTION)]
    rows = d.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(7, QUESTION), (8, "7 + 5 ?")], ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(2, 7)}
