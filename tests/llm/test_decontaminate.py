"""Templates, placeholders and slot consistency."""

from pyspark.sql import functions as F

from fieldmark.llm.decontaminate import contaminated, in_form, template_words

ITEM = "A train leaves the town at 9 and meets Anna after 40 km while Anna waits 3 hours for the train at 9"
BENCH = [(1, ITEM), (2, "Die Katze sitzt auf der Matte und schläft den ganzen Tag"), (3, "too short"), (4, None), (None, "an item without an id that has words enough"), (5, "five words make one whole")]


def found(frame, docs, **more):
    df = frame(docs, "doc_id long, text string").selectExpr("*", "1 AS place", "2 AS w", "3 AS item_id")
    out = contaminated(df, frame(BENCH, "item_id long, text string"), **more)
    return {(r["doc_id"], r["item_id"]): r["exact"] for r in out.collect()}


def test_words(frame):
    df = frame([("we saw Anna run 3.5 km and 20% of 1,000 x2",)], "text string")
    assert df.select(template_words(F.col("text"))).first()[0] == "we saw <p>anna run <n>3.5 <u>km and <n>20 <u> of <n>1,000 x2".split()


def test_marked_words_have_two_forms(frame):
    df = frame([("Then Anna sat. Bob saw, Eve too",)], "text string").select(template_words(F.col("text")).alias("w"))
    assert df.first()[0] == "<s>then <p>anna sat <s>bob saw <p>eve too".split()
    both = df.select(in_form(F.col("w"), F.lit(False)), in_form(F.col("w"), F.lit(True))).first()
    assert both[0] == "then <p>anna sat bob saw <p>eve too".split() and both[1] == "<p>then <p>anna sat <p>bob saw <p>eve too".split()


def test_short_items_are_found_with_their_own_values(frame):
    items = [(1, "what is two plus"), (2, "7 km"), (3, "Ask Anna"), (4, " "), (5, "!!")]
    docs = [(1, "so what is two plus three"), (2, "it is 7 km away"), (3, "it is 8 km away"), (4, "please ask Anna now"), (5, "please ask Bob now"), (6, "what is one plus")]
    assert found_items(frame, items, docs) == {(1, 1): True, (2, 2): True, (4, 3): True}


def test_numbers_of_many_groups_are_one_word(frame):
    long = ".".join(["12"] * 30)
    df = frame([(f"at {long} or 5",)], "text string")
    assert df.select(template_words(F.col("text"))).first()[0] == ["at", f"<n>{long}", "or", "<n>5"]


def test_cases(frame):
    asked = ITEM.replace("9", "7").replace("Anna", "Bob").replace("40", "55").replace("3 hours", "2 hours")
    inconsistent = ITEM.replace("at 9 and", "at 7 and").replace("Anna after", "Bob after")
    docs = [
        (1, f"before it {ITEM} and after it"),
        (2, f"before it {asked} and after"),
        (3, f"before it {inconsistent}"),
        (4, "A train leaves the town but nothing else here is like the item at all"),
        (5, "die katze SITZT auf, der matte: und schläft den ganzen tag!"),
        (6, None),
        (7, ""),
        (None, ITEM),
        (8, "he said five words make one whole and left"),
        (9, " ".join(["12"] * 500)),
        (10, "too short"),
        (1, f"before it {ITEM} and after it"),
        (11, ("clean words without any end " * 3000) + ITEM),
    ]
    got = found(frame, docs)
    # Item 3 has two words and is found as a whole.
    assert got == {(1, 1): True, (2, 1): False, (5, 2): True, (8, 5): True, (11, 1): True, (10, 3): True}


def test_half_an_item_is_enough_and_less_is_not(frame):
    words = ITEM.split()
    docs = [(1, "x y " + " ".join(words[:18])), (2, "x y " + " ".join(words[:10]))]
    assert set(found(frame, docs)) == {(1, 1)}


def test_both_join_paths_agree(frame, monkeypatch):
    docs = [(i, f"some {i} words {ITEM}" if i % 3 == 0 else f"clean words number {i} that are not an item") for i in range(30)]
    small = found(frame, docs)
    monkeypatch.setattr("fieldmark.llm.decontaminate.SENT_BYTES", 0)
    assert found(frame, docs) == small == {(i, 1): True for i in range(0, 30, 3)}


def test_empty_tables(frame):
    assert found(frame, []) == {}
    none = contaminated(frame([(1, ITEM)], "doc_id long, text string"), frame([], "item_id long, text string"))
    assert none.count() == 0


def found_items(frame, items, docs):
    out = contaminated(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    return {(r["doc_id"], r["item_id"]): r["exact"] for r in out.collect()}


def test_names_that_open_a_sentence(frame):
    item = "In 3 days a shop sells 40 pens. Anna buys 5 of them and pays 2 dollars"
    asked = item.replace("Anna", "Eve").replace("buys 5", "buys 55")
    chance = item.replace("3 days", "2 days").replace("Anna", "Eve").replace("buys 5", "buys 2")
    got = found_items(frame, [(1, item)], [(1, "Some words. " + asked), (2, item.lower()), (3, chance)])
    assert got == {(1, 1): False, (2, 1): True}


def test_items_of_numbers_are_found_with_their_values_only(frame):
    item = "12 + 34 = 46 and 46 - 12 = 34 and 34 * 2 = 68"
    docs = [(1, f"we read {item} there"), (2, "we read 13 + 35 = 48 and 48 - 13 = 35 and 35 * 3 = 70 there"), (3, "12 " * 300)]
    assert found_items(frame, [(1, item)], docs) == {(1, 1): True}


def test_changed_words_and_partial_passages(frame):
    short = [f"short{chr(97 + i)}" for i in range(15)]
    long = [f"long{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(38)]

    def changed(words, *places):
        return "before it " + " ".join("other" if i in places else w for i, w in enumerate(words)) + " after it"

    added = " ".join([*long[:9], "more", *long[9:20], "words", *long[21:]])
    docs = [(1, changed(short, 7)), (2, changed(long, 12, 25)), (3, changed(long, 9, 18, 28)), (4, "x y " + " ".join(long[9:29])), (5, added), (6, "x y " + " ".join(long[:18]))]
    assert set(found_items(frame, [(1, " ".join(short)), (2, " ".join(long))], docs)) == {(1, 1), (2, 2), (3, 2), (4, 2), (5, 2)}
