"""Decontamination: edits that shift tokens, parts of items, items that share an id."""

ITEM = ("a farmer near the old river sells apples and pears to a neighbour who brings them by cart to the market every week and "
        "asks how much money the neighbour keeps after paying for the cart and the horse today")


def found(spark, items, texts):
    from ledgerplay.llm import decontaminate as C
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in C.contaminated(docs, bench).collect()}


def test_one_token_more_or_less_does_not_hide_an_item(spark):
    w = ITEM.split()
    texts = [" ".join(w[:k] + ["very"] + w[k:]) for k in range(1, len(w))] + [" ".join(w[:k] + w[k + 1:]) for k in range(1, len(w) - 1)]
    short = w[:17]  # any edit near its middle leaves no stretch of 13 tokens
    texts += [" ".join(short[:8] + ["very"] + short[8:]), " ".join(w[8:25])[::-1]]
    got = found(spark, [(1, ITEM), (2, " ".join(short))], texts)
    assert {d for d, i in got if i == 1} >= set(range(len(texts) - 2))
    assert not any(d == len(texts) - 1 for d, _ in got)


def test_a_long_part_of_an_item_counts(spark):
    w = ITEM.split()
    texts = ["before it " + " ".join(w[5:5 + n]) + " and after" for n in (10, 12, 13, 22)]
    assert found(spark, [(1, ITEM)], texts) == {(2, 1), (3, 1)}


def test_items_of_one_id_and_without_id(spark):
    other = "completely different words are used here to ask which colour the painter takes for the wall of the house"
    items = [(1, ITEM), (1, other), (None, other + " again")]
    assert found(spark, items, [other, ITEM, other + " again"]) == {(0, 1), (0, None), (1, 1), (2, 1), (2, None)}


def test_questions_of_numbers_are_matched_as_they_are(spark):
    items = [(1, "Compute 15 * 23 + 47 - 8."), (2, "What is 12 + 37 * 4 - 9 / 3?"), (3, "7")]
    texts = ["He said: compute 15*23 + 47 - 8. Then he left.", "so what is\n12 + 37 * 4 - 9 / 3 ?", "compute 16 * 23 + 47 - 8", "7 days and 7 nights"]
    assert found(spark, items, texts) == {(0, 1), (1, 2)}


def test_names_at_the_start_of_sentences_are_slots(spark):
    item = "Tom has 3 apples. Tom buys 5 pears. Tom eats 2 of them. How many does Tom have now?"
    new = item.replace("Tom", "Eva")
    texts = ["Before it. " + new, new.replace(". ", ".\n"), new.replace("does Eva", "does\nEva"), "\"" + new + "\"", item.replace("Tom", "Eva", 1)]
    assert found(spark, [(1, item)], texts) >= {(0, 1), (1, 1), (2, 1), (3, 1)}


def test_a_number_and_its_unit_are_one_token(spark):
    item = "the truck drives 12 km to the mill and 7 km to the town, then it takes 3 pears to a shop"
    assert found(spark, [(1, item)], [item.replace("12 km", "12"), item.replace("12 km", "5 miles").replace("7 km", "9"), item.replace("12 km", "12km")]) == {(0, 1), (1, 1), (2, 1)}


def test_one_value_may_stand_for_two_quantities(spark):
    item = "the old farmer picks 3 apples from the tree and then 3 pears from the garden before the cart arrives"
    far = "the old farmer picks 4 apples from the tree and then 7 pears from the garden before the cart arrives"
    assert found(spark, [(1, item)], [far, far + " with 3 men"]) == {(0, 1), (1, 1)}


def test_slots_outside_the_windows_that_hit_are_not_compared(spark):
    item = ("the old farmer picks 3 apples from the tall tree behind the house near a small river , then 3 quick brown foxes jump far away , "
            "and later the same farmer sells 9 of his best apples to the miller who lives next door")
    assert found(spark, [(1, item)], [item.replace("then 3 quick brown foxes jump far away", "some 8 lazy yellow cats sleep right here")]) == {(0, 1)}


def test_one_edited_number_does_not_hide_a_question(spark):
    item = "a box holds 2 red balls and 2 blue balls and a child draws two of them without looking into the box"
    assert found(spark, [(1, item)], [item.replace("2 blue", "3 blue"), item]) == {(0, 1), (1, 1)}


def test_clean_documents_that_share_an_id_stay(spark):
    from ledgerplay.llm import decontaminate as C
    rows = [(None, ITEM), (None, "a clean text without any id"), (7, "x " + ITEM), (7, "another clean text of the same id"), (8, "clean"), (8, None)]
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    left = C.drop_contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left) == sorted((str(a), str(b)) for a, b in (rows[1], rows[3], rows[4], rows[5]))
