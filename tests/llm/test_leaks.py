"""Benchmark items that a document holds more than once, or with other names at the start of a sentence."""

from folio.llm.decontaminate import template_leaks

ITEM = "In the town of Berlin 20 people buy 35 apples at 4 dollars each and carry 12 of them to Madrid before noon"
OTHERS = [ITEM.replace("Berlin", a).replace("20", b).replace("35", c).replace("12", d).replace("Madrid", e)
          for a, b, c, d, e in (("Oslo", "31", "62", "17", "Paris"), ("Lima", "44", "71", "29", "Quito"), ("Turin", "55", "83", "18", "Nice"))]


def leaks(spark, texts, items, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in template_leaks(spark, docs, bench, **more).collect())


def test_several_versions_in_one_document(spark):
    filled = [ITEM.replace("Berlin", f"B{'a' * k}").replace("20", str(200 + k)).replace("35", str(300 + k)) for k in range(1, 7)]
    late = ITEM.split()
    longer = [" ".join(t.split()[:12] + ["surely"] + t.split()[12:]) for t in (f"{ITEM} and so on until the whole lot is sold to the last of those who came", )]
    mixed = ITEM.replace("20", "5").replace("Berlin", "Rome")
    texts = [f"{ITEM}\n{OTHERS[0]}", "\n".join(OTHERS), " so it goes ".join([OTHERS[1], ITEM, OTHERS[2]]), "\n".join(filled),
             " ".join(late[:10]) + " " + " ".join(OTHERS[0].split()[14:]), mixed]
    assert leaks(spark, texts, [ITEM]) == [(0, 0), (1, 0), (2, 0), (3, 0), (5, 0)]
    assert leaks(spark, texts, [ITEM], most_windows=0) == [(0, 0), (1, 0), (2, 0), (3, 0), (5, 0)]
    # an occurrence with a word put in, beside another version
    item = f"{ITEM} and so on until the whole lot is sold to the last of those who came"
    other = item.replace("Berlin", "Oslo").replace("20", "31").replace("35", "62").replace("12", "17").replace("Madrid", "Paris")
    assert leaks(spark, [f"{longer[0]}\n{other}"], [item]) == [(0, 0)]


def test_names_where_sentences_begin(spark):
    items = ["Maria buys 3 pens for 2 dollars each. Maria then gives 1 pen to Tom. How many pens are left?",
             "On the way home McDonald counts 12 birds and then MARIA sees 7 more; Jean-Paul saw none of them at all that day",
             "The USA and NATO met in summer and the USA then signed what was put before them by the others"]
    swap = lambda t, *pairs: [t := t.replace(a, b) for a, b in pairs][-1]
    texts = [swap(items[0], ("Maria", "Anna"), ("Tom", "Ben"), ("3", "8"), ("2", "5")), f"She said: {items[0]}",
             swap(items[1], ("McDonald", "Smith"), ("MARIA", "ANNA"), ("Jean-Paul", "Karl-Heinz"), ("12", "19")), items[2].lower(), items[1].upper(),
             swap(items[0], ("Maria buys", "Anna buys"), ("Maria then", "Carla then"), ("Tom", "Ben"), ("3 ", "8 "), ("2 ", "Y2K ")),
             "The cats buy 3 pens for nothing. Then they went to Tom. How very odd of them it was to do so"]
    found = leaks(spark, texts, items)
    assert {(0, 0), (1, 0), (2, 1), (3, 2), (4, 1)} <= set(found) and not {d for d, _ in found} & {6}
    assert leaks(spark, texts, items, most_windows=0) == found


def test_many_equal_words_at_sentence_starts_are_no_slots(spark):
    item = "The 5 cats met 7 dogs. The 9 hens met 4 rats. The 6 cows met 3 pigs. The 8 bees met 2 ants."
    other = "The 1 cats met 1 dogs. The 1 hens met 2 rats. The 1 cows met 1 pigs. The 1 bees met 1 ants."
    assert leaks(spark, [item, other], [item]) == [(0, 0), (1, 0)]
