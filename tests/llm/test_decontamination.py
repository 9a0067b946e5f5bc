import random
from collections import Counter

from corpus_pipeline import benchmark_leaks
from corpusloom.llm import decontamination as dc
from corpusloom.llm.registry import op1_decontamination

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"
VOCABULARY = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "io", "ul", "ér")]


def words(text):
    kept = "".join(c for c in (text or "").lower() if c.isalnum() or c in " \t\n\x0b\x0c\r")
    return kept.split()


def grams(w):
    return [" ".join(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) > 4 else [" ".join(w)] if w else []


def brute(docs, items):
    """Every window of an item's length, compared in full; items of under five words must stand there as they are."""
    best = {}
    for item, text in items:
        b = grams(words(text))
        if 0 < len(words(text)) < 5:
            for doc, other in docs:
                own, n = words(other), len(words(text))
                at = next((i for i in range(len(own) - n + 1) if own[i:i + n] == words(text)), None)
                if at is not None:
                    best[doc, item] = max(best.get((doc, item), (0, 0)), (1.0, -at))
            continue
        for doc, other in docs:
            a = grams(words(other))
            width = min(len(a), len(b))
            for start in range(len(a) - width + 1) if b and a else ():
                own = a[start:start + width]
                both = sum((Counter(own) & Counter(b)).values())
                similarity = both / (width + len(b) - both)
                if similarity >= 0.8:
                    best[doc, item] = max(best.get((doc, item), (0, 0)), (similarity, -start))
    return {(d, i, -s, x) for (d, i), (x, s) in best.items()}


def found(docs, items):
    return {tuple(r) for r in dc.contaminated(docs, items).collect()}


def test_equals_brute_force(spark):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices(VOCABULARY, k=rng.randrange(3, 60)))) for i in range(12)]
    items += [(20, items[0][1]), (21, "la la la la la la la la la la la la")]
    docs = []
    for d in range(60):
        text = rng.choices(VOCABULARY, k=rng.randrange(0, 80))
        if d % 2:
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randrange(3)):
                at = rng.choice([0, -1, rng.randrange(len(passage))])
                passage[at:at + 1] = rng.choice([[], ["neu"], [passage[at], "neu"]])
                passage = passage or ["neu"]
            text[rng.randrange(len(text) + 1):0] = [p.upper() + "," if d % 3 else p for p in passage]
        docs.append((d, " ".join(text)))
    docs.append((100, "la " * 400))
    want = brute(docs, items)
    assert len(want) > 15
    assert found(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)) == want


def test_rows_of_every_kind(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "x " + item + " y", 0), (3, "x " + item + " y", 0), (None, item, 0),
         (4, "one two", 0), (5, "clean " * 3000 + item, 0), (6, "nothing of the kind", 0)], DOCS + ", start int")
    items = spark.createDataFrame([(1, item, 2), (2, None, 2), (3, "", 2), (None, item, 2), (4, "one two", 2)],
                                  ITEMS + ", n int")
    got = found(docs, items)
    assert got == {(d, i, s, 1.0) for d, s in ((3, 1), (None, 0), (5, 3000)) for i in (1, None)} | {
        (d, 4, s, 1.0) for d, s in ((4, 0), (3, 1), (None, 0), (5, 3000))}
    kept = dc.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 6]


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], DOCS)
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert dc.contaminated(none, items).count() == 0
    assert dc.contaminated(some, spark.createDataFrame([], ITEMS)).count() == 0
    assert dc.without_contaminated(some, spark.createDataFrame([], ITEMS)).count() == 1


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], DOCS)
    plan = dc.contaminated(docs, spark.createDataFrame([(1, "a b c d e f g")], ITEMS))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_registered_query_and_pipeline_find_short_items_inside_longer_documents(spark, tmp_path):
    docs = [(1, "So 3 + 4 = 7, and more words follow here."), (2, "seven"), (3, "Seven is not 3 4 8 7 in all"),
            (4, "one two three"), (None, "x one, TWO three four one two"), (5, "one two"), (6, None), (7, "two one"),
            (8, "a five word item is here and more")]
    items = [(1, "3 + 4 = 7"), (2, "Seven!"), (3, "one two"), (4, "one two three four"), (5, "?"), (6, "a five word item is"),
             (None, "one two")]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {tuple(r) for r in op1_decontamination(spark, str(tmp_path)).collect()}
    want = {(1, 1, 1), (2, 2, 0), (3, 2, 0), (None, 4, 1), (8, 6, 0)}
    want |= {(d, i, s) for d, s in ((4, 0), (None, 1), (5, 0)) for i in (3, None)}
    assert got == {(*w, 1.0) for w in want}
    kept = benchmark_leaks(spark, spark.createDataFrame(docs, DOCS), str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [6, 7]


def test_a_phrase_that_many_items_and_texts_share(spark):
    """Every item begins with one long phrase, and so do texts that hold none of them."""
    rng = random.Random(12)
    phrase = "which of the following statements about the matter is the only true one"
    items = [(i, phrase + " " + " ".join(rng.choices(VOCABULARY, k=rng.randrange(10, 60)))) for i in range(25)]
    docs = [(d, phrase + " " + " ".join(rng.choices(VOCABULARY, k=30)) + " " + phrase) for d in range(60)]
    docs += [(100 + i, "x y " + text + " z") for i, text in items[::3]] + [(200, items[4][1].rsplit(" ", 1)[0]), (201, phrase)]
    known = dc.item_table(spark.createDataFrame(items, ITEMS)).cache()
    own = spark.createDataFrame([(d, t, d) for d, t in docs], DOCS + ", text_hash bigint")
    windows = dc.seeded_windows(dc.seed_places(own, known).cache(), known, 0.8)
    assert windows.select("doc_id").distinct().filter("doc_id < 100").count() == 0
    want = brute(docs, items)
    assert {d for d, *_ in want} >= {100 + i for i in range(0, 25, 3)}
    assert found(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)) == want


def test_runs_of_a_repeated_word_stay_within_the_radius(spark):
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(132)] for _ in range(40)]
    items = [(i, " ".join(t + ["zero"] * 16)) for i, t in enumerate(texts)]  # 12 of 144 shingles are the same
    docs = [(i, " ".join(t + [f"filler{i}"] * 16)) for i, t in enumerate(texts)]
    assert len(brute(docs[:3], items[:3])) == 3
    got = found(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert {(d, i) for d, i, _, _ in got} == {(i, i) for i in range(40)}
    assert {s for _, _, _, s in got} == {0.8}
