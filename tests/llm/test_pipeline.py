import random

import corpus_pipeline
from corpusloom.llm import byte_index, decontamination, quality_trees
from corpusloom.llm.registry import QUERIES, table

from test_byte_index import brute_components, brute_fingerprint
from test_decontamination import brute as brute_leaks
from test_packing import check_pieces
from test_suffix_dedup import brute_words

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    kept = {r["doc_id"] for r in quality_trees.quality_verdicts(docs, table(spark, SF, "labels")).filter("kept").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in kept}
    ids = sorted(texts)
    groups = brute_components(ids, [brute_fingerprint(texts[i]) for i in ids])
    ids = [i for at, i in enumerate(ids) if groups[at] == i]
    cut = corpus_pipeline.repeated_passages(spark, spark.createDataFrame(
        [(i, texts[i], "en", "s", 0) for i in ids], docs.schema), SF).collect()
    assert {r["doc_id"]: (r["text"] or "").encode().split() for r in cut} == dict(zip(ids, brute_words([texts[i] for i in ids], 50)))
    texts = {r["doc_id"]: r["text"] for r in cut}
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    leaks = {d for d, *_ in brute_leaks(list(texts.items()), items)}
    texts = {i: t for i, t in texts.items() if i not in leaks}
    assert len(texts) > 50
    from corpusloom.llm.registry import vocabulary_text
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    assert check_pieces(vocabulary_text(), rows, texts, 2048) > 0.9


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), SF).columns == docs.columns, name


CLASHING = (
    "_id bigint, _hash string, _text_hash int, text_hash int, ranges string, _ranges int, runs int, first int, last int, at int, "
    "minimizer string, block int, fp string, rep int, node int, component int, component_id string, kept boolean, n_words int, "
    "score string, quality string, toxic int, item_id int, start string, similarity int, h int, pos int, w int, `row` int, part int")


def test_stages_keep_columns_named_like_their_own(spark):
    docs = table(spark, SF, "documents").limit(60)
    named = [f.split()[0].strip("`") for f in CLASHING.split(", ")]
    more = docs.selectExpr("*", *[f"cast(doc_id as {f.split()[1]}) as {f.split()[0]}" for f in CLASHING.split(", ")])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made, plain = stage(spark, more, SF), stage(spark, docs, SF)
        assert made.columns == more.columns, name
        assert sorted(map(tuple, made.select(*docs.columns).collect())) == sorted(map(tuple, plain.collect())), name
        for r in made.collect():
            assert all(str(r[c]) == str(r["doc_id"]) or c == "kept" for c in named), name
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, more, SF).count() == stage(spark, docs, SF).count()


def test_no_long_passage_survives(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    texts = [rng.choices(words, k=rng.randrange(20, 200)) for _ in range(60)]
    passages = [rng.choices(words, k=k) for k in (51, 51, 55, 80)] + [["a", "to", "of"] * 17]
    rows = []
    for i, own in enumerate(texts):
        for passage in rng.sample(passages, rng.randrange(3)) if i % 2 else []:
            at = rng.randrange(len(own) + 1)
            own = own[:at] + passage + own[at:]
        rows.append((i, " ".join(own), "en", "s", 0))
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, SF).collect()}
    assert all(left[i] == rows[i][1] for i in range(0, 60, 2))
    seen = {}
    for i, text in left.items():
        for at in range(len(text.split()) - 50):
            seen.setdefault(tuple(text.split()[at:at + 51]), set()).add(i)
    assert all(len(owners) == 1 for owners in seen.values())
    assert not any(" ".join(p) in text for p in passages for text in left.values())


def test_each_stage_takes_no_rows(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_operators_have_one_query_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
