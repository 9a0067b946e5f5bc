import random

import numpy as np
import pyarrow as pa
import pytest

from __spark_entry__ import queries
from corpusloom.llm import suffix_dedup as sd
from corpusloom.session import list_folder, scratch_root

DOCS = "doc_id bigint, text string"


def brute_kept(texts, span):
    seen = {}
    for t in texts:
        for i in range(len(t) - span + 1):
            seen[t[i:i + span]] = seen.get(t[i:i + span], 0) + 1
    kept = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - span + 1):
            if seen[t[i:i + span]] > 1:
                gone[i:i + span] = True
        kept.append((bytes(b for b, g in zip(t, gone) if not g), gone))
    return kept


def corpus(seed, n=60):
    """Texts that share passages of many lengths, with near copies and repeats inside."""
    rng = random.Random(seed)
    letters = "abé" if seed % 2 else "abcdefghij \n"
    passages = ["".join(rng.choices(letters, k=rng.randrange(5, 90))) for _ in range(6)]
    texts = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randrange(0, 5)):
            text += rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choices(letters, k=rng.randrange(1, 40)))
        if text and rng.random() < 0.2:
            at = rng.randrange(len(text))
            text = text[:at] + "#" + text[at:]
        texts.append(text)
    return texts + texts[:5] + ["aaaa" * 40, "ab" * 70]


def removed(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    return {r["doc_id"]: r for r in sd.repeats_removed(docs, **options).collect()}


@pytest.mark.parametrize("seed,hot_runs", [(0, 4096), (1, 4096), (2, 3), (3, 2)])
def test_equals_brute_force(spark, seed, hot_runs):
    texts = corpus(seed)
    got = removed(spark, texts, span=24, seed=7, hot_runs=hot_runs)
    for i, (kept, gone) in enumerate(brute_kept([t.encode() for t in texts], 24)):
        assert got[i]["kept"] == kept, i
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        assert (got[i]["starts"], got[i]["ends"]) == (edges[::2].tolist(), edges[1::2].tolist())


def test_merge_sort_orders_suffixes():
    rng = random.Random(4)
    strings = ["".join(rng.choices("ab", k=rng.randrange(1, 30))).encode() for _ in range(120)]
    group = np.sort(np.array([rng.randrange(7) for _ in strings]))
    texts = sd.Suffixes(strings)
    start = texts.ends - np.array([len(s) for s in strings])
    order = sd.merge_sort(group, start, texts.ends - start, texts)
    assert [(group[i], strings[i]) for i in order] == sorted((g, s) for g, s in zip(group.tolist(), strings))


def test_a_hash_collision_is_not_a_repeat(monkeypatch):
    texts = sd.Suffixes([b"abcdefgh", b"abcdXfgh"])
    monkeypatch.setattr(texts, "common", lambda a, b, room: room.copy())
    best = sd.longest_matches(np.zeros(2, int), np.array([0, 8]), np.array([8, 8]), 6, texts)
    assert best.tolist() == [0, 0]


def test_long_texts_are_cut_into_parts(monkeypatch):
    text = bytes(random.Random(5).choices(b"abc", k=900))
    whole = [np.concatenate(side) for side in zip(*sd.minimizer_runs(text, 40, 10))]
    monkeypatch.setattr(sd, "PART_BYTES", 100)
    cut = [np.concatenate(side) for side in zip(*sd.minimizer_runs(text, 40, 10))]

    def by_start(runs):
        return {x: (m, a) for m, f, z, a in zip(*(r.tolist() for r in runs)) for x in range(f, z + 1)}
    assert by_start(whole) == by_start(cut)
    assert len(by_start(cut)) == 900 - 40 + 1


def test_rows_of_every_kind(spark):
    passage = "é repeated passage of more than twenty-four bytes"
    rows = [(1, None), (2, ""), (3, "short"), (None, "x" + passage), (4, passage + "y"), (5, "left alone " * 3),
            (6, "a row that is there twice, key and text"), (6, "a row that is there twice, key and text")]
    docs = spark.createDataFrame([(i, t, 0, "s", 1, -1) for i, t in rows],
                                 DOCS + ", first int, text_hash string, runs int, n_chars bigint")
    cut = sd.texts_without_repeats(docs, span=24, seed=7)
    assert cut.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in cut.collect()), key=str)
    assert got == sorted([
        (1, None, None), (2, "", 0), (3, "short", 5), (None, "x", 1), (4, "y", 1), (5, "left alone " * 3, 33), (6, "", 0), (6, "", 0),
    ], key=str)
    assert sd.repeats_removed(docs, span=24, seed=7).count() == len(rows)


def brute_words(texts, span):
    """The words of each text that no repeated window of ``span`` words covers."""
    lists, seen = [(t or "").encode().split() for t in texts], {}
    for words in lists:
        for i in range(len(words) - span + 1):
            window = tuple(words[i:i + span])
            seen[window] = seen.get(window, 0) + 1
    kept = []
    for words in lists:
        gone = set()
        for i in range(len(words) - span + 1):
            if seen[tuple(words[i:i + span])] > 1:
                gone.update(range(i, i + span))
        kept.append([w for i, w in enumerate(words) if i not in gone])
    return kept


@pytest.mark.parametrize("span,hot_runs", [(1, 4096), (5, 4096), (5, 3)])
def test_passages_of_words(spark, span, hot_runs):
    rng = random.Random(span + hot_runs)
    words = ["a", "b", "cé", "dd", "a" * 9, "日本", "x.", ",x"]
    gaps = [" ", "  ", "\n", "\t ", "\r\n"]
    passages = [[rng.choice(words) for _ in range(rng.randrange(3, 14))] for _ in range(6)]
    texts = []
    for _ in range(60):
        chosen = [w for _ in range(rng.randrange(4)) for w in (
            rng.choice(passages) if rng.random() < 0.5 else rng.choices(words, k=rng.randrange(9)))]
        texts.append(rng.choice(["", " "]) + "".join(w + rng.choice(gaps) for w in chosen))
    texts += [texts[0], None, "", "  ", "a " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    cut = sd.texts_without_repeats(docs, span=span, seed=min(8 * span, 17), hot_runs=hot_runs, unit="words")
    got = {r["doc_id"]: r["text"] for r in cut.collect()}
    for i, kept in enumerate(brute_words(texts, span)):
        assert (got[i] or "").encode().split() == kept, texts[i]
    assert got[61] is None


def test_codes_of_long_texts(monkeypatch):
    text = ("word é " * 100 + "longer" * 40 + "\n" * 30 + "end").encode()
    whole = sd.word_codes(text)
    assert len(whole) == 8 * len(text.split()) and len({whole[i:i + 8] for i in range(0, len(whole), 8)}) == 4
    monkeypatch.setattr(sd, "PART_BYTES", 50)
    assert sd.word_codes(text) == whole


def test_no_rows(spark):
    assert sd.repeats_removed(spark.createDataFrame([], DOCS)).count() == 0


def test_short_passages_of_many_words_are_counted(spark, tmp_path):
    rng = random.Random(9)
    fill = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    passage, long = " ".join(f"a{i % 7}{i}" for i in range(52)), "x" * 200
    assert len(passage) < 400
    texts = [fill(30) + " " + passage, passage.replace(" ", "\n ") + " " + fill(9), fill(80), " ".join(passage.split()[:49]),
             long + " " + long, long + " " + long, None, "", passage + " " + long + " " + long]
    rows = list(enumerate(texts)) + [(None, passage), (9, "twice " * 3), (9, "twice " * 3)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op4_suffix_dedup"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert {r["doc_id"]: (r["n_removed"], r["n_repeated_words"]) for r in got} == {
        None: (0, 52), 0: (0, 52), 1: (0, 52), 2: (0, 0), 3: (0, 0), 4: (401, 0), 5: (401, 0), 6: (0, 0), 7: (0, 0),
        8: (401, 52), 9: (0, 0)}
    assert len(got) == len(rows)


@pytest.mark.parametrize("span,hot_runs", [(1, 4096), (4, 4096), (4, 3), (9, 2)])
def test_words_are_counted_beside_bytes(spark, span, hot_runs):
    texts = corpus(span + hot_runs)
    texts = [t.replace("e", " ").replace("b", " ") for t in texts] + [texts[0]]
    kept, whole = brute_words(texts, span), [len(t.encode().split()) for t in texts]
    got = removed(spark, texts, span=24, seed=7, hot_runs=hot_runs, words=span)
    assert [got[i]["repeated_words"] for i in range(len(texts))] == [n - len(k) for n, k in zip(whole, kept)]
    assert [got[i]["kept"] for i in range(len(texts))] == [k for k, _ in brute_kept([t.encode() for t in texts], 24)]


def test_runs_at_codes_cover_all_windows(monkeypatch):
    codes = np.random.default_rng(6).integers(0, 3, 400).astype("<u8").tobytes()
    monkeypatch.setattr(sd, "PART_BYTES", 300)
    seen = {}
    for minimizer, first, last, at in sd.minimizer_runs(codes, 80, 20, 8):
        for m, f, z, a in zip(*(side.tolist() for side in (minimizer, first, last, at))):
            seen |= {x: (m, a - x) for x in range(f, z + 1, 8)}
    assert sorted(seen) == list(range(0, len(codes) - 79, 8))
    by_window = {}
    assert all(by_window.setdefault(codes[x:x + 80], key) == key for x, key in seen.items())


def test_what_is_staged_on_the_way_is_deleted(spark):
    before = set(list_folder(spark, scratch_root(spark)))
    removed(spark, ["one passage that is there twice", "one passage that is there twice"], span=24, seed=7, words=3)
    left = set(list_folder(spark, scratch_root(spark))) - before
    assert sorted(name.rpartition("-")[0] for name in left) == ["windows", "windows"]


def test_ranges_of_a_batch_that_was_cut():
    pair = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    rows = [[{"first": 0, "last": 5}], None, [{"first": 20, "last": 21}, {"first": 3, "last": 4}, {"first": 4, "last": 9}],
            [], [{"first": 1, "last": 7}, {"first": 1, "last": 8}], None]
    offsets, starts, ends = sd.covered(pa.array(rows, pair).slice(1, 4), 8)
    assert (offsets.tolist(), starts.tolist(), ends.tolist()) == ([0, 0, 2, 2, 3], [3, 20, 1], [17, 29, 16])
    offsets, starts, ends = sd.covered(pa.array(rows, pair).slice(1, 4), 2, 8)
    assert (offsets.tolist(), starts.tolist(), ends.tolist()) == ([0, 0, 1, 1, 2], [1, 1], [3, 3])
    assert sd.covered(pa.array([None, []], pair), 8)[0].tolist() == [0, 0, 0]
