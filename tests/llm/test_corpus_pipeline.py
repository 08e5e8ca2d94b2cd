"""The pipeline against a brute-force version, and each stage on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from llm import line_templates
from llm.shared import ship
from llm_cases import docs, docs_rows, line_leaves, words  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id_key string"
VOCABULARY = ["the", "cat", "sat", "on", "a", "mat", "and", "dogs", "ran", "over", "hills", "while", "birds", "sang", "under", "trees"]


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    ship(spark)
    rng = random.Random(11)
    item = "how many miles did the old grey goose walk before noon on the long winding road to town"
    clean = ["\n".join(sentence(rng, 15) for _ in range(10)) for _ in range(60)]
    boiler = "All rights reserved by the keeper of this site"
    texts = [t + "\n" + boiler if k < 30 else t for k, t in enumerate(clean)]
    for k in (3, 17, 41):  # near copies of whole documents
        w = texts[k].split(" ")
        w[20] = "changed"
        texts += [" ".join(w), texts[k]]
    texts.append(clean[50] + "\n" + item + " and " + sentence(rng, 5))  # a leak
    noise = [" ".join("".join(rng.choice("QXZ#$%") for _ in range(6)) for _ in range(120)) for _ in range(3)]
    texts += [*noise, "too short", "", None, ("again and again and " * 40).strip(), boiler]
    rows = [(10 * i + 5, t, "en", "s", None if t is None else len(t), "x") for i, t in enumerate(texts)]
    rows.append((None, clean[7].replace("cat", "hen"), "en", "s", 1, "x"))
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"file://{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"file://{folder}/benchmark.parquet")
    return rows, noise, item, f"file://{folder}"


def expected(rows, noise, item):
    def base_failed(t):
        w = words(t)
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        inside = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        return len(w) < 50 or 100 * len(inside) > 50 * len(w)

    left = {r[0]: r[1] for r in rows if not base_failed(r[1]) and r[1] not in noise}
    key = {i: -(1 << 63) if i is None else i for i in left}
    def masked(line):
        return re.sub(line_templates.VARIABLE, "<*>", line)

    leaf = line_leaves(masked(line) for t in left.values() for line in t.split("\n"))
    seen: dict[str, list] = {}
    for i, t in left.items():
        for line in set(t.split("\n")):
            seen.setdefault(leaf[masked(line)], []).append(key[i])
    shared = {t: min(v) for t, v in seen.items() if t.strip() and len(v) >= corpus_pipeline.BOILERPLATE_DOCS}
    cut = {}
    for i, t in left.items():
        lines = [x for x in t.split("\n") if shared.get(leaf[masked(x)], key[i]) == key[i]]
        if "\n".join(lines).strip():
            cut[i] = "\n".join(lines)
    sets = {i: {tuple(words(t.lower())[k : k + 3]) for k in range(len(words(t)) - 2)} for i, t in cut.items()}
    group = {i: i for i in cut}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    order = sorted(cut, key=lambda i: (i is None, i or 0))
    for n, i in enumerate(order):
        for j in order[:n]:
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                group[find(i)] = find(j)
    alone = {i: t for i, t in cut.items() if find(i) == i}
    return {i: t for i, t in alone.items() if item not in " ".join(words(t))}


def test_pipeline(spark, corpus):
    from tokenizers import Tokenizer

    rows, noise, item, folder = corpus
    want = expected(rows, noise, item)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(got) == set(want) and 50 < len(got) < len(rows) - 8
    for i, text in want.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert bytes(got[i].ids) == np.array(ids, "<u4").tobytes() and got[i].n_tokens == len(ids)
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_keep_the_columns(spark, corpus, docs):
    _, _, _, folder = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "bpe":
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0


def test_near_dedup_keeps_one_row_of_a_repeated_id(spark):
    rows = [(1, sentence(random.Random(1), 60)), (1, sentence(random.Random(1), 60)), (2, sentence(random.Random(1), 60)), (3, None), (4, "")]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4]


def test_rows_without_an_id_are_judged_one_by_one(spark, tmp_path):
    texts = [sentence(random.Random(k), 80) for k in range(5)]
    item = " ".join(f"w{k}" for k in "abcdefghijklmnopq")
    schema = "doc_id long, text string, lang string, _id_key string"
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[1] + " end"), (7, texts[2]), (7, texts[3]), (7, texts[3] + " end"), (None, "short"), (7, "short"), (None, texts[4] + " " + item), (7, texts[4] + " " + item)]
    docs = spark.createDataFrame([(*r, "en", "k") for r in rows], schema).repartition(4)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")

    def left(stage):
        out = stage(spark, docs, f"file://{tmp_path}")
        assert out.columns == docs.columns and {r._id_key for r in out.collect()} == {"k"}
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    assert left(corpus_pipeline.quality) == sorted((r for r in rows if r[1] != "short"), key=str)
    assert left(corpus_pipeline.decontaminate) == sorted((r for r in rows if item not in r[1]), key=str)
    got = left(corpus_pipeline.near_dedup)
    assert [len([r for r in got if r[1].startswith(t)]) for t in texts] == [1] * 5 and len(got) == 6
    assert (7, texts[4] + " " + item) in got and (7, "short") in got


def test_line_dedup_keeps_a_line_of_two_documents_once(spark):
    line = sentence(random.Random(3), 60)
    rows = [(1, line + "\nown a"), (2, "own b\n" + line), (3, line), (None, "own c\nfree"), (None, "own d\nfree"), (4, "free\nown e")]
    out = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert {(r.doc_id, r.text) for r in out if r.doc_id} == {(1, line + "\nown a"), (2, "own b"), (4, "own e")}
    texts = [r.text for r in out if r.doc_id is None]
    assert sorted(t.split("\n")[0] for t in texts) == ["own c", "own d"] and sum("free" in t for t in texts) == 1
