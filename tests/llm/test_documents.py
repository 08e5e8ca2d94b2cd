"""Operators 1, 2, 3, 4, 6, 8 and 10 against brute force, libraries or held-out labels."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm import bpe_automaton, extendible_shards, line_templates, lsh_forest, pairwise_quality, perplexity_rules, template_decontamination
from llm.components import connected

from llm_cases import DOCS, WORDS, docs, docs_rows, line_leaves, no_docs, prose, words  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LOW = -(1 << 63)


# line templates


def expected_lines(rows, min_docs=2):
    def name(line):
        return None if not line.strip(" \t\r") else re.sub(line_templates.VARIABLE, "<*>", line)

    counted = [(LOW if r[0] is None else r[0], t) for r in rows if r[1] is not None for t in {name(line) for line in r[1].split("\n")} - {None}]
    leaf = line_leaves(t for _, t in counted)
    ids: dict[str, list[int]] = {}
    for i, t in counted:
        ids.setdefault(leaf[t], []).append(i)
    shared = {t: min(v) for t, v in ids.items() if min(v) != max(v) and len(v) >= min_docs}
    out = []
    for r in rows:
        if r[1] is None:
            out.append((r[0], 0, 0, None))
            continue
        lines = r[1].split("\n")
        stay = [x for x in lines if shared.get(leaf.get(name(x)), LOW if r[0] is None else r[0]) == (LOW if r[0] is None else r[0])]
        out.append((r[0], len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs", [2, 4])
def test_line_templates(docs, docs_rows, min_docs):
    got = line_templates.drop_recurring(docs, min_docs=min_docs).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got), key=str) == expected_lines(docs_rows, min_docs)
    assert {r.row.lang for r in got} <= {"en", "de", None}


def test_line_templates_generalise(spark):
    rows = [(1, "Posted on 2024-01-02 by a@b.c\nown text"), (2, "Posted on 2025-03-04 by x@y.z\nother text"), (3, "\n\nPosted on 1 by q@r.s")]
    got = {r.doc_id: r.text for r in line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "other text", 3: "\n"}


@pytest.mark.parametrize("broadcast", [0, line_templates.BROADCAST])
def test_line_templates_learn_word_fields(spark, monkeypatch, broadcast):
    monkeypatch.setattr(line_templates, "BROADCAST", broadcast)
    rng = random.Random(8)
    first, last = ["Alice", "Bob", "Carol", "Dan"], ["Smith", "Jones", "Brown"]
    heads = ["Posted in Sports by", "Filed under the tag", "We met them in town and saw"]
    rows = []
    for i in range(60):
        lines = [f"{rng.choice(heads)} {rng.choice(first)} {rng.choice(last)}" for _ in range(rng.randrange(4))]
        lines += [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 9))) for _ in range(3)] + ["We met them" + " x" * 3 + " y" * rng.randrange(3)]
        rows.append((i, "\n".join(lines)))
    got = line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str) == expected_lines(rows)
    two = [(1, "Posted in Sports by Alice Smith\nHe went to the store"), (2, "Posted in Sports by Bob Jones\nHe went to the bank"), (3, "Posted in Sports")]
    cut = {r.doc_id: r.text for r in line_templates.drop_recurring(spark.createDataFrame(two, "doc_id long, text string")).collect()}
    assert cut == {1: two[0][1], 2: "He went to the bank", 3: "Posted in Sports"}


def test_line_templates_of_a_very_long_text(spark):
    import time

    text = "\n".join(f"{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyzabcd'[k // 100 % 10]}{'efghijklmn'[k // 1000 % 10]}{'opqrstuvwx'[k // 10000]}" for k in range(40000))
    docs = spark.createDataFrame([(1, text), (2, text + "\nown"), (3, "alone")], "doc_id long, text string")
    start = time.perf_counter()
    got = {r.doc_id: (r.n_dropped, r.text) for r in line_templates.drop_recurring(docs).collect()}
    assert got == {1: (0, text), 2: (40000, "own"), 3: (0, "alone")}
    assert time.perf_counter() - start < 30


# bpe


def test_bpe_like_the_library(spark, docs, docs_rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    got = bpe_automaton.encode_decode(spark, docs, VOCABULARY).collect()
    want = []
    for r in docs_rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got), key=str) == sorted(want, key=str)


def test_bpe_hard_words():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    own = bpe_automaton.Tokenizer(open(VOCABULARY, encoding="utf-8").read())
    rng = random.Random(3)
    texts = ["".join(rng.choice("aabeilnorst' ") for _ in range(rng.randrange(1, 60))) for _ in range(800)]
    texts += ["a<|startoftext|>b <|endoftext|>", "<|endoftext|", "don't DON'T we'll ' s 'S", "İSTANBUL ΣΑΣ ǅ", "é ́a가", "a\x1cb\x85c\xa0d​e", "日本語 12345 ½ 😀👍🏽", "a" * 300]
    for text, ref in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = own.encode(text.encode())
        assert ids == ref.ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_automaton_is_the_merge_order():
    """All words over a small alphabet, against merging by rank."""
    letters = ["a", "b", "c"]
    merges = [("a", "a"), ("aa", "b"), ("b", "c"), ("aa", "aa"), ("c", "a</w>"), ("bc", "aa"), ("b", "b</w>"), ("aa", "a</w>")]
    names = [*letters, *(x + "</w>" for x in letters), *(a + b for a, b in merges)]
    vocabulary = {n: i for i, n in enumerate(dict.fromkeys(names))}
    own = bpe_automaton.Automaton(vocabulary, merges, "</w>")
    rank = {m: i for i, m in enumerate(merges)}

    def merge(word):
        parts = [*word[:-1], word[-1] + "</w>"]
        while True:
            best = min((rank.get(p, 99) for p in zip(parts, parts[1:])), default=99)
            if best == 99:
                return [vocabulary[p] for p in parts]
            k = 0
            while k + 1 < len(parts):
                if rank.get((parts[k], parts[k + 1])) == best:
                    parts[k : k + 2] = [parts[k] + parts[k + 1]]
                k += 1

    from itertools import product

    for n in range(1, 8):
        for word in product(letters, repeat=n):
            assert own.encode("".join(word)) == merge(word), word


# perplexity


def expected_base(text):
    w = words(text)
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    inside = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)


def test_base_rules(spark, docs, docs_rows):
    got = perplexity_rules.quality_rules(spark, docs).collect()
    measured = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str)
    assert measured == sorted(((r[0], *expected_base(r[1])) for r in docs_rows), key=str)
    assert not any(r.kept and r.base_failed for r in got)


def test_kneser_ney_sums_to_one(spark, tmp_path):
    rng = np.random.default_rng(1)
    buf = rng.choice(np.frombuffer(b"abcd ", np.uint8), 4000, p=[0.5, 0.2, 0.1, 0.1, 0.1])
    off = np.array([0, 1500, 4000])
    keys, n = perplexity_rules._distinct(perplexity_rules.grams(buf, off, 3))
    counts = spark.createDataFrame([("en", int(k), int(c)) for k, c in zip(keys, n, strict=True)], "lang string, gram long, n long")
    folder = perplexity_rules.write_model(spark, counts, 3, f"file://{tmp_path}/m")
    model = perplexity_rules.load_model(folder, counts.select(perplexity_rules.model_name(counts.lang)).first()[0], 3)
    assert len(model.grams[3]) == len(keys) and perplexity_rules.load_model(folder, "none", 3) is None
    for context in (b"ab", b"d ", b"zz", b"\0\0"):
        packed = np.uint64(int.from_bytes(context, "big")) << np.uint64(8) | np.arange(256, dtype=np.uint64)
        assert abs(np.exp(model._log(3, packed)).sum() - 1) < 1e-6


def test_perplexity_rejects_noise(spark):
    rng = random.Random(2)
    clean = [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat", "and", "dogs", "ran"]) for _ in range(120))) for i in range(60)]
    noise = [(100, " ".join("".join(rng.choice("QXZ#$%") for _ in range(6)) for _ in range(120)))]
    rows = spark.createDataFrame([(i, t, "en") for i, t in clean + noise], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in perplexity_rules.quality_rules(spark, rows).where("kept").collect()}
    assert 100 not in kept and len(kept) >= 55


def slow_kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney of byte strings by dictionaries; the log probability of a byte after a context."""
    counts = Counter(bytes(order - 1)[: max(0, order - 1 - k)] + t[max(0, k - order + 1) : k + 1] for t in texts for k in range(len(t)))
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    rules = {}
    for k, level in levels.items():
        n1, n2, n3, n4 = (max(1, sum(v == c for v in level.values())) for c in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        clip = lambda v, hi: min(max(v, 0.05), hi)
        rules[k] = [0, clip(1 - 2 * y * n2 / n1, 0.95), clip(2 - 3 * y * n3 / n2, 1.9), clip(3 - 4 * y * n4 / n3, 2.9)]

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / 256
        after = [v for g, v in levels[k].items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        off = [rules[k][min(v, 3)] for v in after]
        own = levels[k].get(gram, 0)
        return (own - (rules[k][min(own, 3)] if own else 0)) / sum(after) + sum(off) / sum(after) * p(gram[1:])

    return p


def test_perplexity_equals_a_slow_model_in_two_languages(spark):
    rng = random.Random(6)
    vocabulary = {"en": ["the", "cat", "sat", "mat", "dogs"], "fr": ["été", "le", "chat", "où", "très"], None: ["ja", "nein"]}
    rows = [(i, " ".join(rng.choice(vocabulary[lang]) + str(rng.randrange(90)) for _ in range(60)), lang) for i, lang in enumerate(["en", "fr", None] * 5)]
    rows += [(90, "zzz qqq " * 30, "en"), (91, "the cat", "fr"), (92, " ".join(f"x{k}" for k in range(60)), "de"), (93, None, "en")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    order = 3
    got = {r.doc_id: r for r in perplexity_rules.quality_rules(spark, table, order=order).collect()}
    assert len(got) == len(rows)
    for lang in ("en", "fr", "de", None):
        own = [(i, (t or "").encode()) for i, t, x in rows if x == lang]
        counted = [t for i, t in own if not got[i].base_failed]
        p = slow_kneser_ney(counted, order)
        known = {}
        score = {}
        for i, t in own:
            padded = bytes(order - 1) + t
            loss = [-math.log(known.setdefault(g, p(g)) if g not in known else known[g]) for g in (padded[k : k + order] for k in range(len(t)))]
            score[i] = math.exp(sum(loss) / max(1, len(t)))
            assert math.isclose(got[i].perplexity, score[i], rel_tol=1e-6), (i, lang)
        for i, _ in own:
            assert got[i].kept == (not got[i].base_failed and got[i].low <= score[i] <= got[i].high)


# near duplicates


def shingle_set(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def test_near_duplicates(spark, docs, docs_rows):
    sets = [shingle_set(r[1]) for r in docs_rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    smallest: dict[int, int | None] = {}
    for i, r in enumerate(docs_rows):
        k = find(i)
        smallest[k] = min((x for x in (smallest.get(k), r[0]) if x is not None), default=None)
    want = sorted(((r[0], len(s), smallest[find(i)], r[0] == smallest[find(i)]) for i, (r, s) in enumerate(zip(docs_rows, sets, strict=True))), key=str)
    for region, family in ((2000, 1500), (3, 4)):
        got = lsh_forest.near_duplicates(spark, docs, region=region, family=family).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == want


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 200), (5, 5)] + [(300 + rng.randrange(30), 300 + rng.randrange(30)) for _ in range(25)]
    root = {n: n for e in edges for n in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    got = {r.node: r.root for r in connected(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in linked}


# decontamination


def test_decontamination(spark):
    rng = random.Random(6)
    plain = [prose(rng, 60).replace("\n", " ") for _ in range(6)]
    item = "If a train leaves at 9 with 12 km per hour and Alice walks 30 minutes, where do the 12 km end for her"
    same = item.replace("9", "7").replace("12", "55").replace("30", "10").replace("Alice", "Robert")
    mixed = item.replace("12", "55", 1).replace("30", "10")  # one value stands for two
    benchmark = spark.createDataFrame([(1, item), (2, plain[0]), (3, "too short"), (4, None), (5, "")], "item_id long, text string")
    rows = [(10, plain[1] + " " + item + " " + plain[2]), (11, plain[3] + " " + same + "."), (12, plain[4]), (13, None), (14, ""), (15, plain[2] + " " + plain[0] + " " + plain[5]), (16, plain[0][: len(plain[0]) // 3]), (10, plain[1] + " " + item)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, item_id string, key string")
    got = {(r.doc_id, r.item_id): r for r in template_decontamination.contaminated(docs, benchmark).collect()}
    assert set(got) == {(10, 1), (11, 1), (15, 2)}
    assert got[11, 1].n_slots == got[11, 1].n_consistent > 0
    assert mixed != item
    none = docs.limit(0)
    assert template_decontamination.contaminated(none, benchmark).count() == 0
    assert template_decontamination.contaminated(docs, benchmark.limit(0)).count() == 0


def test_canonical(spark):
    text = "He paid 12.50 dollars. Then, Alice ran 3 km and 4% less; Bob's 2024-01-02 note"
    got = spark.createDataFrame([(text,)], "t string").select(template_decontamination.canonical(template_decontamination.F.col("t"))).first()[0]
    assert got == "he paid <num> <unit>. then, <name> ran <num> <unit> and <num><unit> less; <name>'s <num>-<num>-<num> note"


# sharding


def test_shards(spark, docs, docs_rows):
    sizes = [(r[0], len((r[1] or "").encode())) for r in docs_rows]
    got = extendible_shards.assign(docs, limit=6000).collect()
    assert sorted(((r.doc_id, r.n_bytes) for r in got), key=str) == sorted(sizes, key=str)
    total = Counter()
    for r in got:
        total[r.depth, r.shard] += r.n_bytes
    assert all(total[r.depth, r.shard] == r.shard_bytes and (r.over_limit or r.shard_bytes <= 6000) for r in got)
    shards = {(r.depth, r.shard) for r in got}
    for d, p in shards:  # no shard holds another, and none split without need
        assert not any(e > d and (q >> (e - d)) == p for e, q in shards)
        if d and not any(r.over_limit for r in got if (r.depth, r.shard) == (d, p)):
            parent = sum(n for (e, q), n in total.items() if e >= d - 1 and (q >> (e - d + 1)) == p >> 1)
            assert parent > 6000


def test_write_shards(spark, docs, tmp_path):
    out = f"file://{tmp_path}/shards"
    extendible_shards.write_shards(docs, out, limit=6000)
    back = spark.read.parquet(out)
    assert back.count() == docs.count()
    files = list((tmp_path / "shards").glob("shard_name=*/*.parquet"))
    assert len(files) == back.select("shard_name").distinct().count()


# quality


def test_pairwise_quality(spark):
    rng = random.Random(8)
    good = [prose(rng, 150) for _ in range(120)]
    bad = [" ".join(w + "$$$" for w in words(prose(rng, 80))) if k % 2 else (prose(rng, 3) + " ") * 40 for k in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    ranker = pairwise_quality.fit(docs, labels.where(~labels.doc_id.isin(list(held))))
    got = {r.doc_id: r.score for r in pairwise_quality.score(spark, docs, ranker).collect()}
    assert len(got) == 183 and all(0 <= s <= 1 for s in got.values())
    right = [(got[i] >= 0.7) == (i < 120) for i in held]
    assert sum(right) >= 0.95 * len(right)


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    ranker = pairwise_quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert all(abs(r.score - 0.7) < 1e-9 for r in pairwise_quality.score(spark, docs, ranker).collect())


def test_empty_tables(spark, no_docs):
    assert line_templates.drop_recurring(no_docs).count() == 0
    assert bpe_automaton.encode_decode(spark, no_docs, VOCABULARY).count() == 0
    assert perplexity_rules.quality_rules(spark, no_docs).count() == 0
    assert lsh_forest.near_duplicates(spark, no_docs).count() == 0
    assert extendible_shards.assign(no_docs).count() == 0
    assert DOCS.startswith("doc_id")


def test_pairs_of_two_parts_are_confirmed(spark):
    """Pairs of near copies under a common frame: one family, split into many parts."""
    rng = random.Random(12)
    frame = [f"frame{k}" for k in range(175)]
    texts = []
    for k in range(40):
        own = [f"own{k}x{rng.randrange(10**6)}" for _ in range(25)]
        texts += [" ".join(frame + own), " ".join([*frame, *own[:-1], "changed"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(spark, docs, family=4).collect()}
    assert got == {k: k // 2 * 2 for k in range(80)}


def test_no_partner_is_dropped_for_likelier_ones(spark):
    """Under a common frame, two sets of very near copies each, which only the first texts of the sets link."""
    rng = random.Random(21)
    frame = [f"frame{k}" for k in range(175)]

    def changed(text, places):
        return [f"new{rng.randrange(10**9)}" if i in places else w for i, w in enumerate(text)]

    texts = []
    for k in range(10):
        first = frame + [f"own{k}x{i}" for i in range(25)]
        places = rng.sample(range(1, 198, 4), 5 + 24)
        second = changed(first, places[:5])
        texts += [first, *[changed(first, [p]) for p in places[5:17]], second, *[changed(second, [p]) for p in places[17:]]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(spark, docs, region=20, family=40).collect()}
    assert got == {i: i // 26 * 26 for i in range(260)}


def test_slots_are_judged_per_occurrence(spark):
    """A verbatim item beside the same question with other numbers, and the question twice with others."""
    item = "a train leaves at 9 with 12 km per hour and walks for 30 minutes where do the 12 km end and why"
    other = [item.replace("9", a).replace("12", b).replace("30", c) for a, b, c in (("7", "55", "10"), ("8", "66", "20"))]
    put_in = [t.replace("where do", "where then do") for t in other]
    between = " so much for that one and now for something else entirely "
    docs = spark.createDataFrame([(1, item + between + other[0]), (2, between.join(other)), (3, between.join(put_in)), (None, other[0] + between + other[1])], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in template_decontamination.contaminated(docs, benchmark, similarity=0.6).collect()}
    assert {1, 2, 3, None} <= set(got)
    assert all(got[k].n_slots == got[k].n_consistent > 0 for k in (1, 2, None))
