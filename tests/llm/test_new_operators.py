"""Operators 11 to 13 against brute force, with the awkward cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from llm.filter_audit import WORDS, audit, positional
from llm.hard_negatives import Index, mine, threshold_join
from llm.pii_bootstrap import base_spans, candidates, find_personal_data, luhn
from llm.shared import ship
from llm_cases import DOCS, awkward, docs, docs_rows, no_docs, words  # noqa: F401

# ---- 11


def plain_base(text: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        total = sum((x * 2 - 9 if x > 4 else x * 2) if k % 2 else x for k, x in enumerate(map(int, reversed(d))))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_grammars():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice(["a", "7", "0", "12", "255", "256", ".", "@", "-", " ", "+1", "+", "(", ")", "é", "_", "%", "4736962573099581", "\n", "x@y.z"]) for _ in range(rng.randrange(40)))
        assert base_spans(text) == plain_base(text), text


def test_luhn():
    assert luhn("4539578763621486") and not luhn("4539578763621487")


def test_candidates_never_meet_a_base_span():
    text = "call 555 0123 456 or +1 (183) 555-1276, mail ann [at] corp dot org, ip 10.0.0 and 4736 9625 7309 9582"
    base = base_spans(text)
    found = [(text[lo:hi], kind) for lo, kind, hi in candidates(text, base)]
    assert ("555 0123 456", 3) in found and ("10.0.0", 1) in found and ("4736 9625 7309 9582", 2) in found
    assert any(kind == 0 and value.startswith("ann [at] corp") for value, kind in found)
    assert all(hi <= lo2 or lo >= hi2 for lo, _, hi in candidates(text, base) for lo2, _, hi2 in base)


def test_long_texts_take_linear_time():
    for unit in ("a", "1", "1.", "+1", "a@", "(at) ", "1 ", "f:"):
        text = unit * (400_000 // len(unit))
        candidates(text, base_spans(text))


@pytest.fixture(scope="module")
def personal(spark):
    ship(spark)
    rng = random.Random(11)
    rows = []
    for n in range(40):
        rows.append((n, f"please contact me at user{n}@mail{n}.example.com today about item {rng.randrange(99)}", "en"))
        rows.append((100 + n, f"the support line is +1 ({200 + n}) 555-{1000 + n} all day, see page {n}", "en"))
        rows.append((200 + n, f"in {1990 + n % 20} about {n} things were seen near 12 34 56 78 places", "en"))
    rows += [
        (300, "please contact me at ann [at] corp [dot] org today", "en"),
        (301, "our support line is 0171 555 4321 all day", "en"),
        (302, "population was 0171 555 4321 then", "en"),
        (302, "our support line is 0171 555 4321 all day", "de"),
        (None, "our support line is 0171 555 4321 all day", "de"),
        (None, None, None),
        (303, "", None),
        (300, "please contact me at ann [at] corp [dot] org today", "en"),
    ]
    return rows


def test_context_finds_what_the_grammars_miss(spark, personal):
    docs = spark.createDataFrame([(*r, "k", 1) for r in personal], "doc_id long, text string, lang string, spans string, n_email int").repartition(3)
    got = find_personal_data(spark, docs).collect()
    assert len(got) == len(personal)
    text_of = {}
    for i, t, _ in personal:
        text_of.setdefault(i, []).append(t)
    for r in got:
        fits = [t for t in text_of[r.doc_id] if hashlib.sha256(",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{lo}:{hi}" for lo, k, hi in plain_base(t or "")).encode()).hexdigest() == r.base_sha256]
        assert fits
        assert r.n_email == sum(s[1] == 0 for s in plain_base(fits[0] or ""))
        if r.n_added == 0:
            assert r.spans == ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{lo}:{hi}" for lo, k, hi in plain_base(fits[0] or ""))
    added = sorted((r.doc_id or -1, r.spans) for r in got if r.n_added)
    assert [a[0] for a in added] == [-1, 300, 300, 301, 302]
    assert added[1][1] == "email:21:44" and added[3][1] == "phone:20:33"


def test_personal_data_of_awkward_and_empty_tables(spark, docs, docs_rows, no_docs):
    got = find_personal_data(spark, docs).collect()
    assert sorted((r.doc_id or -1) for r in got) == sorted((r[0] or -1) for r in docs_rows)
    assert find_personal_data(spark, no_docs).count() == 0


# ---- 12


def plain_audit(rows, labels):
    failed = []
    for i, text, lang in rows:
        t, w = text or "", words(text)
        f = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
        }
        good = any(q == 1 for k, q, _ in labels if k == i and i is not None)
        bad = any(x == 1 for k, _, x in labels if k == i and i is not None)
        failed.append((lang or "", {k for k, v in f.items() if v}, good, bad))
    out = {}
    for part in {r[0] for r in failed}:
        own = [r for r in failed if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for k, x in enumerate(order):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                fails = sum(x in r[1] for r in own)
                out[part, "".join(order), k + 1] = [len(left), len(gone), fails - len(gone), sum(r[1] == {x} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for x in "ABCDE":
            total = sum(v[1] for (p, o, k), v in out.items() if p == part and o[k - 1] == x)
            for (p, o, k), v in out.items():
                if p == part and o[k - 1] == x:
                    v.append(total)
    return out


def check_audit(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, part string, good int").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit(spark, docs, known).collect()
    want = plain_audit(rows, labels)
    assert {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got} == want
    assert len(got) == len(want)


def test_audit_equals_brute_force(spark):
    ship(spark)
    rng = random.Random(8)
    rows = [(i, t, lang) for i, t, lang, *_ in awkward()]
    pool = ["plain words " * 120, "MANY CAPITALS here", "price $5 | a", "same same " * 150, None, "", " ".join(f"w{k}" for k in range(260))]
    rows += [(rng.choice([None, *range(200, 300)]), rng.choice(pool), rng.choice(["en", "de", "", None])) for _ in range(300)]
    rows += [(1000 + k, pool[6] + " $", "en") for k in range(200)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, *_ in rows for _ in range(rng.choice([0, 1, 2]))]
    check_audit(spark, rows, labels)


def test_audit_of_an_empty_table_and_without_labels(spark):
    check_audit(spark, [(1, "one", None)], [])
    assert audit(spark, spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_carry_save_counts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 7, 100, 1001):
        w = WORDS[rng.integers(0, 32, n)]
        weight = rng.integers(1, 1000, n)
        want = [int(weight[(w >> b) & 1 == 1].sum()) for b in range(32)]
        assert positional(w, weight).tolist() == want


# ---- 13


def plain_mine(rows):
    kept = []
    for i, vec, label in rows:
        if i is None or vec is None or label is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        kept.append((i, [math.floor(256 * x) for x in vec], (label + 1) % 10 if i % 7 == 0 else label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    anchors = {(i, tuple(v), lab) for i, v, lab in kept if i % 50 == 0}
    for i, vec, lab in anchors:
        scored = sorted(((-dot(vec, w), j, other == lab) for j, w, other in kept if j != i))
        for s, j, _ in [x for x in scored if x[2]][:5]:
            fits = [(n, t) for t, n, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(i, j, k + 1, n, -s, -t) for k, (n, t) in enumerate(fits)]
    return sorted(out)


def vectors(rng, n, dim, centres):
    base = rng.normal(size=(centres, dim))
    x = base[rng.integers(0, centres, n)] + rng.normal(size=(n, dim)) * 0.6
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(float)


def check_mine(spark, rows):
    table = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], "vec_id long, embedding array<float>, label int, anchor string, score int").repartition(3)
    got = sorted(tuple(r) for r in mine(spark, table).collect())
    assert got == plain_mine(rows)


def test_mining_equals_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(4)
    x = vectors(rng, 700, 13, 6)
    rows = [(k, v.tolist(), int(rng.integers(0, 4))) for k, v in enumerate(x)]
    rows += [(1000 + k, x[50].tolist(), int(k % 2)) for k in range(300)]  # a hot vector: ties everywhere
    rows += [(rows[3][0], rows[3][1], rows[3][2]), (None, x[1].tolist(), 1), (2000, None, 1), (2050, x[2].tolist(), None)]
    rows += [(2100, [0.1, None, 0.2], 1), (2150, [0.1, float("nan")], 1), (2200, [float("inf")], 0), (2250, [], 0), (2300, [0.5, 0.5], 1), (-50, x[9].tolist(), 2)]
    check_mine(spark, rows)


def test_mining_with_few_or_no_partners(spark):
    check_mine(spark, [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.6, 0.1], 1), (50, [-1.0, 0.0], 1)])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert mine(spark, empty).count() == 0


def test_threshold_join_keeps_every_pair_above_the_threshold():
    rng = np.random.default_rng(2)
    for sparse in (0.0, 0.8):
        x, a = (np.floor(256 * vectors(rng, n, 19, 5)) * (rng.random((n, 19)) >= sparse) for n in (400, 60))
        x[:50] = np.floor(x[:50] * 0.05)
        exact = a @ x.T
        wanted = rng.random(exact.shape) < 0.7
        for q in (0.0, 0.5, 0.9, 0.999):
            theta = np.quantile(exact, q, axis=1) if q else np.full(60, -np.inf)
            i, j, s = threshold_join(Index(x), Index(a), theta, wanted)
            want = np.nonzero((exact >= theta[:, None]) & wanted)
            assert sorted(zip(i, j, strict=True)) == sorted(zip(*want, strict=True))
            assert (s == exact[i, j]).all()
