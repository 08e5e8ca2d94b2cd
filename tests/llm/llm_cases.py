"""Small documents with the awkward cases, and helpers for brute-force comparisons."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda", "théta", "zeta", "iota", "rho", "tau", "phi", "chi", "psi"]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, id string, grp string"


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_leaves(lines) -> dict[str, str]:
    """Leaf of each masked line in the template tree, by plain loops."""
    from llm import line_templates as T

    tree: dict[tuple, list[list[str]]] = {}
    for line in set(lines):
        tokens = line.split(" ")
        tree.setdefault((len(tokens), *tokens[: T.LEADING]), []).append(tokens)
    leaf = {}
    for (n, *_), members in tree.items():
        constant = {}
        for p in range(n):
            top, n_top = Counter(m[p] for m in members).most_common(1)[0]
            if 100 * n_top >= T.DOMINANT * len(members):
                constant[p] = top
        general = len(members) > 1 and n >= T.MIN_TOKENS and 100 * len(constant) >= T.CONSTANT * n
        pattern = " ".join(constant.get(p, "\0") for p in range(n))
        for m in members:
            follows = general and all(m[p] == t for p, t in constant.items())
            leaf[" ".join(m)] = pattern if follows else " ".join(m)
    return leaf


def prose(rng: random.Random, n: int, per_line: int = 12) -> str:
    out = [rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed"]) + str(rng.randrange(400)) * (rng.random() < 0.6) for _ in range(n)]
    return "\n".join(" ".join(out[k : k + per_line]) for k in range(0, n, per_line))


def awkward(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([5, 30, 80, 200])) for _ in range(12)]
    texts: list[str | None] = [*base, base[0], base[3], base[3], None, "", " \t\n ", "x", "one two", "ends with\r\nnewline\n", prose(rng, 3000)]
    for t in base[:8]:  # near copies: one word of many changed
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    texts += [base[5][: len(base[5]) // 2] + "\n" + base[6][len(base[6]) // 3 :], (base[7] + "\n") * 3]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, base[4]), (None, None)]
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", None]), None, "k", "i", "g") for i, t in rows]


@pytest.fixture(scope="session")
def docs_rows():
    return awkward()


@pytest.fixture(scope="session")
def docs(spark, docs_rows):
    from llm.shared import ship

    ship(spark)
    return spark.createDataFrame(docs_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    from llm.shared import ship

    ship(spark)
    return spark.createDataFrame([], DOCS)
