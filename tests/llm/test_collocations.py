"""Collocations against brute force; bitmaps stop no frequent phrase."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tempograph.llm import collocations
from tests.llm.test_operators import SCHEMA, SF, TEXTS, low

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, most=3, least=10, cover=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = r["lang"] or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(r["text"])):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates, longer = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}, {}
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer.get(p[i : i + k], 0), a)
        best = []
        for p, a in candidates.items():
            if 100 * longer.get(p, 0) >= cover * a:
                continue
            score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, n[lang], -s) for k, (s, a, p, left, right) in enumerate(sorted(best)[:top])]
    return sorted(out)


def run(docs, **more):
    return sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(docs, **more).collect())


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_against_brute_force(spark, real):
    got = sorted(tuple(r[c] for c in COLUMNS) for r in collocations.op13_collocations(spark, SF).collect())
    assert got == brute(real.collect()) and len(got) > 20


@pytest.mark.parametrize("most", [2, 4])
def test_other_lengths_and_small_bitmaps(real, most):
    """Bitmaps with many collisions prune less, and change nothing."""
    assert run(real, most=most, least=4, cover=80, top=50, bits=16) == brute(real.collect(), most, 4, 80, 50)


def test_awkward_rows(spark):
    rows = [(k, t, "en", "s", 1, "clash", 3, "no") for k, t in enumerate(TEXTS)] + [(1, "a a a a a\tB b;b a\u0085c \x1cd  e", lang, None, None, None, None, None) for lang in ["und", None, "fr"] for _ in range(12)]
    rows += [(None, "é日 É日 ü ü 🎉 🎉" * 5, "zh", "s", 1, None, None, None)] * 3 + [(2, "x y. " * 40 + "x y z\n" * 40, "en", "s", 1, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert run(docs) == brute(docs.collect())
    assert run(docs.where("false")) == run(docs.where("text IS NULL")) == []


def test_blocks_count_each_phrase_once(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 64)
    monkeypatch.setattr(collocations, "pieces", lambda raw: [p for p in re.split(rb"(?= )", raw) if p])
    docs = spark.createDataFrame([(1, "a b c a b c d, e f g " * 60, "en"), (2, "b c " * 100, "en")], "doc_id long, text string, lang string")
    assert run(docs.coalesce(1)) == brute(docs.collect())


def test_scores_are_exact_beyond_64_bits(spark):
    """The score's expression, on counts that no test table reaches."""
    a, left, right = 3_000_000_007, 4_000_000_009, 5_000_000_021
    expr = "(1000000BD * CAST(a AS DECIMAL(16, 0)) * CAST(a AS DECIMAL(16, 0))) div (CAST(l AS DECIMAL(16, 0)) * CAST(r AS DECIMAL(16, 0)))"
    assert expr == collocations.SCORE
    assert spark.sql(f"SELECT {expr} AS s FROM VALUES ({a}L, {left}L, {right}L) t(a, l, r)").first()["s"] == 10**6 * a * a // (left * right)


def test_distinct_grams_of_large_vocabularies():
    rng = np.random.default_rng(3)
    grams = rng.integers(0, 1 << 22, (500, 4)).repeat(3, axis=0)
    got, n = collocations._counted(grams, 1 << 22)
    assert Counter(map(tuple, grams.tolist())) == dict(zip(map(tuple, got.tolist()), n.tolist(), strict=True))
