"""The randomness battery against a slow version, and on planted tokens."""

import base64
import math
import random

from pyspark.sql import functions as F

from tempograph.llm import secrets_scan as scan

PARTS = "process handler config option value stream reader factory internal default index table lookup service manager".split()


def slow(m):
    plain = m.rstrip("=").translate(str.maketrans("-_=", "+//"))
    alphabet = next(a for e, a in scan.ENCODINGS if not e or set(plain) <= set(a))
    k, n, v = len(alphabet), len(plain), [alphabet.index(c) - (len(alphabet) - 1) / 2 for c in plain]
    surprise = lambda z: (lambda tail: tail if z >= 0 else -math.log(1 - math.exp(-tail)))(0.717 * abs(z) + 0.416 * z * z + math.log(2))
    either = lambda z: surprise(abs(max(-30, min(30, z)))) - math.log(2)
    chi = k / n * sum(plain.count(c) ** 2 for c in set(plain)) - n
    z = ((max(1e-6, chi / (k - 1))) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    runs = sum((a > 0) != (b > 0) for a, b in zip(v, v[1:]))
    serial = sum(a * b for a, b in zip(v, v[1:])) / (math.sqrt(n - 1) * (k * k - 1) / 12)
    return 2 * (surprise(max(-30, min(30, z))) + either((runs - (n - 1) / 2) / math.sqrt((n - 1) / 4)) + either(serial))


def test_battery_and_planted_tokens(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        parts = [rng.choice(PARTS) for _ in range(rng.randrange(3, 7))]
        rows.append((i, "_".join(parts) if i % 2 else "".join(map(str.title, parts))))
    rows += [(i, base64.b64encode(rng.randbytes(36)).decode()) for i in range(400, 430)]
    rows += [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(64))) for i in range(430, 450)]
    frame = spark.createDataFrame([(i, f"key {t} end") for i, t in rows], "doc_id long, text string")
    known = {i: t for i, t in rows if len(t) >= 20}
    got = spark.createDataFrame(list(known.items()), "i long, t string").select("i", F.expr(scan.statistic("t")).alias("x")).collect()
    assert all(math.isclose(r["x"], slow(known[r["i"]]), rel_tol=1e-9) for r in got)
    found = {r["doc_id"]: r["spans"] for r in scan.scan_secrets(frame).where("spans like '%random%'").collect()}
    assert not [i for i in found if i < 400] and sum(i < 430 for i in found) >= 24 and sum(i >= 430 for i in found) >= 14
    assert all(s == f"random:4:{4 + len(known[i])}" for i, s in found.items())
    assert scan.stratum_cutoff({10: 1}, 12) == -1
