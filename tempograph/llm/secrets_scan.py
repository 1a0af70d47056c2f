"""Secret scan with a battery of randomness tests.

Base kinds are regular expressions. Other candidates are runs of 20 or more letters, digits and +/_=-
that overlap no base span. For each an encoding is inferred (digits, hex, base32, letters of one case,
one case with digits, base64), its characters are decoded to values, and three tests of randomness ask
whether these are uniform over the alphabet (chi-squared), how often they cross the alphabet's middle
(runs), and whether neighbours are alike (serial correlation). Fisher's method combines the three
p-values into one statistic, small for random values.

What ordinary tokens look like is fitted to the corpus: in each encoding and length class the statistic's
logarithm is a mixture of random values, whose distribution is known, and of ordinary tokens, a normal
distribution that expectation and maximisation fit beside ``PRIOR`` assumed tokens. The probability of an
ordinary token to look as random as the one at hand goes to a false-discovery control for each encoding
and length class. All it needs are counts by (encoding, length class, bin of the statistic), a bounded
number of rows. Short tokens of few kinds of characters can't be told apart, and so none is accepted.

All of it is column expressions; texts are never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, whole_text
from .spans import apart, find, kept, let, named, quoted, written

#: The base kinds.
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS, HEX = "AKIA[A-Z0-9]+", "[0-9a-f]+"
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
#: Rate of false discoveries; bins of the statistic's logarithm in a unit, and their number.
RATE, FINE, BINS = 0.01, 10, 90
#: Mean and spread of the logarithm of a chi-squared variable with 6 degrees of freedom: the statistic of random values.
RANDOM = (1.616, 0.628)
#: Assumed ordinary tokens of a stratum: their number, the spread of the statistic's logarithm, and the sum of squared frequencies of
#: characters, by which the mean follows: 0.065 of letters in one case, 0.05 in both, 1.6 / size for digits and hexadecimal.
PRIOR, SPREAD, ONE_CASE, BOTH, FEW = 20, 0.5, 0.065, 0.05, 1.6
STEPS = 60
#: Lower ends of the length classes.
LENGTHS = (20, 32, 48, 64)
#: Encodings, in the order in which they are tried: expression, alphabet.
ENCODINGS = [
    ("^[0-9]+$", "0123456789"),
    ("^[0-9a-f]+$", "0123456789abcdef"),
    ("^[0-9A-F]+$", "0123456789ABCDEF"),
    ("^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    ("^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("^[A-Z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
]


def _surprise(z: str) -> str:
    """-ln of the probability that a normal variable exceeds z, by 0.5 exp(-0.717 z - 0.416 z^2) for z >= 0."""
    tail = f"0.717D * abs(z) + 0.416D * z * z + {math.log(2)}D"
    return let(f"greatest(-30D, least(30D, {z}))", "z", f"if(z >= 0, {tail}, -ln(1 - exp(-({tail}))))")


def _either_way(z: str) -> str:
    return f"({_surprise(f'abs({z})')} - {math.log(2)}D)"


def _plain(m: str) -> str:
    """Without padding, and with the letters of base64 for those of its other form."""
    return f"translate(regexp_replace({m}, '=+$', ''), '-_=', '+//')"


def encoding(plain: str) -> str:
    return "case " + " ".join(f"when {plain} rlike '{e}' then {k}" for k, (e, _) in enumerate(ENCODINGS)) + " end"


def statistic(m: str) -> str:
    """Fisher's combination of the battery, as SQL: small if the decoded values look random."""
    chars = "filter(split(plain, ''), c -> c <> '')"
    squares = "aggregate(array_distinct(chars), 0D, (acc, c) -> acc + pow(n - length(replace(plain, c, '')), 2))"
    uniform = let(f"greatest(1e-6, (k / n * {squares} - n) / (k - 1))", "ratio", _surprise("(cbrt(ratio) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1)))"))
    zero = "named_struct('last', cast(null as double), 'crossings', 0D, 'products', 0D)"
    crossings = "acc.crossings + if((acc.last > 0) != (here > 0), 1D, 0D)"
    step = let("v - (k - 1) / 2", "here", f"named_struct('last', here, 'crossings', coalesce({crossings}, acc.crossings), 'products', acc.products + coalesce(acc.last * here, 0D))")
    walk = f"aggregate(transform(chars, c -> cast(position(c, alphabet) - 1 as double)), {zero}, (acc, v) -> {step})"
    runs = _either_way("(walk.crossings - (n - 1) / 2) / sqrt((n - 1) / 4)")
    serial = _either_way("walk.products / (sqrt(n - 1) * (k * k - 1) / 12)")
    out = let(walk, "walk", f"2 * ({uniform} + {runs} + {serial})")
    out = let(chars, "chars", let("cast(length(alphabet) as double)", "k", let("cast(length(plain) as double)", "n", f"if(n > 1, {out}, 1e6)")))
    alphabets = ", ".join(quoted(x) for _, x in ENCODINGS)
    return let(_plain(m), "plain", let(f"get(array({alphabets}), {encoding('plain')})", "alphabet", out))


def _bin(m: str) -> str:
    return f"cast(least({BINS}, greatest(0, floor({FINE} * ln(greatest(1D, {statistic(m)}))))) as int)"


def _class(m: str) -> str:
    """The stratum of a token: its encoding and length class."""
    return f"({let(_plain(m), 'plain', encoding('plain'))} * {len(LENGTHS)} + " + " + ".join(f"if(length({m}) >= {n}, 1, 0)" for n in LENGTHS[1:]) + ")"


def assumed_mean(c: int) -> float:
    """The logarithm of the statistic of an ordinary token at the lower end of a stratum's lengths, by its expected chi-squared."""
    code, length = divmod(c, len(LENGTHS))
    k, n = len(ENCODINGS[code][1]), LENGTHS[length]
    excess = k * (BOTH if k == 64 else ONE_CASE if k >= 26 else FEW / k) - 1
    z = n * excess / math.sqrt(2 * (k - 1))
    return math.log(2 * (0.717 * z + 0.416 * z * z + math.log(2)) + 4)


def stratum_cutoff(counts: dict[int, int], c: int, rate: float = RATE) -> int:
    """The highest accepted bin of a stratum's counts, -1 if none: Benjamini and Hochberg with the fitted ordinary tokens."""
    middle = {b: (b + 0.5) / FINE for b in counts}
    density = lambda x, m, s: math.exp(-(((x - m) / s) ** 2) / 2) / s
    total, prior = sum(counts.values()), assumed_mean(c)
    share, mean, spread = 0.5, prior, SPREAD
    for _ in range(STEPS):
        # How many of each bin are ordinary.
        own = {b: n / (1 + share * density(middle[b], *RANDOM) / max(1e-300, (1 - share) * density(middle[b], mean, spread))) for b, n in counts.items()}
        weight = PRIOR + sum(own.values())
        share = min(0.99, max(0.01, 1 - weight / (PRIOR + total)))
        mean = (PRIOR * prior + sum(n * middle[b] for b, n in own.items())) / weight
        spread = math.sqrt((PRIOR * (SPREAD**2 + (prior - mean) ** 2) + sum(n * (middle[b] - mean) ** 2 for b, n in own.items())) / weight)
    under, best = 0, -1
    for b in sorted(counts):
        under += counts[b]
        if 0.5 * math.erfc((mean - (b + 1) / FINE) / spread / math.sqrt(2)) <= rate * under / total:
            best = b
    return best


def _base() -> dict[str, str]:
    """Base spans of the column ``text``."""
    return {
        "assign": kept(find("text", ASSIGN), f"length(regexp_extract(s.m, {quoted(VALUE)}, 1)) >= 6"),
        "access": kept(find("text", ACCESS, "contains(text, 'AKIA')"), "length(s.m) >= 20"),
        "hex": find("text", HEX.replace("+", "{24,}")),
    }


def _bases() -> list[Column]:
    return [F.expr(x).alias(k) for k, x in _base().items()]


def cutoffs(docs: DataFrame, text_col: str = "text", rate: float = RATE) -> dict[int, int]:
    """The highest accepted bin of each stratum of candidates over the whole corpus."""
    rows = docs.select(whole_text(F.col(text_col)).alias("text")).select("text", F.expr(find("text", TOKEN)).alias("tokens")).where("size(tokens) > 0")
    tokens = rows.select("tokens", *_bases()).select(F.explode(F.expr(apart("tokens", "concat(assign, access, hex)"))["m"]).alias("m"))
    counts: dict[int, dict[int, int]] = {}
    for r in tokens.groupBy(F.expr(_class("m")).alias("c"), F.expr(_bin("m")).alias("b")).count().collect():
        counts.setdefault(r["c"], {})[r["b"]] = r["count"]
    return {c: stratum_cutoff(x, c, rate) for c, x in counts.items()}


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; one row for each input row.

    Spans are whole matches in code points, end exclusive, ordered by start, then assign, access, hex,
    random. Random spans are those that overlap no base span. A null or empty text has none: counts 0,
    the digest of the empty string, spans empty. Repeated rows repeat and count as often for the control;
    null ids stay null; other columns are ignored.
    """
    highest = cutoffs(docs, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(F.col(text_col)).alias("text"))
    rows = rows.select("doc_id", *_bases(), F.expr(find("text", TOKEN)).alias("tokens"))
    limits = f"array({', '.join(str(highest.get(c, -1)) for c in range(len(ENCODINGS) * len(LENGTHS)))})"
    rows = rows.withColumn("base", F.expr(f"array_sort(concat({named('assign', 0, 'assign')}, {named('access', 1, 'access')}, {named('hex', 2, 'hex')}))"))
    rows = rows.withColumn("free", F.when(F.size("tokens") > 0, F.expr(apart("tokens", "base"))))
    rows = rows.withColumn("found", F.when(F.size("free") > 0, F.expr(kept("free", f"get({limits}, {_class('s.m')}) >= {_bin('s.m')}"))))
    everything = f"if(size(found) > 0, array_sort(concat(base, {named('random', 3, 'found')})), base)"
    return rows.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(F.expr(written("base")), 256).alias("base_sha256"),
        F.expr(written(everything)).alias("spans"),
    )


def op5_secret_scan(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))
