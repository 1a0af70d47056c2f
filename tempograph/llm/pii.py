"""Personal data by regular expressions and bootstrapped contextual extraction.

Seeds are the base entities; instances that may be discovered are tokens with digits. Lexical patterns are
the word before an entity, the word after it, and both together; patterns and instances form a graph. A
pattern is induced once ``SUPPORT`` known instances stand in it. Its trust is the mass of its instances'
scores over all distinct contexts of it: its instances, and the other tokens that stand in it. So copies of
texts don't count. An instance is known by the noisy-or of its trusted patterns (seeds are). Rounds of
both, as DataFrames, let instances that one round discovers induce the patterns of the next. Scores never
fall, so rounds go on to the fixed point: until no pattern becomes trusted and no score rises by ``STILL``.

Everything is DataFrame functions. Texts are not shuffled; what is stored and joined are the entities, and
the edges of the graph meet patterns and instances by salted keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, few, salted_to, stored, table, whole_text
from .spans import apart, digits, find, kept, let, named, quoted, reach, replaced, written

#: The base kinds. Possessive loops keep Java from recursing on long runs; at the end of an expression they match the same.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"[0-9]+(?:\.[0-9]+){3}"
#: Only chains of 13 to 19 digits, which start and end where the greedy chain does.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: Identifiers that may be discovered: one token of 6 characters or more with ``MIN_DIGITS`` digits or more.
TOKEN = r"(?<![A-Za-z0-9._+@/-])(?=[A-Za-z._+@/-]*+[0-9])[A-Za-z0-9][A-Za-z0-9._+@/-]{5,}+"
MIN_DIGITS, SUPPORT, CONFIDENT, SMOOTH, STILL = 5, 5, 0.7, 2.0, 1e-6
#: Stands before an entity in a tokenized text, and for the blanks in one.
MARK = "\u0001"


def _luhn(m: str) -> str:
    d = f"split(reverse(regexp_replace({m}, '[^0-9]', '')), '')"
    twice = "if(q % 2 = 0, int(c), if(int(c) > 4, 2 * int(c) - 9, 2 * int(c)))"
    return f"aggregate(transform(filter({d}, c -> c <> ''), (c, q) -> {twice}), 0, (acc, c) -> acc + c) % 10 = 0"


def base_spans() -> dict[str, str]:
    """Base spans of the column ``text``, as SQL."""
    number, part = "text rlike '[0-9]'", "regexp_replace(c, '^0+(?=.)', '')"
    return {
        "email": find("text", EMAIL, "contains(text, '@')"),
        "ip": kept(find("text", IP, number), f"forall(split(s.m, {quoted(chr(92) + '.')}), c -> length({part}) < 3 or (length({part}) = 3 and {part} <= '255'))"),
        "card": kept(find("text", CARD, number), _luhn("s.m")),
        "phone": kept(find("text", PHONE, "contains(text, '+')"), f"{digits('s.m')} between 9 and 15"),
    }


#: Tokens of the column ``text`` that may be discovered.
TOKENS = kept(find("text", TOKEN, "text rlike '[0-9]'"), f"{digits('s.m')} >= {MIN_DIGITS}")


def _entities(tokens: str, seeds: str) -> str:
    """Seeds and tokens in ascending order; of entities that overlap, the first."""
    entity = lambda of, seed: f"transform({of}, s -> named_struct('start', s.start, 'end', s.end, 'seed', {seed}, 'instance', concat('{MARK}', translate(lower(s.m), ' ', '{MARK}'))))"
    several = f"array_sort(concat({entity(seeds, 'true')}, {entity(apart(tokens, seeds), 'false')}))"
    first = let(reach("en"), "past", "filter(transform(en, (e, j) -> if(e.start >= get(past, j), e, null)), e -> e is not null)")
    return f"if(size({tokens}) + size({seeds}) > 0, {let(several, 'en', first)}, {entity(f'slice({seeds}, 1, 0)', 'true')})"


#: The words of the column ``text`` in lower case; an entity is one word, marked. Lower-cased last, since that can lengthen a text.
WORDS = "filter(split(lower(" + replaced(f"translate(text, '{MARK}', ' ')", "entities", "concat(' ', s.instance, ' ')") + r"), '\\s+'), w -> w <> '')"


def _patterns(left: str, right: str) -> str:
    """The patterns in which a word between two others stands; entities and missing words make null ones."""
    before, after = (f"if(not startswith({w}, '{MARK}'), concat('{sign} ', {w}), null)" for sign, w in (("<", left), (">", right)))
    return f"array({before}, {after}, concat({before}, ' ', {after}))"


def _found(docs: DataFrame) -> DataFrame:
    """Of each row: doc_id, a hash of its text, the base spans by kind, and entities in order, each with its patterns."""
    rows = docs.select("doc_id", whole_text(F.col("text")).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.select("*", *[F.expr(x).alias(k) for k, x in base_spans().items()], F.expr(TOKENS).alias("tokens")).withColumn("seeds", F.concat(*KINDS))
    rows = rows.withColumn("entities", F.expr(_entities("tokens", "seeds"))).withColumn("words", F.expr(f"if(size(entities) > 0, {WORDS}, null)"))
    marked = f"filter(transform(words, (w, i) -> if(startswith(w, '{MARK}'), {_patterns('if(i > 0, get(words, i - 1), null)', 'get(words, i + 1)')}, null)), x -> x is not null)"
    seen = let(marked, "hits", "transform(entities, (e, j) -> named_struct('start', e.start, 'end', e.end, 'seed', e.seed, 'instance', e.instance, 'patterns', get(hits, j)))")
    bare = [F.expr(f"transform({k}, s -> named_struct('start', s.start, 'end', s.end))").alias(k) for k in KINDS]
    return rows.select("doc_id", "h", *bare, F.expr(f"if(size(entities) > 0, {seen}, null)").alias("entities"))


def _contexts(docs: DataFrame, patterns: DataFrame, of: str = "true") -> DataFrame:
    """How many different words stand in each pattern, entities included, told apart by 64-bit hashes: pattern, contexts. ``of``: of which rows."""
    rows = docs.select(whole_text(F.col("text")).alias("text"))
    rows = rows.select("text", F.expr(TOKENS).alias("tokens"), F.expr(f"concat({', '.join(base_spans().values())})").alias("seeds"))
    rows = rows.select("text", F.expr(_entities("tokens", "seeds")).alias("entities")).select(F.expr(f"if({of}, {WORDS}, null)").alias("w"))  # a filter would be pushed down and find all twice
    near = "transform(w, (x, i) -> named_struct('word', xxhash64(x), 'left', if(i > 0, get(w, i - 1), null), 'right', get(w, i + 1)))"
    each = rows.select(F.expr(f"explode({near})").alias("x")).select("x.word", F.expr(f"explode({_patterns('x.left', 'x.right')})").alias("pattern")).where("pattern is not null")
    return each.join(few(patterns), "pattern", "left_semi").groupBy("pattern", "word").count().groupBy("pattern").agg(F.count(F.lit(1)).alias("contexts"))


def discover(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Spans of identifiers that trusted patterns discover: doc_id, h, extra (array of start, end); stored."""
    each = found.select("doc_id", "h", F.explode("entities").alias("e")).select("doc_id", "h", "e.*")
    all_edges = stored(each.select("instance", "seed", F.explode("patterns").alias("pattern")).where("pattern is not null").groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    # A pattern that could ever be induced and discover: of enough instances, some unknown.
    support = all_edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("seed")).alias("seeds"))
    able = stored(support.where((F.col("n") >= SUPPORT) & (F.col("n") > F.col("seeds"))), "pii-able")
    # Its contexts in texts with entities alone bound its trust from above; most patterns can't reach trust, so that few words are counted over all texts.
    least = _contexts(docs, able.select("pattern"), "size(entities) > 0")
    most = lambda known: F.col(known) / (F.coalesce("contexts", F.lit(0)) + SMOOTH) >= CONFIDENT
    able = stored(able.join(least, "pattern", "left").where(most("n")).select("pattern", ((F.col("seeds") >= SUPPORT) & most("seeds")).alias("begins")), "pii-patterns")
    nothing = each.select("doc_id", "h", F.array(F.struct("start", "end")).alias("extra")).limit(0)
    # In the first round only seeds are known: where they trust no pattern, no later round finds anything.
    if able.where("begins").isEmpty():
        drop(all_edges, able)
        return nothing
    edges = stored(salted_to(all_edges, _contexts(docs, able.select("pattern")), "pattern", F.col("instance")), "pii-graph")
    drop(all_edges, able)
    scores = stored(edges.groupBy("instance").agg(F.max("seed").alias("seed")).select("instance", F.col("seed").cast("double").alias("score"), "seed"), "pii-scores")
    trusted, known_patterns = None, 0
    while True:
        scored = salted_to(edges.drop("seed"), scores, "instance", F.col("pattern"))
        trust = scored.groupBy("pattern").agg((F.sum("score") / (F.max("contexts") + SMOOTH)).alias("trust"), F.count_if(F.col("score") >= CONFIDENT).alias("known"))
        before, trusted = trusted, stored(trust.where((F.col("trust") >= CONFIDENT) & (F.col("known") >= SUPPORT)).select("pattern", "trust"), "pii-trusted")
        told = salted_to(edges.select("pattern", "instance"), trusted, "pattern", F.col("instance")).groupBy("instance").agg(F.sum(F.ln(1 - F.least(F.lit(0.999), F.col("trust")))).alias("miss"))
        new_score = F.when(F.col("seed"), 1.0).otherwise(1 - F.exp(F.coalesce("miss", F.lit(0.0))))
        last, scores = scores, stored(scores.join(told, "instance", "left").select("instance", new_score.alias("score"), "seed", (new_score - F.col("score")).alias("rise")), "pii-scores")
        drop(last, *([before] if before else []))
        had, known_patterns = known_patterns, trusted.count()
        if known_patterns == had and scores.where(F.col("rise") >= STILL).isEmpty():
            break
    drop(edges)
    new = stored(scores.where(~F.col("seed") & (F.col("score") >= CONFIDENT)).select("instance"), "pii-new")
    drop(scores)
    if new.isEmpty():
        drop(new, trusted)
        return nothing
    # An instance is taken where it stands in a trusted pattern.
    places = each.where("not seed").select("doc_id", "h", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    places = places.join(few(trusted), "pattern", "left_semi").join(few(new), "instance", "left_semi")
    extra = stored(places.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("extra")), "pii-extra")
    drop(new, trusted)
    return extra


def _with_extra(rows: DataFrame, extra: DataFrame, h: str = "h", name: str = "extra") -> DataFrame:
    """``rows`` with the discovered spans of each row's id and text hash, as column ``name``."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    if extra.isEmpty():
        return rows.withColumn(name, none)
    extra = few(extra.select(F.col("doc_id").alias("_pii_d"), F.col("h").alias("_pii_k"), F.col("extra").alias("_pii_x")))
    rows = rows.join(extra, F.col("doc_id").eqNullSafe(F.col("_pii_d")) & (F.col(h) == F.col("_pii_k")), "left")
    return rows.withColumn(name, F.coalesce("_pii_x", none)).drop("_pii_d", "_pii_k", "_pii_x")


def scan_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans; one row for each input row.

    Spans in code points, end exclusive, ordered by kind (email, ip, card, phone, other), then start. A null
    or empty text has none: counts 0, the digest of the empty string, spans empty. Repeated rows repeat, null
    ids stay null; other columns are ignored.
    """
    found = stored(_found(docs), "pii")
    rows = _with_extra(found, discover(docs, found))
    base = f"concat({', '.join(named(k, i, k) for i, k in enumerate(KINDS))})"
    return rows.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.expr(written(base)), 256).alias("base_sha256"),
        F.expr(written(f"concat({base}, {named('other', 4, 'extra')})")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets, and n_chars to match.

    Of spans that overlap the first is replaced, and what the others cover goes with it. Texts without any span
    stay as they are, null ones null. Repeated rows repeat.
    """
    found = stored(_found(docs), "pii")
    extra = discover(docs, found)
    drop(found)
    text = whole_text(F.col("text"))
    # Texts and spans under names of our own, whatever columns the documents have.
    rows = docs.select(F.struct("*").alias("row"), text.alias("text"), F.col("doc_id")).withColumn("h", F.xxhash64("text"))
    rows = _with_extra(rows.select("*", *[F.expr(x).alias(k) for k, x in base_spans().items()]), extra)
    rows = rows.withColumn("spans", F.expr(f"array_sort(concat({', '.join(named(k, i, k) for i, k in enumerate(KINDS))}, {named('other', 4, 'extra')}))"))
    rows = rows.select("row", (F.size("spans") > 0).alias("found"), F.expr(replaced("text", "spans", "concat('[', upper(s.kind), ']')")).alias("clean"))
    own = {"text": F.when(F.col("found"), F.col("clean")).otherwise(F.col("row.text")), "n_chars": F.when(F.col("found"), F.length("clean").cast("long")).otherwise(F.col("row.n_chars") if "n_chars" in docs.columns else None)}
    return rows.select(*[(own[c] if c in own else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op8_pii(spark, sf_dir):
    return scan_pii(table(spark, sf_dir, "documents"))
