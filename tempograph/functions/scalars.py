"""Scalar functions on times, subtitle text, media fields and ids, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ordered location rules, the words that say nothing about a place, and the vocabulary of water.
LOCATION_RULES = [
    (("black screen", "digital space", "title"), "opening sequence / title graphics"),
    (("nightclub", "club"), "nightclub celebration"),
    (("water", "boat", "lake"), "open water / stormy lake"),
    (("room", "interior", "cabin", "shelter"), "interior shelter / study"),
    (("forest", "wood", "mud", "tree"), "dark forest / lakeshore"),
    (("outdoor",), "outdoor setting"),
]
PLAIN_WORDS = ["a", "the", "in", "on", "at", "during", "setting", "dark", "outdoor", "interior", "unspecified"]
WATER_WORDS = ["water", "boat", "rain", "storm", "pavement", "crawfish", "mud", "lakeshore"]


def rounded(x: Column, digits: int) -> Column:
    """Half away from zero, decided by the product x * 10^digits in doubles, as SQL engines and C round; ``F.round`` decides by the shortest decimal text."""
    return F.round(x * 10.0**digits) / 10.0**digits


def one_decimal(x: Column) -> Column:
    """The double to print as ``%.1f`` for the exact value of x, ties to even, as C and Python print it; ``format_string`` decides by the shortest decimal text.

    20 |x| is compared with the odd number between two tenths as (16 |x| - odd) + 4 |x|, whose sign is exact.
    """
    size = F.abs(x)
    tenths = F.floor(size * 10)
    odd = (2 * tenths + 1).cast("double")
    side = (16 * size - odd) + 4 * size
    near = (tenths + F.when(side > 0, 1).when(side < 0, 0).otherwise(tenths % 2)) / 10.0
    return F.when(size < 1e14, F.when(x < 0, -near).otherwise(near)).otherwise(x)


def _clock(ms: Column, mark: str) -> Column:
    ms = ms.cast("long")
    part = lambda a, b: (F.floor(ms / a) % b).cast("int")
    return F.when(ms.isNotNull(), F.format_string(f"%02d:%02d:%02d{mark}%03d", F.floor(ms / 3_600_000).cast("int"), part(60_000, 60), part(1000, 60), (ms % 1000).cast("int")))


def format_timestamp(seconds: Column) -> Column:
    """HH:MM:SS.mmm; negative counts as 0; hours aren't wrapped; null stays null."""
    return _clock(F.when(seconds.isNotNull(), F.greatest(F.lit(0.0), F.round(seconds * 1000))), ".")


def format_srt_time(seconds: Column) -> Column:
    return _clock(F.round(seconds * 1000), ",")


def parse_timestamp(text: Column) -> Column:
    """Seconds from H:M:S, M:S or S with comma or dot, 3 decimals; what can't be read is 0."""
    parts = F.split(F.get(F.split(strip(F.replace(text, F.lit(","), F.lit("."))), rf"{BLANK}+"), F.lit(0)), ":")
    n = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    value = F.when(F.size(parts) == 3, n(0) * 3600 + n(1) * 60 + n(2)).when(F.size(parts) == 2, n(0) * 60 + n(1)).when(F.size(parts) == 1, n(0))
    return F.round(F.coalesce(value, F.lit(0.0)), 3)


#: White space of all scripts, and what isn't; cue settings in a text.
BLANK, SOLID = r"[\s\x1C-\x1F\x85\p{Z}]", r"[^\s\x1C-\x1F\x85\p{Z}]"
SETTINGS = rf"align:[\p{{L}}\p{{N}}_]+|(?:position|size|line):{SOLID}+"


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def clean_text(text: Column) -> Column:
    """Subtitle text without breaks, overrides, tags and cue settings, white space collapsed."""
    for pattern, to in ((r"\\[Nn]", " "), (r"\{[^}]*\}", ""), (r"<[^>]+>", ""), (SETTINGS, ""), (f"{BLANK}+", " ")):
        text = F.regexp_replace(text, pattern, to)
    return F.trim(text)


def vtt_speaker(text: Column) -> Column:
    return F.nullif(strip(F.regexp_extract(text, rf"<v(?:\.[\p{{L}}\p{{N}}_-]+)?{BLANK}+([^>]+)>", 1)), F.lit(""))


def sanitize_id(name: Column, default: str = "unnamed_movie") -> Column:
    """File stem in lower case; other than word characters and hyphens become one underscore."""
    stem = F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"(.)\.[^.]*$", "$1")
    clean = F.regexp_replace(F.regexp_replace(stem, r"(?U)[^\w-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(F.lower(clean), F.lit("")), F.lit(default))


def file_size(size: Column) -> Column:
    x = size.cast("double")
    ladder = F.when(x < 0, F.lit("0 B")).when(x < 1024, F.concat(size.cast("string"), F.lit(" B")))
    for k, unit in enumerate(("KB", "MB", "GB", "TB", "PB"), 1):
        text = F.format_string(f"%.2f {unit}", F.bround(x / 1024.0**k, 2))
        ladder = ladder.when(x < 1024.0 ** (k + 1), text) if unit != "PB" else ladder.otherwise(text)
    return ladder


def parse_fps(rate: Column) -> Column:
    part = lambda i: F.get(F.split(rate, "/"), F.lit(i)).try_cast("double")
    value = F.when(F.contains(rate, F.lit("/")), F.try_divide(part(0), part(1))).otherwise(rate.try_cast("double"))
    return F.round(F.coalesce(value, F.lit(0.0)), 3)


def filename_language(name: Column) -> Column:
    return F.lower(F.coalesce(F.nullif(F.regexp_extract(name, r"\.([A-Za-z]{2,3})\.[^.]+$", 1), F.lit("")), F.lit("und")))


def safe_cast(x: Column, kind: str, default) -> Column:
    return F.coalesce(x.try_cast(kind), F.lit(default).cast(kind))


def normalize_location(place: Column) -> Column:
    low = F.lower(F.trim(place))
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    rule = reduce(lambda acc, r: acc.when(has(r[0]), r[1]), LOCATION_RULES, F.when(F.coalesce(low, F.lit("")) == "", "unspecified setting"))
    return rule.otherwise(F.trim(place))


def compatible_locations(a: Column, b: Column) -> Column:
    """Equal when normalised, or with an informative word in common, or both about water."""
    words = lambda x: F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0))
    plain, water = F.array(*map(F.lit, PLAIN_WORDS)), F.array(*map(F.lit, WATER_WORDS))
    return (normalize_location(a) == normalize_location(b)) | F.arrays_overlap(F.array_except(words(a), plain), F.array_except(words(b), plain)) | (F.arrays_overlap(words(a), water) & F.arrays_overlap(words(b), water))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"(?U)(\b\w+\b)"), F.lit(1)))


def speech_seconds(words: Column, per_minute: float = 150.0) -> Column:
    return rounded(words / max(per_minute, 1.0) * 60.0, 1)


def gender(label: Column, legacy: bool = False) -> Column:
    """``legacy`` tests the male words first, under which no label is female."""
    low = F.lower(label)
    male, female = F.contains(low, F.lit("man")) | F.contains(low, F.lit("male")), F.contains(low, F.lit("woman")) | F.contains(low, F.lit("female"))
    first, second = ((male, "male"), (female, "female")) if legacy else ((female, "female"), (male, "male"))
    return F.when(*first).when(*second).otherwise("unknown")


def padded_id(prefix: str, n: Column) -> Column:
    return F.format_string(f"{prefix}_%03d", n.cast("int"))


def resolution(text: Column) -> Column:
    parts = F.split(F.lower(text), "x")
    w, h = F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")
    good = (F.size(parts) == 2) & w.isNotNull() & h.isNotNull()
    return F.struct(F.when(good, w).otherwise(1280).alias("width"), F.when(good, h).otherwise(720).alias("height"))


#: Patterns of names, and words that are none.
NAME_PATTERNS = [
    r"\b(?:Hey|Hi|Hello|Look|Listen|Wait|Please|Thanks),?\s+((?:[A-Z][a-z]{2,15}\s*){1,2})\b",
    r"(?i)\b([A-Z][a-z]{2,15}),\s+(?:look|wait|listen|come here|be careful|are you|what|where|why|help)\b",
    r"(?i)\b(?:my name is|i am|i'm|call me)\s+((?:[A-Z][a-z]{2,15}\s*){1,2})\b",
    r"(?i)\b(?:this is|meet|ask|talk to)\s+((?:[A-Z][a-z]{2,15}\s*){1,2})\b",
]
NO_NAMES = [
    "The", "This", "That", "There", "Here", "What", "Where", "When", "Why", "How", "Please", "Look", "Listen", "Wait", "Hello", "Yes", "Yeah", "No", "Nope", "Okay",
    "Someone", "Anyone", "Nobody", "Everyone", "Movie", "Engine", "Phase", "Dialogue",
]


def candidate_names(text: Column, disallowed: list[str] = NO_NAMES) -> Column:
    """Names in pattern order, of 3 letters or more, without the disallowed ones (case counts); a disallowed first word of several goes."""
    found = F.transform(F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in NAME_PATTERNS]), lambda n: F.split(F.trim(F.regexp_replace(n, r"\s+", " ")), " "))
    bad = lambda w: w.isin(list(disallowed)) if disallowed else F.lit(False)
    names = F.transform(found, lambda w: F.array_join(F.when((F.size(w) > 1) & bad(F.get(w, F.lit(0))), F.slice(w, F.lit(2), F.size(w))).otherwise(w), " "))
    return F.filter(names, lambda n: (F.length(n) >= 3) & ~bad(n))


def name_evidence(text: Column, disallowed: list[str] = NO_NAMES) -> Column:
    """Names as in ``candidate_names``, and behind each found in several words its last word, unless that is disallowed."""
    bad = lambda w: w.isin(list(disallowed)) if disallowed else F.lit(False)
    found = F.transform(F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in NAME_PATTERNS]), lambda n: F.split(F.trim(F.regexp_replace(n, r"\s+", " ")), " "))

    def each(w):
        name = F.array_join(F.when((F.size(w) > 1) & bad(F.get(w, F.lit(0))), F.slice(w, F.lit(2), F.size(w))).otherwise(w), " ")
        last = F.element_at(w, -1)
        return F.when((F.length(name) >= 3) & ~bad(name), F.array_compact(F.array(name, F.when((F.size(w) > 1) & ~bad(last), last)))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(found, each))


def person_labels(people: Column, labels: Column) -> Column:
    """Labels, or where there are none PERSON_A, PERSON_B, ... for the people counted; neither gives none."""
    n = F.least(F.greatest(F.coalesce(people, F.lit(0)), F.lit(0)), F.lit(126)).cast("int")
    made = F.transform(F.slice(F.sequence(F.lit(0), F.lit(126)), F.lit(1), n), lambda k: F.concat(F.lit("PERSON_"), F.char(k + 65)))
    return F.when(F.size(F.coalesce(labels, F.array().cast("array<string>"))) > 0, labels).otherwise(made)


def iso_time(at: Column) -> Column:
    """A timestamp in UTC as ISO 8601 with its offset; microseconds only where there are some."""
    utc = F.to_utc_timestamp(at, F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.unix_micros(at) % 1_000_000 != 0, F.date_format(utc, ".SSSSSS")).otherwise(""), F.lit("+00:00"))


def parse_iso(text: Column) -> Column:
    """The timestamp of an ISO 8601 text with an offset, Z or none (UTC); null where it can't be read."""
    zoned = F.when(text.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return zoned.try_cast("timestamp")


def digest(content: Column) -> Column:
    """SHA-256 of a text's bytes in UTF-8 or of binary content, in lower-case hexadecimal; null stays null."""
    return F.sha2(content.cast("binary"), 256)


def caption_chunks(text: Column, most: int = 15) -> Column:
    """Sentences, then comma or hyphen pieces packed greedily up to ``most`` words; a blank text is one chunk."""
    size = lambda x: F.size(F.split(F.trim(x), r"\s+"))

    def pack(acc, x):
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (size(last) + size(x) <= most)
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat_ws(" ", last, x)))).otherwise(F.array_append(acc, x))

    def sentence(s):
        pieces = F.filter(F.split(s, r"(?<=[,\-])\s+"), lambda x: F.trim(x) != "")
        return F.when(size(s) <= most, F.array(s)).otherwise(F.aggregate(pieces, F.array().cast("array<string>"), pack))

    chunks = F.flatten(F.transform(F.filter(F.split(F.trim(text), r"(?<=[.!?])\s+"), lambda x: F.trim(x) != ""), sentence))
    return F.when(F.size(chunks) > 0, chunks).otherwise(F.array(text))


def wrap_caption(text: Column, width: int = 55) -> Column:
    """Lines of at most ``width``, the first one character less, where words allow; more than two become two halves by words, the first the shorter."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")

    def add(acc, w):
        lines, n = acc["lines"], acc["n"]
        fits = (F.size(lines) > 0) & (n + F.length(w) + 1 <= width)
        longer = F.concat(F.slice(lines, 1, F.size(lines) - 1), F.array(F.concat_ws(" ", F.element_at(lines, -1), w)))
        size = F.when(fits | (F.size(lines) == 0), n + F.length(w) + 1).otherwise(F.length(w))
        return F.struct(F.when(fits, longer).otherwise(F.array_append(lines, w)).alias("lines"), size.alias("n"))

    lines = F.aggregate(words, F.struct(F.array().cast("array<string>").alias("lines"), F.lit(0).alias("n")), add, lambda acc: acc["lines"])
    half = F.floor(F.size(words) / 2).cast("int")
    halves = F.array(F.array_join(F.slice(words, 1, half), " "), F.array_join(F.slice(words, half + 1, F.size(words)), " "))
    return F.array_join(F.when(F.size(lines) > 2, halves).otherwise(lines), "\n")


def rationale(name: Column, n: Column, total: Column, span: Column, ratio: Column, significance: Column) -> Column:
    """Why a character is a candidate, in a sentence; numbers are rounded half up."""
    who = F.coalesce(F.concat(F.lit("'"), F.nullif(name, F.lit("")), F.lit("'")), F.lit("Unnamed character"))
    return F.format_string("%s: in %d of %d events over %.1f s, %.1f%% of the time on screen, mean significance %.1f.", who, n, total, rounded(span, 1), rounded(ratio * 100, 1), rounded(significance, 1))


def prompt(at: Column, said: Column, before: Column, most: int = 4) -> Column:
    """What a provider is asked about a frame: its time, the lines said around it, and the last ``most`` lines of context (arrays of strings)."""
    lines = lambda x, none: F.when(F.size(x) > 0, F.array_join(F.transform(x, lambda line: F.concat(F.lit("- "), line)), "\n")).otherwise(none)
    start = F.greatest(F.lit(1), F.size(before) - most + 1)
    return F.concat(F.lit("Time: "), at, F.lit("\nDialogue:\n"), lines(said, "No dialogue."), F.lit("\nBefore:\n"), lines(F.slice(before, start, most), "Nothing yet."))
