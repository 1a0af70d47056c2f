"""Queries over the test tables, each with DuckDB SQL for the same rows where SQL can express it.

A user's ordered events play a movie's timeline: movie_id, idx from 1, sec from 2024-01-01, label, sig.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import scalars as S
from ..operators import identity as D
from ..operators import intervals as I
from ..operators import timeline as T
from ..operators.packing import pack_clips
from ..sources import documents, media, subtitles
from . import stages as M

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ctes, rest = list(CTES.values()), oracle.strip()
            ORACLES[f.__name__] = "WITH RECURSIVE " + ", ".join(ctes) + (rest if rest.startswith(",") else " " + rest)
        return f

    return add


CTES = {
    "tl": """tl AS (SELECT user_id AS movie_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INTEGER AS idx,
 (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 AS sec, event_type AS label, 1 + CAST(json_extract(props, '$.k') AS INTEGER) % 10 AS sig, value, event_id FROM events)""",
    "li": """li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)::INTEGER AS idx FROM lineitem)""",
    "br": """br AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY movie_id ORDER BY idx) <= 21600 THEN 0 ELSE 1 END AS b FROM tl )""",
    "ru": """ru AS (SELECT *, sum(b) OVER (PARTITION BY movie_id ORDER BY idx) AS g FROM br )""",
    "pc": """pc AS (SELECT *, (row_number() OVER (PARTITION BY movie_id, g ORDER BY idx) - 1) // 6 AS p FROM ru )""",
    "sc": """sc AS (SELECT *, dense_rank() OVER (PARTITION BY movie_id ORDER BY g, p)::INTEGER AS scene FROM pc )""",
}


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def timeline(spark, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    idx = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01', ts)")
    sig = (1 + documents.field(F.col("props"), "$.k", "int", 0) % 10).cast("int")
    return e.select(F.col("user_id").alias("movie_id"), idx.alias("idx"), (micros / 1e6).alias("sec"), F.col("event_type").alias("label"), sig.alias("sig"), "value", "event_id")


def lines(spark, sf_dir: str) -> DataFrame:
    """Line items with an ordinal within their order; line numbers repeat in the data."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf_dir, "lineitem").withColumn("idx", F.row_number().over(order))


def scenes(spark, sf_dir: str) -> DataFrame:
    return T.sessionize(timeline(spark, sf_dir), T.by_gap(6 * 3600), 6)


def _frames_and_cues(spark, sf_dir):
    t = timeline(spark, sf_dir)
    return t.select("movie_id", F.col("event_id").alias("id"), F.col("sec").alias("t")), t.select("movie_id", F.col("event_id").alias("cue"), F.col("sec").alias("rs"), (F.col("sec") + F.col("value") * 0.1).alias("re"))


CUES = """SELECT f.event_id AS id, count(c.event_id) AS n_cues, coalesce(string_agg(c.event_id::VARCHAR, ',' ORDER BY c.sec, c.event_id), '') AS cues
FROM tl f {how} JOIN tl c ON c.movie_id = f.movie_id AND c.sec <= f.sec + 3 AND c.sec + c.value * 0.1 >= greatest(0, f.sec - 3) GROUP BY f.event_id"""


@query(" " + CUES.format(how=""))
def interval_overlap_join(spark, sf_dir):
    return interval_overlap_left_counts(spark, sf_dir).where("n_cues > 0")


@query(" " + CUES.format(how="LEFT"))
def interval_overlap_left_counts(spark, sf_dir):
    frames, cues = _frames_and_cues(spark, sf_dir)
    return I.match_cues(frames, cues, 3.0, by=["movie_id"]).select("id", F.size("cues").cast("long").alias("n_cues"), F.array_join("cues", ",").alias("cues"))


@query(" SELECT movie_id, idx, coalesce(string_agg(label, '|') OVER (PARTITION BY movie_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), '') AS context FROM tl ")
def rolling_context_last4(spark, sf_dir):
    return T.rolling_context(timeline(spark, sf_dir), "label").select("movie_id", "idx", F.array_join("context", "|").alias("context"))


@query(""" , d AS (SELECT movie_id, max(sec) - min(sec) AS duration FROM tl GROUP BY movie_id)
SELECT movie_id, k, round(greatest(0, least(k * 43200.0, duration)), 3) AS t FROM d, unnest(range(0, floor((duration + 1e-4) / 43200.0 + 1e-9)::BIGINT + 1)) AS u(k)""")
def time_grid(spark, sf_dir):
    spans = timeline(spark, sf_dir).groupBy("movie_id").agg((F.max("sec") - F.min("sec")).alias("duration"))
    return I.time_grid(spans, 43200.0).select("movie_id", "k", "t")


@query(" SELECT movie_id, idx, scene FROM sc ")
def scene_sessionize(spark, sf_dir):
    return scenes(spark, sf_dir).select("movie_id", "idx", "scene")


@query(""" , m AS (SELECT movie_id, scene, label, count(*) AS n, min(idx) AS f FROM sc GROUP BY ALL),
b AS (SELECT movie_id, scene, label AS location FROM m QUALIFY row_number() OVER (PARTITION BY movie_id, scene ORDER BY n DESC, f) = 1)
SELECT s.movie_id, s.scene, min(sec) AS start_seconds, max(sec) + 30 AS end_seconds, string_agg(idx::VARCHAR, ',' ORDER BY idx) AS event_indices,
 array_to_string(list_sort(list_distinct(list(label))), ',') AS characters, max(sig) AS importance, any_value(location) AS location
FROM sc s JOIN b ON s.movie_id = b.movie_id AND s.scene = b.scene GROUP BY s.movie_id, s.scene""")
def scene_records(spark, sf_dir):
    return T.scene_records(scenes(spark, sf_dir)).withColumns({"event_indices": F.array_join(F.col("event_indices").cast("array<string>"), ","), "characters": F.array_join("characters", ",")})


FUNCTIONS = {"click": "SETUP", "view": "DISCOVERY", "purchase": "INTRODUCTION", "error": "CONFLICT", "signup": "TRANSITION"}


@query(""" , f AS (SELECT movie_id, idx, CASE label WHEN 'click' THEN 'SETUP' WHEN 'view' THEN 'DISCOVERY' WHEN 'purchase' THEN 'INTRODUCTION' WHEN 'error' THEN 'CONFLICT' ELSE 'TRANSITION' END AS s FROM tl ),
k AS (SELECT *, lag(s) OVER (PARTITION BY movie_id ORDER BY idx) AS p FROM f),
w AS (SELECT movie_id, idx, 1 AS beat, 1 AS size FROM k WHERE idx = 1 UNION ALL
 SELECT k.movie_id, k.idx, CASE WHEN x.act = 'new' THEN w.beat + 1 ELSE w.beat END, CASE WHEN x.act = 'new' THEN 1 ELSE w.size + 1 END
 FROM w JOIN k ON k.movie_id = w.movie_id AND k.idx = w.idx + 1,
 LATERAL (SELECT CASE WHEN p IN ('SETUP', 'DISCOVERY') AND s IN ('SETUP', 'DISCOVERY') OR p = 'CONFLICT' AND s = 'CONFLICT' THEN 'add'
   WHEN s = 'INTRODUCTION' AND p <> 'INTRODUCTION' THEN 'new' WHEN w.size >= 2 THEN 'new' ELSE 'add' END AS act) x)
SELECT movie_id, idx, beat FROM w""")
def beat_automaton(spark, sf_dir):
    function = F.coalesce(*[F.when(F.col("label") == k, v) for k, v in FUNCTIONS.items()])
    return T.beats(timeline(spark, sf_dir).withColumn("function", function)).select("movie_id", "idx", "beat")


@query(""" , g AS (SELECT movie_id, label, min(idx) AS first_idx, arg_min(sec, idx) AS first_seen, arg_max(sec, idx) AS last_seen, count(*) AS appearances FROM tl GROUP BY ALL)
SELECT *, printf('CHARACTER_%03d', row_number() OVER (PARTITION BY movie_id ORDER BY first_idx, label)) AS character_id FROM g""")
def identity_first_occurrence(spark, sf_dir):
    return T.identities(timeline(spark, sf_dir))


@query(""" , p AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem)
SELECT a.p AS source, b.p AS target, min(a.o) AS first_event FROM p a JOIN p b ON a.o = b.o AND a.p <> b.p GROUP BY ALL""")
def copresence_edges(spark, sf_dir):
    return T.edges(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


@query(""" , c AS (SELECT movie_id, label, count(*) AS votes, max(round(value / 100, 6)) AS top, min(idx) AS f FROM tl GROUP BY ALL),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY votes DESC, top DESC, f) = 1)
SELECT movie_id, votes, top, CASE WHEN votes >= 2 THEN 'high' WHEN top >= 0.85 THEN 'medium' WHEN top >= 0.6 THEN 'low' ELSE 'unknown' END AS name_confidence,
 CASE WHEN votes >= 2 OR top >= 0.6 THEN label END AS name FROM b""")
def name_vote_argmax(spark, sf_dir):
    return T.vote(timeline(spark, sf_dir).select("movie_id", "idx", F.col("label").alias("candidate"), S.rounded(F.col("value") / 100, 6).alias("confidence")))


@query(" SELECT movie_id, label, sig, min(idx) AS idx FROM tl GROUP BY ALL")
def evidence_dedup_first(spark, sf_dir):
    return T.first_of(timeline(spark, sf_dir), ["movie_id", "label", "sig"]).select("movie_id", "label", "sig", "idx")


@query(""" , m AS (SELECT l_orderkey, l_returnflag, count(*) AS n, min(idx) AS f FROM li GROUP BY ALL)
SELECT l_orderkey, l_returnflag FROM m QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, f) = 1""")
def dominant_mode(spark, sf_dir):
    return T.modes(lines(spark, sf_dir), ["l_orderkey"], "l_returnflag", "idx")


@query(""" , w AS (SELECT movie_id, count(DISTINCT idx) AS events, greatest(1.0, max(sec)) AS duration FROM tl GROUP BY movie_id),
o AS (SELECT movie_id, label, count(DISTINCT idx) AS n, max(sec) - min(sec) AS span, sum(sig) AS sig, count(*) AS k, min(idx) AS f FROM tl GROUP BY ALL),
x AS (SELECT o.*, events, round(span / duration, 3) AS screen_ratio FROM o JOIN w USING (movie_id)),
y AS (SELECT *, round(least(1.0, greatest(0.0, 0.40::DOUBLE * n / events + 0.30::DOUBLE * screen_ratio + 0.20::DOUBLE * least(1.0::DOUBLE, sig / k / 10.0::DOUBLE) + 0.10::DOUBLE)), 3) AS score FROM x)
SELECT movie_id, label, n, screen_ratio, score, row_number() OVER (PARTITION BY movie_id ORDER BY score DESC, n DESC, f)::INTEGER AS rank FROM y""")
def prominence_score(spark, sf_dir):
    return T.prominence(timeline(spark, sf_dir)).select("movie_id", "label", "n", "screen_ratio", "score", "rank")


@query(""" , g AS (SELECT movie_id, count(*) AS n, max(sec) AS reached FROM tl GROUP BY movie_id)
SELECT movie_id, CASE WHEN n > 0 AND (CASE WHEN movie_id % 2 = 0 THEN n >= 58 ELSE reached >= 2592000 * 0.8 END) THEN 'COMPLETE' ELSE 'PARTIAL' END AS status FROM g""")
def coverage_status(spark, sf_dir):
    g = timeline(spark, sf_dir).groupBy("movie_id").agg(F.count(F.lit(1)).alias("n"), F.max("sec").alias("reached"))
    samples = F.when(F.col("movie_id") % 2 == 0, 69)
    return g.select("movie_id", T.coverage(F.col("n"), samples, F.col("reached"), F.lit(2592000.0)).alias("status"))


@query(""" , o AS (SELECT o_custkey AS movie_id, o_orderkey, o_totalprice::DECIMAL(18,2) AS w FROM orders),
t AS (SELECT movie_id, greatest(45.0::DOUBLE, least(900.0::DOUBLE * (count(*) / 40.0::DOUBLE) * 1.25::DOUBLE, 900.0::DOUBLE)) AS target FROM o GROUP BY 1),
s AS (SELECT o.*, target, round(greatest(10.0::DOUBLE, w::DOUBLE / sum(w) OVER (PARTITION BY movie_id)::DOUBLE * target), 1)::DECIMAL(18,1) AS share FROM o JOIN t USING (movie_id))
SELECT movie_id, o_orderkey, round(share::DOUBLE * target / sum(share) OVER (PARTITION BY movie_id)::DOUBLE, 1) AS seconds FROM s""")
def proportional_allocation(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("movie_id"), "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("w"))
    o = o.withColumn("target", T.target_seconds(F.count(F.lit(1)).over(Window.partitionBy("movie_id")) / 40.0, F.lit(False)))
    return T.allocate(o, "w", "target").select("movie_id", "o_orderkey", "seconds")


@query(""" , n AS (SELECT *, count(*) OVER w AS c, max(sig) OVER w AS imp, row_number() OVER (PARTITION BY movie_id, scene ORDER BY idx) - 1 AS pos FROM sc WINDOW w AS (PARTITION BY movie_id, scene)),
k AS (SELECT *, CASE WHEN imp >= 7 THEN CASE WHEN c <= 1 THEN 1 ELSE least(3, c) END WHEN imp >= 4 THEN least(2, c) ELSE 1 END AS k FROM n)
SELECT movie_id, scene, idx FROM k WHERE len(list_filter(range(0, k), lambda i: (i * c) // k = pos)) > 0""")
def importance_budget_subsample(spark, sf_dir):
    w = Window.partitionBy("movie_id", "scene")
    s = scenes(spark, sf_dir).withColumns({"c": F.count(F.lit(1)).over(w), "imp": F.max("sig").over(w)})
    return T.subsample(s, ["movie_id", "scene"], "idx", T.clip_budget(F.col("imp"), F.col("c"))).select("movie_id", "scene", "idx")


@query(" SELECT movie_id, scene, idx FROM sc QUALIFY sig >= 8 OR NOT bool_or(sig >= 8) OVER (PARTITION BY movie_id, scene)")
def fallback_filter(spark, sf_dir):
    return T.or_all(scenes(spark, sf_dir), ["movie_id", "scene"], F.col("sig") >= 8).select("movie_id", "scene", "idx")


@query(""" , e AS (SELECT movie_id, idx, sec / 3600 AS t FROM tl ), z AS (SELECT movie_id, max(t) + 5 AS stop FROM e GROUP BY 1),
c AS (SELECT movie_id, 0 AS idx, -999.0::DOUBLE AS pe, 0.0::DOUBLE AS s, 0.0::DOUBLE AS d, false AS pushed, stop FROM z UNION ALL
 SELECT e.movie_id, e.idx, b.e1, b.s1, round(b.e1 - b.s1, 2), a.push, c.stop FROM c JOIN e ON e.movie_id = c.movie_id AND e.idx = c.idx + 1,
 LATERAL (SELECT greatest(0.0, e.t - 0.5) AS s0, least(c.stop, greatest(0.0, e.t - 0.5) + 3.0) AS e0, greatest(0.0, e.t - 0.5) < c.pe + 1 AS push) a,
 LATERAL (SELECT CASE WHEN push THEN c.pe + 2 ELSE s0 END AS s1, CASE WHEN push THEN least(c.stop, c.pe + 2 + round(e0 - s0, 2)) ELSE e0 END AS e1) b)
SELECT movie_id, idx AS ord, round(s, 2) AS start, round(pe, 2) AS stop, d AS duration, pushed FROM c WHERE idx > 0""")
def clip_packing(spark, sf_dir):
    t = timeline(spark, sf_dir).select("movie_id", F.col("idx").alias("ord"), (F.col("sec") / 3600).alias("t"))
    return pack_clips(t.withColumn("movie_end", F.max("t").over(Window.partitionBy("movie_id")) + 5))


@query(""" , c AS (SELECT l_orderkey AS movie_id, idx, CASE WHEN idx % 5 = 0 THEN 'x' ELSE l_partkey::VARCHAR END AS clip_id, l_quantity AS start, l_quantity + l_discount * 40 AS stop, l_tax * 50 AS duration, l_suppkey % 7 AS event, l_suppkey % 3 = 0 AS pushed FROM li),
n AS (SELECT *, start - lag(stop) OVER w AS gap, lag(start) OVER w - start AS back, NOT pushed AND NOT coalesce(lag(pushed) OVER w, false) AS free, row_number() OVER (PARTITION BY movie_id, clip_id ORDER BY idx) AS nth FROM c WINDOW w AS (PARTITION BY movie_id ORDER BY idx))
SELECT movie_id, idx, concat_ws(',', CASE WHEN nth > 1 THEN 'duplicate_id' END, CASE WHEN duration <= 0 THEN 'no_duration' END, CASE WHEN duration > 3.01 THEN 'too_long' END, CASE WHEN stop <= start THEN 'end_before_start' END,
 CASE WHEN abs(duration - round(stop - start, 2)) > 0.15 THEN 'duration_mismatch' END, CASE WHEN stop > 46 THEN 'past_end' END, CASE WHEN event <= 0 THEN 'no_event' END, CASE WHEN gap < 0 THEN 'overlap' END, CASE WHEN gap >= 0 AND gap < 0.5 AND free THEN 'touching' END) AS errors,
 concat_ws(',', CASE WHEN gap >= 0.5 AND gap < 5 AND free THEN 'close' END, CASE WHEN back > 5 THEN 'backwards' END) AS warnings FROM n""")
def validator_pairs(spark, sf_dir):
    c = lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("movie_id"), "idx", F.when(F.col("idx") % 5 == 0, "x").otherwise(F.col("l_partkey").cast("string")).alias("clip_id"), F.col("l_quantity").alias("start"),
        (F.col("l_quantity") + F.col("l_discount") * 40).alias("stop"), (F.col("l_tax") * 50).alias("duration"), (F.col("l_suppkey") % 7).cast("int").alias("event"), F.lit("s").alias("scene"), F.lit("r").alias("reason"), F.lit(45.0).alias("movie_end"),
        (F.col("l_suppkey") % 3 == 0).alias("pushed"),
    )
    return T.validate_clips(c).select("movie_id", "idx", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


@query(""" , e AS (SELECT movie_id, count(*) AS events, greatest(1.0, max(sec)) AS duration FROM tl GROUP BY movie_id),
c AS (SELECT movie_id, label, count(*) AS n, arg_max(sec, idx) - arg_min(sec, idx) AS span, avg(sig) AS sig, printf('CHARACTER_%03d', row_number() OVER (PARTITION BY movie_id ORDER BY min(idx), label)) AS character_id FROM tl GROUP BY movie_id, label),
x AS (SELECT c.*, events, round(greatest(0.0, span) / duration, 3) AS screen_ratio FROM c JOIN e USING (movie_id)),
y AS (SELECT *, round(least(1.0, greatest(0.0, 0.40::DOUBLE * n / events + 0.30::DOUBLE * screen_ratio + 0.20::DOUBLE * least(1.0::DOUBLE, sig / 10.0::DOUBLE) + CASE WHEN label = 'error' THEN 0.0::DOUBLE ELSE 0.10::DOUBLE END)), 3) AS score FROM x)
SELECT movie_id, character_id, CASE WHEN label <> 'error' THEN label END AS name, n, screen_ratio, score, row_number() OVER (PARTITION BY movie_id ORDER BY score DESC, n DESC, character_id)::INTEGER AS rank FROM y""")
def story_leads(spark, sf_dir):
    events, characters, appearances, _ = _movie(spark, sf_dir)
    return M.leads(events, characters, appearances).select("movie_id", "character_id", "name", "n", "screen_ratio", "score", "rank")


ITEMS = """ , i AS (SELECT l_orderkey AS movie_id, idx, CASE l_returnflag WHEN 'A' THEN 'STILL_FREEZE' WHEN 'R' THEN 'BLACK_TRANSITION' ELSE 'SOURCE_CLIP' END AS item_type, (l_quantity * 0.06)::DECIMAL(12,2) AS duration FROM li)
"""


def _items(spark, sf_dir):
    kind = F.when(F.col("l_returnflag") == "A", "STILL_FREEZE").when(F.col("l_returnflag") == "R", "BLACK_TRANSITION").otherwise("SOURCE_CLIP")
    return lines(spark, sf_dir).select(F.col("l_orderkey").alias("movie_id"), "idx", kind.alias("item_type"), (F.col("l_quantity") * 0.06).cast("decimal(12,2)").alias("duration"))


@query(ITEMS + "SELECT movie_id, idx, (e - duration)::DOUBLE AS start_seconds, e::DOUBLE AS end_seconds FROM (SELECT *, sum(duration) OVER (PARTITION BY movie_id ORDER BY idx) AS e FROM i)")
def timeline_layout(spark, sf_dir):
    return T.layout(_items(spark, sf_dir)).select("movie_id", "idx", F.col("start_seconds").cast("double").alias("start_seconds"), F.col("end_seconds").cast("double").alias("end_seconds"))


@query(ITEMS + """SELECT movie_id, count(*) FILTER (item_type = 'SOURCE_CLIP') AS clips, coalesce(sum(duration) FILTER (item_type = 'SOURCE_CLIP'), 0)::DOUBLE AS footage, coalesce(sum(duration) FILTER (item_type = 'STILL_FREEZE'), 0)::DOUBLE AS freeze,
 coalesce(sum(duration) FILTER (item_type = 'BLACK_TRANSITION'), 0)::DOUBLE AS black, sum(duration)::DOUBLE AS total, round(coalesce(sum(duration) FILTER (item_type = 'SOURCE_CLIP'), 0)::DOUBLE / greatest(0.01, sum(duration)::DOUBLE) * 100, 1) AS moving_percent FROM i GROUP BY movie_id""")
def manifest_metrics(spark, sf_dir):
    m = T.metrics(_items(spark, sf_dir))
    return m.withColumns({c: F.col(c).cast("double") for c in ("footage", "freeze", "black", "total")})


#: White space of all scripts, and what isn't, as DuckDB writes them.
BLANK, SOLID = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]", r"[^\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def _clean(x: str) -> str:
    for pattern, to in ((r"\\[Nn]", " "), (r"\{[^}]*\}", ""), ("<[^>]+>", ""), (rf"align:[\p{{L}}\p{{N}}_]+|(?:position|size|line):{SOLID}+", ""), (f"{BLANK}+", " ")):
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return f"trim({x})"


def _tokens(x: str) -> str:
    return f"len(regexp_split_to_array(trim({x}), '[\\s\\x0B]+'))"


def _chunks(text: str, most: int) -> str:
    """Sentences, and the pieces of those that are too long, packed; chr(1) stands where a text is cut."""
    cut = lambda x, marks: f"string_split(regexp_replace({x}, '([{marks}])[\\s\\x0B]+', '\\1' || chr(1), 'g'), chr(1))"
    pack = f"lambda acc, x: CASE WHEN {_tokens('string_split(acc, chr(1))[-1]')} + {_tokens('x')} <= {most} THEN acc || ' ' || x ELSE acc || chr(1) || x END"
    pieces = f"list_filter({cut('s', ',' + chr(92) + '-')}, lambda y: trim(y) <> '')"
    each = f"lambda s: CASE WHEN {_tokens('s')} <= {most} THEN [s] ELSE string_split(list_reduce({pieces}, {pack}), chr(1)) END"
    found = f"flatten(list_transform(list_filter({cut(f'trim({text})', '.!?')}, lambda z: trim(z) <> ''), {each}))"
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE [{text}] END"


def _wrapped(text: str, width: int) -> str:
    """Lines behind chr(1), after nine digits of the running length."""
    words = f"list_filter(regexp_split_to_array({text}, '[\\s\\x0B]+'), lambda w: w <> '')"
    n = "substr(acc, 1, 9)::INTEGER"
    state = lambda size: f"lpad(({size})::VARCHAR, 9, '0') || substr(acc, 10)"
    step = f"lambda acc, w: CASE WHEN length(acc) = 9 THEN {state(f'{n} + length(w) + 1')} || chr(1) || w WHEN {n} + length(w) + 1 <= {width} THEN {state(f'{n} + length(w) + 1')} || ' ' || w ELSE {state('length(w)')} || chr(1) || w END"
    lines = f"string_split(substr(list_reduce(list_prepend('000000000', {words}), {step}), 11), chr(1))"
    halves = f"array_to_string({words}[1 : len({words}) // 2], ' ') || chr(10) || array_to_string({words}[len({words}) // 2 + 1 :], ' ')"
    return f"CASE WHEN len({lines}) > 2 THEN {halves} ELSE array_to_string({lines}, chr(10)) END"


@query(f" SELECT page_id, {_clean('html')} AS text FROM pages")
def clean_markup(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.clean_text(F.col("html")).alias("text"))


@query(r""" , c AS (SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+'))::INTEGER AS words FROM documents) SELECT doc_id, words, round(words / 150.0::DOUBLE * 60.0::DOUBLE, 1) AS seconds FROM c""")
def word_count_duration(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", S.word_count(F.col("text")).alias("words"))
    return d.withColumn("seconds", S.speech_seconds(F.col("words")))


@query(f""" , c AS (SELECT conv_id, turn, {_chunks("text", 15)} AS chunks FROM conversations), x AS (SELECT conv_id, turn, unnest(range(len(chunks)))::INTEGER AS pos, chunks FROM c)
SELECT conv_id, turn, pos, chunks[pos + 1] AS chunk, {_wrapped("chunks[pos + 1]", 55)} AS wrapped FROM x""")
def caption_chunks(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(S.caption_chunks(F.col("text"))).alias("pos", "chunk"))
    return c.withColumn("wrapped", S.wrap_caption(F.col("chunk")))


@query(""" , m AS (SELECT event_id, round(sec * 1000)::BIGINT AS ms FROM tl )
SELECT event_id, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS clock, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS srt, round(ms / 1000.0::DOUBLE, 3) AS back FROM m""")
def format_timestamps(spark, sf_dir):
    t = timeline(spark, sf_dir).select("event_id", S.format_timestamp(F.col("sec")).alias("clock"), S.format_srt_time(F.col("sec")).alias("srt"))
    return t.withColumn("back", S.parse_timestamp(F.col("srt")))


@query(r""" , b AS (SELECT page_id, regexp_replace(regexp_replace(url, '^.*/', ''), '(.)\.[^.]*$', '\1') AS x FROM pages),
c AS (SELECT page_id, lower(regexp_replace(regexp_replace(x, '[^A-Za-z0-9_\-]+', '_', 'g'), '^_+|_+$', '', 'g')) AS y FROM b) SELECT page_id, coalesce(nullif(y, ''), 'unnamed_movie') AS id FROM c""")
def sanitize_ids(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.sanitize_id(F.col("url")).alias("id"))


@query(" , n AS (SELECT doc_id, n_chars * 37 AS n FROM documents) SELECT doc_id, CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN printf('%.2f KB', n / 1024.0::DOUBLE) ELSE printf('%.2f MB', n / 1048576.0::DOUBLE) END AS size FROM n")
def file_size_ladder(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.file_size(F.col("n_chars") * 37).alias("size"))


@query(""" , s AS (SELECT *, CASE WHEN s_acctbal > 9000 THEN 0 WHEN s_name LIKE '%7' THEN 1 ELSE 2 END AS rule FROM supplier)
SELECT s_nationkey, s_suppkey, rule FROM s QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY rule, s_suppkey) = 1""")
def ranked_choice(spark, sf_dir):
    return T.choose_track(table(spark, sf_dir, "supplier"), ["s_nationkey"], [F.col("s_acctbal") > 9000, F.col("s_name").endswith("7")], ["s_suppkey"]).select("s_nationkey", "s_suppkey", "rule")


@query(""" , f AS (SELECT movie_id, scene, label, min(idx) AS f FROM sc GROUP BY ALL) SELECT movie_id, scene, string_agg(label, ' ' ORDER BY f) AS labels FROM f GROUP BY ALL""")
def ordered_distinct_concat(spark, sf_dir):
    return scenes(spark, sf_dir).groupBy("movie_id", "scene").agg(T.ordered_distinct("label").alias("labels"))


@query(""" , u AS (SELECT o_custkey, max(CASE WHEN o_orderpriority[1] = '1' THEN 3 WHEN o_orderpriority[1] IN ('2', '3') THEN 2 ELSE 1 END) AS r FROM orders GROUP BY 1)
SELECT o_custkey, CASE r WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS uncertainty FROM u""")
def uncertainty_ordinal_max(spark, sf_dir):
    p = F.substring("o_orderpriority", 1, 1)
    level = F.when(p == "1", "high").when(p.isin("2", "3"), "medium").otherwise("low")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(T.ordinal_max(level).alias("uncertainty"))


@query(" , p AS (SELECT movie_id, idx, label AS cause, lead(label) OVER w AS effect, lead(idx) OVER w AS effect_idx, row_number() OVER w AS n FROM tl WINDOW w AS (PARTITION BY movie_id ORDER BY idx)) SELECT movie_id, idx, cause, effect, effect_idx FROM p WHERE n <= 3 AND effect IS NOT NULL")
def causal_pairs_top3(spark, sf_dir):
    return T.causal_pairs(timeline(spark, sf_dir).withColumn("title", F.col("label"))).select("movie_id", "idx", F.col("title").alias("cause"), "effect", "effect_idx")


@query(" , a AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), b AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) SELECT DISTINCT l_orderkey, l_suppkey FROM a JOIN b USING (l_partkey)")
def array_overlap_join(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return T.overlap_join(items.select("l_orderkey", "l_partkey"), items.select("l_suppkey", "l_partkey"), "l_partkey")


@query(" , x AS (SELECT movie_id, idx, CASE WHEN label <> 'error' THEN event_id END AS path FROM tl ) SELECT movie_id, idx, coalesce(path, lag(path) OVER w, lead(path) OVER w) AS path FROM x WINDOW w AS (PARTITION BY movie_id ORDER BY idx)")
def neighbour_fill(spark, sf_dir):
    t = timeline(spark, sf_dir).withColumn("path", F.when(F.col("label") != "error", F.col("event_id")))
    return t.select("movie_id", "idx", T.neighbour_fill(F.col("path")).alias("path"))


@query(" SELECT movie_id, idx FROM tl WHERE idx <= 20 AND idx % 3 <> 0")
def resume_antijoin(spark, sf_dir):
    t = timeline(spark, sf_dir).select("movie_id", "idx")
    return T.pending(t, t.where("idx % 3 = 0"), 20)


@query(" SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS INTEGER), -1) AS k, coalesce(json_extract_string(props, '$.missing'), 'none') AS missing FROM events")
def json_tolerant_extract(spark, sf_dir):
    p = F.col("props")
    return table(spark, sf_dir, "events").select("event_id", documents.field(p, "$.k", "int", -1).alias("k"), documents.field(p, "$.missing", "string", "none").alias("missing"))


def _name_sql() -> str:
    text = " || ".join(f"regexp_extract_all(text, '{p.replace(chr(39), chr(39) * 2)}', 1)" for p in S.NAME_PATTERNS)
    bad = ", ".join(f"'{w}'" for w in S.NO_NAMES)
    return f""" , n AS (SELECT conv_id, turn, role, text, list_transform({text}, lambda x: regexp_split_to_array(trim(x, ' \t\n\r'), '\\s+')) AS found FROM conversations),
 m AS (SELECT conv_id, turn, role, list_transform(found, lambda x: CASE WHEN len(x) > 1 AND x[1] IN ({bad}) THEN array_to_string(x[2:], ' ') ELSE array_to_string(x, ' ') END) AS names FROM n)
SELECT conv_id, turn, role, array_to_string(list_filter(names, lambda x: length(x) >= 3 AND x NOT IN ({bad})), ',') AS names FROM m"""


@query(_name_sql())
def name_patterns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.array_join(S.candidate_names(F.col("text")), ",").alias("names"))


def _cues(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where(F.trim("text") != "")
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return c.select(F.col("conv_id").cast("string").alias("movie_id"), n.alias("idx"), (n * 4.0).alias("start_seconds"), (n * 4.0 + 2.5).alias("end_seconds"), S.clean_text(F.col("text")).alias("text"))


def _clock(x: str) -> str:
    ms = f"round({x} * 1000)::BIGINT"
    return f"printf('%02d:%02d:%02d.%03d', {ms} // 3600000, {ms} // 60000 % 60, {ms} // 1000 % 60, {ms} % 1000)"


def _cue_sql(text: str, speaker: str) -> str:
    """The cues of the conversations' turns after a round trip, in which cue n has ``text`` of the cleaned turn."""
    return f""" , q AS (SELECT conv_id::VARCHAR AS movie_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n, {_clean("text")} AS c FROM conversations WHERE trim(text) <> ''),
t AS (SELECT movie_id, n * 4.0::DOUBLE AS a, n * 4.0::DOUBLE + 2.5 AS b, {_clean(text)} AS text FROM q)
SELECT movie_id, row_number() OVER (PARTITION BY movie_id ORDER BY a)::INTEGER AS idx, a AS start_seconds, b AS end_seconds, {_clock("a")} AS start, {_clock("b")} AS "end", round(b - a, 3) AS duration_seconds, text, {speaker} AS speaker FROM t WHERE text <> ''"""


@query(_cue_sql("c", "NULL::VARCHAR"))
def srt_round_trip(spark, sf_dir):
    return subtitles.parse_srt(subtitles.to_srt(_cues(spark, sf_dir)))


@query(_cue_sql("replace(c, ',', '.')", "'Speaker'"))
def vtt_parse(spark, sf_dir):
    srt = subtitles.to_srt(_cues(spark, sf_dir).withColumn("text", F.concat(F.lit("<v Speaker>"), "text")))
    return subtitles.parse_vtt(srt.select("movie_id", F.concat(F.lit("WEBVTT\n\nNOTE skipped\n\n"), F.replace("content", F.lit(","), F.lit("."))).alias("content")))


@query(_cue_sql("c", "'Name'"))
def ass_parse(spark, sf_dir):
    c = _cues(spark, sf_dir)
    line = F.concat(F.lit("Dialogue: 0,"), S.format_timestamp(F.col("start_seconds")), F.lit(","), S.format_timestamp(F.col("end_seconds")), F.lit(",Name,{\\pos(1,2)}"), "text")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(-F.col("idx"), line.alias("l")))), lambda x: x["l"]), "\n")
    return subtitles.parse_ass(c.groupBy("movie_id").agg(F.concat(F.lit("[Script Info]\n\n[Events]\nFormat: Layer, Start, End, Name, Text\n"), body).alias("content")))


def _said(words: tuple[str, ...]) -> str:
    return "(" + " OR ".join("contains(t, '" + w.replace("'", "''") + "')" for w in words) + ")"


@query(
    """ , tx AS (SELECT conv_id, lower(string_agg(coalesce(text, ''), ' ' ORDER BY turn, role, coalesce(text, ''))) AS t, max(turn) AS m FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE """
    + " ".join(f"WHEN {_said(w)} THEN '{f}'" for w, f in R.SCENE_RULES)
    + " WHEN m >= 9 THEN 'CLIMAX' WHEN m >= 7 THEN 'ESCALATION' WHEN m = 1 THEN 'SETUP' ELSE 'TRANSITION' END AS scene_function FROM tx"
)
def scene_function_rules(spark, sf_dir):
    said = F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))))
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(said["text"], " ").alias("t"), F.max("turn").alias("m"))
    return c.select("conv_id", R.scene_function(F.col("t"), F.col("m"), F.col("m") == 1).alias("scene_function"))


@query(""" , x AS (SELECT movie_id, scene, lower(string_agg(label, ' ' ORDER BY idx)) AS t, max(sig) AS sig, count(DISTINCT label) AS n FROM sc GROUP BY ALL),
y AS (SELECT *, CASE WHEN contains(t, 'error') THEN 'Escalation' WHEN contains(t, 'signup') THEN 'Introduction' WHEN n = 1 THEN 'Transition' ELSE 'Story' END AS title FROM x),
z AS (SELECT *, CASE title WHEN 'Escalation' THEN 'rising_action_and_crisis' WHEN 'Introduction' THEN 'setting_shift_and_character_intro' ELSE CASE WHEN sig >= 9 THEN 'peak_climax' WHEN title = 'Transition' THEN 'atmospheric_transition' ELSE 'story_progression' END END AS purpose FROM y)
SELECT movie_id, scene, purpose, CASE purpose WHEN 'rising_action_and_crisis' THEN 'moderate' WHEN 'peak_climax' THEN 'high' ELSE 'none' END AS spoiler_level,
 CASE WHEN purpose = 'atmospheric_transition' AND n = 1 THEN 1.0 ELSE sig::DOUBLE END AS weight FROM z""")
def segment_purpose(spark, sf_dir):
    x = scenes(spark, sf_dir).groupBy("movie_id", "scene").agg(F.collect_set("label").alias("labels"), F.max("sig").alias("sig"))
    has = lambda label: F.array_contains("labels", label)
    title = F.when(has("error"), "Escalation").when(has("signup"), "Introduction").when(F.size("labels") == 1, "Transition").otherwise("Story")
    x = x.withColumn("p", R.purpose(title, F.when(F.col("sig") >= 9, F.array(F.lit("CLIMAX")))))
    return x.select("movie_id", "scene", "p.purpose", "p.spoiler_level", R.weight(F.col("sig"), F.col("p.purpose"), F.size("labels") - 1).alias("weight"))


@query(""" , h AS (SELECT movie_id, bool_or(label = 'click') AS c, bool_or(label = 'view') AS v, bool_or(label = 'error') AS e FROM tl GROUP BY movie_id),
r AS (SELECT t.*, CASE WHEN label = 'view' AND c THEN CASE WHEN e THEN 'error' ELSE 'click' END WHEN label = 'click' AND e THEN 'error' ELSE label END AS character_id FROM tl t JOIN h ON t.movie_id = h.movie_id)
SELECT movie_id, character_id, min(sec) AS first_seen, max(sec) AS last_seen, array_to_string(list_sort(list_distinct(list(label))), ',') AS merged_ids FROM r GROUP BY movie_id, character_id""")
def identity_merge(spark, sf_dir):
    t = timeline(spark, sf_dir)
    characters = t.groupBy("movie_id", F.col("label").alias("character_id")).agg(F.min("sec").alias("first_seen"), F.max("sec").alias("last_seen"))
    each = lambda idx, a, b: F.struct(F.lit(idx).alias("idx"), F.lit(a).alias("primary"), F.lit(b).alias("merged"))
    merges = t.select("movie_id").distinct().select("movie_id", F.explode(F.array(each(1, "click", "view"), each(2, "error", "click"), each(3, "click", "error"))).alias("m")).select("movie_id", "m.*")
    return D.merge_identities(characters, merges).withColumn("merged_ids", F.array_join("merged_ids", ","))


@query(""" , f AS (SELECT f.event_id AS id, list(c.label ORDER BY c.sec, c.event_id) FILTER (c.event_id IS NOT NULL) AS said FROM tl f LEFT JOIN tl c ON c.event_id <> f.event_id AND c.movie_id = f.movie_id AND c.sec BETWEEN f.sec - 3600 AND f.sec GROUP BY f.event_id)
SELECT id, CASE WHEN len(said) > 0 THEN 2 ELSE 1 END::INTEGER AS people_count, CASE WHEN len(said) > 0 THEN 6 ELSE 4 END::INTEGER AS plot_significance,
 CASE WHEN len(said) > 0 THEN 'Characters speaking: "' || array_to_string(said[1:2], ' ') || '"' ELSE 'A character is observing the surroundings.' END AS action,
 CASE WHEN len(said) > 0 THEN 'Characters interact while discussing: "' || said[1] || '"' ELSE 'Scene progression at ' || id || ' showing character observation.' END AS event_summary FROM f""")
def mock_provider(spark, sf_dir):
    near = Window.partitionBy("movie_id").orderBy("sec").rangeBetween(-3600, 0)
    said = F.array_sort(F.collect_list(F.struct("sec", "event_id", "label")).over(near))
    t = timeline(spark, sf_dir).withColumn("said", said).select(F.col("event_id").alias("id"), F.filter("said", lambda s: s["event_id"] != F.col("event_id"))["label"].alias("said"))
    return t.withColumn("d", D.mock_description(F.col("said"), F.col("id").cast("string"))).select("id", "d.people_count", "d.plot_significance", "d.action", "d.event_summary")


@query(""" SELECT p_partkey, round(p_retailprice, 3)::DOUBLE AS duration_seconds, CASE WHEN p_size % 3 = 0 THEN 'unknown' ELSE p_size || 'x' || p_size END AS resolution,
 CASE WHEN p_size % 2 = 0 THEN round(p_size::DOUBLE, 3) ELSE 25.0 END AS fps, 2 AS number_of_subtitle_streams, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'en' END AS subtitle_languages FROM part""")
def media_metadata(spark, sf_dir):
    size = F.col("p_size").cast("string")
    known = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.concat(F.lit(', "width": '), size, F.lit(', "height": '), size))
    rate = F.when(F.col("p_size") % 2 == 0, F.concat(size, F.lit("/1"))).otherwise("0/0")
    tags = F.when(F.col("p_size") % 5 == 0, "").otherwise(', "tags": {"language": "en"}')
    probe = F.concat(
        F.lit('{"format": {"duration": "'), F.col("p_retailprice").cast("string"), F.lit('"}, "streams": [{"codec_type": "video", "r_frame_rate": "'), rate, F.lit('", "avg_frame_rate": "25/1"'), known,
        F.lit('}, {"codec_type": "subtitle"'), tags, F.lit('}, {"codec_type": "subtitle", "index": 3, "disposition": {"default": 1}'), tags, F.lit("}]}"),
    )
    m = media.shape_metadata(table(spark, sf_dir, "part").select("p_partkey", probe.alias("probe")), ["p_partkey"])
    return m.select("p_partkey", "duration_seconds", "resolution", "fps", "number_of_subtitle_streams", F.array_join("subtitle_languages", ",").alias("subtitle_languages"))


GAP = 6 * 3600.0


def _movie(spark, sf_dir):
    """The timeline as described events, characters and their appearances, and movies of 69 samples and 30 days."""
    t = documents.staged(timeline(spark, sf_dir), "timeline")
    level = F.when(F.col("sig") >= 9, "high").when(F.col("sig") >= 4, "medium").otherwise("low")
    events = t.select(
        "movie_id", F.col("idx").alias("event"), "sec", F.col("label").alias("location"), F.concat_ws(" ", F.lit("do"), "label").alias("action"), F.array("label").alias("labels"),
        F.concat_ws(" ", "label", F.col("event_id").cast("string")).alias("summary"), F.lit(None).cast("array<string>").alias("dialogue"), "sig", level.alias("uncertainty"),
    )
    ids = T.identities(t)
    characters = ids.select("movie_id", "character_id", F.when(F.col("label") != "error", F.col("label")).alias("name"), "first_seen", "last_seen")
    appearances = t.join(ids.select("movie_id", "label", "character_id"), ["movie_id", "label"]).select("movie_id", "character_id", F.col("idx").alias("ord"), F.col("idx").alias("event"), "sec")
    movies = t.select("movie_id").distinct().select("movie_id", F.lit(69).alias("samples"), F.lit(2592000.0).alias("duration"))
    return documents.staged(M.with_cast(M.ordered(events), characters, appearances), "events"), characters, appearances, movies


STORY = """ , mb AS (SELECT *, CASE WHEN lag(label) OVER w = label AND sec - lag(sec) OVER w <= 21600 THEN 0 ELSE 1 END AS b FROM tl WINDOW w AS (PARTITION BY movie_id ORDER BY idx)),
mr AS (SELECT *, sum(b) OVER (PARTITION BY movie_id ORDER BY idx) AS g FROM mb), mp AS (SELECT *, (row_number() OVER (PARTITION BY movie_id, g ORDER BY idx) - 1) // 6 AS p FROM mr),
ms AS (SELECT *, dense_rank() OVER (PARTITION BY movie_id ORDER BY g, p)::INTEGER AS scene FROM mp),
mx AS (SELECT movie_id, scene, min(sec) AS start_seconds, max(sec) + 30 AS end_seconds, list(idx ORDER BY idx) AS event_indices, any_value(label) AS location, string_agg(label || ' ' || event_id, ' ' ORDER BY idx) AS summary,
 max(sig) AS importance, CASE WHEN max(sig) >= 9 THEN 'high' WHEN max(sig) >= 4 THEN 'medium' ELSE 'low' END AS uncertainty,
 CASE WHEN max(sig) >= 9 THEN 'CLIMAX' WHEN max(sig) >= 7 THEN 'ESCALATION' WHEN scene = 1 THEN 'SETUP' ELSE 'TRANSITION' END AS scene_function FROM ms GROUP BY movie_id, scene)"""
BEATS = (
    STORY
    + """, mk AS (SELECT *, lag(scene_function) OVER (PARTITION BY movie_id ORDER BY scene) AS pf FROM mx),
mw AS (SELECT movie_id, scene, 1 AS beat, 1 AS size FROM mk WHERE scene = 1 UNION ALL
 SELECT k.movie_id, k.scene, CASE WHEN x.new THEN w.beat + 1 ELSE w.beat END, CASE WHEN x.new THEN 1 ELSE w.size + 1 END
 FROM mw w JOIN mk k ON k.movie_id = w.movie_id AND k.scene = w.scene + 1,
 LATERAL (SELECT NOT (k.pf = 'SETUP' AND k.scene_function = 'SETUP' OR k.pf = 'ESCALATION' AND k.scene_function = 'ESCALATION') AND w.size >= 2 AS new) x),
bt AS (SELECT movie_id, beat, list(scene ORDER BY scene) AS scenes, list(scene_function ORDER BY scene) AS fs, flatten(list(event_indices ORDER BY scene)) AS ev, string_agg(summary, ' ' ORDER BY scene) AS description,
 list_sort(list_distinct(list(location))) AS cast_, arg_min(location, scene) AS place, max(importance) AS importance, arg_max(uncertainty, importance) AS uncertainty FROM mk JOIN mw USING (movie_id, scene) GROUP BY movie_id, beat),
bs AS (SELECT *, CASE WHEN list_contains(fs, 'ESCALATION') THEN 'Escalation' ELSE 'Passage: ' || array_to_string(fs, ', ') END AS title,
 CASE WHEN list_contains(fs, 'ESCALATION') THEN 'A dispute turns into danger.' ELSE len(scenes) || ' scenes, the first in ' || place || '.' END AS cause FROM bt)"""
)


@query(STORY + " SELECT movie_id, scene, start_seconds, end_seconds, array_to_string(event_indices, ',') AS event_indices, location AS characters, location, summary, importance, uncertainty, scene_function FROM mx")
def story_scenes(spark, sf_dir):
    s = M.scenes(_movie(spark, sf_dir)[0], GAP)
    who = F.transform("characters", lambda c: F.when(c.startswith("CHARACTER_"), None).otherwise(c))
    return s.withColumns({"event_indices": F.array_join(F.col("event_indices").cast("array<string>"), ","), "characters": F.array_join(who, ",")})


@query(
    BEATS
    + """ SELECT movie_id, beat::INTEGER AS beat, title, description, array_to_string(scenes, ',') AS supporting_scenes, array_to_string(ev, ',') AS event_indices, cause, importance, uncertainty FROM bs"""
)
def story_beats(spark, sf_dir):
    b = M.beats(M.scenes(_movie(spark, sf_dir)[0], GAP))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return b.select("movie_id", "beat", "title", "description", text("supporting_scenes"), text("event_indices"), "cause", "importance", "uncertainty")


def _planned(spark, sf_dir):
    events, characters, appearances, movies = _movie(spark, sf_dir)
    scenes_ = documents.staged(M.scenes(events, GAP), "scenes")
    heads = documents.staged(M.headers(events, movies), "headers")
    return events, scenes_, heads, M.plan(heads, documents.staged(M.beats(scenes_), "beats"), M.causal_links(events))


PLAN = (
    BEATS
    + """, hn AS (SELECT movie_id, count(*) AS n FROM tl GROUP BY movie_id),
hd AS (SELECT movie_id, round(CASE WHEN n >= 58 THEN 900.0::DOUBLE ELSE greatest(45.0::DOUBLE, least(900.0::DOUBLE * (n / 69.0::DOUBLE) * 1.25::DOUBLE, 900.0::DOUBLE)) END, 1) AS target FROM hn),
pu AS (SELECT *, CASE WHEN title = 'Escalation' THEN 'rising_action_and_crisis' WHEN list_contains(fs, 'CLIMAX') THEN 'peak_climax' WHEN list_contains(fs, 'TRANSITION') THEN 'atmospheric_transition' ELSE 'story_progression' END AS purpose, importance::DECIMAL(18,2) AS w FROM bs JOIN hd USING (movie_id)),
sh AS (SELECT *, round(greatest(10.0::DOUBLE, w::DOUBLE / sum(w) OVER (PARTITION BY movie_id)::DOUBLE * target), 1)::DECIMAL(18,1) AS share FROM pu)"""
)


@query(PLAN + """ SELECT movie_id, beat::INTEGER AS segment, purpose, CASE purpose WHEN 'rising_action_and_crisis' THEN 'moderate' WHEN 'peak_climax' THEN 'high' ELSE 'none' END AS spoiler_level, importance, uncertainty,
 (2 + len(list_filter([1, 2, 3], lambda i: list_contains(ev, i) OR list_contains(ev, i + 1))))::INTEGER AS n_points, round(share::DOUBLE * target / sum(share) OVER (PARTITION BY movie_id)::DOUBLE, 1) AS seconds FROM sh""")
def narration_plan(spark, sf_dir):
    return _planned(spark, sf_dir)[3].select("movie_id", "segment", "purpose", "spoiler_level", "importance", "uncertainty", F.size("key_points").alias("n_points"), "seconds")


@query(""" , e AS (SELECT movie_id, idx, label || ' ' || event_id AS s, lead(label || ' ' || event_id) OVER w AS t FROM tl WINDOW w AS (PARTITION BY movie_id ORDER BY idx)), h AS (SELECT movie_id FROM tl WHERE idx = 60),
r AS (SELECT movie_id, 1 AS ord, 'a long story' AS cause, 'a late event' AS effect, 'high' AS confidence, '1,60' AS evidence FROM h)
SELECT * FROM r UNION ALL SELECT movie_id, idx, s, 'Then: ' || t, 'medium', idx || ',' || (idx + 1) FROM e WHERE idx <= 3 AND t IS NOT NULL AND movie_id NOT IN (SELECT movie_id FROM r)""")
def causal_rules(spark, sf_dir):
    x = M.causal_links(_movie(spark, sf_dir)[0], [((60,), (1, 2), "a long story", "a late event", (1, 60))])
    return x.withColumn("evidence", F.array_join(F.col("evidence").cast("array<string>"), ","))


@query(""" , c AS (SELECT movie_id, label, printf('CHARACTER_%03d', row_number() OVER (PARTITION BY movie_id ORDER BY min(idx), label)) AS character_id, min(idx) AS f, arg_min(sec, idx) AS s FROM tl GROUP BY movie_id, label)
SELECT movie_id, character_id, CASE WHEN label <> 'error' THEN label END AS name, printf('First seen at %.1f s (event %d), %s: do %s.', s, f, label, label) AS introduction,
 'Uncertain circumstances' AS conflict, 'No decision recorded' AS major_decisions FROM c""")
def character_arcs(spark, sf_dir):
    a = M.arcs(*_movie(spark, sf_dir)[:3])
    return a.select("movie_id", "character_id", "name", "introduction", "conflict", F.array_join("major_decisions", ",").alias("major_decisions"))


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


SCRIPT = (
    PLAN
    + f""", ef AS (SELECT movie_id, idx, lead(label || ' ' || event_id) OVER (PARTITION BY movie_id ORDER BY idx) AS nxt FROM tl),
fl AS (SELECT s.movie_id, s.beat, arg_min(nxt, idx) AS effect FROM sh s JOIN ef e ON e.movie_id = s.movie_id AND e.idx <= 3 AND e.nxt IS NOT NULL AND (list_contains(s.ev, e.idx) OR list_contains(s.ev, e.idx + 1)) GROUP BY ALL),
te AS (SELECT movie_id, beat, string_agg('At ' || location || CASE WHEN scene_function = 'ESCALATION' THEN ' things get tense.' ELSE ' we see how they get by.' END, ' ' ORDER BY scene) AS tells FROM mx JOIN mw USING (movie_id, scene) GROUP BY ALL),
ty AS (SELECT movie_id, beat AS segment, CASE purpose {" ".join(f"WHEN '{p}' THEN {_text(t)}" for p, _, t in M.PROSE)} ELSE concat_ws(' ', CASE WHEN beat = 1 THEN 'The story opens with a hook.' ELSE 'Then the story goes deeper.' END, tells, 'This leads on: ' || lower('Then: ' || effect)) END AS text,
 list_sort(ev) AS ev, importance, false AS is_continuation FROM sh JOIN te USING (movie_id, beat) LEFT JOIN fl USING (movie_id, beat)),
sg AS (SELECT * FROM ty UNION ALL SELECT movie_id, max(segment) + 1, {_text(M.CONTINUES)}, arg_max(ev, segment), 3, true FROM ty JOIN hn USING (movie_id) WHERE n < 58 GROUP BY movie_id),
sw AS (SELECT *, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'))::INTEGER AS word_count FROM sg)"""
)
CLIPS = (
    SCRIPT
    + """, ce AS (SELECT movie_id, segment, importance, unnest(ev) AS event FROM sg WHERE NOT is_continuation),
cj AS (SELECT ce.*, t.sec, t.sig, t.label, ms.scene FROM ce JOIN tl t ON t.movie_id = ce.movie_id AND t.idx = ce.event JOIN ms ON ms.movie_id = ce.movie_id AND ms.idx = ce.event),
cf AS (SELECT * FROM cj QUALIFY sig >= 3 OR NOT bool_or(sig >= 3) OVER (PARTITION BY movie_id, segment)),
cn AS (SELECT *, count(*) OVER (PARTITION BY movie_id, segment) AS c, row_number() OVER (PARTITION BY movie_id, segment ORDER BY event) - 1 AS pos FROM cf),
ck AS (SELECT *, CASE WHEN importance >= 7 THEN CASE WHEN c <= 1 THEN 1 ELSE least(3, c) END WHEN importance >= 4 THEN least(2, c) ELSE 1 END AS k FROM cn),
co AS (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY segment, event)::INTEGER AS ord FROM ck WHERE len(list_filter(range(0, k), lambda i: (i * c) // k = pos)) > 0),
cr AS (SELECT DISTINCT movie_id, 0 AS ord, -999.0::DOUBLE AS pe, 0.0::DOUBLE AS s, 0.0::DOUBLE AS d, false AS pushed FROM co UNION ALL
 SELECT co.movie_id, co.ord, b.e1, b.s1, round(b.e1 - b.s1, 2), a.push FROM cr JOIN co ON co.movie_id = cr.movie_id AND co.ord = cr.ord + 1,
 LATERAL (SELECT greatest(0.0::DOUBLE, co.sec - 0.5) AS s0, least(2592000.0::DOUBLE, greatest(0.0::DOUBLE, co.sec - 0.5) + 3.0) AS e0, greatest(0.0::DOUBLE, co.sec - 0.5) < cr.pe + 1 AS push) a,
 LATERAL (SELECT CASE WHEN push THEN cr.pe + 2 ELSE s0 END AS s1, CASE WHEN push THEN least(2592000.0::DOUBLE, cr.pe + 2 + round(e0 - s0, 2)) ELSE e0 END AS e1) b),
cl AS (SELECT movie_id, ord, printf('CLIP_%03d', ord) AS clip_id, segment::INTEGER AS segment, event, scene, round(s, 2) AS start, round(pe, 2) AS stop, d AS duration, pushed, 'Shows: do ' || label AS reason, importance FROM cr JOIN co USING (movie_id, ord))"""
)


def _shown(freezes: int) -> str:
    return CLIPS + f""", it AS (SELECT movie_id, segment, ord, 0 AS o, 'SOURCE_CLIP' AS item_type, duration::DECIMAL(12, 2) AS dur FROM cl UNION ALL SELECT movie_id, segment, ord, 1, 'STILL_FREEZE', 1.0 FROM cl WHERE ord <= {freezes}
 UNION ALL SELECT movie_id, segment, NULL, 2, 'BLACK_TRANSITION', 0.3 FROM sg),
ix AS (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY segment, ord NULLS LAST, o) AS idx FROM it), iy AS (SELECT *, sum(dur) OVER (PARTITION BY movie_id ORDER BY idx) AS e FROM ix)"""


@query(
    BEATS
    + """, w AS (SELECT movie_id, count(*) AS events, greatest(1.0, max(sec)) AS duration FROM tl GROUP BY movie_id), o AS (SELECT movie_id, label, count(*) AS n, max(sec) - min(sec) AS span, sum(sig) AS sig, min(idx) AS f FROM tl GROUP BY ALL),
x AS (SELECT o.*, events, round(0.40::DOUBLE * n / events + 0.30::DOUBLE * round(span / duration, 3) + 0.20::DOUBLE * least(1.0::DOUBLE, sig / n / 10.0::DOUBLE) + 0.10::DOUBLE, 3) AS score FROM o JOIN w USING (movie_id)),
y AS (SELECT *, (round(score * 1000)::INTEGER + 5) // 10 AS hundredths FROM x QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY score DESC, n DESC, f) = 1),
b AS (SELECT movie_id, count(*) AS n_beats, sum(len(scenes)) AS n_scenes, string_agg('In ' || chr(39) || title || chr(39) || ', ' || description, ' ' ORDER BY beat) AS told FROM bs GROUP BY movie_id),
u AS (SELECT movie_id, 'Events that can be read in several ways: [' || string_agg(idx::VARCHAR, ', ' ORDER BY idx) || '].' AS unsure FROM tl WHERE sig >= 9 GROUP BY movie_id)
SELECT movie_id, CASE WHEN events >= 58 THEN 'COMPLETE' ELSE 'PARTIAL' END AS story_status,
 'Story of ' || chr(39) || movie_id || chr(39) || ' in order of time: scenes ' || n_scenes || ', beats ' || n_beats || ', coverage ' || CASE WHEN events >= 58 THEN 'COMPLETE' ELSE 'PARTIAL' END || '.' || chr(10) || chr(10) || told || chr(10) || chr(10)
 || printf('The lead is %s (prominence %d.%02d), seen in %d events.', label, hundredths // 100, hundredths % 100, n) AS story_summary,
 concat_ws(chr(10), CASE WHEN events < 58 THEN printf('Only a part of the movie was analysed (%d events); how it ends isn''t seen.', events) END, unsure) AS open_uncertainties FROM y JOIN b USING (movie_id) LEFT JOIN u USING (movie_id)"""
)
def story_document(spark, sf_dir):
    events, characters, appearances, movies = _movie(spark, sf_dir)
    s, heads = documents.staged(M.scenes(events, GAP), "scenes"), M.headers(events, movies)
    leads = T.prominence(timeline(spark, sf_dir)).select("movie_id", "rank", F.col("label").alias("who"), "score", "n")
    return M.story(heads, s, M.beats(s), leads, M.ambiguous(events)).withColumn("open_uncertainties", F.array_join("open_uncertainties", "\n"))


@query(SCRIPT + " SELECT movie_id, segment::INTEGER AS segment, text, word_count, round(word_count / 150.0::DOUBLE * 60.0::DOUBLE, 1) AS seconds, importance, is_continuation FROM sw")
def script_segments(spark, sf_dir):
    events, s, heads, p = _planned(spark, sf_dir)
    return M.script(documents.staged(p, "plan"), s, events, heads).select("movie_id", "segment", "text", "word_count", "seconds", "importance", "is_continuation")


def _preview(spark, sf_dir):
    events, s, heads, p = _planned(spark, sf_dir)
    text = documents.staged(M.script(documents.staged(p, "plan"), s, events, heads), "script")
    return text, documents.staged(M.clips(text, s, events, heads), "clips")


@query(CLIPS + " SELECT * FROM cl")
def clip_plan(spark, sf_dir):
    return _preview(spark, sf_dir)[1]


@query(
    _shown(2)
    + """, m AS (SELECT movie_id, count(*) FILTER (item_type = 'SOURCE_CLIP') AS clips, coalesce(sum(dur) FILTER (item_type = 'SOURCE_CLIP'), 0)::DOUBLE AS footage, coalesce(sum(dur) FILTER (item_type = 'STILL_FREEZE'), 0)::DOUBLE AS freeze,
 coalesce(sum(dur) FILTER (item_type = 'BLACK_TRANSITION'), 0)::DOUBLE AS black, sum(dur)::DOUBLE AS total, count(DISTINCT segment) AS segments, count(*) FILTER (item_type <> 'SOURCE_CLIP') AS placeholders,
 count(*) FILTER (item_type = 'STILL_FREEZE') AS freezes, count(*) FILTER (item_type = 'BLACK_TRANSITION') AS transitions, coalesce(max(dur) FILTER (item_type = 'STILL_FREEZE'), 0)::DOUBLE AS longest_freeze,
 coalesce(max(dur) FILTER (item_type = 'BLACK_TRANSITION'), 0)::DOUBLE AS longest_transition FROM it GROUP BY movie_id) SELECT *, round(footage / greatest(0.01, total) * 100, 1) AS moving_percent FROM m"""
)
def preview_manifest(spark, sf_dir):
    m = M.manifest(M.items(*_preview(spark, sf_dir), freezes=2))
    return m.withColumns({c: F.col(c).cast("double") for c, kind in m.dtypes if kind.startswith("decimal")})


@query(
    _shown(0)
    + f""", sp AS (SELECT movie_id, segment, min(e - dur)::DOUBLE AS s, max(e)::DOUBLE AS e FROM iy GROUP BY ALL),
ch AS (SELECT movie_id, segment, {_chunks("text", 14)} AS chunks, s, e, greatest(1.0::DOUBLE, e - s) AS length FROM sg JOIN sp USING (movie_id, segment)),
ct AS (SELECT *, greatest(1, list_sum(list_transform(chunks, lambda v: {_tokens("v")}))) AS total FROM ch),
cc AS (SELECT movie_id, segment, 1 AS pos, s AS start, CASE WHEN len(chunks) = 1 THEN e ELSE round(s + length * {_tokens("chunks[1]")} / total, 2) END AS stop FROM ct UNION ALL
 SELECT cc.movie_id, cc.segment, pos + 1, stop, CASE WHEN pos + 1 = len(chunks) THEN e ELSE round(stop + length * {_tokens("chunks[pos + 1]")} / total, 2) END FROM cc JOIN ct ON ct.movie_id = cc.movie_id AND ct.segment = cc.segment WHERE pos < len(chunks))
SELECT movie_id, row_number() OVER (PARTITION BY movie_id ORDER BY segment, pos)::INTEGER AS idx, start AS start_seconds, stop AS end_seconds, {_wrapped("chunks[pos]", 45)} AS text FROM cc JOIN ct USING (movie_id, segment)"""
)
def preview_captions(spark, sf_dir):
    text, c = _preview(spark, sf_dir)
    return M.captions(text, M.items(text, c))


@query(""" , f AS (SELECT p_partkey AS k, p_size AS n FROM part)
SELECT k, CASE WHEN n % 4 = 0 THEN 0.0 WHEN n % 4 = 1 THEN round(n * 1000 / 1001.0::DOUBLE, 3) WHEN n % 4 = 2 THEN n::DOUBLE ELSE 0.0 END AS fps, CASE WHEN n % 2 = 0 THEN 'en' ELSE 'und' END AS language,
 CASE WHEN n % 2 = 0 THEN 'female' WHEN n % 3 = 0 THEN 'male' ELSE 'unknown' END AS gender, CASE WHEN n % 2 = 0 THEN n ELSE 1280 END::INTEGER AS width, CASE WHEN n % 2 = 0 THEN 2 * n ELSE 720 END::INTEGER AS height,
 CASE WHEN n % 3 = 0 THEN 'Ann ' || n END AS speaker, CASE WHEN n % 2 = 0 THEN n ELSE -1 END::INTEGER AS cast_ FROM f""")
def media_scalars(spark, sf_dir):
    n, text = F.col("n"), F.col("n").cast("string")
    rate = F.when(n % 4 == 0, F.concat(text, F.lit("/0"))).when(n % 4 == 1, F.concat((n * 1000).cast("string"), F.lit("/1001"))).when(n % 4 == 2, text).otherwise("junk")
    even, third = n % 2 == 0, n % 3 == 0
    size = S.resolution(F.when(even, F.concat(text, F.lit("X"), (2 * n).cast("string"))).otherwise("wide"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("n")).select(
        "k", S.parse_fps(rate).alias("fps"), S.filename_language(F.when(even, "Movie.EN.srt").otherwise("Movie.srt")).alias("language"),
        S.gender(F.when(even, "Tall Woman").when(third, "old man").otherwise("PERSON_A")).alias("gender"), size["width"].alias("width"), size["height"].alias("height"),
        S.vtt_speaker(F.when(third, F.concat(F.lit("<v.loud Ann "), text, F.lit(">Hi"))).otherwise("Hi")).alias("speaker"), S.safe_cast(F.when(even, text).otherwise("x"), "int", -1).alias("cast_"),
    )


def _norm(x: str) -> str:
    cases = " ".join(f"WHEN {' OR '.join(f"contains(lower(trim({x})), '{w}')" for w in words)} THEN '{place}'" for words, place in S.LOCATION_RULES)
    return f"CASE WHEN trim(coalesce({x}, '')) = '' THEN 'unspecified setting' {cases} ELSE trim({x}) END"


def _said_words(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '[\\p{{L}}\\p{{N}}_]+')"


@query(
    f""" , c AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM conversations), w AS (SELECT *, {_said_words("text")} AS a, {_said_words("before")} AS b FROM c)
SELECT conv_id, turn, {_norm("text")} AS place, {_norm("text")} = {_norm("before")} OR list_has_any(list_filter(a, lambda x: x NOT IN {tuple(S.PLAIN_WORDS)}), b) OR (list_has_any(a, {S.WATER_WORDS}) AND list_has_any(b, {S.WATER_WORDS})) AS compatible FROM w"""
)
def location_rules(spark, sf_dir):
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy(*[F.asc_nulls_last(c) for c in ("turn", "role", "text")]))
    c = table(spark, sf_dir, "conversations").withColumn("before", before)
    return c.select("conv_id", "turn", S.normalize_location(F.col("text")).alias("place"), S.compatible_locations(F.col("text"), F.col("before")).alias("compatible"))


@query(""" , w AS (SELECT movie_id, count(*) AS total, max(sec) AS d FROM tl GROUP BY movie_id), o AS (SELECT movie_id, label, count(*) AS n, max(sec) - min(sec) AS span, avg(sig) AS sig FROM tl GROUP BY ALL)
SELECT movie_id, label, printf('%s: in %d of %d events over %.1f s, %.1f%% of the time on screen, mean significance %.1f.', CASE WHEN label = 'error' THEN 'Unnamed character' ELSE chr(39) || label || chr(39) END, n, total, round(span, 1), round(round(span / d, 3) * 100, 1), round(sig, 1)) AS rationale FROM o JOIN w USING (movie_id)""")
def lead_rationale(spark, sf_dir):
    p = T.prominence(timeline(spark, sf_dir))
    name = F.when(F.col("label") != "error", F.col("label"))
    return p.select("movie_id", "label", S.rationale(name, F.col("n"), F.col("events"), F.col("span"), F.col("screen_ratio"), F.col("sig") / F.col("k")).alias("rationale"))


@query(""" , c AS (SELECT movie_id, idx, label, string_agg('- ' || label, chr(10)) OVER (PARTITION BY movie_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS b FROM tl)
SELECT movie_id, idx, 'Time: ' || idx || chr(10) || 'Dialogue:' || chr(10) || CASE WHEN label = 'error' THEN 'No dialogue.' ELSE '- ' || label END || chr(10) || 'Before:' || chr(10) || coalesce(b, 'Nothing yet.') AS prompt FROM c""")
def frame_prompt(spark, sf_dir):
    t = T.rolling_context(timeline(spark, sf_dir), "label", 6)
    said = F.when(F.col("label") != "error", F.array("label")).otherwise(F.array().cast("array<string>"))
    return t.select("movie_id", "idx", S.prompt(F.col("idx").cast("string"), said, F.col("context")).alias("prompt"))


@query(
    _shown(0)
    + """, h AS (SELECT movie_id, count(*) AS n_events, count(DISTINCT label) AS n_characters, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (label <> 'error') AS named FROM tl GROUP BY movie_id)
SELECT movie_id, 'SUCCESS' AS status, n_events, n_characters, coalesce(named, '') AS named, 0::BIGINT AS n_merges, NULL::VARCHAR AS error, (SELECT count(*) FROM mx WHERE mx.movie_id = h.movie_id) AS n_scenes, (SELECT count(*) FROM cl WHERE cl.movie_id = h.movie_id) AS n_clips,
 (SELECT max(e)::DOUBLE FROM iy WHERE iy.movie_id = h.movie_id) AS seconds FROM h"""
)
def pipeline_summary(spark, sf_dir):
    events, s, heads, p = _planned(spark, sf_dir)
    text = documents.staged(M.script(documents.staged(p, "plan"), s, events, heads), "script")
    c = documents.staged(M.clips(text, s, events, heads), "clips")
    characters = T.identities(timeline(spark, sf_dir)).select("movie_id", F.when(F.col("label") != "error", F.col("label")).alias("name"))
    return M.summary(heads, characters, s, c, M.items(text, c)).withColumn("named", F.array_join("named", ","))


@query(""" , k AS (SELECT l_orderkey, idx, l_linenumber, CASE l_partkey % 6 WHEN 0 THEN 'SubRip' WHEN 1 THEN 'hdmv_pgs_subtitle' WHEN 2 THEN 'ass' WHEN 3 THEN 'dvd_subtitle' WHEN 4 THEN 'mov_text' ELSE 'webvtt' END AS codec,
 CASE l_suppkey % 5 WHEN 0 THEN 'fra' WHEN 1 THEN 'en-GB' WHEN 2 THEN 'msa' WHEN 4 THEN 'zho' END AS lang, l_returnflag = 'R' AND l_quantity > 40 AS def, l_orderkey % 10 AS d FROM li),
r AS (SELECT *, CASE WHEN d = 0 THEN CASE WHEN l_linenumber = 2 THEN 1 END WHEN codec IN ('hdmv_pgs_subtitle', 'dvd_subtitle') THEN NULL WHEN d = 1 AND lang = 'fra' THEN 2 WHEN def THEN 3 WHEN lang IN ('en-GB', 'msa', 'zho') THEN 4 ELSE 5 END AS rule FROM k)
SELECT l_orderkey AS movie_id, rule, l_linenumber AS stream_index, codec AS codec_name, lang AS language FROM r WHERE rule IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY rule, CASE WHEN rule = 4 THEN CASE lang WHEN 'en-GB' THEN 1 WHEN 'msa' THEN 2 ELSE 4 END ELSE 0 END, idx) = 1""")
def subtitle_track_choice(spark, sf_dir):
    kind, of = F.col("l_partkey") % 6, F.col("l_suppkey") % 5
    codec = reduce(lambda c, x: c.when(kind == x[0], x[1]), enumerate(["SubRip", "hdmv_pgs_subtitle", "ass", "dvd_subtitle", "mov_text"]), F.when(F.lit(False), "")).otherwise("webvtt")
    language = F.when(of == 0, "fra").when(of == 1, "en-GB").when(of == 2, "msa").when(of == 4, "zho")
    tracks = lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("movie_id"), F.col("idx").alias("pos"), F.col("l_linenumber").alias("stream_index"), codec.alias("codec_name"), language.alias("language"),
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40)).alias("is_default"), (F.col("l_orderkey") % 10).alias("d"),
    )
    return media.choose_subtitle(tracks, ["movie_id"], F.when(F.col("d") == 0, 2), F.when(F.col("d") == 1, " FRA ")).select("movie_id", "rule", "stream_index", "codec_name", "language")


def _evidence_sql() -> str:
    text = " || ".join(f"regexp_extract_all(text, '{p.replace(chr(39), chr(39) * 2)}', 1)" for p in S.NAME_PATTERNS)
    bad = ", ".join(f"'{w}'" for w in S.NO_NAMES)
    name = f"CASE WHEN len(x) > 1 AND x[1] IN ({bad}) THEN array_to_string(x[2:], ' ') ELSE array_to_string(x, ' ') END"
    each = f"lambda x: CASE WHEN length({name}) >= 3 AND {name} NOT IN ({bad}) THEN CASE WHEN len(x) > 1 AND x[-1] NOT IN ({bad}) THEN [{name}, x[-1]] ELSE [{name}] END ELSE []::VARCHAR[] END"
    return f""" , n AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text)::INTEGER AS idx, turn, role, coalesce(text, '') AS text FROM conversations),
 f AS (SELECT *, list_transform({text}, lambda x: regexp_split_to_array(trim(x, ' \t\n\r'), '\\s+')) AS found FROM n),
 e AS (SELECT conv_id, idx, turn, role, text, [{{'text': '[Speaker Tag: ' || role || '] ' || text, 'name': role, 'c': 0.9::DOUBLE}}] || list_transform(flatten(list_transform(found, {each})), lambda y: {{'text': text, 'name': y, 'c': 0.8::DOUBLE}}) AS x FROM f),
 u AS (SELECT conv_id, idx, turn, role, unnest(range(len(x))) AS place, x FROM e), v AS (SELECT conv_id, idx, turn, role, place, x[place + 1].text AS text, x[place + 1].name AS candidate, x[place + 1].c AS confidence FROM u)
SELECT conv_id AS movie_id, idx, role AS label, place::INTEGER AS place, turn::DOUBLE AS sec, text, candidate, confidence FROM v QUALIFY row_number() OVER (PARTITION BY conv_id, role, text, candidate ORDER BY idx, place) = 1"""


@query(_evidence_sql())
def name_evidence(spark, sf_dir):
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    line = F.array(F.struct(F.col("turn").cast("double").alias("start_seconds"), F.coalesce("text", F.lit("")).alias("text"), F.col("role").alias("speaker")))
    events = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("movie_id"), n.alias("idx"), F.col("turn").cast("double").alias("sec"), F.array("role").alias("labels"), line.alias("dialogue"))
    return D.name_evidence(events).select("movie_id", "idx", "label", F.col("at").alias("place"), "sec", "text", "candidate", "confidence")


@query(""" , k AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events), l AS (SELECT event_id, CASE WHEN k % 3 > 0 THEN [event_type] ELSE list_transform(range(0, k % 4), lambda i: 'PERSON_' || chr((65 + i)::INTEGER)) END AS l FROM k)
SELECT event_id, array_to_string(l, ',') AS labels FROM l WHERE len(l) > 0""")
def labels_of_people(spark, sf_dir):
    k = documents.field(F.col("props"), "$.k", "int", 0)
    e = table(spark, sf_dir, "events").select("event_id", (k % 4).alias("people_count"), F.when(k % 3 > 0, F.array("event_type")).alias("labels"))
    return D.seen(e).select("event_id", F.array_join("labels", ",").alias("labels"))


@query(""" , m AS (SELECT event_id, ts, epoch_us(ts) AS us FROM events)
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN us % 1000000 <> 0 THEN printf('.%06d', us % 1000000) ELSE '' END || '+00:00' AS iso, us AS back FROM m""")
def iso_times(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", S.iso_time(F.col("ts").cast("timestamp")).alias("iso"))
    return e.withColumn("back", F.unix_micros(S.parse_iso(F.col("iso"))))


@query(" SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_digests(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.digest(F.col("text")).alias("sha256"))


@query(SCRIPT + """ SELECT sw.movie_id, CASE WHEN any_value(n) >= 58 THEN 'COMPLETE' ELSE 'PARTIAL' END AS status, any_value(target) AS target_seconds, sum(round(word_count / 150.0::DOUBLE * 60.0::DOUBLE, 1)::DECIMAL(18, 1))::DOUBLE AS estimated_seconds,
 sum(word_count)::BIGINT AS total_words, count(*) AS segments, string_agg(text, chr(10) || chr(10) ORDER BY segment) AS full_script FROM sw JOIN hn USING (movie_id) JOIN hd USING (movie_id) GROUP BY sw.movie_id""")
def script_totals(spark, sf_dir):
    events, s, heads, p = _planned(spark, sf_dir)
    return M.script_totals(M.script(documents.staged(p, "plan"), s, events, heads), heads).drop("warnings", "words_per_minute")


@query(CLIPS + """, g AS (SELECT *, start - lag(stop) OVER w AS gap, lag(start) OVER w - start AS back, NOT pushed AND NOT coalesce(lag(pushed) OVER w, false) AS free FROM cl WINDOW w AS (PARTITION BY movie_id ORDER BY ord)),
v AS (SELECT movie_id, count(*) AS n, sum(duration::DECIMAL(18, 2))::DOUBLE AS s, sum((duration <= 0)::INT + (duration > 3.01)::INT + (stop <= start)::INT + (abs(duration - round(stop - start, 2)) > 0.15)::INT + (stop > 2592001)::INT + coalesce((gap < 0)::INT, 0) + coalesce((gap >= 0 AND gap < 0.5 AND free)::INT, 0))::BIGINT AS errors,
 sum(coalesce((gap >= 0.5 AND gap < 5 AND free)::INT, 0) + coalesce((back > 5)::INT, 0))::BIGINT AS warnings FROM g GROUP BY movie_id)
SELECT h.movie_id, coalesce(x.n, 0) AS total_clips, coalesce(s, 0.0) AS total_seconds, coalesce(errors, 0) AS errors, coalesce(warnings, 0) AS warnings, coalesce(errors, 0) = 0 AS valid FROM hn h LEFT JOIN v x ON x.movie_id = h.movie_id""")
def clip_totals(spark, sf_dir):
    events, s, heads, p = _planned(spark, sf_dir)
    c = documents.staged(M.clips(documents.staged(M.script(documents.staged(p, "plan"), s, events, heads), "script"), s, events, heads), "clips")
    totals = M.clip_totals(c, heads)
    return totals.select("movie_id", "total_clips", "total_seconds").join(T.validate_plans(totals, T.validate_clips(M.to_validate(c, heads))), "movie_id")
