"""Places of regular expressions in texts, as SQL expressions, linear in the number of matches but for blocks of ``BLOCK``.

Spark copies an array to append to it, so a fold that appends is quadratic. ``running`` folds blocks of
``BLOCK`` values and then the blocks' totals. All take and give SQL texts: parsed in one go, they cost no
calls between Python and the JVM for each of their hundreds of nodes. Names of lambda variables differ by helper.
"""

from __future__ import annotations

from collections.abc import Callable

SPANS = "array<struct<start:int,end:int,m:string>>"
BLOCK = 64
#: Characters of a piece of text in which places are looked up.
PIECE = 1024
FAR = 1 << 30
EMPTY = f"cast(array() as {SPANS})"


def quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``value``, made once, as ``name``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def running(values: str, combine: Callable[[str, str], str], zero: int) -> str:
    """Of each value the combination of those before it; ``combine`` is associative and ``zero`` its neutral element."""
    fold = lambda x, first: f"aggregate({x}, array({first}), (acc, y) -> array_append(acc, {combine('element_at(acc, -1)', 'y')}))"
    blocks = f"transform(sequence(0, cast(floor((size(v) - 1) / {BLOCK}) as int)), b -> slice(v, b * {BLOCK} + 1, {BLOCK}))"
    totals = f"transform(bs, x -> aggregate(x, {zero}, (t, y) -> {combine('t', 'y')}))"
    each = f"flatten(transform(bs, (x, i) -> slice({fold('x', 'get(bases, i)')}, 1, size(x))))"
    return let(values, "v", f"if(size(v) > 0, {let(blocks, 'bs', let(fold(totals, str(zero)), 'bases', each))}, cast(array() as array<int>))")


def find(text: str, pattern: str, gate: str = "true") -> str:
    """Leftmost non-overlapping matches as (start, end, m), in code points, end exclusive; none where ``gate`` isn't true.

    What lies between the matches comes from ``split`` and the matches from ``regexp_extract_all``, so the
    places are running sums of their lengths.
    """
    p = quoted(pattern)
    parts = f"arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0))"
    before = running("transform(parts, z -> length(z['0']) + coalesce(length(z['1']), 0))", lambda a, b: f"{a} + {b}", 0)
    span = "named_struct('start', get(at, k) + length(z['0']), 'end', get(at, k) + length(z['0']) + length(z['1']), 'm', z['1'])"
    return f"if({gate} and {text} rlike {p}, {let(parts, 'parts', let(before, 'at', f'''transform(filter(parts, z -> z['1'] is not null), (z, k) -> {span})'''))}, {EMPTY})"


def kept(spans: str, condition: str) -> str:
    """The spans ``s`` that meet a condition."""
    return f"filter({spans}, s -> {condition})"


def named(kind: str, order: int, spans: str) -> str:
    return f"transform({spans}, s -> named_struct('start', s.start, 'order', {order}, 'end', s.end, 'kind', '{kind}'))"


def written(spans: str) -> str:
    """kind:start:end, comma-joined."""
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, cast(s.start as string), cast(s.end as string))), ',')"


def reach(spans: str) -> str:
    """Of each span the largest end of those before it."""
    return running(f"transform({spans}, s -> s.end)", lambda a, b: f"greatest({a}, {b})", 0)


def apart(spans: str, others: str) -> str:
    """The spans, in ascending order, that overlap none of the others, by one sort and a scan from either side."""
    most = lambda a, b: f"greatest({a}, {b})"
    event = lambda of, mine: f"transform({of}, (s, i) -> named_struct('start', s.start, 'mine', {mine}, 'end', s.end, 'i', i))"
    ends = running("transform(ev, e -> if(e.mine, 0, e.end))", most, 0)
    starts = f"reverse({running(f'reverse(transform(ev, e -> if(e.mine, -{FAR}, -e.start)))', most, -FAR)})"
    free = "e.mine and get(past, j) <= e.start and -get(next, j) >= e.end"
    free = let(ends, "past", let(starts, "next", f"filter(transform(ev, (e, j) -> if({free}, get(own, e.i), null)), s -> s is not null)"))
    several = let(f"array_sort(concat({event('own', 'true')}, {event('oth', 'false')}))", "ev", free)
    return let(spans, "own", let(others, "oth", f"if(size(own) > 0 and size(oth) > 0, {several}, own)"))


def replaced(text: str, spans: str, by: str) -> str:
    """The text with each of the ascending spans ``s`` replaced by ``by``; what overlaps an earlier one goes with it.

    Texts between spans come from pieces of ``PIECE`` characters, since ``substring`` walks from the beginning.
    """
    heads = f"filter(transform(sp, (s, j) -> if(s.start >= get(past, j), named_struct('f', get(past, j), 't', s.start, 'by', {by}), null)), h -> h is not null)"
    last = f"array(named_struct('f', array_max(transform(sp, s -> s.end)), 't', length({text}), 'by', ''))"
    div = lambda x: f"cast(floor({x} / {PIECE}) as int)"
    piece = f"substring(array_join(slice(pieces, {div('h.f')} + 1, {div('h.t')} - {div('h.f')} + 1), ''), h.f % {PIECE} + 1, h.t - h.f)"
    rebuilt = let(f"regexp_extract_all({text}, '(?s).{{1,{PIECE}}}', 0)", "pieces", f"array_join(transform(concat({heads}, {last}), h -> concat({piece}, h.by)), '')")
    return let(spans, "sp", f"if(size(sp) > 0, {let(reach('sp'), 'past', rebuilt)}, {text})")


def digits(m: str) -> str:
    return f"length(regexp_replace({m}, '[^0-9]', ''))"
