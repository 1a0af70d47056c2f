"""Discovered identifiers don't depend on how often texts are repeated."""

import pytest

from tempograph.llm import pii

ROWS = [(k, f"x{k} badge: u{k}@x.org y") for k in range(20)] + [(50, "z badge: ID-778812 w"), (51, "z other ID-778813 w")]


@pytest.mark.parametrize("more", [[(i + 100, t) for i, t in ROWS], [(k, ROWS[20][1]) for k in range(100, 1100)], [(k, "no badge: today") for k in range(100, 1100)]], ids=["all twice", "one instance", "one other text"])
def test_copies_leave_discovered_spans(spark, more):
    got = {r["doc_id"]: r["spans"] for r in pii.scan_pii(spark.createDataFrame(ROWS + more, "doc_id long, text string")).collect()}
    assert got[50] == "other:9:18" and got[51] == ""
    again = {i: next(j for j, t in ROWS if t == x) for i, x in more if "today" not in x}
    assert all(got[i] == got[j] for i, j in again.items())


def test_words_in_other_contexts_lower_trust(spark):
    """Each distinct token after the word counts, where an entity follows it elsewhere too."""
    rows = ROWS + [(k, f"a badge: word{k} b") for k in range(100, 120)]
    assert {r["spans"] for r in pii.scan_pii(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 50").collect()} == {""}
    phones = [(k, f"badge: +1 555 123 40{k:02d}") for k in range(20)] + [(50, "z badge: ID-778812 w"), (60, "badge: +1"), (61, "badge:")]
    frame = spark.createDataFrame(phones, "doc_id long, text string")
    patterns = spark.createDataFrame([("< badge:",)], "pattern string")
    assert pii._contexts(frame, patterns).collect()[0]["contexts"] == 20 + 1 + 1


def test_discovered_instances_induce_patterns(spark):
    """Ids that the word before gives away are followed by a word that gives away others, in the next round."""
    rows = [(k, f"x{k} badge: u{k}@x.org y{k}") for k in range(80)]
    rows += [(100 + k, f"z{k} badge: ID-7788{k:02d} issued") for k in range(30)] + [(200, "they say ID-990011 issued"), (201, "they say ID-990012 today")]
    got = {r["doc_id"]: r["spans"] for r in pii.scan_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("other:" in got[100 + k] for k in range(30))
    assert got[200] == "other:9:18" and got[201] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean[200] == "they say [OTHER] issued" and clean[201] == rows[-1][1] and clean[3] == "x3 badge: [EMAIL] y3"


def test_long_identifiers_and_both_sides(spark):
    """Identifiers of any length; a pattern of the words on both sides where neither alone is enough."""
    long = "A" * 300 + "-" + "7" * 300
    rows = [(k, f"w ref {k}@x.org ends") for k in range(12)] + [(50, f"w ref {long} ends"), *[(60 + k, f"a ref plain{chr(97 + k)} other") for k in range(20)], *[(90 + k, f"a some plain{chr(97 + k)} ends") for k in range(20)]]
    got = {r["doc_id"]: r["spans"] for r in pii.scan_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == f"other:6:{6 + len(long)}"


def test_offsets_behind_letters_that_lower_case_lengthens(spark):
    dotted = "\u0130" * 8
    rows = [(k, f"x{k} badge: u{k}@x.org y") for k in range(20)] + [(50, f"{dotted}z badge: ID-778812 w")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["spans"] for r in pii.scan_pii(frame).collect()}[50] == "other:17:26"
    assert {r["doc_id"]: r["text"] for r in pii.redact(frame).collect()}[50] == f"{dotted}z badge: [OTHER] w"


def test_chain_of_many_rounds(spark):
    """Each group of ids tips the next pattern over its trust, round after round, to the last."""
    levels, n = 14, iter(range(10**6))
    said = lambda k, what: (m := next(n), f"t{m} key{k}: {what} y{m}")
    ids = lambda j: [f"ID-{j:02d}{i}00{i}" for i in range(3)]
    rows = [said(0, f"s{i}@x.org") for i in range(20)] + [said(k, f"u{k}x{i}@x.org") for k in range(1, levels) for i in range(12)]
    rows += [said(k, x) for j in range(1, levels + 1) for k in (j - 1, j) if k < levels for x in ids(j)]
    got = {r["doc_id"]: r["spans"] for r in pii.scan_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("other:" in got[m] for m, t in rows if "ID-" in t)
