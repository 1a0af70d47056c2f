"""Corpus pipeline: quality, exact and near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of ``documents``, whatever these are, beside those that the stage reads. No rows give no rows.
"""

from tempograph.llm.common import drop, stored, table
from tempograph.llm.exact_dedup import drop_exact
from tempograph.llm.near_dedup import drop_near
from tempograph.llm.packing import pack
from tempograph.llm.pii import redact
from tempograph.llm.quality import keep_quality

#: A trained network and sketches decide here, so SQL can't express the result.
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    """Documents that the classifier rejects go. A null text counts as empty; rows of one text go or stay together, ids don't matter."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact(spark, docs, sf_dir):
    """Of equal texts, null ones being empty, the row with the largest id stays; a null id only where there is no other. Of repeated rows one stays."""
    return drop_exact(docs)


def near(spark, docs, sf_dir):
    """Of each group of near copies (five words, similarity 0.8), the document with the smallest id stays. Rows without words stay, and those without an id, but for copies of other rows."""
    return drop_near(docs)


def private(spark, docs, sf_dir):
    """Personal data is replaced by its kind. Null texts stay null, repeated rows repeat, null ids stay."""
    return redact(docs)


def packed(spark, docs, sf_dir):
    """Pieces of sequences of 1024 tokens. A null or empty text is one id; repeated rows are packed each by itself, null ids stay null."""
    return pack(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("pii", private), ("packing", packed)]


def run(spark, sf_dir):
    """Each stage's result is stored, and removed once the next one's is; the last is read by the result."""
    docs, kept = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop(*kept)
        kept = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
