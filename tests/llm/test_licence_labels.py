"""Labels of whole notices, by brute force over all templates and places."""

import re

from tempograph.llm import license_scan as scan


def test_labels_by_brute_force(spark):
    texts = [f"{'x ' * k}{notice}. Some other words; {notice[: len(notice) // 2]}" for k, (_, notice, _) in enumerate(scan.NOTICES)]
    texts += [" ".join(n for _, n, _ in scan.NOTICES), "Mozilla Public License", "This work is licensed under the GNU General Public License, version 3.", "licensed under CC BY-SA and CC BY-NC 4.0", "the the mit license under mit license under the mit license", None, ""]
    got = {r["doc_id"]: r for r in scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, text in enumerate(texts):
        words = re.findall(scan.WORD, (text or "").lower())
        fits = lambda t, at: all(0 <= at + j < len(words) and words[at + j] == t["words"][j] for j in t["must"])
        want = {t["label"] for t in scan._templates() for at in range(-len(t["words"]), len(words)) if fits(t, at)}
        assert got[k]["labels"] == ",".join(sorted(want)) and got[k]["n_words"] == len(words)
    assert all(scan.NOTICES[k][0] in got[k]["labels"] and got[k]["score"] > 0.99 for k in range(len(scan.NOTICES)))
