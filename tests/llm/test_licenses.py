"""License scans: the base result against a plain search, notices with changed words, and what is left alone."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.llm import licenses

SCHEMA = "doc_id long, text string, digest string, n_words string"
NOTICE = dict((text, label) for label, text in licenses.NOTICES)


def words(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def brute(text):
    """n_words, n_base, first_word, last_word, base_labels, labels, score; votes counted diagonal by diagonal."""
    w, starts, base, labels, score = words(text), [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        starts += at
        if at:
            base.add(label)
            score = 1.0
    for label, text_ in licenses.NOTICES:
        t = text_.split()
        n = len(t) - 1
        votes = {}
        for j in range(n):
            for i in range(len(w) - 1):
                if w[i:i + 2] == t[j:j + 2]:
                    votes.setdefault(i - j, set()).add((i, j))
        for d in votes:
            near = set().union(*(votes.get(d + s, ()) for s in range(-licenses.SLACK, licenses.SLACK + 1)))
            share = len({j for _, j in near}) / n
            cover = licenses.COVER if n >= licenses.WHOLE else 1
            span = max(i for i, _ in near) + 2 - min(i for i, _ in near)
            if share >= cover and span <= 1.5 * len(t):
                labels.add(label)
                score = max(score, share)
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), score)


def rows():
    r = random.Random(4)
    mit = next(t for t, lab in NOTICE.items() if lab == "mit" and "granted" in t)
    apache = next(t for t, lab in NOTICE.items() if lab == "apache" and "unless" in t)
    filler = lambda n: " ".join(r.choice(["of", "the", "license", "cc", "by", "this", "all", "is", "été", "rights"]) for _ in range(n))
    texts = [None, "", "  ", "cc", "CC BY", "cc-by", "CC-BY-SA 4.0", "cc by cc by by", "All Rights  Reserved. all rights reserved",
             "ALL RİGHTS RESERVED", "Kcc by", "all rightsK reserved", "the GNU General Public License, version 3", "general public\x00license",
             f"{filler(30)} {mit.capitalize()}. {filler(30)}", mit.replace("any person", "any other good person").replace("associated ", ""),
             mit[:40], filler(20000) + " " + apache.replace("express", "explicit") + " " + filler(20),
             " ".join(reversed(mit.split())), (mit + " ") * 3, "Licensed under CC BY-NC 4.0.", "Released under the MIT License.",
             "Licensed under the Apache License, Version 2.0."]
    texts += [filler(r.randint(1, 300)) for _ in range(25)]
    out = [(i, t) for i, t in enumerate(texts)]
    return out + [out[8], out[8], out[14], (None, texts[14]), (None, texts[4]), (None, None), (3, "all rights reserved")] + [(77, "cc by cc by")] * 200


def test_scan_equals_brute_force(spark):
    given = rows()
    docs = spark.createDataFrame([(*x, "d", "n") for x in given], SCHEMA).repartition(5)
    got = Counter(tuple(r) for r in licenses.scan(docs).collect())
    assert got == Counter((i, *brute(t)) for i, t in given)
    labels = {r.doc_id: r.labels for r in licenses.scan(docs.filter("doc_id between 14 and 22"), phrases=()).collect()}
    assert labels == {14: "mit", 15: "mit", 16: "", 17: "apache", 18: "", 19: "mit", 20: "cc-by-nc", 21: "mit", 22: "apache"}


def test_plan_is_native_and_table_may_be_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    found = licenses.scan(docs)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD", "Cartesian", "NestedLoop")) or "Scan ExistingRDD" in plan


def test_templates_are_bounded(spark):
    with pytest.raises(ValueError):
        licenses.scan(spark.createDataFrame([(1, "x", "", "")], SCHEMA), phrases=(("single", "x"),))
    with pytest.raises(ValueError):
        licenses.scan(spark.createDataFrame([(1, "x", "", "")], SCHEMA), notices=[("x", "a b " * 40)])
