"""License scans: base places by hand, fuzzy notices against edit distance."""

import random
import re

from vacancia.llm import license_scan
from vacancia.llm.license_scan import NOTICES, PHRASES, Scanner

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    None, "", " ", "CC BY", "cc-by cc by; cC\nBy!", "ccc by cc byy", "all rights all rights reserved", "GNU General Public License v3",
    "Licenced under the Apache Licence, Version 2.0.", "Permision is hereby granted, free of charg, to", "cc\x7fby é cc by", "cc 漢 by", "x" * 4000,
    "All Rights Reserved. " * 300, "general public\tlicense general-public-license", "unrelated words only here",
]


def base(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_base_columns(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t), t
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    assert "apache" in got[8].labels and got[8].score < 1 and "mit" in got[9].labels and got[15].labels == ""
    for s in got[8].spans:
        assert WORD.findall(TEXTS[8].lower())[s.start:s.stop] == s.found.split()


def test_notices_with_edits_are_found_and_others_not():
    rng, scanner = random.Random(3), Scanner(PHRASES, NOTICES)
    for _ in range(300):
        notice, label, allowed = rng.choice(NOTICES)
        edited = list(notice)
        for _ in range(rng.randint(0, allowed)):
            k = rng.randrange(1, len(edited) - 1)
            edited[k:k + 1] = rng.choice([[], ["q"], [edited[k], "q"]])
        edited = " ".join("".join(edited).split())
        if distance(edited, notice) <= allowed:
            found = scanner.fuzzy(f"some words {edited} and more")
            assert label in {f[0] for f in found}, (notice, edited)
    text = " ".join(rng.choice(["public", "license", "rights", "under", "the", "free", "x"]) for _ in range(3000))
    for label, a, b, edits, matched, k in scanner.fuzzy(text):
        assert text[a:b] == matched and distance(matched, NOTICES[k][0]) <= NOTICES[k][2]


def test_odd_rows(spark, odd):
    assert license_scan.scan(odd).count() == odd.count()
    assert license_scan.scan(odd.limit(0)).collect() == []


def test_notices_that_follow_each_other_all_have_spans():
    scanner = license_scan.Scanner(dict(license_scan.PHRASES), license_scan.NOTICES)
    spans = scanner.scan("all right reserved all rights reserved x all rights reservd")[-1]
    assert [(s["start"], s["stop"], s["edits"]) for s in spans if s["label"] == "reserved"] == [(0, 3, 1), (3, 6, 0), (7, 10, 1)]
