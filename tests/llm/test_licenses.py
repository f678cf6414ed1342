"""Licence scan against brute force and edited templates."""

import random
import re

from encore.llm import licenses
from util import ODD, docs, rows, table

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]


def brute(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split(" ")
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_equals_brute_force(spark):
    rng = random.Random(4)
    pieces = ["mit", "MIT ", "license", "License", " ", "-", "apache", "general", "public", "é", "x9", "\n", "general public license "]
    given = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(200)]
    given += [(1000 + r["doc_id"], r["text"]) for r in table("documents")] + ODD
    found = rows(licenses.scan(docs(spark, given, extra=True)).select(*COLUMNS))
    assert found == sorted(((i, *brute(t)) for i, t in given), key=repr)


def test_templates_whole_edited_and_foreign(spark):
    rng = random.Random(5)
    given, wanted = [], {}
    for n, (label, text) in enumerate(licenses.TEMPLATES.items()):
        words = text.split(" ")
        around = [f"w{i}" for i in range(30)]
        given.append((3 * n, " ".join(around + words + around)))
        edited = list(words)
        edited.insert(len(words) // 2, "really")
        del edited[len(words) // 4]
        given.append((3 * n + 1, " ".join(around + edited)))
        shuffled = words[:]
        rng.shuffle(shuffled)
        given.append((3 * n + 2, " ".join(shuffled)))
        wanted |= {3 * n: label, 3 * n + 1: label}
    for r in licenses.scan(docs(spark, given)).collect():
        if r["doc_id"] in wanted:
            label = wanted[r["doc_id"]]
            assert label in r["labels"].split(",")
            assert any(s["label"] == label and s["start"] >= 28 for s in r["spans"]) and r["score"] >= 0.5
            if r["doc_id"] % 3 == 0:
                assert r["score"] == 1.0
        else:
            assert not r["spans"]


def test_empty_table_and_native_plan(spark):
    assert licenses.scan(docs(spark, [])).count() == 0
    plan = licenses.scan(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
