"""Language identification: held-out accuracy, and that labels do not leak."""

from pyspark.sql import functions as F

from encore.llm import langid
from encore.llm.queries import op3_language_id
from util import ODD, docs, rows, table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_folds(spark):
    import zlib

    import duckdb

    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    found = op3_language_id(spark, SF).collect()
    assert len(found) == len(langs)
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_held_out_rows_teach_nothing(spark, tmp_path):
    given = docs(spark, [(r["doc_id"], r["text"], r["lang"]) for r in table("documents")])
    changed = given.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang"))).withColumn(
        "source", F.lit("other")
    )
    for name, frame in (("a", given), ("b", changed)):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    first, second = (rows(op3_language_id(spark, f"{tmp_path}/{n}")) for n in "ab")
    assert first == second


def test_backing_off_to_shorter_grams():
    import numpy as np

    model = langid.Model(["a", "b"], {"the": np.array([-1.0, -9.0])}, {"<qu": np.array([-2.0, -1.0]), "x": np.array([-3.0, -4.0])})
    assert model.score("the").tolist() == [-1.0, -9.0]
    assert model.score("qux").tolist() == [-2.5, -2.5]  # "<qu", then "x"
    assert model.score("zzz").tolist() == [0.0, 0.0]


def test_odd_rows(spark):
    labelled = docs(spark, [(1, "the house and the tree", "en"), (2, "das Haus und der Baum", "de"), (3, None, "fr"), (4, "x", None)])
    frame = docs(spark, [*ODD, (50, "123 ... 7"), (51, "das Haus")], extra=True)
    found = langid.identify(frame, labelled).collect()
    assert len(found) == len(ODD) + 2
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[50] == ("und", 0.0) and by_id[51][0] == "de"
    assert langid.identify(docs(spark, []), labelled).count() == 0
    nothing = langid.identify(frame, docs(spark, []))
    assert {(r["lang_pred"], r["score"]) for r in nothing.collect()} == {("und", 0.0)}


def test_the_sample_is_bounded_and_all_its_entries_are_kept(spark):
    labelled = docs(spark, [(i, f"alpha{chr(97 + i % 26)}{chr(97 + i // 26)} beta gamma", "en" if i % 2 else "de") for i in range(400)])
    model = langid.train(labelled, max_rows=20)
    assert model.languages == ["de", "en"] and 20 <= len(model.words) - 2 <= 60
    assert len(langid.train(labelled).words) == 402
    # rows without an id, or with one id, are sampled by their texts
    same = labelled.withColumn("doc_id", F.lit(None).cast("long"))
    assert 20 <= len(langid.train(same, max_rows=20).words) - 2 <= 60


def test_texts_without_a_letter(spark):
    labelled = docs(spark, [(1, "the house and the tree", "en"), (2, "das Haus und der Baum", "de")])
    odd = ["²", "½ ¾", "①②", "Ⅷ", "٣", "_ 9", "🙂"]
    found = langid.identify(docs(spark, list(enumerate([*odd, "² das Haus²und½"]))), labelled).collect()
    by_id = {r["doc_id"]: r["lang_pred"] for r in found}
    assert [by_id[i] for i in range(len(odd))] == ["und"] * len(odd) and by_id[len(odd)] == "de"
    assert langid.words_of("² das Haus²und½ x_y") == ["das", "haus", "und", "x", "y"]


def test_whole_operator_equals_brute_force(spark):
    """Training counts, smoothing, backing off and the tempered posterior, written the direct way."""
    import math

    import regex

    given = [(r["doc_id"], r["text"], r["lang"]) for r in table("documents")[:120]]
    learnt = [r for r in given if r[0] % 3]
    languages = sorted({lang for _, text, lang in learnt if lang is not None and text is not None})
    words = lambda text: regex.findall(r"\p{L}+", (text or "").lower())
    counts, grams = {}, {}
    for _, text, lang in learnt:
        for word in words(text) if lang is not None else ():
            counts.setdefault(word, dict.fromkeys(languages, 0))[lang] += 1
            marked = f"<{word}>"
            for size in range(1, 6):
                for at in range(len(marked) - size + 1):
                    grams.setdefault(marked[at : at + size], dict.fromkeys(languages, 0))[lang] += 1

    by_size = {n: {g: c for g, c in grams.items() if len(g) == n} for n in range(1, 6)}
    totals = {n: {lang: sum(c[lang] for c in t.values()) for lang in languages} for n, t in by_size.items()}
    word_totals = {lang: sum(c[lang] for c in counts.values()) for lang in languages}

    def score(word, lang):
        if word in counts:
            return math.log((counts[word][lang] + 0.5) / (word_totals[lang] + 0.5 * (len(counts) + 1)))
        marked, at, parts = f"<{word}>", 0, []
        while at < len(marked):
            size = next((n for n in range(min(5, len(marked) - at), 0, -1) if marked[at : at + n] in grams), 0)
            if size:
                held, table_ = grams[marked[at : at + size]], by_size[size]
                parts.append(math.log((held[lang] + 0.5) / (totals[size][lang] + 0.5 * (len(table_) + 1))))
            at += max(1, size - 1)
        return sum(parts) / len(parts) if parts else 0.0

    found = {r["doc_id"]: r for r in langid.identify(docs(spark, given), docs(spark, learnt)).collect()}
    memo = {}
    for doc_id, text, _ in given:
        seen = words(text)
        if not seen:
            assert tuple(found[doc_id])[1:] == ("und", 0.0)
            continue
        sums = {}
        for lang in languages:
            sums[lang] = math.fsum(memo.setdefault((w, lang), None) or memo.update({(w, lang): score(w, lang)}) or memo[w, lang] for w in seen)
        best = max(languages, key=lambda lang: sums[lang])
        tempered = [(sums[lang] - sums[best]) / math.sqrt(len(seen)) for lang in languages]
        assert found[doc_id]["lang_pred"] == best
        assert abs(found[doc_id]["score"] - 1 / sum(map(math.exp, tempered))) < 1e-9
