"""The pipeline's stages against brute force, each on its own input."""

import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from encore.llm import quality, records
from encore.llm.queries import tokenizer
from test_curriculum import check
from test_decontaminate import brute as least_edits
from test_quality import brute as measures
from test_simhash import brute_components, brute_print
from util import SF, docs, table
from encore.llm import decontaminate


def stages(spark, tmp_path, frame, sf_dir):
    frame.write.parquet(f"{tmp_path}/in")
    frame, out = spark.read.parquet(f"{tmp_path}/in"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, sf_dir).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        out.append((name, frame, after))
        frame = after
    return out


def test_stages_equal_brute_force(spark, tmp_path):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    run = stages(spark, tmp_path, given, SF)
    assert [n for n, _, _ in run] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "source_mix", "token_records"]
    assert all(after.columns == given.columns for _, _, after in run[:-1])
    rows = [([tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()]) for _, a, b in run]

    before, after = rows[0]
    assert set(after) <= set(before)
    assert all(not measures(t)[5] for _, t, *_ in after)
    passed = {r["doc_id"] for r in quality.report(run[0][1]).filter("kept").collect()}
    assert {r[0] for r in after} == passed

    before, after = rows[1]
    prints = {i: brute_print(t) for i, t, *_ in before}
    root = brute_components(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    assert sorted(r[0] for r in after) == sorted(least.values()) and set(after) <= set(before)

    before, after = rows[2]
    items = [(r["text"], set(decontaminate.words_of(r["text"])), len(decontaminate.words_of(r["text"]))) for r in table("benchmark")]

    def leaks(text):
        held = set(decontaminate.words_of(text))
        return any(len(words - held) <= 0.2 * n and least_edits(text, t) <= int(0.2 * n + 1e-9) for t, words, n in items)

    assert {r[0] for r in after} == {r[0] for r in before if not leaks(r[1])}

    before, after = rows[3]
    from collections import Counter

    from encore.llm import curriculum

    placed = curriculum.place(run[3][1], columns=["doc_id"]).collect()
    check([(i, t, lang, s) for i, t, lang, s, *_ in before], placed)
    assert Counter(r[0] for r in after) == +Counter({r["doc"]["doc_id"]: r["copies"] for r in placed})
    assert set(after) <= set(before)

    before, after = rows[4]
    library, start = Tokenizer.from_file(tokenizer("word_bpe_49k.json")), 0
    assert len(after) == len(before)
    # the files follow the training sequence: the rows of the mix in the order they were written
    import glob

    import pyarrow.parquet as pq

    sequence = [r for f in sorted(glob.glob(f"{tmp_path}/source_mix/part-*")) for r in pq.read_table(f).to_pylist()]
    positions = {r["doc"]["doc_id"]: sorted(r["positions"]) for r in placed}
    taken = [positions[r["doc_id"]].pop(0) for r in sequence]
    assert taken == sorted(taken) and len(taken) == len(before)
    for (i, text), r in zip([(r["doc_id"], r["text"]) for r in sequence], sorted(after, key=lambda r: r[1])):
        ids = library.encode(text, add_special_tokens=False).ids + [records.END_ID]
        assert r[:4] == (i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)


def test_odd_and_empty_documents(spark, tmp_path):
    filler = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(1, None), (2, ""), (3, filler), (3, filler), (4, filler), (None, filler + " more"), (5, "w" * 200_000)]
    run = stages(spark, tmp_path / "odd", docs(spark, rows, extra=True), SF)
    assert [r["doc_id"] for r in run[1][2].collect()] == [3]
    assert {r["doc_id"] for r in run[-1][2].collect()} == {3}
    run = stages(spark, tmp_path / "none", docs(spark, []), SF)
    assert run[-1][2].count() == 0


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
