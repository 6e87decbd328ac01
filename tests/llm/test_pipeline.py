"""The pipeline's stages against plain versions, on a small corpus."""

import zlib
from collections import Counter

import corpus_pipeline as cp
from lectern.llm import mixing
from lectern.llm import quality_rules as qr
from tests.llm import test_line_dedup, test_ngram_join
from tests.llm.fixtures import DOCS, prose


def corpus():
    rows = []
    for i in range(90):
        source = "hot" if i % 3 == 0 else f"s{i % 4}"
        text = prose(i, 60) + "\n" + prose(i + 300, 40)
        if i % 10 == 0:
            text += "\n" + prose(9000, 25)  # a line that several share
        if i % 15 == 1:
            text = prose(5000, 120) + f" end{i}"  # near copies
        if i % 15 == 2:
            text = text.upper().replace(" ", "!! ")  # junk
        rows.append((i, text, "en", source, len(text)))
    return rows


def test_each_stage_on_its_own_input(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_join", "mixing", "packing"]
    kept = cp.clean(spark, docs, "").cache()
    verdict = {r.doc_id: r.kept for r in qr.figures(docs).collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, k in verdict.items() if k} == {i for i in range(90) if i % 15 != 2}

    lines = cp.lines_once(spark, kept, "").cache()
    gone = test_line_dedup.brute([tuple(r) for r in kept.collect()])
    want = {}
    for r in kept.collect():
        text = "\n".join(x for i, x in enumerate(r.text.split("\n")) if (r.doc_id, i) not in gone)
        if text.strip():
            want[r.doc_id] = text
    assert {r.doc_id: r.text for r in lines.collect()} == want and all(r.n_chars == len(r.text) for r in lines.collect())

    single = cp.one_of_near_copies(spark, lines, "").cache()
    groups = test_ngram_join.brute([tuple(r) for r in lines.collect()])
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in groups}

    mix = cp.mixed(spark, single, "").cache()
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.plan(single).collect() if r.taken}
    assert Counter(r.doc_id for r in mix.collect()) == taken
    for df in (kept, lines, single, mix):
        assert df.columns == docs.columns

    packed = cp.packed(spark, mix, "").collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == taken
    assert all(r.length <= 2048 and 0 <= r.ids_crc32 < 1 << 32 for r in packed)
    assert zlib.crc32(b"") == 0


def test_run_reads_each_stage_again(spark, tmp_path):
    spark.createDataFrame(corpus()[:30], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    out = cp.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
