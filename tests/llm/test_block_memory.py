"""How much text the substring stage of the pipeline handles at a time."""

import corpus_pipeline
from mixloom.llm import substring

HUMONGOUS = 512 << 10  # bytes from which G1 gives an object of a 1 MB region whole regions


def test_the_pipeline_makes_small_blocks_and_not_more_packets(spark, monkeypatch):
    text = " ".join(f"{k * 7919 % 100_003:x}" for k in range(450_000))  # 2.4 MB, hardly compressible
    docs = spark.createDataFrame([(k, text[k * 20_000 : (k + 1) * 20_000]) for k in range(100)], "doc_id long, text string").coalesce(1)
    made, stage_blocks = [], substring.stage_blocks

    def seen(*given):
        made.append(stage_blocks(*given))
        return made[-1]

    monkeypatch.setattr(substring, "stage_blocks", seen)
    monkeypatch.setattr(substring, "text_bytes", lambda *given: 4000 << 20)
    wide = substring.Substrings(docs, 13, "doc_id", "text")
    corpus_pipeline.substrings(spark, docs, "")
    sizes = [len(row.payload) for row in made[-1].collect()]
    assert len(sizes) > 1 and max(sizes) < HUMONGOUS
    narrow = substring.Substrings(docs, 13, "doc_id", "text", corpus_pipeline.BLOCK_BYTES)
    assert narrow.buckets * 2 == wide.buckets == 1000


def test_rows_are_the_same_for_any_block(spark):
    shared = " ".join(f"s{k}" for k in range(40))
    rows = [(k, f"a{k} b{k} {shared if k % 3 else ''} c{k} d{k}") for k in range(60)] + [(None, shared), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    found = [sorted(map(tuple, substring.remove_repeats(docs, block_bytes=size).collect()), key=str) for size in (2 << 20, 256)]
    assert found[0] == found[1] and ("a5 b5 c5 d5" in [text for _, text in found[0]])
