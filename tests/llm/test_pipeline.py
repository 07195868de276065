"""The pipeline against plain Python, stage by stage, each on its own input."""

import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from loglathe.llm.quality_lines import document_figures, verdicts
from rows import words
from test_decontaminate import brute as leaks
from test_files_and_shards import targets
from test_near_dedup import brute as groups

SF_DIR = "/root/testdata/sf0.001"


def test_stages_equal_plain_python(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    states = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "tokens":
            assert out.columns == columns
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = corpus_pipeline.stored(out, name)
        states.append(docs.collect())
    raw, good, unique, clean, mixed, tokens = states
    kept = {r["doc_id"] for r in verdicts(document_figures(spark.read.parquet(f"{SF_DIR}/documents.parquet"))).where("kept").collect()}
    assert {r["doc_id"] for r in good} == kept and 0.8 * len(raw) < len(good) < len(raw)
    assert all(len(r["text"]) == r["n_chars"] for r in good)
    component = groups([(r["doc_id"], r["text"]) for r in good], 5)
    assert {r["doc_id"] for r in unique} == set(component.values()) and len(unique) < len(good)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    dirty = {int(d) for d, *_ in leaks([(r["doc_id"], r["text"]) for r in unique], items)}
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in unique} - dirty and dirty
    wanted, _ = targets([(r["doc_id"], r["text"], r["source"]) for r in clean])
    taken, largest = defaultdict(int), defaultdict(int)
    for r in mixed:
        taken[r["source"]] += len(words(r["text"]))
    for r in clean:
        largest[r["source"]] = max(largest[r["source"]], len(words(r["text"])))
    assert all(abs(taken[s] - wanted[s]) <= largest[s] for s in wanted)
    assert max(Counter(r["doc_id"] for r in mixed).values()) == 2
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, expected = 0, []
    for r in sorted(mixed, key=lambda r: r["doc_id"]):
        ids = np.array([*model.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        expected.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in tokens) == expected


def test_run_is_all_stages(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
