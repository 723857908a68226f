import re
import sys
from pathlib import Path

import sentencepiece

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as C  # noqa: E402
from tidemark.llm import byte_cnn, quality_rules, sentence_pieces  # noqa: E402
from tidemark.llm.queries import MIX_DEFAULT, MIX_WEIGHTS  # noqa: E402

from .helpers import documents, links_and_classes  # noqa: E402
from .test_pfair_mix import check  # noqa: E402

SF = "/root/testdata/sf0.01"


def plain_kept(text, lang, cut):
    """The rules of the contract and the four levels, counted with plain regular expressions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    repeated = len({j for p in at.values() if len(p) > 1 for i in p for j in (i, i + 1, i + 2)})
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    if len(words) < 50 or 100 * repeated > 50 * len(words):
        return False
    chars = sum(map(len, words))
    share = {"symbols": 100 * len(re.findall(r"[#*$%&|<>]", text)) // max(1, len(words)),
             "capitals": 100 * len(re.findall("[A-Z]", text)) // max(1, chars), "repeats": 100 * repeated // max(1, len(words)),
             "dup_lines": 100 * (len(lines) - len(set(lines))) // max(1, len(lines))}
    return all(min(100, v) <= cut.get((lang or "", r), 100) for r, v in share.items())


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    row = {r.doc_id: r for r in docs.collect()}
    cut = {(r.stratum, r.rule): r.cutoff for r in quality_rules.cutoffs(quality_rules.measure(docs), labels).collect() if r.cutoff is not None}
    left = [d for d, r in row.items() if plain_kept(r.text, r.lang, cut)]
    p, share = byte_cnn.train(docs, labels)
    from tidemark.llm.common import text_buffer
    import pyarrow as pa

    left = [d for d in left if byte_cnn.scores(*text_buffer(pa.array([row[d].text])), p, share)[0] >= byte_cnn.THRESHOLD]
    left = {c for _, c, _ in links_and_classes([(d, row[d].text) for d in left])}
    out = C.run(spark, SF).collect()
    assert {r.doc_id for r in out} == left and len(out) == len(left)
    sp = sentencepiece.SentencePieceProcessor(model_proto=sentence_pieces.model_bytes())
    assert all(r.ids == sp.encode(row[r.doc_id].text) and r.round_trip for r in out)


def test_mix_stage_orders_the_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [r.source for r in C.mix(spark, docs, SF).collect()]
    sizes = {r.source: r["count"] for r in docs.groupBy("source").count().collect()}
    blocks, at, slot = [], 0, 0
    left = dict(sizes)
    while at < len(out):  # blocks lie one after the other
        n = min(16, left[out[at]])
        assert len(set(out[at:at + n])) == 1
        left[out[at]] -= n
        blocks += [(slot, k, out[at], (sizes[out[at]] - left[out[at]] - n) // 16, None) for k in range(n)]
        at, slot = at + n, slot + 1
    check(blocks, MIX_WEIGHTS, MIX_DEFAULT, 16, sizes)


def test_result_keeps_the_mix_of_several_files(spark, monkeypatch, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(C, "STAGES", C.STAGES[-2:])  # all rows reach the mix
    monkeypatch.setattr(C, "prepare", lambda spark: str(tmp_path))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.files.maxRecordsPerFile")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "60")
    try:
        out = C.run(spark, SF).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(list(tmp_path.glob("*/pipeline-*/source_mix/part-*.parquet"))) > 8
    assert sorted(r.position for r in out) == list(range(docs.count()))
    want = C.pfair_mix.place(docs, MIX_WEIGHTS, MIX_DEFAULT).select("doc_id", "__mix_slot", "__mix_rank").collect()
    assert [r.doc_id for r in sorted(out, key=lambda r: r.position)] == [
        r.doc_id for r in sorted(want, key=lambda r: (r["__mix_slot"], r["__mix_rank"]))]


def test_columns_and_empty_tables(spark):
    docs = documents(spark, [])
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name
        if name != C.STAGES[-1][0]:
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            docs = out


def test_entry_registers_queries_and_pipeline():
    import __spark_entry__ as E

    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(E.oracle_sql()) <= names


def test_a_worker_gives_free_memory_back_after_a_task():
    """Small arrays freed below one that lives stay with the C library unless it is told to return them."""
    import numpy as np
    import pyarrow as pa
    from tidemark.llm.common import released

    def held() -> float:
        with open("/proc/self/status") as f:
            return next(int(x.split()[1]) / 1024 for x in f if x.startswith("RssAnon"))

    kept = []

    def run(batches):
        for b in batches:
            some = [np.ones(12_000) for _ in range(2_000)]      # 96 KB each, from the heap
            kept.append(some[-1])
            yield b

    batch, before = pa.RecordBatch.from_pydict({"x": [1]}), held()
    assert [b.num_rows for b in released(run)([batch])] == [1]
    assert held() - before < 100                                 # of 190 MB
    plain = released(run)([batch, batch])
    next(plain)
    plain.close()                                                # a task that is not read to its end
    assert held() - before < 100
