import numpy as np

import corpus_pipeline
from beaconry.llm import entries
from tests.llm.helpers import documents, prose, words
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import TOKENIZER
from tests.llm.test_toxicity import LABELS, corpus


def test_stages(spark, tmp_path):
    rows, labels = corpus(200)
    rows += [(1000 + i, t) for i, t in rows[:40]] + [(2000 + i, t + " tail") for i, t in rows[40:80]] + [(3000, None), (3001, "")]
    docs = documents(spark, [(*r, f"s{r[0] % 4}") for r in rows])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    folder, kept = str(tmp_path), spark.read.parquet(str(tmp_path / "documents.parquet"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "ngram_jaccard", "source_mixing", "best_fit_packing"]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, folder)
        if name != names[-1]:
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        after[name] = kept.collect()
    toxic = {i for i, _ in rows if i % 1000 < 200 and i < 3000 and i % 1000 % 6 == 0}
    clean = [(r["doc_id"], r["text"]) for r in after["toxicity"]]
    assert len({i for i, _ in clean} & toxic) <= 0.05 * len(toxic)
    assert len([i for i, _ in clean]) >= 0.97 * (len(rows) - len(toxic))
    first = {}
    for i, t in sorted(clean):
        first.setdefault(" ".join((t or "").split()), i)
    single = [(r["doc_id"], r["text"]) for r in after["exact_dedup"]]
    assert sorted(i for i, _ in single) == sorted(first.values())
    groups = {c if n else i for i, n, c in brute(single, 5, 80)}
    assert sorted(r["doc_id"] for r in after["ngram_jaccard"]) == sorted(groups)
    mixed = [r["doc_id"] for r in after["source_mixing"]]
    assert set(mixed) <= groups and max(map(mixed.count, mixed)) <= 3
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(TOKENIZER)
    tokens = sum(len(whole.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in after["source_mixing"])
    assert sum(r["length"] for r in after["best_fit_packing"]) == tokens
    run = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in run.collect()) == sorted(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in after["best_fit_packing"])
    assert np.isclose(sum(len(words(t)) for _, t in single), sum(len(words(r["text"])) for r in after["exact_dedup"]))


def test_registered():
    assert [n.split("_")[0] for n in entries.QUERIES] == [f"op{i}" for i in range(1, 11)] + ["pipeline"]
    assert set(entries.ORACLES) <= set(entries.QUERIES)
