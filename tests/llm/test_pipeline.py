"""The pipeline's stages on a small corpus, against plain versions of what each should keep."""

import random

import corpus_pipeline
import public_tokenizers
from millrace.llm import segmentations


def test_stages(spark, tmp_path):
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    item = prose(40)
    clean = [prose(120) for _ in range(20)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean)]
    near = clean[2].replace(clean[2].split()[60], "edited")
    rows += [(30, clean[1], "en", "s", 0), (31, near, "en", None, 0), (32, "short junk", "en", "s", 10), (33, ("spam spam eggs " * 60).strip(), "en", "s", 0)]
    rows += [(34, clean[3][:300] + "\n" + item + "\n" + prose(100), "en", "s", 0), (35, item, "en", "s", 0), (36, prose(80) + " write to someone@mail.example.com", "en", "s", 0), (37, None, "en", "s", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    quality, near, leaks, private = kept
    whole = set(range(20))
    assert set(quality) == whole | {30, 31, 34, 36}
    assert set(near) == whole | {34, 36}
    assert set(leaks) == whole | {34, 36} and item not in leaks[34] and all(leaks[i] == clean[i] for i in whole)
    assert "someone@mail" not in private[36] and all(private[i] == clean[i] for i in whole)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    vocabulary = segmentations.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert {(r["doc_id"], r["rank"]) for r in last} == {(i, k) for i in private for k in (1, 2)}
    assert all(vocabulary.decode(r["ids"]) == private[r["doc_id"]] for r in last)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(last)
