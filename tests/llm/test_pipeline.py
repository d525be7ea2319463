"""The pipeline's stages: schema kept, decisions take effect."""

import corpus_pipeline as P
from subword_spark.llm import common
from subword_spark.session import shared_table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_dedup", "substring_dedup", "source_mixing", "bpe_codec"]
    seen = {"documents": docs}
    before = docs
    for name, stage in P.STAGES:
        before = seen[name] = shared_table(stage(spark, before, SF), name)[0]
        assert name == "bpe_codec" or before.schema == docs.schema
    ids = {n: sorted(r.doc_id for r in d.select("doc_id").collect()) for n, d in seen.items()}
    assert set(ids["simhash_dedup"]) < set(ids["toxicity"]) < set(ids["documents"])
    assert len(set(ids["simhash_dedup"])) == len(ids["simhash_dedup"])
    assert ids["substring_dedup"] == ids["simhash_dedup"] and ids["bpe_codec"] == ids["source_mixing"]
    assert set(ids["source_mixing"]) <= set(ids["substring_dedup"])
    texts = {r.doc_id: r.text for r in seen["simhash_dedup"].collect()}
    windows, first = {}, {}
    for i in sorted(texts):
        words = texts[i].encode().split()
        windows[i] = [tuple(words[p : p + 13]) for p in range(len(words) - 12)]
        for w in windows[i]:
            first.setdefault(w, i)
    for r in seen["substring_dedup"].collect():
        if all(first[w] == r.doc_id for w in windows[r.doc_id]):
            assert r.text == texts[r.doc_id]
        else:
            assert len(r.text) < len(texts[r.doc_id]) and r.n_chars == len(r.text)
    assert all(paths <= common.made() for paths in P._LEFT.values())
    common.release()


def test_run_and_an_empty_table(spark, tmp_path):
    """``run`` over documents with nulls, repeats and clashing names; and over none."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(None, None, "en", "web", None), (7, "", None, None, 0), (7, None, "en", None, 0)], docs.schema)
    for name, rows in (("some", docs.union(extra).union(extra)), ("none", docs.limit(0))):
        at = f"{tmp_path}/{name}"
        rows.write.parquet(f"{at}/documents.parquet")
        spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{at}/labels.parquet")
        got = P.run(spark, at).collect()
        assert bool(got) == (name == "some")
        assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    common.release()
