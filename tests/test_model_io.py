"""Model sinks and sources round-trip."""

import pytest

from subword_spark.operators.train import train
from subword_spark.options import BPEOptions
from subword_spark.session import scratch_path
from subword_spark.sources import model_io


def test_model_roundtrips(spark, lines_df):
    m = train(lines_df(["hello world", "hello there", "world peace"]), "line", BPEOptions(max_merges=6))
    base = scratch_path(spark, "t-model")
    model_io.save_model(m, spark, base)
    back = model_io.load_model(spark, base)
    assert back.tokens == m.tokens and back.merges == m.merges and back.options == m.options
    model_io.save_bundle(m, spark, base + "-b")
    b = model_io.load_bundle(spark, base + "-b")
    assert b.tokens == m.tokens and b.merges == m.merges and b.options == m.options
    model_io.save_vocab_json(m, spark, base + "-v")
    v = model_io.load_vocab_json(spark, base + "-v").orderBy("token_id").collect()
    assert [r.token for r in v] == m.tokens
    model_io.save_merges_text(m, spark, base + "-m")
    mm = model_io.load_merges_text(spark, base + "-m").orderBy("rank").collect()
    assert [(r.left, r.right) for r in mm] == m.merges


def test_merges_text_keeps_white_space(spark):
    from subword_spark.operators.model import BPEModel

    pairs = [(" ", "t"), ("\\", "u0020"), ("\x1c", "\x85"), ("\n", "\r\n"), ("\u3000", "é"), ("a\\", " b"), ("😀", "x")]
    m = BPEModel(options=BPEOptions(), tokens=["<unknown>"], merges=pairs)
    path = scratch_path(spark, "t-merges")
    model_io.save_merges_text(m, spark, path)
    back = model_io.load_merges_text(spark, path).orderBy("rank").collect()
    assert [(r.left, r.right) for r in back] == pairs


@pytest.mark.parametrize("line", ["a", "a b c", " a", "a "])
def test_merges_text_rejects_other_lines(spark, line):
    path = scratch_path(spark, "t-bad")
    spark.createDataFrame([(line,)], "value string").write.text(path)
    with pytest.raises(Exception, match="not a merge of two symbols"):
        model_io.load_merges_text(spark, path).collect()
