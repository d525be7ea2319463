"""What a Python worker keeps after a task."""

import pyarrow as pa
import public_tokenizers

from subword_spark.llm import bpe_codec, common


def test_a_task_gives_its_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    run = common.returning(lambda batches: (b + 1 for b in batches))
    assert list(run(iter([1, 2]))) == [2, 3] and given == [1]
    rows = run(iter([1, 2]))
    next(rows)
    rows.close()
    assert given == [1, 1]


def test_freed_memory_goes_back_to_the_system():
    import re

    def held() -> int:
        return int(re.search(r"VmRSS:\s+(\d+)", open("/proc/self/status").read())[1]) // 1024

    common.give_back()
    before = held()
    many = [pa.array([b"x" * 40_000 * 25]) for _ in range(100)]
    last = [bytes(1000) for _ in range(100_000)]
    assert held() > before + 150
    del many, last
    common.give_back()
    assert held() < before + 60


def test_pieces_outlive_a_full_cache(monkeypatch):
    """Pieces met again stay known when the cache is full, ids stay the same, and no more than
    two generations are held."""
    spec = bpe_codec._spec(public_tokenizers.path("word_bpe_49k.json"))
    whole, small = bpe_codec.Codec(spec), bpe_codec.Codec(spec)
    texts = [f"the word{i % 7} number{i} the é{i}" for i in range(60)]
    want = [whole.encode(t) for t in texts]
    monkeypatch.setattr(bpe_codec, "_CACHE", 8)
    made, ids = [], small._ids
    monkeypatch.setattr(small, "_ids", lambda mapped: made.append(mapped) or ids(mapped))
    assert [small.encode(t) for t in texts] == want
    assert len(small) <= 8 and len(small.old) <= 8
    assert sum(m.startswith("th") and len(m) == 3 for m in made) == 1


def test_the_driver_gives_back_what_training_took(monkeypatch):
    import gc

    from subword_spark.llm import toxicity

    seen = []
    monkeypatch.setattr(toxicity, "give_back", lambda: seen.append(any(isinstance(x, Texts) for x in gc.get_objects())))

    class Texts(list):
        pass

    monkeypatch.setattr(toxicity, "sample", lambda *a: (Texts(["bad", "good"] * 20), [1, 0] * 20))
    assert toxicity.learn(None, None, "doc_id", "text", "toxic").weights is not None
    assert seen == [False]
