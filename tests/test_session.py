"""Session helpers: the package shipped to Python workers, the checkpoint folder."""

import zipfile

from subword_spark import session


def test_package_zip_holds_the_worker_modules(spark):
    session.ship_package(spark)
    assert session._ZIP is not None
    names = set(zipfile.ZipFile(session._ZIP).namelist())
    for mod in ["operators/kernels.py", "operators/encode.py", "functions/unicode.py", "__init__.py"]:
        assert f"subword_spark/{mod}" in names
    assert not any("__pycache__" in n for n in names)
    session.ship_package(spark)  # idempotent per application


def test_checkpoint_folder_is_set(spark):
    assert session.ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()


def test_training_leaves_the_session_and_the_folder_as_they_were(spark):
    """Checkpoint paths never nest and are gone afterwards, also with two trainings at once."""
    import os
    from concurrent.futures import ThreadPoolExecutor

    from subword_spark.operators.train import _Work, train
    from subword_spark.options import BPEOptions

    root = spark.sparkContext.getCheckpointDir()
    local = root.removeprefix("file:")
    before = set(os.listdir(local))
    for _ in range(150):
        _Work(spark).close()
    assert spark.sparkContext.getCheckpointDir() == root
    df = spark.createDataFrame([("abab cdcd abcd " * 3,)] * 5, "line string")
    opts = BPEOptions(minimum_pair_frequency=1, max_merges=12)
    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(lambda _: train(df, "line", opts, max_batch=1), range(2))
    assert a.merges == b.merges and len(a.merges) == 12
    assert spark.sparkContext.getCheckpointDir() == root
    assert set(os.listdir(local)) == before


def test_scratch_paths_can_be_removed(spark):
    df, path = session.shared_table(spark.range(3), "t")
    assert df.count() == 3 and path in session._SCRATCH
    session.remove_path(spark, path)
    assert path not in session._SCRATCH
    session.remove_path(spark, path)
