"""Driver contract: every registered query has an oracle, entry() runs."""

import pytest

import __spark_entry__ as E


def test_every_query_has_an_oracle():
    from seqtally.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert len(catalog.QUERIES) >= 40
    assert set(catalog.QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["sample", "gene", "barcode", "read_counts", "rpm"]
    rows = df.collect()
    assert rows and all(r.read_counts >= 0 and r.rpm >= 0 for r in rows)
    by_sample = {}
    for r in rows:
        by_sample[r.sample] = by_sample.get(r.sample, 0) + r.rpm
    assert all(abs(v - 1e6) < 1e-6 or v == 0 for v in by_sample.values())


def test_scale_conf_sizes():
    from seqtally.session import scale_conf
    c = scale_conf(100 * 10 ** 12, 8000)
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert 90_000 < int(c["spark.sql.shuffle.partitions"]) < 110_000
    assert int(scale_conf(10 ** 6, 8)["spark.sql.shuffle.partitions"]) == 16


def test_checkpoint_dir_fallback_without_cluster_setting():
    """No spark.checkpoint.dir: a private folder is registered on the context
    and the (static) setting itself is never written."""
    from seqtally.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

        def set(self, key, value):
            raise AssertionError("static setting must not be modified")

    class Context:
        master = "local[4]"

        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        conf = Conf()
        sparkContext = Context()

    s = Session()
    d = checkpoint_dir(s)
    assert d and s.sparkContext.dir == d
    assert checkpoint_dir(s) == d
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        s.sparkContext = Context()
        s.sparkContext.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(s)


def test_staged_tables_can_be_removed(spark):
    import os
    from seqtally.operators._util import staged
    from seqtally.session import remove_staged, scratch_root
    staged(spark.range(3), "x")
    root = scratch_root(spark).removeprefix("file:")
    assert os.path.isdir(root)
    remove_staged(spark)
    assert not os.path.exists(root)
