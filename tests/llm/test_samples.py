"""The share of a sample at any size of table."""

from ledgermill.llm.samples import in_sample, sample_bound


def test_share_of_a_table_of_any_size(spark):
    assert sample_bound(4096, 100) is None and sample_bound(4096, 0) is None
    for total in (10**5, 50 * 10**9, 10**15):
        share = (sample_bound(4096, total) + (1 << 63)) / (1 << 64)
        assert abs(share * total - 4096) < 1
    rows = spark.range(100_000)
    assert 3600 < rows.where(in_sample(4096, 100_000, "id")).count() < 4600
    assert rows.where(in_sample(4096, 50, "id")).count() == 100_000
