from girder.llm import common


def test_settings_hold_within_and_go(spark):
    """Also those that nobody set before."""
    names = [common.CLEANUP, common.BATCH, common.BATCH_BYTES]
    before = [spark.conf.get(n) for n in names]
    with common.settings(spark, cleanup="true", batch="17", batch_bytes="1048576"):
        assert [spark.conf.get(n).rstrip("b") for n in names] == ["true", "17", "1048576"]
    assert [spark.conf.get(n) for n in names] == before


def test_batches_of_written_tables(spark):
    def sizes(batches):
        for batch in batches:
            yield batch.assign(n=len(batch))[["n"]]

    df = common.written(spark.range(0, 1000, 1, 2).mapInPandas(sizes, "n long"), "sizes", 100)
    assert df.agg({"n": "max"}).first()[0] == 100
    common.drop(df)
