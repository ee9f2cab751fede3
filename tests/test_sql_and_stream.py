from test_queries import DATA, HOST, SESSION, model  # noqa: F401

from girder.plans.registry import run
from girder.plans.sql import register_functions
from girder.sources.schema import TABLES
from girder.streaming.freshness import stamps


def test_table_functions(model):  # noqa: F811
    assert len(register_functions(model)) == 10
    sql = lambda text: [tuple(r) for r in model.spark.sql(text).collect()]
    assert [r[0] for r in sql("SELECT id FROM bim_rooms_of(1) ORDER BY number, id")] == [1, 2]
    assert len(sql("SELECT * FROM bim_rooms_of(1, true)")) == 5
    assert [r[0] for r in sql("SELECT id FROM bim_views_of(1, 'SECTION')")] == [22] and len(sql("SELECT * FROM bim_views_of(1)")) == 3
    links = run(model, SESSION, "get_links").to_dict()["links"]
    assert sql("SELECT id, loaded, project_key FROM bim_links_of(1) ORDER BY name, id") == [(x["id"], x["loaded"], x.get("project_key")) for x in links]
    assert sql("SELECT sheet_id, view_id FROM bim_sheet_views_of(1) ORDER BY sheet_number, sheet_id, ordinal") == [(30, 20), (30, 22), (32, None), (31, 21)]
    assert len(sql("SELECT * FROM bim_levels_of(1)")) == 4


def test_only_the_functions_that_are_needed(model):  # noqa: F811
    """A box test that nobody asked for doesn't read elements to shape its cells."""
    assert register_functions(model, "few_", ["elements_in_box"]) == ["few_elements_in_box"]
    assert model.spark.catalog.tableExists("few_pairs_in") and not model.spark.catalog.tableExists("few_pairs_meeting")
    assert register_functions(model, "no_", []) == [] and not model.spark.catalog.tableExists("no_pairs_in")


def test_freshness_stream(spark, tmp_path):
    rows = [(HOST, "Host", "", f"g{saves}", saves, modified, False, False, True, None) for saves, modified in ((1, False), (1, True), (2, False))] + [(9, "New", None, None, None, False, False, False, True, None)]
    for k, row in enumerate(rows):
        spark.createDataFrame([row], TABLES["documents"]).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = stamps(spark.readStream.schema(TABLES["documents"]).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*"))
    query = stream.writeStream.format("memory").queryName("stamps").outputMode("complete").option("checkpointLocation", f"{tmp_path}/state").start()
    query.processAllAvailable()
    query.stop()
    got = {r.doc_id: r for r in spark.table("stamps").collect()}
    assert (got[HOST].version_guid, got[HOST].has_unsaved_changes, got[HOST].snapshots) == ("g2", False, 3) and got[9].number_of_saves is None
