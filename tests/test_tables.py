from placewise.functions import fields
from placewise.sources import tables
from placewise.sources.schemas import POST

SF = "/root/testdata/sf0.001"


def test_parts_add_values_but_no_rows(spark):
    bare, full = tables.posts(spark, SF), tables.posts(spark, SF, "text", "author", "place")
    key = ["data.id", "data.author_id", "data.created_at", "data.source"]
    one, two = (df.select(*key, fields.has_place().alias("placed")) for df in (bare, full))
    events = tables.table(spark, SF, "events").count()
    assert bare.count() == full.count() == events
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_posts_have_the_declared_shape(spark):
    for parts in ((), ("text", "author", "place")):
        assert tables.posts(spark, SF, *parts).schema.simpleString() == POST.simpleString()


def test_events_are_streamed_from_a_file_or_a_folder(spark, tmp_path):
    tables.table(spark, SF, "events").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for folder in (SF, str(tmp_path)):
        out = str(tmp_path / f"out-{folder == SF}")
        query = (tables.stream_events(spark, folder, max_files=1).writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", out + "-cp").trigger(availableNow=True).start())
        query.awaitTermination(120)
        assert query.exception() is None and spark.read.parquet(out).count() == 1000
