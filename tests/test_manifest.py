"""Topic tables with a manifest: commits, offsets, partitions, pruning."""

from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelog.functions.murmur import key_partition, murmur2
from tidelog.plans.query import TopicQuery
from tidelog.plans.run import messages
from tidelog.sources import manifest
from tidelog.sources.files import file_context
from tidelog.sources.sink import write_topic
from tidelog.sources.topic import TopicNotFound, TopicSource, read_topic

START = datetime(2024, 1, 1, tzinfo=UTC)


def rows(spark, numbers, topic="t", key=lambda i: f"k{i % 7}".encode(), partition=None):
    data = [(key(i), str(i).encode(), topic, START + timedelta(minutes=i), i) for i in numbers]
    df = spark.createDataFrame(data, "key binary, value binary, topic string, timestamp timestamp, place int")
    return df if partition is None else df.withColumn("partition", F.lit(partition))


@pytest.fixture
def table(spark, tmp_path):
    source = TopicSource("managed", str(tmp_path / "log"))
    manifest.create_topic(spark, source.path, "t", 4)
    return source


def files_of(df):
    return {f.rsplit("/", 1)[1] for f in df.inputFiles()}


def test_key_hash_has_the_known_values(spark):
    # fixed values: signed hashes of these keys
    known = {
        "21": -973932308,
        "foobar": -790332482,
        "a-little-bit-long-string": -985981536,
        "a-little-bit-longer-string": -1486304829,
        "lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971,
        "abc": 479470107,
    }
    df = spark.createDataFrame([(k.encode(),) for k in known] + [(None,)], "key binary")
    got = {r["key"] and bytes(r["key"]): r for r in df.select("key", murmur2(F.col("key")).alias("h"), key_partition(F.col("key"), 5).alias("p")).collect()}
    for key, value in known.items():
        assert got[key.encode()]["h"] == value % (1 << 32)
        assert got[key.encode()]["p"] == (value & 0x7FFFFFFF) % 5
    assert got[None]["h"] is None and got[None]["p"] is None


def test_offsets_go_on_without_gaps(spark, table):
    write_topic(rows(spark, range(500)), table)
    write_topic(rows(spark, range(500, 800)), table)
    write_topic(rows(spark, []), table)
    got = read_topic(spark, table, "t").collect()
    assert Counter(int(r["value"]) for r in got) == Counter(range(800))
    by_partition = {}
    for r in sorted(got, key=lambda r: (r["partition"], r["offset"])):
        by_partition.setdefault(r["partition"], []).append(r)
    for part in by_partition.values():
        assert [r["offset"] for r in part] == list(range(len(part)))
        assert [r["timestamp"] for r in part] == sorted(r["timestamp"] for r in part)
    assert len({(bytes(r["key"]), r["partition"]) for r in got}) == 7  # a key has one partition


def test_rows_without_key_are_spread_and_given_partitions_kept(spark, table):
    write_topic(rows(spark, range(300), key=lambda i: None), table)
    assert {r["partition"] for r in read_topic(spark, table, "t").collect()} == {0, 1, 2, 3}
    write_topic(rows(spark, range(300, 310), partition=2), table)
    late = read_topic(spark, table, "t").filter("cast(cast(value as string) as int) >= 300").collect()
    assert {r["partition"] for r in late} == {2}
    with pytest.raises(Exception, match="no such partition"):
        write_topic(rows(spark, range(3), partition=4), table)
    with pytest.raises(Exception, match="topic not found"):
        write_topic(rows(spark, range(3), topic="u"), table)
    now = rows(spark, range(3), topic=None).drop("timestamp")
    write_topic(now, table, topic="t")
    assert read_topic(spark, table, "t").count() == 313


def test_a_hot_partition_is_many_tasks(spark, table, monkeypatch):
    """All rows in one partition: their numbers come from several range partitions."""
    told = []
    plain = manifest._numbered
    monkeypatch.setattr(manifest, "_numbered", lambda ranged, high: told.append(ranged) or plain(ranged, high))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one
    try:
        write_topic(rows(spark, range(4000), partition=1), table)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert told[0].select("_part").distinct().count() >= 4
    assert [r["offset"] for r in read_topic(spark, table, "t").orderBy("offset").collect()] == list(range(4000))


def test_bounds_and_catalog_with_empty_partitions(spark, table):
    write_topic(rows(spark, range(10), partition=1), table)
    manifest.create_topic(spark, table.path, "other", 2)
    zones = manifest.zones(spark, table.path)
    got = {(r["topic"], r["partition"]): (r["earliest"], r["latest"]) for r in manifest.bounds(zones).collect()}
    assert got == {("t", 0): (0, 0), ("t", 1): (0, 10), ("t", 2): (0, 0), ("t", 3): (0, 0), ("other", 0): (0, 0), ("other", 1): (0, 0)}
    assert manifest.partitions_of(zones, "t") == [0, 1, 2, 3]
    listed = manifest.catalog(zones, prefix="t").collect()
    assert {(r["partition"], r["messages"]) for r in listed} == {(0, 0), (1, 10), (2, 0), (3, 0)}
    assert {r["topic"] for r in manifest.catalog(zones, limit=1).collect()} == {"other"}


def test_partitions_are_those_declared(spark, table):
    write_topic(rows(spark, range(10), partition=1), table)
    query = lambda p: TopicQuery("t", partition=p, offset="earliest")
    assert messages(spark, query(1), table).count() == 10
    assert messages(spark, query(3), table).count() == 0
    with pytest.raises(ValueError, match="out of range"):
        messages(spark, query(4), table)
    with pytest.raises(TopicNotFound):
        messages(spark, TopicQuery("none", offset="earliest"), table)


def test_unknown_topic_of_a_plain_table(spark, tmp_path):
    plain = TopicSource(path=str(tmp_path / "plain"))
    write_topic(rows(spark, range(5), partition=0).withColumn("offset", F.col("place").cast("long")), plain)
    assert messages(spark, TopicQuery("t", offset="earliest"), plain).count() == 5
    with pytest.raises(TopicNotFound):
        messages(spark, TopicQuery("none", offset="earliest"), plain)


def test_only_files_that_may_hold_something_are_read(spark, table):
    for first in range(0, 500, 100):
        write_topic(rows(spark, range(first, first + 100), partition=(first // 100) % 2), table)
    every = files_of(read_topic(spark, table, "t"))
    last = messages(spark, TopicQuery("t", offset="last_n", last_n=30), table)
    assert Counter(r["partition"] for r in last.collect()) == {0: 30, 1: 30}
    assert len(files_of(last)) < len(every) / 2
    window = TopicQuery("t", offset="earliest", start_time=START + timedelta(minutes=110), end_time=START + timedelta(minutes=120))
    found = messages(spark, window, table)
    assert sorted(int(r["value"]) for r in found.collect()) == list(range(110, 121))
    assert len(files_of(found)) <= 2
    one = messages(spark, TopicQuery("t", partition=1, offset="earliest"), table)
    assert one.count() == 200 and len(files_of(one)) < len(every)
    then = manifest.bounds(manifest.zones(spark, table.path))
    write_topic(rows(spark, range(500, 520), partition=3), table)
    new = messages(spark, TopicQuery("t"), table, then)
    assert sorted(int(r["value"]) for r in new.collect()) == list(range(500, 520))
    assert not files_of(new) & every


def test_planning_reads_no_messages(spark, table):
    """With the messages gone, bounds and choice of files still work."""
    write_topic(rows(spark, range(50)), table)
    hadoop, context = file_context(spark, table.path)
    zones = manifest.zones(spark, table.path)
    context.rename(
        hadoop.Path(f"{table.path}/messages"),
        hadoop.Path(f"{table.path}/aside"),
        spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0),
    )
    assert manifest.bounds(zones).agg(F.sum("latest")).first()[0] == 50
    assert manifest.catalog(zones).agg(F.sum("messages")).first()[0] == 50
    assert manifest.partitions_of(zones, "t") == [0, 1, 2, 3]


def test_a_commit_is_whole_or_not_at_all(spark, table, monkeypatch):
    """An append that dies before its commit leaves nothing to be seen; one that
    finds its number taken gives its offsets anew."""
    write_topic(rows(spark, range(10), partition=0), table)
    plain = manifest._commit

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(manifest, "_commit", dies)
    with pytest.raises(RuntimeError, match="lost"):
        write_topic(rows(spark, range(10, 20), partition=0), table)
    assert read_topic(spark, table, "t").count() == 10

    def raced(path, zones, number):
        monkeypatch.setattr(manifest, "_commit", plain)
        write_topic(rows(spark, range(20, 25), partition=0), table)
        return plain(path, zones, number)

    monkeypatch.setattr(manifest, "_commit", raced)
    write_topic(rows(spark, range(30, 40), partition=0), table)
    got = sorted((r["offset"], int(r["value"])) for r in read_topic(spark, table, "t").collect())
    assert [o for o, _ in got] == list(range(25))
    assert [v for _, v in got] == [*range(10), *range(20, 25), *range(30, 40)]
    monkeypatch.setattr(manifest, "_commit", lambda *_: False)
    with pytest.raises(manifest.CommitConflict):
        manifest.create_topic(spark, table.path, "late", 1)


def test_names_and_times_are_checked(spark, table):
    with pytest.raises(ValueError, match="illegal"):
        manifest.create_topic(spark, table.path, "a/b", 1)
    with pytest.raises(ValueError, match="time zone"):
        TopicQuery("t", start_time=datetime(2024, 1, 1))
    assert TopicQuery("t").fingerprint() != TopicQuery("t", start_time=START).fingerprint()
    with pytest.raises(ValueError, match="batch"):
        read_topic(spark, table, "t", stream=True)
