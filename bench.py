"""Headline timings, one JSON line.

Topic tables are written once from the tables in ``$BENCH_SF_DIR`` (not timed);
each query then reads its topic table and is run to the last row with nothing
kept. The time is the median of the warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import sample_topics as topics  # noqa: E402
from sample_queries import EVENT_COLUMNS  # noqa: E402
from tidelog.functions import variants as V  # noqa: E402
from tidelog.operators import decode, panels  # noqa: E402
from tidelog.operators.infer import find_fields, infer_fields, schema_groups  # noqa: E402
from tidelog.operators.lineprotocol import LineOptions, lp_long  # noqa: E402
from tidelog.operators.wide import FieldSpec  # noqa: E402
from tidelog.plans.query import TopicQuery  # noqa: E402
from tidelog.plans.run import run  # noqa: E402
from tidelog.session import configure, scratch_folder  # noqa: E402
from tidelog.sources.offsets import last_n  # noqa: E402
from tidelog.sources.topic import TOPIC_SCHEMA  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
FILES = 3 * CPUS


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def wide_json(fields: int) -> tuple[Column, list[FieldSpec]]:
    """Flat objects of ``fields`` members of four types, from a line item."""
    cycle = [
        (V.DOUBLE, F.col("l_extendedprice").cast("string")),
        (V.LONG, F.col("l_partkey").cast("string")),
        (V.STRING, F.concat(F.lit('"supplier '), F.col("l_suppkey").cast("string"), F.lit('"'))),
        (V.BOOL, F.when(F.col("l_returnflag") == "R", "true").otherwise("false")),
    ]
    parts, specs = [], []
    for i in range(fields):
        kind, value = cycle[i % 4]
        parts += [F.lit(("," if i else "{") + f'"field_{i}":'), value]
        specs.append(FieldSpec(f"field_{i}", kind, depths=(1,)))
    return F.concat(*parts, F.lit("}")), specs


def ten_lines() -> Column:
    """Ten lines with three tags and five fields per order."""
    tags = [",tag0=", F.col("o_orderstatus"), ",tag1=", F.col("o_custkey"), ",tag2=c"]
    fields = [
        " field0=", F.col("o_totalprice"), ",field1=2.5,field2=", F.col("o_custkey"),
        "i,field3=true,field4=", F.col("o_orderkey"), "i ",
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")),
    ]
    return F.concat_ws("\n", *[topics._text(f"cpu{i}", *tags, *fields) for i in range(10)])


def stored(spark: SparkSession, folder: str, name: str, df: DataFrame) -> DataFrame:
    path = f"{folder}/{name}"
    df.repartition(FILES).write.parquet(path)
    return spark.read.schema(TOPIC_SCHEMA).parquet(path)


def lineitem_topic(spark: SparkSession, value: Column) -> DataFrame:
    df = topics.table(spark, SF_DIR, "lineitem")
    unique = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return topics._topic(df, "lines", unique, F.col("l_shipdate"), F.lit(None), value)


def workloads(spark: SparkSession, folder: str):
    """Name, messages, the DataFrame to run."""
    json20, specs20 = wide_json(20)
    json100, specs100 = wide_json(100)
    t_events = stored(spark, folder, "events", topics.events_log(spark, SF_DIR))
    t_20 = stored(spark, folder, "json20", lineitem_topic(spark, json20))
    t_100 = stored(spark, folder, "json100", lineitem_topic(spark, json100))
    orders = topics.table(spark, SF_DIR, "orders")
    lp = topics._topic(
        orders, "lp", F.col("o_orderkey"), F.col("o_orderdate"), F.lit(None), ten_lines()
    )
    t_lp = stored(spark, folder, "lp", lp)
    text = topics._text("seq=", F.col("l_orderkey"), " value=", F.col("l_extendedprice"))
    t_text = stored(spark, folder, "text", lineitem_topic(spark, text))

    lines = TopicQuery("lines", offset="earliest")
    events = TopicQuery("events", offset="earliest")
    lp_query = TopicQuery("lp", offset="earliest", format="lineprotocol")
    plain = TopicQuery("lines", offset="earliest", format="plaintext")
    wide_events = run(spark, events, t_events, fields=EVENT_COLUMNS)
    n_lines, n_events, n_orders = t_20.count(), t_events.count(), t_lp.count()
    by_type = wide_events.filter("error IS NULL").select(
        F.col("`event.type`").alias("type"), "time", "partition", "offset", "value"
    )
    return [
        ("plaintext", n_lines, lambda: run(spark, plain, t_text)),
        ("json20_wide", n_lines, lambda: run(spark, lines, t_20, fields=specs20)),
        ("json100_wide", n_lines, lambda: run(spark, lines, t_100, fields=specs100)),
        ("json20_long", n_lines, lambda: run(spark, TopicQuery("lines", offset="earliest", shape="long"), t_20)),
        ("json20_wide_default", n_lines, lambda: run(spark, lines, t_20)),
        ("json20_infer", n_lines, lambda: infer_fields(t_20)),
        ("json20_fields", n_lines, lambda: spark.range(len(find_fields(t_20)))),
        ("events_wide", n_events, lambda: wide_events),
        ("events_schema_groups", n_events, lambda: schema_groups(t_events)),
        ("events_audit", n_events, lambda: decode.decode_audit(decode.decode_json(t_events))),
        ("events_last_n", n_events, lambda: last_n(t_events, 100)),
        ("lineprotocol", n_orders, lambda: lp_long(t_lp)),
        ("lineprotocol_wide", n_orders, lambda: run(spark, lp_query, t_lp)),
        ("lineprotocol_filtered", n_orders, lambda: lp_long(t_lp, LineOptions(measurements="cpu[12]", fields="field0"))),
        ("moving_mean", n_events, lambda: panels.moving_mean(by_type, "value", ["type"])),
        ("panel_mean", n_events, lambda: panels.reduce_mean(wide_events, "value", ["event.type"])),
    ]


def main() -> None:
    spark = session()
    folder = scratch_folder(spark, "bench")
    seconds, rates = {}, {}
    for name, messages, build in workloads(spark, folder):
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        rates[name] = round(messages / seconds[name])
        print(f"{name}: {seconds[name]} s, {rates[name]} messages/s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries, warm median",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "messages_per_sec": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
