"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to the end through Spark's noop sink, once, after one warm-up query on the smallest tables. Landing the catalog
documents is timed apart (``land_*``), as a catalog is there before it is read. With names as arguments only those are run.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from skyledger import search, store_items
from skyledger.plans import queries as q
from skyledger.plans.document_sets import landed
from skyledger.workspace import Workspace, remove_all

HEADLINE = [
    "t3_crawl", "t4_follow_pages", "t5_page_order", "i1_property_names", "i4_infer_and_read", "p1_project_items",
    "f2_filter_property", "l4_top_k", "g1_geojson_to_wkt", "g2_wkt_to_geojson", "s4_freshest_response", "q3_search_datetime",
    "q4_search_bbox", "q5_search_triangle", "q7_search_all", "q9_search_batch",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:]
    times = {}

    def timed(name, job):
        if wanted and name not in wanted and not name.startswith("land_"):
            return
        started = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    drain(q.flagship(spark, os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")))
    for name in ("tree", "pages", "geometries", "searches", "responses"):
        timed(f"land_{name}", lambda: landed(spark, sf_dir, name))
    for name in HEADLINE:
        timed(name, lambda: drain(q.QUERIES[name](spark, sf_dir)))

    # a stored item table, as a user would search it again and again
    path = f"{Workspace(spark).root}/items"
    if not wanted or any(w.startswith("stored_") for w in wanted):
        timed("store_items", lambda: store_items(q._event_items(spark, sf_dir), path))
        if "store_items" not in times:
            store_items(q._event_items(spark, sf_dir), path)
        stored = spark.read.parquet(path)
        timed("stored_search_bbox", lambda: drain(search(stored, bbox=[-20.0, 10.5, 30.25, 40.0])))
        timed("stored_search_all", lambda: drain(search(
            stored, collections=["click", "error"], datetime="2024-01-03/2024-01-24", bbox=[-90, -45, 90, 45])))
        timed("stored_search_batch", lambda: drain(q.sky.search_batch(stored, landed(spark, sf_dir, "searches").drop("max_items")).select("search_id", "id")))
    remove_all(spark)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


main()
