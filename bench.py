"""Times headline queries: prints one JSON line.  BENCH_SF_DIR and BENCH_CPUS choose the data and the cores."""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = ["spine_density_per_dendrite", "a1_region_props", "a2_channel_stats", "a22_validate", "a24_surface_area", "a25_morphometrics", "a33_ssim", "j6_nearest_point", "j7_distance_to", "j11_crop_bbox", "g1_connected_components_26", "g2_connected_components_4d", "g3_grow_labels", "g4_dilate_erode", "l1_gaussian", "l6_extract_tiles", "a17_track_matrix", "a13_dendrite_summary", "j1_merge_measurements", "w3_polyline_length"]


def main() -> None:
    from pyspark.sql import SparkSession

    from voxlake import registry

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .config("spark.local.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("a11_neuron_totals", "g1_connected_components_6"):  # warm-up of the JVM and of Python workers
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()
