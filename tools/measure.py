"""

Rows in, rows per second cold and warm (median of three runs), and bytes written to shuffles.
"""

from __future__ import annotations

import os
import statistics
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bench import HEADLINE, run
from prepkit.session import get_session

IMAGES = {"mean_pool", "score_head", "evaluate", "decode_image", "image_prepare", "imageclass", "imagecap"}
TALKS = {"encode_pair", "lm_seq2seq"}


def shuffled(spark) -> int:
    """Bytes written to shuffles so far, over all executors."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "measure", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("documents", "conversations", "embeddings")}
    for name in sys.argv[2:] or HEADLINE:
        rows = sizes["embeddings" if name in IMAGES else "conversations" if name in TALKS else "documents"]
        before = shuffled(spark)
        cold = run(spark, name, sf_dir)
        moved = shuffled(spark) - before
        warm = statistics.median(run(spark, name, sf_dir) for _ in range(3))
        print(f"| {name} | {rows:,} | {rows / cold:,.0f} | {rows / warm:,.0f} | {moved:,} | {sys.argv[1]} |", flush=True)


if __name__ == "__main__":
    main()
