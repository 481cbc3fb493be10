"""Held-out figures of the classifiers: fitted on labels of ids not divisible by 5, judged on the others.

    python tests/llm/held_out.py FOLDER
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F

from thalweg.llm import quality, toxicity
from thalweg.session import local_session, ship_package


def main(folder: str) -> None:
    spark = local_session(8, 8, "8g", "held-out")
    ship_package(spark)
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    held, rest = labels.filter("doc_id % 5 = 0"), labels.filter("doc_id % 5 <> 0")
    for name, got in (("quality", quality.score_quality(docs, rest).select("doc_id", F.col("keep").alias("yes"))), ("toxic", toxicity.score_toxicity(docs, rest).select("doc_id", F.col("toxic").alias("yes")))):
        rows = {(r[name], r["yes"]): r["n"] for r in got.join(held, "doc_id").groupBy(name, "yes").agg(F.count("*").alias("n")).collect()}
        for label in (0, 1):
            total = rows.get((label, True), 0) + rows.get((label, False), 0)
            print(f"{name} label {label}: {rows.get((label, bool(label)), 0)} of {total} right, {rows.get((label, not label), 0)} wrong")


if __name__ == "__main__":
    main(sys.argv[1])
