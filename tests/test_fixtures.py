"""Archives derived from tables."""

import gzip
import random
from pathlib import Path

from pyspark.sql import functions as F

from webcorpus.fixtures import write_archives


def test_one_file_per_object_behind_a_join(spark, tmp_path):
    """A join on the object's index, planned as a large one, turns out to be small: an object stays in one file."""
    rows = spark.range(0, 2_000_000, 1, 8).select(
        (F.col("id") % 7).alias("object_index"), F.col("id").alias("record_idx"), F.lit("x").alias("value")
    )
    last = rows.groupBy("object_index").agg(F.max("record_idx").alias("last"))
    write_archives(rows.join(last, "object_index").filter("last > 0"), str(tmp_path / "a"))
    files = [len(list(folder.glob("*.gz"))) for folder in Path(tmp_path / "a").glob("object_index=*")]
    assert files == [1] * 7


def test_archives_are_compressed_fast(spark, tmp_path):
    draw = random.Random(1)
    words = ["".join(draw.choices("abcdefgh", k=draw.randrange(2, 9))) for _ in range(500)]
    rows = [(0, i, " ".join(draw.choices(words, k=400))) for i in range(200)]
    write_archives(spark.createDataFrame(rows, "object_index bigint, record_idx bigint, value string"), str(tmp_path / "a"))
    (path,) = (tmp_path / "a" / "object_index=0").glob("*.gz")
    text = gzip.decompress(path.read_bytes())
    assert text == "".join(f"{value}\r\n\r\n" for _, _, value in rows).encode()
    fast, usual = (len(gzip.compress(text, level)) for level in (1, 6))
    assert abs(path.stat().st_size - fast) < abs(path.stat().st_size - usual)
