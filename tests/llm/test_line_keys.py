import random

from pyspark.sql import functions as F

from tidemark.llm import line_dedup


def test_segment_keys_are_short_code_and_the_same_keys(spark):
    """Each substring of each kind has a key, and the expression is not a list of all kinds, which is too long to be compiled."""
    rng = random.Random(4)
    lines = ["".join(rng.choice("abé日 ") for _ in range(n)) for n in (1, 2, 3, 7, 40, 41, 42, 43, 90)]
    rows = [(i, x, len(x)) for i, x in enumerate(lines)]
    want = []
    for i, x, n in rows:
        for gap in range(3):
            for k in range(3):
                other = n - gap
                start, end = other * k // 3, other * (k + 1) // 3
                for shift in range(max(-k, gap - (2 - k)), min(k, gap + (2 - k)) + 1):
                    at = start + shift
                    if at >= 0 and at + end - start <= n and end > start:
                        want.append((other, k, x[at: at + end - start], i * 2 + (gap == 0 and shift == 0)))
    hashed = spark.createDataFrame(want, "other int, i int, part string, tag long").select(F.xxhash64("other", "i", "part").alias("key"), "tag")
    keys = line_dedup.segment_keys(spark.createDataFrame(rows, "id long, line string, n int").repartition(2), 2)
    assert sorted(map(tuple, keys.collect())) == sorted(map(tuple, hashed.collect()))
    assert keys._jdf.queryExecution().optimizedPlan().toString().count("substring(") == 1
