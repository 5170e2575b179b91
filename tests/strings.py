"""Random strings that mix scripts, spaces, symbols, marks and astral characters."""

import random

POOL = (
    list("abcXYZ019_ .-*/\\|·•@$!<>\t\n")
    + list("\x1c\x85\xa0 　​")
    + list("死ね殺バカくずがｱｶﾞＡｂ１")
    + list("аеорсЖαοε½²ǅß")
    + list("́̈️‿")
    + ["😀", "𝒳", "𠮷"]
)


def random_strings(n, longest=40, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choices(POOL, k=rng.randint(0, longest))) for _ in range(n)]


def column_of(spark, function, strings):
    df = spark.createDataFrame(list(enumerate(strings)), "i int, t string")
    rows = df.select("i", function(df.t).alias("r")).collect()
    return [
        row.r for row in sorted(rows, key=lambda row: row.i)
    ]
