"""Text cleaning: every character against plain Python, and its cost."""

import re
import time

from pyspark.sql import functions as F

from tidewatch.functions.text import clean_text

SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                           0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def _compact(text):
    text = re.sub(f"http[^{SPACES}]+", "", text.lower())
    return re.sub(f"[{SPACES}]+", " ", re.sub(f"[^a-zA-Z{SPACES}]", "", text)).strip(" ")


def test_compact_cleaning_of_every_character(spark):
    texts = [f"a{chr(c)}b {chr(c)} c{chr(c)}{chr(c)}\n.d" for c in (*range(1, 0xD800), *range(0xE000, 0x10000), 0x1F600)
             if chr(c).lower() == chr(c)]
    texts += ["", " . ", "x http://a.b/c?d\u3000y", "\n\n a - b  --\t c", "http"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(4)
    got = df.select("t", clean_text("t", punct="").alias("c")).collect()
    assert [(r["t"], r["c"]) for r in got if r["c"] != _compact(r["t"])] == []


def test_compact_cleaning_costs_about_as_much_as_the_other(spark):
    """It took ten times as long."""
    text = " ".join(f"word{i % 7} of, the day-by-day news." for i in range(80))
    df = spark.range(6_000).repartition(4).select(F.concat(F.lit(text), F.col("id").cast("string")).alias("t")).persist()
    df.count()

    def seconds(punct):
        best = 1e9
        for _ in range(3):
            start = time.time()
            df.select(F.sum(F.length(clean_text("t", punct)))).collect()
            best = min(best, time.time() - start)
        return best

    assert seconds("") < 4 * seconds(" ")
    df.unpersist()


def test_url_pattern_runs_only_where_a_url_can_be(spark):
    df = spark.createDataFrame([("See http://a.b/C?d now http",), ("xHTTPS://q\tr http http://",), ("no link, at all",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(clean_text("t")).collect()]
    assert got == ["see now http", "x r http", "no link at all", "", ""]
    assert [r[0] for r in df.select(clean_text("t", "")).collect()] == got
    assert "contains(" in df.select(clean_text("t"))._jdf.queryExecution().optimizedPlan().toString().lower()
