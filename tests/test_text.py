import re
import unicodedata

from pyspark.sql import functions as F

from folio.functions import text as T


def test_strip_removes_what_the_pattern_does(spark):
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    pattern = re.compile("[ \t\n\x0b\x0c\r\x1c-\x1f\x85]")
    assert set(T.SPACES) == {c for c in every if pattern.match(c) or unicodedata.category(c)[0] == "Z"}
    rows = [f"{a}{b}x {a}y{b}{a}" for a in T.SPACES for b in T.SPACES] + ["", " ", " ", None, "a", "​z​", "\x00 "]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", T.strip(F.col("t")).alias("s"), T.rstrip(F.col("t")).alias("r"), F.regexp_replace("t", f"^{T.SPACE}+|{T.SPACE}+$", "").alias("s2"), F.regexp_replace("t", f"{T.SPACE}+$", "").alias("r2"))
    assert all(r.s == r.s2 and r.r == r.r2 for r in got.collect())


def test_lines(spark):
    ends = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]
    rows = ["", "a", None, *ends, *(f"a{e}" for e in ends), *(f"a{e}{e}b{e}{e}" for e in ends), "\n\r", "a\r\n\nb", "\n\n"]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", T.lines(F.col("t")).alias("l")).collect()
    assert all(r.l == (None if r.t is None else r.t.splitlines()) for r in got), [r for r in got if r.t is not None and r.l != r.t.splitlines()]
