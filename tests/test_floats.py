"""Float texts against the interpreter's own."""
import math
import random
import struct

from pyspark.sql import functions as F

from tickerlens.functions import text as T


def test_equals_python(spark):
    random.seed(3)
    values = [0.0, -0.0, 1.0, 0.1, 100.0, 1e15, 1e16, 123456789012345.6, 9999999999999998.0, 1e-4, 1e-5, 0.00012345, 2e23, 1e23, 2e-3, 5e-324, 2.2250738585072014e-308,
              1.7976931348623157e308, 1e300, 2.0**-1074 * 3, 4.35, 1.1e-322, 2.0**63, 1e22, 8.41e21, 2.0e-44, 9.5e-5, math.inf, -math.inf, math.nan]
    while len(values) < 20_000:
        kind = random.random()
        if kind < 0.4:
            values.append(struct.unpack("d", random.randbytes(8))[0])
        elif kind < 0.7:
            values.append(float(f"{random.randint(1, 10 ** random.randint(1, 17))}e{random.randint(-320, 300)}"))
        else:
            values.append(round(random.uniform(-1e6, 1e6), random.randint(0, 6)) * 10.0 ** random.randint(-6, 12))
    df = spark.createDataFrame(list(enumerate(values)) + [(-1, None)], "i int, x double").repartition(4)
    got = {r.i: r.t for r in df.select("i", T.fmt_float("x").alias("t")).collect()}
    assert got.pop(-1) is None
    bad = [(v, got[i], format(v, ",")) for i, v in enumerate(values) if got[i] != format(v, ",")]
    assert not bad, (len(bad), bad[:5])
