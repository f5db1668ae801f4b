"""Recursive averages as a scan over pieces, against a loop over each series."""

import random

import pytest
from pyspark.sql import functions as F

from tidewright.operators import indicators


def looped(series):
    out, fast, slow, signal, gain, loss, atr, last = [], None, None, None, None, None, None, None
    ema = lambda old, x, n: x if old is None else old + (x - old) * 2 / (n + 1)
    wilder = lambda old, x: x if old is None else old + (x - old) / 14
    for k, close, high, low in series:
        fast, slow = ema(fast, close, 12), ema(slow, close, 26)
        signal = ema(signal, fast - slow, 9)
        if last is not None:
            gain, loss = wilder(gain, max(close - last, 0.0)), wilder(loss, max(last - close, 0.0))
        atr = wilder(atr, high - low if last is None else max(high - low, abs(high - last), abs(low - last)))
        last = close
        out.append((k, fast - slow, signal, None if not gain and not loss else 100 * gain / (gain + loss), atr))
    return out


@pytest.mark.parametrize("piece", [4, 512])
def test_smoothed(spark, monkeypatch, piece):
    monkeypatch.setattr(indicators, "_PIECE", piece)
    rng, rows, want = random.Random(1), [], {}
    for code, n in (("a", 90), ("b", 1), ("c", 5), ("flat", 6)):
        series = []
        for k in range(n):
            close = 5.0 if code == "flat" else round(rng.uniform(1, 100), 2)
            series.append((k, close, close + rng.random(), close - rng.random()))
        want[code] = looped(series)
        rows += [(code, k, c, h, low) for k, c, h, low in series]
    got = indicators.smoothed(spark.createDataFrame(rows, "code string, d int, close double, high double, low double"), "code", "d", F.floor(F.col("d") / 10).cast("int")).collect()
    assert len(got) == len(rows)
    for r in got:
        k, *values = want[r.code][r.d]
        for x, y in zip((r.macd, r.macd_signal, r.rsi14, r.atr14), values, strict=True):
            assert x == (None if y is None else pytest.approx(y, abs=1e-9))
