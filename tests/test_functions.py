from __future__ import annotations

import math
import random

import pytest
from hypothesis import given, settings, strategies as hs
from pyspark.sql import functions as F

from earshot.functions import arrays as ar, scalars as sf
from earshot.functions.similar_text import jaro_winkler_py
from earshot.functions.snr import snr
from earshot.functions.speakers import speaker, split_name
from earshot.functions.text import plain, plain_py


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", f(F.col("v"))).collect())]


def test_speaker_forms(spark):
    forms = ["spk_000000038", "Spk.000000038", "spk00038", "SPK_000000038", "spk_000000038\t", "  spk_000000038", "Speaker_000038", "speaker 38", "SPK-38", "spk_OOOOOOO38", "38.0", "spk_０００００００３８", "spk_000000038 "]
    assert apply(spark, forms, speaker) == ["spk_000000038"] * len(forms)
    nobody = [None, "", "none", "null", "n/a", "Unknown ", "  ", "spk", "speaker"]
    assert apply(spark, nobody, speaker) == [None] * len(nobody)
    assert apply(spark, ["spk_1234567890123"], speaker) == ["spk_1234567890123"]


def test_splits(spark):
    assert apply(spark, [" train", "TRAIN", "train\n", "val", " val", "VAL", "Validation", "test\n", "?", "", None, "unassigned"], split_name) == ["train"] * 3 + ["validation"] * 4 + ["test"] + [None] * 4


@settings(max_examples=60, deadline=None)
@given(hs.text(max_size=30))
def test_plain_py_is_stable(s):
    assert plain_py(plain_py(s)) == plain_py(s)


def test_plain_agrees(spark):
    values = ["Café", "wаke", "ｆｕｌｌ９", "zero\u200bwidth", None, "", "ABC", "e\u0301"]
    assert apply(spark, values, plain) == [None if v is None else plain_py(v) for v in values]


def test_scalars(spark):
    assert apply(spark, ["hey_tessera_clip_12.wav", "call-home-v3.flac", "kettle_whistle_noise.wav", "open_gate_20230401_101530.wav", "lamp_d38z5_off.wav", "_1.wav", None], sf.spoken_text) == ["hey tessera", "call home", "kettle whistle", "open gate", "lamp off", "unknown", None]
    assert apply(spark, [0.5], lambda c: sf.platt(c, 1.0, 0.0), "double") == [0.5]
    assert apply(spark, [0.5], lambda c: sf.platt(c, 1.0, 1.0), "double")[0] > 0.5 > apply(spark, [0.5], lambda c: sf.platt(c, 1.0, -1.0), "double")[0]
    assert apply(spark, [0.0, 1.0, -3.0, 2.0, 0.5], sf.to_uint8, "double") == [0, 255, 0, 255, 128]
    assert apply(spark, ["1,2", "[5],[7,11]", "x", None], sf.parse_ints) == [[1, 2], [5, 7, 11], None, None]
    assert apply(spark, [float("nan"), float("inf"), 1.0, None], sf.finite, "double") == [None, None, 1.0, None]
    assert apply(spark, [0, 480, 481, 10**6], lambda c: sf.frame_count(c, 480, 160), "int") == [1, 1, 2, 6248]


def test_arrays(spark):
    f = lambda v, g: apply(spark, [[float(x) for x in a] for a in v], g, "array<float>")
    assert f([[1, 2, 3], [1], []], lambda c: ar.pad_or_cut(c, 2)) == [[1, 2], [1, 0], [0, 0]]
    assert f([[1, 2, 3], [1]], lambda c: ar.fixed_length(c, 2, "truncate_start")) == [[2, 3], [0, 1]]
    assert f([[0, 0, 1, 0, 2, 0], [0, 0], []], ar.trimmed_zeros) == [[1, 0, 2], [], []]
    assert f([[1, 2], []], lambda c: ar.tiled(c, 5)) == [[1, 2, 1, 2, 1], []]
    assert f([[3, 4], [0, 0]], ar.normalised) == [[0.6000000000000001, 0.8], [0, 0]] or f([[3, 4]], ar.normalised)[0] == pytest.approx([0.6, 0.8])
    assert f([[1, 0, 0]], lambda c: ar.convolved(c, (0.5, 0.25), 1.0)) == [[1.0, 0.5, 0.0, 0.0]]
    with pytest.raises(ValueError):
        ar.fixed_length(F.lit(1), 2, "other")


def test_snr(spark):
    r = random.Random(3)
    tone = [math.copysign(r.gammavariate(0.4, 1.0), r.random() - 0.5) for _ in range(6000)]  # speech-like amplitudes, as the method takes them

    def mixed(db):
        power = sum(x * x for x in tone) / len(tone)
        sigma = math.sqrt(power / 10 ** (db / 10))
        return [x + r.gauss(0, sigma) for x in tone]

    got = apply(spark, [[], [0.0] * 10, [1e-6 if i % 97 else 1.0 for i in range(500)], *[mixed(db) for db in (0, 5, 10, 15, 20)]], snr, "array<double>")
    assert got[:2] == [-20.0, -20.0] and all(-20 <= g <= 100 for g in got)
    assert got[3:] == sorted(got[3:]) and got[3:] == pytest.approx([0, 5, 10, 15, 20], abs=3)


def test_jaro_winkler():
    assert jaro_winkler_py("MARTHA", "MARHTA") == pytest.approx(0.9611, abs=1e-4) and jaro_winkler_py("", "a") == 0.0 and jaro_winkler_py("abc", "xyz") == 0.0
