from __future__ import annotations

from pyspark.sql import functions as F

from earshot.llm.names import named
from earshot.llm.paths import clip_path, folder_speaker


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", f(F.col("v"))).collect())]


def test_paths(spark):
    same = ["/mnt/ww/a_b/c/x_t001.wav", "//mnt/ww/a_b/c/x_t001.wav", "./mnt/ww/a_b/c/x_t001.wav", "/mnt/ww/a_b/./c/x_t001.wav ", "D:\\mnt\\ww\\a_b\\c\\x_t001.wav", "file:///mnt/ww/a_b/c/x_t001.wav", "/mnt/ww/a%5Fb/c/x%5Ft001.wav", "/mnt/ww/a_b/q/../c/x_t001.wav", "\u200b/mnt/ww/а_b/c/X_T００1.wav"]
    assert apply(spark, same, clip_path) == [same[0]] * len(same)
    assert apply(spark, ["/a/100%/b.wav", "/a+b/c.wav", None], clip_path) == ["/a/100%/b.wav", "/a+b/c.wav", None]
    assert apply(spark, ["/a/spk_000000770/x.wav", "/a/speaker_38/x.wav", "/a/special/x.wav"], folder_speaker) == ["spk_000000770", "spk_000000038", None]


def test_named(spark):
    names = ["kitchen_far", "porch_evening", "glossary"]
    forms = ["kitchen far", "KITCHEN_FAR", "KitchenFar", "/data/x/kitchen_far", "kitchen-far", "kitchen_far/", " kitchen_far ", "kithen_far", "kitcehn_far", "porh_evening", "Glossary\n"]
    assert apply(spark, forms, lambda c: named(c, names)) == ["kitchen_far"] * 9 + ["porch_evening", "glossary"]
    assert apply(spark, ["", None, "far", "kitchen_near", "evening"], lambda c: named(c, names)) == [None] * 5
    assert apply(spark, ["kithen_far"], lambda c: named(c, names, slips=False)) == [None]
