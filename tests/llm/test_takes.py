from __future__ import annotations

import random

from hypothesis import given, settings, strategies as hs

from earshot.llm.takes import COLUMNS, Shard, _scan, covered, overlapping_takes, parsed_takes, slip, take_classes


def brute_slip(a, b):
    if a == b:
        return True
    letters = sorted(set(a + b))
    out = {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in letters} | {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in letters}
    return b in out | {a[:i] + a[i + 1] + a[i] + a[i + 2 :] for i in range(len(a) - 1)}


@settings(max_examples=300, deadline=None)
@given(hs.text("abc", min_size=5, max_size=8), hs.text("abc", min_size=5, max_size=8))
def test_slip(a, b):
    assert slip(a, b) == brute_slip(a, b) == slip(b, a)


@settings(max_examples=200, deadline=None)
@given(hs.text("abcdefgh", min_size=8, max_size=8), hs.integers(0, 7), hs.sampled_from("abcdefgh"), hs.sampled_from(["sub", "del", "ins", "swap"]))
def test_every_slip_is_covered_by_a_passage(code, i, ch, how):
    text = {"sub": code[:i] + ch + code[i + 1 :], "del": code[:i] + code[i + 1 :], "ins": code[:i] + ch + code[i:], "swap": code[:i] + code[i + 1 : i + 2] + code[i : i + 1] + code[i + 2 :]}[how]
    there, back = Shard([code, "zzzzzzzz"]).scan(text), Shard([text]).scan(code)
    assert [i for i, _ in there] == [0] == [i for i, _ in back]
    assert all((share == 1) == (text == code) or how == "ins" or len(set(code)) < 8 for _, share in there) and there[0][1] >= 0.37


def test_covered():
    assert covered([]) == 0 and covered([(0, 3), (2, 5), (7, 8), (7, 8)]) == 6


def frame(spark, data):
    return spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "row_id bigint, path string, split string, speaker_id string")


CASES = [
    ("/d/negative/room/d20230101/abcd2345_03_call_home.wav", "train", "spk_000000001"),  # 0
    ("/d/negative/room/batch/20230101_abcd2345_call_home_take3.flac", "VAL", "1.0"),  # 1 another layout
    ("/d/negative/room/d20230101/CALL_HOME_ABCD2345_T0003_copy2 (1).wav.bak", "test\n", None),  # 2 another spelling, no speaker
    ("/d/negative/room/d20230101/abcd2345_04_call_home.wav", "validation", "spk_000000001"),  # 3 another take
    ("/d/negative/room/d20230101/abdc2345_03_call_home.wav", "validation", "spk_000000001"),  # 4 mistyped code
    ("/d/negative/room/d20230101/abcd2346_03_call_home.wav", "validation", "spk_000000002"),  # 5 another session
    ("/d/negative/room/d20230101/abcd2345_03_call_home.wav", "validation", "spk_000000009"),  # 6 another speaker
    ("/d/negative/room/d20230101/abcd2345_03_call_home.wav", "?", "spk_000000001"),  # 7 no split
    ("/d/positive/room/spk_000000005/d20230301/hey_tessera_t001.wav", "train", None),  # 8
    ("\\d\\positive\\room\\spk_000000005\\d20230301\\hey-tessera-t1.WAV", "val", "spk_000000005"),  # 9
    ("/d/positive/room/spk_000000005/d20230302/hey_tessera_t001.wav", "val", "spk_000000005"),  # 10 another day
    (None, "val", "spk_000000005"),  # 11
    ("", "train", ""),  # 12
    ("/x/" + "y" * 5000 + ".wav", "train", "spk_000000005"),  # 13
]


def test_pairs(spark):
    want = {(0, 1), (0, 2), (0, 4), (8, 9)}
    got = {(r.row_id_train, r.row_id_eval) for r in overlapping_takes(frame(spark, CASES)).collect()}
    assert got == want


def test_slips_of_phrases(spark):
    day = "/d/positive/r/spk_000000005/d20230301/"
    data = [(day + "okay_marlo_t001.wav", "train", None), (day + "okay_carlo_t001.wav", "val", None), (day + "okay_malro_t001.wav", "test", None)]
    filler = [(f"/d/positive/r/spk_{i:09d}/d20230301/{p}_t001.wav", "train", None) for p, n in (("okay_marlo", 40), ("okay_carlo", 20)) for i in range(100, 100 + n)]
    assert {(r.row_id_train, r.row_id_eval) for r in overlapping_takes(frame(spark, data + filler)).collect()} == {(0, 2)}


def test_copies_of_a_slip_and_phrases_of_few_sessions(spark):
    day = "/d/positive/r/spk_000000005/d20230301/"
    filed_again = [(day + "okay_malro_t001.wav", "test", None)] * 30
    data = [(day + "okay_marlo_t001.wav", "train", None), *filed_again, (day + "rare_words_t002.wav", "val", None), (day + "rare_wrods_t002.wav", "train", None)]
    filler = [(f"/d/positive/r/spk_{i:09d}/d20230301/{p}_t001.wav", "train", None) for p, n in (("okay_marlo", 40), ("rare_words", 2)) for i in range(100, 100 + n)]
    want = {(0, i) for i in range(1, 31)} | {(32, 31)}
    assert {(r.row_id_train, r.row_id_eval) for r in overlapping_takes(frame(spark, data + filler)).collect()} == want


def test_empty_repeated_and_clashing(spark):
    assert overlapping_takes(frame(spark, CASES).limit(0)).count() == 0
    from pyspark.sql import functions as F

    twice = frame(spark, CASES).unionByName(frame(spark, CASES)).withColumn("take", F.lit("x")).withColumn("key", F.lit(0))
    assert overlapping_takes(twice).count() == 4 * 4


def test_against_all_pairs(spark):
    r = random.Random(2)
    codes = ["".join(r.choice("abcdefghjkmnpqrstuvwxyz023456789") for _ in range(8)) for _ in range(25)]
    data = [(f"/d/negative/room/d20230101/{c}_{t:02d}_call_home.wav", r.choice(["train", "val", "test"]), r.choice([None, f"spk_{i % 5:09d}"])) for i, c in enumerate(codes) for t in range(1, 4) for _ in range(3)]
    rows = [(i, d[0].split("/")[-1], d[1], d[2]) for i, d in enumerate(data)]
    want = {(a[0], b[0]) for a in rows for b in rows if a[2] == "train" and b[2] != "train" and a[1] == b[1] and (a[3] is None or b[3] is None or a[3] == b[3])}
    assert {(x.row_id_train, x.row_id_eval) for x in overlapping_takes(frame(spark, data)).collect()} == want


def test_a_phrase_is_no_code(spark):
    data = [("/d/positive/room/flat/hey_tessera_t001.wav", "train", "spk_000000001"), ("/d/positive/hall/flat/hey_tessera_t001.wav", "val", "spk_000000001"), ("/d/positive/room/flat/hey_tesser7_t001.wav", "val", None)]
    assert [r.code for r in sorted(parsed_takes(frame(spark, data)).collect())] == [None, None, "tesser7"]
    assert overlapping_takes(frame(spark, data)).count() == 0


def test_a_code_without_digits_and_a_letter_too_many(spark):
    data = [
        ("/d/negative/room/d20230101/call_home_abcdefgh_t003.wav", "train", "spk_000000001"), ("/d/negative/room/d20230101/call_home_abcdefxgh_t003.wav", "val", "1"), ("/d/negative/room/d20230101/call_home_abcdfgh_t003.wav", "test", None),
        ("/d/negative/room/d20230101/tv_chatter_t003.wav", "train", None), ("/d/negative/room/d20230102/tv_chatter_t003.wav", "val", None), ("/d/negative/room/d20230101/read_news_abcdfgh_t003.wav", "test", None),
    ]
    assert {(r.row_id_train, r.row_id_eval) for r in overlapping_takes(frame(spark, data)).collect()} == {(0, 1), (0, 2)}


def test_shards_are_bounded():
    import pyarrow as pa

    r = random.Random(4)
    codes = ["".join(r.choice("abcde23") for _ in range(8)) for _ in range(300)]
    rows = sorted({(route, "c|" + c, None, None, 0, is_text) for c in codes for route in ("<" + c[:4], ">" + c[-4:], "=" + c[:3] + c[-3:]) for is_text in (False, True)}, key=lambda x: (x[0], x[5]))
    batches = lambda: (pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i : i + 97])], COLUMNS) for i in range(0, len(rows), 97))
    got = lambda most: sorted(p for b in _scan(batches(), most, 0.125) for p in zip(*b.to_pydict().values()))
    assert got(1) == got(7) == got(10_000) and [p[:2] for p in got(7)] == sorted(("c|" + a, "c|" + b) for a in set(codes) for b in set(codes) if slip(a, b))


def test_classes_are_the_pairs_without_copies(spark):
    rows = frame(spark, CASES).unionByName(frame(spark, CASES)).unionByName(frame(spark, CASES).selectExpr("row_id + 100 AS row_id", "path", "split", "speaker_id"))
    members, sizes, links = take_classes(rows)
    of = {}
    for r in members.collect():
        of.setdefault(r.class_id, []).append(r.row_id)
    pairs = sorted((a, b) for x in links.collect() for a in of[x.class_train] for b in of[x.class_eval])
    assert pairs == sorted((r.row_id_train, r.row_id_eval) for r in overlapping_takes(rows).collect()) and len(pairs) == 4 * 9 and links.count() == 4
    assert {r.class_id: r.n for r in sizes.collect()} == {k: len(v) for k, v in of.items()}


def test_parsed(spark):
    t = {r.row_id: r for r in parsed_takes(frame(spark, CASES)).collect()}
    assert (t[1].code, t[1].take, t[1].day) == ("abcd2345", 3, "20230101") and t[8].code is None and t[8].take == 1 and t[12].key is None
