from __future__ import annotations

import random

from conftest import rows
from hypothesis import given, settings, strategies as hs

from earshot.functions.text import plain_table
from earshot.llm.leaks import Passages, leaked_passages, letters, mapped, mapped_edges

T = plain_table()
R = random.Random(7)
WORDS = ["".join(R.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(R.randint(2, 9))) for _ in range(400)]
ITEMS = [(i, " ".join(R.choice(WORDS) for _ in range(45))) for i in range(6)]
INDEX = Passages(ITEMS, 16, T)
FILL = "the log says nothing about any of it and we will look again"


def words(i, a, b):
    return ITEMS[i][1].split()[a:b]


def hit(text):
    return {h[0] for h in INDEX.find(text)}


@settings(max_examples=150, deadline=None)
@given(hs.integers(0, 5), hs.integers(0, 25), hs.integers(1, 14), hs.sampled_from(["none", "sub", "del", "ins"]))
def test_one_slip_in_sixteen(item, start, at, how):
    w = words(item, start, start + 16)
    if how == "sub":
        w[at] = "qqqq"
    elif how == "del":
        w = words(item, start, start + 17)
        del w[at]
    elif how == "ins":
        w.insert(at, "qqqq")
    assert item in hit(f"{FILL}. {' '.join(w)} {FILL}")


def brute(item, text, run=16):
    """The longest run by trying every alignment word by word: it begins and ends with words as they are and has at most one slip in `run` of its words."""
    w, t, best = item.split(), text.split(), 0
    most = len(w) // run
    for i in range(len(w)):
        for s in range(len(t)):
            if w[i] != t[s]:
                continue
            seen, todo = set(), [(i, s, 0)]
            while todo:
                r, e, n = state = todo.pop()
                if state in seen or r >= len(w) or e >= len(t):
                    continue
                seen.add(state)
                if w[r] == t[e]:
                    if n == 0 or n * run <= r + 1 - i:
                        best = max(best, r + 1 - i)
                    todo.append((r + 1, e + 1, n))
                if n < most and state != (i, s, 0):
                    todo += [(r + 1, e + 1, n + 1), (r + 1, e, n + 1), (r, e + 1, n + 1)]
    return best


@settings(max_examples=120, deadline=None)
@given(hs.integers(0, 10**9))
def test_longest_runs_against_all_alignments(seed):
    r = random.Random(seed)
    w = ITEMS[r.randrange(6)][1].split()
    a = r.randint(0, 25)
    part = w[a : a + r.randint(15, 45)]
    for _ in range(r.randint(0, 4)):
        k = r.randrange(len(part))
        part[k : k + 1] = r.choice([["qqqq"], [], ["qqqq", part[k]], ["qq", "zz"]])
    text = " ".join([*FILL.split()[:4], *part, *FILL.split()[4:9]])
    item = " ".join(w)
    want = brute(item, text)
    found = Passages([(0, item)], 16, T).find(text)
    assert [h[1] for h in found] == ([want] if want >= 16 else [])


def test_too_short_or_too_much_altered():
    assert not hit(f"{FILL} {' '.join(words(0, 0, 12))} {FILL}")
    w = words(1, 0, 24)
    for i in (4, 9, 14, 19):
        w[i] = "qqqq"
    assert not hit(" ".join(w))
    assert not hit(" ".join(reversed(words(2, 0, 40))))


def test_disguises():
    w = words(3, 5, 25)
    plain = " ".join(w)
    forms = [
        plain.upper(),
        plain.replace(" ", "  \t "),
        "\n> ".join(" ".join(w[i : i + 4]) for i in range(0, 20, 4)),
        "<p>" + " <b>".join(w) + "</b>",
        "&nbsp;".join(w),
        ", ".join(f"**{x}**" if i % 3 else f"_{x}_" for i, x in enumerate(w)),
        plain.replace("a", "а").replace("e", "е"),
        "​".join(plain),
        plain[:40] + "-\n" + plain[40:],
        plain.replace("o", "ö"),
    ]
    for f in forms:
        assert hit(f"{FILL}! {f} {FILL}") == {3}, f


def test_markup_of_any_length():
    for n in (250, 301, 10_000):
        tag = f'<a href="{"x" * n}" title="5 > 3">'
        w = words(3, 5, 21)
        assert hit(f"{FILL} {' '.join(w[:8])} {tag}{' '.join(w[8:])}</a> {FILL}") == {3}
        assert not hit(f'{FILL} <img alt="{"z" * n} {" ".join(w)}"> {FILL}')
    assert hit(" ".join(words(3, 5, 13)) + " < " + " ".join(words(3, 13, 25)) + " > 3") == {3}  # no markup


def test_offsets_point_into_the_original():
    text = f"<i>{FILL}</i> – " + " ".join(x.upper() for x in words(4, 3, 23)) + " … end"
    (item, n, a, b), = INDEX.find(text)
    assert item == 4 and n == 20 and letters(text[a:b], T) == "".join(words(4, 3, 23))


@settings(max_examples=100, deadline=None)
@given(hs.text(alphabet=" aBé1-<>&;\n​а.", max_size=60))
def test_mapped_letters_are_letters_apart_from_broken_markup(s):
    doc, at, starts = mapped(s, T)
    assert len(doc) == len(at) and starts[0] == 0 and starts[-1] == len(doc) and at == sorted(at)


def test_punctuation_without_blanks_is_an_edge():
    w = " ".join(words(2, 7, 23))
    for f in ('{"q":"%s","a":1}', "cell|%s|next|", "see:%s.Then", "(%s)etc"):
        assert hit(f % w) == {2}, f
    assert mapped_edges("self-made don't_do.it", T)[3] == {0, 8, 14, 16}


def test_slips_at_the_ends_of_sixteen():
    for at in (0, 15):
        w = words(5, 10, 26)
        w[at] = "qqqq"
        assert not hit(f"{FILL} {' '.join(w)} {FILL}")
        w = words(5, 10, 26)
        w.insert(at, "qqqq")
        assert hit(f"{FILL} {' '.join(w)} {FILL}") == {5}
        w = words(5, 10, 27)
        del w[at]
        assert hit(f"{FILL} {' '.join(w)} {FILL}") == {5}


def test_every_text_of_a_repeated_id_counts():
    index = Passages([(7, ITEMS[0][1]), (7, " ".join(words(1, 0, 20)))], 16, T)
    for i, n in ((0, 45), (1, 20)):
        assert [h[:2] for h in index.find(f"{FILL} {' '.join(words(i, 0, n))} {FILL}")] == [(7, n)]


def test_tables(spark):
    docs = spark.createDataFrame([(1, ITEMS[0][1]), (1, ITEMS[0][1]), (2, None), (3, ""), (4, FILL * 3000), (5, FILL + " " + ITEMS[1][1] + " " + ITEMS[2][1]), (None, ITEMS[3][1])], "doc_id bigint, text string")
    items = spark.createDataFrame([*ITEMS, (99, "too short to count"), (None, ITEMS[0][1]), (98, None)], "item_id bigint, text string")
    got = leaked_passages(docs, items)
    assert rows(got.select("doc_id", "item_id")) == [(1, 0), (1, 0), (5, 1), (5, 2), (None, 3)]
    split = leaked_passages(docs, items, most_items=2)
    assert rows(split) == rows(leaked_passages(docs, items)) and split.rdd.getNumPartitions() > docs.rdd.getNumPartitions()
    assert leaked_passages(docs.limit(0), items).count() == 0 and leaked_passages(docs, items.limit(0)).count() == 0
