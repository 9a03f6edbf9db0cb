"""Problem 5: passages of evaluation texts inside a corpus, by one automaton over the evaluation texts."""

from __future__ import annotations

import html
import re
import unicodedata
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from earshot.functions.text import folded_py, plain_table
from earshot.llm.cutoffs import bounded
from earshot.llm.markup import ENTITY_PATTERN, TAG, TAG_PATTERN
from earshot.worker import kept

_DROP = re.compile("[^a-z0-9]+")
_WITHIN = set("-_'\u2019\u2010\u2011")  # marks of which one alone may stand within a word
_PIECE = re.compile(rf"{TAG_PATTERN}|{ENTITY_PATTERN}|-[ \t]*+\r?\n[ \t>]*+|.", re.S | re.I)


def letters(text: str, table: dict) -> str:
    """The text's letters and digits only: no case, blanks, punctuation, markup, accents, look-alikes or unseen characters."""
    if "<" in text:
        text = TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return _DROP.sub("", folded_py(text, table).lower())


def mapped(text: str, table: dict) -> tuple[str, list[int], list[int]]:
    """(`letters`, the offset in the text of each letter, the positions among the letters at which a word starts)."""
    return mapped_edges(text, table)[:3]


def mapped_edges(text: str, table: dict) -> tuple[str, list[int], list[int], set[int]]:
    """`mapped` and the positions at which a word may start or end: its starts, and where punctuation stands between letters, other than a hyphen, apostrophe or underscore alone."""
    out, at, starts, edges = [], [], [0], {0}
    gap, marks = False, ""
    for m in _PIECE.finditer(text):
        piece = m.group()
        if len(piece) > 1:
            if piece[0] == "-":
                continue  # a word parted at the line's end
            piece = " " if piece[0] == "<" else html.unescape(piece)
        for ch in piece if piece.isascii() else piece.translate(table):
            ch = ch.lower()
            if "a" <= ch <= "z" or "0" <= ch <= "9":
                if gap and out:
                    starts.append(len(out))
                if gap or (marks and marks not in _WITHIN):
                    edges.add(len(out))
                gap, marks = False, ""
                out.append(ch)
                at.append(m.start())
            elif ch.isspace():
                gap = True
            elif unicodedata.category(ch)[0] in "PS":
                marks += ch
    starts.append(len(out))
    edges.add(len(out))
    return "".join(out), at, starts, edges


class Passages:
    """One automaton over every run of `seed` words of every item.

    A run of `run` words with at most one word altered, left out or put in holds `seed` = run / 2 words in a row as they are, so every passage that counts has a seed."""

    def __init__(self, items: list[tuple[int, str]], run: int, table: dict) -> None:
        import ahocorasick

        self.run, self.table, seed = run, table, run // 2
        self.words: list[list[str]] = []  # by the item's row, as an id may have several texts
        self.ids = [item for item, _ in items]
        owners: dict[str, list[tuple[int, int]]] = {}
        for row, (_, text) in enumerate(items):
            words = [w for w in (letters(x, table) for x in (TAG.sub(" ", text) if "<" in text else text).split()) if w]
            self.words.append(words)
            for i in range(len(words) - seed + 1 if len(words) >= run else 0):
                owners.setdefault("".join(words[i : i + seed]), []).append((row, i))
        self.seed, self.any = seed, bool(owners)
        self.automaton = ahocorasick.Automaton()
        for pattern, of in owners.items():
            self.automaton.add_word(pattern, (len(pattern), of))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, words of it in the longest run, offsets of the run in the text) of each item of which the text holds a passage."""
        if not self.any:
            return []
        plain = letters(text, self.table)
        hits = list(self.automaton.iter(plain))
        if not hits:
            return []
        doc, at, starts, edges = mapped_edges(text, self.table)
        if doc != plain:  # signs of markup that come from entities
            hits = list(self.automaton.iter(doc))
        best: dict[int, tuple[int, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for end, (n, of) in hits:
            for row, i in of:
                s, e = end + 1 - n, end + 1
                diagonal = (row, i - bisect_right(starts, s))
                if e <= done.get(diagonal, -1):
                    continue
                length, a, b, reach = self._longest(self.words[row], doc, starts, edges, i, s, e)
                done[diagonal] = reach
                item = self.ids[row]
                if length >= self.run and length > best.get(item, (0,))[0]:
                    best[item] = (length, at[a], at[b - 1] + 1)
        return [(item, *x) for item, x in sorted(best.items())]

    def _longest(self, w: list[str], doc: str, starts: list[int], edges: set[int], i: int, s: int, e: int) -> tuple[int, int, int, int]:
        """(item words, start and end in the letters, end of the run as it is) of the longest run around a seed with at most one slip in `run` words; a run begins and ends with words as they are."""

        def right(r: int, e: int) -> tuple[int, int]:
            r0 = r
            while r < len(w) and doc.startswith(w[r], e):
                e += len(w[r])
                r += 1
            while r > r0 and e not in edges:  # the item's last word is only the beginning of the text's
                r -= 1
                e -= len(w[r])
            return r, e

        def left(k: int, s: int) -> tuple[int, int]:
            k0 = k
            while k > 0 and s >= len(w[k - 1]) and doc.startswith(w[k - 1], s - len(w[k - 1])):
                s -= len(w[k - 1])
                k -= 1
            while k < k0 and s not in edges:
                s += len(w[k])
                k += 1
            return k, s

        def slipped_right(r: int, e: int) -> list[tuple[int, int]]:
            """One word altered, left out, or put in."""
            after = starts[bisect_right(starts, e)] if e < len(doc) else e
            return [x for x in ((r + 1, after), (r + 1, e), (r, after)) if x[0] < len(w) and x[1] < len(doc)]

        def slipped_left(k: int, s: int) -> list[tuple[int, int]]:
            before = starts[max(0, bisect_right(starts, s - 1) - 1)] if s > 0 else s
            return [x for x in ((k - 1, before), (k - 1, s), (k, before)) if x[0] > 0 and x[1] > 0]

        def reached(first: tuple[int, int], slips: int, slipped, onward) -> list[list[tuple[int, int]]]:
            """By number of slips, the ends that a run can have."""
            ends, at = [[first]], {first}
            for _ in range(slips):
                ends.append([])
                new = set()
                for x in {y for z in at for y in slipped(*z)}:
                    y = onward(*x)
                    new.add(y)
                    if y != x:
                        ends[-1].append(y)
                at = new
            return ends

        most = len(w) // self.run
        to_right = reached(right(i + self.seed, e), most, slipped_right, right)
        to_left = reached(left(i, s), most, slipped_left, left)
        found = [
            (r - k, s1, e1)
            for n, lefts in enumerate(to_left) for k, s1 in lefts
            for m, rights in enumerate(to_right[: most - n + 1]) for r, e1 in rights
            if n + m == 0 or (n + m) * self.run <= r - k
        ]
        return (*max(found), to_right[0][0][1])


def shards(items: DataFrame, item_id: str, item_text: str, most_items: int, most_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in parts by a hash of their ids, of about `most_items` rows and `most_chars` characters each, one part at a time."""
    held = items.select(F.col(item_id).alias("_id"), F.col(item_text).alias("_t")).where(F.col(item_id).isNotNull() & (F.length(item_text) > 0))
    n, chars = held.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("_t")), F.lit(0))).first()
    k = max(-(-n // most_items), -(-chars // most_chars))
    for i in range(k):
        part = held if k == 1 else held.where(F.pmod(F.xxhash64("_id"), F.lit(k)) == i)
        yield sorted((r[0], r[1]) for r in bounded(part, 2 * most_items + 1000))


def leaked_passages(documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", run: int = 16, most_items: int = 50_000, most_chars: int = 50_000_000) -> DataFrame:
    """(doc_id, item_id, n_words, start, end): every document that holds a run of at least `run` words of an item, in order, of which at most one in `run` is altered, left out or has a
    word put in beside it; n_words is the longest such run found, start and end are its offsets in the original text. A slip lies within the run: a run whose first or last word is altered
    ends before it, so of sixteen words such a one holds fifteen.

    Each text is scanned whole, once for each automaton; case, punctuation, spacing, markup, look-alikes and unseen characters play no part. Up to `most_items` items of `most_chars` characters
    make one automaton; more are split by hash into several, each of which scans all texts. Items go to each executor once, and a Python worker builds an automaton once for all its tasks. Null
    ids and texts of items are left out, of repeated ids every text counts, and items of fewer than `run` words hold no passage. Null and empty texts have none. Repeated documents give repeated
    rows. Without documents or items there are no rows."""
    table, context = plain_table(), documents.sparkSession.sparkContext
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    columns = documents.select(F.col(doc_id).cast("bigint"), F.col(text)).where(F.col(text).isNotNull())

    def scanned(part: list[tuple[int, str]]) -> DataFrame:
        sent, name = context.broadcast((part, run, table)), f"passages {uuid.uuid4().hex}"

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = kept(name, lambda: Passages(*sent.value))
            for batch in batches:
                out = [(i, *hit) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t for hit in index.find(t)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["doc_id", "item_id", "n_words", "start", "end"])

        return columns.mapInArrow(scan, "doc_id bigint, item_id bigint, n_words int, start int, end int")

    parts = [scanned(part) for part in shards(items, item_id, item_text, most_items, most_chars)] or [scanned([])]
    return reduce(DataFrame.unionByName, parts)
