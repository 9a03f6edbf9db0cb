"""Problem 7: abusive, hateful or sexual language, tagged by a linear-chain conditional random field. `toxicity_fit` learns it."""

from __future__ import annotations

import html
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from earshot.functions.text import folded_py, plain_table
from earshot.llm.markup import ENTITY_PATTERN, TAG, TAG_PATTERN
from earshot.worker import kept

_PIECE = re.compile(rf"{TAG_PATTERN}|{ENTITY_PATTERN}|.", re.S | re.I)
# Letters set apart by one and the same sign, as in "s.e.t": three or more of them.
_APART = re.compile(r"(?<![a-z0-9@$])[a-z0-9@$](?:([ ._*-])[a-z0-9@$](?:\1[a-z0-9@$])+)(?![a-z0-9@$])")
_WORD = re.compile(r"[a-z0-9_@$€*]+(?:[!|+'’][a-z0-9_@$€*]+)*|[.!?]+(?=\s|$)|\n|:(?=\s)|;")
_SIGN = re.compile(r"[0-9@$€*!|+]")
# What stands for letters in disguised words.
STANDS_FOR = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e"}
BOUND = 0  # the type of all boundaries


def tidy(text: str, table: dict) -> str:
    """Lower case without markup, look-alikes and unseen characters, letters that were set apart joined again."""
    if "<" in text:
        text = TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return _APART.sub(_joined, folded_py(text, table).lower())


def _joined(m: re.Match) -> str:
    s = m.group().replace(m.group(1), "")
    return s if sum(ch.isalpha() for ch in s) * 2 > len(s) else m.group()


def tidy_mapped(text: str, table: dict) -> tuple[str, list[int]]:
    """`tidy`, and for each of its characters the offset in the text, the text's length at the end."""
    out, at = [], []
    for m in _PIECE.finditer(text):
        piece = m.group()
        if len(piece) > 1:
            piece = " " if piece[0] == "<" else html.unescape(piece)
        for ch in (piece if piece.isascii() else piece.translate(table)).lower():
            out.append(ch)
            at.append(m.start())
    at.append(len(text))
    s, done, t, where = "".join(out), 0, [], []
    for m in _APART.finditer(s):
        new = _joined(m)
        t.append(s[done : m.start()] + new)
        where += at[done : m.start()]
        kept = [i for i in range(m.start(), m.end()) if s[i] != m.group(1)] if new != m.group() else range(m.start(), m.end())
        where += [at[i] for i in kept]
        done = m.end()
    return "".join(t) + s[done:], where + at[done:]


class Word(NamedTuple):
    """What a token is read as, whether its spelling hides that, and whether a given list has it."""

    reading: str
    hidden: bool
    listed: bool


class Speller:
    """Reads tokens. Of the readings of a spelling the first counts that is among the words `known` to tell, or on a given list, where a trailing * stands for any ending."""

    def __init__(self, known: frozenset[str], listed: frozenset[str] = frozenset()) -> None:
        self.known = known
        self.exact = {w for w in listed if not w.endswith("*")}
        self.stems = {w.rstrip("*") for w in listed if w.endswith("*")}
        self.longest = max(map(len, self.stems), default=0)
        self.long = sorted(w for w in {*known, *self.exact, *self.stems} if len(w) >= 4)
        self.table = str.maketrans(STANDS_FOR)

    def listed(self, w: str) -> bool:
        return w in self.exact or any(w[:n] in self.stems for n in range(1, min(len(w), self.longest) + 1))

    def telling(self, w: str) -> bool:
        return w in self.known or self.listed(w)

    def readings(self, token: str) -> list[str]:
        """As written, with signs and digits read as letters, with runs of a letter shortened."""
        out = [token.replace("'", "").replace("’", "").strip("_*")]
        if _SIGN.search(token) and any(ch.isalpha() for ch in token):
            t = token.replace("'", "")
            out += [t.translate(self.table), t.replace("1", "l").replace("!", "l").translate(self.table)]
        for w in list(out):
            if re.search(r"(.)\1", w):
                out += [re.sub(r"(.)\1{2,}", r"\1", w), re.sub(r"(.)\1+", r"\1", w) if len(w) >= 6 else w, re.sub(r"(.)\1{2,}", r"\1\1", w)]
        if len(token) >= 6 and token[0] in "ai" and self.telling(token[1:]):
            out.append(token[1:])  # an article that was drawn in with letters set apart
        return list(dict.fromkeys(out))

    def read(self, token: str) -> Word:
        readings = self.readings(token)
        for i, w in enumerate(readings):
            if self.telling(w):
                return Word(w, i > 0, self.listed(w))
        if "*" in token.strip("*"):
            stands = re.compile(token.strip("_").replace("*", "[a-z]{1,3}"))
            for w in self.long:
                if stands.fullmatch(w):
                    return Word(w, True, self.listed(w))
        signs = len(readings) > 1 and _SIGN.search(token) is not None
        return Word(readings[signs], signs, False)


def features(word: Word) -> list[str]:
    """A word's features: itself, its runs of three to five letters, whether it's disguised, whether it's on a given list."""
    out = ["w=" + word.reading]
    if len(word.reading) >= 4 and word.reading.isalpha():
        s = f"^{word.reading}$"
        out += [s[i : i + n] for n in (3, 4, 5) for i in range(len(s) - n + 1)]
    return out + ["hidden"] * word.hidden + ["listed"] * word.listed


@dataclass
class Model:
    """Learned weights: by feature for a word, by reading for the word before and the word behind, by pair of readings; the bias of label 1; of beginning with label 1, of going from label 0
    to 1, from 1 to 0, and staying with 1 (staying with 0 has weight 0). `known`: the words by which disguises are read, as are those `listed`. A document counts from score `threshold` on."""

    own: dict[str, float] = field(default_factory=dict)
    before: dict[str, float] = field(default_factory=dict)
    behind: dict[str, float] = field(default_factory=dict)
    pair: dict[tuple[str, str], float] = field(default_factory=dict)
    bias: float = -30.0
    move: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)
    known: frozenset[str] = frozenset()
    listed: frozenset[str] = frozenset()
    threshold: float = 0.4


class Tagger:
    """Applies a model. Words are known by type; a type's features and weights are worked out once."""

    def __init__(self, model: Model, table: dict, most_types: int = 400_000) -> None:
        self.model, self.table, self.most = model, table, most_types
        self.speller = Speller(model.known, model.listed)
        self.numbers: dict[str, int] = {}
        for pair in model.pair:
            for w in pair:
                self.numbers.setdefault(w, len(self.numbers) + 1)
        self.base = len(self.numbers) + 1
        keys = sorted((self.numbers[a] * self.base + self.numbers[b], x) for (a, b), x in model.pair.items())
        self.pair_keys = np.array([k for k, _ in keys] + [self.base**2], np.int64)
        self.pair_weights = np.array([x for _, x in keys] + [0.0])
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[str, int] = {}
        self.words = [Word("", False, False)]
        self.rows: list[tuple[float, float, float, int]] = [(0.0, 0.0, 0.0, 0)]

    def type_of(self, token: str) -> int:
        if token[0] in ".!?\n:;":
            i = BOUND
        elif token.isdigit():
            i = self.ids.get("0") or self._new("0")
        else:
            i = self._new(token)
        self.ids[token] = i
        return i

    def _new(self, token: str) -> int:
        word, m = self.speller.read(token) if token != "0" else Word("0", False, False), self.model
        self.words.append(word)
        self.rows.append((m.bias + sum(m.own.get(f, 0.0) for f in features(word)), m.before.get(word.reading, 0.0), m.behind.get(word.reading, 0.0), self.numbers.get(word.reading, 0)))
        self.ids[token] = len(self.rows) - 1
        return len(self.rows) - 1

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(type of each token, each text's first token), a boundary in front of each text and one at the end of all."""
        if len(self.rows) > self.most:
            self._reset()
        ids, starts, get, new = [], [], self.ids.get, self.type_of
        for t in texts:
            starts.append(len(ids))
            ids.append(BOUND)
            ids += [new(x) if (i := get(x)) is None else i for x in _WORD.findall(tidy(t, self.table))]
        ids.append(BOUND)
        return np.array(ids, np.int32), np.array(starts, np.int64)

    def emission(self, ids: np.ndarray) -> np.ndarray:
        """The log odds of label 1 by each token and its neighbours."""
        table = np.array(self.rows)
        u = table[ids, 0]
        u[1:] += table[ids[:-1], 1]
        u[:-1] += table[ids[1:], 2]
        number = table[:, 3].astype(np.int64)[ids]
        key = number[:-1] * self.base + number[1:]
        at = np.searchsorted(self.pair_keys, key)
        hit = self.pair_keys[at] == key
        u[1:][hit] += self.pair_weights[at[hit]]
        return u

    def marginals(self, ids: np.ndarray) -> np.ndarray:
        """The probability of each token to belong to such an utterance."""
        return Chains(ids).run(self.emission(ids), self.model.move)[0]


class Chains:
    """The utterances of `ids` as chains, the longest first, in blocks of chains of like length, so that padding stays small."""

    def __init__(self, ids: np.ndarray) -> None:
        self.n_tokens, self.firsts = len(ids), np.flatnonzero(ids == BOUND)
        lengths = np.diff(np.append(self.firsts, len(ids))) - 1
        some = np.flatnonzero(lengths > 0)
        self.segment = some[np.argsort(-lengths[some], kind="stable")]  # of each chain
        first, n = self.firsts[self.segment] + 1, lengths[self.segment]
        self.blocks, lo = [], 0
        while lo < len(n):
            hi = max(lo + 1, min(lo + 20_000, int(np.searchsorted(-n, -(n[lo] * 3 // 4), side="left"))))
            at = np.arange(int(n[lo]))[:, None]
            self.blocks.append((slice(lo, hi), np.minimum(first[None, lo:hi] + at, self.n_tokens - 1), at < n[None, lo:hi]))
            lo = hi

    def run(self, u: np.ndarray, move: tuple | np.ndarray, moves: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """By forward and backward passes over all chains at once: (P(label 1) of each token; of each chain the log of its sum over all labellings, the one of zeros only having weight 1; if
        wanted, of each chain the expected numbers of beginning with 1 and of moves 0 to 1, 1 to 0 and 1 to 1)."""
        begin, up, down, stay = np.exp(move)
        out, total = np.zeros(self.n_tokens), np.zeros(len(self.segment))
        counts = np.zeros((len(self.segment), 4)) if moves else None
        for part, grid, real in self.blocks:
            e = np.exp(np.clip(u[grid], -30, 30))
            zero, one = np.empty(grid.shape), np.empty(grid.shape)
            x = begin * e[0]
            zero[0], one[0], log = 1 / (1 + x), x / (1 + x), np.log1p(x)
            for t in range(1, len(grid)):
                a, b = zero[t - 1] + one[t - 1] * down, (zero[t - 1] * up + one[t - 1] * stay) * e[t]
                c, r = a + b, real[t]
                zero[t], one[t] = np.where(r, a / c, zero[t - 1]), np.where(r, b / c, one[t - 1])
                log += np.where(r, np.log(c), 0.0)
            total[part] = log
            p, back0, back1 = np.empty(grid.shape), np.ones(grid.shape[1]), np.ones(grid.shape[1])
            for t in range(len(grid) - 1, -1, -1):
                a, b = zero[t] * back0, one[t] * back1
                p[t] = b / (a + b)
                if not t:
                    break
                r, ahead = real[t], e[t] * back1
                a, b = back0 + up * ahead, down * back0 + stay * ahead
                if moves:
                    z = zero[t - 1] * a + one[t - 1] * b
                    for k, x in ((1, zero[t - 1] * up * ahead), (2, one[t - 1] * down * back0), (3, one[t - 1] * stay * ahead)):
                        counts[part, k] += np.where(r, x / z, 0.0)
                c = np.maximum(a, b)
                back0, back1 = np.where(r, a / c, back0), np.where(r, b / c, back1)
            if moves:
                counts[part, 0] = p[0]
            out[grid[real]] = p[real]
        return out, total, counts


def document_scores(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A document's score: the highest of its tokens' marginals."""
    return np.maximum.reduceat(p, starts)


# ---- over tables

SCORES = "score double, toxic boolean, spans array<struct<start:int,end:int,p:double>>"


def score_documents(documents: DataFrame, model: Model, *, text: str, keep: list[str], spans: bool = True, chunk: int = 1_000_000) -> DataFrame:
    """The columns `keep`, and for each document its score from 0 to 1, whether it reaches the model's threshold, and, if so and wanted, the offending spans.

    The score is the highest marginal of the document's tokens; spans are the runs of tokens whose marginals reach the threshold, with offsets in the original text. Whole texts are read. Null
    and empty texts have score 0 and no spans. The model goes to each executor once, and a worker works out a word once for all its tasks."""
    if clash := {"score", "toxic", "spans", "_text"} & set(keep):
        raise ValueError(f"rename {sorted(clash)} first")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema.fields) + ", " + SCORES
    n, name = len(keep), f"tagger {uuid.uuid4().hex}"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    sent = documents.sparkSession.sparkContext.broadcast((model, plain_table()))  # as large as the labelled sample's vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = kept(name, lambda: Tagger(*sent.value))
        threshold = tagger.model.threshold
        for batch in batches:
            texts = [t or "" for t in batch.column(n).to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo + 1, len(texts[lo])
                while hi < len(texts) and size + len(texts[hi]) <= chunk:
                    size += len(texts[hi])
                    hi += 1
                ids, starts = tagger.batch(texts[lo:hi])
                p = tagger.marginals(ids)
                scores = document_scores(p, starts)
                toxic = scores >= threshold
                where = [_spans(texts[lo + i], p[starts[i] + 1 :], threshold, tagger.table) if x and spans else [] for i, x in enumerate(toxic)]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[:n], pa.array(scores, pa.float64()), pa.array(toxic, pa.bool_()), pa.array(where, kind)], names=[*keep, "score", "toxic", "spans"])
                lo = hi

    return documents.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def _spans(text: str, p: np.ndarray, threshold: float, table: dict) -> list[dict]:
    """The runs of tokens of a text from the threshold on. p: the marginals of its tokens; a boundary's is 0 and ends a run."""
    tidied, at = tidy_mapped(text, table)
    found: list[dict] = []
    last = -2
    for i, (m, x) in enumerate(zip(_WORD.finditer(tidied), p)):
        if x >= threshold:
            if last == i - 1:
                found[-1] |= {"end": at[m.end() - 1] + 1, "p": max(found[-1]["p"], round(float(x), 6))}
            else:
                found.append({"start": at[m.start()], "end": at[m.end() - 1] + 1, "p": round(float(x), 6)})
            last = i
    return found
