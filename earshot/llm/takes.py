"""Problem 1: the same take in a train row and in a validation or test row, by automata over sharded evaluation passages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from earshot.functions.speakers import speaker, split_name
from earshot.llm.names import one_slip
from earshot.llm.paths import clip_path, folder_speaker
from earshot.session import cut

# The parts of a clip's file name in its layouts. A session code has eight letters or digits; one may be mistyped, left out or put in.
_CODE = "([a-z0-9]{7,9})"
DATED = rf"^(\d{{8}})_{_CODE}_(.+?)_take_?(\d+)(?:_.*)?$"  # day_code_phrase_take3
NUMBERED = rf"^{_CODE}_(\d+)_(.+)$"  # code_03_phrase
# Before the take a phrase's last word stands too, so a code of another length than eight is known by a digit.
CODED = r"^(.+)_([a-z0-9]{8}|(?=[a-z]*\d)[a-z0-9]{7,9})_t(\d+)(?:_.*)?$"  # phrase_code_t003
UNCODED = r"^(.+?)_t(?:ake)?_?(\d+)(?:_.*)?$"  # phrase_t003
#: The last word of a phrase that may be a code without a digit of which a letter was left out or put in.
TAIL = r"_([a-z]{7}|[a-z]{9})$"


def parsed_takes(records: DataFrame) -> DataFrame:
    """(row_id, split, speaker, code, day, phrase, take, key, tail) of each record of (row_id, path, split, speaker_id).

    `key` names the session: its code or, where the name has none, speaker, day folder and phrase; null if these aren't known. `tail` is the last word of a phrase without a code that may be a
    mistyped code. A name in no layout has a null take and key. Null ids, paths and splits are kept."""
    path = clip_path(F.col("path"))
    rows = records.select("row_id", split_name(F.col("split")).alias("split"), speaker(F.col("speaker_id")).alias("known"), path.alias("p"))
    rows = rows.select("*", F.substring_index("p", "/", -1).alias("f"), F.regexp_extract("p", r"/d(\d{8})/", 1).alias("d"), F.coalesce("known", folder_speaker(F.col("p"))).alias("speaker"), F.instr("p", "/sp").alias("sp"))
    stem = F.regexp_replace(F.regexp_replace("f", r"\.(?:wave?|flac|mp3|ogg|m4a|aac|opus)(?:\.bak|\.old|\.tmp)*\s*$", ""), r"[^a-z0-9]+", "_")
    rows = rows.select("row_id", "split", "speaker", "d", "sp", stem.alias("f"))
    # Each pattern is run once a row: what matches becomes code|day|phrase|take behind its mark. A speaker folder above a day folder holds names without a code, so there a phrase of seven
    # letters is no code.
    nested = (F.col("d") != "") & (F.col("sp") > 0)
    as_ = lambda pattern, form: F.regexp_replace("f", pattern, form)
    rows = rows.withColumn("m", F.when(F.instr("f", "_take") > 0, as_(DATED, "=$2|$1|$3|$4")).otherwise(F.col("f")))
    rows = rows.withColumn("m", F.when(F.col("m").startswith("="), F.col("m")).otherwise(as_(NUMBERED, "=$1||$3|$2")))
    rows = rows.withColumn("m", F.when(F.col("m").startswith("=") | nested, F.col("m")).otherwise(as_(CODED, "=$2||$1|$3")))
    rows = rows.withColumn("m", F.when(F.col("m").startswith("="), F.col("m")).otherwise(as_(UNCODED, "=||$1|$2")))
    part = F.when(F.col("m").startswith("="), F.split(F.substr("m", F.lit(2)), r"\|"))
    rows = rows.withColumn("x", part)
    some = lambda c: F.nullif(c, F.lit(""))
    tail = F.when(~nested & (F.substr("m", F.lit(1), F.lit(3)) == "=||"), some(F.regexp_extract(F.col("x")[2], TAIL, 1)))
    rows = rows.select("row_id", "split", "speaker", tail.alias("tail"), some(F.col("x")[0]).alias("code"), some(F.coalesce(some(F.col("x")[1]), F.col("d"))).alias("day"), F.col("x")[2].alias("phrase"), F.col("x")[3].try_cast("int").alias("take"))
    uncoded = F.concat_ws("|", F.lit("u"), "speaker", "day", "phrase")
    whole = F.col("take").isNotNull() & F.col("speaker").isNotNull() & F.col("day").isNotNull()
    return rows.withColumn("key", F.when(F.col("code").isNotNull(), F.concat(F.lit("c|"), "code")).when(whole, uncoded))


def slim(takes: DataFrame) -> DataFrame:
    """`parsed_takes` with numbers for speakers and days, which aggregate by hash and shuffle as eight bytes."""
    number = F.coalesce(F.substr("speaker", F.lit(5)).try_cast("bigint"), F.xxhash64("speaker"))
    return takes.select("row_id", "split", F.when(F.col("speaker").isNotNull(), number).alias("speaker"), F.col("day").cast("int").alias("day"), "phrase", "take", "key", "tail")


def with_tails(takes: DataFrame) -> DataFrame:
    """`slim` takes with a split, by session: a take whose phrase ends in what may be a mistyped code comes a second time with the key `p|` and that word, which only a true code can match."""
    known = takes.where(F.col("split").isNotNull())
    return known.where(F.col("key").isNotNull()).unionByName(known.where(F.col("tail").isNotNull()).withColumn("key", F.concat(F.lit("p|"), "tail"))).drop("tail")


def sessions_of(takes: DataFrame) -> DataFrame:
    """One row per session: the speaker and day that its rows agree on, their number, and whether train and evaluation rows are among them."""
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).alias(c)
    held = lambda *names: F.max(F.col("split").isin(*names))
    return takes.groupBy("key").agg(one("speaker"), one("day"), F.count(F.lit(1)).alias("n"), held("validation", "test").alias("has_eval"), held("train").alias("has_train"))


def passages(text: str) -> list[str]:
    """The patterns of an evaluation session's text: the whole, both halves, and two shorter ends. `^` and `$` anchor them at the ends of a normalised text.

    Whatever the slip, a text of one slip holds the whole, a half, or both ends."""
    half, end = (len(text) + 1) // 2, max(1, (len(text) - 1) // 2)
    return [f"^{text}$", f"^{text[:half]}", f"{text[-half:]}$", f"^{text[:end]}", f"{text[-end:]}$"]


def slip(a: str, b: str) -> bool:
    """Equal, or one letter altered, left out or put in, or two neighbours swapped."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def mistyped(n: int, m: int, in_use: float) -> bool:
    """Whether of two phrases one slip apart, of n and m speaker and day sessions, one is a slip and not in use itself: it's found in one session only, or in no more than the share `in_use` of the other's."""
    return min(n, m) == 1 or min(n, m) <= in_use * max(n, m)


def covered(intervals: list[tuple[int, int]]) -> int:
    """Letters under merged half-open intervals."""
    total, end = 0, -1
    for a, b in sorted(intervals):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


class Shard:
    """One automaton over the passages of the evaluation sessions of a shard; texts are scanned by it."""

    def __init__(self, texts: list[str]) -> None:
        import ahocorasick

        self.texts = texts
        owners: dict[str, list[int]] = {}
        for i, text in enumerate(texts):
            for pattern in set(passages(text)):
                owners.setdefault(pattern, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for pattern, of in owners.items():
            self.automaton.add_word(pattern, (len(pattern), of))
        if owners:
            self.automaton.make_automaton()

    def scan(self, text: str, least: float = 0.5) -> list[tuple[int, float]]:
        """(evaluation text, the share of its letters that merged matches cover) where the share is `least` at least (but for one letter) and the two are one text up to one slip."""
        if not self.texts:
            return []
        hits: dict[int, list[tuple[int, int]]] = {}
        last = len(text)
        for end, (n, of) in self.automaton.iter(f"^{text}$"):
            span = (max(0, end - n), min(last, end))  # without the anchors
            for i in of:
                hits.setdefault(i, []).append(span)
        out = []
        for i, spans in hits.items():
            n, length = covered(spans), len(self.texts[i])
            if n >= least * (min(last, length) - 1) and slip(text, self.texts[i]):
                out.append((i, min(1.0, n / length)))
        return out


def _route_kind(a: str, b: str) -> str:
    """The first of the shards in which two codes meet."""
    return "<" if a[:4] == b[:4] else ">" if a[-4:] == b[-4:] else "="


COLUMNS = ["route", "key", "speaker", "day", "n_phrase", "is_text"]
PAIRS = "evaluation string, train string, coverage double"


class _Batch:
    """Evaluation passages of some shards and the train texts that are scanned against them, by automata of at most `most` passages."""

    def __init__(self, most: int, in_use: float) -> None:
        self.most, self.in_use = most, in_use
        self.clear()

    def clear(self) -> None:
        self.passages: dict[str, tuple] = {}
        self.texts: list[tuple] = []
        self.shards: list[tuple[list[tuple], Shard]] | None = None

    def flush(self) -> list[tuple[str, str, float]]:
        if self.shards is None:
            held = list(self.passages.values())
            parts = [held[i : i + self.most] for i in range(0, len(held), self.most)]
            self.shards = [(part, Shard([r[1][2:] for r in part])) for part in parts]
        out = [pair for text in self.texts for held, shard in self.shards for i, share in shard.scan(text[1][2:]) if (pair := self._pair(held[i], text, share))]
        self.texts = []
        return out

    def _pair(self, passage: tuple, text: tuple, share: float) -> tuple[str, str, float] | None:
        (_, k, s, d, m, _), (route, key, speaker, day, n, _) = passage, text
        if k == key:
            # Of the three shards in which a code meets itself the first counts.
            good = key[0] == "u" or (key[0] == "c" and route[0] == "<")
        elif key[0] == "u" or k[0] == "u":
            # Only a phrase may slip, and not into another that is in use.
            good = key[0] == k[0] and k.rpartition("|")[0] == key.rpartition("|")[0] and mistyped(n, m, self.in_use)
        else:
            true_code = {("c", "c"): True, ("c", "p"): len(k) == 10, ("p", "c"): len(key) == 10}.get((k[0], key[0]), False)  # kind, sign and eight letters
            good = true_code and route[0] == _route_kind(k[2:], key[2:]) and (s is None or speaker is None or s == speaker) and (d is None or day is None or d == day)
        return (k, key, share) if good else None


def _scan(batches: Iterator[pa.RecordBatch], most: int, in_use: float) -> Iterator[pa.RecordBatch]:
    """Rows by shard, in each the evaluation passages first, then the train texts. A session's text is its key without the kind: the code, or speaker, day and phrase.

    Whole shards are taken together until they hold `most` passages or texts; of a shard with more texts these are scanned part by part, so memory holds as many of either at a time, but for the
    passages of one shard."""
    batch_ = _Batch(most, in_use)
    last, held = None, False
    for batch in batches:
        out: list[tuple[str, str, float]] = []
        for row in zip(*(batch.column(c).to_pylist() for c in COLUMNS), strict=True):
            if row[0] != last:
                last, held = row[0], False
                if len(batch_.passages) >= most or len(batch_.texts) >= most or batch_.shards is not None:
                    out += batch_.flush()
                    batch_.clear()
            if not row[5]:
                batch_.passages[row[1]] = row
                held = True
            elif held:
                batch_.texts.append(row)
                if len(batch_.texts) >= 4 * most:
                    out += batch_.flush()
        yield _pairs(out)
    yield _pairs(batch_.flush())


def _pairs(out: list[tuple[str, str, float]]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], ["evaluation", "train", "coverage"])


def matching_sessions(sessions: DataFrame, *, in_use: float = 0.125, most: int = 20_000) -> DataFrame:
    """(evaluation, train, coverage): the pairs of session keys whose rows may be one take, and what share of the evaluation passage the matches cover.

    Sessions are sharded by parts of their code, three keys each, of which two codes of one slip share one; sessions without a code by speaker and day. How far a phrase is in use is counted in
    sessions, so copies of a mistyped clip don't make its spelling a phrase (`in_use`: see `mistyped`). The evaluation passages of some shards make an automaton, of `most` sessions at most, and
    every train text of these shards is scanned by it. A session is one text however many rows it has, so a hot one is no load. The pairs are distinct."""
    code = F.substr("key", F.lit(3))
    routes = F.array(F.concat(F.lit("<"), F.left(code, F.lit(4))), F.concat(F.lit(">"), F.right(code, F.lit(4))), F.concat(F.lit("="), F.left(code, F.lit(3)), F.right(code, F.lit(3))))
    is_coded = ~F.col("key").startswith("u")
    plain = sessions.where(~is_coded).withColumn("phrase", F.substring_index("key", "|", -1))
    counts = plain.groupBy(F.col("phrase").alias("_phrase")).agg(F.count(F.lit(1)).alias("n_phrase"))
    columns = ["route", "key", "speaker", "day", "n_phrase", "has_eval", "has_train"]
    both = sessions.where(is_coded).withColumn("route", F.explode(routes)).withColumn("n_phrase", F.lit(0).cast("bigint")).select(*columns)
    both = both.unionByName(plain.join(counts, F.col("phrase") == F.col("_phrase")).withColumn("route", F.substring_index("key", "|", 3)).select(*columns))
    roles = F.filter(F.array(F.when(F.col("has_eval"), F.lit(False)), F.when(F.col("has_train"), F.lit(True))), lambda x: x.isNotNull())
    return both.withColumn("is_text", F.explode(roles)).select(*COLUMNS).repartition(F.col("route")).sortWithinPartitions("route", "is_text").mapInArrow(lambda batches: _scan(batches, most, in_use), PAIRS)


def _met(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The evaluation rows of (row_id, split, speaker, key, take, phrase) with the train rows of the same take, as `row_id`, `split`, `row_id_train`, `coverage`."""
    train = rows.where(F.col("split") == "train").select(F.col("row_id").alias("row_id_train"), F.col("speaker").alias("speaker_train"), F.col("key").alias("train"), F.col("take").alias("take_train"), F.col("phrase").alias("phrase_train"))
    held = rows.where(F.col("split") != "train").withColumnRenamed("key", "evaluation")
    met = held.join(pairs.withColumnRenamed("train", "train_key"), "evaluation").join(train, (F.col("train_key") == F.col("train")) & (F.col("take") == F.col("take_train")))
    differ = F.coalesce(F.col("speaker") != F.col("speaker_train"), F.lit(False))
    # Two codes of one slip must go with one phrase, up to a slip or what a tool has put behind it.
    a, b = F.col("phrase"), F.col("phrase_train")
    words = F.when((F.col("evaluation") == F.col("train")) | F.col("train").startswith("u"), F.lit(True)).otherwise(a.startswith(b) | b.startswith(a) | one_slip(a, b))
    return met.where(~differ & words).select("row_id", "split", "row_id_train", "coverage")


def _takes_and_pairs(records: DataFrame, in_use: float) -> tuple[DataFrame, DataFrame]:
    takes = with_tails(cut(slim(parsed_takes(records)), "takes"))
    return takes.select("row_id", "split", "speaker", "key", "take", "phrase"), cut(matching_sessions(sessions_of(takes), in_use=in_use), "sessions")


def overlapping_takes(records: DataFrame, *, in_use: float = 0.125) -> DataFrame:
    """(row_id_train, row_id_eval, split, coverage): all pairs of a train row with a validation or test row that are the same take; coverage is the share of the evaluation row's session that
    matches in the train row's name cover.

    Rows are one take if their take numbers are equal, no two known speakers differ, and their sessions match: the same code, or one slip away with the same phrase and nothing known that
    differs; without a code the same speaker, day folder and phrase, the phrase up to a slip that is no other phrase in use (`mistyped`). Repeated rows pair like others; rows without a split, take
    or session pair with none, and an empty table gives no pairs. Paths are read whole however long, and columns other than the four named play no part. All pairs of a session's take are
    returned, as they are the result wanted; the join splits a hot session. `take_classes` has them without copies."""
    rows, pairs = _takes_and_pairs(records, in_use)
    return _met(rows, pairs).select("row_id_train", F.col("row_id").alias("row_id_eval"), "split", "coverage")


def take_classes(records: DataFrame, *, in_use: float = 0.125) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: row_id, class_id; sizes: class_id, n; links: class_train, class_eval, coverage): `overlapping_takes` without expanding copies.

    Rows of one session, take, speaker, phrase and split are alike to the operator and make a class, named by the kind of session (c by code, u without, p by what may be a mistyped code) and its
    least row; of each pair of classes one link is given. Every row that has a session and a split is a member of one class, and of a second if its phrase may end in a mistyped code."""
    rows, pairs = _takes_and_pairs(records, in_use)
    alike = ["split", "speaker", "key", "take", "phrase"]
    classes = cut(rows.groupBy(*alike).agg(F.min("row_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    classes = classes.withColumn("row_id", F.concat(F.left("key", F.lit(1)), F.col("least").cast("string"))).drop("least")
    links = _met(classes.drop("n"), pairs).select(F.col("row_id_train").alias("class_train"), F.col("row_id").alias("class_eval"), "coverage")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in alike]
    members = rows.alias("r").join(classes.alias("c"), same).select("r.row_id", F.col("c.row_id").alias("class_id"))
    return members, classes.select(F.col("row_id").alias("class_id"), "n"), links
